"""Service edges (F21) with their peer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telescry.entities.addresses import agency_name, names_of
from telescry.functions.text import to_long, truthy

EDGE_SCHEMA = (
    "data struct<serviceEdgeList:struct<list:array<struct<id:string, name:string, "
    "physicalConnection:struct<connectionName:string>, equipmentInterface:struct<device:struct<name:string>>, "
    "organization:struct<shortName:string, fullName:string, types:string, fundingAgency:string, visibility:string, "
    "tags:array<string>>, bgpNeighbors:array<struct<remoteIp:string, peerDetail:struct<asn:string>>>>>>>"
)


def peer(neighbors: Column) -> Column:
    """Peer of one or two BGP neighbours as ``(as_id, ipv4, ipv6)``, else null.

    Neighbours without an address do not count; the later one of a family wins; a bad AS number is
    ignored; two different AS numbers void the peer.
    """
    with_ip = F.filter(neighbors, lambda n: truthy(n.getField("remoteIp")))
    ips = F.transform(with_ip, lambda n: n.getField("remoteIp"))
    asns = F.array_distinct(F.array_compact(F.transform(with_ip, lambda n: to_long(n.getField("peerDetail").getField("asn")))))
    last = lambda items: F.get(F.reverse(items), F.lit(0))
    usable = F.size(neighbors).between(1, 2) & (F.size(with_ip) > 0) & (F.size(asns) <= 1)
    return F.when(usable, F.struct(
        F.get(asns, F.lit(0)).alias("as_id"),
        last(F.filter(ips, lambda i: ~i.contains(":"))).alias("ipv4"),
        last(F.filter(ips, lambda i: i.contains(":"))).alias("ipv6")))


def stage_service_edges(rows: DataFrame) -> DataFrame:
    """landed payloads -> one row per ``device::edge``."""
    listed = rows.select("_pos", F.posexplode("data.data.serviceEdgeList.list").alias("_s", "s"))
    device = F.col("s.equipmentInterface.device.name")
    good = listed.filter(truthy(F.col("s.name")) & truthy(device))
    org = "s.organization"
    tags = F.coalesce(F.filter(f"{org}.tags", truthy), F.array().cast("array<string>"))
    hidden = F.coalesce(F.upper(f"{org}.visibility") == "HIDDEN", F.lit(False)) | F.exists(tags, lambda t: F.lower(t) == "hide")
    out = good.withColumn("_peer", peer(F.col("s.bgpNeighbors")))
    return out.select(
        F.struct("_pos", "_s").alias("_pos"), F.concat_ws("::", device, "s.name").alias("id"),
        F.lit("{}").alias("ext"), F.array().cast("array<string>").alias("tag"),
        F.col("s.physicalConnection.connectionName").alias("connection_name"), F.col("s.id").alias("service_edge_id"),
        F.col(f"{org}.shortName").alias("org_short_name"), F.col(f"{org}.fullName").alias("org_full_name"),
        hidden.alias("org_hide"), tags.alias("org_tag"), names_of(F.col(f"{org}.types")).alias("org_type"),
        agency_name(F.col(f"{org}.fundingAgency")).alias("org_funding_agency"),
        F.col("_peer.as_id").alias("peer_as_id"), F.col("_peer.ipv4").alias("peer_ipv4"), F.col("_peer.ipv6").alias("peer_ipv6"))
