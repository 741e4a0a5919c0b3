"""Prefix-list entities: event venue, science registry, grid sites, service prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telescry.functions.net import address_or_cidr, cidr_struct
from telescry.functions.text import day_or_epoch, to_double, to_long, truthy
from telescry.operators.predicates import all_present


VENUE_SCHEMA = (
    "addresses array<string>, org_name string, resource_name string, latitude string, longitude string"
)
SCIENCE_SCHEMA = (
    "scireg_id string, addresses array<string>, last_updated string, org_name string, discipline string, "
    "latitude string, longitude string, resource_name string, project_name string, contact_email string"
)
GRID_SCHEMA = (
    "map<string, struct<country:string, latitude:string, longitude:string, rc_tier_level:string, "
    "netroutes:map<string, struct<netsite:string, networks:struct<ipv4:array<string>, ipv6:array<string>>>>>>"
)
SERVICE_SCHEMA = (
    "data struct<serviceList:struct<list:array<struct<id:string, label:string, prefixGroupName:string, "
    "serviceType:struct<shortName:string>, customer:struct<shortName:string, fullName:string, types:string, "
    "fundingAgency:string, visibility:string>, peer:struct<asn:string>, prefixes:string>>>>"
)


def _defaults() -> list[Column]:
    return [F.lit("{}").alias("ext"), F.array().cast("array<string>").alias("tag")]


def address_list(c: Column) -> Column:
    """Addresses and CIDRs -> CIDR structs; items that are neither are dropped."""
    return F.array_compact(F.transform(c, address_or_cidr))


def stage_event_venue(rows: DataFrame) -> DataFrame:
    """F17."""
    good = rows.filter(all_present(["addresses", "org_name", "resource_name"]))
    return good.select(
        "_pos", F.col("resource_name").alias("id"), *_defaults(), address_list(F.col("addresses")).alias("ip_subnet"),
        F.col("org_name").alias("organization_name"), to_double(F.col("latitude")).alias("coordinate_x"),
        to_double(F.col("longitude")).alias("coordinate_y"))


def stage_science_registry(rows: DataFrame) -> DataFrame:
    """F18."""
    good = rows.filter(all_present(["scireg_id", "addresses"]))
    return good.select(
        "_pos", F.col("scireg_id").alias("id"), *_defaults(), day_or_epoch(F.col("last_updated")).alias("scireg_update_time"),
        address_list(F.col("addresses")).alias("ip_subnet"), F.col("org_name").alias("organization_name"),
        F.col("org_name").alias("organization_id"), "discipline", to_double(F.col("latitude")).alias("latitude"),
        to_double(F.col("longitude")).alias("longitude"), "resource_name", "project_name", "contact_email")


def stage_grid_sites(rows: DataFrame) -> DataFrame:
    """``sites`` is a map site -> record; one row per network route with its v4 then v6 blocks."""
    sites = rows.select("_pos", F.posexplode("sites").alias("_s", "site", "s"))
    routes = sites.select("_pos", "_s", "site", "s", F.posexplode("s.netroutes").alias("_r", "route", "r"))
    blocks = lambda c: F.array_compact(F.transform(F.coalesce(c, F.array().cast("array<string>")), cidr_struct))
    found = routes.withColumn("ip_subnet", F.concat(blocks(F.col("r.networks.ipv4")), blocks(F.col("r.networks.ipv6"))))
    found = found.filter(F.size("ip_subnet") > 0)
    return found.select(
        F.struct("_pos", "_s", "_r").alias("_pos"), F.col("route").alias("id"), *_defaults(), "ip_subnet",
        F.when(truthy(F.col("site")), F.col("site")).otherwise(F.lit("Unknown")).alias("rcsite_name"),
        to_double(F.col("s.latitude")).alias("latitude"), to_double(F.col("s.longitude")).alias("longitude"),
        F.col("s.country").alias("country_name"), F.col("r.netsite").alias("netsite_name"),
        to_long(F.col("s.rc_tier_level")).alias("tier"))


def names_of(c: Column) -> Column:
    """JSON list of ``{"name": ..}`` objects or plain strings -> names that are not empty."""
    items = F.from_json(c, "array<string>")
    named = F.transform(items, lambda i: F.when(
        i.startswith("{"), F.get_json_object(i, "$.name")).otherwise(i))
    return F.coalesce(F.filter(named, lambda n: n.isNotNull() & (n != "")), F.array().cast("array<string>"))


def agency_name(c: Column) -> Column:
    """JSON ``{"shortName": ..}`` or plain text."""
    return F.when(c.startswith("{"), F.get_json_object(c, "$.shortName")).otherwise(c)


def prefixes_of(c: Column) -> Column:
    """JSON list of ``{"prefixIp": ..}`` objects or plain strings."""
    items = F.from_json(c, "array<string>")
    return F.transform(items, lambda i: F.when(i.startswith("{"), F.get_json_object(i, "$.prefixIp")).otherwise(i))


def service_rows(rows: DataFrame) -> DataFrame:
    """One row per service with its prefixes, labels and organisation; ``seq`` is the input order."""
    listed = rows.select("_pos", F.posexplode("data.data.serviceList.list").alias("_s", "s"))
    c = "s.customer"
    return listed.select(
        F.struct("_pos", "_s").alias("seq"), prefixes_of(F.col("s.prefixes")).alias("prefixes"),
        F.col("s.prefixGroupName").alias("group_name"), F.col("s.label").alias("label"),
        F.col("s.serviceType.shortName").alias("kind"),
        F.struct(
            F.col(f"{c}.shortName").alias("org_short_name"), F.col(f"{c}.fullName").alias("org_full_name"),
            names_of(F.col(f"{c}.types")).alias("org_types"), agency_name(F.col(f"{c}.fundingAgency")).alias("org_funding_agency"),
            F.coalesce(F.col(f"{c}.visibility").isin("Hidden", "Hide Flow Data"), F.lit(False)).alias("org_hide"),
            to_long(F.col("s.peer.asn")).alias("as_id")).alias("org"))


def merge_prefixes(services: DataFrame) -> DataFrame:
    """Services that share a prefix become one row.

    Names are reduced to their first position per (prefix, name) before they are collected, so what is
    gathered per prefix is the result's own distinct names, however many services list the prefix.
    """
    listed = services.select("seq", "group_name", "label", "kind", "org", F.posexplode("prefixes").alias("_p", "prefix"))
    listed = listed.filter(truthy(F.col("prefix"))).withColumn("seq", F.struct("seq", "_p"))
    head = listed.groupBy("prefix").agg(F.min_by("org", "seq").alias("org"), F.min("seq").alias("first_seq"))
    entries = F.array(*[F.struct(F.lit(n).alias("list"), F.col(n).alias("name")) for n in ("group_name", "label", "kind")])
    names = listed.select("prefix", "seq", F.explode(entries).alias("e")).filter(truthy(F.col("e.name")))
    firsts = names.groupBy("prefix", "e.list", "e.name").agg(F.min("seq").alias("seq"))
    ordered = lambda which: F.transform(
        F.array_sort(F.expr(f"collect_list(struct(seq, name)) FILTER (WHERE list = '{which}')")), lambda s: s.getField("name"))
    lists = firsts.groupBy(F.col("prefix").alias("_prefix")).agg(
        ordered("group_name").alias("group_names"), ordered("label").alias("labels"), ordered("kind").alias("kinds"))
    joined = head.join(lists, F.col("prefix") == F.col("_prefix"), "left")
    empty = F.array().cast("array<string>")
    return joined.select(
        "prefix", "first_seq", *[F.coalesce(c, empty).alias(c) for c in ("group_names", "labels", "kinds")], "org.*")


def stage_service_prefixes(rows: DataFrame) -> DataFrame:
    """landed payloads -> one row per prefix; a prefix that is no CIDR is dropped."""
    merged = merge_prefixes(service_rows(rows)).withColumn("_cidr", cidr_struct(F.col("prefix"))).filter(F.col("_cidr").isNotNull())
    return merged.select(
        F.col("first_seq").alias("_pos"), F.col("prefix").alias("id"), *_defaults(), F.array("_cidr").alias("ip_subnet"),
        F.col("group_names").alias("service_prefix_group_name"), F.col("labels").alias("service_label"),
        F.col("kinds").alias("service_type"), "org_short_name", "org_full_name", "org_types", "org_funding_agency", "org_hide", "as_id")
