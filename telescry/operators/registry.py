"""Public registry and geolocation merges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telescry.functions.net import cidr_struct
from telescry.functions.text import to_double, truthy
from telescry.operators.lookup import lookup_join, overlay
from telescry.operators.prefix import cidr_join, prefix_keys

# Id prefixes, provenance marks and the name of an unnamed organisation.
AS_REGISTRY, NET_REGISTRY = "caida", "peeringdb"
AS_SOURCE, NET_SOURCE = "CAIDA", "PeeringDB"
UNNAMED = "Delegated"
NET_ATTRIBUTES = {
    "peeringdb_ipv6": "info_ipv6",
    "peeringdb_prefixes4": "info_prefixes4",
    "peeringdb_prefixes6": "info_prefixes6",
    "peeringdb_ratio": "info_ratio",
    "peeringdb_scope": "info_scope",
    "peeringdb_traffic": "info_traffic",
    "peeringdb_type": "info_types",
}


def country_names(df: DataFrame, iso: DataFrame | None) -> DataFrame:
    """Add ``country_name`` and ``continent_name`` for ``country_code`` from an ISO dimension
    ``country_code, country_name, continent_name``."""
    return lookup_join(df, iso, {"country_code": "country_code"},
                       {"country_name": "_country", "continent_name": "_continent"})


def _last(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(*keys, *[f"_r.{c}" for c in rest])


def _first(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("_r")).select(*keys, *[f"_r.{c}" for c in rest])


def as_records(registry: DataFrame) -> DataFrame:
    """Records of type ASN: ``asn, organization_id, name``; a repeated number keeps its last record."""
    rows = registry.filter(F.col("type") == "ASN").select(
        "pos", F.col("asn").try_cast("bigint").alias("asn"),
        F.concat(F.lit(f"{AS_REGISTRY}:"), F.col("organizationId")).alias("organization_id"), "name")
    rows = rows.filter(F.col("asn").isNotNull() & F.col("organization_id").isNotNull() & F.col("name").isNotNull())
    return _last(rows, ["asn"], "pos").drop("pos")


def org_records(registry: DataFrame) -> DataFrame:
    """Records of type Organization: ``id, name, country_code``."""
    rows = registry.filter((F.col("type") == "Organization") & F.col("organizationId").isNotNull()).select(
        "pos", F.concat(F.lit(f"{AS_REGISTRY}:"), F.col("organizationId")).alias("id"),
        F.coalesce("name", F.lit(UNNAMED)).alias("name"),
        F.when(truthy(F.col("country")), F.col("country")).alias("country_code"))
    return _last(rows, ["id"], "pos").drop("pos")


def merge_registries(registry: DataFrame, net_orgs: DataFrame, nets: DataFrame, iso: DataFrame | None = None,
                     subdivisions: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """AS and organisation tables from an AS registry and a network registry.

    ``registry`` has ``pos, type, asn, organizationId, name, country``; ``net_orgs`` ``pos, id, name,
    country, city, state, latitude, longitude``; ``nets`` ``pos, asn, org_id, name, info_*``; ``pos`` is
    the input order.  The first network of a number gives name and attributes, the first network of an
    organisation fills that organisation's gaps.
    """
    as1, org1 = as_records(registry), org_records(registry)
    org2 = _last(net_orgs.filter(F.col("id").isNotNull()).withColumn(
        "id", F.concat(F.lit(f"{NET_REGISTRY}:"), F.col("id").cast("string"))), ["id"], "pos").drop("pos")

    net = nets.withColumn("asn", F.col("asn").try_cast("bigint")).filter(F.col("asn").isNotNull() & F.col("org_id").isNotNull())
    net = net.withColumn("net_org", F.concat(F.lit(f"{NET_REGISTRY}:"), F.col("org_id").cast("string")))
    net = net.join(org2.select(F.col("id").alias("net_org")), "net_org", "left_semi")
    keyed = as1.select("asn", F.col("organization_id").alias("_org1"), F.col("name").alias("_name1"))
    usable = net.join(keyed, "asn", "left").filter(F.col("_name1").isNotNull() | F.col("name").isNotNull())

    first = _first(usable.select("asn", "pos", "net_org", F.col("name").alias("_name2"), *NET_ATTRIBUTES.values()), ["asn"], "pos")
    merged = as1.join(first.drop("pos"), "asn", "full_outer")
    in_net = F.col("net_org").isNotNull()
    sources = F.array_compact(F.array(F.when(F.col("name").isNotNull(), F.lit(AS_SOURCE)), F.when(in_net, F.lit(NET_SOURCE))))
    as_ext = F.to_json(F.struct(sources.alias("data_source"), *[F.col(src).alias(n) for n, src in NET_ATTRIBUTES.items()]))
    as_table = merged.select(
        F.col("asn").alias("id"), F.when(in_net, F.col("_name2")).otherwise(F.col("name")).alias("name"),
        F.coalesce("organization_id", "net_org").alias("organization_id"), as_ext.alias("ext"))

    # every network touches the organisation its AS belongs to; the first one fills the gaps
    owners = as_table.select(F.col("id").alias("asn"), F.col("organization_id").alias("owner"))
    touches = usable.join(owners, "asn").select("owner", "pos", "net_org")
    filler = _first(touches, ["owner"], "pos").select(F.col("owner").alias("_owner"), F.col("net_org").alias("_filler"))
    created = as_table.join(as1.select(F.col("asn").alias("id")), "id", "left_anti").select(F.col("organization_id").alias("id")).distinct()
    new_orgs = org2.join(created, "id", "left_semi").select(
        "id", "name", F.when(truthy(F.col("country")), F.col("country")).alias("country_code"),
        F.array().cast("array<string>").alias("_sources"))
    orgs = org1.withColumn("_sources", F.array(F.lit(AS_SOURCE))).unionByName(new_orgs)
    extra = org2.select(F.col("id").alias("_fid"), F.col("country").alias("_country2"), F.col("city").alias("city_name"),
                        F.col("state").alias("_state"), F.col("latitude").alias("latitude"), F.col("longitude").alias("longitude"))
    orgs = orgs.join(filler, F.col("id") == F.col("_owner"), "left").join(extra, F.col("_filler") == F.col("_fid"), "left")
    orgs = orgs.withColumn("country_code", F.coalesce("country_code", F.when(truthy(F.col("_country2")), F.col("_country2"))))
    orgs = country_names(orgs, iso)
    orgs = orgs.withColumn("country_sub_code", F.when(truthy(F.col("_state")), F.col("_state")))
    orgs = lookup_join(orgs, subdivisions, {"country_code": "country_code", "country_sub_code": "subdivision_code"},
                       {"subdivision_name": "country_sub_name"})
    marks = F.concat("_sources", F.when(F.col("_filler").isNotNull(), F.array(F.lit(NET_SOURCE))).otherwise(F.array().cast("array<string>")))
    org_table = orgs.select(
        "id", "name", "country_code", F.col("_country").alias("country_name"), F.col("_continent").alias("continent_name"),
        "city_name", "country_sub_code", "country_sub_name",
        to_double(F.col("latitude").cast("string")).alias("latitude"), to_double(F.col("longitude").cast("string")).alias("longitude"),
        F.to_json(F.struct(marks.alias("data_source"))).alias("ext"))
    return as_table, org_table


def asn_index(blocks: DataFrame) -> DataFrame:
    """D12 index from ``pos, network, autonomous_system_number``; a repeated prefix keeps its last row."""
    rows = blocks.filter(truthy(F.col("network")) & truthy(F.col("autonomous_system_number").cast("string")))
    cidr = cidr_struct(F.col("network"))
    rows = rows.select("pos", cidr.alias("c"), F.col("autonomous_system_number").try_cast("bigint").alias("as_id"))
    rows = rows.filter(F.col("c").isNotNull() & F.col("as_id").isNotNull()).select("pos", "c.ip", "c.len", "as_id")
    keyed = prefix_keys(rows, "ip", "len")
    return keyed.groupBy("family", "plen", "hi", "lo").agg(F.max_by("as_id", "pos").alias("as_id"))


def locations(rows: DataFrame) -> DataFrame:
    """D13 dimension: ``geoname_id`` -> names; a repeated id keeps its last row."""
    picked = rows.filter(truthy(F.col("geoname_id"))).select(
        "geoname_id", "pos", "continent_name", F.col("country_iso_code").alias("country_code"), "country_name",
        F.col("subdivision_1_iso_code").alias("country_sub_code"), F.col("subdivision_1_name").alias("country_sub_name"), "city_name")
    return _last(picked, ["geoname_id"], "pos").drop("pos")


LOCATION_FIELDS = ("continent_name", "country_code", "country_name", "country_sub_code", "country_sub_name", "city_name")


def geo_blocks(blocks: DataFrame, asn: DataFrame, places: DataFrame, custom: DataFrame | None = None,
               present: str | None = None) -> DataFrame:
    """D12 + D13 + D14: geo blocks with AS and place names, custom records on top.

    ``asn`` is an index from :func:`asn_index`, ``places`` a dimension from :func:`locations`, ``custom``
    rows use the output columns.
    """
    rows = blocks.filter(truthy(F.col("network"))).select("network", "geoname_id", "latitude", "longitude")
    rows = cidr_join(rows, "network", asn, {"as_id": "as_id"})
    rows = lookup_join(rows, places, {"geoname_id": "geoname_id"}, {f: f for f in LOCATION_FIELDS})
    out = rows.select(
        F.col("network").alias("id"), F.array_compact(F.array(cidr_struct(F.col("network")))).alias("ip_subnet"),
        F.nullif("as_id", F.lit(0)).alias("as_id"), *LOCATION_FIELDS,
        to_double(F.col("latitude").cast("string")).alias("latitude"), to_double(F.col("longitude").cast("string")).alias("longitude"))
    return out if custom is None else overlay(out, custom, "id", present)


