"""The given tables written the way sources look, read back and staged."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telescry.entities import specs, status
from telescry.operators import flows, versioned
from telescry.operators.snapshot import LookupSpec
from telescry.plans.registered import registered
from telescry.plans.registered.entities import _json_rows, _refs, _status_rows
from telescry.plans.views import table
from telescry.session import shared_dir
from telescry.sources import files


def _one_file_each(df: DataFrame, path: str) -> str:
    """A text column as files of one row each."""
    df.write.option("maxRecordsPerFile", 1).text(path)
    return path


@registered("a3_json_documents", "SELECT c_custkey AS k, c_name AS name, c_acctbal AS balance FROM customer")
def a3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document (an array of records over several lines) per file."""
    c = table(spark, sf_dir, "customer")
    record = F.to_json(F.struct(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")))
    docs = c.groupBy((F.col("c_custkey") % 40).alias("g")).agg(F.array_join(F.collect_list(record), ",\n").alias("body"))
    path = _one_file_each(docs.select(F.concat(F.lit("[\n"), "body", F.lit("\n]")).alias("value")), shared_dir(spark, "documents"))
    return files.read_json_docs(spark, path, "k bigint, name string, balance double").drop("_pos")


@registered("a4_table_files", """
SELECT 'meta_' || lower(r_name) AS "table", n_nationkey::VARCHAR AS id, n_name AS name FROM nation JOIN region ON n_regionkey = r_regionkey""")
def a4(spark, sf_dir):
    """One YAML file per region, and one without a table name, which is skipped."""
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    item = F.format_string('  - {id: "%s", name: "%s"}', F.col("n_nationkey").cast("string"), "n_name")
    docs = n.groupBy("r_name").agg(F.array_join(F.collect_list(item), "\n").alias("body"))
    named = docs.select(F.concat(F.lit("table: meta_"), F.lower("r_name"), F.lit("\ndata:\n"), "body").alias("value"))
    path = _one_file_each(named.unionByName(docs.limit(1).select(F.concat(F.lit("data:\n"), "body").alias("value"))), shared_dir(spark, "tables"))
    rows = files.read_table_files(spark, path)
    return rows.select("table", F.from_json("row_json", "id string, name string").alias("r")).select("table", "r.*")


@registered("a5_csv_blocks", """
SELECT 0 AS file, '10.' || p_size || '.0.0/16' AS network, p_partkey::VARCHAR AS geoname_id, p_retailprice::VARCHAR AS latitude, NULL AS longitude FROM part
UNION ALL SELECT 1, '2001:db8::/' || (32 + s_suppkey % 9), s_suppkey::VARCHAR, NULL, s_name FROM supplier""")
def a5(spark, sf_dir):
    """Two files with other columns in another order; columns are taken by name."""
    out = shared_dir(spark, "csv")
    table(spark, sf_dir, "part").select(
        F.col("p_type").alias("unused"), F.col("p_retailprice").cast("string").alias("latitude"), F.col("p_partkey").alias("geoname_id"),
        F.format_string("10.%d.0.0/16", "p_size").alias("network")).write.option("header", True).csv(f"{out}/a")
    table(spark, sf_dir, "supplier").select(
        F.expr("concat('2001:db8::/', 32 + s_suppkey % 9)").alias("network"), F.col("s_suppkey").alias("geoname_id"), F.col("s_name").alias("longitude")
    ).write.option("header", True).csv(f"{out}/b")
    rows = files.read_csv(spark, [f"{out}/a", f"{out}/b"], files.GEO_BLOCKS)
    return rows.select("pos.file", "network", "geoname_id", "latitude", "longitude")


@registered("a6_as_registry", """
SELECT 'ASN' AS type, s_suppkey::VARCHAR AS asn, 'org' || s_nationkey AS "organizationId", s_name AS name, NULL AS country FROM supplier
UNION ALL SELECT 'Organization', NULL, 'org' || n_nationkey, n_name, 'C' || n_regionkey FROM nation""")
def a6(spark, sf_dir):
    """Gzipped JSON lines of two kinds, with blank lines."""
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    lines = s.select(F.to_json(F.struct(F.lit("ASN").alias("type"), F.col("s_suppkey").cast("string").alias("asn"), F.expr("concat('org', s_nationkey)").alias("organizationId"), F.col("s_name").alias("name"))).alias("value"))
    orgs = n.select(F.to_json(F.struct(F.lit("Organization").alias("type"), F.expr("concat('org', n_nationkey)").alias("organizationId"), F.col("n_name").alias("name"), F.expr("concat('C', n_regionkey)").alias("country"))).alias("value"))
    blank = n.select(F.lit("").alias("value"))
    path = shared_dir(spark, "registry")
    lines.unionByName(orgs).unionByName(blank).write.option("compression", "gzip").text(path)
    return files.read_as_registry(spark, path).drop("pos").filter("type is not null")


@registered("a7_net_registry", """
SELECT 'org' AS kind, n_nationkey::BIGINT AS id, n_name AS name, NULL::BIGINT AS org_id FROM nation
UNION ALL SELECT 'net', s_suppkey, s_name, s_nationkey FROM supplier""")
def a7(spark, sf_dir):
    """One nested dump, as the source publishes it."""
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    orgs = n.agg(F.collect_list(F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))).alias("orgs"))
    nets = s.agg(F.collect_list(F.struct(F.col("s_suppkey").cast("string").alias("asn"), F.col("s_nationkey").alias("org_id"), F.col("s_name").alias("name"))).alias("nets"))
    dump = orgs.join(nets).select(F.to_json(F.struct(F.struct(F.col("orgs").alias("data")).alias("org"), F.struct(F.col("nets").alias("data")).alias("net"))).alias("value"))
    org, net = files.read_net_registry(spark, _one_file_each(dump, shared_dir(spark, "dump")))
    left = org.select(F.lit("org").alias("kind"), "id", "name", F.lit(None).cast("bigint").alias("org_id"))
    return left.unionByName(net.select(F.lit("net").alias("kind"), F.col("asn").cast("bigint").alias("id"), "name", "org_id"))


@registered("a9_snapshot", """
SELECT o_custkey::VARCHAR AS id, arg_max(o_orderkey, (o_orderdate, o_orderkey)) || '__v1' AS ref, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS status FROM orders GROUP BY o_custkey""")
def a9(spark, sf_dir):
    """Latest rows of a stored table of versions."""
    o = table(spark, sf_dir, "orders")
    stamp = F.expr("timestamp_micros(unix_micros(timestamp(o_orderdate)) + o_orderkey)")  # one version per instant
    path = shared_dir(spark, "versions")
    o.select(F.col("o_custkey").cast("string").alias("id"), F.concat(F.col("o_orderkey").cast("string"), F.lit("__v1")).alias("ref"),
             F.col("o_orderstatus").alias("status"), stamp.alias("insert_time")).write.parquet(path)
    return files.snapshot(spark.read.parquet(path), LookupSpec.parse("meta_order:status")).select("id", "ref", "status")


@registered("f11_device", """
SELECT s_suppkey::VARCHAR AS id, s_suppkey || '__v1' AS ref, '10.0.' || s_nationkey || '.1,10.1.' || s_nationkey || '.1' AS loopbacks, 'm' || s_suppkey AS management,
  s_name AS hostname, 'room,rack' AS location_type, CASE WHEN s_suppkey % 3 > 0 THEN s_acctbal END AS latitude FROM supplier""")
def f11(spark, sf_dir):
    """Address lists as arrays and as JSON text; records without a type are dropped."""
    s = table(spark, sf_dir, "supplier")
    n = F.col("s_nationkey").cast("string")
    v4 = F.concat(F.lit('["10.0.'), n, F.lit('.1","10.1.'), n, F.lit('.1"]'))
    made = lambda kind: _json_rows(
        s, "s_suppkey", id=F.col("s_suppkey").cast("string"), type=kind, loopback_ip=v4, management_ip=F.array(F.concat(F.lit("m"), F.col("s_suppkey").cast("string"))),
        hostname=F.col("s_name"), location_type=F.array(F.lit("room"), F.lit("rack")), latitude=F.when(F.col("s_suppkey") % 3 == 0, F.lit("north")).otherwise(F.col("s_acctbal").cast("string")))
    rows = made(F.lit("router")).unionByName(made(F.lit(None).cast("string")))
    out = versioned.upsert_versions(versioned.stage(rows, specs.DEVICE), None, specs.DEVICE)
    return out.select("id", "ref", F.array_join("loopback_ip", ",").alias("loopbacks"), F.array_join("management_ip", ",").alias("management"), "hostname",
                      F.array_join("location_type", ",").alias("location_type"), "latitude")


@registered("f12_circuit", """
SELECT l_orderkey || '-' || l_linenumber AS id, 'device,port' AS kinds, l_suppkey || ',' || l_partkey AS ends,
  CASE WHEN l_linenumber > 1 AND EXISTS (SELECT 1 FROM lineitem p WHERE p.l_orderkey = l.l_orderkey AND p.l_linenumber = l.l_linenumber - 1 AND (p.l_orderkey + p.l_linenumber) % 5 <> 0)
    THEN l_orderkey || '-' || (l_linenumber - 1) || '__v1' END AS parent_circuit_ref
FROM (SELECT DISTINCT ON (l_orderkey, l_linenumber) * FROM lineitem ORDER BY l_orderkey, l_linenumber, l_partkey DESC, l_suppkey DESC) l
WHERE (l_orderkey + l_linenumber) % 5 <> 0""")
def f12(spark, sf_dir):
    """Lines as circuits whose parent is the line before; endpoints that are no pair drop the record."""
    li = table(spark, sf_dir, "lineitem")
    own = F.expr("concat(l_orderkey, '-', l_linenumber)")
    text = lambda c: F.col(c).cast("string")
    ends = F.when(F.expr("(l_orderkey + l_linenumber) % 5 = 0"), F.array(text("l_suppkey"))).otherwise(F.array(text("l_suppkey"), text("l_partkey")))
    rows = li.select(
        F.struct("l_partkey", "l_suppkey").alias("pos"),
        F.to_json(F.struct(own.alias("id"), F.array(F.lit("device"), F.lit("port")).alias("endpoint_type"), ends.alias("endpoint_id"),
                           F.expr("CASE WHEN l_linenumber > 1 THEN concat(l_orderkey, '-', l_linenumber - 1) END").alias("parent_circuit_id"))).alias("row_json"))
    out = versioned.upsert_versions(versioned.with_refs(versioned.stage(rows, specs.CIRCUIT), specs.CIRCUIT, {}), None, specs.CIRCUIT)
    return out.select("id", F.array_join("endpoint_type", ",").alias("kinds"), F.array_join("endpoint_id", ",").alias("ends"), "parent_circuit_ref")


@registered("f14_autonomous_system", """
SELECT s_suppkey AS id, s_suppkey || '__v1' AS ref, s_name AS name, CASE WHEN s_nationkey < 20 THEN 'n' || s_nationkey || '__v1' END AS organization_ref FROM supplier""")
def f14(spark, sf_dir):
    """Organizations resolve for the first twenty nations; an id that is no number is dropped."""
    s = table(spark, sf_dir, "supplier")
    rows = _json_rows(s, "s_suppkey", id=F.col("s_suppkey"), name=F.col("s_name"), organization_id=F.expr("concat('n', s_nationkey)"))
    bad = _json_rows(s, "s_suppkey", id=F.expr("concat('AS', s_suppkey)"), name=F.col("s_name"), organization_id=F.lit("n"))
    orgs = _refs(table(spark, sf_dir, "nation").select(F.expr("CASE WHEN n_nationkey < 20 THEN concat('n', n_nationkey) ELSE concat('other', n_nationkey) END").alias("k")), "k")
    staged = versioned.stage(rows.unionByName(bad), specs.AUTONOMOUS_SYSTEM)
    out = versioned.apply_batch(staged, None, specs.AUTONOMOUS_SYSTEM, {"meta_organization": orgs}, F.lit("2024-01-01").cast("timestamp"))
    return out.select("id", "ref", "name", "organization_ref")


@registered("f16_application", "SELECT p_partkey::VARCHAR AS id, p_brand AS protocol, p_size AS port_range_min, p_size + 10 AS port_range_max FROM part WHERE p_partkey % 6 > 0")
def f16(spark, sf_dir):
    """Ports as numbers and as text; records without an upper bound are dropped."""
    p = table(spark, sf_dir, "part")
    rows = _json_rows(p, "p_partkey", id=F.col("p_partkey"), protocol=F.col("p_brand"), port_range_min=F.col("p_size").cast("string"),
                      port_range_max=F.when(F.col("p_partkey") % 6 > 0, F.col("p_size") + 10))
    out = versioned.upsert_versions(versioned.stage(rows, specs.APPLICATION), None, specs.APPLICATION)
    return out.select("id", "protocol", "port_range_min", "port_range_max")


_STAMP = "CAST(epoch(o_orderdate) AS BIGINT)"


def _stamp():
    return F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")


@registered("f22_facilities", f"""
SELECT o_orderkey::VARCHAR AS id, CASE WHEN o_custkey % 4 > 0 THEN {_STAMP} END AS modified_epoch, o_orderpriority AS short_name FROM orders WHERE o_orderkey % 9 > 0""")
def f22_facilities(spark, sf_dir):
    """A bad time becomes null; a missing address drops the record."""
    o = table(spark, sf_dir, "orders")
    rows = _status_rows(o, "o_orderkey", id=F.col("o_orderkey"), self_uri=F.when(F.col("o_orderkey") % 9 > 0, F.lit("u")),
                        last_modified=F.when(F.col("o_custkey") % 4 > 0, _stamp()).otherwise(F.lit("later")), short_name=F.col("o_orderpriority"))
    return status.stage_facilities(rows).select("id", F.unix_timestamp("last_modified").alias("modified_epoch"), "short_name")


@registered("f22_sites", """
SELECT o_orderkey::VARCHAR AS id, CASE WHEN c_nationkey IS NOT NULL THEN 'f' || c_nationkey END AS facility_id, CASE WHEN c_nationkey < 12 THEN 'f' || c_nationkey || '__v1' END AS facility_ref
FROM orders LEFT JOIN customer ON c_custkey = o_custkey""")
def f22_sites(spark, sf_dir):
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    rows = _status_rows(o, "o_orderkey", id=F.col("o_orderkey"), self_uri=F.lit("u"), last_modified=_stamp())
    owner = o.join(c, F.col("o_custkey") == F.col("c_custkey")).select(F.col("o_orderkey").cast("string").alias("key"), F.expr("concat('f', c_nationkey)").alias("value"))
    known = table(spark, sf_dir, "nation").select(F.expr("CASE WHEN n_nationkey < 12 THEN concat('f', n_nationkey) ELSE concat('g', n_nationkey) END").alias("k"))
    staged = versioned.with_refs(status.stage_sites(rows, owner), specs.SITE, {"meta_iri_facility": _refs(known, "k")})
    return versioned.upsert_versions(staged, None, specs.SITE).select("id", "facility_id", "facility_ref")


@registered("f22_events", f"""
SELECT o_orderkey::VARCHAR AS id, o_custkey::VARCHAR AS resource_id, 'i' || (o_orderkey % 7) AS incident_id, {_STAMP} AS occurred_epoch, 'i' || (o_orderkey % 7) || '__v1' AS incident_ref
FROM orders""")
def f22_events(spark, sf_dir):
    """Ids are the last segments of addresses, whatever slashes follow."""
    o = table(spark, sf_dir, "orders")
    rows = _status_rows(
        o, "o_orderkey", id=F.col("o_orderkey"), self_uri=F.lit("u"), last_modified=_stamp(), status=F.lit("up"), occurred_at=_stamp(),
        resource_uri=F.expr("concat('https://api.example.org/resources/', o_custkey, '//')"), incident_uri=F.expr("concat('https://api.example.org/incidents/i', o_orderkey % 7)"))
    incidents = _refs(o.select(F.expr("concat('i', o_orderkey % 7)").alias("k")).distinct(), "k")
    staged = versioned.with_refs(status.stage_events(rows), specs.EVENT, {"meta_iri_incident": incidents})
    return versioned.upsert_versions(staged, None, specs.EVENT).select("id", "resource_id", "incident_id", F.unix_timestamp("occurred_at_time").alias("occurred_epoch"), "incident_ref")


@registered("g8_vlan_ids", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_linenumber % 3 > 0 THEN l_partkey % 4096 END AS vlan_id, l_suppkey % 4096 AS vlan_in_id, l_orderkey % 4096 AS vlan_out_id,
  CASE WHEN l_linenumber % 2 = 0 THEN l_linenumber END AS vlan_in_inner_id, NULL::BIGINT AS vlan_out_inner_id FROM lineitem""")
def g8(spark, sf_dir):
    """Five fields as text; bad and missing ones become null."""
    li = table(spark, sf_dir, "lineitem")
    wire = li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.expr("CASE WHEN l_linenumber % 3 > 0 THEN string(l_partkey % 4096) ELSE 'trunk' END").alias("vlan"),
        F.expr("string(l_suppkey % 4096)").alias("vlan_in"), F.expr("string(l_orderkey % 4096)").alias("vlan_out"), F.expr("CASE WHEN l_linenumber % 2 = 0 THEN string(l_linenumber) END").alias("cvlan_in"))
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    whole = wire.select(*keys, *[(F.col(c) if c in wire.columns else F.lit(None).cast("string")).alias(c) for c in flows.WIRE_TEXT])
    return flows.ext_fields(whole).select(*keys, "vlan_id", "vlan_in_id", "vlan_out_id", "vlan_in_inner_id", F.col("vlan_out_inner_id").cast("bigint"))
