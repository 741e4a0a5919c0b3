"""F1-F8: versioned metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telescry.functions.text import content_hash, ext_or_default, string_array, to_double, to_flag, to_long
from telescry.operators import versioned
from telescry.operators.versioned import EntitySpec
from telescry.plans.registered import registered
from telescry.plans.views import table
from telescry.session import shared_dir
from telescry.sinks import tables as sinks
from telescry.sinks.current import read_kept, refresh, version_view

SPEC = EntitySpec("meta_customer", {"name": "text", "nationkey": "long", "cents": "long"}, required=("id", "name"))


def _records(spark: SparkSession, sf_dir: str, changed: bool) -> DataFrame:
    """customer as record JSON; with ``changed`` every 7th balance differs and every 30th id comes twice."""
    c = table(spark, sf_dir, "customer")
    cents = F.round(F.col("c_acctbal") * 100).cast("bigint")
    if changed:
        cents = cents + F.when(F.col("c_custkey") % 7 == 0, 1).otherwise(0)
    row = lambda value, text: F.to_json(F.struct(
        F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 40 != 5, F.col("c_name")).alias("name"),
        F.col("c_nationkey").cast("string").alias("nationkey"), value.alias("cents"))).alias(text)
    base = c.select((F.col("c_custkey") * 2 + 1).alias("pos"), row(cents, "row_json"))
    if not changed:
        return base
    twice = c.filter("c_custkey % 30 = 3").select((F.col("c_custkey") * 2).alias("pos"), row(F.lit(-1), "row_json"))
    return base.unionByName(twice)


def _current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First snapshot as the stored table: 9 of 10 ids, versions 1..12, some references without a version."""
    staged = versioned.last_per_id(versioned.stage(_records(spark, sf_dir, False), SPEC)).filter("id % 10 <> 0")
    ref = F.expr("CASE WHEN id % 50 = 1 THEN 'broken' ELSE concat(id, '__v', 1 + id % 12) END")
    return staged.withColumn("hash", content_hash(["id", *SPEC.content])).withColumn("ref", ref)


_BATCH = """
s AS (SELECT c_custkey AS k, c_name, c_nationkey, CAST(round(c_acctbal * 100) AS BIGINT) AS old, CAST(round(c_acctbal * 100) AS BIGINT) + CASE WHEN c_custkey % 7 = 0 THEN 1 ELSE 0 END AS cents
      FROM customer WHERE c_custkey % 40 <> 5),
h AS (SELECT *, md5('{"cents":' || cents || ',"ext":"{}","id":"' || k || '","name":"' || c_name || '","nationkey":' || c_nationkey || ',"tag":[]}') AS hash FROM s)"""


@registered("f2_hash", f"WITH {_BATCH} SELECT k::VARCHAR AS id, hash FROM h")
def f2(spark, sf_dir):
    staged = versioned.last_per_id(versioned.stage(_records(spark, sf_dir, True), SPEC))
    return staged.select("id", content_hash(["id", *SPEC.content]).alias("hash"))


@registered("f3_scd2_changes", f"""
WITH {_BATCH} SELECT k::VARCHAR AS id, CASE WHEN k % 10 = 0 THEN k || '__v1' ELSE k || '__v' || (2 + k % 12) END AS ref, hash, cents FROM h
WHERE k % 10 = 0 OR (k % 7 = 0 AND k % 50 <> 1)""")
def f3(spark, sf_dir):
    staged = versioned.stage(_records(spark, sf_dir, True), SPEC)
    return versioned.upsert_versions(staged, _current(spark, sf_dir), SPEC).select("id", "ref", "hash", "cents")


@registered("f3_bucketed_changes", f"""
WITH {_BATCH} SELECT k::VARCHAR AS id, CASE WHEN k % 10 = 0 THEN k || '__v1' ELSE k || '__v' || (2 + k % 12) END AS ref, hash, cents FROM h
WHERE k % 10 = 0 OR (k % 7 = 0 AND k % 50 <> 1)""")
def f3_bucketed(spark, sf_dir):
    """The same batch against the stored table's kept view, which is bucketed by id; older versions of each id were appended first."""
    base, stored = shared_dir(spark, "bucketed"), _current(spark, sf_dir)
    spec = sinks.metadata_table(SPEC)
    at = lambda text: F.lit(text).cast("timestamp").alias("insert_time")
    content = [F.col(c) for c in ("hash", *SPEC.content)]
    sinks.append_table(stored.select("id", F.concat("id", F.lit("__v0")).alias("ref"), *content, at("2023-01-01")), spec, base)
    sinks.append_table(stored.select("id", "ref", *content, at("2024-01-01")), spec, base)
    refresh(spark, base, version_view(SPEC))
    now = read_kept(spark, base, version_view(SPEC))
    return versioned.upsert_versions(versioned.stage(_records(spark, sf_dir, True), SPEC), now, SPEC).select("id", "ref", "hash", "cents")


@registered("f8_force", f"""
WITH {_BATCH} SELECT k::VARCHAR AS id, CASE WHEN k % 10 = 0 THEN k || '__v1' ELSE k || '__v' || (2 + k % 12) END AS ref FROM h
WHERE k % 10 = 0 OR k % 50 <> 1""")
def f8(spark, sf_dir):
    staged = versioned.stage(_records(spark, sf_dir, True), SPEC)
    return versioned.upsert_versions(staged, _current(spark, sf_dir), SPEC, force=True).select("id", "ref")


@registered("f7_unversioned", f"WITH {_BATCH} SELECT k::VARCHAR AS id, c_name AS name, c_nationkey AS nationkey, cents FROM h")
def f7(spark, sf_dir):
    spec = EntitySpec("meta_plain", SPEC.fields, SPEC.required, versioned=False)
    return versioned.upsert_versions(versioned.stage(_records(spark, sf_dir, True), spec), None, spec).drop("ext", "tag")


_TREE = EntitySpec("meta_node", {"name": "text", "up_id": "text", "peer_id": "texts"}, refs=(("up", "meta_node"),),
                   list_refs=(("peer", "meta_node"),), self_refs=("up",), self_list_refs=("peer",))


@registered("f4_self_references", """
WITH c AS (SELECT c_custkey AS k, c_custkey // 2 AS up, c_custkey % 5 <> 0 AS stored, c_custkey % 7 = 0 AS changed, [c_custkey + 1, 9000000] AS peers,
             (SELECT max(c_custkey) FROM customer) AS last FROM customer)
SELECT k::VARCHAR AS id, CASE WHEN NOT stored THEN k || '__v1' ELSE k || '__v2' END AS ref,
  up || CASE WHEN up % 5 <> 0 AND up % 7 = 0 THEN '__v2' ELSE '__v1' END AS up_ref,
  CASE WHEN k = last THEN '-' ELSE (k + 1) || CASE WHEN (k + 1) % 5 <> 0 AND (k + 1) % 7 = 0 THEN '__v2' ELSE '__v1' END END || ',-' AS peer_refs
FROM c
WHERE NOT stored OR changed
  -- unchanged records whose neighbours got a new version or were unknown before
  OR (up % 5 <> 0 AND up % 7 = 0) OR (up % 5 = 0) OR (k <> last AND ((k + 1) % 5 = 0 OR (k + 1) % 7 = 0))""")
def f4(spark, sf_dir):
    """Stored: four of five nodes with the references known at that time; every 7th name changes."""
    c = table(spark, sf_dir, "customer")
    node = lambda name: F.to_json(F.struct(
        F.col("c_custkey").alias("id"), name.alias("name"), F.expr("c_custkey div 2").alias("up_id"),
        F.array((F.col("c_custkey") + 1).cast("string"), F.lit("9000000")).alias("peer_id")))
    old = c.filter("c_custkey % 5 <> 0").select(F.col("c_custkey").alias("pos"), node(F.col("c_name")).alias("row_json"))
    stored = versioned.upsert_versions(versioned.with_refs(versioned.stage(old, _TREE), _TREE, {}), None, _TREE)
    new_name = F.when(F.col("c_custkey") % 7 == 0, F.lower("c_name")).otherwise(F.col("c_name"))
    new = c.select(F.col("c_custkey").alias("pos"), node(new_name).alias("row_json"))
    staged = versioned.with_refs(versioned.stage(new, _TREE), _TREE, {"meta_node": stored.select("id", "ref")})
    out = versioned.upsert_versions(staged, stored, _TREE)
    return out.select("id", "ref", "up_ref", F.array_join("peer_ref", ",", "-").alias("peer_refs"))


@registered("f5_coercions", r"""
WITH t AS (SELECT l_orderkey, l_linenumber, CASE l_linenumber % 8 WHEN 0 THEN l_partkey::VARCHAR WHEN 1 THEN ' ' || l_partkey || ' ' WHEN 2 THEN l_partkey || '.5'
  WHEN 3 THEN 'x' WHEN 4 THEN 'true' WHEN 5 THEN '["a","b' || l_suppkey || '"]' WHEN 6 THEN '1' END AS s, l_partkey AS p, l_suppkey AS q FROM lineitem)
SELECT l_orderkey, l_linenumber, s,
  CASE WHEN l_linenumber % 8 IN (0, 1) THEN p WHEN l_linenumber % 8 = 6 THEN 1 END AS as_long,
  CASE WHEN l_linenumber % 8 IN (0, 1) THEN p::DOUBLE WHEN l_linenumber % 8 = 2 THEN p + 0.5::DOUBLE WHEN l_linenumber % 8 = 6 THEN 1::DOUBLE END AS as_double,
  l_linenumber % 8 IN (4, 6) OR (l_linenumber % 8 = 0 AND p = 1) AS as_flag,
  CASE WHEN l_linenumber % 8 = 5 THEN 'a,b' || q ELSE '' END AS as_list,
  CASE WHEN l_linenumber % 8 = 7 THEN '{}' WHEN l_linenumber % 8 = 1 THEN p::VARCHAR ELSE s END AS as_ext FROM t""")
def f5(spark, sf_dir):
    s = F.expr("""CASE l_linenumber % 8 WHEN 0 THEN string(l_partkey) WHEN 1 THEN concat(' ', l_partkey, ' ') WHEN 2 THEN concat(l_partkey, '.5')
      WHEN 3 THEN 'x' WHEN 4 THEN 'true' WHEN 5 THEN concat('["a","b', l_suppkey, '"]') WHEN 6 THEN '1' END""")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", s.alias("s"))
    c = F.col("s")
    return li.select("l_orderkey", "l_linenumber", "s", to_long(c).alias("as_long"), to_double(c).alias("as_double"), to_flag(c).alias("as_flag"),
                     F.array_join(string_array(c), ",").alias("as_list"), ext_or_default(c).alias("as_ext"))


@registered("f6_ext_tag_defaults", """
SELECT c_custkey::VARCHAR AS id, CASE c_custkey % 3 WHEN 0 THEN '{}' WHEN 1 THEN '{"a":{"c":2,"d":[1]},"b":' || c_nationkey || '}' ELSE '{"z":1}' END AS ext,
  CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'x,y' ELSE '' END AS tag FROM customer""")
def f6(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    ext = F.expr("""CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN concat(',"ext":{"b":', c_nationkey, ',"a":{"d":[1],"c":2}},"tag":["x","y"]')
      ELSE ',"ext":"{\\\\"z\\\\":1}","tag":"not json"' END""")
    json = F.concat(F.lit('{"id":"'), F.col("c_custkey").cast("string"), F.lit('","name":"n"'), ext, F.lit("}"))
    rows = c.select(F.col("c_custkey").alias("pos"), json.alias("row_json"))
    return versioned.stage(rows, SPEC).select("id", "ext", F.array_join("tag", ",").alias("tag"))
