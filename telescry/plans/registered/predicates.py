"""A2, A8, B1-B9."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telescry.operators import predicates as P
from telescry.plans.registered import registered
from telescry.plans.views import METRIC_CTE, metric_messages, table
from telescry.sources.messages import job_rows, parse_messages, raw_archive


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as raw messages; every 50th value is broken JSON, every 51st empty."""
    ev = table(spark, sf_dir, "events")
    value = F.concat(F.lit('{"u": '), F.col("user_id").cast("string"), F.lit(', "a": "'), "event_type",
                     F.lit('", "p": '), "props", F.lit("}"))
    value = F.when(F.col("event_id") % 50 == 7, F.lit("{broken")).when(F.col("event_id") % 51 == 8, F.lit("")).otherwise(value)
    return ev.select(
        F.when(F.col("event_id") % 3 > 0, F.col("user_id").cast("string")).alias("key"), value.alias("value"),
        F.col("event_type").alias("topic"), (F.col("event_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"), F.col("ts").cast("timestamp").alias("timestamp"))


@registered("a1_parse_messages", """
SELECT event_type AS topic, event_id AS "offset", user_id AS u, event_type AS a,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
FROM events WHERE event_id % 50 <> 7 AND event_id % 51 <> 8""")
def a1(spark, sf_dir):
    good, _ = parse_messages(_messages(spark, sf_dir), "u bigint, a string, p struct<k:bigint>")
    return good.select("topic", "offset", "u", "a", F.col("p.k").alias("k"))


@registered("a1_dead_letters", """
SELECT event_type AS topic, event_id AS "offset", '{broken' AS value FROM events WHERE event_id % 50 = 7""")
def a1_dead(spark, sf_dir):
    _, dead = parse_messages(_messages(spark, sf_dir), "u bigint")
    return dead.select("topic", "offset", "value")


@registered("a2_raw_archive", """
SELECT event_type AS topic, event_id % 4 AS "partition", event_id AS "offset",
       CASE WHEN event_id % 3 > 0 THEN user_id::VARCHAR END AS key,
       '{"a":"' || event_type || '","p":{"k":' || json_extract_string(props, '$.k') || '},"u":' || user_id || '}' AS value
FROM events WHERE event_id % 50 <> 7 AND event_id % 51 <> 8""")
def a2(spark, sf_dir):
    return raw_archive(_messages(spark, sf_dir))


_LONG = "1234567890123456789012345678901234567890"


@registered("a2_number_tokens", f"""
SELECT event_id AS "offset", '{{"a":' || event_id || '.0,"b":{{"x":[{_LONG},-0.50,true,null],"y":1e3}},"c":"é"}}' AS value FROM events""")
def a2_numbers(spark, sf_dir):
    """Numbers keep their text; keys are sorted at every level."""
    ev = table(spark, sf_dir, "events")
    value = F.concat(F.lit('{ "c": "é", "b": {"y": 1e3, "x": [' + _LONG + ', -0.50, true, null]}, "a": '), F.col("event_id").cast("string"), F.lit(".0}"))
    raw = ev.select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"), F.lit(None).cast("string").alias("key"), value.alias("value"))
    return raw_archive(raw).select("offset", "value")


@registered("a8_job_rows", """
SELECT o_custkey::VARCHAR AS compute_resource_id, 'q' || o_orderkey AS jobid, o_orderpriority AS queue FROM orders
UNION ALL
SELECT o_custkey::VARCHAR, 'r' || o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F'""")
def a8(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    job = lambda kind: F.struct(F.concat(F.lit(kind), F.col("o_orderkey").cast("string")).alias("jobid"), F.col("o_orderpriority").alias("queue"))
    data = F.struct(F.array(job("q")).alias("queued"), F.when(F.col("o_orderstatus") == "F", F.array(job("r"))).alias("running"))
    payloads = o.select(F.format_string("https://api.example.org/%s/status", F.col("o_custkey")).alias("url"), data.alias("data"),
                        F.col("o_orderkey").alias("_pos"))
    return job_rows(payloads).drop("_pos")


@registered("b1_any_present", """
SELECT p_partkey FROM part WHERE nullif(p_size % 3, 0) IS NOT NULL OR nullif(p_partkey % 2, 0) IS NOT NULL""")
def b1(spark, sf_dir):
    df = table(spark, sf_dir, "part").select("p_partkey", F.struct(
        F.expr("nullif(p_size % 3, 0)").alias("a"), F.expr("nullif(p_partkey % 2, 0)").alias("b")).alias("m"))
    return df.filter(P.any_present(["m.a", "m.b"])).select("p_partkey")


@registered("b2_all_present", """
SELECT p_partkey, CASE WHEN p_size % 3 <> 0 AND p_partkey % 2 <> 0 THEN '' ELSE
  'missing ' || concat_ws(',', CASE WHEN p_size % 3 = 0 THEN 'm.a' END, CASE WHEN p_partkey % 2 = 0 THEN 'm.b' END) END AS reason
FROM part""")
def b2(spark, sf_dir):
    df = table(spark, sf_dir, "part").select("p_partkey", F.struct(
        F.expr("nullif(p_size % 3, 0)").alias("a"), F.expr("nullif(p_partkey % 2, 0)").alias("b")).alias("m"))
    ok, bad = P.split_required(df, ["m.a", "m.b"])
    return ok.select("p_partkey", F.lit("").alias("reason")).unionByName(bad.select("p_partkey", F.col("reject_reason").alias("reason")))


@registered("b4_url_route", r"""
SELECT page_id, url FROM pages
WHERE regexp_matches(rtrim(string_split(url, '?')[1], '/'), '/(en|fr)/[0-9]+$')""")
def b4(spark, sf_dir):
    return table(spark, sf_dir, "pages").filter(P.route_url("/(en|fr)/[0-9]+$")).select("page_id", "url")


@registered("b5_url_contains", """
SELECT page_id FROM pages WHERE contains(url, 'example.org') AND nullif(page_id % 4, 0) IS NOT NULL""")
def b5(spark, sf_dir):
    df = table(spark, sf_dir, "pages").select("page_id", "url", F.struct(F.expr("nullif(page_id % 4, 0)").alias("list")).alias("data"))
    return df.filter(P.route_contains("example.org", present="data.list")).select("page_id")


@registered("b6_metric_route", f"WITH {METRIC_CTE} SELECT event_id FROM msg WHERE rule = 0")
def b6(spark, sf_dir):
    df = metric_messages(spark, sf_dir).withColumn("fields", F.from_json("fields", "map<string,string>"))
    return df.filter(P.route_metric("snmp_if", ["SNMP_IF-MIB::none", "SNMP_IF-MIB::ifHCInOctets"])).select("event_id")


@registered("b8_route_counts", """
SELECT target, count(*) AS n FROM (
  SELECT 'errors' AS target FROM events WHERE event_type = 'error'
  UNION ALL SELECT 'clicks' FROM events WHERE event_type = 'click'
  UNION ALL SELECT 'large' FROM events WHERE value > 10) t GROUP BY target""")
def b8(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    routes = P.route_targets({
        "errors": P.route_type("error", "event_type"), "clicks": P.route_table("click", "event_type"), "large": F.col("value") > 10})
    return ev.select(F.explode(routes).alias("target")).groupBy("target").agg(F.count(F.lit(1)).alias("n"))
