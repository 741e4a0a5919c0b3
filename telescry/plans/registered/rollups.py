"""Rollups, merges and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telescry.config import RollupPolicy
from telescry.entities.addresses import merge_prefixes
from telescry.functions.timing import time_bucket
from telescry.operators import ranges, rollup, snapshot
from telescry.plans import views
from telescry.plans.registered import registered
from telescry.plans.registered.flows import enriched
from telescry.plans.views import FLOW_CTE, table
from telescry.session import shared_dir
from telescry.sinks.tables import retained
from telescry.streaming.run import read_rollup, rollup_sink, run_stream


def _epoch(df: DataFrame) -> DataFrame:
    """Timestamps as epoch seconds and arrays as text, so that engines compare alike."""
    out = df.withColumn("start_epoch", F.unix_timestamp("start_time")).drop("start_time")
    return out.withColumn("policy_scope", F.array_join("policy_scope", "|"))


_DICT = """
best AS (SELECT k, v, id FROM (SELECT DISTINCT protocol AS k, application_port AS v FROM enriched) q
         JOIN app ON app.protocol = k AND v BETWEEN mn AND mx QUALIFY row_number() OVER (PARTITION BY k, v ORDER BY mn, mx, id) = 1)"""


def _edge_sql(seconds: int) -> str:
    return f"""
WITH {FLOW_CTE}, {_DICT}
SELECT CAST(epoch(start_time) AS BIGINT) // {seconds} * {seconds} AS start_epoch, 'unknown' AS policy_originator, 'tlp:green' AS policy_level, 'comm:re' AS policy_scope,
  src_as_id, src_as_ref, dst_as_id, dst_as_ref, device_id, device_ref, best.id AS application_id, in_id AS in_interface_id, in_ref AS in_interface_ref,
  in_edge AS in_interface_edge, out_id AS out_interface_id, out_ref AS out_interface_ref, out_edge AS out_interface_edge, 4 AS ip_version,
  count(*) AS flow_count, CAST(sum(bit_count) AS BIGINT) AS bit_count, CAST(sum(packet_count) AS BIGINT) AS packet_count
FROM enriched LEFT JOIN best ON best.k = protocol AND best.v = application_port WHERE in_edge OR out_edge GROUP BY ALL"""


def edge_rollup(spark: SparkSession, sf_dir: str, window: str) -> DataFrame:
    applications = ranges.dictionary_ranges(views.applications(spark, sf_dir))
    return rollup.rollup(enriched(spark, sf_dir, rollup.EDGE_AS.reads()), rollup.EDGE_AS, window, applications=applications)


@registered("e1_rollup_edge", _edge_sql(300))
def e1(spark, sf_dir):
    return _epoch(edge_rollup(spark, sf_dir, "5m"))


@registered("e1_rollup_edge_1h", _edge_sql(3600))
def e1_1h(spark, sf_dir):
    return _epoch(edge_rollup(spark, sf_dir, "1h"))


@registered("e1_rollup_edge_1d", _edge_sql(86400))
def e1_1d(spark, sf_dir):
    return _epoch(edge_rollup(spark, sf_dir, "1d"))


@registered("e2_rollup_interface", f"""
WITH {FLOW_CTE}
SELECT CAST(epoch(start_time) AS BIGINT) // 86400 * 86400 AS start_epoch, 'unknown' AS policy_originator, 'tlp:green' AS policy_level, 'comm:re' AS policy_scope, device_id, device_ref,
  in_id AS in_interface_id, in_ref AS in_interface_ref, in_edge AS in_interface_edge, out_id AS out_interface_id, out_ref AS out_interface_ref, out_edge AS out_interface_edge,
  count(*) AS flow_count, CAST(sum(bit_count) AS BIGINT) AS bit_count, CAST(sum(packet_count) AS BIGINT) AS packet_count
FROM enriched WHERE in_ref IS NOT NULL AND out_ref IS NOT NULL GROUP BY ALL""")
def e2(spark, sf_dir):
    return _epoch(rollup.rollup(enriched(spark, sf_dir, rollup.INTERFACE.reads()), rollup.INTERFACE, "1d"))


def _version_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as plain flow rows."""
    ev = table(spark, sf_dir, "events")
    return as_version_flows(ev)


def as_version_flows(ev: DataFrame) -> DataFrame:
    return ev.select(
        F.col("ts").cast("timestamp").alias("start_time"), F.col("event_type").alias("policy_originator"), F.lit("tlp:amber").alias("policy_level"),
        F.array(F.lit("a"), F.lit("b")).alias("policy_scope"), F.when(F.col("event_id") % 3 == 0, 6).otherwise(4).alias("ip_version"),
        (F.col("user_id") * 8).alias("bit_count"), F.col("event_id").alias("packet_count"))


def _version_sql(bucket: str, level: str = "tlp:green", scope: str = "comm:re") -> str:
    return f"""
SELECT {bucket} AS start_epoch, event_type AS policy_originator, '{level}' AS policy_level, '{scope}' AS policy_scope,
  CASE WHEN event_id % 3 = 0 THEN 6 ELSE 4 END AS ip_version, count(*) AS flow_count, CAST(sum(user_id * 8) AS BIGINT) AS bit_count,
  CAST(sum(event_id) AS BIGINT) AS packet_count FROM events GROUP BY ALL"""


@registered("e3_rollup_version", _version_sql("CAST(floor(epoch(ts)) AS BIGINT) // 3600 * 3600"))
def e3(spark, sf_dir):
    return _epoch(rollup.rollup(_version_flows(spark, sf_dir), rollup.IP_VERSION, "1h"))


@registered("e10_policy_override", _version_sql("CAST(floor(epoch(ts)) AS BIGINT) // 86400 * 86400", "tlp:red", "internal,restricted"))
def e10(spark, sf_dir):
    policy = RollupPolicy(level="tlp:red", scope=("internal", " restricted ", ""))
    return _epoch(rollup.rollup(_version_flows(spark, sf_dir), rollup.IP_VERSION, "1D", policy))


@registered("e10_policy_kept", _version_sql("CAST(floor(epoch(ts)) AS BIGINT) // 86400 * 86400", "tlp:amber", "a|b"))
def e10_kept(spark, sf_dir):
    return _epoch(rollup.rollup(_version_flows(spark, sf_dir), rollup.IP_VERSION, "1d", RollupPolicy(override=False)))


def _bucket(name: str, window: str, sql: str) -> None:
    @registered(name, f"SELECT CAST(epoch({sql.format(c='l_shipdate')}) AS BIGINT) AS bucket, count(*) AS n FROM lineitem GROUP BY ALL UNION ALL "
                      f"SELECT CAST(epoch({sql.format(c='ts')}) AS BIGINT), count(*) FROM events GROUP BY ALL")
    def run(spark, sf_dir):
        def counted(t, c):
            rows = table(spark, sf_dir, t).select(F.unix_timestamp(time_bucket(F.col(c), window)).alias("bucket"))
            return rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))

        return counted("lineitem", "l_shipdate").unionByName(counted("events", "ts"))


_bucket("e4_bucket_30s", "30s", "time_bucket(INTERVAL '30 seconds', {c}, TIMESTAMP '1970-01-01')")
_bucket("e4_bucket_5m", "5m", "time_bucket(INTERVAL '5 minutes', {c}, TIMESTAMP '1970-01-01')")
_bucket("e4_bucket_12h", "12h", "time_bucket(INTERVAL '12 hours', {c}, TIMESTAMP '1970-01-01')")
_bucket("e4_bucket_1d", "1d", "date_trunc('day', {c})::TIMESTAMP")
_bucket("e4_bucket_1w", "1w", "time_bucket(INTERVAL '7 days', {c}, TIMESTAMP '1970-01-05')")
_bucket("e4_bucket_3mo", "3mo", "time_bucket(INTERVAL '3 months', {c}, TIMESTAMP '1970-01-01')")
_bucket("e4_bucket_1y", "1y", "date_trunc('year', {c})::TIMESTAMP")
_bucket("e4_bucket_5y", "5y", "make_timestamp(year({c}) // 5 * 5, 1, 1, 0, 0, 0.0)")


@registered("e5_rollup_of_rollup", _version_sql("CAST(floor(epoch(ts)) AS BIGINT) // 86400 * 86400"))
def e5(spark, sf_dir):
    hourly = rollup.rollup(_version_flows(spark, sf_dir), rollup.IP_VERSION, "1h")
    return _epoch(rollup.coarser(hourly, rollup.IP_VERSION, "1d"))


@registered("e6_coalescing_merge", """
WITH e AS (SELECT user_id, CAST(floor(epoch(ts)) AS BIGINT) // 86400 AS day, ts, event_id, CASE WHEN event_type = 'click' THEN value END AS clicks,
  CASE WHEN event_type = 'error' THEN props END AS errors FROM events)
SELECT user_id, day, arg_max(clicks, ts) FILTER (WHERE clicks IS NOT NULL) AS clicks, arg_max(errors, ts) FILTER (WHERE errors IS NOT NULL) AS errors
FROM e GROUP BY user_id, day""")
def e6(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    rows = ev.select(
        "user_id", (F.unix_timestamp(F.col("ts").cast("timestamp")) / 86400).cast("bigint").alias("day"), "ts",
        F.when(F.col("event_type") == "click", F.col("value")).alias("clicks"), F.when(F.col("event_type") == "error", F.col("props")).alias("errors"))
    return snapshot.coalesce_latest(rows, ["user_id", "day"], ["clicks", "errors"], F.col("ts"))


@registered("e7_replacing_merge", """
SELECT o_custkey, o_orderstatus, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def e7(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return snapshot.keep_last(o, ["o_custkey", "o_orderstatus"], [F.col("o_orderdate"), F.col("o_orderkey")]).select(
        "o_custkey", "o_orderstatus", "o_orderkey", "o_totalprice")


@registered("e9_prefix_merge", """
WITH s AS (SELECT c_custkey AS pos, c_mktsegment AS g, 'L' || (c_custkey % 7) AS l, CASE WHEN c_custkey % 4 > 0 THEN 'K' || (c_custkey % 3) END AS k, c_name,
             unnest(['10.' || c_nationkey || '.0.0/16', '', '10.' || (c_custkey % 40) || '.0.0/16']) AS prefix, unnest([1, 2, 3]) AS p FROM customer),
n AS (SELECT prefix, 'g' AS t, g AS name, min((pos, p)) AS f FROM s WHERE prefix <> '' GROUP BY ALL
      UNION ALL SELECT prefix, 'l', l, min((pos, p)) FROM s WHERE prefix <> '' GROUP BY ALL
      UNION ALL SELECT prefix, 'k', k, min((pos, p)) FROM s WHERE prefix <> '' AND k IS NOT NULL GROUP BY ALL),
h AS (SELECT prefix, arg_min(c_name, (pos, p)) AS org FROM s WHERE prefix <> '' GROUP BY prefix)
SELECT h.prefix, h.org, coalesce(string_agg(name, ',' ORDER BY f) FILTER (WHERE t = 'g'), '') AS group_names,
  coalesce(string_agg(name, ',' ORDER BY f) FILTER (WHERE t = 'l'), '') AS labels, coalesce(string_agg(name, ',' ORDER BY f) FILTER (WHERE t = 'k'), '') AS kinds
FROM h LEFT JOIN n USING (prefix) GROUP BY h.prefix, h.org""")
def e9(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    services = c.select(
        F.col("c_custkey").alias("seq"), F.col("c_mktsegment").alias("group_name"), F.expr("concat('L', c_custkey % 7)").alias("label"),
        F.expr("CASE WHEN c_custkey % 4 > 0 THEN concat('K', c_custkey % 3) END").alias("kind"), F.struct(F.col("c_name").alias("org")).alias("org"),
        F.expr("array(concat('10.', c_nationkey, '.0.0/16'), '', concat('10.', c_custkey % 40, '.0.0/16'))").alias("prefixes"))
    out = merge_prefixes(services)
    return out.select("prefix", "org", *[F.array_join(n, ",").alias(n) for n in ("group_names", "labels", "kinds")])


@registered("e11_ext_subset", """
SELECT event_id, '{"a":' || user_id || ',"b":["' || event_type || '"]}' AS ext FROM events""")
def e11(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    text = F.concat(F.lit('{"c":1,"b":["'), "event_type", F.lit('"],"a":'), F.col("user_id").cast("string"), F.lit("}"))
    return ev.select("event_id", rollup.ext_subset(text, ["a", "b"]).alias("ext"))


@registered("j3_retention", """
SELECT event_id FROM events WHERE CAST(ts AS DATE) >= (SELECT CAST(max(ts) AS DATE) - 10 FROM events)""")
def j3(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    newest = ev.agg(F.max("ts")).scalar()
    return retained(ev, "ts", 10, newest).select("event_id")


@registered("k3_stream_rollup", _version_sql("CAST(floor(epoch(ts)) AS BIGINT) // 3600 * 3600"))
def k3(spark, sf_dir):
    """The events table as a file stream, rolled up batch by batch and read back."""
    out = shared_dir(spark, "rollup")
    schema = table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    run_stream(as_version_flows(stream), rollup_sink(rollup.IP_VERSION, "1h", out), f"{out}/checkpoint", interval=None).awaitTermination()
    return _epoch(read_rollup(spark, out, rollup.IP_VERSION, "1h"))


@registered("e8_distinct_ranges", """
SELECT DISTINCT lower(p_brand) AS key, least(p_size, p_partkey % 60) AS lo, greatest(p_size, p_partkey % 60) AS hi, p_type AS value FROM part""")
def e8(spark, sf_dir):
    df = table(spark, sf_dir, "part").withColumn("other", F.col("p_partkey") % 60)
    return ranges.range_table(df, "p_size", "other", "p_brand", "p_type")
