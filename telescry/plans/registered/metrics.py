"""Counters and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telescry.config import MetricConfig
from telescry.functions import snmp
from telescry.functions.text import duration_seconds
from telescry.functions.timing import interval_floor
from telescry.operators import keyed, metrics
from telescry.plans import views
from telescry.plans.registered import registered
from telescry.plans.views import METRIC_CTE, table

AS_OF = "2024-02-01 00:00:00"


def rules() -> metrics.Rules:
    return metrics.Rules.parse(views.RULES)


def kv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index lookups of the same messages, plus references for named interfaces, every second one under another name."""
    names = keyed.index_lookup(metrics.tokens(views.metric_messages(spark, sf_dir)), rules().by_name).distinct()
    ids = names.select(F.concat_ws("::", F.substring_index("key", "::", 1), "value").alias("key")).distinct()
    ids = ids.withColumn("key", F.when(F.length("key") % 2 == 0, F.col("key")).otherwise(F.concat(F.lit("-"), "key")))
    refs = ids.select(F.lit("meta_interface").alias("table"), "key", F.concat("key", F.lit("__v3")).alias("value"))
    return names.unionByName(refs)


_REFS = """refs AS (SELECT DISTINCT device || '::' || value AS id FROM (SELECT string_split(key, '::')[1] AS device, value FROM kv) t
  WHERE length(device || '::' || value) % 2 = 0)"""


@registered("h1_interface_traffic", f"""
WITH {METRIC_CTE}, {_REFS}
SELECT t // 300 * 300 AS start_epoch, t // 300 * 300 + 300 AS end_epoch, 'unknown' AS collector_id, device || '::' || kv.value AS interface_id,
  refs.id || '__v3' AS interface_ref,
  CASE event_id % 5 WHEN 1 THEN 'up' WHEN 2 THEN 'down' WHEN 3 THEN 'testing' ELSE (event_id % 5)::VARCHAR END AS admin_status,
  event_id * 8000 AS in_bit_count
FROM msg JOIN kv ON kv.key = device || '::' || idx LEFT JOIN refs ON refs.id = device || '::' || kv.value WHERE rule = 0""")
def h1(spark, sf_dir):
    pairs = kv(spark, sf_dir)
    out = metrics.interface_traffic(views.metric_messages(spark, sf_dir), keyed.kv_table(pairs, "ifindex_to_ifname"), keyed.kv_table(pairs, "meta_interface"))
    return out.select(F.unix_timestamp("start_time").alias("start_epoch"), F.unix_timestamp("end_time").alias("end_epoch"), "collector_id", "interface_id",
                      "interface_ref", "admin_status", F.col("in_bit_count").cast("bigint").alias("in_bit_count"))


@registered("h2_interval_floor", """
SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS t, CASE WHEN user_id % 4 = 0 THEN CAST(floor(epoch(ts)) AS BIGINT)
  ELSE CAST(floor(epoch(ts)) AS BIGINT) // (user_id % 4 * 60) * (user_id % 4 * 60) END AS floored FROM events""")
def h2(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", F.unix_timestamp(F.col("ts").cast("timestamp")).alias("t"))
    return ev.select("event_id", "t", interval_floor(F.col("t"), F.col("user_id") % 4 * 60).alias("floored"))


@registered("h3_scaling", """
SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE (18446744073709551 + event_id)::HUGEINT * 8 END::VARCHAR AS bits FROM events""")
def h3(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    text = F.expr("CASE WHEN event_id % 5 = 0 THEN 'n/a' ELSE string(18446744073709551 + event_id) END")
    return ev.select("event_id", metrics.scaled(text, 8).cast("string").alias("bits"))


@registered("h4_status_enum", """
SELECT event_id, CASE event_id % 10 WHEN 1 THEN 'up' WHEN 2 THEN 'down' WHEN 3 THEN 'testing' WHEN 4 THEN 'unknown' WHEN 5 THEN 'dormant'
  WHEN 6 THEN 'notPresent' WHEN 7 THEN 'lowerLayerDown' ELSE (event_id % 10)::VARCHAR END AS oper,
  CASE event_id % 10 WHEN 1 THEN 'up' WHEN 2 THEN 'down' WHEN 3 THEN 'testing' ELSE (event_id % 10)::VARCHAR END AS admin FROM events""")
def h4(spark, sf_dir):
    code = (F.col("event_id") % 10).cast("string")
    return table(spark, sf_dir, "events").select(
        "event_id", metrics.status_name(code, metrics.OPER_STATUS).alias("oper"), metrics.status_name(code, metrics.ADMIN_STATUS).alias("admin"))


@registered("h5_metric_melt", f"""
WITH {METRIC_CTE}, {_REFS},
long AS (
  SELECT *, 'gauge' AS metric_name, CAST(CAST(value AS DECIMAL(20,3)) AS DOUBLE) AS g, NULL::BIGINT AS c, NULL::VARCHAR AS txt FROM resolved
  UNION ALL SELECT *, 'counter', NULL, k::BIGINT, NULL FROM resolved WHERE k IS NOT NULL
  UNION ALL SELECT *, 'flag', NULL, CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END, NULL FROM resolved
  UNION ALL SELECT *, 'state', NULL, 1, event_type FROM resolved
  UNION ALL SELECT *, 'SNMP_IF-MIB::ifHCInOctets', NULL, event_id * 1000, NULL FROM resolved
  UNION ALL SELECT *, 'SNMP_IF-MIB::ifAdminStatus', NULL, event_id % 5, NULL FROM resolved
  UNION ALL SELECT *, 'SNMP_IF-MIB::ifName', NULL, 1, 'eth' || (user_id % 40) FROM resolved)
SELECT 'data_' || CASE WHEN rule = 3 THEN 'chassis_part' ELSE 'interface' END || CASE WHEN metric_name = 'gauge' THEN '_gauge' ELSE '_counter' END AS target_table,
  t AS epoch, long.id, CASE WHEN rule IN (0, 1) AND refs.id IS NOT NULL THEN long.id || '__v3' END AS ref, metric_name, g AS metric_gauge, c AS metric_counter,
  queue_num, CASE WHEN rule <> 3 THEN site END AS site, device || '.example.com' AS device, txt AS metric_value
FROM long LEFT JOIN refs ON refs.id = long.id""")
def h5(spark, sf_dir):
    out = metrics.melt_metrics(views.metric_messages(spark, sf_dir), rules(), kv(spark, sf_dir))
    ext = F.from_json("ext", "map<string,string>")
    return out.select(
        "target_table", F.unix_timestamp("observation_time").alias("epoch"), "id", "ref", "metric_name", "metric_gauge",
        F.col("metric_counter").cast("bigint").alias("metric_counter"),
        *[F.element_at(ext, k).alias(k) for k in ("queue_num", "site", "device", "metric_value")])


@registered("h6_resource_id", f"WITH {METRIC_CTE} SELECT event_id, id FROM resolved")
def h6(spark, sf_dir):
    rows = metrics.tokens(views.metric_messages(spark, sf_dir))
    return metrics.with_resource_id(rows, rules(), kv(spark, sf_dir)).select("event_id", F.col("resource_id").alias("id"))


@registered("h7_formats", """
SELECT l_orderkey, l_linenumber, 'core' || l_suppkey AS host, CASE WHEN l_linenumber % 3 = 0 THEN 'plain' ELSE l_partkey::VARCHAR END AS part,
  CASE WHEN l_linenumber % 3 <> 0 THEN 'q' || l_suppkey END AS queue_name FROM lineitem""")
def h7(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    raw = F.expr("CASE WHEN l_linenumber % 3 = 0 THEN 'plain' ELSE concat('7.', l_partkey, '/q', l_suppkey, '.tail') END")
    part, extra = metrics.formatted(raw, {"format": "regex", "format_opts": {"pattern": r"\d\.(?P<value>\d+)/(?P<queue_name>q\d+)"}})
    host, _ = metrics.formatted(F.concat(F.lit("core"), F.col("l_suppkey").cast("string"), F.lit(".example.net")), {"format": "short_hostname"})
    return li.select("l_orderkey", "l_linenumber", host.alias("host"), part.alias("part"), extra["queue_name"].alias("queue_name"))


_PORT = """CASE WHEN x = 503316480 THEN NULL
  WHEN (x >> 29) & 7 = 0 THEN ((x >> 25) & 15) || '/' || ((x >> 21) & 15) || '/' || ((x >> 15) & 63)
  WHEN (x >> 29) & 7 = 1 THEN ((x >> 25) & 15) || '/' || ((x >> 21) & 15) || '/' || ((x >> 15) & 63) || '.' || (x & 32767)
  WHEN (x >> 29) & 7 = 2 AND (x >> 28) & 1 = 0 THEN 'virtual-' || (x & 511)
  WHEN (x >> 29) & 7 = 2 THEN 'lag-' || (x & 255)
  WHEN (x >> 29) & 7 = 3 THEN ((x >> 18) & 31) || '/' || ((x >> 14) & 15) || '/c' || ((x >> 6) & 63) || '/' || (x & 63) END"""


@registered("h8_port_decode", f"""
WITH r AS (SELECT DISTINCT CASE WHEN l_orderkey % 100 = 0 THEN 503316480 ELSE l_orderkey * 7919777 % 4294967296 END AS x,
             l_linenumber % 3 AS kind, l_suppkey % 5 AS q FROM lineitem),
d AS (SELECT DISTINCT CASE kind WHEN 0 THEN x::VARCHAR WHEN 1 THEN '12.' || x || '.4095' ELSE '12.' || x || '.4095.' || q END AS raw_index, kind, {_PORT} AS port,
        CASE kind WHEN 2 THEN q END AS q FROM r)
SELECT raw_index, CASE WHEN kind = 0 THEN port ELSE '12-' || port || '-4095' END AS name, CASE WHEN port IS NOT NULL THEN q::VARCHAR END AS queue_num FROM d""")
def h8(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    x = F.expr("string(CASE WHEN l_orderkey % 100 = 0 THEN 503316480 ELSE l_orderkey * 7919777 % 4294967296 END)")
    raw = F.when(F.col("l_linenumber") % 3 == 0, x).when(F.col("l_linenumber") % 3 == 1, F.concat(F.lit("12."), x, F.lit(".4095"))).otherwise(
        F.concat(F.lit("12."), x, F.lit(".4095."), (F.col("l_suppkey") % 5).cast("string")))
    return metrics.port_index_dim(li.select(raw.alias("raw")), "raw")


@registered("h9_address_index", """
WITH r AS (SELECT DISTINCT l_suppkey % 256 AS a, l_linenumber AS b, l_linenumber % 4 AS kind FROM lineitem)
SELECT DISTINCT CASE kind WHEN 0 THEN '1.4.198.18.' || a || '.' || b WHEN 1 THEN '2.16.32.1.13.184.0.7.0.' || a || '.0.0.0.0.0.0.0.' || b
  WHEN 2 THEN '3.4.198.18.' || a || '.' || b ELSE '1.4.10.' || a END AS raw_index,
  CASE kind WHEN 0 THEN '198.18.' || a || '.' || b WHEN 1 THEN '2001:0db8:0007:00' || lpad(lower(hex(a)), 2, '0') || ':0000:0000:0000:000' || b END AS address
FROM r""")
def h9(spark, sf_dir):
    raw = F.expr("""CASE l_linenumber % 4 WHEN 0 THEN concat('1.4.198.18.', l_suppkey % 256, '.', l_linenumber)
      WHEN 1 THEN concat('2.16.32.1.13.184.0.7.0.', l_suppkey % 256, '.0.0.0.0.0.0.0.', l_linenumber)
      WHEN 2 THEN concat('3.4.198.18.', l_suppkey % 256, '.', l_linenumber) ELSE concat('1.4.10.', l_suppkey % 256) END""")
    return metrics.address_index_dim(table(spark, sf_dir, "lineitem").select(raw.alias("raw")), "raw")


@registered("h10_tags", f"""
WITH {METRIC_CTE} SELECT event_id, queue_num, CASE WHEN rule <> 3 THEN site END AS site, CASE WHEN queue_num IS NULL THEN 3 ELSE 4 END + CASE WHEN rule = 3 THEN 0 ELSE 1 END AS n
FROM resolved""")
def h10(spark, sf_dir):
    rows = metrics.with_resource_id(metrics.tokens(views.metric_messages(spark, sf_dir)), rules(), None)
    rows = rows.withColumn("ext", metrics.tags_ext(rules()))
    return rows.select("event_id", F.element_at("ext", "queue_num").alias("queue_num"), F.element_at("ext", "site").alias("site"),
                       F.size("ext").cast("bigint").alias("n"))


@registered("h11_named_traffic", """
SELECT CAST(floor(epoch(ts)) AS BIGINT) AS start_epoch, CAST(floor(epoch(ts)) AS BIGINT) + 30 AS end_epoch,
  CASE user_id % 3 WHEN 0 THEN 'a' || user_id WHEN 1 THEN 'b' ELSE 'unknown' END AS collector_id, 'dev::if' || user_id AS interface_id,
  CASE WHEN user_id % 2 = 0 THEN 'dev::if' || user_id || '__v1' END AS interface_ref, event_id AS in_bit_count,
  CASE WHEN event_type = 'error' THEN 'down' END AS oper_status FROM events WHERE user_id % 10 <> 9""")
def h11(spark, sf_dir):
    rows, refs = named_messages(spark, sf_dir)
    out = metrics.project_interface_traffic(rows, refs)
    return out.select(F.unix_timestamp("start_time").alias("start_epoch"), F.unix_timestamp("end_time").alias("end_epoch"), "collector_id", "interface_id",
                      "interface_ref", F.col("in_bit_count").cast("bigint").alias("in_bit_count"), "oper_status")


def named_messages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """events as messages that name their interface, and the references of every second one."""
    ev = table(spark, sf_dir, "events")
    iface = F.concat(F.lit("dev::if"), F.col("user_id").cast("string"))
    null = F.lit(None).cast("string")
    wanted = {"in_bits": F.when(F.col("user_id") % 10 != 9, F.col("event_id").cast("string")),
              "oper_state": F.when((F.col("event_type") == "error") & (F.col("user_id") % 10 != 9), F.lit("down"))}
    names = sorted({*metrics.NAMED_FIELDS.values(), "in_pkts", "out_pkts"})
    values = F.struct(*[F.struct(wanted.get(n, null).alias("val")).alias(n) for n in names])
    sensor = F.expr("CASE user_id % 3 WHEN 0 THEN concat('[\"a', user_id, '\",\"z\"]') WHEN 1 THEN 'b' END")
    start = F.date_format(F.date_trunc("second", F.col("ts").cast("timestamp")), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    rows = ev.select(
        start.alias("start"), F.struct(iface.alias("id"), null.alias("name"), F.lit("dev").alias("device"), sensor.alias("sensor_id")).alias("meta"),
        F.struct(F.lit("o").alias("originator"), F.lit("l").alias("level"), F.lit(None).cast("array<string>").alias("scopes")).alias("policy"),
        values.alias("values"))
    refs = ev.select(F.when(F.col("user_id") % 2 == 0, iface).otherwise(F.concat(F.lit("-"), iface)).alias("key"), F.concat(iface, F.lit("__v1")).alias("value")).distinct()
    return rows, refs


@registered("h12_status_metrics", """
WITH r AS (SELECT 'r' || event_id AS id, CASE event_id % 5 WHEN 0 THEN 'UP' WHEN 1 THEN 'degraded' WHEN 2 THEN 'Down' WHEN 3 THEN 'unknown' ELSE event_type END AS s,
             CAST(floor(epoch(ts)) AS BIGINT) AS t, event_id FROM events)
SELECT id, 'status' AS metric_name, CASE event_id % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 ELSE 4 END AS metric_value, '{"status_str":"' || s || '"}' AS ext,
  CASE WHEN event_id % 2 = 0 THEN id || '__v1' END AS ref FROM r
UNION ALL SELECT id, 'last_modified', t, '{"last_modified_str":"' || strftime(make_timestamp(t * 1000000), '%Y-%m-%dT%H:%M:%SZ') || '"}',
  CASE WHEN event_id % 2 = 0 THEN id || '__v1' END FROM r WHERE event_id % 7 <> 0""")
def h12(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    rid = F.concat(F.lit("r"), F.col("event_id").cast("string"))
    status = F.expr("CASE event_id % 5 WHEN 0 THEN 'UP' WHEN 1 THEN 'degraded' WHEN 2 THEN 'Down' WHEN 3 THEN 'unknown' ELSE event_type END")
    stamp = F.date_format(F.date_trunc("second", F.col("ts").cast("timestamp")), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    rows = ev.select(rid.alias("id"), status.alias("current_status"), F.when(F.col("event_id") % 7 == 0, F.lit("soon")).otherwise(stamp).alias("last_modified"))
    refs = ev.select(F.when(F.col("event_id") % 2 == 0, rid).otherwise(F.concat(F.lit("-"), rid)).alias("id"), F.concat(rid, F.lit("__v1")).alias("ref"))
    return metrics.status_metrics(rows, refs, F.lit(AS_OF).cast("timestamp")).select("id", "metric_name", "metric_value", "ext", "ref")


@registered("h13_duration_parse", """
WITH t AS (SELECT o_orderkey, o_orderkey % 4 AS kind, o_custkey % 24 AS h, o_orderkey % 60 AS m, o_custkey % 60 AS s, o_custkey % 9 AS d FROM orders)
SELECT 'j' || o_orderkey AS id, 'runtime_secs' AS metric_name, (CASE kind WHEN 0 THEN h * 3600 + m * 60 + s ELSE d * 86400 + h * 3600 + m * 60 + s END)::DOUBLE AS metric_value
FROM t WHERE kind IN (0, 1)
UNION ALL SELECT 'j' || o_orderkey, 'score', m + 0.5 FROM t WHERE kind <> 3""")
def h13(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    hms = F.expr("concat(o_custkey % 24, ':', lpad(o_orderkey % 60, 2, '0'), ':', o_custkey % 60)")
    text = F.expr("o_orderkey % 4")
    run = F.when(text == 0, hms).when(text == 1, F.concat((F.col("o_custkey") % 9).cast("string"), F.lit(":"), hms)).when(text == 2, F.lit("1:xx:3")).otherwise(F.lit("12:30"))
    rows = o.select(F.concat(F.lit("j"), F.col("o_orderkey").cast("string")).alias("jobid"), run.alias("runtimef"), F.lit(None).cast("string").alias("queuedtimef"),
                    F.when(text != 3, F.expr("o_orderkey % 60") + F.lit(0.5)).alias("score"))
    return metrics.job_metrics(rows, None, F.lit(AS_OF).cast("timestamp"), cfg=MetricConfig()).select("id", "metric_name", "metric_value")


__all__ = ["duration_seconds", "kv", "rules", "snmp"]
