"""Tables and key-value entries that are written, by several writers, and read back."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telescry.functions.net import ipv4_text
from telescry.functions.text import short_hostname
from telescry.operators import keyed, rollup
from telescry.plans import jobs, views
from telescry.plans.registered import registered
from telescry.plans.registered.metrics import rules as metric_rules
from telescry.plans.registered.rollups import _epoch, _version_sql, as_version_flows
from telescry.plans.views import table
from telescry.session import shared_dir
from telescry.sinks import tables as sinks
from telescry.sinks.current import latest_version_view, pointer, read_kept, refresh, write_generation
from telescry.sinks.statistics import STATISTICS
from telescry.sinks.tables import Batch
from telescry.streaming.run import compact_rollup, read_rollup, rollup_sink, run_stream
from telescry.streaming.state import keyed_state, run_once

EVENTS = sinks.TableSpec("events_by_day", ("event_id", "ts", "user_id", "event_type"), "ts", ("user_id", "ts"), 10)


@registered("j1_append_retry", "SELECT event_id, user_id, event_type, CAST(ts AS DATE)::VARCHAR AS day FROM events")
def j1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that broke off and is repeated, a second stream with the same batch number, and a batch job."""
    ev, base = table(spark, sf_dir, "events"), shared_dir(spark, "append")
    part = lambda k: ev.filter(F.col("event_id") % 3 == k)
    sinks.append_table(part(0).filter("user_id % 2 = 0"), EVENTS, base, Batch("first", 0))
    sinks.append_table(part(0), EVENTS, base, Batch("first", 0))
    sinks.append_table(part(1), EVENTS, base, Batch("second", 0))
    sinks.append_table(part(2), EVENTS, base)
    return sinks.read_table(spark, base, EVENTS.name).select("event_id", "user_id", "event_type", F.col("dt").cast("string").alias("day"))


@registered("j4_clustered_read", """
WITH u AS (SELECT user_id, max(ts) AS newest FROM events WHERE user_id = (SELECT max(user_id) FROM events) GROUP BY user_id)
SELECT event_id, e.user_id, event_type, CAST(ts AS DATE)::VARCHAR AS day FROM events e JOIN u ON e.user_id = u.user_id
WHERE ts > newest - INTERVAL 24 HOUR""")
def j4(spark, sf_dir):
    """A day of one user from a table clustered by day, user and time."""
    ev, base = table(spark, sf_dir, "events"), shared_dir(spark, "clustered")
    sinks.append_table(ev, EVENTS, base, rows_per_file=1_000_000)
    stored = sinks.read_table(spark, base, EVENTS.name)
    user, newest = stored.groupBy("user_id").agg(F.max("ts")).orderBy(F.desc_nulls_last("user_id")).first() or (None, None)
    newest = newest or datetime(1970, 1, 1)
    day = timedelta(days=1)
    rows = stored.filter((F.col("user_id") == F.lit(user)) & (F.col("ts") > F.lit(newest - day)) & (F.col("dt") >= F.lit((newest - day).date())))
    return rows.select("event_id", "user_id", "event_type", F.col("dt").cast("string").alias("day"))


@registered("j3_day_retention", """
SELECT event_id FROM events WHERE CAST(ts AS DATE) >= (SELECT CAST(max(ts) AS DATE) - 10 FROM events)""")
def j3_days(spark, sf_dir):
    """Whole days dropped from a written table."""
    ev, base = table(spark, sf_dir, "events"), shared_dir(spark, "retention")
    sinks.append_table(ev, EVENTS, base, Batch("stream", 0))
    sinks.apply_retention(spark, EVENTS, base, ev.agg(F.max("ts")).first()[0])
    return sinks.read_table(spark, base, EVENTS.name).select("event_id")


@registered("j5_kv_upsert", """
WITH job AS (SELECT o_custkey AS k, arg_max(o_orderkey::VARCHAR, (o_orderdate, o_orderkey)) AS v FROM orders GROUP BY o_custkey)
SELECT coalesce(k, c_custkey)::VARCHAR AS key, CASE WHEN c_custkey IS NOT NULL AND (c_custkey % 3 > 0 OR k IS NULL) THEN c_name ELSE v END AS value
FROM job FULL JOIN customer ON c_custkey = k""")
def j5(spark, sf_dir):
    """Entries of a batch job and of a stream in one table; the stream's are newer for two of three keys, and a repeat changes nothing."""
    o, c, base = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"), shared_dir(spark, "kv")
    at = lambda text: F.lit(text).cast("timestamp")
    loaded = o.select(F.lit("t").alias("table"), F.col("o_custkey").cast("string").alias("key"), F.col("o_orderkey").alias("value"),
                      F.struct(F.col("o_orderdate").cast("timestamp").alias("at"), F.lit(0).alias("partition"), F.col("o_orderkey").alias("offset")).cast(keyed.ORDER_SCHEMA).alias("seq"))
    sinks.write_kv(keyed.kv_rows(loaded, at("2024-01-01"), None, F.col("seq")), base)
    stamp = F.when(F.col("c_custkey") % 3 > 0, at("2024-01-02")).otherwise(at("2023-12-31"))
    live = c.select(F.lit("t").alias("table"), F.col("c_custkey").cast("string").alias("key"), F.col("c_name").alias("value"), stamp.alias("stamp"))
    for _ in range(2):
        sinks.write_kv(live.transform(lambda d: keyed.kv_rows(d.withColumn("key", F.col("key")), F.col("stamp"))), base, batch=Batch("stream", 0))
    return keyed.kv_table(keyed.kv_view(sinks.read_table(spark, base, "kv")), "t")


@registered("j5_kv_compacted", """
SELECT o_custkey::VARCHAR AS key, arg_max(o_orderkey::VARCHAR, (o_orderdate, o_orderkey)) AS value FROM orders GROUP BY o_custkey
HAVING max(o_orderdate) > (SELECT max(o_orderdate) FROM orders) - INTERVAL 400 DAY""")
def j5_compacted(spark, sf_dir):
    """Expired entries and the history go, twice over; the newest live entries stay."""
    o, base = table(spark, sf_dir, "orders"), shared_dir(spark, "kv")
    rows = o.select(F.lit("t").alias("table"), F.col("o_custkey").cast("string").alias("key"), F.col("o_orderkey").alias("value"), F.col("o_orderdate").cast("timestamp").alias("at"), "o_orderkey")
    order = F.struct("at", F.lit(0).alias("partition"), F.col("o_orderkey").alias("offset")).cast(keyed.ORDER_SCHEMA)
    sinks.write_kv(keyed.kv_rows(rows, F.col("at"), 400 * 86400, order), base, batch=Batch("stream", 3))
    now = F.lit(o.agg(F.max("o_orderdate")).first()[0]).cast("timestamp")
    for generation in (1, 2):
        sinks.compact_kv(spark, keyed.kv_view(sinks.read_table(spark, base, "kv"), now), base, "kv", generation)
    return keyed.kv_table(sinks.read_table(spark, base, "kv"), "t")


@registered("c5_kv_newest", """
SELECT 'meta_order:customer' AS "table", o_custkey::VARCHAR AS key, arg_max(o_orderkey::VARCHAR, (o_orderdate, o_orderkey::VARCHAR)) AS value FROM orders GROUP BY o_custkey""")
def c5_newest(spark, sf_dir):
    """Records that share a key: the job writes the newest record, not the greatest value."""
    o, base = table(spark, sf_dir, "orders"), shared_dir(spark, "kv")
    text = F.col("o_orderkey").cast("string")
    records = o.select(text.alias("id"), F.concat(text, F.lit("__v1")).alias("ref"), F.col("o_custkey").cast("string").alias("customer"), F.col("o_orderdate").cast("timestamp").alias("insert_time"))
    sinks.append_table(records, sinks.TableSpec("meta_order", ("id", "ref", "customer", "insert_time")), base)
    jobs.kv_job(spark, base, ["meta_order:customer"], F.lit("2024-01-01").cast("timestamp"))
    return jobs.kv(spark, base).select("table", "key", "value")


ORDER_TABLE = sinks.TableSpec("meta_order", ("id", "ref", "hash", "insert_time"))


@registered("c9_refreshed_lookup", """
SELECT o_custkey::VARCHAR AS id, arg_max(o_custkey || '__v' || o_orderkey, (date_trunc('year', o_orderdate), o_orderkey)) AS ref,
       arg_max(o_orderstatus, (date_trunc('year', o_orderdate), o_orderkey)) AS hash FROM orders GROUP BY o_custkey""")
def c9(spark, sf_dir):
    """Three appends of versions: one merged, one with a refresh that broke off and another one, one read from its own folder."""
    o, base = table(spark, sf_dir, "orders"), shared_dir(spark, "kept")
    view = latest_version_view("meta_order", ("hash",))
    versions = o.select(
        F.col("o_custkey").cast("string").alias("id"), F.concat(F.col("o_custkey").cast("string"), F.lit("__v"), F.col("o_orderkey").cast("string")).alias("ref"),
        F.col("o_orderstatus").alias("hash"), F.date_trunc("year", "o_orderdate").alias("insert_time"), F.pmod("o_orderkey", F.lit(3)).alias("part"))
    for part in range(3):
        sinks.append_table(versions.filter(F.col("part") == part), ORDER_TABLE, base)
        if part == 1:
            write_generation(spark, base, view, read_kept(spark, base, view).limit(1), pointer(spark, base, view))  # breaks off before its pointer
        if part < 2:
            refresh(spark, base, view)
    return read_kept(spark, base, view).select("id", "ref", "hash")


def _metric_rows(ev: DataFrame, value, target) -> DataFrame:
    null = F.lit(None).cast("string")
    return ev.select(
        target.alias("target_table"), F.col("ts").cast("timestamp").alias("observation_time"), F.lit("c").alias("collector_id"), F.lit("o").alias("policy_originator"),
        F.lit("tlp:amber").alias("policy_level"), F.array(F.lit("s")).alias("policy_scope"), F.lit("{}").alias("ext"), F.col("event_id").cast("string").alias("id"), null.alias("ref"),
        F.col("event_type").alias("metric_name"), value.alias("metric_value"))


@registered("j6_gauge_counter", """
SELECT 'counter' AS kind, event_id::VARCHAR AS id, event_type AS metric_name, event_id * 1000 AS counter_value, NULL::DOUBLE AS gauge_value FROM events
UNION ALL SELECT 'gauge', event_id::VARCHAR, event_type, NULL, CASE WHEN event_id % 2 = 0 THEN value ELSE user_id END FROM events""")
def j6(spark, sf_dir):
    """Two writers with values of different types share the tables of a kind."""
    ev, base = table(spark, sf_dir, "events"), shared_dir(spark, "metrics")
    even, odd, name = ev.filter("event_id % 2 = 0"), ev.filter("event_id % 2 = 1"), F.lit("data_events")
    sinks.write_demux(_metric_rows(even, F.col("event_id") * 1000, name), base, "counter")
    sinks.write_demux(_metric_rows(odd, (F.col("event_id") * 1000).cast("decimal(21,0)"), name), base, "counter", batch=Batch("stream", 0))
    sinks.write_demux(_metric_rows(even, F.col("value"), name), base, "gauge")
    sinks.write_demux(_metric_rows(odd, F.col("user_id"), name), base, "gauge", batch=Batch("stream", 0))
    counter, gauge = (sinks.read_table(spark, base, f"metrics_{k}") for k in ("counter", "gauge"))
    none = F.lit(None)
    left = counter.select(F.lit("counter").alias("kind"), "id", "metric_name", F.col("metric_value").cast("bigint").alias("counter_value"), none.cast("double").alias("gauge_value"))
    return left.unionByName(gauge.select(F.lit("gauge").alias("kind"), "id", "metric_name", none.cast("bigint").alias("counter_value"), F.col("metric_value").alias("gauge_value")))


@registered("b8_demux_tables", """
SELECT 'data_' || event_type AS target_table, CAST(ts AS DATE)::VARCHAR AS day, count(*) AS n, CAST(sum(user_id) AS BIGINT) AS total FROM events GROUP BY ALL""")
def b8_tables(spark, sf_dir):
    """Rows of one batch land in the tables that they name, and a repeated batch does not double them."""
    ev, base = table(spark, sf_dir, "events"), shared_dir(spark, "demux")
    rows = _metric_rows(ev, F.col("user_id"), F.concat(F.lit("data_"), F.col("event_type")))
    for _ in range(2):
        sinks.write_demux(rows, base, "counter", batch=Batch("stream", 4))
    back = sinks.read_table(spark, base, "metrics_counter")
    return back.groupBy("target_table", F.col("dt").cast("string").alias("day")).agg(F.count("*").alias("n"), F.sum("metric_value").cast("bigint").alias("total"))


#: Five days, with all times of the day.
_SECONDS = "1700006400 + (l_orderkey * 7919 + l_linenumber * 977) % 432000"


def _flow_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as messages: every 41st line is broken, every 43rd lacks its source address, every 47th its time."""
    li = table(spark, sf_dir, "lineitem")
    k = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    wire = F.struct(
        F.when(k % 43 != 0, ipv4_text(views.src_int())).alias("ip_src"), ipv4_text(views.dst_int()).alias("ip_dst"), F.expr("string(l_orderkey % 2000)").alias("port_src"),
        F.expr("string(l_partkey % 2000)").alias("port_dst"), F.expr(views.PROTO_SQL).alias("ip_proto"),
        F.when(k % 47 != 0, F.expr(f"string({_SECONDS})")).otherwise(F.lit("soon")).alias("timestamp_start"),
        F.expr("string(CAST(l_quantity AS BIGINT) * 100)").alias("bytes"), F.expr("string(l_linenumber)").alias("packets"))
    value = F.when(k % 41 == 0, F.lit("{broken")).otherwise(F.to_json(wire))
    return li.select(F.lit(None).cast("string").alias("key"), value.alias("value"), F.lit("flow").alias("topic"), F.lit(0).alias("partition"), k.cast("bigint").alias("offset"),
                     F.col("l_shipdate").cast("timestamp").alias("timestamp"))


_FATE = """
fate AS (SELECT *, l_orderkey * 8 + l_linenumber AS k FROM lineitem),
stored AS (SELECT * FROM fate WHERE k % 41 <> 0 AND k % 43 <> 0 AND k % 47 <> 0)"""


def _write_messages(rows: DataFrame, path: str) -> None:
    """Four files of small row groups, so that the tasks of a batch share its file."""
    rows.repartition(4, "offset").write.option("parquet.block.size", 1 << 20).parquet(path)


def _flow_base(spark: SparkSession, sf_dir: str) -> str:
    """The flow stream over at least four files, one a batch, each batch handled twice."""
    from telescry.sources.messages import read_messages

    base = shared_dir(spark, "flows")
    _write_messages(_flow_messages(spark, sf_dir), f"{base}/messages")
    handle = jobs.flow_batch(spark, f"{base}/tables", rollups={"ip_version": ["1d"]})

    def twice(rows: DataFrame, batch: Batch) -> None:
        handle(rows, batch)
        handle(rows, batch)

    source = read_messages(spark, True, "parquet", path=f"{base}/messages", maxFilesPerTrigger="1")
    run_stream(source, twice, f"{base}/checkpoint", None).awaitTermination()
    return f"{base}/tables"


@registered("k1_flow_stream", f"""
WITH {_FATE}
SELECT CAST(to_timestamp({_SECONDS}) AT TIME ZONE 'UTC' AS DATE)::VARCHAR AS day, count(*) AS flow_count, CAST(sum(CAST(l_quantity AS BIGINT) * 800) AS BIGINT) AS bit_count, count(*) AS stored FROM stored GROUP BY ALL""")
def k1(spark, sf_dir):
    """Days of the flow table beside the rollup that the stream kept."""
    base = _flow_base(spark, sf_dir)
    stored = sinks.read_table(spark, base, sinks.FLOW_TABLE.name).groupBy(F.col("dt").cast("string").alias("day")).agg(F.count("*").alias("stored"))
    rolled = read_rollup(spark, base, rollup.IP_VERSION, "1d").select(F.to_date("start_time").cast("string").alias("day"), "flow_count", "bit_count")
    return rolled.join(stored, "day")


@registered("e12_load_statistics", f"""
WITH {_FATE}
SELECT 'data_flow' AS sink, 4 AS batches, (SELECT count(*) FROM stored) AS records
UNION ALL SELECT 'rejected_message', 4, (SELECT count(*) FROM fate) - (SELECT count(*) FROM stored)""")
def e12(spark, sf_dir):
    """Records per sink as they were counted while written, over four batches, each handled twice."""
    stats = sinks.read_table(spark, _flow_base(spark, sf_dir), STATISTICS.name)
    return stats.groupBy("sink").agg(F.count("*").cast("int").alias("batches"), F.sum("record_count").alias("records"))


@registered("k1_rejected", f"""
WITH {_FATE}
SELECT 'stored' AS fate, count(*) AS messages FROM stored
UNION ALL SELECT 'value is not a JSON object', count(*) FROM fate WHERE k % 41 = 0
UNION ALL SELECT 'missing field', count(*) FROM fate WHERE k % 41 <> 0 AND k % 43 = 0
UNION ALL SELECT 'no usable start time', count(*) FROM fate WHERE k % 41 <> 0 AND k % 43 <> 0 AND k % 47 = 0""")
def k1_rejected(spark, sf_dir):
    """Every message is either stored or rejected with a reason, once."""
    base = _flow_base(spark, sf_dir)
    reason = F.when(F.col("error").contains("JSON") | F.col("error").contains("usable"), F.col("error")).otherwise(F.lit("missing field"))
    rejected = sinks.read_table(spark, base, jobs.REJECTED.name).groupBy(reason.alias("fate")).agg(F.countDistinct("offset").alias("distinct_messages"), F.count("*").alias("messages"))
    stored = sinks.read_table(spark, base, sinks.FLOW_TABLE.name).agg(F.count("*").alias("messages")).select(F.lit("stored").alias("fate"), "messages")
    return stored.unionByName(rejected.select("fate", "messages"))


@registered("k3_late_batches", _version_sql("CAST(floor(epoch(ts)) AS BIGINT) // 3600 * 3600"))
def k3_late(spark, sf_dir):
    """Four files whose rows span all days, so every batch after the first is late; batches come twice; old days are compacted in between."""
    out, ev = shared_dir(spark, "rollup"), table(spark, sf_dir, "events")
    ev.repartition(4, "event_id").write.parquet(f"{out}/events")
    middle = ev.agg(F.percentile(F.unix_timestamp(F.col("ts").cast("timestamp")), 0.5)).first()[0]
    before = datetime.fromtimestamp(middle, timezone.utc).date()
    sink = rollup_sink(rollup.IP_VERSION, "1h", out)

    def twice(rows: DataFrame, batch: Batch) -> None:
        sink(rows, batch)
        sink(rows, batch)
        if batch.number == 2:
            compact_rollup(spark, out, rollup.IP_VERSION, "1h", before, 1)

    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(f"{out}/events")
    run_stream(as_version_flows(stream), twice, f"{out}/checkpoint", None).awaitTermination()
    compact_rollup(spark, out, rollup.IP_VERSION, "1h", before, 2)
    return _epoch(read_rollup(spark, out, rollup.IP_VERSION, "1h"))


@registered("j3_rollup_retention", f"""
SELECT * FROM ({_version_sql("CAST(floor(epoch(ts)) AS BIGINT) // 86400 * 86400")}) r
WHERE start_epoch >= (SELECT CAST(floor(epoch(min(ts))) AS BIGINT) // 86400 * 86400 + 10 * 86400 FROM events)""")
def j3_rollup(spark, sf_dir):
    """Rollups are kept for five years: ten days after the oldest row's term, ten days are gone."""
    ev, base = table(spark, sf_dir, "events"), shared_dir(spark, "rollup")
    rollup_sink(rollup.IP_VERSION, "1d", base)(as_version_flows(ev), Batch("stream", 0))
    oldest = ev.agg(F.min("ts")).first()[0]
    sinks.apply_retention(spark, sinks.rollup_table(rollup.IP_VERSION, "1d"), base, oldest + timedelta(days=sinks.ROLLUP_KEEP_DAYS + 10))
    return _epoch(read_rollup(spark, base, rollup.IP_VERSION, "1d"))


@registered("k7_keyed_state", """
SELECT o_custkey::VARCHAR AS key, arg_max(o_orderkey::VARCHAR, (o_orderdate, o_orderkey)) AS value, count(*) AS updates FROM orders GROUP BY o_custkey""")
def k7(spark, sf_dir):
    """The newest value per key by message time, over four batches in any order, and the number of updates."""
    out, o = shared_dir(spark, "state"), table(spark, sf_dir, "orders")
    o.repartition(4, "o_orderkey").write.parquet(f"{out}/orders")
    stream = spark.readStream.schema(o.schema).option("maxFilesPerTrigger", 1).parquet(f"{out}/orders").select(
        F.lit("t").alias("table"), F.col("o_custkey").cast("string").alias("key"), F.lit("order").alias("field"), F.col("o_orderkey").cast("string").alias("value"),
        F.col("o_orderdate").cast("timestamp").alias("at"), F.col("o_orderkey").alias("seq"))

    def write(rows: DataFrame, number: int) -> None:
        rows.withColumn("batch_id", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{out}/changes")

    writer = keyed_state(stream, 10**9).writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{out}/checkpoint")
    run_once(writer, spark)
    last = spark.read.parquet(f"{out}/changes").groupBy("key").agg(F.max_by(F.struct("value", "updates"), "batch_id").alias("r"))
    return last.select("key", "r.value", "r.updates")


@registered("k6_snmp_stream", f"""
WITH {views.METRIC_CTE},
io AS (SELECT event_id, device || '::' || idx AS key, 1 AS w, 'v' || (event_id % 5) || 'eth' || (user_id % 40) AS value FROM msg WHERE rule = 0
       UNION ALL SELECT event_id, device || '::' || (user_id % 40), 0, NULL FROM msg WHERE rule < 2),
seen AS (SELECT *, last_value(value IGNORE NULLS) OVER (PARTITION BY key ORDER BY event_id, w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS name FROM io)
SELECT event_id, key, name FROM seen WHERE w = 0""")
def k6(spark, sf_dir):
    """Interface names that change with every poll, as polls and queue polls see them in order: four batches, each delivered
    twice, with a restart after each."""
    out, order = shared_dir(spark, "replay"), F.col("event_id")
    polls = views.metric_messages(spark, sf_dir).withColumn("fields", F.replace("fields", F.lit('"eth'), F.concat(F.lit('"v'), (order % 5).cast("string"), F.lit("eth"))))
    polls = polls.select("name", "timestamp", "interval", "tags", "fields", F.lit(0).alias("partition"), order.alias("offset"))
    low, high = table(spark, sf_dir, "events").agg(F.min("event_id"), F.max("event_id")).first()
    rules, device = metric_rules(), short_hostname(F.element_at("tags", "device"))
    index = F.element_at("tags", "oidIndex")
    asked = F.when(F.col("name") == "snmp_if", index).when(F.col("name") == "snmp_queue", F.split_part(index, F.lit("."), F.lit(2)))
    reads = F.when(asked.isNotNull(), F.array(F.struct(F.lit("ifindex_to_ifname").alias("table"), F.concat_ws("::", device, asked).alias("key"))))

    def write(rows: DataFrame, number: int) -> None:
        for _ in range(2):
            rows.withColumn("batch_id", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{out}/seen")

    share = F.floor((F.col("offset") - (low or 0)) * 4 / ((high or 0) - (low or 0) + 1))
    for part in range(4):
        polls.filter(share == part).write.mode("append").parquet(f"{out}/polls")
        stream = spark.readStream.schema(polls.schema).parquet(f"{out}/polls")
        seen = jobs.ordered_lookups(stream, rules, reads)
        run_once(seen.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", f"{out}/checkpoint"), spark)
    return spark.read.parquet(f"{out}/seen").select(F.col("offset").alias("event_id"), "key", F.col("seen").alias("name"))


def _as_messages(rows: DataFrame) -> DataFrame:
    """Rows as messages of one partition, in any order."""
    text = lambda v: F.lit(v).cast("string")
    return rows.select(text(None).alias("key"), F.to_json(F.struct(*rows.columns)).alias("value"), F.lit("t").alias("topic"), F.lit(0).alias("partition"),
                       F.monotonically_increasing_id().alias("offset"), F.lit("2024-01-01").cast("timestamp").alias("timestamp"))


@registered("l2_enriched_flow_job", f"""
SELECT CAST(to_timestamp({_SECONDS}) AT TIME ZONE 'UTC' AS DATE)::VARCHAR AS day, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS bits
FROM lineitem WHERE l_linenumber <> 7 GROUP BY ALL""")
def l2_enriched(spark, sf_dir):
    """The source that is enriched already, handled twice, read back from the flow table."""
    from telescry.plans.registered.flows import _enriched_messages

    base = shared_dir(spark, "flows")
    at = F.timestamp_seconds(F.expr(_SECONDS.replace("l_orderkey", "values.num_bits").replace("l_linenumber", "values.num_packets")))
    stamp = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    lines = table(spark, sf_dir, "lineitem").repartition(4 * spark.sparkContext.defaultParallelism)  # a file may be one row group
    source = _as_messages(_enriched_messages(lines).withColumn("start", stamp).withColumn("end", stamp))
    for _ in range(2):
        jobs.enriched_flow_batch(base)(source, Batch("stream", 0))
    back = sinks.read_table(spark, base, sinks.FLOW_TABLE.name)
    return back.groupBy(F.col("dt").cast("string").alias("day")).agg(F.count("*").alias("n"), F.sum("bit_count").cast("bigint").alias("bits"))


@registered("l2_named_traffic_job", """
SELECT CAST(ts AS DATE)::VARCHAR AS day, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS bits,
  count(CASE WHEN user_id % 2 = 0 THEN 1 END) AS known FROM events WHERE user_id % 10 <> 9 GROUP BY ALL""")
def l2_named(spark, sf_dir):
    """The source that names its interfaces, with references from the key-value table, read back from the traffic table."""
    from telescry.config import MetricConfig
    from telescry.plans.registered.metrics import named_messages

    base = shared_dir(spark, "traffic")
    rows, refs = named_messages(spark, sf_dir)
    sinks.write_kv(keyed.kv_rows(refs.withColumn("table", F.lit(MetricConfig().interface_ref_table)), F.lit("2024-01-01").cast("timestamp"), None), base)
    jobs.named_traffic_batch(base)(_as_messages(rows), Batch("stream", 0))
    back = sinks.read_table(spark, base, sinks.TRAFFIC_TABLE.name)
    return back.groupBy(F.col("dt").cast("string").alias("day")).agg(
        F.count("*").alias("n"), F.sum("in_bit_count").cast("bigint").alias("bits"), F.count("interface_ref").alias("known"))
