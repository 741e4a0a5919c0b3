"""Batches of raw flow messages: judged once, by tasks that share them; probes of ranges."""

import json

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from telescry.config import FlowConfig
from telescry.functions.flow import until_first_gap
from telescry.operators import flows, ranges
from telescry.plans import jobs
from telescry.plans.registered import stores
from telescry.session import shared_dir
from telescry.sinks import tables as sinks
from telescry.sinks.tables import Batch

_FLOW = {"ip_src": "10.0.0.1", "ip_dst": "10.0.0.2", "port_src": "1", "port_dst": "2", "ip_proto": "tcp", "timestamp_start": "1700000000"}


def test_each_message_is_read_once_a_batch(spark):
    """Rejected messages and flows come from one pass over the source."""
    values = [json.dumps(_FLOW), " \n{}", json.dumps(_FLOW | {"timestamp_start": "soon"}), "[1]", "{broken", '"{}"', "null", "", None, '{"a":1,"a":2}', json.dumps(_FLOW)]
    rows = spark.createDataFrame(list(enumerate(values)), "offset long, value string").repartition(2)
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    text = F.lit("t")
    source = rows.mapInArrow(count, rows.schema).select(text.alias("key"), "value", text.alias("topic"), F.lit(0).alias("partition"), "offset", F.lit("2024-01-01").cast("timestamp").alias("timestamp"))
    base = shared_dir(spark, "flows")
    jobs.flow_batch(spark, base)(source, Batch("stream", 0))
    assert seen.value == len(values)
    rejected = {r.offset: r.error for r in sinks.read_table(spark, base, jobs.REJECTED.name).collect()}
    no_object = "value is not a JSON object"
    missing = "missing ip_src,ip_dst,port_src,port_dst,ip_proto"
    assert rejected == {1: missing, 2: "no usable start time", 3: no_object, 4: no_object, 5: no_object, 6: no_object, 9: no_object}
    assert sinks.read_table(spark, base, sinks.FLOW_TABLE.name).count() == 2


def test_tasks_share_a_file_of_messages(spark, tmp_path):
    """A batch of one file is read by several tasks."""
    n = 60_000
    numbers = spark.range(n)
    numbers.select(
        F.col("id").alias("l_orderkey"), (F.col("id") * 7).alias("l_partkey"), (F.col("id") % 100).alias("l_suppkey"), (F.col("id") % 7).cast("int").alias("l_linenumber"),
        F.lit(1.0).alias("l_quantity"), F.lit("2024-01-01").cast("timestamp").alias("l_shipdate")).write.parquet(f"{tmp_path}/lineitem.parquet")
    stores._write_messages(stores._flow_messages(spark, str(tmp_path)), f"{tmp_path}/messages")
    groups = [pq.ParquetFile(f).metadata.num_row_groups for f in tmp_path.glob("messages/*.parquet")]
    assert len(groups) == 4 and min(groups) > 1


def test_columns_of_a_flow_are_built_once(spark):
    """A batch's plan takes few calls to the JVM."""
    cfg = FlowConfig()
    assert flows._normal_columns(cfg.flow_type) is flows._normal_columns(cfg.flow_type)
    assert flows._bgp_columns(cfg.as_path_mode) is flows._bgp_columns(cfg.as_path_mode)


def test_exploded_probes_of_ranges_are_not_broadcast(spark):
    """Few rows of a file become many probes; the plan must not send them to the driver."""
    probes = spark.range(1000).select(F.lit("k").alias("key"), F.col("id").alias("v"))
    table = spark.createDataFrame([("k", 10, 700, "a"), ("k", 5, 20, "b"), ("k", 900, 900, "c"), ("k", -3, -1, "d")], "key string, lo long, hi long, value string")
    found = ranges.range_resolve(probes, ranges.range_index(table))
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    expect = {v: "b" if 5 <= v <= 20 else "a" if 10 <= v <= 700 else "c" for v in [*range(5, 701), 900]}
    assert {r.v: r.value for r in found.collect()} == expect


def test_enriched_messages_are_read_once_a_batch(spark):
    """Without lookups and dead letters one pass writes a batch; dead letters are still found."""
    flow = {"start": "2024-01-01T00:00:00Z", "end": "2024-01-01T00:00:00Z", "values": {"num_bits": 8, "num_packets": 1}, "meta": {
        "src_asn": 1, "src_ip": "10.0.0.1", "src_port": 1, "dst_asn": 2, "dst_ip": "10.0.0.2", "dst_port": 2, "mpls": {"exp0": "4", "exp1": "5", "exp2": "x", "exp3": "6"}}}
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    def messages(*values):
        rows = spark.createDataFrame(list(enumerate(values)), "offset long, value string").repartition(2)
        text = F.lit("t")
        return rows.mapInArrow(count, rows.schema).select(text.alias("key"), "value", text.alias("topic"), F.lit(0).alias("partition"), "offset", F.lit("2024-01-01").cast("timestamp").alias("timestamp"))

    base = shared_dir(spark, "flows")
    handle = jobs.enriched_flow_batch(base, FlowConfig(extensions=("mpls",)))
    handle(messages(json.dumps(flow), json.dumps(flow), "{}"), Batch("stream", 0))
    assert seen.value == 3
    assert [json.loads(r.ext)["mpls_exp"] for r in sinks.read_table(spark, base, sinks.FLOW_TABLE.name).collect()] == [[4, 5], [4, 5]]
    handle(messages(json.dumps(flow), "[1]", "{broken"), Batch("stream", 1))
    assert sorted(r.offset for r in sinks.read_table(spark, base, jobs.REJECTED.name).collect()) == [1, 2]
    assert sinks.read_table(spark, base, sinks.FLOW_TABLE.name).count() == 3


def test_first_gap_of_a_numbered_family(spark):
    rows = spark.createDataFrame([("1", "2", "3"), ("1", None, "3"), ("x", "2", "3"), (None, None, None), (" 7 ", "8", "9.5")], "a string, b string, c string")
    got = [r[0] for r in rows.select(until_first_gap([F.col(c) for c in "abc"])).collect()]
    assert got == [[1, 2, 3], [1], [], [], [7, 8]]
