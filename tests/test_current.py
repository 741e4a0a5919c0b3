"""Kept views: equal to a reduction of the whole history, and independent of its length."""

import random

import pytest
from pyspark.sql import functions as F

from telescry.operators import keyed
from telescry.operators.lookup import DEVICE_LOOKUP, devices_by_address
from telescry.operators.snapshot import current
from telescry.session import shared_dir
from telescry.sinks import current as kept
from telescry.sinks import tables as sinks
from telescry.sinks.tables import Batch

TABLE = sinks.TableSpec("meta_thing", ("id", "ref", "hash", "insert_time"))
VIEW = kept.latest_version_view("meta_thing", ("hash",))


def versions(spark, rng, n, at):
    rows = [(f"t{k}", f"t{k}__v{rng.randint(1, 12)}", f"h{rng.randint(0, 99)}", at + rng.randint(0, 2)) for k in (rng.randrange(20) for _ in range(n))]
    rows += [(None, "x__v1", "h", at), ("t1", None, "h", at + 9)]
    return spark.createDataFrame(rows, "id string, ref string, hash string, at long").select("id", "ref", "hash", F.timestamp_seconds("at").alias("insert_time"))


def rows_of(df):
    return sorted(map(tuple, df.select("id", "ref", "hash").collect()))


def whole(spark, base):
    return rows_of(current(sinks.read_table(spark, base, TABLE.name)).select("id", "ref", "hash"))


def test_any_order_of_appends_and_refreshes(spark):
    rng, base = random.Random(1), shared_dir(spark, "kept")
    assert kept.read_kept(spark, base, VIEW) is None and kept.refresh(spark, base, VIEW) == -1
    for step in range(9):
        batch = sinks.JOB if step % 3 else Batch("stream", step // 3)
        sinks.append_table(versions(spark, rng, 15, 100 + rng.randint(0, 5)), TABLE, base, batch)
        if step % 2:
            kept.refresh(spark, base, VIEW, share=rng.choice([0.0, 0.5]))
        # equal (insert_time, version) of one id make more than one right answer only in hash; insert times differ by version here
        got, want = rows_of(kept.read_kept(spark, base, VIEW)), whole(spark, base)
        assert [r[:2] for r in got] == [r[:2] for r in want]


def test_reading_does_not_grow_with_the_history(spark):
    rng, base = random.Random(2), shared_dir(spark, "kept")
    for step in range(7):
        sinks.append_table(versions(spark, rng, 5, 100 * step), TABLE, base)
    assert kept.refresh(spark, base, VIEW) == 0
    df = kept.read_kept(spark, base, VIEW)
    assert all("/current/" in f for f in df.inputFiles())
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    sinks.append_table(versions(spark, rng, 5, 1000), TABLE, base)
    files = kept.read_kept(spark, base, VIEW).inputFiles()
    assert sum("/current/" not in f for f in files) == sum("batch_id=7" in f for f in files) > 0
    assert rows_of(kept.read_kept(spark, base, VIEW)) == whole(spark, base)


def test_broken_and_competing_refreshes(spark):
    rng, base = random.Random(3), shared_dir(spark, "kept")
    sinks.append_table(versions(spark, rng, 30, 0), TABLE, base)
    kept.write_generation(spark, base, VIEW, kept.read_kept(spark, base, VIEW).limit(1), kept.pointer(spark, base, VIEW))  # no pointer
    assert rows_of(kept.read_kept(spark, base, VIEW)) == whole(spark, base)
    assert kept.refresh(spark, base, VIEW) == 0
    held = kept.pointer(spark, base, VIEW)
    assert not sinks.create_file(spark, f"{base}/current/{VIEW.name}/_pointers/0")  # the second of two refreshes loses
    sinks.append_table(versions(spark, rng, 30, 50), TABLE, base)
    assert kept.refresh(spark, base, VIEW, share=0) == 1 and kept.refresh(spark, base, VIEW, share=0) == 1
    sinks.append_table(versions(spark, rng, 30, 90), TABLE, base)
    assert kept.refresh(spark, base, VIEW, share=0) == 2
    assert not sinks.path_exists(spark, f"{base}/current/{VIEW.name}/{held.folder}")  # only the last two stay
    assert rows_of(kept.read_kept(spark, base, VIEW)) == whole(spark, base)


def test_unfinished_appends_are_read_but_not_held(spark):
    rng, base = random.Random(4), shared_dir(spark, "kept")
    sinks.append_table(versions(spark, rng, 9, 0), TABLE, base)
    rows = versions(spark, rng, 9, 60).withColumn("writer", F.lit("job")).withColumn("batch_id", F.lit(1))
    number = sinks.reserve_append(spark, f"{base}/{TABLE.name}")
    rows.write.mode("append").partitionBy("writer", "batch_id").parquet(f"{base}/{TABLE.name}")  # its end has not been marked
    sinks.append_table(versions(spark, rng, 9, 80), TABLE, base, Batch("stream", 4))
    kept.refresh(spark, base, VIEW)
    held = kept.pointer(spark, base, VIEW)
    assert number == 1 and held.holds("job", 0) and not held.holds("job", 1) and not held.holds("stream", 4)
    assert rows_of(kept.read_kept(spark, base, VIEW)) == whole(spark, base)
    sinks.append_table(versions(spark, rng, 9, 90), TABLE, base)
    kept.refresh(spark, base, VIEW, share=0)
    held = kept.pointer(spark, base, VIEW)
    assert (held.upto, held.more) == (1, frozenset({2}))


@pytest.mark.parametrize("refreshed", [0, 2, 4])
def test_lookup_and_key_value_views(spark, refreshed):
    base = shared_dir(spark, "kept")
    devices = sinks.TableSpec("meta_device", ("id", "ref", "loopback_ip", "insert_time"))
    view = kept.lookup_view(DEVICE_LOOKUP)
    for k in range(4):
        rows = [("a", f"a__v{k + 1}", ["10.0.0.1", f"10.0.1.{k}"] if k != 3 else None, k), ("b", f"b__v{k + 1}", [f"10.0.2.{k}"], k)]
        df = spark.createDataFrame(rows, "id string, ref string, loopback_ip array<string>, at long").withColumn("insert_time", F.timestamp_seconds("at"))
        sinks.append_table(df, devices, base)
        entries = spark.createDataFrame([("t", f"k{n}", f"v{k}{n}") for n in range(k, 4)], "table string, key string, value string")
        sinks.write_kv(keyed.kv_rows(entries, F.timestamp_seconds(F.lit(100 * k)), 150), base)
        if k < refreshed:
            kept.refresh(spark, base, view, share=0)
            kept.refresh(spark, base, kept.KV_VIEW, share=0)
    table = sinks.read_table(spark, base, "meta_device")
    assert sorted(map(tuple, devices_by_address(kept.read_kept(spark, base, view)).collect())) == sorted(map(tuple, devices_by_address(table).collect()))
    whole = keyed.kv_view(sinks.read_table(spark, base, "kv"))
    got = kept.read_kept(spark, base, kept.KV_VIEW)
    assert sorted(map(tuple, got.select("key", "value").collect())) == sorted(map(tuple, whole.select("key", "value").collect()))


def exchanges_over(plan, name):
    """Exchanges of a printed plan that have a scan of the named table below them."""
    lines = plan.splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    found = 0
    for k, line in enumerate(lines):
        if "Exchange" in line:
            below = []
            for other in lines[k + 1 :]:
                if depth(other) <= depth(line):
                    break
                below.append(other)
            found += any(name in other for other in below)
    return found


def test_changes_are_detected_without_shuffling_the_history(spark):
    """only the batch is shuffled, to the buckets of the current versions."""
    from telescry.operators import versioned

    rng, base = random.Random(6), shared_dir(spark, "kept")
    spec = versioned.EntitySpec("meta_thing", {"name": "text"})
    sinks.append_table(versions(spark, rng, 60, 0), TABLE, base)
    kept.refresh(spark, base, VIEW)
    now = kept.read_kept(spark, base, VIEW)
    held = kept.pointer(spark, base, VIEW)
    name = kept._table_name(f"{base}/current/{VIEW.name}/{held.folder}")
    rows = spark.createDataFrame([(k, f'{{"id": "t{k}", "name": "n{k}"}}') for k in range(40)], "pos long, row_json string")
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        changed = versioned.upsert_versions(versioned.stage(rows, spec), now, spec)
        plan = changed._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and name in plan and exchanges_over(plan, name) == 0
        assert exchanges_over(plan, "Scan ExistingRDD") > 0
        known = {r.id for r in now.collect()}
        assert {r.id: r.ref.endswith("__v1") for r in changed.collect()}.keys() == {f"t{k}" for k in range(40)}
        assert all(r.ref == f"{r.id}__v1" for r in changed.collect() if r.id not in known)
        # appends that are not merged yet meet the buckets too
        sinks.append_table(versions(spark, rng, 5, 90), TABLE, base)
        plan = kept.read_kept(spark, base, VIEW)._jdf.queryExecution().executedPlan().toString()
        assert name in plan and exchanges_over(plan, name) == 0
        assert rows_of(kept.read_kept(spark, base, VIEW)) == whole(spark, base)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
