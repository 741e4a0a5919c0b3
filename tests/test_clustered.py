"""Files clustered by range: what a reader of one key and hour has to read."""

from datetime import datetime, timedelta
from pathlib import Path

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from telescry.sinks import tables as sinks

TABLE = sinks.TableSpec("samples", ("device", "ts", "value"), "ts", ("device", "ts"))


def _groups(folder: str, device: str, start: datetime, end: datetime) -> tuple[int, int, int]:
    """Row groups of all files, those whose statistics admit the device and the time, and the rows of the largest file."""
    total = admitted = largest = 0
    for path in Path(folder).rglob("*.parquet"):
        meta = pq.read_metadata(path)
        names = [meta.schema.column(i).name for i in range(meta.num_columns)]
        largest = max(largest, meta.num_rows)
        for g in range(meta.num_row_groups):
            total += 1
            d, t = (meta.row_group(g).column(names.index(c)).statistics for c in ("device", "ts"))
            admitted += d.min <= device <= d.max and t.min.replace(tzinfo=None) <= end and t.max.replace(tzinfo=None) >= start
    return total, admitted, largest


def test_a_device_and_hour_read_few_row_groups(spark, tmp_path):
    start = datetime(2024, 1, 1)
    # one device has a third of all rows
    rows = spark.range(40_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("d"), (F.xxhash64("id") % 50 + 50).cast("string"))).alias("device"),
        (F.lit(start) + F.make_interval(secs=F.col("id") * 7919 % 172_800)).alias("ts"), F.col("id").alias("value"))
    at = start + timedelta(hours=30)
    found = {}
    for name, limit in (("plain", None), ("clustered", 500)):
        base = str(tmp_path / name)
        sinks.append_table(rows, TABLE, base, rows_per_file=limit)
        stored = sinks.read_table(spark, base, "samples")
        assert stored.count() == 40_000
        for device in ("hot", "d7"):
            part = stored.filter((F.col("device") == device) & (F.col("ts") >= F.lit(at)) & (F.col("ts") < F.lit(at + timedelta(hours=1))))
            want = rows.filter((F.col("device") == device) & (F.col("ts") >= F.lit(at)) & (F.col("ts") < F.lit(at + timedelta(hours=1))))
            assert sorted(r.value for r in part.collect()) == sorted(r.value for r in want.collect()) != []
            found[name, device] = _groups(base, device, at, at + timedelta(hours=1))
    for device in ("hot", "d7"):
        total, admitted, largest = found["clustered", device]
        assert largest <= 500 and total >= 80 and admitted <= total / 10
        assert found["plain", device][1] * 2 >= found["plain", device][0]  # without ranges each file of the day may hold it
    assert "PushedFilters: [IsNotNull(device)" in part._jdf.queryExecution().toString()


def test_clustering_keeps_nulls_repeats_and_empty_appends(spark, tmp_path):
    rows = spark.createDataFrame([("a", datetime(2024, 1, 1), 1)] * 7 + [(None, datetime(2024, 1, 1), 2), ("b", None, 3)], "device string, ts timestamp, value long")
    sinks.append_table(rows, TABLE, str(tmp_path), rows_per_file=3)
    sinks.append_table(rows.limit(0), TABLE, str(tmp_path), rows_per_file=3)
    assert sorted(r.value for r in sinks.read_table(spark, str(tmp_path), "samples").collect()) == [1] * 7 + [2, 3]
