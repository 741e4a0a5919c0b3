"""Micro-batch streams and incremental rollups (K1-K6, K8)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from telescry.config import RollupPolicy
from telescry.operators.rollup import COUNTERS, RollupKind, merge_sum, partials
from telescry.sinks.tables import Batch, append_table, batch_folders, finish_replacement, read_table, replace_folders, rollup_table


BatchFn = Callable[[DataFrame, Batch], None]


def run_stream(df: DataFrame, batch_fn: BatchFn, checkpoint: str, interval: str | None = "30 seconds", name: str | None = None) -> StreamingQuery:
    """K1, K2, K8: ``batch_fn(rows, batch)`` per micro-batch.

    A batch is named by the query's id, which its checkpoint keeps over restarts, and its number: another stream, or
    the same one with a new checkpoint, is another writer.  ``interval=None`` processes what is there and stops.  The
    batch size is limited at the source (``maxOffsetsPerTrigger``, ``maxFilesPerTrigger``).
    """
    ids: list[str] = []

    def handle(rows: DataFrame, number: int) -> None:
        if not ids:
            ids.append(rows.sparkSession.read.json(f"{checkpoint}/metadata").first()["id"])
        batch_fn(rows, Batch(ids[0], number))

    writer = df.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(availableNow=True) if interval is None else writer.trigger(processingTime=interval)
    return writer.start()


def read_once(handle: BatchFn) -> BatchFn:
    """Keep a micro-batch while its batch function uses it several times."""

    def keep(rows: DataFrame, batch: Batch) -> None:
        rows = rows.persist()
        try:
            handle(rows, batch)
        finally:
            rows.unpersist()

    return keep


def fan_out(outputs: Sequence[tuple[Callable[[DataFrame], DataFrame], BatchFn]]) -> BatchFn:
    """One batch through several (transform, sink) pairs, read from the source once."""

    def handle(rows: DataFrame, batch: Batch) -> None:
        for transform, sink in outputs:
            sink(transform(rows), batch)

    return read_once(handle)


def rollup_sink(kind: RollupKind, window: str, base: str, policy: RollupPolicy = RollupPolicy(),
                applications: Callable[[], DataFrame | None] = lambda: None) -> BatchFn:
    """K3, K5: batch function that adds a batch of flow rows to a rollup table, as partial sums of its own.

    ``applications`` is called per batch, so refreshed lookups are picked up.
    """

    def handle(flows: DataFrame, batch: Batch) -> None:
        append_table(partials(flows, kind, window, policy, applications()), rollup_table(kind, window), base, batch)

    return handle


def read_rollup(spark: SparkSession, base: str, kind: RollupKind, window: str) -> DataFrame | None:
    """K4: partial sums added up; rows may arrive however late.  None before the first write."""
    finish_replacement(spark, rollup_table(kind, window), base)
    table = read_table(spark, base, kind.table(window))
    return None if table is None else merge_sum(table, ["start_time", *kind.keys], COUNTERS)


def compact_rollup(spark: SparkSession, base: str, kind: RollupKind, window: str, before: date, generation: int) -> None:
    """K4, E5: the partial sums of days before ``before`` become one partial sum per day.

    Only folders that stand there when it begins are replaced, so a late batch is kept beside the sum.  The sums are written
    aside first; a run that breaks off is finished by the next reader or compaction, so nothing counts twice or is lost.
    """
    table = rollup_table(kind, window)
    finish_replacement(spark, table, base)
    old = batch_folders(spark, table, base, before)
    if old:
        rows = spark.read.option("basePath", f"{base}/{table.name}").parquet(*old)
        replace_folders(spark, merge_sum(rows, ["start_time", *kind.keys], COUNTERS), table, base, old, generation)


def watermarked_rollup(flows: DataFrame, kind: RollupKind, window: str, lateness: str) -> DataFrame:
    """Streaming aggregate variant: later than ``lateness`` is dropped, state stays bounded.

    Only for windows of fixed length (seconds to days).
    """
    units = {"s": "seconds", "m": "minutes", "h": "hours", "d": "days"}
    count, unit = int(window[:-1]), units[window[-1].lower()]
    rows = kind.rows(flows).withWatermark("start_time", lateness)
    grouped = rows.groupBy(F.window("start_time", f"{count} {unit}").alias("w"), *kind.keys)
    out = grouped.agg(F.count(F.lit(1)).alias("flow_count"), F.sum("bit_count").alias("bit_count"),
                      F.sum("packet_count").alias("packet_count"))
    return out.select(F.col("w.start").alias("start_time"), *kind.keys, *COUNTERS)
