"""Load statistics: how many records each sink was given, counted while they are written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from telescry.sinks.tables import JOB, Batch, TableSpec, append_table

STATISTICS = TableSpec("load_statistics", ("sink", "record_count", "last_updated"))
_SCHEMA = "sink string, record_count bigint"


class LoadLog:
    """Observes the rows on their way into sinks; no sink is read again and no row counted by a job of its own.

    The observation stands in the stage that writes, so a stage that is repeated before it does not count twice.
    """

    def __init__(self, as_of: Callable[[], Column] = F.current_timestamp):
        self.as_of = as_of
        self.watched: list[tuple[str, Observation]] = []

    def watch(self, rows: DataFrame, sink: str) -> DataFrame:
        """The rows, to be written next."""
        observation = Observation()
        self.watched.append((sink, observation))
        return rows.observe(observation, F.count(F.lit(1)).alias("records"))

    def counts(self) -> list[tuple[str, int]]:
        """Records per sink since the last call; waits for their writes."""
        found: dict[str, int] = {}
        for sink, observation in self.watched:
            found[sink] = found.get(sink, 0) + int(observation.get.get("records", 0))
        self.watched = []
        return sorted(found.items())

    def flush(self, spark: SparkSession, base: str, batch: Batch = JOB) -> None:
        """Append a row per sink; those of a repeated batch replace its earlier ones."""
        rows = spark.createDataFrame(self.counts(), _SCHEMA).coalesce(1)
        append_table(rows.withColumn("last_updated", self.as_of()), STATISTICS, base, batch)


class StreamLog(StreamingQueryListener):
    """Batches and input records of running queries, by their names or ids, from their progress reports."""

    def __init__(self) -> None:
        self.batches: dict[str, dict[int, int]] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.batches.setdefault(p.name or str(p.id), {})[p.batchId] = p.numInputRows

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def rows(self) -> list[tuple[str, int, int]]:
        """(query, batches with records, records)."""
        return [(name, sum(n > 0 for n in found.values()), sum(found.values())) for name, found in sorted(self.batches.items())]
