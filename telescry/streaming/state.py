"""Keyed state: newest values with a time to live (K7), lookups replayed in message order (K6)."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming.readwriter import DataStreamWriter
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

OUTPUT_SCHEMA = "table string, key string, field string, value string, updates bigint"
FIELD_SCHEMA, ENTRY_SCHEMA = "field string", "value string, updates bigint, at timestamp, seq bigint"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _place(at: Any, seq: int | None) -> tuple:
    """Order of messages: those without a time first, then by time and number."""
    return (at is not None, at.timestamp() if at is not None else 0.0, -1 if seq is None else int(seq))


class LatestFields(StatefulProcessor):
    """The newest value by message time of each field of a ``(table, key)``.

    Each field is an entry of the key's map state and expires by itself ``ttl_ms`` after its last update; the state
    store drops what has expired.
    """

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.fields = handle.getMapState("fields", FIELD_SCHEMA, ENTRY_SCHEMA, self.ttl_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        changed: dict[str, list] = {}
        for row in rows:
            if row.value is None or row.field is None:
                continue
            if (entry := changed.get(row.field)) is None:
                held = self.fields.getValue((row.field,))
                entry = changed[row.field] = list(held) if held is not None else [None, 0, None, None]
            entry[1] += 1
            if entry[0] is None or _place(row.at, row.seq) >= _place(entry[2], entry[3]):
                entry[0], entry[2], entry[3] = row.value, row.at, row.seq
        for field, entry in changed.items():
            self.fields.updateValue((field,), tuple(entry))
            yield Row(table=key[0], key=key[1], field=field, value=entry[0], updates=entry[1])

    def close(self) -> None:
        pass


def with_state_store(spark: SparkSession) -> None:
    """State on RocksDB, which map states and expiry need and which keeps it off the heap."""
    spark.conf.set(PROVIDER, ROCKS_DB)


def run_once(writer: DataStreamWriter, spark: SparkSession) -> None:
    """Process what is there and stop.  A query with a time to live otherwise goes on with empty batches for ever."""
    name = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        query = writer.trigger(availableNow=True).start()
    finally:
        spark.conf.set(name, before)
    query.awaitTermination()


def keyed_state(stream: DataFrame, ttl_s: int) -> DataFrame:
    """Stream of ``table, key, field, value, at, seq`` -> changed fields with the number of updates while alive.

    ``at`` and ``seq`` are a message's time and offset; the order in which rows reach a task does not count.
    """
    with_state_store(stream.sparkSession)
    return stream.groupBy("table", "key").transformWithState(
        statefulProcessor=LatestFields(ttl_s * 1000), outputStructType=OUTPUT_SCHEMA, outputMode="Update", timeMode="ProcessingTime")


SEEN_SCHEMA = "table string, key string, partition int, offset bigint, seen string"


class ReplayedLookup(StatefulProcessor):
    """What each reader of a ``(table, key)`` saw: the value that the last message before it wrote.

    A batch's rows of a key are put in order by partition and offset; a message that writes and reads does not see its own
    value.  A task holds one key's rows of one batch, which the limit of the source bounds.
    """

    def __init__(self, ttl_ms: int | None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("held", "value string", self.ttl_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        held = self.held.get() if self.held.exists() else None
        value = before = held[0] if held is not None else None
        written = False
        for row in sorted(rows, key=lambda r: (r.partition, r.offset, r.writes)):
            if row.writes:
                value, written = row.value, True
            else:
                yield Row(table=key[0], key=key[1], partition=row.partition, offset=row.offset, seen=value)
        if written and (value != before or self.ttl_ms is not None):
            self.held.update((value,))

    def close(self) -> None:
        pass


def replayed_lookup(stream: DataFrame, ttl_s: int | None = None) -> DataFrame:
    """Stream of ``table, key, value, writes, partition, offset`` -> one row per reading row, with the value it saw or null.

    With ``ttl_s`` a value expires that long after the last batch that wrote it.
    """
    with_state_store(stream.sparkSession)
    return stream.groupBy("table", "key").transformWithState(
        statefulProcessor=ReplayedLookup(None if ttl_s is None else ttl_s * 1000), outputStructType=SEEN_SCHEMA, outputMode="Append",
        timeMode="None" if ttl_s is None else "ProcessingTime")
