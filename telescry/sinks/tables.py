"""Parquet tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telescry.entities import specs
from telescry.operators.flows import FLOW_COLUMNS
from telescry.operators.metrics import INTERFACE_FIELDS, TRAFFIC_KEYS
from telescry.operators.prefix import PrefixIndex, counts_of, length_counts, needs_search, search_entries
from telescry.operators.rollup import COUNTERS, RollupKind


@dataclass(frozen=True)
class TableSpec:
    """Columns in order, the time column behind the day partition, clustering and retention in days."""

    name: str
    columns: tuple[str, ...]
    time_column: str | None = None
    sort_key: tuple[str, ...] = ()
    keep_days: int | None = None


FLOW_TABLE = TableSpec("data_flow", FLOW_COLUMNS, "start_time", ("src_as_id", "dst_as_id", "src_ip", "dst_ip", "start_time"), 30)
TRAFFIC_TABLE = TableSpec(
    "data_interface_traffic", TRAFFIC_KEYS + tuple(INTERFACE_FIELDS), "start_time",
    ("interface_id", "policy_level", "policy_scope", "policy_originator", "collector_id", "start_time"), 180)
MESSAGE_TABLE = TableSpec("data_kafka_message", ("topic", "partition", "offset", "key", "value"))
METRIC_COLUMNS = ("observation_time", "collector_id", "policy_originator", "policy_level", "policy_scope", "ext", "id", "ref",
                  "metric_name", "metric_value")
ROLLUP_KEEP_DAYS = 5 * 365
METRIC_KEEP_DAYS = 180


def rollup_table(kind: RollupKind, window: str) -> TableSpec:
    return TableSpec(kind.table(window), ("start_time", *kind.keys, *COUNTERS), "start_time", (), ROLLUP_KEEP_DAYS)


def metric_table(kind: str) -> TableSpec:
    return TableSpec(f"metrics_{kind}", METRIC_COLUMNS, "observation_time", (), METRIC_KEEP_DAYS)


def metadata_table(spec: specs.EntitySpec) -> TableSpec:
    head = ("id", "ref", "hash") if spec.versioned else ("id",)
    return TableSpec(spec.table, (*head, *spec.content, "insert_time"), None, spec.sort_key)


@dataclass(frozen=True)
class Batch:
    """Who writes: a stream's id, which its checkpoint keeps, and the number of its micro-batch."""

    writer: str
    number: int


#: A batch job: each append gets the next number of the table.  A stream's batch has its number, and a repeat overwrites it.
JOB = Batch("job", 0)
#: Files that reserve a job's append (``n``) and tell that it is complete (``n.done``).
_APPENDS = "_appends"


def declared(df: DataFrame, columns: Sequence[str], types: Mapping[str, str] | None = None) -> DataFrame:
    """Declared column order and types; a missing column fails the analysis."""
    types = types or {}
    return df.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in columns])


def _write(df: DataFrame, path: str, parts: Sequence[str], sort: Sequence[str], batch: Batch, rows_per_file: int | None = None) -> None:
    """One layout for every table: its own partitions, then writer and batch, so that any two writers fit together."""
    number = reserve_append(df.sparkSession, path) if batch == JOB else batch.number
    out = df.withColumn("writer", F.lit(batch.writer)).withColumn("batch_id", F.lit(number).cast("bigint"))
    if sort and rows_per_file:
        out = out.repartitionByRange(*parts, *sort)
    if sort:
        out = out.sortWithinPartitions(*parts, *sort)
    writer = out.write.option("maxRecordsPerFile", rows_per_file or 0).mode("append" if batch == JOB else "overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*parts, "writer", "batch_id").parquet(path)
    if batch == JOB:
        create_file(df.sparkSession, f"{path}/{_APPENDS}/{number}.done")


def create_file(spark: SparkSession, path: str, text: str = "") -> bool:
    """Create a file that nobody else has created; false if somebody has."""
    fs, target = _filesystem(spark, path)
    try:
        out = fs.create(target, False)
    except Py4JJavaError:
        if fs.exists(target):
            return False
        raise
    out.writeBytes(text)
    out.close()
    return True


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, target = _filesystem(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(target)] if fs.exists(target) else []


def reserve_append(spark: SparkSession, path: str) -> int:
    """The next number of a job's append to a table; no two jobs get the same one."""
    taken = [int(n) for n in _names(spark, f"{path}/{_APPENDS}") if n.isdigit()]
    number = max(taken, default=-1) + 1
    while not create_file(spark, f"{path}/{_APPENDS}/{number}"):
        number += 1
    return number


def finished_appends(spark: SparkSession, path: str) -> set[int]:
    return {int(n.removesuffix(".done")) for n in _names(spark, f"{path}/{_APPENDS}") if n.endswith(".done")}


def append_table(df: DataFrame, table: TableSpec, base: str, batch: Batch = JOB, rows_per_file: int | None = None) -> None:
    """Append, by day and sorted within the files.

    With ``rows_per_file`` the append is dealt over tasks by ranges of day and sort key and cut into files of at most so many
    rows: each file has a narrow range of the key, and readers skip files and row groups by it.  That costs a shuffle; rows
    that agree in the whole sort key, which should end in a time, are the only ones that cannot be split.
    """
    out = declared(df, table.columns)
    if table.time_column:
        out = out.withColumn("dt", F.to_date(table.time_column))
    _write(out, f"{base}/{table.name}", ["dt"] if table.time_column else [], [c for c in table.sort_key if c in out.columns], batch, rows_per_file)


_ASIDE = ".replacing"

#: One schema per kind of metric, whoever writes it.
METRIC_TYPES = {
    "counter": {"metric_value": "decimal(21,0)"},
    "gauge": {"metric_value": "double"},
}


def write_demux(df: DataFrame, base: str, kind: str, target: str = "target_table", time_column: str = "observation_time",
                sort_key: Sequence[str] = ("metric_name", "id", "observation_time"), batch: Batch = JOB) -> None:
    """Rows to the table named in ``target``, all of them in one write below ``base``, with the kind's schema."""
    out = declared(df, (target, *METRIC_COLUMNS), METRIC_TYPES[kind]).withColumn("dt", F.to_date(time_column))
    _write(out, f"{base}/metrics_{kind}", [target, "dt"], sort_key, batch)


def read_table(spark: SparkSession, base: str, name: str, schema: str | None = None) -> DataFrame | None:
    """A table below ``base``, None while it has not been written."""
    path = f"{base}/{name}"
    if not path_exists(spark, path):
        return None
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def _filesystem(spark: SparkSession, path: str):
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _filesystem(spark, path)
    return bool(fs.exists(target))


def _found(spark: SparkSession, pattern: str) -> list[str]:
    """Folders that match a pattern."""
    fs, target = _filesystem(spark, pattern)
    return sorted(status.getPath().toString() for status in fs.globStatus(target) or [] if status.isDirectory())


def read_batch(spark: SparkSession, table: TableSpec, base: str, batch: Batch) -> DataFrame | None:
    """The rows that one batch wrote, from its own folders; None if it wrote none."""
    days = "dt=*/" if table.time_column else ""
    paths = _found(spark, f"{base}/{table.name}/{days}writer={batch.writer}/batch_id={batch.number}")
    return spark.read.option("basePath", f"{base}/{table.name}").parquet(*paths) if paths else None


def cutoff_day(as_of: datetime, keep_days: int) -> date:
    return (as_of - timedelta(days=keep_days)).date()


def apply_retention(spark: SparkSession, table: TableSpec, base: str, as_of: datetime) -> list[str]:
    """Drop whole day partitions that ended before the cut-off; returns their days.

    Days stand at the root of a table or, in demultiplexed ones, below the target's folder.
    """
    if table.keep_days is None:
        return []
    limit, dropped = cutoff_day(as_of, table.keep_days).isoformat(), set()
    for pattern in ("dt=*", "*=*/dt=*"):
        for path in _found(spark, f"{base}/{table.name}/{pattern}"):
            day = path.rsplit("/", 1)[1]
            if day[3:] < limit:
                fs, target = _filesystem(spark, path)
                fs.delete(target, True)
                dropped.add(day)
    return sorted(dropped)


def retained(df: DataFrame, time_column: str, keep_days: int, as_of) -> DataFrame:
    """J3 on the read path: rows of days that are still kept; the raw column is compared, so the filter reaches the files."""
    limit = F.date_sub(F.to_date(as_of), keep_days)
    kept = df.filter(F.col(time_column) >= limit.cast(df.schema[time_column].dataType))
    return kept.filter(F.col("dt") >= limit) if "dt" in df.columns else kept


def write_kv(rows: DataFrame, base: str, name: str = "kv", batch: Batch = JOB) -> None:
    """Append entries; the newest per key is what ``kv_view`` reads."""
    _write(rows, f"{base}/{name}", ["table"], (), batch)


def compact_kv(spark: SparkSession, view: DataFrame, base: str, name: str, generation: int) -> None:
    """Replace all entries written so far by ``view``, their newest live ones.

    The view goes to a writer of its own before the folders that it was made from are deleted; until then both are
    read, which does not change the newest entry of a key.
    """
    old = _found(spark, f"{base}/{name}/table=*/writer=*/batch_id=*")
    batch = Batch("compact", generation)
    if any(p.endswith(f"writer={batch.writer}/batch_id={batch.number}") for p in old):
        raise ValueError(f"generation {generation} has been written")
    write_kv(view, base, name, batch)
    for path in old:
        fs, target = _filesystem(spark, path)
        fs.delete(target, True)


def batch_folders(spark: SparkSession, table: TableSpec, base: str, before: date) -> list[str]:
    """What has been written so far for days before ``before``: one folder per day, writer and batch."""
    return [p for p in _found(spark, f"{base}/{table.name}/dt=*/writer=*/batch_id=*") if p.split("/dt=", 1)[1][:10] < before.isoformat()]


def replace_folders(spark: SparkSession, rows: DataFrame, table: TableSpec, base: str, old: Sequence[str], generation: int) -> None:
    """Replace the folders ``old`` by ``rows``, in steps that another run can finish; what came later stays."""
    aside = f"{base}/{table.name}{_ASIDE}"
    spark.createDataFrame([(p,) for p in old], "value string").write.mode("overwrite").text(f"{aside}/_old")  # one line per folder
    out = declared(rows, table.columns).withColumn("dt", F.to_date(table.time_column))
    _write(out, f"{aside}/rows", ["dt"], (), Batch("compact", generation))  # Spark marks a complete write with _SUCCESS
    finish_replacement(spark, table, base)


def finish_replacement(spark: SparkSession, table: TableSpec, base: str) -> None:
    """Put a complete write aside in the place of the folders it stands for; an incomplete one is dropped."""
    aside = f"{base}/{table.name}{_ASIDE}"
    fs, target = _filesystem(spark, aside)
    if not fs.exists(target):
        return
    if path_exists(spark, f"{aside}/rows/_SUCCESS"):
        for row in spark.read.text(f"{aside}/_old").collect():
            fs.delete(_filesystem(spark, row.value)[1], True)
        for path in _found(spark, f"{aside}/rows/dt=*/writer=*/batch_id=*"):
            place = _filesystem(spark, f"{base}/{table.name}/{path.split('/rows/', 1)[1]}")[1]
            fs.mkdirs(place.getParent())
            fs.rename(_filesystem(spark, path)[1], place)
    fs.delete(target, True)


def index_file_name(spec_text: str, simple: bool = True) -> str:
    """Name of an exported subnet index from its lookup spec."""
    return "ip_trie_" + (spec_text.split(":", 1)[0] if simple else spec_text.replace(":", "."))


def export_index(index: DataFrame, base: str, spec_text: str, simple: bool = True) -> str:
    """Replace the exported subnet index, and beside it what searches need."""
    path = f"{base}/{index_file_name(spec_text, simple)}"
    _replace(index, path)
    stored = index.sparkSession.read.parquet(path)
    _replace(length_counts(stored).coalesce(1), f"{path}.lengths")
    counts = counts_of(index.sparkSession.read.parquet(f"{path}.lengths"))
    _replace(search_entries(stored, counts) if needs_search(counts) else stored.select("family", "plen", "hi", "lo", F.col("plen").alias("best")).limit(0), f"{path}.search")
    return path


def _replace(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def read_index(spark: SparkSession, base: str, spec_text: str, simple: bool = True) -> PrefixIndex | None:
    """An exported subnet index, None while there is none."""
    name = index_file_name(spec_text, simple)
    rows, search, lengths = (read_table(spark, base, f"{name}{part}") for part in ("", ".search", ".lengths"))
    if rows is None or search is None or lengths is None:
        return None
    counts = counts_of(lengths)
    return PrefixIndex(rows, search if needs_search(counts) else None, counts)
