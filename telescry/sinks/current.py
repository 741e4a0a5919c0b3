"""Kept views: the current state of an append-only table, merged from the last appends only.

A view is the result of a reduction that can be applied to its own results: ``reduce(reduce(a) + b) = reduce(a + b)``, as
"the latest row per key" can.  It is stored in generations below ``current/{view}``.  A generation is a folder of rows and a pointer, a
small file created after the rows are complete, which names the folder and the appends that it holds.  Readers take the
newest pointer and reduce its rows with the rows of the appends that it does not hold, from their own folders; with none
left they read the generation as it is, without a shuffle.  Views of one row per id are bucketed by id (F3): what is joined to them by id, be
it the last appends or a staged batch, is shuffled to their buckets, and they stay where they are.  So a reader's work does not grow with the history, a refresh that
breaks off changes nothing, and of two refreshes at once one wins.

Appends are folders of writer and number (see ``tables``).  A job's append counts as held once its end has been marked; of a stream's
batches the last one never does, as it may still be written.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telescry.entities.specs import EntitySpec
from telescry.operators import keyed
from telescry.operators.snapshot import LookupSpec, keep_last, latest, version_number
from telescry.sinks.tables import JOB, _filesystem, _found, _names, create_file, finished_appends

FOLDER = "current"


@dataclass(frozen=True)
class KeptView:
    """``columns`` of ``table``, reduced; with ``order``, to the row per ``id`` that comes last in it."""

    name: str
    table: str
    columns: tuple[str, ...]
    reduce: Callable[[DataFrame], DataFrame]
    order: Callable[[str], Column] | None = None

    def merge(self, kept: DataFrame, fresh: DataFrame) -> DataFrame:
        """The reduction of what is kept and of new rows."""
        fresh = fresh.select(*self.columns)
        if not self.order:
            return self.reduce(kept.select(*self.columns).unionByName(fresh))
        sides = [df.select(F.col("id").alias(f"{n}_id"), F.struct(*self.columns).alias(n)) for n, df in (("old", kept), ("new", self.reduce(fresh)))]
        both = sides[0].join(sides[1], F.col("old_id") == F.col("new_id"), "full_outer")
        newer = F.col("new").isNotNull() & (F.col("old").isNull() | (self.order("new") > self.order("old")))
        return both.select(F.when(newer, F.col("new")).otherwise(F.col("old")).alias("row")).select("row.*")


def version_view(spec: EntitySpec) -> KeptView:
    """Id, ref, hash and insert_time of the current version of each id."""
    return latest_version_view(spec.table, ("hash",))


def latest_version_view(table: str, columns: Sequence[str] = ()) -> KeptView:
    return _latest_view(f"{table}.versions", table, tuple(columns), ())


def lookup_view(text: str) -> KeptView:
    """C1 + C2: the latest id, ref and fields per id of rows that have all fields; ``lookup_rows`` gives the same from it as from the table."""
    spec = LookupSpec.parse(text)
    return _latest_view(text.replace(":", ".").replace("@", ""), spec.table, spec.fields, spec.fields)


def _latest_view(name: str, table: str, columns: tuple[str, ...], needed: tuple[str, ...]) -> KeptView:
    def reduce(rows: DataFrame) -> DataFrame:
        for c in ("id", "ref", *needed):
            rows = rows.filter(F.col(c).isNotNull())
        order = [F.col("insert_time"), version_number(F.col("ref")), F.col("ref")]
        return latest(rows, ["id"], ["ref", *columns, "insert_time"], order)

    def order(side: str) -> Column:
        ref = F.col(f"{side}.ref")
        return F.struct(F.col(f"{side}.insert_time").alias("at"), F.coalesce(version_number(ref), F.lit(-1)).alias("version"), ref.alias("ref"))

    return KeptView(name, table, ("id", "ref", *columns, "insert_time"), reduce, order)


def last_view(spec: EntitySpec) -> KeptView:
    """The last inserted row per sort key of an unversioned table."""
    names = ("id", *spec.content, "insert_time")
    return KeptView(f"{spec.table}.last", spec.table, names, lambda rows: keep_last(rows, list(spec.sort_key), [F.col("insert_time")]))


#: The newest entry per key; entries past their time to live are left out by readers.
KV_VIEW = KeptView("kv.newest", "kv", ("table", "key", "value", "updated_at", "expires", "seq"), keyed.kv_view)
HASH_VIEW = KeptView("kv_hash.newest", "kv_hash", ("table", "key", "field", "value", "updated_at", "expires", "seq"), keyed.hash_view)


@dataclass(frozen=True)
class Pointer:
    """Number and folder of a generation, the highest held batch per stream, and the held appends of jobs: all below ``upto``, and ``more``."""

    number: int
    folder: str
    streams: Mapping[str, int]
    upto: int
    more: frozenset[int]
    buckets: int = 0
    schema: str = ""

    def holds(self, writer: str, number: int) -> bool:
        if writer == JOB.writer:
            return number < self.upto or number in self.more
        return number <= self.streams.get(writer, -1)


_NOTHING = Pointer(-1, "", {}, 0, frozenset())


def _home(base: str, view: KeptView) -> str:
    return f"{base}/{FOLDER}/{view.name}"


def pointer(spark: SparkSession, base: str, view: KeptView) -> Pointer:
    """The newest pointer of a view."""
    numbers = [int(n) for n in _names(spark, f"{_home(base, view)}/_pointers") if n.isdigit()]
    if not numbers:
        return _NOTHING
    fs, path = _filesystem(spark, f"{_home(base, view)}/_pointers/{max(numbers)}")
    stream = fs.open(path)
    try:
        found = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Pointer(max(numbers), found["folder"], found["streams"], found["upto"], frozenset(found["more"]), found["buckets"], found["schema"])


def _appends(spark: SparkSession, base: str, table: str) -> dict[tuple[str, int], list[str]]:
    """Folders of each append of a table, by writer and number."""
    out: dict[tuple[str, int], list[str]] = {}
    for pattern in ("writer=*/batch_id=*", "*=*/writer=*/batch_id=*"):
        for path in _found(spark, f"{base}/{table}/{pattern}"):
            writer, number = path.rsplit("/writer=", 1)[1].split("/batch_id=")
            out.setdefault((writer, int(number)), []).append(path)
    return out


def _table_name(path: str) -> str:
    return "kept_" + hashlib.md5(path.encode()).hexdigest()


def _generation(spark: SparkSession, base: str, view: KeptView, held: Pointer) -> DataFrame | None:
    """The rows of a generation, with their buckets made known to the session's catalog."""
    if not held.folder:
        return None
    path = f"{_home(base, view)}/{held.folder}"
    if not held.buckets:
        return spark.read.parquet(path)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_table_name(path)} ({held.schema}) USING parquet CLUSTERED BY (id) SORTED BY (id) INTO {held.buckets} BUCKETS LOCATION '{path}'")
    return spark.table(_table_name(path))


def _rows(spark: SparkSession, base: str, view: KeptView, held: Pointer, new: Sequence[str]) -> DataFrame | None:
    kept = _generation(spark, base, view, held)
    if not new:
        return kept
    fresh = spark.read.option("basePath", f"{base}/{view.table}").parquet(*new).select(*view.columns)
    return view.reduce(fresh) if kept is None else view.merge(kept, fresh)


def read_kept(spark: SparkSession, base: str, view: KeptView) -> DataFrame | None:
    """The view as of now, whether refreshed or not; None while its table is empty."""
    held = pointer(spark, base, view)
    new = [p for (writer, number), paths in _appends(spark, base, view.table).items() if not held.holds(writer, number) for p in paths]
    return _rows(spark, base, view, held, new)


def _size(spark: SparkSession, paths: Sequence[str]) -> int:
    found = (_filesystem(spark, p) for p in paths)
    return sum(fs.getContentSummary(target).getLength() for fs, target in found)


def write_generation(spark: SparkSession, base: str, view: KeptView, rows: DataFrame, held: Pointer) -> tuple[str, int]:
    """Write the rows of the generation after ``held``, which no pointer names yet; returns its folder and number of buckets."""
    folder = f"{held.number + 1:010d}-{uuid.uuid4().hex[:8]}"
    path = f"{_home(base, view)}/{folder}"
    if not view.order:
        rows.write.parquet(path)
        return folder, 0
    buckets = held.buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if not held.buckets:  # later ones come from a join by bucket
        rows = rows.repartition(buckets, "id")
    rows.write.format("parquet").bucketBy(buckets, "id").sortBy("id").option("path", path).saveAsTable(_table_name(path))
    return folder, buckets


def refresh(spark: SparkSession, base: str, view: KeptView, share: float = 0.1, most: int = 64) -> int:
    """Merge complete appends into a new generation and point to it; returns the newest generation's number (-1: none).

    That is done when they hold more than ``share`` of the generation's bytes or are more than ``most``, so that small appends do
    not rewrite a large view one by one.  The generation before stays for readers that began with it; older ones go.
    """
    held = pointer(spark, base, view)
    appends = _appends(spark, base, view.table)
    done = finished_appends(spark, f"{base}/{view.table}")
    newest: dict[str, int] = {}
    for writer, number in appends:
        newest[writer] = max(number, newest.get(writer, -1))
    complete = {key for key in appends if (key[1] in done if key[0] == JOB.writer else key[1] < newest[key[0]])}
    new = sorted(key for key in complete if not held.holds(*key))
    paths = [p for key in new for p in appends[key]]
    if not new or (held.folder and len(new) <= most and _size(spark, paths) <= share * _size(spark, [f"{_home(base, view)}/{held.folder}"])):
        return held.number
    rows = _rows(spark, base, view, held, paths)
    folder, buckets = write_generation(spark, base, view, rows, held)
    more = set(held.more) | {n for w, n in new if w == JOB.writer}
    upto = held.upto
    while upto in more:
        more.discard(upto)
        upto += 1
    streams = dict(held.streams) | {w: n for w, n in sorted(new) if w != JOB.writer}
    text = json.dumps({"folder": folder, "streams": streams, "upto": upto, "more": sorted(more), "buckets": buckets, "schema": rows._jdf.schema().toDDL()})
    if not create_file(spark, f"{_home(base, view)}/_pointers/{held.number + 1}", text):
        _forget(spark, f"{_home(base, view)}/{folder}")  # another refresh was first
        return held.number + 1
    for name in _names(spark, f"{_home(base, view)}/_pointers"):
        if name.isdigit() and int(name) < held.number:
            _delete(spark, f"{_home(base, view)}/_pointers/{name}")
    for name in _names(spark, _home(base, view)):
        if name[:10].isdigit() and int(name[:10]) < held.number:
            _forget(spark, f"{_home(base, view)}/{name}")
    return held.number + 1


def _delete(spark: SparkSession, path: str) -> None:
    fs, target = _filesystem(spark, path)
    fs.delete(target, True)


def _forget(spark: SparkSession, path: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {_table_name(path)}")
    _delete(spark, path)
