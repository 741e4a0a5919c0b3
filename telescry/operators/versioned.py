"""Append-only versioned metadata.

``upsert_versions`` compares a staged batch with the current snapshot and returns the rows to append.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telescry.functions.text import content_hash, ext_or_default, parsed_once, string_array, to_double, to_flag, to_long
from telescry.operators.lookup import (
    as_text_key,
    lookup_array,
    lookup_join,
    refs_in_batch,
    resolve_in_batch,
    resolve_list_in_batch,
)
from telescry.operators.predicates import all_present
from telescry.operators.snapshot import current, version_number


@dataclass(frozen=True)
class EntitySpec:
    """One metadata table.

    ``fields`` maps a column to its kind: text, long, double, flag, texts (array) or cidrs.
    ``refs`` are ``(field, table)`` pairs: ``{field}_id`` is looked up in that table's snapshot and
    gives ``{field}_ref``; ``list_refs`` do the same for arrays.
    """

    table: str
    fields: Mapping[str, str]
    required: tuple[str, ...] = ("id",)
    refs: tuple[tuple[str, str], ...] = ()
    list_refs: tuple[tuple[str, str], ...] = ()
    self_refs: tuple[str, ...] = ()
    self_list_refs: tuple[str, ...] = ()
    pairs: tuple[str, ...] = ()  # array columns that must hold two items
    versioned: bool = True
    sort_key: tuple[str, ...] = ("ref", "id", "insert_time")
    id_type: str = "string"

    @property
    def content(self) -> list[str]:
        """Content columns in table order, without id, ref, hash."""
        names = ["ext", "tag"]
        refs = {f for f, _ in self.refs} | {f for f, _ in self.list_refs}
        for name in self.fields:
            names.append(name)
            stem = name.removesuffix("_id")
            if name.endswith("_id") and stem in refs:
                names.append(f"{stem}_ref")
        return names


def cidr_list(c: Column) -> Column:
    """JSON text ``[["10.0.0.0", 8], ...]`` -> CIDR structs; items that are no pair are dropped."""
    items = F.from_json(c, "array<array<string>>")
    typed = F.transform(items, lambda i: F.when(
        (F.size(i) == 2) & F.get(i, F.lit(1)).try_cast("int").isNotNull(),
        F.struct(F.get(i, F.lit(0)).alias("ip"), F.get(i, F.lit(1)).try_cast("int").alias("len"))))
    return F.coalesce(F.array_compact(typed), F.array().cast("array<struct<ip:string,len:int>>"))


_COERCE = {
    "text": lambda c: c,
    "long": to_long,
    "double": to_double,
    "flag": to_flag,
    "texts": string_array,
    "cidrs": cidr_list,
}


def wire_schema(spec: EntitySpec) -> str:
    """Every wire field is read as text, so numbers, JSON strings and JSON arrays are all accepted."""
    names = dict.fromkeys(["id", "ext", "tag", *spec.fields])
    return ", ".join(f"`{n}` string" for n in names)


def stage(rows: DataFrame, spec: EntitySpec, json: str = "row_json", pos: str = "pos") -> DataFrame:
    """record JSON -> typed content columns; records lacking a required field are dropped."""
    parsed = rows.select(F.col(pos).alias("_pos"), parsed_once(F.from_json(F.col(json), wire_schema(spec))).alias("r")).select("_pos", "r.*")
    parsed = parsed.filter(all_present([f"`{n}`" for n in spec.required]) & F.col("id").isNotNull())
    typed = parsed.select(
        "_pos", "id", ext_or_default(F.col("ext")).alias("ext"), string_array(F.col("tag")).alias("tag"),
        *[_COERCE[kind](F.col(f"`{name}`")).alias(name) for name, kind in spec.fields.items()],
    )
    for name in spec.pairs:
        typed = typed.filter(F.size(name) == 2)
    return typed


def last_per_id(staged: DataFrame) -> DataFrame:
    """The same id twice in one batch: the last record by input position counts."""
    if "_pos" not in staged.columns:
        return staged
    names = [c for c in staged.columns if c not in ("id", "_pos")]
    picked = staged.groupBy("id").agg(F.max_by(F.struct(*[F.col(f"`{n}`") for n in names]), "_pos").alias("_r"))
    return picked.select("id", *[F.col(f"_r.`{n}`").alias(n) for n in names])


def with_refs(staged: DataFrame, spec: EntitySpec, snapshots: Mapping[str, DataFrame],
              cut: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Reference columns from the current snapshots (``id, ref``); a table not given counts as empty.

    With ``cut`` the batch is stored before list references are resolved, so that only ids and list items are shuffled.
    """
    staged = last_per_id(staged)
    if spec.list_refs and cut:
        staged = cut(staged)
    for name, table in spec.refs:
        right = as_text_key(snapshots.get(table))
        keyed = staged.withColumn("_rid", F.col(f"{name}_id").cast("string"))
        staged = lookup_join(keyed, right, {"_rid": "id"}, {"ref": f"{name}_ref"}).drop("_rid")
    for name, table in spec.list_refs:
        staged = lookup_array(staged, "id", f"{name}_id", as_text_key(snapshots.get(table)), f"{name}_ref", stored=cut is not None)
    return staged


def next_ref(id_: Column, old_ref: Column) -> Column:
    """``x__v3`` -> ``x__v4``; null when the old reference holds no version."""
    version = version_number(old_ref)
    return F.when(version.isNotNull(), F.concat(id_, F.lit("__v"), (version + 1).cast("string")))


def upsert_versions(staged: DataFrame, now: DataFrame | None, spec: EntitySpec, force: bool = False,
                    cut: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Rows to append, with ``ref`` and ``hash``.

    A new id gets ``__v1``, an unchanged one is skipped, a changed (or forced) one gets the next
    version; one whose current reference holds no version is skipped.  Records that point at records
    of the same batch get their new references, are hashed again and compared again.  ``cut`` is applied
    to the batch before that second pass, which reads it once per reference column.
    """
    batch = last_per_id(staged)
    if not spec.versioned:
        return batch.select("id", *[F.col(f"`{c}`") for c in spec.content])
    content = ["id", *spec.content]
    hashed = batch.withColumn("hash", content_hash(content))
    old = None if now is None else now.select(F.col("id").cast("string").alias("id"), "ref", "hash")
    compared = lookup_join(hashed, old, {"id": "id"}, {"ref": "_old_ref", "hash": "_old_hash"})
    known = F.col("_old_ref").isNotNull()
    same = known & (F.col("_old_hash") == F.col("hash")) & F.lit(not force)
    first = F.concat(F.col("id"), F.lit("__v1"))
    bumped = next_ref(F.col("id"), F.col("_old_ref"))
    decided = compared.withColumn("ref", F.when(~known, first).when(same, F.col("_old_ref")).otherwise(bumped))
    decided = decided.filter(F.col("ref").isNotNull())
    out_columns = ["id", "ref", "hash", *[F.col(f"`{c}`") for c in spec.content]]
    if not (spec.self_refs or spec.self_list_refs):
        return decided.filter(~(known & (F.col("ref") == F.col("_old_ref")))).select(*out_columns)

    decided = cut(decided) if cut else decided
    refs = refs_in_batch(decided)
    for name in spec.self_list_refs:  # first, while the batch is still the stored one
        decided = resolve_list_in_batch(decided, refs, name, stored=cut is not None)
    for name in spec.self_refs:
        decided = resolve_in_batch(decided, refs, name)
    final = decided.withColumn("hash", content_hash(content))
    unchanged = known & (F.col("hash") == F.col("_old_hash")) & F.lit(not force)
    moved = known & (F.col("ref") == F.col("_old_ref"))  # changed through its references only
    final = final.withColumn("ref", F.when(moved, bumped).otherwise(F.col("ref")))
    return final.filter(~unchanged & F.col("ref").isNotNull()).select(*out_columns)


def apply_batch(staged: DataFrame, table: DataFrame | None, spec: EntitySpec,
                snapshots: Mapping[str, DataFrame], as_of: Column, force: bool = False,
                cut: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Stage -> references -> versions -> rows stamped with ``insert_time``."""
    now = current(table) if table is not None and spec.versioned else None
    return apply_to_current(staged, now, spec, snapshots, as_of, force, cut)


def apply_to_current(staged: DataFrame, now: DataFrame | None, spec: EntitySpec,
                     snapshots: Mapping[str, DataFrame], as_of: Column, force: bool = False,
                     cut: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``apply_batch`` where the current versions (``id, ref, hash``) are at hand."""
    rows = upsert_versions(with_refs(staged, spec, snapshots, cut), now, spec, force, cut)
    if spec.id_type != "string":
        rows = rows.withColumn("id", F.col("id").try_cast(spec.id_type)).filter(F.col("id").isNotNull())
    return rows.withColumn("insert_time", as_of)


def content_columns(specs: Sequence[EntitySpec]) -> dict[str, list[str]]:
    return {s.table: s.content for s in specs}
