"""Current state of append-only tables.

All reductions are ``max_by`` aggregates, so rows of one key combine map-side and a hot key never
gathers in one task the way a per-key window would.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class LookupSpec:
    """``table[:field][:@array_field]...``; ``@`` fields are exploded."""

    table: str
    fields: tuple[str, ...] = ()
    exploded: tuple[str, ...] = ()
    require_fields: bool = True

    @classmethod
    def parse(cls, text: str, require_fields: bool = True) -> "LookupSpec":
        table, *rest = text.split(":")
        return cls(
            table,
            tuple(f.lstrip("@") for f in rest),
            tuple(f[1:] for f in rest if f.startswith("@")),
            require_fields,
        )


def version_number(ref: Column) -> Column:
    """``x__v12`` -> 12, null without that ending."""
    return F.regexp_extract(ref, r"__v(\d+)$", 1).try_cast("bigint")


def latest(df: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Sequence[Column],
           newest: str | None = None) -> DataFrame:
    """One row per key: all ``columns`` from the row with the greatest ``order``."""
    picked = F.max_by(F.struct(*columns), F.struct(*order))
    extra = [F.max(order[0]).alias(newest)] if newest else []
    out = df.groupBy(*keys).agg(picked.alias("_row"), *extra)
    return out.select(*keys, *([newest] if newest else []), *[F.col(f"_row.{c}").alias(c) for c in columns])


def current(df: DataFrame, columns: Sequence[str] = ("ref", "hash")) -> DataFrame:
    """Latest version per id; equal insert times are ordered by the version number."""
    rows = df.filter(F.col("id").isNotNull() & F.col("ref").isNotNull())
    return latest(rows, ["id"], list(columns), [F.col("insert_time"), version_number(F.col("ref")), F.col("ref")])


def lookup_rows(df: DataFrame, spec: LookupSpec, versioned: bool = True) -> DataFrame:
    """C1 + C2 + C3: latest ``id, ref, fields`` per id, with rows lacking a named field left out first."""
    rows = df.filter(F.col("id").isNotNull())
    if versioned:
        rows = rows.filter(F.col("ref").isNotNull())
    if spec.require_fields:
        for name in spec.fields:
            rows = rows.filter(F.col(name).isNotNull())
    payload = (["ref"] if versioned else []) + list(spec.fields)
    order = [F.col("insert_time")] + ([version_number(F.col("ref")), F.col("ref")] if versioned else [])
    return explode_zipped(latest(rows, ["id"], payload, order, newest="max_insert_time"), spec.exploded)


def explode_zipped(df: DataFrame, arrays: Sequence[str]) -> DataFrame:
    """One row per element; several arrays are walked together; empty arrays drop the row."""
    if not arrays:
        return df
    kept = [c for c in df.columns if c not in arrays]
    zipped = F.arrays_zip(*[F.col(a) for a in arrays])
    return df.select(*kept, F.explode(zipped).alias("_z")).select(
        *kept, *[F.col("_z").getField(a).alias(a) for a in arrays])


def key_index(rows: DataFrame, keys: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """C4: newest row per composite key (ties: greatest id)."""
    return latest(rows, list(keys), list(payload), [F.col("max_insert_time"), F.col("id")])


def key_text(df: DataFrame, keys: Sequence[str]) -> Column:
    """C4: text form of a composite key: non-null parts joined by ``:``, booleans as ``True``/``False``."""
    kinds = dict(df.dtypes)

    def part(name: str) -> Column:
        if kinds[name] == "boolean":
            return F.initcap(F.col(name).cast("string"))
        return unmapped(F.col(name).cast("string"))

    return F.concat_ws(":", *[part(k) for k in keys])


def unmapped(ip: Column) -> Column:
    """``::ffff:10.0.0.1`` -> ``10.0.0.1``."""
    return F.regexp_replace(ip, r"^::ffff:(?=\d+\.)", "")


def coalesce_latest(df: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Column) -> DataFrame:
    """Per key and column the latest value that is not null."""
    picks = [
        F.expr(f"max_by(`{c}`, _order) FILTER (WHERE `{c}` IS NOT NULL)").alias(c) for c in columns
    ]
    return df.withColumn("_order", order).groupBy(*keys).agg(*picks)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Last inserted row per key."""
    rest = [c for c in df.columns if c not in keys]
    return latest(df, list(keys), rest, list(order)).select(*df.columns)


def live(df: DataFrame, as_of: Column, updated: str = "updated_at", expires: str = "expires") -> DataFrame:
    """Rows whose time to live has not run out; null or 0 seconds never expires."""
    ttl = F.coalesce(F.col(expires), F.lit(0))
    end = F.timestamp_seconds(F.unix_timestamp(F.col(updated).cast("timestamp")) + ttl)
    return df.filter((ttl <= 0) | (end > as_of))
