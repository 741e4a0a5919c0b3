"""Equi lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telescry.operators.snapshot import LookupSpec, explode_zipped, key_index, latest, lookup_rows, unmapped

#: What the flow lookups read of the device and interface tables.
DEVICE_LOOKUP, INTERFACE_LOOKUP = "meta_device:@loopback_ip", "meta_interface:device_id:flow_index:edge"


def lookup_join(df: DataFrame, right: DataFrame | None, on: Mapping[str, str], fields: Mapping[str, str],
                how: str = "left") -> DataFrame:
    """Add ``fields`` (right name -> new name) of the row whose key equals ours.

    ``right`` holds one row per key.  A null key or a miss gives null; no lookup configured gives
    nulls for every row.
    """
    if right is None:
        nulls = df.select("*", *[F.lit(None).cast("string").alias(n) for n in fields.values()])
        return nulls if how == "left" else nulls.limit(0)
    side = right.select(
        *[F.col(r).alias(left) for left, r in on.items()], *[F.col(f).alias(n) for f, n in fields.items()])
    return df.join(side, list(on), how)


def as_text_key(df: DataFrame | None, key: str = "id") -> DataFrame | None:
    return None if df is None else df.withColumn(key, F.col(key).cast("string"))


def lookup_array(df: DataFrame, key: str, ids: str, right: DataFrame | None, out: str,
                 keep_misses: bool = True, right_id: str = "id", right_value: str = "ref", stored: bool = False) -> DataFrame:
    """Look up every element of an array column of a table with unique ``key``.

    ``keep_misses`` keeps nulls in place (index-aligned), otherwise they are removed.  The row travels
    with its elements and is put together again by its key, so the input is evaluated once and a group
    is never larger than one row's own array.  A ``stored`` input (a table, a checkpoint) is read twice
    instead: only keys and elements are shuffled and the result is joined back.
    """
    empty = F.array().cast("array<string>")
    if right is None:
        value = F.transform(ids, lambda _: F.lit(None).cast("string")) if keep_misses else empty
        return df.withColumn(out, F.coalesce(value, empty))
    wanted = F.filter("_items", lambda s: s.getField("_pos").isNotNull() if keep_misses else s.getField("_ref").isNotNull())
    refs = F.transform(F.array_sort(wanted), lambda s: s.getField("_ref"))
    pairs = F.collect_list(F.struct("_pos", "_ref")).alias("_items")
    if stored:
        items = df.select(key, F.posexplode(ids).alias("_pos", "_id"))
        grouped = lookup_join(items, right, {"_id": right_id}, {right_value: "_ref"}).groupBy(key).agg(pairs)
        return df.join(grouped.select(key, refs.alias(out)), key, "left").withColumn(out, F.coalesce(out, empty))
    items = df.select(F.struct(*df.columns).alias("_row"), F.posexplode_outer(ids).alias("_pos", "_id"))
    found = lookup_join(items, right, {"_id": right_id}, {right_value: "_ref"})
    grouped = found.groupBy(F.col(f"_row.{key}").alias("_key")).agg(F.first("_row").alias("_row"), pairs)
    return grouped.select("_row.*", refs.alias(out))


def preferred_interfaces(interfaces: DataFrame) -> DataFrame:
    """D8 dimension: per (device, flow index) the edge interface, else the other one; newest wins."""
    rows = lookup_rows(interfaces, LookupSpec.parse(INTERFACE_LOOKUP))
    rows = rows.withColumn("flow_index", F.col("flow_index").cast("string"))
    return latest(rows, ["device_id", "flow_index"], ["id", "ref", "edge"],
                  [F.col("edge"), F.col("max_insert_time"), F.col("id")])


def enrich_interface(df: DataFrame, preferred: DataFrame | None, device: str, index: str, direction: str) -> DataFrame:
    """Add ``{direction}_interface_{id,ref,edge}``."""
    names = {"id": f"{direction}_interface_id", "ref": f"{direction}_interface_ref", "edge": f"{direction}_interface_edge"}
    out = lookup_join(df, preferred, {device: "device_id", index: "flow_index"}, names)
    return out.withColumn(names["edge"], edge_flag(names["edge"]))


def edge_flag(column: str) -> Column:
    return F.coalesce(F.col(column).cast("boolean"), F.lit(False))


def devices_by_address(devices: DataFrame) -> DataFrame:
    """D9 dimension: loopback address -> newest device."""
    rows = lookup_rows(devices, LookupSpec.parse(DEVICE_LOOKUP))
    rows = rows.withColumn("loopback_ip", unmapped(F.col("loopback_ip"))).filter(F.col("loopback_ip").isNotNull())
    return key_index(rows, ["loopback_ip"], ["id", "ref"])


def enrich_device(df: DataFrame, by_address: DataFrame | None, ip: str) -> DataFrame:
    """Add ``device_id`` (falls back to the address, then ``unknown``) and ``device_ref``."""
    out = lookup_join(df, by_address, {ip: "loopback_ip"}, {"id": "_device", "ref": "device_ref"})
    return out.withColumn("device_id", device_name("_device", ip)).drop("_device")


def device_name(found: str, ip: str) -> Column:
    return F.coalesce(F.col(found), F.nullif(F.col(ip), F.lit("")), F.lit("unknown"))


def chain(df: DataFrame, key: str, hops: Sequence[tuple[DataFrame | None, str, str, str]]) -> DataFrame:
    """Follow lookups one after the other; a hop is ``(table, its key, its value, new column)``."""
    at = key
    for table, table_key, value, name in hops:
        df = lookup_join(df, table, {at: table_key}, {value: name})
        at = name
    return df


def overlay(base: DataFrame, custom: DataFrame, key: str, present: str | None = None) -> DataFrame:
    """Custom rows override matching base rows and unmatched custom rows are appended.

    ``present`` names an array column of ``custom`` with the column names its record really has: only
    those override, a present null too.  Without it every non-null custom value overrides.
    """
    columns = [c for c in base.columns if c != key]
    theirs = [c for c in custom.columns if c not in (key, present)]
    side = custom.select(F.col(key).alias("_ckey"), *[F.col(c).alias(f"_c_{c}") for c in theirs],
                         (F.col(present) if present else F.lit(None).cast("array<string>")).alias("_present"))
    joined = base.join(side, F.col(key) == F.col("_ckey"), "full_outer")

    def pick(name: str) -> Column:
        mine, other = F.col(name), F.col(f"_c_{name}")
        if present:
            return F.when(F.array_contains("_present", name), other).otherwise(mine)
        return F.coalesce(other, mine)

    return joined.select(
        F.coalesce(key, "_ckey").alias(key),
        *[(pick(c) if c in theirs else F.col(c)).alias(c) for c in columns],
        *[F.col(f"_c_{c}").alias(c) for c in theirs if c not in columns],
    )


def refs_in_batch(batch: DataFrame, id_column: str = "id", ref_column: str = "ref") -> DataFrame:
    """Id -> ref of the records of the batch itself."""
    return batch.filter(F.col(ref_column).isNotNull()).select(F.col(id_column).alias("id"), F.col(ref_column).alias("ref"))


def resolve_in_batch(batch: DataFrame, refs: DataFrame, field_name: str) -> DataFrame:
    """D17 for one scalar pair ``X_id`` / ``X_ref``: only a hit replaces the reference."""
    out = lookup_join(batch, refs, {f"{field_name}_id": "id"}, {"ref": "_own"})
    return out.withColumn(f"{field_name}_ref", F.coalesce("_own", f"{field_name}_ref")).drop("_own")


def resolve_list_in_batch(batch: DataFrame, refs: DataFrame, field_name: str, key: str = "id", stored: bool = False) -> DataFrame:
    """D17 for one list pair: in-batch references first, looked-up ones where the batch has none."""
    out = lookup_array(batch, key, f"{field_name}_id", refs, "_own", stored=stored)
    merged = F.zip_with("_own", f"{field_name}_ref", lambda own, old: F.coalesce(own, old))
    return out.withColumn(f"{field_name}_ref", merged).drop("_own")


__all__ = [
    "as_text_key", "chain", "devices_by_address", "enrich_device", "enrich_interface", "explode_zipped",
    "lookup_array", "lookup_join", "overlay", "preferred_interfaces", "refs_in_batch", "resolve_in_batch",
    "resolve_list_in_batch",
]
