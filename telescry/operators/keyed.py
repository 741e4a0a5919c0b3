"""Key-value tables built from metadata and device polls.

A key-value table has the columns ``table, key, value, updated_at, expires``; a keyed-hash table has
``table, key, field, value, updated_at, expires``.  Both are append-only and read through ``kv_view`` /
``hash_view``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telescry.functions.snmp import positional_pattern
from telescry.functions.text import short_hostname, strip_trailing_slashes, truthy
from telescry.operators.predicates import all_present
from telescry.operators.snapshot import LookupSpec, coalesce_latest, key_text, live, lookup_rows

DEFAULT_TTL_S = 86400
UUID_PATTERN = "^[0-9a-fA-F-]{36}$"


def kv_refs(df: DataFrame, spec: LookupSpec, text: str) -> DataFrame:
    """``table:id -> ref`` or, with fields, ``table__fields:values -> id``."""
    rows = lookup_rows(df, spec)
    if spec.fields:
        key = F.concat_ws(":", F.lit(text.replace(":", "__")), key_text(rows, spec.fields))
        return rows.select(F.lit(text).alias("table"), key.alias("key"), F.col("id").alias("value"), "max_insert_time")
    key = F.concat_ws(":", F.lit(spec.table), "id")
    return rows.select(F.lit(text).alias("table"), key.alias("key"), F.col("ref").alias("value"), "max_insert_time")


def kv_load_stats(refs: DataFrame, as_of: Column) -> DataFrame:
    """One statistics row per loaded table."""
    return refs.groupBy("table").agg(F.count(F.lit(1)).alias("record_count")).withColumn("last_updated", as_of)


ORDER_SCHEMA = "struct<at:timestamp, partition:int, offset:bigint>"


def message_order() -> Column:
    """The place of a message among others of one load: its time, then partition and offset."""
    return F.struct(F.col("message_time").alias("at"), "partition", "offset").cast(ORDER_SCHEMA)


def time_order(at: Column) -> Column:
    """The place of a record that only has a time."""
    return F.struct(at.cast("timestamp").alias("at"), F.lit(0).alias("partition"), F.lit(0).cast("bigint").alias("offset")).cast(ORDER_SCHEMA)


def kv_rows(df: DataFrame, as_of: Column, ttl: int | None = DEFAULT_TTL_S, order: Column | None = None) -> DataFrame:
    """Rows ready to append; rows without table, key or value are left out.

    ``order`` tells which of several values of a key in one load is the newest.
    """
    good = df.filter(truthy(F.col("table")) & truthy(F.col("key")) & truthy(F.col("value").cast("string")))
    return good.select("table", "key", F.col("value").cast("string").alias("value"), as_of.cast("timestamp").alias("updated_at"),
                       F.lit(ttl).cast("int").alias("expires"), (F.lit(None).cast(ORDER_SCHEMA) if order is None else order).alias("seq"))


def _newest(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The entry of the latest load per key, in it the last by its order."""
    order = F.struct("updated_at", *(["seq"] if "seq" in df.columns else []), "value")
    kept = [c for c in ("value", "updated_at", "expires", "seq") if c in df.columns]
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*kept), order).alias("r"))
    return newest.select(*keys, *[F.col(f"r.{c}").alias(c) for c in kept])


def kv_view(kv: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Latest value per ``(table, key)``, without entries whose time to live has run out."""
    out = _newest(kv, ["table", "key"])
    return out if as_of is None else live(out, as_of)


def to_write(newest: DataFrame, known: DataFrame, as_of: Column) -> DataFrame:
    """Entries that change a value, or that have used up half of their time to live; the others need not be appended again."""
    old = known.select("table", "key", F.col("value").alias("_value"), F.col("updated_at").alias("_updated"))
    fresh = F.unix_timestamp(as_of) - F.unix_timestamp("_updated") < F.coalesce(F.col("expires"), F.lit(1 << 30)) / 2
    same = F.col("_value").eqNullSafe(F.col("value")) & fresh
    return newest.join(old, ["table", "key"], "left").filter(~F.coalesce(same, F.lit(False))).select(*newest.columns)


def kv_table(kv: DataFrame, name: str) -> DataFrame:
    return kv.filter(F.col("table") == name).select("key", "value")


# --- C10: index lookups from device polls ----------------------------------------------------------

def path_value(path: Sequence[str]) -> Column:
    """Value at a rule path; ``tags`` and ``fields`` are text maps, the rest plain columns."""
    head, *rest = path
    value = F.col(head)
    for key in rest:
        value = F.element_at(value, F.lit(key))
    return value.cast("string")


def _short(value: Column, kind: str | None) -> Column:
    return short_hostname(value) if kind == "short_hostname" else value


def _builder(rule_name: str, builder: Mapping) -> Column | None:
    """One lookup entry of a rule as a struct, null unless name, key and value paths are there."""
    parts = [k for k in builder.get("key", []) if k.get("type") == "field"]
    target = builder.get("value", {})
    if not builder.get("name") or target.get("type") != "field":
        return None
    raw = [path_value(k["path"]) for k in parts]
    value = path_value(target["path"])
    present = F.col("name") == rule_name
    for c in [*raw, value]:
        present = present & c.isNotNull()
    key = F.concat_ws("::", *[_short(c, k.get("format")) for c, k in zip(raw, parts)])
    return F.when(present, F.struct(F.lit(builder["name"]).alias("table"), key.alias("key"),
                                    _short(value, target.get("format")).alias("value")))


def index_lookup(df: DataFrame, rules: Mapping, keep: Sequence[str] = ()) -> DataFrame:
    """Lookup entries of all rules in one pass over the messages."""
    entries = [
        _builder(name, b) for name, rule in rules.items() if isinstance(rule, Mapping)
        for b in rule.get("resource_lookup_tables", []) or []
    ]
    entries = [e for e in entries if e is not None]
    if not entries:
        return df.select(*keep, *[F.lit(None).cast("string").alias(c) for c in ("table", "key", "value")]).filter(F.lit(False))
    return df.select(*keep, F.explode(F.array_compact(F.array(*entries))).alias("e")).select(*keep, "e.*")


def invert_refs(df: DataFrame, uris: str, table: str, id_column: str = "id", keep: Sequence[str] = ()) -> DataFrame:
    """C11: child id (last URI segment that looks like a UUID) -> parent id."""
    rows = df.filter(truthy(F.col(id_column))).select(*keep, F.col(id_column).alias("value"), F.explode(uris).alias("_uri"))
    key = F.substring_index(strip_trailing_slashes(F.col("_uri")), "/", -1)
    return rows.select(*keep, F.lit(table).alias("table"), key.alias("key"), "value").filter(F.col("key").rlike(UUID_PATTERN))


# --- C12 / C13: interface records as keyed hashes --------------------------------------------------

INTERFACE_POLL_SCHEMA = (
    "meta struct<id:string, name:string, device:string, descr:string, intercloud:string, if_index:string, "
    "vrtr_ifglobalindex:string, vrtr_ifindex:string, vrtr_name:string, vrtr_ifencapvalue:string, sap_name:string, "
    "ipv4:string, ipv6:string, speed:string, service_type:string, is_lag:boolean, port_name:string, "
    "visibility:boolean, circuits:struct<id:array<string>>, lag_members:array<string>, "
    "peer:struct<asn:string, ipv4:string, ipv6:string>, remote:struct<id:string>, org:struct<short_name:string>>"
)


def interface_records(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Device poll -> interface entity record (all values as text), with the ``keep`` columns of the poll."""
    m = lambda name: F.col(f"meta.{name}")
    rows = df.filter(all_present(["meta.id", "meta.name", "meta.device"]))
    kind = (
        F.when(truthy(m("service_type")), F.concat(F.lit("service_"), F.lower(m("service_type"))))
        .when(truthy(m("vrtr_name")), F.lit("service_l3vpn"))
        .when(F.coalesce(m("is_lag"), F.lit(False)), F.lit("lag"))
        .when(truthy(m("port_name")), F.lit("interface"))
        .otherwise(F.lit("port"))
    )
    listed = F.from_json(m("intercloud"), "array<boolean>")
    edge = F.when(m("intercloud").startswith("["), F.when(F.size(listed) > 0, F.get(listed, F.lit(0)).cast("string"))).otherwise(
        m("intercloud"))
    index = F.when(truthy(m("if_index")), m("if_index")).when(truthy(m("vrtr_ifglobalindex")), m("vrtr_ifglobalindex"))
    hidden = F.coalesce(~m("visibility"), F.lit(False))
    empty = F.array().cast("array<string>")
    known = lambda c: F.when(truthy(c), c)
    ext = F.to_json(F.struct(
        known(m("vrtr_ifglobalindex")).alias("vrtr_interface_global_index"),
        known(m("vrtr_ifindex")).alias("vrtr_interface_index"), known(m("vrtr_name")).alias("vrtr_id"),
        known(m("vrtr_ifencapvalue")).alias("vrtr_interface_encap"), known(m("sap_name")).alias("sap_name")))
    return rows.select(
        m("id").alias("id"), kind.alias("type"), m("device").alias("device_id"), m("descr").alias("description"),
        edge.alias("edge"), index.alias("flow_index"), m("ipv4").alias("ipv4"), m("ipv6").alias("ipv6"),
        m("name").alias("name"), m("speed").alias("speed"),
        F.to_json(F.coalesce(m("circuits.id"), empty)).alias("circuit_id"),
        m("peer.asn").alias("peer_as_id"), m("peer.ipv4").alias("peer_interface_ipv4"),
        m("peer.ipv6").alias("peer_interface_ipv6"),
        F.to_json(F.coalesce(m("lag_members"), empty)).alias("lag_member_interface_id"),
        F.when(truthy(m("port_name")), F.concat_ws("::", m("device"), m("port_name"))).alias("port_interface_id"),
        m("remote.id").alias("remote_interface_id"), m("org.short_name").alias("remote_organization_id"),
        F.to_json(F.when(hidden, F.array(F.lit("hide"))).otherwise(empty)).alias("tags"), ext.alias("ext"), *keep,
    )


def name_from_id(df: DataFrame) -> DataFrame:
    """Fill a missing ``meta.name`` with the part of ``meta.id`` after the first ``::``."""
    own = F.when(F.col("meta.id").contains("::"), F.regexp_extract(F.col("meta.id"), "^.*?::(.*)$", 1))
    return df.withColumn("meta", F.col("meta").withField("name", F.coalesce("meta.name", own)))


def hash_rows(records: DataFrame, table: str, key: str, as_of: Column, ttl: int | None = DEFAULT_TTL_S) -> DataFrame:
    """Records -> one row per field that is not null; a column ``seq`` orders the records of one load."""
    names = [n for n in records.columns if n != "seq"]
    seq = F.col("seq") if "seq" in records.columns else F.lit(None).cast(ORDER_SCHEMA)
    pairs = F.array(*[F.struct(F.lit(n).alias("field"), F.col(n).cast("string").alias("value")) for n in names])
    long = records.select(F.lit(table).alias("table"), F.col(key).alias("key"), seq.alias("seq"), F.explode(pairs).alias("p"))
    long = long.select("table", "key", "p.field", "p.value", "seq").filter(truthy(F.col("key")) & F.col("value").isNotNull())
    return long.select("table", "key", "field", "value", as_of.cast("timestamp").alias("updated_at"), F.lit(ttl).cast("int").alias("expires"), "seq")


def hash_view(rows: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Latest value of every field; each field has its own time to live."""
    out = _newest(rows, ["table", "key", "field"])
    return out if as_of is None else live(out, as_of)


def hash_records(view: DataFrame, table: str, fields: Sequence[str]) -> DataFrame:
    """A10: keyed hashes of one table as wide rows, one column per field."""
    rows = view.filter(F.col("table") == table)
    picks = [F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in fields]
    return rows.groupBy("key").agg(*picks)


__all__ = [
    "coalesce_latest", "hash_records", "hash_rows", "hash_view", "index_lookup", "interface_records", "invert_refs",
    "kv_load_stats", "kv_refs", "kv_rows", "kv_table", "kv_view", "name_from_id", "path_value", "positional_pattern",
]
