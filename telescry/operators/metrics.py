"""Interface counters and generic metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from pathlib import Path

import yaml
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telescry.config import MetricConfig, Policy
from telescry.functions.snmp import address_text, port_name, positional_pattern, sap_name, sap_queue
from telescry.functions.text import duration_seconds, iso_timestamp, mapped, parsed_once, short_hostname, to_long, truthy
from telescry.functions.timing import interval_floor
from telescry.operators.keyed import path_value
from telescry.operators.lookup import lookup_join
from telescry.operators.predicates import any_present, route_metric

WIRE_SCHEMA = "name string, timestamp string, interval string, tags map<string,string>, fields string"

# Interface metric -> SNMP field, and those counted in octets.
INTERFACE_FIELDS = {
    "admin_status": "SNMP_IF-MIB::ifAdminStatus",
    "oper_status": "SNMP_IF-MIB::ifOperStatus",
    "in_bit_count": "SNMP_IF-MIB::ifHCInOctets",
    "in_discard_packet_count": "SNMP_IF-MIB::ifInDiscards",
    "in_error_packet_count": "SNMP_IF-MIB::ifInErrors",
    "in_bcast_packet_count": "SNMP_IF-MIB::ifHCInBroadcastPkts",
    "in_ucast_packet_count": "SNMP_IF-MIB::ifHCInUcastPkts",
    "in_mcast_packet_count": "SNMP_IF-MIB::ifHCInMulticastPkts",
    "out_bit_count": "SNMP_IF-MIB::ifHCOutOctets",
    "out_discard_packet_count": "SNMP_IF-MIB::ifOutDiscards",
    "out_error_packet_count": "SNMP_IF-MIB::ifOutErrors",
    "out_bcast_packet_count": "SNMP_IF-MIB::ifHCOutBroadcastPkts",
    "out_ucast_packet_count": "SNMP_IF-MIB::ifHCOutUcastPkts",
    "out_mcast_packet_count": "SNMP_IF-MIB::ifHCOutMulticastPkts",
}
OCTET_METRICS = ("in_bit_count", "out_bit_count")
STATUS_METRICS = ("admin_status", "oper_status")
# IF-MIB status codes.
ADMIN_STATUS = {"1": "up", "2": "down", "3": "testing"}
OPER_STATUS = {"1": "up", "2": "down", "3": "testing", "4": "unknown", "5": "dormant", "6": "notPresent", "7": "lowerLayerDown"}
# Resource status codes and the code of any other text.
RESOURCE_STATUS = {"up": 1, "degraded": 2, "down": 3, "unknown": 4}
OTHER_STATUS = 4
DEFAULT_SKIP_TAGS = ("date", "routing_tag", "collector")

COUNTER_TYPE = "decimal(21,0)"  # unsigned 64-bit counters, also times 8
TRAFFIC_KEYS = ("start_time", "end_time", "collector_id", "policy_originator", "policy_level", "policy_scope",
                "ext", "interface_id", "interface_ref")


def policy_cols(policy: Policy) -> list[Column]:
    return [
        F.lit(policy.originator).alias("policy_originator"),
        F.lit(policy.level).alias("policy_level"),
        F.array(*[F.lit(s) for s in policy.scope]).cast("array<string>").alias("policy_scope"),
    ]


def tokens(df: DataFrame) -> DataFrame:
    """Turn the ``fields`` JSON text into a map of value texts, keeping the text as ``fields_json``."""
    rest = [F.col(c) for c in df.columns if c != "fields"]
    return df.select(*rest, F.col("fields").alias("fields_json"), parsed_once(F.from_json("fields", "map<string,string>")).alias("fields"))


def scaled(c: Column, factor: int = 1) -> Column:
    """H3: whole number times factor, null for other text."""
    number = c.try_cast(COUNTER_TYPE)
    return (number * factor).try_cast(COUNTER_TYPE) if factor != 1 else number


def status_name(c: Column, names: Mapping[str, str]) -> Column:
    """H4: unknown codes pass through."""
    return F.coalesce(mapped(c, names), c)


def interface_traffic(df: DataFrame, index_lookup: DataFrame | None, refs: DataFrame | None,
                      cfg: MetricConfig = MetricConfig()) -> DataFrame:
    """H1-H4: one wide row per poll of a known interface; unknown indexes are dropped.

    ``index_lookup`` and ``refs`` are ``key, value`` tables: ``device::index -> name`` and interface
    id -> reference.
    """
    rows = tokens(df).select("*", F.element_at("tags", "device").alias("_dev"), F.element_at("tags", "oidIndex").alias("_idx"))
    rows = rows.filter(
        any_present(["name", "timestamp", "interval", "_dev", "_idx"])
        & route_metric(cfg.interface_metric_name, list(INTERFACE_FIELDS.values())))
    seconds = to_long(F.col("timestamp"))
    interval = F.when(F.element_at("tags", "interval").isNull(), F.lit(0)).otherwise(to_long(F.element_at("tags", "interval")))
    device = short_hostname(F.col("_dev")) if cfg.short_device else F.col("_dev")
    rows = rows.select(
        "*", interval.cast("bigint").alias("_interval"), F.coalesce(seconds, F.when(F.col("timestamp").isNull(), 0)).alias("_ts"),
        device.alias("_device"))
    rows = rows.filter(F.col("_interval").isNotNull() & F.col("_ts").isNotNull() & F.col("_device").isNotNull() & F.col("_idx").isNotNull())
    rows = rows.withColumn("_key", F.concat_ws("::", "_device", "_idx"))
    rows = lookup_join(rows, index_lookup, {"_key": "key"}, {"value": "_ifname"}, how="inner")
    rows = rows.filter(F.col("_ifname").isNotNull()).withColumn("interface_id", F.concat_ws("::", "_device", "_ifname"))
    rows = lookup_join(rows, refs, {"interface_id": "key"}, {"value": "interface_ref"})
    start = interval_floor(F.col("_ts"), F.col("_interval"))
    metrics = []
    for name, source in INTERFACE_FIELDS.items():
        value = F.element_at("fields", F.lit(source))
        if name == "admin_status":
            value = status_name(value, ADMIN_STATUS)
        elif name == "oper_status":
            value = status_name(value, OPER_STATUS)
        else:
            value = scaled(value, 8 if name in OCTET_METRICS else 1)
        metrics.append(value.alias(name))
    return rows.select(
        F.timestamp_seconds(start).alias("start_time"), F.timestamp_seconds(start + F.col("_interval")).alias("end_time"),
        F.coalesce(F.element_at("tags", "collector"), F.lit("unknown")).alias("collector_id"),
        *policy_cols(cfg.policy), F.lit("{}").alias("ext"), "interface_id", "interface_ref", *metrics)


# --- rules (L3) ------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Rules:
    """Rule file: metric name -> resource type, id parts, reference table, lookup builders."""

    by_name: Mapping[str, Mapping]

    @classmethod
    def load(cls, path: str | Path) -> "Rules":
        return cls.parse(Path(path).read_text())

    @classmethod
    def parse(cls, text: str) -> "Rules":
        return cls(yaml.safe_load(text) or {})

    @property
    def metric_rules(self) -> dict[str, Mapping]:
        return {n: r for n, r in self.by_name.items() if isinstance(r, Mapping) and r.get("resource_type")}

    def id_parts(self, rule: Mapping) -> list[Mapping]:
        parts = rule.get("resource_id") or (self.by_name.get("_default") or {}).get("resource_id") or []
        return [p for p in parts if p.get("type") == "field"]

    @property
    def usable(self) -> dict[str, Mapping]:
        """Rules that can name a resource."""
        has_default = bool((self.by_name.get("_default") or {}).get("resource_id"))
        return {n: r for n, r in self.metric_rules.items() if r.get("resource_id") or has_default}


def _per_rule(values: Mapping[str, Column | None], kind: str = "string") -> Column:
    """``CASE name WHEN rule THEN value ...``; rules without a value give null."""
    out = F.lit(None).cast(kind)
    for name, value in values.items():
        if value is not None:
            out = F.when(F.col("name") == name, value).otherwise(out)
    return out


def formatted(raw: Column, part: Mapping) -> tuple[Column, dict[str, Column]]:
    """H7: formatted part and the extra ext entries it yields."""
    kind = part.get("format")
    if kind == "short_hostname":
        return short_hostname(raw), {}
    if kind == "tmnxportid":
        return F.coalesce(port_name(raw), raw), {}
    if kind == "tmnxsapid":
        return F.coalesce(sap_name(raw), raw), {"queue_num": sap_queue(raw)}
    if kind == "regex" and (part.get("format_opts") or {}).get("pattern"):
        pattern, groups = positional_pattern(part["format_opts"]["pattern"])
        if "value" not in groups:
            return raw, {}
        hit = raw.rlike(pattern)
        extra = {g: F.when(hit, F.regexp_extract(raw, pattern, i)) for g, i in groups.items() if g != "value"}
        return F.when(hit, F.regexp_extract(raw, pattern, groups["value"])).otherwise(raw), extra
    return raw, {}


def with_resource_id(df: DataFrame, rules: Rules, kv: DataFrame | None) -> DataFrame:
    """H6, H7: add ``resource_id`` and the map ``_id_ext``.

    All rules are resolved in the same pass: every part position has one key column per row, so the
    number of lookup joins is the number of positions that use a lookup, not the number of rules.
    """
    parts = {name: rules.id_parts(rule) for name, rule in rules.usable.items()}
    depth = max((len(p) for p in parts.values()), default=0)
    extras: dict[str, dict[str, Column]] = {}
    done: list[str] = []
    for i in range(depth):
        values: dict[str, Column] = {}
        tables: dict[str, Column | None] = {}
        for name, listed in parts.items():
            if i >= len(listed):
                continue
            value, extra = formatted(path_value(listed[i]["path"]), listed[i])
            values[name] = value
            tables[name] = F.lit(listed[i]["lookup"]) if listed[i].get("lookup") else None
            for key, column in extra.items():
                extras.setdefault(key, {})[name] = column
        part = f"_part{i}"
        df = df.withColumn(part, _per_rule(values))
        if kv is not None and any(t is not None for t in tables.values()):
            df = df.withColumn("_lt", F.when(F.col(part).isNotNull(), _per_rule(tables)))
            df = df.withColumn("_lk", F.concat_ws("::", *done, part))
            df = lookup_join(df, kv, {"_lt": "table", "_lk": "key"}, {"value": "_found"})
            df = df.withColumn(part, F.coalesce("_found", part)).drop("_lt", "_lk", "_found")
        done.append(part)
    pairs = [F.struct(F.lit(k).alias("key"), _per_rule(v).alias("value")) for k, v in extras.items()]
    entries = F.filter(F.array(*pairs), lambda e: e.getField("value").isNotNull()) if pairs else None
    ext = F.map_from_entries(entries) if pairs else F.create_map().cast("map<string,string>")
    return df.withColumn("resource_id", F.concat_ws("::", *done) if done else F.lit("")).withColumn("_id_ext", ext).drop(*done)


def tags_ext(rules: Rules) -> Column:
    """Tags without the skipped ones, over the entries the id parts gave (tags win)."""
    skips = {
        name: F.array(*[F.lit(t) for t in (*(rule.get("skip_tags") or []), *DEFAULT_SKIP_TAGS)])
        for name, rule in rules.usable.items()
    }
    skip = _per_rule(skips, "array<string>")
    kept = F.map_filter("tags", lambda k, _: ~F.array_contains(skip, k))
    older = F.map_filter("_id_ext", lambda k, _: ~F.map_contains_key(kept, k))
    return F.map_concat(older, kept)


def melt_metrics(df: DataFrame, rules: Rules, kv: DataFrame | None, cfg: MetricConfig = MetricConfig()) -> DataFrame:
    """One row per non-null field.

    Floats go to the gauge table, whole numbers and booleans to the counter table, anything else to the
    counter table as 1 with the original value in ``ext.metric_value``.  ``metric_gauge`` holds gauge
    values, ``metric_counter`` counter values.
    """
    usable = rules.usable
    rows = df.filter(F.col("name").isin(list(usable)) & F.col("timestamp").isNotNull() & F.col("fields").isNotNull() & F.col("tags").isNotNull())
    rows = tokens(rows).withColumn("_ts", to_long(F.col("timestamp"))).filter(F.col("_ts").isNotNull())
    rows = with_resource_id(rows, rules, kv)
    ref_table = _per_rule({n: F.lit(r["resource_ref"]) for n, r in usable.items() if r.get("resource_ref")})
    rows = rows.withColumn("_ref_table", ref_table)
    rows = lookup_join(rows, kv, {"_ref_table": "table", "resource_id": "key"}, {"value": "ref"})
    rows = rows.select(
        F.timestamp_seconds("_ts").alias("observation_time"),
        F.coalesce(F.element_at("tags", "collector"), F.lit("unknown")).alias("collector_id"),
        F.col("resource_id").alias("id"), "ref", parsed_once(tags_ext(rules)).alias("_ext"),
        _per_rule({n: F.lit(r["resource_type"]) for n, r in usable.items()}).alias("_type"), "fields", "fields_json")
    # what all fields of a message share is made once, before they become rows: its ext as text and the names of its texts
    kind = lambda v: F.schema_of_variant(v)
    texts = F.map_keys(F.map_filter(F.from_json("fields_json", "map<string,variant>"), lambda _, v: kind(v).startswith("STRING") | kind(v).startswith("OBJECT") | kind(v).startswith("ARRAY")))
    rows = rows.select(
        "observation_time", "collector_id", "id", "ref", "_type", "fields", F.to_json("_ext").alias("_ext_json"),
        F.to_json(F.map_filter("_ext", lambda k, _: k != "metric_value")).alias("_open"), parsed_once(texts).alias("_texts"))
    rows = rows.select(
        "observation_time", "collector_id", "id", "ref", "_type", "_ext_json", "_open", "_texts", F.explode("fields").alias("metric_name", "_token")).filter(F.col("_token").isNotNull())
    rows = rows.withColumn("_text", F.coalesce(F.array_contains("_texts", F.col("metric_name")), F.lit(False)))
    whole = F.col("_token").rlike("^-?[0-9]+$") | F.col("_token").isin("true", "false")
    rows = rows.withColumn("_gauge", ~F.col("_text") & ~whole)
    number = F.when(F.col("_token") == "true", F.lit("1")).when(F.col("_token") == "false", F.lit("0")).otherwise(F.col("_token"))
    original = F.to_json(F.create_map(F.lit("metric_value"), F.col("_token")))
    head = F.when(F.col("_open") == "{}", F.lit("{")).otherwise(F.concat(F.expr("left(_open, length(_open) - 1)"), F.lit(",")))
    ext = F.when(F.col("_text"), F.concat(head, F.substring(original, 2, 1 << 30))).otherwise(F.col("_ext_json"))
    table = F.concat(F.lit("data_"), F.col("_type"), F.when(F.col("_gauge"), F.lit("_gauge")).otherwise(F.lit("_counter")))
    return rows.select(
        table.alias("target_table"), "observation_time", "collector_id", *policy_cols(cfg.policy),
        ext.alias("ext"), "id", "ref", "metric_name",
        F.when(F.col("_gauge"), F.col("_token").try_cast("double")).alias("metric_gauge"),
        F.when(F.col("_text"), F.lit(1)).when(~F.col("_gauge"), number.try_cast(COUNTER_TYPE)).cast(COUNTER_TYPE).alias("metric_counter"),
    )


def metric_tables(melted: DataFrame) -> dict[str, DataFrame]:
    """The gauge and the counter variant of the metric schema."""
    shared = [c for c in melted.columns if c not in ("metric_gauge", "metric_counter")]
    gauges = melted.filter(F.col("target_table").endswith("_gauge"))
    counters = melted.filter(F.col("target_table").endswith("_counter"))
    return {
        "gauge": gauges.select(*shared, F.col("metric_gauge").alias("metric_value")),
        "counter": counters.select(*shared, F.col("metric_counter").alias("metric_value")),
    }


# --- H8 / H9: dimensions of raw indexes ------------------------------------------------------------

def port_index_dim(df: DataFrame, column: str) -> DataFrame:
    """H8: distinct raw indexes -> ``raw_index, name, queue_num``; undecodable ones have no name."""
    raw = df.select(F.col(column).cast("string").alias("raw_index")).filter(F.col("raw_index").isNotNull()).distinct()
    is_sap = F.col("raw_index").contains(".")
    return raw.select(
        "raw_index",
        F.when(is_sap, sap_name(F.col("raw_index"))).otherwise(port_name(F.col("raw_index"))).alias("name"),
        F.when(is_sap, sap_queue(F.col("raw_index"))).alias("queue_num"))


def address_index_dim(df: DataFrame, column: str) -> DataFrame:
    """H9: distinct raw address indexes -> ``raw_index, address``."""
    raw = df.select(F.col(column).cast("string").alias("raw_index")).filter(F.col("raw_index").isNotNull()).distinct()
    return raw.select("raw_index", address_text(F.col("raw_index")).alias("address"))


# --- H11: interface traffic that arrives named -----------------------------------------------------

# Interface metric -> name in the named source.
NAMED_FIELDS = {
    "admin_status": "admin_state",
    "oper_status": "oper_state",
    "in_bit_count": "in_bits",
    "in_discard_packet_count": "in_discards",
    "in_error_packet_count": "in_errors",
    "in_bcast_packet_count": "in_bcast_pkts",
    "in_ucast_packet_count": "in_ucast_pkts",
    "in_mcast_packet_count": "in_mcast_pkts",
    "out_bit_count": "out_bits",
    "out_discard_packet_count": "out_discards",
    "out_error_packet_count": "out_errors",
    "out_bcast_packet_count": "out_bcast_pkts",
    "out_ucast_packet_count": "out_ucast_pkts",
    "out_mcast_packet_count": "out_mcast_pkts",
}
_NAMED_VALUES = sorted({*NAMED_FIELDS.values(), "in_pkts", "out_pkts"})
NAMED_SCHEMA = (
    "start string, meta struct<id:string, name:string, device:string, sensor_id:string>, "
    "policy struct<originator:string, level:string, scopes:array<string>>, "
    "values struct<" + ", ".join(f"{v}:struct<val:string>" for v in _NAMED_VALUES) + ">"
)


def project_interface_traffic(df: DataFrame, refs: DataFrame | None, cfg: MetricConfig = MetricConfig(),
                              need_name: bool = True) -> DataFrame:
    """end = start + interval, collector = first of the list, name recovered from the id."""
    any_value = any_present([f"values.{v}.val" for v in _NAMED_VALUES])
    rows = df.filter(any_value & F.col("start").isNotNull() & F.col("meta.id").isNotNull() & F.col("meta.device").isNotNull())
    if need_name:
        rows = rows.filter(F.col("meta.name").isNotNull() | F.col("meta.id").contains("::"))
    sensor = F.col("meta.sensor_id")
    first = F.get(F.from_json(sensor, "array<string>"), F.lit(0))
    start = iso_timestamp(F.col("start"))
    rows = rows.withColumn("interface_id", F.col("meta.id"))
    rows = lookup_join(rows, refs, {"interface_id": "key"}, {"value": "interface_ref"})
    metrics = [
        (F.col(f"values.{src}.val") if name in STATUS_METRICS else scaled(F.col(f"values.{src}.val"))).alias(name)
        for name, src in NAMED_FIELDS.items()
    ]
    return rows.select(
        start.alias("start_time"), (start + F.make_interval(secs=F.lit(cfg.traffic_interval_s))).alias("end_time"),
        F.when(sensor.startswith("["), first).otherwise(F.coalesce(sensor, F.lit("unknown"))).alias("collector_id"),
        F.col("policy.originator").alias("policy_originator"), F.col("policy.level").alias("policy_level"),
        F.coalesce("policy.scopes", F.array().cast("array<string>")).alias("policy_scope"),
        F.lit("{}").alias("ext"), "interface_id", "interface_ref", *metrics)


# --- H12 / H13: status and job metrics -------------------------------------------------------------

def _melt(rows: DataFrame, id_column: str, resource: str, kind: str, entries: Sequence[Column], refs: DataFrame | None,
          as_of: Column, cfg: MetricConfig) -> DataFrame:
    """Entries are ``(metric_name, metric_value, ext)`` structs; those without a value are skipped."""
    keyed = lookup_join(rows, refs, {id_column: "id"}, {"ref": "ref"})
    long = keyed.select(F.col(id_column).alias("id"), "ref", F.explode(F.array(*entries)).alias("e"))
    return long.filter(F.col("e.metric_value").isNotNull()).select(
        F.lit(f"data_{resource}_{kind}").alias("target_table"), as_of.alias("observation_time"),
        F.lit(cfg.collector_id).alias("collector_id"), *policy_cols(cfg.policy), F.col("e.ext").alias("ext"), "id", "ref",
        F.col("e.metric_name").alias("metric_name"), F.col("e.metric_value").alias("metric_value"))


def status_code(c: Column) -> Column:
    """Status text (any case) -> code."""
    names = F.create_map(*[F.lit(x) for pair in RESOURCE_STATUS.items() for x in pair])
    return F.when(c.isNotNull(), F.coalesce(F.element_at(names, F.lower(c)), F.lit(OTHER_STATUS)))


def status_metrics(df: DataFrame, refs: DataFrame | None, as_of: Column, resource: str = "iri_resource",
                   cfg: MetricConfig = MetricConfig()) -> DataFrame:
    """Status code (from ``current_status`` and from ``status``) and last change as epoch seconds."""
    rows = df.filter(F.col("id").isNotNull() & F.col("current_status").isNotNull() & F.col("last_modified").isNotNull())

    def entry(name: str, value: Column, label: str, text: Column) -> Column:
        ext = F.to_json(F.create_map(F.lit(label), text))
        return F.struct(F.lit(name).alias("metric_name"), value.cast("bigint").alias("metric_value"), ext.alias("ext"))

    status = F.col("status") if "status" in df.columns else F.lit(None).cast("string")
    entries = [
        entry("status", status_code(F.col("current_status")), "status_str", F.col("current_status")),
        entry("status", status_code(status), "status_str", status),
        entry("last_modified", F.unix_timestamp(iso_timestamp(F.col("last_modified"))), "last_modified_str", F.col("last_modified")),
    ]
    return _melt(rows, "id", resource, "counter", entries, refs, as_of, cfg)


def job_metrics(df: DataFrame, refs: DataFrame | None, as_of: Column, resource: str = "alcf_job",
                cfg: MetricConfig = MetricConfig()) -> DataFrame:
    """Run time and queue time in seconds and the score; missing or bad values are skipped."""
    rows = df.filter(F.col("jobid").isNotNull())
    values = {
        "runtime_secs": duration_seconds(F.col("runtimef")),
        "queued_time_secs": duration_seconds(F.col("queuedtimef")),
        "score": F.col("score"),
    }
    entries = [
        F.struct(F.lit(n).alias("metric_name"), v.cast("double").alias("metric_value"), F.lit("{}").alias("ext"))
        for n, v in values.items()
    ]
    return _melt(rows, "jobid", resource, "gauge", entries, refs, as_of, cfg)


__all__ = [
    "ADMIN_STATUS", "INTERFACE_FIELDS", "NAMED_SCHEMA", "OPER_STATUS", "Rules", "WIRE_SCHEMA", "address_index_dim",
    "formatted", "interface_traffic", "job_metrics", "melt_metrics", "metric_tables", "policy_cols", "port_index_dim",
    "project_interface_traffic", "scaled", "status_code", "status_metrics", "status_name", "tags_ext", "tokens",
    "truthy", "with_resource_id",
]
