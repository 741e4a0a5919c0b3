"""Flow messages -> typed, enriched flow rows."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, field
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telescry.config import FlowConfig
from telescry.functions import flow as ff
from telescry.functions.net import ip_version
from telescry.functions.text import int_or_zero, mapped, non_empty, to_long, truthy
from telescry.operators.lookup import (
    as_text_key,
    devices_by_address,
    enrich_device,
    enrich_interface,
    lookup_array,
    lookup_join,
    preferred_interfaces,
)
from telescry.operators.predicates import all_present, missing_paths
from telescry.operators.prefix import PrefixIndex, lpm_attach, lpm_resolve
from telescry.operators.ranges import port_dimension
from telescry.sources.messages import judged_messages

REQUIRED = ("ip_src", "ip_dst", "port_src", "port_dst", "ip_proto")
# Collector daemon -> flow type.
FLOW_TYPES = {"nfacctd": "netflow", "sfacctd": "sflow"}

WIRE_TEXT = (
    "ip_src", "ip_dst", "port_src", "port_dst", "ip_proto", "timestamp_start", "timestamp_end",
    "timestamp_arrival", "bytes", "packets", "writer_id", "label", "as_src", "as_dst", "peer_ip_src",
    "peer_ip_dst", "peer_as_dst", "iface_in", "iface_out", "as_path", "comms", "ecomms", "lcomms",
    "local_pref", "med", "tos", "ipv6_flow_label", "mpls_label",
    *[f"mpls_label{i}" for i in range(1, 11)],
    "mpls_pw_id", "mpls_top_label_ipv4", "mpls_top_label_type", "mpls_vpn_rd", "vlan", "vlan_in",
    "vlan_out", "cvlan_in", "cvlan_out",
)
WIRE_SCHEMA = ", ".join(f"{name} string" for name in WIRE_TEXT)

FLOW_COLUMNS = (
    "start_time", "end_time", "collector_id", "policy_originator", "policy_level", "policy_scope", "ext",
    "flow_type", "device_id", "device_ref", "src_as_id", "src_as_ref", "src_ip", "src_ip_ref", "src_port",
    "dst_as_id", "dst_as_ref", "dst_ip", "dst_ip_ref", "dst_port", "protocol", "in_interface_id",
    "in_interface_ref", "in_interface_edge", "out_interface_id", "out_interface_ref", "out_interface_edge",
    "peer_as_id", "peer_as_ref", "peer_ip", "peer_ip_ref", "ip_version", "application_port", "bit_count",
    "packet_count",
)


@dataclass(frozen=True)
class FlowLookups:
    """Lookup tables; one that is not given behaves as empty.

    ``ip`` and ``ip_ext`` are prefix indexes, ``applications`` a cache range index, ``devices`` and
    ``interfaces`` metadata tables, ``as_refs`` and the other ``*_refs`` ``id, ref`` snapshots.
    """

    ip: DataFrame | PrefixIndex | None = None
    ip_ext: Mapping[str, DataFrame | PrefixIndex] = field(default_factory=dict)
    as_refs: DataFrame | None = None
    devices: DataFrame | None = None
    interfaces: DataFrame | None = None
    applications: DataFrame | None = None


def wire(df: DataFrame) -> DataFrame:
    """All wire columns as text; columns the source does not have are null."""
    return df.select(*_wire_columns(frozenset(df.columns) & frozenset(WIRE_TEXT)))


@cache
def _wire_columns(have: frozenset[str]) -> tuple[Column, ...]:
    return tuple((F.col(c) if c in have else F.lit(None)).cast("string").alias(c) for c in WIRE_TEXT)


def epoch_millis(c: Column) -> Column:
    """Epoch seconds text -> whole milliseconds."""
    return (c.try_cast("double") * 1000).try_cast("bigint")


def _millis(df: DataFrame) -> tuple[Column, Column]:
    """First and last millisecond of a wire flow, null where the text is no time."""
    text = lambda name: F.col(name).cast("string") if name in df.columns else F.lit(None).cast("string")
    arrival_only = text("timestamp_start").isNull()
    start = F.when(arrival_only, text("timestamp_arrival")).otherwise(text("timestamp_start"))
    end = F.when(arrival_only, text("timestamp_arrival")).otherwise(F.coalesce(text("timestamp_end"), text("timestamp_start")))
    return epoch_millis(start), epoch_millis(end)


def flow_times(df: DataFrame) -> DataFrame:
    """Add ``start_time`` and ``end_time``; rows without a usable time are dropped (``judged_flows`` names them)."""
    start, end = _millis(df)
    out = df.select("*", F.timestamp_millis(start).alias("start_time"), F.timestamp_millis(end).alias("end_time"))
    return out.filter(F.col("start_time").isNotNull() & F.col("end_time").isNotNull())


def judged_flows(raw: DataFrame) -> DataFrame:
    """Raw messages as wire flows with ``error``: why a message is no flow, null if it is one."""
    rows = judged_messages(raw, WIRE_SCHEMA)
    start, end = _millis(rows)
    reason = F.when(F.col("error").isNotNull(), F.col("error")).when(~all_present(REQUIRED), F.concat(F.lit("missing "), missing_paths(REQUIRED))).when(
        ~(start.isNotNull() & end.isNotNull()), F.lit("no usable start time"))
    return rows.withColumn("error", reason)


def bgp_fields(df: DataFrame, mode: str) -> DataFrame:
    """AS path without repeats and its padding, communities, preferences."""
    numbers, starts, fields = _bgp_columns(mode)
    return df.withColumn("_asn", numbers).withColumn("_starts", starts).select(*df.columns, *fields)


@cache  # columns are built once, not once a batch: each takes hundreds of calls to the JVM
def _bgp_columns(mode: str) -> tuple[Column, Column, tuple[Column, ...]]:
    has_path = truthy(F.col("as_path"))
    gated = lambda c: F.when(has_path, c)
    return ff.as_numbers(F.col("as_path")), ff.run_starts(F.col("_asn")), (
        ff.path_without_repeats(F.col("_asn"), F.col("_starts")).alias("bgp_as_path_id"),
        ff.path_padding(F.col("_asn"), F.col("_starts"), mode).alias("bgp_as_path_padding"),
        gated(ff.underscore_list(F.col("comms"))).alias("bgp_community"),
        gated(ff.underscore_list(F.col("ecomms"))).alias("bgp_ext_community"),
        gated(ff.underscore_list(F.col("lcomms"))).alias("bgp_large_community"),
        gated(to_long(F.col("local_pref"))).alias("bgp_local_pref"),
        gated(to_long(F.col("med"))).alias("bgp_med"),
    )


def mpls_fields(df: DataFrame) -> DataFrame:
    """Label stack, bottom label, pseudo wire, top label, route distinguisher."""
    words, labels, fields = _mpls_columns()
    own = [c for c in df.columns if c not in ("mpls_label", "mpls_top_label_type", "mpls_vpn_rd")]
    return df.withColumn("_words", words).withColumn("_labels", labels).select(*own, *fields)


@cache
def _mpls_columns() -> tuple[Column, Column, tuple[Column, ...]]:
    tokens = ff.label_tokens([F.col(f"mpls_label{i}") for i in range(1, 11)], F.col("mpls_label"))
    return ff.label_words(tokens), ff.label_values(F.col("_words")), (
        ff.bottom_label(F.col("_labels")).alias("mpls_bottom_label"),
        ff.label_exp(F.col("_words")).alias("mpls_exp"),
        F.col("_labels").alias("mpls_label"),
        to_long(F.col("mpls_pw_id")).alias("mpls_pw"),
        non_empty(F.col("mpls_top_label_ipv4")).alias("mpls_top_label_ip"),
        to_long(F.col("mpls_top_label_type")).alias("mpls_top_label_type"),
        non_empty(F.col("mpls_vpn_rd")).alias("mpls_vpn_rd"),
    )


EXT_GROUPS = {
    "bgp": ("bgp_as_path_id", "bgp_as_path_padding", "bgp_community", "bgp_ext_community",
            "bgp_large_community", "bgp_local_pref", "bgp_med"),
    "ipv4": ("ipv4_tos", "ipv4_dscp"),
    "ipv6": ("ipv6_flow_label",),
    "mpls": ("mpls_label", "mpls_exp", "mpls_bottom_label", "mpls_pw", "mpls_top_label_ip",
             "mpls_top_label_type", "mpls_vpn_rd"),
    "vlan": ("vlan_id", "vlan_in_id", "vlan_out_id", "vlan_in_inner_id", "vlan_out_inner_id"),
}
_WIRE_VLAN = {"vlan_id": "vlan", "vlan_in_id": "vlan_in", "vlan_out_id": "vlan_out",
              "vlan_in_inner_id": "cvlan_in", "vlan_out_inner_id": "cvlan_out"}


def ext_fields(df: DataFrame, mode: str = "reference") -> DataFrame:
    """All extension columns of a wire flow."""
    return mpls_fields(bgp_fields(df, mode)).withColumns(_other_columns())


@cache
def _other_columns() -> dict[str, Column]:
    tos = to_long(F.col("tos"))
    return {
        "ipv4_tos": tos, "ipv4_dscp": F.shiftright(tos, 2), "ipv6_flow_label": to_long(F.col("ipv6_flow_label")),
        **{name: to_long(F.col(src)) for name, src in _WIRE_VLAN.items()}}


def normalize_flows(messages: DataFrame, cfg: FlowConfig = FlowConfig()) -> DataFrame:
    """Everything that needs no lookup.  ``_``-columns are inputs of the enrichment."""
    df = wire(messages).filter(all_present(REQUIRED))
    df = flow_times(df)
    return ext_fields(df, cfg.as_path_mode).select(*_normal_columns(cfg.flow_type))


@cache
def _normal_columns(flow_type: str) -> tuple[Column, ...]:
    kind = F.coalesce(mapped(F.col("writer_id"), FLOW_TYPES), F.lit(flow_type))
    return (
        F.col("start_time"), F.col("end_time"),
        F.coalesce("label", F.lit("unknown")).alias("collector_id"),
        kind.alias("flow_type"),
        non_empty(F.col("ip_src")).alias("src_ip"),
        non_empty(F.col("ip_dst")).alias("dst_ip"),
        non_empty(F.col("peer_ip_dst")).alias("peer_ip"),
        F.col("as_src").alias("_as_src"), F.col("as_dst").alias("_as_dst"), F.col("peer_as_dst").alias("_as_peer"),
        F.col("peer_ip_src").alias("_device_ip"), F.col("iface_in").alias("_if_in"), F.col("iface_out").alias("_if_out"),
        F.col("port_src").alias("_port_src"), F.col("port_dst").alias("_port_dst"),
        F.col("ip_proto").alias("protocol"),
        ip_version(F.col("ip_src")).alias("ip_version"),
        F.try_multiply(int_or_zero(F.coalesce("bytes", F.lit("0"))), F.lit(8)).alias("bit_count"),
        int_or_zero(F.coalesce("packets", F.lit("0"))).alias("packet_count"),
        *[F.col(c) for group in EXT_GROUPS.values() for c in group],
    )


def wire_or_prefix_as(ip: str, wire_as: str) -> Column:
    """AS text of an address; the matched prefix's AS replaces a wire AS that is missing or 0.

    Text that is no number is left alone here (and becomes 0 in the final coercion, G13).
    """
    wire_text = F.col(wire_as)
    replace = F.col(f"{ip}_ref").isNotNull() & (wire_text.isNull() | F.coalesce(to_long(wire_text) == 0, F.lit(False)))
    chosen = F.when(replace, F.col(f"_{ip}_as").cast("string")).otherwise(wire_text)
    return F.when(F.col(ip).isNotNull(), chosen)


def enrich_ip_as(df: DataFrame, resolved: DataFrame | None, as_refs: DataFrame | None,
                 sides: Sequence[tuple[str, str, str]]) -> DataFrame:
    """G9, D3, D4 for several ``(address, wire AS, AS name)`` columns: ``{address}_ref``,
    ``{name}_id`` and ``{name}_ref``."""
    for ip, _, _ in sides:
        if resolved is None:
            df = df.select("*", F.lit(None).cast("string").alias(f"{ip}_ref"), F.lit(None).cast("bigint").alias(f"_{ip}_as"))
        else:
            df = lpm_attach(df, ip, resolved, {"ref": f"{ip}_ref", "as_id": f"_{ip}_as"})
    df = df.withColumns({f"_{name}": wire_or_prefix_as(ip, wire_as) for ip, wire_as, name in sides})
    for _, _, name in sides:
        df = lookup_join(df, as_text_key(as_refs), {f"_{name}": "id"}, {"ref": f"{name}_ref"})
    df = df.withColumns({f"{name}_id": int_or_zero(F.col(f"_{name}")) for _, _, name in sides})
    return df.drop(*[c for ip, wire_as, name in sides for c in (wire_as, f"_{ip}_as", f"_{name}")])


def application_port(df: DataFrame, applications: DataFrame | None) -> DataFrame:
    """The smaller known port, the known one, or 0."""
    ports = None if applications is None else port_dimension(applications)
    df = df.withColumns({"_proto": F.lower("protocol"), "_ps": to_long(F.col("_port_src")), "_pd": to_long(F.col("_port_dst"))})
    df = lookup_join(df, ports, {"_proto": "key", "_ps": "port"}, {"value": "_app_src"})
    df = lookup_join(df, ports, {"_proto": "key", "_pd": "port"}, {"value": "_app_dst"})
    known_src, known_dst = F.col("_app_src").isNotNull(), F.col("_app_dst").isNotNull()
    src, dst = F.coalesce("_ps", F.lit(0)), F.coalesce("_pd", F.lit(0))
    port = F.when(known_src & known_dst, F.least(src, dst)).when(known_src, src).when(known_dst, dst).otherwise(0)
    return df.withColumns({"application_port": port.cast("bigint"), "src_port": src, "dst_port": dst})


def scope_list(cfg: FlowConfig, src_as: Column, dst_as: Column, rd: Column) -> Column:
    """Configured scopes, then the sorted distinct automatic ones."""
    fixed = F.array(*[F.lit(s) for s in cfg.policy.scope]).cast("array<string>")
    if not cfg.auto_scopes:
        return fixed
    as_scope = lambda n: F.when(n != 0, F.concat(F.lit("as:"), n.cast("string")))
    community = mapped(F.when(rd.contains(":"), F.substring_index(rd, ":", -1)), cfg.community_scopes)
    auto = F.array(as_scope(src_as), as_scope(dst_as), F.when(community.isNotNull(), F.concat(F.lit("comm:"), community)))
    return F.concat(fixed, F.array_sort(F.array_distinct(F.array_compact(auto))))


def ext_json(df: DataFrame, columns: list[str]) -> Column:
    """JSON of the columns; absent ones are left out."""
    return F.to_json(F.struct(*[F.col(c) for c in columns])) if columns else F.lit("{}")


def _one_row_per_key(df: DataFrame | None, key: str = "id") -> bool:
    """Whether a lookup cannot multiply rows."""
    return df is None or as_text_key(df, key).filter(F.col(key).isNotNull()).groupBy(key).count().filter("count > 1").isEmpty()


def enrich_flows(df: DataFrame, lookups: FlowLookups, cfg: FlowConfig = FlowConfig(),
                 messages: DataFrame | None = None, wanted: Collection[str] | None = None) -> DataFrame:
    """Lookups, policy and the final column order.

    The distinct addresses of all address columns are resolved against a prefix index once.  They are
    read from ``messages`` when given: the pass over the raw source then reads three columns only.  The small lookups come
    first, so that a filter on them takes rows out before the joins by address.  With ``wanted`` only those columns
    are given; addresses of which nothing is wanted are not looked up, unless that could change the number of rows.
    """
    names = set(FLOW_COLUMNS if wanted is None else wanted)
    sides = (("src_ip", "_as_src", "src_as"), ("dst_ip", "_as_dst", "dst_as"), ("peer_ip", "_as_peer", "peer_as"))
    if not names >= {f"{name}_{field}" for ip, _, name in sides for field in ("id", "ref")} and _one_row_per_key(lookups.as_refs):
        scoped = {"src_as", "dst_as"} if "policy_scope" in names else set()
        sides = tuple((ip, wire_as, name) for ip, wire_as, name in sides if name in scoped or names & {f"{name}_id", f"{name}_ref", f"{ip}_ref"})
    probes = df.select("src_ip", "dst_ip", "peer_ip") if messages is None else wire(messages).select(
        F.col("ip_src").alias("src_ip"), F.col("ip_dst").alias("dst_ip"), F.col("peer_ip_dst").alias("peer_ip"))

    df = enrich_device(df, devices_by_address(lookups.devices) if lookups.devices is not None else None, "_device_ip")
    preferred = preferred_interfaces(lookups.interfaces) if lookups.interfaces is not None else None
    df = enrich_interface(df, preferred, "device_id", "_if_in", "in")
    df = enrich_interface(df, preferred, "device_id", "_if_out", "out")
    if names & {"application_port", "src_port", "dst_port"}:
        df = application_port(df, lookups.applications)
    if sides:
        resolved = None
        if lookups.ip is not None:
            resolved = lpm_resolve(probes, [ip for ip, _, _ in sides], lookups.ip, ["ref", "as_id"])
        df = enrich_ip_as(df, resolved, lookups.as_refs, sides)

    ext = [c for group in cfg.extensions for c in EXT_GROUPS[group]]
    for name in cfg.ip_ref_extensions if "ext" in names else ():
        index = lookups.ip_ext.get(name)
        if index is None:
            continue
        found = lpm_resolve(probes, ["src_ip", "dst_ip"], index, ["ref"])
        for direction in ("src", "dst"):
            column = f"{direction}_ip_{name}_ref"
            df = lpm_attach(df, f"{direction}_ip", found, {"ref": column})
            ext.append(column)
    made = {"policy_originator": F.lit(cfg.policy.originator), "policy_level": F.lit(cfg.policy.level)}
    if "policy_scope" in names:
        made["policy_scope"] = scope_list(cfg, F.col("src_as_id"), F.col("dst_as_id"), F.col("mpls_vpn_rd"))
    if "ext" in names:
        made["ext"] = ext_json(df, ext)
    return df.select(*[made.get(c, F.col(c)).alias(c) for c in FLOW_COLUMNS if c in names])


def ingest(messages: DataFrame, lookups: FlowLookups, cfg: FlowConfig = FlowConfig(), wanted: Collection[str] | None = None) -> DataFrame:
    """Raw flow messages -> enriched flow rows, or the ``wanted`` columns of them."""
    return enrich_flows(normalize_flows(messages, cfg), lookups, cfg, messages, wanted)


# --- G16: flows that arrive already enriched -------------------------------------------------------

_HOPS = 20
ENRICHED_SCHEMA = (
    "start string, `end` string, "
    "meta struct<sensor_id:string, flow_type:string, router:struct<name:string>, "
    "src_asn:bigint, src_ip:string, src_port:int, dst_asn:bigint, dst_ip:string, dst_port:int, "
    "protocol:string, iface_in:struct<id:string>, iface_out:struct<id:string>, ip_version:int, app_port:int, "
    "dscp:bigint, ip_tos:bigint, ipv6:struct<flow_label:bigint>, "
    "service:struct<src:array<string>,dst:array<string>>, "
    "bgp:struct<peer_as_dst:bigint, next_hop:string, as_path:array<bigint>, comms:array<string>, "
    "ecomms:array<string>, lcomms:array<string>, local_pref:bigint, med:bigint, "
    + ", ".join(f"as_hop{i}_padding:string" for i in range(_HOPS))
    + ">, mpls:struct<labels:array<bigint>, bottom_label:bigint, pw_id:bigint, top_label_ip:string, "
    "top_label_type:bigint, vpn_rd:string, " + ", ".join(f"exp{i}:string" for i in range(_HOPS)) + ">>, "
    "policy struct<originator:string, level:string, scopes:array<string>>, "
    "values struct<num_bits:bigint, num_packets:bigint>"
)
ENRICHED_REQUIRED = ("start", "end", "meta.dst_asn", "meta.dst_ip", "meta.dst_port", "meta.src_asn", "meta.src_ip", "meta.src_port")


def enriched_ext(groups: tuple[str, ...]) -> dict[str, Column]:
    """Extension columns of the enabled groups."""
    m = lambda name: F.col(f"meta.{name}")
    texts = lambda c: F.coalesce(c, F.array().cast("array<string>"))
    longs = lambda c: F.coalesce(c, F.array().cast("array<bigint>"))
    families = {
        "bgp": {
            "bgp_as_path_id": longs(m("bgp.as_path")),
            "bgp_as_path_padding": ff.until_first_gap([m(f"bgp.as_hop{i}_padding") for i in range(_HOPS)]),
            "bgp_community": texts(m("bgp.comms")),
            "bgp_ext_community": texts(m("bgp.ecomms")),
            "bgp_large_community": texts(m("bgp.lcomms")),
            "bgp_local_pref": m("bgp.local_pref"),
            "bgp_med": m("bgp.med"),
        },
        "ipv4": {"ipv4_dscp": m("dscp"), "ipv4_tos": m("ip_tos")},
        "ipv6": {"ipv6_flow_label": m("ipv6.flow_label")},
        "mpls": {
            "mpls_bottom_label": m("mpls.bottom_label"),
            "mpls_exp": ff.until_first_gap([m(f"mpls.exp{i}") for i in range(_HOPS)]),
            "mpls_label": longs(m("mpls.labels")),
            "mpls_pw": m("mpls.pw_id"),
            "mpls_top_label_ip": m("mpls.top_label_ip"),
            "mpls_top_label_type": m("mpls.top_label_type"),
            "mpls_vpn_rd": m("mpls.vpn_rd"),
        },
    }
    return {name: c for group in groups for name, c in families.get(group, {}).items()}


def project_enriched_flows(messages: DataFrame, cfg: FlowConfig = FlowConfig(), ip: DataFrame | PrefixIndex | None = None,
                           as_refs: DataFrame | None = None, device_refs: DataFrame | None = None,
                           interface_refs: DataFrame | None = None, service_refs: DataFrame | None = None,
                           registry: DataFrame | None = None) -> DataFrame:
    """Nested, already enriched flow messages -> flow rows; edge flags default to false.

    ``service_refs`` (``id, ref``) resolves the prefix group lists of both ends, ``registry`` is the
    science registry's prefix index; both only fill ``ext`` and are used when given.
    """
    ext = enriched_ext(cfg.extensions)
    df = messages.filter(all_present([f"`{p}`" if p == "end" else p for p in ENRICHED_REQUIRED]))
    df = df.select(
        "*", *[c.alias(n) for n, c in ext.items()],
        F.col("meta.src_ip").alias("src_ip"), F.col("meta.dst_ip").alias("dst_ip"),
        F.col("meta.bgp.next_hop").alias("peer_ip"), F.col("meta.src_asn").alias("src_as_id"),
        F.col("meta.dst_asn").alias("dst_as_id"), F.col("meta.bgp.peer_as_dst").alias("peer_as_id"),
        F.col("meta.router.name").alias("device_id"), F.col("meta.iface_in.id").alias("in_interface_id"),
        F.col("meta.iface_out.id").alias("out_interface_id"),
    )
    resolved = None if ip is None else lpm_resolve(df, ["src_ip", "dst_ip", "peer_ip"], ip, ["ref"])
    for column in ("src_ip", "dst_ip", "peer_ip"):
        df = df.withColumn(f"{column}_ref", F.lit(None).cast("string")) if resolved is None else \
            lpm_attach(df, column, resolved, {"ref": f"{column}_ref"})
    for column, right in (("src_as", as_refs), ("dst_as", as_refs), ("peer_as", as_refs), ("device", device_refs),
                          ("in_interface", interface_refs), ("out_interface", interface_refs)):
        keyed = df.withColumn("_k", F.col(f"{column}_id").cast("string"))
        df = lookup_join(keyed, as_text_key(right), {"_k": "id"}, {"ref": f"{column}_ref"}).drop("_k")
    names = list(ext)
    if registry is not None:
        found = lpm_resolve(df, ["src_ip", "dst_ip"], registry, ["ref"])
        for direction in ("dst", "src"):
            df = lpm_attach(df, f"{direction}_ip", found, {"ref": f"{direction}_scireg_ref"})
            names.append(f"{direction}_scireg_ref")
    if service_refs is not None:
        for direction in ("src", "dst"):  # a list of groups is resolved once, however many flows have it
            column, key = f"{direction}_ip_service_ref", F.col(f"meta.service.{direction}")
            lists = df.select(key.alias("_groups")).filter("_groups IS NOT NULL").distinct().withColumn("_list", F.col("_groups"))
            refs = lookup_array(lists, "_list", "_groups", service_refs, column, keep_misses=False).select("_list", column)
            df = df.withColumn("_key", key).join(refs, F.col("_key") == F.col("_list"), "left").drop("_key", "_list")
            df = df.withColumn(column, F.coalesce(column, F.array().cast("array<string>")))
            names.append(column)
    false = F.lit(False)
    shaped = df.select(
        F.try_to_timestamp("start").alias("start_time"), F.try_to_timestamp("end").alias("end_time"),
        F.col("meta.sensor_id").alias("collector_id"), F.col("policy.originator").alias("policy_originator"),
        F.col("policy.level").alias("policy_level"),
        F.coalesce("policy.scopes", F.array().cast("array<string>")).alias("policy_scope"),
        ext_json(df, names).alias("ext"), F.col("meta.flow_type").alias("flow_type"),
        "device_id", "device_ref", "src_as_id", "src_as_ref", "src_ip", "src_ip_ref",
        F.col("meta.src_port").cast("bigint").alias("src_port"),
        "dst_as_id", "dst_as_ref", "dst_ip", "dst_ip_ref",
        F.col("meta.dst_port").cast("bigint").alias("dst_port"), F.col("meta.protocol").alias("protocol"),
        "in_interface_id", "in_interface_ref", false.alias("in_interface_edge"),
        "out_interface_id", "out_interface_ref", false.alias("out_interface_edge"),
        "peer_as_id", "peer_as_ref", "peer_ip", "peer_ip_ref", F.col("meta.ip_version").alias("ip_version"),
        F.coalesce("meta.app_port", F.lit(0)).cast("bigint").alias("application_port"),
        F.col("values.num_bits").alias("bit_count"), F.col("values.num_packets").alias("packet_count"),
    )
    return shaped.select(*FLOW_COLUMNS)
