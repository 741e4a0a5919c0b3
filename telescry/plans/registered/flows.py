"""Flow normalisation and enrichment."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telescry.config import FlowConfig
from telescry.operators import flows, lookup, prefix, ranges
from telescry.plans import views
from telescry.plans.registered import registered
from telescry.plans.views import FLOW_CTE, PORTS, SRC_SQL, SUBNET_CTE, lpm_cte, sql_ip, table

CONFIG = FlowConfig(community_scopes=views.COMMUNITIES)


def lookups(spark: SparkSession, sf_dir: str) -> flows.FlowLookups:
    return flows.FlowLookups(
        ip=prefix.subnet_index(views.ip_blocks(spark, sf_dir), ["ref", "as_id"]),
        as_refs=views.as_refs(spark, sf_dir), devices=views.devices(spark, sf_dir),
        interfaces=views.interfaces(spark, sf_dir), applications=ranges.cache_ranges(views.applications(spark, sf_dir)))


def enriched(spark: SparkSession, sf_dir: str, wanted: Collection[str] | None = None) -> DataFrame:
    return flows.ingest(views.flows_wire(spark, sf_dir), lookups(spark, sf_dir), CONFIG, wanted)


def keyed_wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wire flows with the line's key beside them, for queries on single fields."""
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_shipdate")


@registered("g9_flow_enriched", f"""
WITH {FLOW_CTE}
SELECT CAST(epoch(start_time) AS BIGINT) AS start_epoch, collector_id, flow_type, protocol, {sql_ip("src")} AS src_ip, {sql_ip("dst")} AS dst_ip,
  sport AS src_port, dport AS dst_port, src_part || '__v1' AS src_ip_ref, dst_part || '__v1' AS dst_ip_ref, src_as_id, src_as_ref,
  dst_as_id, dst_as_ref, device_id, device_ref, in_id AS in_interface_id, in_ref AS in_interface_ref, in_edge AS in_interface_edge,
  out_id AS out_interface_id, out_ref AS out_interface_ref, out_edge AS out_interface_edge, 4 AS ip_version, application_port,
  bit_count, packet_count,
  array_to_string(list_sort(list_distinct([CASE WHEN src_as_id <> 0 THEN 'as:' || src_as_id END, CASE WHEN dst_as_id <> 0 THEN 'as:' || dst_as_id END,
    CASE rd WHEN 0 THEN 'comm:blue' WHEN 1 THEN 'comm:red' END])), ',') AS policy_scope
FROM enriched""")
def g9(spark, sf_dir):
    out = enriched(spark, sf_dir).withColumn("start_epoch", F.unix_timestamp("start_time")).withColumn("policy_scope", F.array_join("policy_scope", ","))
    return out.select(
        "start_epoch", "collector_id", "flow_type", "protocol", "src_ip", "dst_ip", "src_port", "dst_port", "src_ip_ref", "dst_ip_ref",
        "src_as_id", "src_as_ref", "dst_as_id", "dst_as_ref", "device_id", "device_ref", "in_interface_id", "in_interface_ref",
        "in_interface_edge", "out_interface_id", "out_interface_ref", "out_interface_edge", "ip_version", "application_port",
        "bit_count", "packet_count", "policy_scope")


@registered("d4_as_fallback", f"""
WITH {SUBNET_CTE}, {lpm_cte("m", SRC_SQL)},
w AS (SELECT l_orderkey, l_linenumber, {SRC_SQL} AS ip, CASE l_suppkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '0' WHEN 2 THEN 'bad' ELSE l_suppkey::VARCHAR END AS wire_as FROM lineitem),
j AS (SELECT w.*, m.partkey, m.ip IS NOT NULL AS hit FROM w LEFT JOIN m ON m.ip = w.ip),
c AS (SELECT *, CASE WHEN hit AND (wire_as IS NULL OR wire_as = '0') THEN CASE WHEN partkey % 5 <> 0 THEN partkey::VARCHAR END ELSE wire_as END AS t FROM j)
SELECT l_orderkey, l_linenumber, partkey || '__v1' AS ip_ref, CASE WHEN t = 'bad' THEN 0 ELSE t::BIGINT END AS as_id,
  CASE WHEN p_partkey IS NOT NULL THEN t || '__v1' END AS as_ref
FROM c LEFT JOIN part ON p_partkey::VARCHAR = t AND p_partkey % 3 <> 0""")
def d4(spark, sf_dir):
    from telescry.functions.net import ipv4_text

    li = keyed_wire(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", ipv4_text(views.src_int()).alias("ip"),
        F.expr("CASE l_suppkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '0' WHEN 2 THEN 'bad' ELSE string(l_suppkey) END").alias("wire_as"))
    index = prefix.subnet_index(views.ip_blocks(spark, sf_dir), ["ref", "as_id"])
    resolved = prefix.lpm_resolve(li, ["ip"], index, ["ref", "as_id"])
    return flows.enrich_ip_as(li, resolved, views.as_refs(spark, sf_dir), [("ip", "wire_as", "as")]).drop("ip")


@registered("g2_time_ladder", """
SELECT l_orderkey, l_linenumber, CAST(epoch(l_shipdate) AS BIGINT) * 1000 + 250 AS start_ms,
  CAST(epoch(l_shipdate) AS BIGINT) * 1000 + CASE l_linenumber % 5 WHEN 1 THEN 60250 ELSE 250 END AS end_ms
FROM lineitem WHERE l_linenumber % 5 IN (0, 1, 2)""")
def g2(spark, sf_dir):
    li = keyed_wire(spark, sf_dir)
    epoch = F.unix_timestamp(F.col("l_shipdate").cast("timestamp"))
    text = lambda c: F.concat(c.cast("string"), F.lit(".25"))
    kind = F.col("l_linenumber") % 5
    rows = li.select(
        "l_orderkey", "l_linenumber", F.when(kind == 0, text(epoch)).alias("timestamp_arrival"),
        F.when(kind.isin(1, 2), text(epoch)).when(kind == 4, F.lit("soon")).alias("timestamp_start"),
        F.when(kind == 1, text(epoch + 60)).alias("timestamp_end"))
    out = flows.flow_times(rows)
    return out.select("l_orderkey", "l_linenumber", F.unix_millis("start_time").alias("start_ms"), F.unix_millis("end_time").alias("end_ms"))


@registered("g3_flow_type", f"""
SELECT CASE l_returnflag WHEN 'A' THEN 'netflow' WHEN 'R' THEN 'sflow' ELSE 'unknown' END AS flow_type, l_linestatus AS collector_id,
  4 AS ip_version, CAST(l_quantity AS BIGINT) * 800 AS bit_count, l_linenumber AS packet_count, {sql_ip(SRC_SQL)} AS src_ip FROM lineitem""")
def g3(spark, sf_dir):
    return flows.normalize_flows(views.flows_wire(spark, sf_dir)).select("flow_type", "collector_id", "ip_version", "bit_count", "packet_count", "src_ip")


_PATH = """
t AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, 65000 + l_suppkey % 3 AS a, 65000 + l_partkey % 3 AS b, 65000 + l_orderkey % 3 AS c FROM lineitem),
n AS (SELECT *, [a, b, c, c] AS nums FROM t),
s AS (SELECT *, list_filter([0, 1, 2, 3], lambda i: i = 0 OR nums[i + 1] <> nums[i]) AS starts FROM n),
p AS (SELECT *, list_transform(starts, lambda i: nums[i + 1]) AS path,
  list_transform(range(1, len(starts) + 1), lambda k: CASE WHEN k = 1 THEN 1 ELSE starts[k] - starts[k - 1] END) AS shifted,
  list_transform(range(1, len(starts) + 1), lambda k: coalesce(starts[k + 1], 4) - starts[k]) AS runs FROM s)"""


@registered("g4_as_path_rle", f"""
WITH {_PATH} SELECT l_orderkey, l_linenumber, a, array_to_string(path, ',') AS path, array_to_string(shifted, ',') AS shifted, array_to_string(runs, ',') AS runs FROM p""")
def g4(spark, sf_dir):
    from telescry.functions import flow as ff

    li = keyed_wire(spark, sf_dir).withColumn("a", 65000 + F.col("l_suppkey") % 3)
    text = F.expr("concat_ws('_', a, 65000 + l_partkey % 3, 'x', 65000 + l_orderkey % 3, 65000 + l_orderkey % 3)")
    rows = li.withColumn("n", ff.as_numbers(text)).withColumn("s", ff.run_starts(F.col("n")))
    joined = lambda c: F.array_join(c.cast("array<string>"), ",")
    return rows.select(
        "l_orderkey", "l_linenumber", "a", joined(ff.path_without_repeats(F.col("n"), F.col("s"))).alias("path"),
        joined(ff.path_padding(F.col("n"), F.col("s"))).alias("shifted"),
        joined(ff.path_padding(F.col("n"), F.col("s"), "true_run_length")).alias("runs"))


@registered("g5_communities", """
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_linenumber % 3 > 0 AND l_suppkey % 2 = 0 THEN '65000:' || l_suppkey || ',65000:1' END AS community,
  CASE WHEN l_linenumber % 3 > 0 AND l_partkey % 5 > 0 THEN l_partkey END AS pref,
  CASE WHEN l_linenumber % 3 > 0 THEN 5 END AS med
FROM lineitem""")
def g5(spark, sf_dir):
    li = keyed_wire(spark, sf_dir)
    rows = li.select(
        "l_orderkey", "l_linenumber", F.expr("CASE l_linenumber % 3 WHEN 0 THEN '' ELSE '65000' END").alias("as_path"),
        F.expr("CASE WHEN l_suppkey % 2 = 0 THEN concat('65000:', l_suppkey, '_65000:1') END").alias("comms"),
        F.lit("").alias("ecomms"), F.lit(None).cast("string").alias("lcomms"),
        F.expr("CASE WHEN l_partkey % 5 > 0 THEN string(l_partkey) ELSE 'high' END").alias("local_pref"), F.lit("5").alias("med"))
    out = flows.bgp_fields(rows, "reference")
    return out.select("l_orderkey", "l_linenumber", F.array_join("bgp_community", ",").alias("community"),
                      F.col("bgp_local_pref").alias("pref"), F.col("bgp_med").alias("med"))


_LABELS = """
t AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (l_partkey % 256) * 65536 + (l_suppkey % 256) * 256 + (l_linenumber * 16) % 256 AS w FROM lineitem),
w AS (SELECT *, CASE WHEN l_linenumber % 2 = 0 THEN [w] ELSE [w, 14] END AS words FROM t),
x AS (SELECT *, list_transform(words, lambda v: v >> 4) AS labels, list_transform(words, lambda v: (v & 14) >> 1) AS exps,
        nullif(w >> 4, 0) AS bottom FROM w)"""


@registered("g7_mpls_decode", f"""
WITH {_LABELS} SELECT l_orderkey, l_linenumber, array_to_string(labels, ',') AS labels, array_to_string(exps, ',') AS exps, bottom, '65000:' || (l_partkey % 3) AS rd FROM x""")
def g7(spark, sf_dir):
    keys = keyed_wire(spark, sf_dir).select("l_orderkey", "l_linenumber")
    wire = flows.wire(views.flows_wire(spark, sf_dir))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *_mpls_wire())
    out = flows.mpls_fields(rows.select(*keys.columns, *[c for c in wire.columns if c.startswith("mpls_")]))
    joined = lambda c: F.array_join(F.col(c).cast("array<string>"), ",")
    return out.select("l_orderkey", "l_linenumber", joined("mpls_label").alias("labels"), joined("mpls_exp").alias("exps"),
                      F.col("mpls_bottom_label").alias("bottom"), F.col("mpls_vpn_rd").alias("rd"))


def _mpls_wire():
    hexed = "lower(concat(lpad(hex(l_partkey % 256), 2, '0'), '-', lpad(hex(l_suppkey % 256), 2, '0'), '-', lpad(hex(l_linenumber * 16 % 256), 2, '0')))"
    null = F.lit(None).cast("string")
    return [
        F.expr(f"CASE WHEN l_linenumber % 2 = 0 THEN concat({hexed}, '_zz') END").alias("mpls_label"),
        F.expr(f"CASE WHEN l_linenumber % 2 = 1 THEN {hexed} END").alias("mpls_label1"),
        F.lit("00-00-0e").alias("mpls_label2"), F.lit("").alias("mpls_label3"), F.lit("ff-ff-f0").alias("mpls_label4"),
        *[null.alias(f"mpls_label{i}") for i in range(5, 11)],
        F.lit("7").alias("mpls_pw_id"), F.lit("").alias("mpls_top_label_ipv4"), F.lit("x").alias("mpls_top_label_type"),
        F.expr("concat('65000:', l_partkey % 3)").alias("mpls_vpn_rd")]


@registered("g11_application_port", f"""
WITH {FLOW_CTE} SELECT protocol, sport AS src_port, dport AS dst_port, application_port, count(*) AS n FROM flow GROUP BY ALL""")
def g11(spark, sf_dir):
    n = flows.normalize_flows(views.flows_wire(spark, sf_dir))
    out = flows.application_port(n, ranges.cache_ranges(views.applications(spark, sf_dir)))
    keys = ["protocol", F.col("_port_src").cast("bigint").alias("src_port"), F.col("_port_dst").cast("bigint").alias("dst_port"), "application_port"]
    return out.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


@registered("g13_int_coercion", f"""
SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 4 = 3 THEN NULL WHEN l_linenumber % 4 = 0 THEN 0 ELSE l_partkey END AS n,
  l_orderkey % {PORTS} // 4 AS shifted FROM lineitem""")
def g13(spark, sf_dir):
    from telescry.functions.text import int_or_zero

    li = keyed_wire(spark, sf_dir)
    text = F.expr("CASE l_linenumber % 4 WHEN 3 THEN NULL WHEN 0 THEN concat(l_partkey, '.5') ELSE concat(' ', l_partkey, ' ') END")
    return li.select("l_orderkey", "l_linenumber", int_or_zero(text).alias("n"), F.shiftright(F.expr(f"l_orderkey % {PORTS}"), 2).alias("shifted"))


@registered("g14_policy_scope", """
SELECT l_orderkey, l_linenumber, array_to_string(list_concat(['internal'], list_sort(list_distinct(list_filter(['as:' || l_suppkey % 3, 'as:' || l_partkey % 3,
  CASE l_orderkey % 4 WHEN 0 THEN 'comm:blue' WHEN 1 THEN 'comm:red' END], lambda s: s IS NOT NULL AND s <> 'as:0')))), ',') AS scope FROM lineitem""")
def g14(spark, sf_dir):
    from telescry.config import Policy

    cfg = FlowConfig(policy=Policy(scope=("internal",)), community_scopes=views.COMMUNITIES)
    li = keyed_wire(spark, sf_dir)
    scope = flows.scope_list(cfg, F.col("l_suppkey") % 3, F.col("l_partkey") % 3, F.expr("concat('65000:', l_orderkey % 4)"))
    return li.select("l_orderkey", "l_linenumber", F.array_join(scope, ",").alias("scope"))


@registered("g12_ip_version", f"""
WITH t AS (SELECT l_orderkey % {PORTS} % 2 = 0 AS six, {SRC_SQL} AS src, CAST(l_quantity AS BIGINT) * 800 AS bits FROM lineitem),
a AS (SELECT CASE WHEN six THEN 6 ELSE 4 END AS ip_version, CASE WHEN six THEN '2001:db8::' ELSE '' END || {sql_ip("src")} AS ip, bits FROM t)
SELECT ip_version, ip AS src_ip, ip AS peer_ip, count(*) AS n, CAST(sum(bits) AS BIGINT) AS bit_count FROM a GROUP BY ip_version, ip""")
def g12(spark, sf_dir):
    """Every flow whose source port is even is an IPv6 flow; the peer is the source."""
    ip = F.when(F.col("port_src").cast("bigint") % 2 == 0, F.concat(F.lit("2001:db8::"), F.col("ip_src"))).otherwise(F.col("ip_src"))
    messages = views.flows_wire(spark, sf_dir).withColumn("ip_src", ip).withColumn("peer_ip_dst", F.col("ip_src"))
    rows = flows.normalize_flows(messages).groupBy("ip_version", "src_ip", "peer_ip")
    return rows.agg(F.count(F.lit(1)).alias("n"), F.sum("bit_count").alias("bit_count"))


@registered("g15_ext_json", f"""
WITH {_PATH}, {_LABELS.replace("t AS", "t2 AS").replace("FROM t)", "FROM t2)").replace("w AS (SELECT *, CASE", "w2 AS (SELECT *, CASE").replace("FROM w)", "FROM w2)")}
SELECT '{{"bgp_as_path_id":[' || array_to_string(path, ',') || '],"bgp_as_path_padding":[' || array_to_string(shifted, ',') || '],"ipv4_tos":' || (p.l_orderkey % 256)
  || ',"ipv4_dscp":' || ((p.l_orderkey % 256) >> 2) || ',"mpls_label":[' || array_to_string(labels, ',') || '],"mpls_exp":[' || array_to_string(exps, ',') || ']'
  || CASE WHEN bottom IS NOT NULL THEN ',"mpls_bottom_label":' || bottom ELSE '' END || ',"mpls_vpn_rd":"65000:' || (p.l_partkey % 3) || '"}}' AS ext, count(*) AS n
FROM p JOIN (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, labels, exps, bottom FROM x) x
  ON x.l_orderkey = p.l_orderkey AND x.l_linenumber = p.l_linenumber AND x.l_partkey = p.l_partkey AND x.l_suppkey = p.l_suppkey
GROUP BY ALL""")
def g15(spark, sf_dir):
    rows = flows.normalize_flows(views.flows_wire(spark, sf_dir))
    names = [c for group in CONFIG.extensions for c in flows.EXT_GROUPS[group]]
    return rows.select(flows.ext_json(rows, names).alias("ext")).groupBy("ext").agg(F.count(F.lit(1)).alias("n"))


def _enriched_messages(lines: DataFrame) -> DataFrame:
    """lineitem as nested, already enriched flow messages."""
    from telescry.functions.net import ipv4_text

    li = lines.withColumn("_src", ipv4_text(views.src_int())).withColumn("_dst", ipv4_text(views.dst_int()))
    null = lambda t: F.lit(None).cast(t)
    stamp = F.concat(F.date_format(F.col("l_shipdate").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    hops = [F.when(F.lit(i) < F.col("l_linenumber"), F.lit(str(i + 1))).alias(f"as_hop{i}_padding") for i in range(20)]
    exps = [(F.lit("x") if i == 2 else F.lit(str(i))).alias(f"exp{i}") for i in range(20)]
    bgp = F.struct(
        F.col("l_partkey").alias("peer_as_dst"), null("string").alias("next_hop"), F.array(F.col("l_suppkey"), F.col("l_partkey")).alias("as_path"),
        null("array<string>").alias("comms"), null("array<string>").alias("ecomms"), null("array<string>").alias("lcomms"),
        null("bigint").alias("local_pref"), null("bigint").alias("med"), *hops)
    mpls = F.struct(
        null("array<bigint>").alias("labels"), null("bigint").alias("bottom_label"), null("bigint").alias("pw_id"), null("string").alias("top_label_ip"),
        null("bigint").alias("top_label_type"), null("string").alias("vpn_rd"), *exps)
    meta = F.struct(
        F.lit("sensor").alias("sensor_id"), F.lit("sflow").alias("flow_type"), F.struct(F.concat(F.lit("NATION_"), (F.col("l_suppkey") % 30).cast("string")).alias("name")).alias("router"),
        F.when(F.col("l_linenumber") != 7, F.col("l_suppkey")).alias("src_asn"), F.col("_src").alias("src_ip"), (F.col("l_orderkey") % PORTS).cast("int").alias("src_port"),
        F.col("l_partkey").alias("dst_asn"), F.col("_dst").alias("dst_ip"), F.lit(443).alias("dst_port"), F.lit("tcp").alias("protocol"),
        F.struct(F.lpad((F.col("l_partkey") % 50).cast("string"), 12, "0").alias("id")).alias("iface_in"), F.struct(null("string").alias("id")).alias("iface_out"),
        F.lit(4).alias("ip_version"), null("int").alias("app_port"), null("bigint").alias("dscp"), null("bigint").alias("ip_tos"),
        F.struct(null("bigint").alias("flow_label")).alias("ipv6"),
        F.struct(F.array(F.concat(F.lit("g"), (F.col("l_suppkey") % 10).cast("string"))).alias("src"), null("array<string>").alias("dst")).alias("service"),
        bgp.alias("bgp"), mpls.alias("mpls"))
    return li.select(
        stamp.alias("start"), stamp.alias("end"), meta.alias("meta"),
        F.struct(F.lit("org").alias("originator"), F.lit("tlp:red").alias("level"), null("array<string>").alias("scopes")).alias("policy"),
        F.struct(F.col("l_orderkey").alias("num_bits"), F.col("l_linenumber").cast("bigint").alias("num_packets")).alias("values"))


@registered("g16_enriched_source", f"""
WITH {SUBNET_CTE}, {lpm_cte("m", SRC_SQL)}
SELECT CAST(epoch(l_shipdate) AS BIGINT) AS start_epoch, l_suppkey AS src_as_id, l_partkey AS dst_as_id, m.partkey || '__v1' AS src_ip_ref,
  CASE WHEN n_name IS NOT NULL THEN n_name || '__v1' END AS device_ref, CASE WHEN p_partkey IS NOT NULL THEN l_partkey || '__v1' END AS dst_as_ref,
  s_suppkey || '__v1' AS in_interface_ref, l_orderkey AS bit_count, l_linenumber AS packet_count, 0 AS application_port, false AS in_interface_edge,
  '{{"bgp_as_path_id":[' || l_suppkey || ',' || l_partkey || '],"bgp_as_path_padding":[' || array_to_string(range(1, l_linenumber + 1), ',')
  || '],"bgp_community":[],"bgp_ext_community":[],"bgp_large_community":[],"mpls_exp":[0,1],"mpls_label":[],"src_ip_service_ref":['
  || CASE WHEN l_suppkey % 10 < 5 THEN '"g' || (l_suppkey % 10) || '__v1"' ELSE '' END || '],"dst_ip_service_ref":[]}}' AS ext
FROM lineitem LEFT JOIN m ON m.ip = {SRC_SQL} LEFT JOIN nation ON n_name = 'NATION_' || (l_suppkey % 30)
LEFT JOIN part ON p_partkey = l_partkey AND p_partkey % 3 <> 0 LEFT JOIN supplier ON s_suppkey = l_partkey % 50
WHERE l_linenumber <> 7""")
def g16(spark, sf_dir):
    services = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") % 5).alias("g")).distinct().select(
        F.concat(F.lit("g"), F.col("g").cast("string")).alias("id"), F.concat(F.lit("g"), F.col("g").cast("string"), F.lit("__v1")).alias("ref"))
    out = flows.project_enriched_flows(
        _enriched_messages(table(spark, sf_dir, "lineitem")), FlowConfig(extensions=("bgp", "mpls")),
        ip=prefix.subnet_index(views.ip_blocks(spark, sf_dir), ["ref"]), as_refs=views.as_refs(spark, sf_dir),
        device_refs=views.devices(spark, sf_dir).select("id", "ref"), interface_refs=views.interfaces(spark, sf_dir).select("id", "ref"),
        service_refs=services)
    return out.withColumn("start_epoch", F.unix_timestamp("start_time")).select(
        "start_epoch", "src_as_id", "dst_as_id", "src_ip_ref", "device_ref", "dst_as_ref", "in_interface_ref", "bit_count", "packet_count",
        "application_port", "in_interface_edge", "ext")


__all__ = ["CONFIG", "enriched", "lookup", "lookups"]
