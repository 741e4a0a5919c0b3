"""Network-shaped views of the benchmark tables, for Spark and, as SQL text, for the oracle.

Every view covers its whole table; the arithmetic gives the same integers in both engines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telescry.functions.net import ipv4_text

IP_SPACE = 4294967296
PORTS = 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def src_int() -> Column:
    return F.expr(f"(l_partkey * 2654435761 + l_linenumber * 97) % {IP_SPACE}")


def dst_int() -> Column:
    return F.expr(f"(l_suppkey * 40503 * 65537 + l_orderkey * 2654435) % {IP_SPACE}")


SRC_SQL = f"((l_partkey * 2654435761 + l_linenumber * 97) % {IP_SPACE})"
DST_SQL = f"((l_suppkey * 40503 * 65537 + l_orderkey * 2654435) % {IP_SPACE})"


def sql_ip(value: str) -> str:
    """DuckDB: integer -> dotted text."""
    return (f"(({value}) // 16777216)::VARCHAR || '.' || ((({value}) // 65536) % 256)::VARCHAR || '.' || "
            f"((({value}) // 256) % 256)::VARCHAR || '.' || (({value}) % 256)::VARCHAR")


PROTO_SQL = "CASE l_linenumber % 3 WHEN 0 THEN 'TCP' WHEN 1 THEN 'udp' ELSE 'icmp' END"


def flows_wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as raw flow messages (all values as text, like a JSON source gives them)."""
    li = table(spark, sf_dir, "lineitem")
    text = lambda e: F.expr(e).cast("string")
    return li.select(
        ipv4_text(src_int()).alias("ip_src"),
        ipv4_text(dst_int()).alias("ip_dst"),
        text(f"l_orderkey % {PORTS}").alias("port_src"),
        text(f"l_partkey % {PORTS}").alias("port_dst"),
        F.expr(PROTO_SQL).alias("ip_proto"),
        F.concat((F.unix_timestamp(F.col("l_shipdate").cast("timestamp")) + F.expr("l_orderkey * 37 % 86400")).cast("string"), F.lit(".0")).alias("timestamp_start"),
        F.lit(None).cast("string").alias("timestamp_end"),
        text("CAST(l_quantity AS BIGINT) * 100").alias("bytes"),
        text("l_linenumber").alias("packets"),
        F.expr("CASE l_returnflag WHEN 'A' THEN 'nfacctd' WHEN 'R' THEN 'sfacctd' END").alias("writer_id"),
        F.col("l_linestatus").alias("label"),
        F.expr("CASE l_suppkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '0' ELSE CAST(l_suppkey AS STRING) END").alias("as_src"),
        F.expr("CASE l_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'x' ELSE CAST(l_partkey AS STRING) END").alias("as_dst"),
        F.expr("CASE WHEN l_suppkey % 11 = 0 THEN '' ELSE concat('10.0.0.', l_suppkey % 30) END").alias("peer_ip_src"),
        text("l_partkey % 50").alias("iface_in"),
        text("l_orderkey % 50").alias("iface_out"),
        F.expr("concat_ws('_', 65000 + l_suppkey % 3, 65000 + l_partkey % 3, 'x', 65000 + l_orderkey % 3, 65000 + l_orderkey % 3)").alias("as_path"),
        text("l_orderkey % 256").alias("tos"),
        F.expr("lower(concat_ws('_', concat(lpad(hex(l_partkey % 256), 2, '0'), '-', lpad(hex(l_suppkey % 256), 2, '0'), '-', "
               "lpad(hex(l_linenumber * 16 % 256), 2, '0')), CASE WHEN l_linenumber % 2 = 0 THEN 'zz' ELSE '00-00-0e' END))").alias("mpls_label"),
        F.expr("concat('65000:', l_partkey % 3)").alias("mpls_vpn_rd"),
    )


COMMUNITIES = {"0": "blue", "1": "red"}

# prefix table of part: bits 1..4 vary so that probes hit, miss and nest
LEN_SQL = "CASE p_size % 5 WHEN 0 THEN 10 WHEN 1 THEN 12 WHEN 2 THEN 14 WHEN 3 THEN 16 ELSE 20 END"
NET_SQL = f"((p_partkey * 2654435761) % {IP_SPACE})"


def ip_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as IP metadata: one prefix per part, AS = part key."""
    part = table(spark, sf_dir, "part")
    net, length = F.expr(NET_SQL), F.expr(LEN_SQL)
    return part.select(
        F.lpad(F.col("p_partkey").cast("string"), 12, "0").alias("id"),
        F.concat(F.col("p_partkey").cast("string"), F.lit("__v1")).alias("ref"),
        F.array(F.struct(ipv4_text(net).alias("ip"), length.alias("len"))).alias("ip_subnet"),
        F.when(F.col("p_partkey") % 5 != 0, F.col("p_partkey")).alias("as_id"),
        F.lit("1992-01-01").cast("timestamp").alias("insert_time"),
    )


SUBNET_CTE = f"""
subnet AS (
  SELECT plen, net, max(p_partkey) AS partkey FROM (
    SELECT {LEN_SQL} AS plen, ({NET_SQL}) >> (32 - {LEN_SQL}) AS net, p_partkey FROM part) s
  GROUP BY plen, net)"""


def lpm_cte(name: str, value_sql: str, source: str = "lineitem") -> str:
    """DuckDB: brute-force longest-prefix match of every distinct integer address."""
    return f"""
{name} AS (
  SELECT p.ip, s.partkey, s.plen FROM (SELECT DISTINCT {value_sql} AS ip FROM {source}) p
  JOIN subnet s ON (p.ip >> (32 - s.plen)) = s.net
  QUALIFY row_number() OVER (PARTITION BY p.ip ORDER BY s.plen DESC) = 1)"""


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as port ranges; some bounds reversed, some ids empty."""
    part = table(spark, sf_dir, "part")
    lo = F.expr(f"p_partkey * 37 % {PORTS}")
    hi = lo + F.col("p_size")
    turned = F.col("p_partkey") % 10 == 0
    return part.select(
        F.when(F.col("p_partkey") % 17 == 0, F.lit("")).otherwise(F.col("p_name")).alias("id"),
        F.expr("CASE p_partkey % 3 WHEN 0 THEN 'TCP' WHEN 1 THEN 'udp' ELSE 'Icmp' END").alias("protocol"),
        F.when(turned, hi).otherwise(lo).alias("port_range_min"),
        F.when(turned, lo).otherwise(hi).alias("port_range_max"),
        F.col("p_partkey").alias("pos"),
    )


APP_CTE = f"""
app AS (
  SELECT CASE WHEN p_partkey % 17 = 0 THEN '' ELSE p_name END AS id,
         CASE p_partkey % 3 WHEN 0 THEN 'TCP' WHEN 1 THEN 'udp' ELSE 'Icmp' END AS protocol,
         CASE WHEN p_partkey % 10 = 0 THEN p_partkey * 37 % {PORTS} + p_size ELSE p_partkey * 37 % {PORTS} END AS mn,
         CASE WHEN p_partkey % 10 = 0 THEN p_partkey * 37 % {PORTS} ELSE p_partkey * 37 % {PORTS} + p_size END AS mx
  FROM part)"""


def interfaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier as interface metadata: device = nation, flow index = key modulo 50, even keys are edges."""
    s = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return s.select(
        F.lpad(F.col("s_suppkey").cast("string"), 12, "0").alias("id"),
        F.concat(F.col("s_suppkey").cast("string"), F.lit("__v1")).alias("ref"),
        F.col("n_name").alias("device_id"), (F.col("s_suppkey") % 50).alias("flow_index"),
        (F.col("s_suppkey") % 2 == 0).alias("edge"), F.lit("1992-01-01").cast("timestamp").alias("insert_time"),
    )


IFACE_CTE = """
iface AS (
  SELECT n_name AS device_id, s_suppkey % 50 AS idx, s_suppkey % 2 = 0 AS edge,
         lpad(s_suppkey::VARCHAR, 12, '0') AS id, s_suppkey::VARCHAR || '__v1' AS ref
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  QUALIFY row_number() OVER (PARTITION BY n_name, s_suppkey % 50 ORDER BY (s_suppkey % 2 = 0) DESC, s_suppkey DESC) = 1)"""


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation as device metadata with two loopback addresses each, one written as mapped IPv6."""
    n = table(spark, sf_dir, "nation")
    return n.select(
        F.col("n_name").alias("id"), F.concat("n_name", F.lit("__v1")).alias("ref"),
        F.array(F.concat(F.lit("::ffff:10.0.0."), F.col("n_nationkey").cast("string")),
                F.concat(F.lit("10.0.1."), F.col("n_nationkey").cast("string"))).alias("loopback_ip"),
        F.lit("1992-01-01").cast("timestamp").alias("insert_time"),
    )


def out_of_reach(key: str, where: str) -> Column:
    """The key, negative where the condition holds: the whole table is a lookup side, and probes of these keys still miss."""
    return F.expr(f"CASE WHEN {where} THEN -1 - {key} ELSE {key} END")


def as_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part keys as known AS numbers, out of reach where divisible by 3."""
    part = table(spark, sf_dir, "part").select(out_of_reach("p_partkey", "p_partkey % 3 = 0").alias("id"))
    return part.select("id", F.concat(F.col("id").cast("string"), F.lit("__v1")).alias("ref"))


FLOW_CTE = f"""
wire AS (
  SELECT {SRC_SQL} AS src, {DST_SQL} AS dst, l_orderkey % {PORTS} AS sport, l_partkey % {PORTS} AS dport,
         {PROTO_SQL} AS protocol, l_shipdate + to_seconds(l_orderkey * 37 % 86400) AS start_time, (CAST(l_quantity AS BIGINT) * 100) * 8 AS bit_count,
         l_linenumber AS packet_count, l_linestatus AS collector_id,
         CASE l_returnflag WHEN 'A' THEN 'netflow' WHEN 'R' THEN 'sflow' ELSE 'unknown' END AS flow_type,
         CASE l_suppkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE l_suppkey END AS as_src,
         CASE l_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'x' ELSE l_partkey::VARCHAR END AS as_dst,
         CASE WHEN l_suppkey % 11 = 0 THEN NULL ELSE l_suppkey % 30 END AS dev,
         l_partkey % 50 AS if_in, l_orderkey % 50 AS if_out, l_partkey % 3 AS rd,
         l_orderkey % 256 AS tos
  FROM lineitem),
{SUBNET_CTE.strip()},
{lpm_cte("m_src", SRC_SQL).strip()},
{lpm_cte("m_dst", DST_SQL).strip()},
{IFACE_CTE.strip()},
{APP_CTE.strip()},
known AS (
  SELECT DISTINCT q.k, q.v FROM (
    SELECT DISTINCT lower(protocol) AS k, sport AS v FROM wire
    UNION SELECT DISTINCT lower(protocol), dport FROM wire) q
  JOIN app ON lower(app.protocol) = q.k AND q.v BETWEEN least(mn, mx) AND greatest(mn, mx) AND app.id <> ''),
flow AS (
  SELECT w.start_time, w.collector_id, w.flow_type, w.protocol, w.src, w.dst, w.sport, w.dport, w.bit_count,
         w.packet_count, w.tos, ms.partkey AS src_part, md.partkey AS dst_part,
         CASE WHEN ms.ip IS NOT NULL AND coalesce(w.as_src, 0) = 0
              THEN CASE WHEN ms.partkey % 5 <> 0 THEN ms.partkey END ELSE w.as_src END AS src_as_id,
         CASE WHEN md.ip IS NOT NULL AND w.as_dst IS NULL
              THEN CASE WHEN md.partkey % 5 <> 0 THEN md.partkey END
              WHEN w.as_dst = 'x' THEN 0 ELSE w.as_dst::BIGINT END AS dst_as_id,
         w.as_dst AS as_dst_text,
         coalesce(d.n_name, CASE WHEN w.dev IS NULL THEN 'unknown' ELSE '10.0.0.' || w.dev END) AS device_id,
         d.n_name || '__v1' AS device_ref, w.if_in, w.if_out, w.rd,
         CASE WHEN ks.v IS NOT NULL AND kd.v IS NOT NULL THEN least(w.sport, w.dport)
              WHEN ks.v IS NOT NULL THEN w.sport WHEN kd.v IS NOT NULL THEN w.dport ELSE 0 END AS application_port
  FROM wire w
  LEFT JOIN m_src ms ON ms.ip = w.src LEFT JOIN m_dst md ON md.ip = w.dst
  LEFT JOIN nation d ON d.n_nationkey = w.dev
  LEFT JOIN known ks ON ks.k = lower(w.protocol) AND ks.v = w.sport
  LEFT JOIN known kd ON kd.k = lower(w.protocol) AND kd.v = w.dport),
enriched AS (
  SELECT f.*, i.id AS in_id, i.ref AS in_ref, coalesce(i.edge, false) AS in_edge,
         o.id AS out_id, o.ref AS out_ref, coalesce(o.edge, false) AS out_edge,
         CASE WHEN EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = f.src_as_id AND p.p_partkey % 3 <> 0)
              THEN src_as_id::VARCHAR || '__v1' END AS src_as_ref,
         CASE WHEN coalesce(as_dst_text, '') <> 'x' AND EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = f.dst_as_id AND p.p_partkey % 3 <> 0)
              THEN dst_as_id::VARCHAR || '__v1' END AS dst_as_ref
  FROM flow f
  LEFT JOIN iface i ON i.device_id = f.device_id AND i.idx = f.if_in
  LEFT JOIN iface o ON o.device_id = f.device_id AND o.idx = f.if_out)"""


def metric_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as SNMP messages: two devices' worth of indexes per user, mixed field types."""
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    name = F.expr("CASE event_id % 4 WHEN 0 THEN 'snmp_if' WHEN 1 THEN 'snmp_queue' WHEN 2 THEN 'snmp_sap' ELSE 'snmp_other' END")
    device = F.concat(F.lit("router"), (F.col("user_id") % 20).cast("string"), F.lit(".example.com"))
    port = F.expr("(user_id % 8 + 1) * 33554432 + (event_id % 6 + 1) * 2097152 + (event_id % 12 + 1) * 32768")
    index = F.expr("CASE event_id % 4 WHEN 1 THEN concat(event_id % 3, '.', user_id % 40, '.', event_id % 5) END")
    index = F.coalesce(index, F.when(F.col("event_id") % 4 == 2, F.concat_ws(".", (F.col("user_id") % 7).cast("string"), port.cast("string"), F.lit("100"))),
                       (F.col("user_id") % 40).cast("string"))
    fields = F.concat(
        F.lit('{"gauge": '), F.col("value").cast("decimal(20,3)").cast("string"), F.lit(', "counter": '), F.coalesce(k, F.lit("null")),
        F.lit(', "flag": '), F.when(F.col("event_id") % 2 == 0, F.lit("true")).otherwise(F.lit("false")),
        F.lit(', "state": "'), F.col("event_type"),
        F.lit('", "SNMP_IF-MIB::ifHCInOctets": '), (F.col("event_id") * 1000).cast("string"),
        F.lit(', "SNMP_IF-MIB::ifAdminStatus": '), (F.col("event_id") % 5).cast("string"),
        F.lit(', "SNMP_IF-MIB::ifName": "'), F.concat(F.lit("eth"), (F.col("user_id") % 40).cast("string")), F.lit('"}'))
    tags = F.create_map(
        F.lit("device"), device, F.lit("oidIndex"), index, F.lit("interval"), F.lit("300"), F.lit("date"), F.lit("x"),
        F.lit("site"), F.concat(F.lit("s"), (F.col("user_id") % 3).cast("string")))
    return ev.select(
        name.alias("name"), F.unix_timestamp(F.col("ts").cast("timestamp")).cast("string").alias("timestamp"),
        F.lit("300").alias("interval"), tags.alias("tags"), fields.alias("fields"), "event_id", "user_id")


RULES = r"""
_default:
  resource_id:
    - {type: field, format: short_hostname, path: [tags, device]}
    - {type: field, path: [tags, oidIndex]}
snmp_if:
  resource_type: interface
  resource_id:
    - {type: field, format: short_hostname, path: [tags, device]}
    - {type: field, lookup: ifindex_to_ifname, path: [tags, oidIndex]}
  resource_ref: meta_interface
  resource_lookup_tables:
    - name: ifindex_to_ifname
      key:
        - {type: field, format: short_hostname, path: [tags, device]}
        - {type: field, path: [tags, oidIndex]}
      value: {type: field, path: [fields, "SNMP_IF-MIB::ifName"]}
snmp_queue:
  resource_type: interface
  resource_id:
    - {type: field, format: short_hostname, path: [tags, device]}
    - type: field
      format: regex
      format_opts: {pattern: '[0-9]+[.](?P<value>[0-9]+)[.](?P<queue_num>[0-9]+)'}
      lookup: ifindex_to_ifname
      path: [tags, oidIndex]
  resource_ref: meta_interface
snmp_sap:
  resource_type: interface
  resource_id:
    - {type: field, format: short_hostname, path: [tags, device]}
    - {type: field, format: tmnxsapid, path: [tags, oidIndex]}
snmp_other:
  resource_type: chassis_part
  skip_tags: [site]
"""

METRIC_CTE = """
msg AS (
  SELECT event_id, user_id, value, event_type, json_extract_string(props, '$.k') AS k,
         CAST(floor(epoch(ts)) AS BIGINT) AS t, event_id % 4 AS rule, 'router' || (user_id % 20) AS device,
         CASE event_id % 4
           WHEN 1 THEN (event_id % 3) || '.' || (user_id % 40) || '.' || (event_id % 5)
           WHEN 2 THEN (user_id % 7) || '.' || ((user_id % 8 + 1) * 33554432 + (event_id % 6 + 1) * 2097152 + (event_id % 12 + 1) * 32768) || '.100'
           ELSE (user_id % 40)::VARCHAR END AS idx,
         (user_id % 7) || '-' || (user_id % 8 + 1) || '/' || (event_id % 6 + 1) || '/' || (event_id % 12 + 1) || '-100' AS sap,
         's' || (user_id % 3) AS site
  FROM events),
kv AS (
  SELECT DISTINCT device || '::' || idx AS key, 'eth' || (user_id % 40) AS value FROM msg WHERE rule = 0),
resolved AS (
  SELECT m.*, m.device || '::' || CASE m.rule
      WHEN 0 THEN coalesce(kv.value, m.idx)
      WHEN 1 THEN coalesce(kq.value, (m.user_id % 40)::VARCHAR)
      WHEN 2 THEN m.sap ELSE m.idx END AS id,
    CASE m.rule WHEN 1 THEN (m.event_id % 5)::VARCHAR END AS queue_num
  FROM msg m
  LEFT JOIN kv ON m.rule = 0 AND kv.key = m.device || '::' || m.idx
  LEFT JOIN kv kq ON m.rule = 1 AND kq.key = m.device || '::' || (m.user_id % 40))"""


