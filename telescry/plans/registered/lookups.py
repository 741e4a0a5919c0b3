"""Snapshots, key tables and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telescry.functions.net import ipv4_text
from telescry.operators import keyed, lookup, prefix, ranges, snapshot
from telescry.operators.snapshot import LookupSpec
from telescry.plans import views
from telescry.plans.registered import registered
from telescry.plans.views import (
    APP_CTE, DST_SQL, IFACE_CTE, METRIC_CTE, PORTS, PROTO_SQL, SRC_SQL, SUBNET_CTE, lpm_cte, sql_ip, table,
)


@registered("c1_latest_order_per_customer", """
SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def c1(spark, sf_dir):
    return snapshot.latest(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderkey", "o_orderstatus", "o_totalprice"],
                           [F.col("o_orderdate"), F.col("o_orderkey")])


def _order_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as an append-only metadata table: id = customer, version = order key; some rows lack ref or status."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").cast("string").alias("id"),
        F.when(F.col("o_orderkey") % 13 != 0, F.concat(F.col("o_custkey").cast("string"), F.lit("__v"), F.col("o_orderkey").cast("string"))).alias("ref"),
        F.date_trunc("year", "o_orderdate").alias("insert_time"),
        F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderstatus")).alias("status"),
        F.split("o_orderpriority", "[- ]").alias("words"), (F.col("o_orderkey") % 2 == 0).alias("edge"))


_VERSIONS = """
v AS (SELECT o_custkey::VARCHAR AS id, CASE WHEN o_orderkey % 13 <> 0 THEN o_custkey || '__v' || o_orderkey END AS ref,
        date_trunc('year', o_orderdate) AS t, o_orderkey AS k, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus END AS status,
        string_split(replace(o_orderpriority, '-', ' '), ' ') AS words, o_orderkey % 2 = 0 AS edge FROM orders)"""


@registered("c1_current_versions", f"""
WITH {_VERSIONS} SELECT id, ref, status FROM v WHERE ref IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY id ORDER BY t DESC, k DESC) = 1""")
def c1_current(spark, sf_dir):
    return snapshot.current(_order_versions(spark, sf_dir), ["ref", "status"])


@registered("c3_array_explode", f"""
WITH {_VERSIONS}, l AS (SELECT id, ref, status, words FROM v WHERE ref IS NOT NULL AND status IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY t DESC, k DESC) = 1)
SELECT id, ref, status, unnest(words) AS words FROM l""")
def c3(spark, sf_dir):
    rows = snapshot.lookup_rows(_order_versions(spark, sf_dir), LookupSpec.parse("meta_order:status:@words"))
    return rows.select("id", "ref", "status", "words")


@registered("c4_newest_wins_composite_key", f"""
WITH {_VERSIONS}, l AS (SELECT id, ref, status, edge, max(t) OVER (PARTITION BY id) AS mt, t, k FROM v
    WHERE ref IS NOT NULL AND status IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY t DESC, k DESC) = 1),
w AS (SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY status, edge, length(id) ORDER BY mt DESC, id DESC) = 1)
SELECT status || ':' || CASE WHEN edge THEN 'True' ELSE 'False' END || ':' || length(id) AS key, id, ref FROM w""")
def c4(spark, sf_dir):
    rows = snapshot.lookup_rows(_order_versions(spark, sf_dir), LookupSpec.parse("meta_order:status:edge"))
    rows = rows.withColumn("size", F.length("id"))
    won = snapshot.key_index(rows, ["status", "edge", "size"], ["id", "ref"])
    return won.select(snapshot.key_text(won, ["status", "edge", "size"]).alias("key"), "id", "ref")


@registered("c4_key_text", """
SELECT p_partkey, concat_ws(':', p_brand, CASE WHEN p_size % 3 > 0 THEN p_size::VARCHAR END,
  CASE WHEN p_size % 2 = 0 THEN 'True' ELSE 'False' END, '10.0.0.' || p_size) AS key FROM part""")
def c4_text(spark, sf_dir):
    df = table(spark, sf_dir, "part").select(
        "p_partkey", "p_brand", F.when(F.col("p_size") % 3 > 0, F.col("p_size")).alias("size"),
        (F.col("p_size") % 2 == 0).alias("even"), F.concat(F.lit("::ffff:10.0.0."), F.col("p_size").cast("string")).alias("ip"))
    return df.select("p_partkey", snapshot.key_text(df, ["p_brand", "size", "even", "ip"]).alias("key"))


@registered("c5_kv_refs", f"""
WITH {_VERSIONS}, l AS (SELECT id, ref, status FROM v WHERE ref IS NOT NULL AND status IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY t DESC, k DESC) = 1),
l0 AS (SELECT id, ref FROM v WHERE ref IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY t DESC, k DESC) = 1)
SELECT 'meta_order:status' AS "table", 'meta_order__status:' || status AS key, id AS value FROM l
UNION ALL SELECT 'meta_order', 'meta_order:' || id, ref FROM l0""")
def c5(spark, sf_dir):
    df = _order_versions(spark, sf_dir)
    parts = [keyed.kv_refs(df, LookupSpec.parse(t), t).drop("max_insert_time") for t in ("meta_order:status", "meta_order")]
    return parts[0].unionByName(parts[1])


@registered("c5_load_stats", f"""
WITH {_VERSIONS} SELECT 'meta_order' AS "table", count(DISTINCT id) AS record_count FROM v WHERE ref IS NOT NULL""")
def c5_stats(spark, sf_dir):
    refs = keyed.kv_refs(_order_versions(spark, sf_dir), LookupSpec.parse("meta_order"), "meta_order")
    return keyed.kv_load_stats(refs, F.lit(0)).drop("last_updated")


@registered("c6_range_table", f"""
WITH {APP_CTE} SELECT DISTINCT lower(protocol) AS key, least(mn, mx) AS lo, greatest(mn, mx) AS hi, id AS value FROM app""")
def c6(spark, sf_dir):
    return ranges.range_table(views.applications(spark, sf_dir), "port_range_min", "port_range_max", "protocol", "id")


@registered("c7_subnet_index", f"""
WITH {SUBNET_CTE} SELECT 4 AS family, plen, net << (32 - plen) AS lo, partkey || '__v1' AS ref FROM subnet""")
def c7(spark, sf_dir):
    return prefix.subnet_index(views.ip_blocks(spark, sf_dir), ["ref"]).drop("hi")


_KV_EVENTS = """
w AS (SELECT event_type AS "table", user_id::VARCHAR AS key, props AS value, ts,
             CAST(json_extract_string(props, '$.k') AS INT) * 7200 AS expires FROM events
      QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, props DESC) = 1)"""


@registered("c8_live_entries", f"""
WITH {_KV_EVENTS} SELECT "table", key, value FROM w
WHERE expires <= 0 OR floor(epoch(ts)) + expires > epoch(TIMESTAMP '2024-01-25 00:00:00')""")
def c8(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    kv = ev.select(F.col("event_type").alias("table"), F.col("user_id").cast("string").alias("key"), F.col("props").alias("value"),
                   F.col("ts").cast("timestamp").alias("updated_at"),
                   (F.get_json_object("props", "$.k").cast("int") * 7200).alias("expires"))
    return keyed.kv_view(kv, F.lit("2024-01-25").cast("timestamp")).select("table", "key", "value")


@registered("c10_index_lookup", f"WITH {METRIC_CTE} SELECT 'ifindex_to_ifname' AS \"table\", key, value FROM kv")
def c10(spark, sf_dir):
    from telescry.operators.metrics import Rules, tokens

    rules = Rules.parse(views.RULES)
    return keyed.index_lookup(tokens(views.metric_messages(spark, sf_dir)), rules.by_name).distinct()


_UUID = "substr(m, 1, 8) || '-' || substr(m, 9, 4) || '-' || substr(m, 13, 4) || '-' || substr(m, 17, 4) || '-' || substr(m, 21, 12)"


@registered("c11_uri_inversion", f"""
SELECT 'iri_site_to_facility' AS "table", {_UUID} AS key, 'f' || o_custkey AS value
FROM (SELECT md5(o_orderkey::VARCHAR) AS m, o_custkey FROM orders) t""")
def c11(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("m", F.md5(F.col("o_orderkey").cast("string")))
    uri = F.concat(F.lit("https://api.example.org/facility/sites/"), F.expr(_UUID), F.lit("/"))
    rows = o.select(F.concat(F.lit("f"), F.col("o_custkey").cast("string")).alias("id"),
                    F.array(uri, F.lit("https://api.example.org/facility/sites/short")).alias("site_uris"))
    return keyed.invert_refs(rows, "site_uris", "iri_site_to_facility")


def _polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer as device polls of interfaces."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    text = lambda e: F.expr(e).cast("string")
    return c.select("c_custkey", F.struct(
        F.concat(F.lit("dev"), F.col("c_nationkey").cast("string"), F.lit("::if"), k.cast("string")).alias("id"),
        F.when(k % 6 != 0, F.concat(F.lit("if"), k.cast("string"))).alias("name"),
        F.concat(F.lit("dev"), F.col("c_nationkey").cast("string")).alias("device"), F.col("c_name").alias("descr"),
        F.expr("CASE c_custkey % 4 WHEN 0 THEN 'true' WHEN 1 THEN 'false' WHEN 2 THEN '[true,false]' END").alias("intercloud"),
        text("nullif(c_custkey % 9, 0)").alias("if_index"), text("c_custkey % 100 + 1000").alias("vrtr_ifglobalindex"),
        F.lit(None).cast("string").alias("vrtr_ifindex"), F.expr("CASE WHEN c_custkey % 7 = 0 THEN 'vpn1' END").alias("vrtr_name"),
        F.lit(None).cast("string").alias("vrtr_ifencapvalue"), F.lit(None).cast("string").alias("sap_name"),
        F.lit(None).cast("string").alias("ipv4"), F.lit(None).cast("string").alias("ipv6"), text("c_custkey * 10").alias("speed"),
        F.expr("CASE WHEN c_custkey % 5 = 0 THEN 'VPLS' END").alias("service_type"), (k % 3 == 0).alias("is_lag"),
        F.expr("CASE WHEN c_custkey % 2 = 0 THEN concat('p', c_custkey % 10) END").alias("port_name"),
        (k % 8 != 0).alias("visibility"), F.struct(F.array(F.concat(F.lit("c"), k.cast("string"))).alias("id")).alias("circuits"),
        F.lit(None).cast("array<string>").alias("lag_members"),
        F.struct(text("c_custkey + 64512").alias("asn"), F.lit(None).cast("string").alias("ipv4"), F.lit(None).cast("string").alias("ipv6")).alias("peer"),
        F.struct(F.lit(None).cast("string").alias("id")).alias("remote"), F.struct(F.col("c_mktsegment").alias("short_name")).alias("org"),
    ).alias("meta"))


_POLLS = """
r AS (SELECT 'dev' || c_nationkey || '::if' || c_custkey AS id,
  CASE WHEN c_custkey % 5 = 0 THEN 'service_vpls' WHEN c_custkey % 7 = 0 THEN 'service_l3vpn' WHEN c_custkey % 3 = 0 THEN 'lag'
       WHEN c_custkey % 2 = 0 THEN 'interface' ELSE 'port' END AS type,
  CASE c_custkey % 4 WHEN 0 THEN 'true' WHEN 1 THEN 'false' WHEN 2 THEN 'true' END AS edge,
  coalesce(nullif(c_custkey % 9, 0), c_custkey % 100 + 1000)::VARCHAR AS flow_index, 'if' || c_custkey AS name,
  '["c' || c_custkey || '"]' AS circuit_id,
  CASE WHEN c_custkey % 2 = 0 THEN 'dev' || c_nationkey || '::p' || (c_custkey % 10) END AS port_interface_id,
  CASE WHEN c_custkey % 8 = 0 THEN '["hide"]' ELSE '[]' END AS tags,
  '{"vrtr_interface_global_index":"' || (c_custkey % 100 + 1000) || '"' || CASE WHEN c_custkey % 7 = 0 THEN ',"vrtr_id":"vpn1"' ELSE '' END || '}' AS ext
  FROM customer)"""


@registered("c12_interface_records", f"WITH {_POLLS} SELECT * FROM r")
def c12(spark, sf_dir):
    recs = keyed.interface_records(keyed.name_from_id(_polls(spark, sf_dir)))
    return recs.select("id", "type", "edge", "flow_index", "name", "circuit_id", "port_interface_id", "tags", "ext")


@registered("c13_hash_upsert", """
SELECT user_id::VARCHAR AS key, event_type AS field, props AS value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, props DESC) = 1""")
def c13(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    rows = ev.select(F.lit("u").alias("table"), F.col("user_id").cast("string").alias("key"), F.col("event_type").alias("field"),
                     F.col("props").alias("value"), F.col("ts").cast("timestamp").alias("updated_at"), F.lit(0).alias("expires"))
    return keyed.hash_view(rows).select("key", "field", "value")


@registered("a10_keyed_hashes", f"""
WITH {_POLLS} SELECT id AS key, type, edge, flow_index, name FROM r""")
def a10(spark, sf_dir):
    recs = keyed.interface_records(keyed.name_from_id(_polls(spark, sf_dir)))
    view = keyed.hash_view(keyed.hash_rows(recs, "meta_interface_cache", "id", F.lit("2024-01-01").cast("timestamp")))
    return keyed.hash_records(view, "meta_interface_cache", ["type", "edge", "flow_index", "name"])


@registered("d1_lookup_left", """
SELECT o_orderkey, c_name AS customer, c_mktsegment AS segment FROM orders
LEFT JOIN customer ON c_custkey = o_custkey AND c_custkey % 10 <> 0""")
def d1(spark, sf_dir):
    right = table(spark, sf_dir, "customer").withColumn("c_custkey", views.out_of_reach("c_custkey", "c_custkey % 10 = 0"))
    return lookup.lookup_join(table(spark, sf_dir, "orders"), right, {"o_custkey": "c_custkey"},
                              {"c_name": "customer", "c_mktsegment": "segment"}).select("o_orderkey", "customer", "segment")


def _id_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", F.when(F.col("o_orderkey") % 10 != 0, F.array(
        *[F.expr(e).cast("string") for e in ("o_custkey", "o_custkey * 7 % 1000", "o_orderkey % 500")])).alias("ids"))


_LISTS = """
i AS (SELECT o_orderkey, unnest([o_custkey, o_custkey * 7 % 1000, o_orderkey % 500]) AS id, unnest([1, 2, 3]) AS pos
      FROM orders WHERE o_orderkey % 10 <> 0),
f AS (SELECT o_orderkey, pos, CASE WHEN c_custkey % 3 <> 0 THEN c_custkey || '__v1' END AS ref FROM i LEFT JOIN customer ON c_custkey = id)"""


def _customer_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").withColumn("c_custkey", views.out_of_reach("c_custkey", "c_custkey % 3 = 0"))
    return c.select(F.col("c_custkey").cast("string").alias("id"), F.concat(F.col("c_custkey").cast("string"), F.lit("__v1")).alias("ref"))


@registered("d2a_list_aligned", f"""
WITH {_LISTS}, g AS (SELECT o_orderkey, string_agg(coalesce(ref, '-'), ',' ORDER BY pos) AS refs FROM f GROUP BY o_orderkey)
SELECT o.o_orderkey, coalesce(refs, '') AS refs FROM orders o LEFT JOIN g USING (o_orderkey)""")
def d2a(spark, sf_dir):
    out = lookup.lookup_array(_id_lists(spark, sf_dir), "o_orderkey", "ids", _customer_refs(spark, sf_dir), "refs")
    return out.select("o_orderkey", F.array_join("refs", ",", "-").alias("refs"))


@registered("d2b_list_compact", f"""
WITH {_LISTS}, g AS (SELECT o_orderkey, string_agg(ref, ',' ORDER BY pos) AS refs FROM f GROUP BY o_orderkey)
SELECT o.o_orderkey, coalesce(refs, '') AS refs FROM orders o LEFT JOIN g USING (o_orderkey)""")
def d2b(spark, sf_dir):
    out = lookup.lookup_array(_id_lists(spark, sf_dir), "o_orderkey", "ids", _customer_refs(spark, sf_dir), "refs", keep_misses=False)
    return out.select("o_orderkey", F.array_join("refs", ",").alias("refs"))


@registered("d3_lpm_join", f"""
WITH {SUBNET_CTE}, {lpm_cte("m", SRC_SQL)}
SELECT l_orderkey, l_linenumber, {SRC_SQL} AS src, m.partkey || '__v1' AS ref
FROM lineitem LEFT JOIN m ON m.ip = {SRC_SQL}""")
def d3(spark, sf_dir):
    index = prefix.subnet_index(views.ip_blocks(spark, sf_dir), ["ref", "as_id"])
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", views.src_int().alias("src"))
    joined = prefix.lpm_join(li.withColumn("ip", ipv4_text(F.col("src"))), "ip", index, {"ref": "ref"})
    return joined.select("l_orderkey", "l_linenumber", "src", "ref")


@registered("d3_lpm_join_ipv6", f"""
WITH {SUBNET_CTE}, {lpm_cte("m", DST_SQL)}
SELECT l_orderkey, l_linenumber, {DST_SQL} AS dst, m.partkey || '__v1' AS ref
FROM lineitem LEFT JOIN m ON m.ip = {DST_SQL}""")
def d3_v6(spark, sf_dir):
    """The same integers as bits 32..63 of IPv6 addresses and prefixes."""
    def v6(c, tail):
        return F.concat(F.lit("2001:DB8:"), F.hex(F.shiftright(c, 16)), F.lit(":"), F.hex(c.bitwiseAND(65535)), F.lit(tail))

    blocks = views.ip_blocks(spark, sf_dir).withColumn("_net", F.expr(views.NET_SQL.replace("p_partkey", "CAST(id AS BIGINT)")))
    blocks = blocks.withColumn("ip_subnet", F.array(F.struct(v6(F.col("_net"), "::").alias("ip"), (F.col("ip_subnet")[0]["len"] + 32).alias("len"))))
    index = prefix.subnet_index(blocks, ["ref"])
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", views.dst_int().alias("dst"))
    joined = prefix.lpm_join(li.withColumn("ip", v6(F.col("dst"), "::1")), "ip", index, {"ref": "ref"})
    return joined.select("l_orderkey", "l_linenumber", "dst", "ref")


@registered("d5_extra_prefix_tables", f"""
WITH {SUBNET_CTE}, {lpm_cte("ms", SRC_SQL)}, {lpm_cte("md", DST_SQL)}
SELECT l_orderkey, l_linenumber, ms.partkey || '__v1' AS src_ip_site_ref, md.partkey || '__v1' AS dst_ip_site_ref
FROM lineitem LEFT JOIN ms ON ms.ip = {SRC_SQL} LEFT JOIN md ON md.ip = {DST_SQL}""")
def d5(spark, sf_dir):
    indexes = {"site": prefix.subnet_index(views.ip_blocks(spark, sf_dir), ["ref"])}
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", ipv4_text(views.src_int()).alias("s"), ipv4_text(views.dst_int()).alias("d"))
    out = prefix.enrich_ip_ext(prefix.enrich_ip_ext(li, indexes, "s", "src"), indexes, "d", "dst")
    return out.drop("s", "d")


@registered("d6_range_exists", f"""
WITH {APP_CTE}, q AS (SELECT DISTINCT lower({PROTO_SQL}) AS k, l_orderkey % {PORTS} AS v FROM lineitem),
hit AS (SELECT DISTINCT k, v FROM q JOIN app ON lower(app.protocol) = k AND v BETWEEN least(mn, mx) AND greatest(mn, mx) AND id <> '')
SELECT l_orderkey, l_linenumber, hit.v IS NOT NULL AS known FROM lineitem
LEFT JOIN hit ON hit.k = lower({PROTO_SQL}) AND hit.v = l_orderkey % {PORTS}""")
def d6(spark, sf_dir):
    index = ranges.cache_ranges(views.applications(spark, sf_dir))
    li = table(spark, sf_dir, "lineitem")
    out = ranges.range_join(li, index, F.lower(F.expr(PROTO_SQL)), F.col("l_orderkey") % PORTS, "app")
    return out.select("l_orderkey", "l_linenumber", F.col("app").isNotNull().alias("known"))


_DICT = f"""
{APP_CTE.strip()}, q AS (SELECT DISTINCT {PROTO_SQL} AS k, l_orderkey % {PORTS} AS v FROM lineitem),
best AS (SELECT k, v, id FROM q JOIN app ON protocol = k AND v BETWEEN mn AND mx
         QUALIFY row_number() OVER (PARTITION BY k, v ORDER BY mn, mx, id) = 1)"""


@registered("d7_range_min", f"""
WITH {_DICT} SELECT l_orderkey, l_linenumber, best.id AS application_id FROM lineitem
LEFT JOIN best ON best.k = {PROTO_SQL} AND best.v = l_orderkey % {PORTS}""")
def d7(spark, sf_dir):
    index = ranges.dictionary_ranges(views.applications(spark, sf_dir))
    li = table(spark, sf_dir, "lineitem")
    out = ranges.range_join(li, index, F.expr(PROTO_SQL), F.col("l_orderkey") % PORTS, "application_id")
    return out.select("l_orderkey", "l_linenumber", "application_id")


@registered("d6_wide_ranges", f"""
WITH r AS (SELECT o_orderstatus AS k, o_orderkey * 1000 AS lo, o_orderkey * 1000 + CAST(o_totalprice AS BIGINT) AS hi, o_orderkey AS id FROM orders),
q AS (SELECT DISTINCT CASE c_custkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'O' ELSE 'P' END AS k, c_custkey * 9973 AS v, c_custkey FROM customer)
SELECT q.c_custkey, r.id FROM q LEFT JOIN r ON r.k = q.k AND q.v BETWEEN r.lo AND r.hi
QUALIFY row_number() OVER (PARTITION BY q.c_custkey ORDER BY r.lo, r.hi, r.id) = 1""")
def d6_wide(spark, sf_dir):
    """Ranges hundreds of thousands wide that overlap by the hundred."""
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("k"), (F.col("o_orderkey") * 1000).alias("lo"),
        (F.col("o_orderkey") * 1000 + F.round("o_totalprice").cast("bigint")).alias("hi"), F.col("o_orderkey").alias("id"))
    index = ranges.range_index(ranges.range_table(o, "lo", "hi", "k", "id", fold_key=False))
    c = table(spark, sf_dir, "customer")
    out = ranges.range_join(c, index, F.expr("CASE c_custkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'O' ELSE 'P' END"), F.col("c_custkey") * 9973, "id")
    return out.select("c_custkey", "id")


@registered("d8_preferred_edge", f"""
WITH {IFACE_CTE} SELECT c_custkey, i.id AS in_interface_id, i.ref AS in_interface_ref, coalesce(i.edge, false) AS in_interface_edge
FROM customer JOIN nation ON n_nationkey = c_nationkey LEFT JOIN iface i ON i.device_id = n_name AND i.idx = c_custkey % 50""")
def d8(spark, sf_dir):
    preferred = lookup.preferred_interfaces(views.interfaces(spark, sf_dir))
    probes = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    probes = probes.select("c_custkey", F.col("n_name").alias("device_id"), (F.col("c_custkey") % 50).cast("string").alias("idx"))
    return lookup.enrich_interface(probes, preferred, "device_id", "idx", "in").drop("device_id", "idx")


@registered("d9_device_by_address", """
SELECT s_suppkey, coalesce(n_name, CASE WHEN s_suppkey % 11 = 0 THEN 'unknown' ELSE '10.0.1.' || (s_suppkey % 30) END) AS device_id,
       n_name || '__v1' AS device_ref
FROM supplier LEFT JOIN nation ON s_suppkey % 11 <> 0 AND n_nationkey = s_suppkey % 30""")
def d9(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.expr("CASE WHEN s_suppkey % 11 = 0 THEN '' ELSE concat('10.0.1.', s_suppkey % 30) END").alias("ip"))
    return lookup.enrich_device(s, lookup.devices_by_address(views.devices(spark, sf_dir)), "ip").drop("ip")


@registered("d11_chain", """
SELECT s_suppkey, n_name AS nation, r_name AS region FROM supplier
LEFT JOIN nation ON n_nationkey = s_nationkey AND n_nationkey % 5 <> 0 LEFT JOIN region ON r_regionkey = n_regionkey""")
def d11(spark, sf_dir):
    n = table(spark, sf_dir, "nation").withColumn("n_nationkey", views.out_of_reach("n_nationkey", "n_nationkey % 5 = 0"))
    r = table(spark, sf_dir, "region")
    s = table(spark, sf_dir, "supplier")
    out = lookup.chain(s, "s_nationkey", [(n, "n_nationkey", "n_regionkey", "region_key"), (r, "r_regionkey", "r_name", "region")])
    return lookup.lookup_join(out, n, {"s_nationkey": "n_nationkey"}, {"n_name": "nation"}).select("s_suppkey", "nation", "region")


_BLOCKS = """
b AS (SELECT c_custkey, 6 + c_custkey % 22 AS blen, ((c_custkey * 2654435761 + 12345) % 4294967296) AS ip FROM customer)"""


@registered("d12_cidr_in_cidr", f"""
WITH {SUBNET_CTE}, {_BLOCKS}
SELECT c_custkey, partkey AS as_id FROM (
  SELECT b.c_custkey, s.partkey, s.plen FROM b LEFT JOIN subnet s ON s.plen <= b.blen AND (b.ip >> (32 - s.plen)) = s.net) t
QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY plen DESC NULLS LAST) = 1""")
def d12(spark, sf_dir):
    index = prefix.subnet_index(views.ip_blocks(spark, sf_dir).withColumn("part", F.col("id").cast("bigint")), ["part"])
    blocks = geo_rows(spark, sf_dir)
    return prefix.cidr_join(blocks, "network", index, {"part": "as_id"}).select("c_custkey", "as_id")


def geo_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer as geo blocks."""
    c = table(spark, sf_dir, "customer")
    ip = F.expr("(c_custkey * 2654435761 + 12345) % 4294967296")
    return c.select(
        "c_custkey", F.concat(ipv4_text(ip), F.lit("/"), (F.col("c_custkey") % 22 + 6).cast("string")).alias("network"),
        F.when(F.col("c_nationkey") != 3, F.col("c_nationkey").cast("string")).alias("geoname_id"),
        F.col("c_acctbal").cast("string").alias("latitude"), F.lit("x").alias("longitude"))


@registered("d13_geo_blocks", f"""
WITH {SUBNET_CTE}, {_BLOCKS}, m AS (
  SELECT c_custkey, partkey FROM (
    SELECT b.c_custkey, s.partkey, s.plen FROM b JOIN subnet s ON s.plen <= b.blen AND (b.ip >> (32 - s.plen)) = s.net) t
  QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY plen DESC) = 1)
SELECT {sql_ip("b.ip")} || '/' || b.blen AS id, nullif(m.partkey, 0) AS as_id, n_name AS country_name, r_name AS continent_name, c_acctbal AS latitude
FROM b JOIN customer USING (c_custkey) LEFT JOIN m USING (c_custkey)
LEFT JOIN nation ON n_nationkey = c_nationkey AND c_nationkey <> 3 LEFT JOIN region ON r_regionkey = n_regionkey""")
def d13(spark, sf_dir):
    from telescry.operators import registry

    index = prefix.subnet_index(views.ip_blocks(spark, sf_dir).withColumn("as_id", F.col("id").cast("bigint")), ["as_id"])
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    null = F.lit(None).cast("string")
    places = registry.locations(n.select(
        F.col("n_nationkey").cast("string").alias("geoname_id"), F.col("n_nationkey").alias("pos"), F.col("r_name").alias("continent_name"),
        null.alias("country_iso_code"), F.col("n_name").alias("country_name"), null.alias("subdivision_1_iso_code"),
        null.alias("subdivision_1_name"), null.alias("city_name")))
    out = registry.geo_blocks(geo_rows(spark, sf_dir), index, places)
    return out.select("id", "as_id", "country_name", "continent_name", "latitude")


@registered("d14_overlay", """
WITH cu AS (SELECT c_custkey * 2 AS id, c_name AS name, CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END AS seg, c_custkey % 5 AS has FROM customer),
ba AS (SELECT s_suppkey AS id, s_name AS name, s_nationkey::VARCHAR AS seg FROM supplier)
SELECT coalesce(ba.id, cu.id) AS id,
       CASE WHEN cu.id IS NOT NULL AND has > 0 THEN cu.name ELSE ba.name END AS name,
       CASE WHEN cu.id IS NOT NULL AND has > 1 THEN cu.seg ELSE ba.seg END AS seg
FROM ba FULL OUTER JOIN cu ON ba.id = cu.id""")
def d14(spark, sf_dir):
    base = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").cast("string").alias("seg"))
    has = F.expr("CASE c_custkey % 5 WHEN 0 THEN array('id') WHEN 1 THEN array('id', 'name') ELSE array('id', 'name', 'seg') END")
    custom = table(spark, sf_dir, "customer").select(
        (F.col("c_custkey") * 2).alias("id"), F.col("c_name").alias("name"),
        F.expr("CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END").alias("seg"), has.alias("present"))
    return lookup.overlay(base, custom, "id", "present")


_REG_SQL = """
as1 AS (SELECT c_custkey * 2 AS asn, 'caida:o' || c_nationkey AS org, c_name AS name FROM customer),
org1 AS (SELECT 'caida:o' || CASE WHEN n_nationkey % 6 = 5 THEN -1 - n_nationkey ELSE n_nationkey END AS id, CASE WHEN n_nationkey % 4 = 0 THEN 'Delegated' ELSE n_name END AS name,
                CASE WHEN n_nationkey % 3 <> 0 THEN 'R' || n_regionkey END AS cc FROM nation),
org2 AS (SELECT 'peeringdb:' || CASE WHEN n_nationkey = 7 THEN -1 - n_nationkey ELSE n_nationkey END AS id, n_name AS name, 'R' || (n_regionkey + 1) % 5 AS cc, 'city' || n_nationkey AS city FROM nation),
net AS (SELECT s_suppkey AS pos, s_suppkey // 2 * 3 AS asn, 'peeringdb:' || s_nationkey AS org, CASE WHEN s_suppkey % 9 <> 0 THEN s_name END AS name, s_suppkey * 5 AS p4
        FROM supplier WHERE s_nationkey <> 7),
usable AS (SELECT net.*, as1.org AS org1 FROM net LEFT JOIN as1 USING (asn) WHERE as1.asn IS NOT NULL OR net.name IS NOT NULL),
firstnet AS (SELECT * FROM usable QUALIFY row_number() OVER (PARTITION BY asn ORDER BY pos) = 1),
ases AS (SELECT coalesce(as1.asn, f.asn) AS id, CASE WHEN f.asn IS NOT NULL THEN f.name ELSE as1.name END AS name,
                coalesce(as1.org, f.org) AS organization_id, f.p4, as1.asn IS NOT NULL AS in1, f.asn IS NOT NULL AS in2
         FROM as1 FULL OUTER JOIN firstnet f ON as1.asn = f.asn),
filler AS (SELECT a.organization_id AS owner, u.org AS filler FROM usable u JOIN ases a ON a.id = u.asn
           QUALIFY row_number() OVER (PARTITION BY a.organization_id ORDER BY u.pos) = 1),
orgs AS (SELECT id, name, cc, true AS o1 FROM org1 UNION ALL
         SELECT id, name, cc, false FROM org2 WHERE id IN (SELECT organization_id FROM ases WHERE NOT in1))"""


def _registries(spark: SparkSession, sf_dir: str):
    from telescry.operators import registry

    c, n, s, r = (table(spark, sf_dir, t) for t in ("customer", "nation", "supplier", "region"))
    null = F.lit(None).cast("string")
    ases = c.select(
        F.struct(F.lit(0).alias("f"), F.col("c_custkey").cast("bigint").alias("n")).alias("pos"), F.lit("ASN").alias("type"),
        (F.col("c_custkey") * 2).cast("string").alias("asn"), F.concat(F.lit("o"), F.col("c_nationkey").cast("string")).alias("organizationId"),
        F.col("c_name").alias("name"), null.alias("country"))
    orgs = n.select(
        F.struct(F.lit(1).alias("f"), F.col("n_nationkey").cast("bigint").alias("n")).alias("pos"), F.lit("Organization").alias("type"),
        null.alias("asn"), F.concat(F.lit("o"), views.out_of_reach("n_nationkey", "n_nationkey % 6 = 5").cast("string")).alias("organizationId"),
        F.expr("CASE WHEN n_nationkey % 4 <> 0 THEN n_name END").alias("name"),
        F.expr("CASE WHEN n_nationkey % 3 <> 0 THEN concat('R', n_regionkey) ELSE '' END").alias("country"))
    net_orgs = n.select(
        F.col("n_nationkey").cast("bigint").alias("pos"), views.out_of_reach("n_nationkey", "n_nationkey = 7").cast("bigint").alias("id"), F.col("n_name").alias("name"),
        F.expr("concat('R', (n_regionkey + 1) % 5)").alias("country"), F.concat(F.lit("city"), F.col("n_nationkey").cast("string")).alias("city"),
        null.alias("state"), null.alias("latitude"), null.alias("longitude"))
    nets = s.select(
        F.col("s_suppkey").alias("pos"), F.expr("s_suppkey div 2 * 3").cast("string").alias("asn"), F.col("s_nationkey").cast("bigint").alias("org_id"),
        F.expr("CASE WHEN s_suppkey % 9 <> 0 THEN s_name END").alias("name"), F.lit(True).alias("info_ipv6"),
        (F.col("s_suppkey") * 5).alias("info_prefixes4"), F.lit(None).cast("bigint").alias("info_prefixes6"), null.alias("info_ratio"),
        null.alias("info_scope"), null.alias("info_traffic"), F.lit(None).cast("array<string>").alias("info_types"))
    iso = r.select(F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("country_code"), F.col("r_name").alias("country_name"),
                   F.lower("r_name").alias("continent_name"))
    return registry.merge_registries(ases.unionByName(orgs), net_orgs, nets, iso)


@registered("d15_registry_merge", f"""
WITH {_REG_SQL} SELECT id, name, organization_id,
  '{{"data_source":[' || concat_ws(',', CASE WHEN in1 THEN '"CAIDA"' END, CASE WHEN in2 THEN '"PeeringDB"' END) || ']'
  || CASE WHEN in2 THEN ',"peeringdb_ipv6":true,"peeringdb_prefixes4":' || p4 ELSE '' END || '}}' AS ext FROM ases""")
def d15(spark, sf_dir):
    return _registries(spark, sf_dir)[0]


@registered("d15_registry_orgs", f"""
WITH {_REG_SQL} SELECT o.id, o.name, coalesce(o.cc, x.cc) AS country_code, r_name AS country_name, lower(r_name) AS continent_name, x.city AS city_name,
  '{{"data_source":[' || concat_ws(',', CASE WHEN o1 THEN '"CAIDA"' END, CASE WHEN x.id IS NOT NULL THEN '"PeeringDB"' END) || ']}}' AS ext
FROM orgs o LEFT JOIN filler ON owner = o.id LEFT JOIN org2 x ON x.id = filler
LEFT JOIN region ON 'R' || r_regionkey = coalesce(o.cc, x.cc)""")
def d15_orgs(spark, sf_dir):
    return _registries(spark, sf_dir)[1].select("id", "name", "country_code", "country_name", "continent_name", "city_name", "ext")


@registered("d16_country_names", """
SELECT s_suppkey, n_name AS country, upper(n_name) AS continent FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey AND s_nationkey % 4 > 0""")
def d16(spark, sf_dir):
    from telescry.operators.registry import country_names

    iso = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("country_code"), F.col("n_name").alias("country_name"),
                                                F.upper("n_name").alias("continent_name"))
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.expr("CASE WHEN s_nationkey % 4 > 0 THEN string(s_nationkey) END").alias("country_code"))
    return country_names(s, iso).select("s_suppkey", F.col("_country").alias("country"), F.col("_continent").alias("continent"))


@registered("d17_self_ref", """
WITH b AS (SELECT c_custkey, c_custkey // 2 AS parent, [c_custkey + 1, c_custkey * 3] AS members FROM customer),
m AS (SELECT c_custkey, unnest(members) AS m, unnest([1, 2]) AS pos FROM b),
g AS (SELECT m.c_custkey, string_agg(CASE WHEN t.c_custkey IS NOT NULL THEN t.c_custkey || '__v1' ELSE 'old' END, ',' ORDER BY pos) AS refs
      FROM m LEFT JOIN customer t ON t.c_custkey = m.m GROUP BY m.c_custkey)
SELECT b.c_custkey::VARCHAR AS id, coalesce(p.c_custkey || '__v1', 'old') AS parent_ref, g.refs AS member_refs
FROM b LEFT JOIN customer p ON p.c_custkey = b.parent LEFT JOIN g ON g.c_custkey = b.c_custkey""")
def d17(spark, sf_dir):
    k = F.col("c_custkey")
    batch = table(spark, sf_dir, "customer").select(
        k.cast("string").alias("id"), F.concat(k.cast("string"), F.lit("__v1")).alias("ref"),
        F.expr("c_custkey div 2").cast("string").alias("parent_id"), F.lit("old").alias("parent_ref"),
        F.array((k + 1).cast("string"), (k * 3).cast("string")).alias("member_id"), F.array(F.lit("old"), F.lit("old")).alias("member_ref"))
    refs = lookup.refs_in_batch(batch)
    out = lookup.resolve_list_in_batch(lookup.resolve_in_batch(batch, refs, "parent"), refs, "member")
    return out.select("id", "parent_ref", F.array_join("member_ref", ",").alias("member_refs"))
