"""Entity builders on records made from the benchmark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telescry.entities import addresses, services, specs, status
from telescry.operators import versioned
from telescry.plans.registered import registered
from telescry.plans.views import out_of_reach, table
from telescry.session import cut_lineage



def _json_rows(df: DataFrame, pos: str, **fields) -> DataFrame:
    return df.select(F.col(pos).alias("pos"), F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()])).alias("row_json"))


def _refs(df: DataFrame, key: str) -> DataFrame:
    text = F.col(key).cast("string")
    return df.select(text.alias("id"), F.concat(text, F.lit("__v1")).alias("ref"))


@registered("f10_interface", """
WITH i AS (SELECT l_orderkey, l_linenumber, 'd' || l_suppkey || '::' || l_orderkey || '-' || l_linenumber || '-' || l_partkey AS id, l_suppkey AS dev, l_partkey AS asn, l_orderkey % 2 = 0 AS edge
           FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_orderkey, l_linenumber, l_partkey ORDER BY l_orderkey) = 1),
c AS (SELECT * FROM (SELECT l_orderkey AS ok, l_linenumber AS ln, l_suppkey AS sk, l_partkey AS pk FROM lineitem) t)
SELECT i.id, i.id || '__v1' AS ref, CASE WHEN dev % 4 <> 0 THEN 'd' || dev || '__v1' END AS device_ref, edge,
  CASE WHEN asn % 3 <> 0 THEN asn || '__v1' END AS peer_as_ref, CASE WHEN l_linenumber = 2 THEN NULL ELSE asn END AS flow_index,
  'c' || (l_orderkey % 10) || '__v1,-' AS circuit_refs, i.id || '__v1' AS port_interface_ref, i.id || '__v1,-' AS lag_refs
FROM i""")
def f10(spark, sf_dir):
    """Every line is an interface whose port is itself; devices, AS numbers and circuits resolve in part."""
    li = table(spark, sf_dir, "lineitem")
    text = lambda e: F.expr(e).cast("string")
    iid = F.expr("concat('d', l_suppkey, '::', l_orderkey, '-', l_linenumber, '-', l_partkey)")
    rows = _json_rows(
        li.withColumn("pos", F.col("l_orderkey")), "pos", id=iid, type=F.lit("port"), name=F.lit("n"), device_id=F.expr("concat('d', l_suppkey)"),
        edge=F.expr("CASE WHEN l_orderkey % 2 = 0 THEN '1' ELSE 'no' END"), flow_index=F.expr("CASE WHEN l_linenumber = 2 THEN 'x' ELSE string(l_partkey) END"),
        circuit_id=F.expr("concat('[\"c', l_orderkey % 10, '\",\"none\"]')"), peer_as_id=text("l_partkey"), port_interface_id=iid,
        lag_member_interface_id=F.array(iid, F.lit("gone")))
    snapshots = {
        "meta_device": li.select(F.concat(F.lit("d"), out_of_reach("l_suppkey", "l_suppkey % 4 = 0").cast("string")).alias("k")).distinct().transform(lambda d: _refs(d, "k")),
        "meta_as": _refs(li.select(out_of_reach("l_partkey", "l_partkey % 3 = 0").alias("k")).distinct(), "k"),
        "meta_circuit": li.select(F.expr("concat('c', l_orderkey % 10)").alias("k")).distinct().transform(lambda d: _refs(d, "k")),
    }
    out = versioned.upsert_versions(versioned.with_refs(versioned.stage(rows, specs.INTERFACE), specs.INTERFACE, snapshots, cut_lineage), None, specs.INTERFACE, cut=cut_lineage)
    return out.select("id", "ref", "device_ref", "edge", "peer_as_ref", "flow_index", F.array_join("circuit_ref", ",", "-").alias("circuit_refs"),
                      "port_interface_ref", F.array_join("lag_member_interface_ref", ",", "-").alias("lag_refs"))


@registered("f13_organization", """
SELECT c_custkey::VARCHAR AS id, c_custkey || '__v1' AS ref, c_name AS name, c_mktsegment || ',x' AS types, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_acctbal END AS latitude
FROM customer""")
def f13(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    rows = _json_rows(c, "c_custkey", id=F.col("c_custkey"), name=F.col("c_name"), type=F.array("c_mktsegment", F.lit("x")),
                      latitude=F.when(F.col("c_custkey") % 3 == 0, F.lit("north")).otherwise(F.col("c_acctbal").cast("string")))
    out = versioned.upsert_versions(versioned.stage(rows, specs.ORGANIZATION), None, specs.ORGANIZATION)
    return out.select("id", "ref", "name", F.array_join("type", ",").alias("types"), "latitude")


@registered("f15_ip_block", """
SELECT p_partkey::VARCHAR AS id, CASE WHEN p_partkey % 3 <> 0 THEN p_partkey || '__v1' END AS as_ref,
  '10.' || p_size || '.0.0/16' || CASE WHEN p_partkey % 2 = 0 THEN ',2001:db8::/32' ELSE '' END AS subnets FROM part""")
def f15(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    nets = F.expr("""concat('[["10.', p_size, '.0.0", 16], ["10.0.0.0"], ["10.0.0.0", "wide"]', CASE WHEN p_partkey % 2 = 0 THEN ', ["2001:db8::", "32"]' ELSE '' END, ']')""")
    rows = _json_rows(p, "p_partkey", id=F.col("p_partkey"), ip_subnet=nets, as_id=F.col("p_partkey"))
    refs = {"meta_as": _refs(p.select(out_of_reach("p_partkey", "p_partkey % 3 = 0").alias("k")), "k")}
    out = versioned.upsert_versions(versioned.with_refs(versioned.stage(rows, specs.IP_BLOCK), specs.IP_BLOCK, refs), None, specs.IP_BLOCK)
    return out.select("id", "as_ref", F.array_join(F.transform("ip_subnet", lambda s: F.concat_ws("/", s["ip"], s["len"].cast("string"))), ",").alias("subnets"))


def _subnets(column: str = "ip_subnet"):
    return F.array_join(F.transform(column, lambda s: F.concat_ws("/", s["ip"], s["len"].cast("string"))), ",")


@registered("f17_event_venue", """
SELECT c_name AS id, '10.0.' || c_nationkey || '.0/24,10.1.1.' || c_nationkey || '/32,2001:db8::' || c_nationkey || '/128' AS subnets, c_mktsegment AS organization_name,
  c_acctbal AS coordinate_x, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal END AS coordinate_y FROM customer WHERE c_custkey % 5 <> 0""")
def f17(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    n = F.col("c_nationkey").cast("string")
    rows = c.select(
        F.col("c_custkey").alias("_pos"),
        F.array(F.concat(F.lit("10.0."), n, F.lit(".0/24")), F.concat(F.lit("10.1.1."), n), F.lit("10.1.1.999"), F.concat(F.lit("2001:db8::"), n), F.lit("10.0.0.0/x")).alias("addresses"),
        F.col("c_mktsegment").alias("org_name"), F.when(F.col("c_custkey") % 5 != 0, F.col("c_name")).alias("resource_name"),
        F.col("c_acctbal").cast("string").alias("latitude"),
        F.when(F.col("c_custkey") % 2 == 0, F.col("c_acctbal").cast("string")).otherwise(F.lit("east")).alias("longitude"))
    out = addresses.stage_event_venue(rows)
    return out.select("id", _subnets().alias("subnets"), "organization_name", "coordinate_x", "coordinate_y")


@registered("f18_science_registry", """
SELECT c_custkey::VARCHAR AS id, CASE WHEN c_custkey % 3 = 0 THEN '1970-01-01' ELSE '2020-01-' || lpad((c_nationkey + 1)::VARCHAR, 2, '0') END AS updated,
  CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment || '__v1' END AS organization_ref, c_acctbal AS latitude FROM customer""")
def f18(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    null = F.lit(None).cast("string")
    org = F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).otherwise(F.lit("nobody"))
    rows = c.select(
        F.col("c_custkey").alias("_pos"), F.col("c_custkey").cast("string").alias("scireg_id"), F.array(F.lit("10.0.0.0/8")).alias("addresses"),
        F.when(F.col("c_custkey") % 3 == 0, F.lit("soon")).otherwise(F.format_string("2020-01-%02d", F.col("c_nationkey") + 1)).alias("last_updated"),
        org.alias("org_name"), null.alias("discipline"), F.col("c_acctbal").cast("string").alias("latitude"), null.alias("longitude"),
        null.alias("resource_name"), null.alias("project_name"), null.alias("contact_email"))
    refs = {"meta_organization": _refs(c.select("c_mktsegment").distinct(), "c_mktsegment")}
    out = versioned.upsert_versions(versioned.with_refs(addresses.stage_science_registry(rows), specs.SCIENCE_REGISTRY_IP, refs), None, specs.SCIENCE_REGISTRY_IP)
    return out.select("id", F.col("scireg_update_time").cast("string").alias("updated"), "organization_ref", "latitude")


@registered("f19_grid_sites", """
SELECT 'r' || s_suppkey || 'a' AS id, '10.' || s_suppkey % 200 || '.0.0/16,2001:db8::/' || (32 + s_suppkey % 9) AS subnets, s_name AS site, 'net' || s_nationkey AS netsite,
  s_acctbal AS latitude, (s_suppkey % 4)::BIGINT AS tier FROM supplier
UNION ALL SELECT 'r' || s_suppkey || 'b', '192.0.2.0/24', s_name, NULL, s_acctbal, (s_suppkey % 4)::BIGINT FROM supplier""")
def f19(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey").cast("string")
    null = F.lit(None).cast("string")
    arr = lambda *c: F.array(*c).cast("array<string>")
    route = lambda net, v4, v6: F.struct(net.alias("netsite"), F.struct(v4.alias("ipv4"), v6.alias("ipv6")).alias("networks"))
    routes = F.create_map(
        F.concat(F.lit("r"), k, F.lit("a")), route(F.concat(F.lit("net"), F.col("s_nationkey").cast("string")),
                                                   arr(F.expr("concat('10.', s_suppkey % 200, '.0.0/16')"), F.lit("10.0.0.0")),
                                                   arr(F.expr("concat('2001:db8::/', 32 + s_suppkey % 9)"))),
        F.concat(F.lit("r"), k, F.lit("b")), route(null, arr(F.lit("192.0.2.0/24")), F.lit(None).cast("array<string>")),
        F.concat(F.lit("r"), k, F.lit("c")), route(null, arr(F.lit("bad")), arr(F.lit("2001:db8::/x"))))
    site = F.struct(F.lit("Land").alias("country"), F.col("s_acctbal").cast("string").alias("latitude"), F.lit("x").alias("longitude"),
                    (F.col("s_suppkey") % 4).cast("string").alias("rc_tier_level"), routes.alias("netroutes"))
    rows = s.select(F.col("s_suppkey").alias("_pos"), F.create_map(F.col("s_name"), site).alias("sites"))
    out = addresses.stage_grid_sites(rows)
    return out.select("id", _subnets().alias("subnets"), F.col("rcsite_name").alias("site"), F.col("netsite_name").alias("netsite"), "latitude", "tier")


@registered("f20_service_prefixes", """
WITH s AS (SELECT c_custkey AS pos, c_mktsegment AS g, 'L' || (c_custkey % 7) AS l, c_name, c_custkey % 4 AS vis, c_custkey AS asn,
             unnest(['10.' || c_nationkey || '.0.0/16', '10.' || (c_custkey % 40) || '.0.0/16', 'bad']) AS prefix, unnest([1, 2, 3]) AS p FROM customer),
n AS (SELECT prefix, 'g' AS t, g AS name, min((pos, p)) AS f FROM s GROUP BY ALL UNION ALL SELECT prefix, 'l', l, min((pos, p)) FROM s GROUP BY ALL),
h AS (SELECT prefix, arg_min((c_name, vis, asn), (pos, p)) AS o FROM s GROUP BY prefix)
SELECT h.prefix AS id, o[1] AS org_full_name, o[2] IN (1, 2) AS org_hide, 'type' || (o[2]) || ',flat' AS org_types, 'A' || (o[2]) AS agency,
  CASE WHEN o[3] % 2 = 0 THEN o[3] END AS as_id, string_agg(name, ',' ORDER BY f) FILTER (WHERE t = 'g') AS group_names,
  string_agg(name, ',' ORDER BY f) FILTER (WHERE t = 'l') AS labels
FROM h JOIN n USING (prefix) WHERE prefix <> 'bad' GROUP BY h.prefix, o""".replace("(c_name, vis, asn)", "{'a': c_name, 'b': vis, 'c': asn}").replace("o[1]", "o.a").replace("o[2]", "o.b").replace("o[3]", "o.c"))
def f20(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    v = F.col("c_custkey") % 4
    vt = v.cast("string")
    prefixes = F.expr("""concat('[{"prefixIp":"10.', c_nationkey, '.0.0/16"},"10.', c_custkey % 40, '.0.0/16",{"prefixIp":"bad"},{"prefixIp":""}]')""")
    customer = F.struct(
        F.lit("s").alias("shortName"), F.col("c_name").alias("fullName"), F.concat(F.lit('[{"name":"type'), vt, F.lit('"},"flat",{"name":""}]')).alias("types"),
        F.when(v % 2 == 0, F.concat(F.lit('{"shortName":"A'), vt, F.lit('"}'))).otherwise(F.concat(F.lit("A"), vt)).alias("fundingAgency"),
        F.when(v == 1, F.lit("Hidden")).when(v == 2, F.lit("Hide Flow Data")).when(v == 3, F.lit("HIDDEN")).alias("visibility"))
    service = F.struct(
        F.col("c_custkey").cast("string").alias("id"), F.expr("concat('L', c_custkey % 7)").alias("label"), F.col("c_mktsegment").alias("prefixGroupName"),
        F.struct(F.lit(None).cast("string").alias("shortName")).alias("serviceType"), customer.alias("customer"),
        F.struct(F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey").cast("string")).otherwise(F.lit("n/a")).alias("asn")).alias("peer"), prefixes.alias("prefixes"))
    data = F.struct(F.struct(F.struct(F.array(service).alias("list")).alias("serviceList")).alias("data"))
    out = addresses.stage_service_prefixes(c.select(F.col("c_custkey").alias("_pos"), data.alias("data")))
    return out.select("id", "org_full_name", "org_hide", F.array_join("org_types", ",").alias("org_types"), F.col("org_funding_agency").alias("agency"), "as_id",
                      F.array_join("service_prefix_group_name", ",").alias("group_names"), F.array_join("service_label", ",").alias("labels"))


@registered("f21_service_edges", """
SELECT 'dev' || l_suppkey || '::se-' || l_orderkey || '-' || l_linenumber AS id, l_orderkey::VARCHAR AS service_edge_id,
  l_linenumber % 4 = 0 OR l_orderkey % 5 = 0 AS org_hide,
  CASE l_linenumber % 7 WHEN 1 THEN l_partkey WHEN 2 THEN l_partkey WHEN 6 THEN l_partkey END AS peer_as_id,
  CASE WHEN l_linenumber % 7 IN (1, 2, 5) THEN '192.0.2.1' WHEN l_linenumber % 7 = 6 THEN '192.0.2.2' END AS peer_ipv4,
  CASE WHEN l_linenumber % 7 = 2 THEN '2001:db8::1' END AS peer_ipv6
FROM lineitem WHERE l_suppkey % 3 <> 0""")
def f21(spark, sf_dir):
    """Neighbour cases by line number: 1 one, 2 dual stack, 3 three, 4 two AS numbers, 5 bad AS, 6 same family, 0 none."""
    li = table(spark, sf_dir, "lineitem")
    asn = F.col("l_partkey").cast("string")
    nb = lambda ip, a: F.struct(ip.cast("string").alias("remoteIp"), F.struct(a.cast("string").alias("asn")).alias("peerDetail"))
    v4, v4b, v6 = F.lit("192.0.2.1"), F.lit("192.0.2.2"), F.lit("2001:db8::1")
    k = F.col("l_linenumber") % 7
    neighbors = (
        F.when(k == 1, F.array(nb(v4, asn))).when(k == 2, F.array(nb(v4, asn), nb(v6, asn)))
        .when(k == 3, F.array(nb(v4, asn), nb(v6, asn), nb(v4b, asn))).when(k == 4, F.array(nb(v4, asn), nb(v6, F.lit("1000000000"))))
        .when(k == 5, F.array(nb(v4, F.lit("bad")), nb(F.lit(None), asn))).when(k == 6, F.array(nb(v4, F.lit(None)), nb(v4b, asn))).otherwise(F.array().cast("array<struct<remoteIp:string,peerDetail:struct<asn:string>>>")))
    null = F.lit(None).cast("string")
    org = F.struct(
        F.lit("o").alias("shortName"), F.lit("org").alias("fullName"), null.alias("types"), null.alias("fundingAgency"),
        F.when(F.col("l_linenumber") % 4 == 0, F.lit("hidden")).otherwise(F.lit("open")).alias("visibility"),
        F.when(F.col("l_orderkey") % 5 == 0, F.array(F.lit("Transit"), F.lit("HIDE"))).alias("tags"))
    edge = F.struct(
        F.col("l_orderkey").cast("string").alias("id"), F.expr("concat('se-', l_orderkey, '-', l_linenumber)").alias("name"),
        F.struct(F.lit("conn").alias("connectionName")).alias("physicalConnection"),
        F.struct(F.struct(F.when(F.col("l_suppkey") % 3 != 0, F.concat(F.lit("dev"), F.col("l_suppkey").cast("string"))).alias("name")).alias("device")).alias("equipmentInterface"),
        org.alias("organization"), neighbors.alias("bgpNeighbors"))
    data = F.struct(F.struct(F.struct(F.array(edge).alias("list")).alias("serviceEdgeList")).alias("data"))
    out = services.stage_service_edges(li.select(F.col("l_orderkey").alias("_pos"), data.alias("data")))
    return out.select("id", "service_edge_id", "org_hide", "peer_as_id", "peer_ipv4", "peer_ipv6")


def _status_rows(df: DataFrame, key: str, **fields) -> DataFrame:
    names = [c.split()[0].strip("`") for c in status.RECORD_SCHEMA.split(", ")]
    kinds = {c.split()[0].strip("`"): c.split()[1] for c in status.RECORD_SCHEMA.split(", ")}
    return df.select(F.col(key).alias("_pos"), *[fields.get(n, F.lit(None)).cast(kinds[n]).alias(n) for n in names])


@registered("f22_resources", """
SELECT o_orderkey::VARCHAR AS id, CASE WHEN o_custkey % 3 <> 0 THEN o_custkey::VARCHAR END AS site_id, CASE WHEN o_custkey % 3 <> 0 AND c_custkey IS NOT NULL THEN 'f' || c_nationkey END AS facility_id,
  CASE WHEN o_custkey % 3 <> 0 AND c_nationkey % 2 = 0 THEN 'f' || c_nationkey || '__v1' END AS facility_ref, o_orderpriority AS type
FROM orders LEFT JOIN customer ON c_custkey = o_custkey""")
def f22(spark, sf_dir):
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    rows = _status_rows(o, "o_orderkey", id=F.col("o_orderkey"), self_uri=F.lit("u"), resource_type=F.col("o_orderpriority"))
    to_site = o.select(out_of_reach("o_orderkey", "o_custkey % 3 = 0").cast("string").alias("key"), F.col("o_custkey").cast("string").alias("value"))
    to_facility = c.select(F.col("c_custkey").cast("string").alias("key"), F.concat(F.lit("f"), F.col("c_nationkey").cast("string")).alias("value"))
    facilities = c.select(F.concat(F.lit("f"), out_of_reach("c_nationkey", "c_nationkey % 2 = 1").cast("string")).alias("k")).distinct()
    staged = versioned.with_refs(status.stage_resources(rows, to_site, to_facility), specs.RESOURCE, {"meta_iri_facility": _refs(facilities, "k")})
    return versioned.upsert_versions(staged, None, specs.RESOURCE).select("id", "site_id", "facility_id", "facility_ref", "type")


@registered("f22_incidents", """
SELECT o_orderkey::VARCHAR AS id, CAST(epoch(o_orderdate) AS BIGINT) AS start_epoch,
  CASE WHEN o_orderkey % 2 = 0 THEN CAST(epoch(o_orderdate) AS BIGINT) END AS end_epoch, o_custkey || ',9x' AS resource_ids,
  CASE WHEN o_custkey % 2 = 0 THEN o_custkey || '__v1' ELSE '' END AS resource_refs FROM orders WHERE o_orderkey % 9 <> 0""")
def f22_incidents(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    stamp = F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    rows = _status_rows(
        o, "o_orderkey", id=F.col("o_orderkey"), self_uri=F.lit("u"), last_modified=stamp, status=F.lit("up"), type=F.lit("t"), start=stamp,
        end=F.when(F.col("o_orderkey") % 2 == 0, stamp).otherwise(F.lit("later")),
        resolution=F.when(F.col("o_orderkey") % 9 != 0, F.lit("open")),
        resource_uris=F.array(F.expr("concat('https://api.example.org/status/resources/', o_custkey, '/')"), F.lit(""), F.lit("https://api.example.org/9x")))
    refs = _refs(o.select(out_of_reach("o_custkey", "o_custkey % 2 = 1").alias("k")).distinct(), "k")
    out = status.stage_incidents(rows, refs)
    return out.select("id", F.unix_timestamp("start_time").alias("start_epoch"), F.unix_timestamp("end_time").alias("end_epoch"),
                      F.array_join("resource_id", ",").alias("resource_ids"), F.array_join("resource_ref", ",").alias("resource_refs"))


@registered("f23_compute_jobs", """
SELECT o_orderkey::VARCHAR AS id, 'cr' || (o_custkey % 5) AS compute_resource_id, o_custkey AS node_count, o_orderkey % 500 * 60 AS wall_time_secs,
  CASE WHEN o_orderkey % 4 <> 0 THEN CAST(epoch(o_orderdate) AS BIGINT) END AS start_epoch,
  CASE WHEN o_orderkey % 4 <> 0 THEN CAST(epoch(o_orderdate) AS BIGINT) + o_orderkey % 500 * 60 END AS end_epoch, 'loc1,loc2' AS location
FROM orders WHERE o_orderkey % 11 <> 0""")
def f23(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    epoch = F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).cast("string")
    rows = o.select(
        F.col("o_orderkey").alias("_pos"), F.expr("concat('cr', o_custkey % 5)").alias("compute_resource_id"), F.col("o_orderkey").cast("string").alias("jobid"),
        F.lit("script").alias("mode"), F.col("o_custkey").cast("string").alias("nodes"), F.lit("p").alias("project"), F.lit("q").alias("queue"),
        F.lit("running").alias("state"), F.when(F.col("o_orderkey") % 11 == 0, F.lit("-5")).otherwise(epoch).alias("submittime"),
        F.when(F.col("o_orderkey") % 4 != 0, epoch).otherwise(F.lit("-1")).alias("starttime"), F.lit("42").alias("substate"),
        (F.col("o_orderkey") % 500).cast("string").alias("walltime"), F.lit('["loc1","loc2"]').alias("location"),
        F.lit(None).cast("array<struct<" + status.SELECT_FIELDS + ">>").alias("schedselect"), F.lit(None).cast("string").alias("ext"), F.lit(None).cast("string").alias("tag"))
    out = versioned.upsert_versions(status.stage_jobs(rows), None, specs.COMPUTE_JOB)
    return out.select("id", "compute_resource_id", "node_count", "wall_time_secs", F.unix_timestamp("start_time").alias("start_epoch"),
                      F.unix_timestamp("end_time").alias("end_epoch"), F.array_join("location", ",").alias("location"))
