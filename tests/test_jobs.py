"""Jobs end to end on small files, written the way their sources look."""

import gzip
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from telescry.config import FlowConfig
from telescry.entities import specs
from telescry.operators import metrics, rollup
from telescry.operators.snapshot import LookupSpec
from telescry.plans import jobs, views
from telescry.sinks import tables as sinks
from telescry.sources import files, messages
from telescry.streaming.run import read_rollup

FILES = {
    "organization.yml": """
table: meta_organization
data:
  - {id: college, name: North College, type: [school, library], latitude: "51.5", longitude: west}
""",
    "as.yml": """
table: meta_as
data:
  - {id: "64501", name: "Campus", organization_id: college}
""",
    "device.yml": """
table: meta_device
data:
  - {id: hub-1, type: router, loopback_ip: ["192.0.2.1", "192.0.2.2"]}
  - {id: rim-2, type: router, loopback_ip: '["192.0.2.9"]'}
  - {id: no-type}
""",
    "circuit.yml": """
table: meta_circuit
data:
  - {id: span-9, type: path, endpoint_type: [device, device], endpoint_id: [hub-1, rim-2], parent_circuit_id: parent}
  - {id: parent, endpoint_type: [device, device], endpoint_id: [a, b]}
""",
    "interface.yml": """
table: meta_interface
data:
  - id: hub-1::customer-4
    type: service_l3vpn
    device_id: hub-1
    edge: true
    flow_index: 410
    name: customer-4
    speed: 1000
    circuit_id: [span-9, missing]
    peer_as_id: 64501
    port_interface_id: hub-1::trunk-3
    remote_interface_id: rim-2::uplink-8
    remote_organization_id: college
  - {id: "hub-1::trunk-3", type: port, device_id: hub-1, edge: true, flow_index: "411", name: trunk-3}
  - {id: "rim-2::uplink-8", type: port, device_id: rim-2, edge: 0, flow_index: 7, name: se, lag_member_interface_id: '["hub-1::trunk-3", "gone"]'}
""",
    "ip.yml": """
table: meta_ip
data:
  - {id: block4, ip_subnet: [["198.18.0.0", 16], ["198.19.0.0", 16], ["bad"]], as_id: 64501}
  - {id: block6, ip_subnet: [["2001:db8::", 32]], as_id: 64501, ext: {b: 1, a: 2}, tag: [edu]}
  - {id: inner, ip_subnet: [["198.18.1.0", 24]], as_id: 5}
""",
    "application.yml": """
table: meta_application
data:
  - {id: http, protocol: TCP, port_range_min: 80, port_range_max: 81}
  - {id: dns, protocol: udp, port_range_min: 53, port_range_max: 53}
""",
    "ignored.yml": "data: []\n",
}


def stamp(day):
    return F.lit(f"2024-01-{day:02d} 00:00:00").cast("timestamp")


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("metadata")
    for name, body in FILES.items():
        (root / name).write_text(body)
    out = str(root / "base")
    jobs.metadata_files(spark, str(root / "*.yml"), out, stamp(1))
    return out


def row(spark, base, table, **where):
    df = spark.read.parquet(f"{base}/{table}")
    for k, v in where.items():
        df = df.filter(F.col(k) == v)
    found = df.collect()
    assert len(found) == 1, found
    return found[0]


def test_metadata_files_resolve_references(spark, base):
    i = row(spark, base, "meta_interface", id="hub-1::customer-4")
    assert (i.ref, i.device_ref, i.peer_as_ref, i.edge, i.flow_index) == ("hub-1::customer-4__v1", "hub-1__v1", "64501__v1", True, 410)
    assert i.circuit_ref == ["span-9__v1", None]
    assert (i.port_interface_ref, i.remote_interface_ref) == ("hub-1::trunk-3__v1", "rim-2::uplink-8__v1")
    assert i.remote_organization_ref == "college__v1"
    lag = row(spark, base, "meta_interface", id="rim-2::uplink-8")
    assert lag.lag_member_interface_ref == ["hub-1::trunk-3__v1", None] and lag.edge is False
    c = row(spark, base, "meta_circuit", id="span-9")
    assert c.parent_circuit_ref == "parent__v1"
    o = row(spark, base, "meta_organization", id="college")
    assert (o.latitude, o.longitude, o.type) == (51.5, None, ["school", "library"])
    ip = row(spark, base, "meta_ip", id="block4")
    assert [(s.ip, s.len) for s in ip.ip_subnet] == [("198.18.0.0", 16), ("198.19.0.0", 16)] and ip.as_ref == "64501__v1"
    assert row(spark, base, "meta_ip", id="block6").ext == '{"a":2,"b":1}'
    assert spark.read.parquet(f"{base}/meta_device").count() == 2
    assert row(spark, base, "meta_as", id=64501).organization_ref == "college__v1"


def test_second_load_appends_nothing_and_a_change_appends_one(spark, base, tmp_path):
    counts = lambda: {t: spark.read.parquet(f"{base}/{t}").count() for t in ("meta_organization", "meta_interface", "meta_circuit", "meta_ip")}
    before = counts()
    for name, body in FILES.items():
        (tmp_path / name).write_text(body)
    jobs.metadata_files(spark, str(tmp_path / "*.yml"), base, stamp(2))
    assert counts() == before
    (tmp_path / "organization.yml").write_text(FILES["organization.yml"].replace("North College,", "College,"))
    jobs.metadata_files(spark, str(tmp_path / "organization.yml"), base, stamp(3))
    assert spark.read.parquet(f"{base}/meta_organization").filter("ref = 'college__v2'").count() == 1


def kafka_rows(spark, values, path):
    rows = [(str(i), v, "t", 0, i, datetime(2024, 1, 1)) for i, v in enumerate(values)]
    spark.createDataFrame(rows, messages.MESSAGE_SCHEMA).write.mode("append").json(path)


FLOW = {"ip_src": "198.18.1.9", "ip_dst": "2001:db8::1", "port_src": 80, "port_dst": 5000, "ip_proto": "tcp", "timestamp_start": "1609459200.0",
        "timestamp_end": "1609459260.0", "bytes": 1024, "packets": 10, "writer_id": "nfacctd", "peer_ip_src": "192.0.2.2", "iface_in": 410,
        "iface_out": "99", "as_src": 0, "as_dst": 65002, "as_path": "65001_65001_65002", "tos": "64", "mpls_vpn_rd": "65000:100"}


def test_flow_stream(spark, base, tmp_path):
    jobs.ip_index_job(spark, base, "meta_ip:as_id")
    src = str(tmp_path / "in")
    late = dict(FLOW, timestamp_start=None, timestamp_end=None, timestamp_arrival="1609459201.5", writer_id="sfacctd", ip_src="8.8.8.8", as_src=None)
    kafka_rows(spark, [json.dumps(FLOW), json.dumps(late), "{broken", "", json.dumps({"ip_src": "1.1.1.1"})], src)
    cfg = FlowConfig(community_scopes={"100": "community1"})
    stream = lambda: jobs.flow_stream(
        spark, messages.read_messages(spark, True, "json", path=src), base, str(tmp_path / "cp"), cfg, {"edge_as": ["5m"], "ip_version": ["1h"]}, None)
    stream().awaitTermination()
    flows = spark.read.parquet(f"{base}/data_flow")
    f = flows.filter("src_ip = '198.18.1.9'").first()
    assert (f.start_time, f.end_time) == (datetime(2021, 1, 1), datetime(2021, 1, 1, 0, 1))
    assert (f.flow_type, f.bit_count, f.packet_count, f.src_ip_ref, f.src_as_id, f.dst_ip_ref, f.dst_as_id) == (
        "netflow", 8192, 10, "inner__v1", 5, "block6__v1", 65002)
    assert (f.device_id, f.device_ref, f.in_interface_id, f.in_interface_edge, f.out_interface_id, f.out_interface_edge) == (
        "hub-1", "hub-1__v1", "hub-1::customer-4", True, None, False)
    assert (f.application_port, f.ip_version, f.policy_scope) == (80, 4, ["as:5", "as:65002", "comm:community1"])
    ext = json.loads(f.ext)
    assert ext == {"bgp_as_path_id": [65001, 65002], "bgp_as_path_padding": [1, 2], "ipv4_tos": 64, "ipv4_dscp": 16, "mpls_vpn_rd": "65000:100"}
    s = flows.filter("src_ip = '8.8.8.8'").first()
    assert (s.flow_type, s.start_time, s.end_time, s.src_ip_ref, s.src_as_id) == ("sflow", datetime(2021, 1, 1, 0, 0, 1, 500000), s.start_time, None, None)
    rejected = {r.error for r in spark.read.parquet(f"{base}/rejected_message").collect()}
    assert rejected == {"value is not a JSON object", "missing ip_dst,port_src,port_dst,ip_proto"}
    # a second batch adds to the same bucket, however late it is
    kafka_rows(spark, [json.dumps(FLOW)], src)
    stream().awaitTermination()
    edge = read_rollup(spark, base, rollup.EDGE_AS, "5m").collect()
    assert len(edge) == 2 and {(r.application_id, r.flow_count, r.bit_count) for r in edge} == {(None, 2, 16384), (None, 1, 8192)}
    version = read_rollup(spark, base, rollup.IP_VERSION, "1h").collect()
    assert [(r.ip_version, r.flow_count, r.policy_level, r.policy_scope) for r in version] == [(4, 3, "tlp:green", ["comm:re"])]
    # a repeated batch replaces its own rows
    jobs.flow_batch(spark, base, cfg, {"ip_version": ["1h"]})(
        messages.read_messages(spark, False, "json", path=src).filter(F.col("value").contains("8.8.8.8")), sinks.Batch(flows.filter("batch_id = 0").first().writer, 0))
    assert spark.read.parquet(f"{base}/data_flow").filter("batch_id = 0").count() == 1
    dropped = sinks.apply_retention(spark, sinks.FLOW_TABLE, base, datetime(2021, 3, 1))
    assert dropped == ["dt=2021-01-01"]


def test_snmp_stream(spark, tmp_path):
    base, src = str(tmp_path / "base"), str(tmp_path / "in")
    poll = {"name": "snmp_if", "timestamp": 1609459250, "interval": 60, "tags": {"device": "router1.example.com", "oidIndex": "10", "interval": "60"},
            "fields": {"SNMP_IF-MIB::ifName": "eth0", "SNMP_IF-MIB::ifHCInOctets": 18446744073709551615, "SNMP_IF-MIB::ifAdminStatus": 1, "load": 1.0, "n": None}}
    unknown = dict(poll, tags={"device": "router2", "oidIndex": "11"}, fields={"SNMP_IF-MIB::ifHCInOctets": 5})
    kafka_rows(spark, [json.dumps(poll), json.dumps(unknown)], src)
    rules = metrics.Rules.parse(views.RULES)
    jobs.snmp_stream(messages.read_messages(spark, True, "json", path=src), base, str(tmp_path / "cp"), rules, None).awaitTermination()
    t = spark.read.parquet(f"{base}/data_interface_traffic").collect()
    assert [(r.interface_id, r.start_time, r.end_time, r.admin_status, int(r.in_bit_count), r.out_bit_count) for r in t] == [
        ("router1::eth0", datetime(2021, 1, 1, 0, 0), datetime(2021, 1, 1, 0, 1), "up", 18446744073709551615 * 8, None)]
    gauges = spark.read.parquet(f"{base}/metrics_gauge").collect()
    assert [(r.target_table, r.id, r.metric_name, r.metric_value) for r in gauges] == [("data_interface_gauge", "router1::eth0", "load", 1.0)]
    counters = {(r.id, r.metric_name): (int(r.metric_value), json.loads(r.ext).get("metric_value")) for r in spark.read.parquet(f"{base}/metrics_counter").collect()}
    assert counters[("router1::eth0", "SNMP_IF-MIB::ifName")] == (1, "eth0")
    assert counters[("router1::eth0", "SNMP_IF-MIB::ifHCInOctets")] == (18446744073709551615, None)
    assert counters[("router2::11", "SNMP_IF-MIB::ifHCInOctets")] == (5, None)


def test_registry_and_geo(spark, tmp_path):
    base = str(tmp_path / "base")
    with gzip.open(tmp_path / "as.jsonl.gz", "wt") as f:
        f.write('{"type":"Organization","organizationId":"O1","name":"Org One","country":"US"}\n\n{"type":"Organization","organizationId":"O2"}\n')
        f.write('{"type":"ASN","asn":"100","organizationId":"O1","name":"AS100"}\n{"type":"ASN","asn":"bad","organizationId":"O1","name":"x"}\n')
    (tmp_path / "net.json").write_text(json.dumps({
        "org": {"data": [{"id": 1, "name": "P One", "country": "DE", "city": "Bonn", "state": "NW", "latitude": 50.7}, {"id": 2, "name": "P Two", "country": "US"}]},
        "net": {"data": [{"asn": 100, "org_id": 1, "name": "Net100", "info_ipv6": True, "info_types": ["NSP"]},
                         {"asn": 200, "org_id": 2, "name": "Net200"}, {"asn": 300, "org_id": 2}, {"asn": 400, "org_id": 99, "name": "x"}]}}))
    iso = spark.createDataFrame([("US", "United States", "North America"), ("DE", "Germany", "Europe")], "country_code string, country_name string, continent_name string")
    jobs.registry_job(spark, str(tmp_path / "as.jsonl.gz"), str(tmp_path / "net.json"), base, stamp(1), iso)
    orgs = {r.id: r for r in spark.read.parquet(f"{base}/meta_organization").collect()}
    assert set(orgs) == {"caida:O1", "caida:O2", "peeringdb:2"}
    assert (orgs["caida:O1"].country_code, orgs["caida:O1"].city_name, orgs["caida:O1"].country_sub_code) == ("US", "Bonn", "NW")
    assert orgs["caida:O2"].name == "Delegated" and orgs["peeringdb:2"].country_name == "United States"
    ases = {r.id: r for r in spark.read.parquet(f"{base}/meta_as").collect()}
    assert {k: (r.name, r.organization_ref) for k, r in ases.items()} == {100: ("Net100", "caida:O1__v1"), 200: ("Net200", "peeringdb:2__v1")}
    assert json.loads(ases[100].ext)["data_source"] == ["CAIDA", "PeeringDB"] and json.loads(ases[200].ext)["data_source"] == ["PeeringDB"]

    (tmp_path / "asn.csv").write_text("network,autonomous_system_number,autonomous_system_organization\n1.0.0.0/8,100,x\n1.2.0.0/16,200,y\n2001:db8::/32,100,z\n")
    (tmp_path / "loc.csv").write_text("geoname_id,locale_code,continent_name,country_iso_code,country_name,city_name\n7,en,Europe,DE,Germany,Bonn\n")
    (tmp_path / "b4.csv").write_text("network,geoname_id,latitude,longitude\n1.2.3.0/24,7,50.7,7.1\n1.0.0.0/7,,1,1\n")
    (tmp_path / "b6.csv").write_text("network,geoname_id,latitude,longitude\n2001:db8:1::/48,9,,\n")
    custom = spark.createDataFrame([("1.2.3.0/24", None, "Koeln", ["id", "city_name"]), ("9.9.9.0/24", 5, None, ["id", "as_id"])],
                                   "id string, as_id bigint, city_name string, present array<string>")
    paths = lambda *n: [str(tmp_path / x) for x in n]
    jobs.ip_geo_job(spark, paths("b4.csv", "b6.csv"), paths("asn.csv"), paths("loc.csv"), base, stamp(1), custom, "present")
    ips = {r.id: r for r in spark.read.parquet(f"{base}/meta_ip").collect()}
    assert (ips["1.2.3.0/24"].as_id, ips["1.2.3.0/24"].city_name, ips["1.2.3.0/24"].country_name, ips["1.2.3.0/24"].as_ref) == (200, "Koeln", "Germany", "200__v1")
    assert ips["1.0.0.0/7"].as_id is None and ips["2001:db8:1::/48"].as_id == 100 and ips["9.9.9.0/24"].as_id == 5


UUID = "12345678-1234-1234-1234-1234564501ab"


def payload(tmp_path, name, rows):
    path = tmp_path / name
    path.write_text("\n".join(json.dumps(r) for r in rows))
    return str(path)


def test_status_and_jobs(spark, tmp_path):
    base = str(tmp_path / "base")
    api = "https://api.example.org/v1"
    when = "2024-01-01T00:00:00Z"
    path = payload(tmp_path, "status.json", [
        {"url": f"{api}/facility/?x=1", "status_code": 200, "data": [{"id": "fac", "self_uri": "u", "last_modified": when, "site_uris": [f"{api}/facility/sites/{UUID}/"]}]},
        {"url": f"{api}/facility/sites", "status_code": 200, "data": [{"id": UUID, "self_uri": "u", "last_modified": when, "resource_uris": [f"{api}/status/resources/{UUID[::-1]}"]}]},
        {"url": f"{api}/status/resources", "status_code": 200, "data": [{"id": UUID[::-1], "self_uri": "u", "resource_type": "compute", "current_status": "Degraded", "last_modified": when}]},
        {"url": f"{api}/status/incidents", "status_code": 200, "data": [{"id": "inc", "self_uri": "u", "last_modified": when, "status": "down", "type": "planned", "start": when, "end": "bad",
                                                                        "resolution": "pending", "resource_uris": [f"{api}/status/resources/{UUID[::-1]}", f"{api}/x/none"]}]},
        {"url": f"{api}/status/incidents/inc/events", "status_code": 200, "data": [{"id": "ev", "self_uri": "u", "last_modified": when, "status": "up", "occurred_at": when,
                                                                                   "resource_uri": f"{api}/status/resources/{UUID[::-1]}", "incident_uri": f"{api}/status/incidents/inc/"}]},
    ])
    jobs.status_job(spark, path, base, stamp(2))
    r = row(spark, base, "meta_iri_resource", id=UUID[::-1])
    assert (r.site_id, r.site_ref, r.facility_id, r.facility_ref) == (UUID, f"{UUID}__v1", "fac", "fac__v1")
    inc = row(spark, base, "meta_iri_incident", id="inc")
    assert (inc.end_time, inc.resource_id, inc.resource_ref) == (None, [UUID[::-1], "none"], [f"{UUID[::-1]}__v1"])
    ev = row(spark, base, "meta_iri_event", id="ev")
    assert (ev.resource_ref, ev.incident_ref) == (f"{UUID[::-1]}__v1", "inc__v1")
    m = {x.metric_name: (x.metric_value, x.ref) for x in spark.read.parquet(f"{base}/metrics_counter").collect()}
    assert m == {"status": (2, f"{UUID[::-1]}__v1"), "last_modified": (1704067200, f"{UUID[::-1]}__v1")}

    job = {"jobid": "7", "mode": "script", "nodes": 2, "project": "p", "queue": "q", "state": "running", "submittime": 1609459200, "starttime": 1609459200, "substate": 42,
           "walltime": 60, "location": ["n1"], "schedselect": [{"host": "h", "ncpus": 4}], "runtimef": "00:01:00", "queuedtimef": "1:00:00:00", "score": 1.5}
    path = payload(tmp_path, "jobs.json", [{"url": "https://status.example.org/polaris/activity.json", "status_code": 200,
                                           "data": {"running": [job], "queued": [dict(job, jobid="8", starttime=-1), dict(job, jobid="9", submittime=None)]}}])
    jobs.compute_job_job(spark, path, base, stamp(2))
    j = row(spark, base, "meta_alcf_job", id="7")
    assert (j.compute_resource_id, j.node_count, j.wall_time_secs, j.end_time) == ("polaris", 2, 3600, datetime(2021, 1, 1, 1))
    assert j.schedule_select[0].ncpus == 4 and row(spark, base, "meta_alcf_job", id="8").start_time is None
    assert spark.read.parquet(f"{base}/meta_alcf_job").count() == 2
    got = {(x.id, x.metric_name): x.metric_value for x in spark.read.parquet(f"{base}/metrics_gauge").collect()}
    assert got[("7", "runtime_secs")] == 60 and got[("8", "queued_time_secs")] == 86400 and got[("7", "score")] == 1.5


def test_address_sources(spark, tmp_path):
    base = str(tmp_path / "base")
    venue = tmp_path / "venue.json"
    venue.write_text(json.dumps([{"addresses": ["10.0.0.0/8", "192.0.2.1", "nonsense"], "org_name": "o", "resource_name": "booth", "latitude": "1.5"}]))
    jobs.event_venue_job(spark, str(venue), base, stamp(1))
    v = row(spark, base, "meta_ip_scinet", id="booth")
    assert [(s.ip, s.len) for s in v.ip_subnet] == [("10.0.0.0", 8), ("192.0.2.1", 32)] and v.coordinate_x == 1.5
    science = tmp_path / "science.json"
    science.write_text(json.dumps([{"scireg_id": "5", "addresses": ["2001:db8::1"], "org_name": "o", "latitude": "north"}]))
    jobs.science_registry_job(spark, str(science), base, stamp(1))
    s = row(spark, base, "meta_ip_scireg", id="5")
    assert str(s.scireg_update_time) == "1970-01-01" and s.latitude is None and s.ip_subnet[0].len == 128
    grid = payload(tmp_path, "grid.json", [{"url": "https://grid.example.org/api", "status_code": 200, "data": {
        "SITE": {"country": "CH", "latitude": 46.2, "rc_tier_level": 0, "netroutes": {"r1": {"netsite": "n", "networks": {"ipv4": ["10.0.0.0/8", "x"], "ipv6": ["2001:db8::/32"]}}, "r2": {"networks": {}}}}}}])
    jobs.grid_site_job(spark, grid, base, stamp(1), "grid.example.org")
    g = row(spark, base, "meta_ip_cric", id="r1")
    assert (g.rcsite_name, g.tier, len(g.ip_subnet), g.latitude) == ("SITE", 0, 2, 46.2)
    services = payload(tmp_path, "services.json", [{"url": "https://db.example.org/graphql", "status_code": 200, "data": {"data": {
        "serviceList": {"list": [
            {"id": "1", "label": "A", "prefixGroupName": "G1", "serviceType": {"shortName": "T"}, "customer": {"shortName": "c1", "types": [{"name": "Site"}, "Lab"], "visibility": "Hidden"},
             "peer": {"asn": 12}, "prefixes": [{"prefixIp": "10.0.0.0/8"}]},
            {"id": "2", "label": "B", "prefixGroupName": "G1", "customer": {"shortName": "c2"}, "prefixes": [{"prefixIp": "10.0.0.0/8"}, {"prefixIp": "bad"}]}]},
        "serviceEdgeList": {"list": [{"id": "78", "name": "se-1", "equipmentInterface": {"device": {"name": "cr6"}}, "organization": {"shortName": "o", "visibility": "HIDDEN", "tags": ["Transit"]},
                                      "bgpNeighbors": [{"remoteIp": "192.0.2.1", "peerDetail": {"asn": 123}}, {"remoteIp": "2001:db8::1", "peerDetail": {"asn": "123"}}]},
                                     {"id": "79", "name": "se-2"}]}}}}])
    jobs.service_prefix_job(spark, services, base, stamp(1), "db.example.org")
    p = row(spark, base, "meta_ip_service", id="10.0.0.0/8")
    assert (p.service_label, p.service_prefix_group_name, p.service_type, p.org_short_name, p.org_types, p.org_hide, p.as_id) == (
        ["A", "B"], ["G1"], ["T"], "c1", ["Site", "Lab"], True, 12)
    jobs.service_edge_job(spark, services, base, stamp(1), "db.example.org")
    e = row(spark, base, "meta_interface_service", id="cr6::se-1")
    assert (e.org_hide, e.org_tag, e.peer_as_id, e.peer_ipv4, e.peer_ipv6) == (True, ["Transit"], 123, "192.0.2.1", "2001:db8::1")


def test_interface_cache_and_kv(spark, base, tmp_path):
    from telescry.operators.keyed import INTERFACE_POLL_SCHEMA

    out = str(tmp_path / "base")
    polls = tmp_path / "polls.json"
    polls.write_text(json.dumps({"meta": {"id": "r1::eth0", "device": "r1", "intercloud": [True], "if_index": "5", "port_name": "eth0", "visibility": False, "peer": {"asn": 9}}}))
    jobs.interface_cache_job(spark, spark.read.schema(INTERFACE_POLL_SCHEMA).json(str(polls)), out, stamp(1))
    jobs.interface_export_job(spark, out, stamp(1))
    i = row(spark, out, "meta_interface", id="r1::eth0")
    assert (i.type, i.name, i.edge, i.flow_index, i.peer_as_id, i.port_interface_id) == ("interface", "eth0", True, 5, 9, "r1::eth0")
    jobs.interface_export_job(spark, out, stamp(3))  # the cache has expired by then
    assert spark.read.parquet(f"{out}/meta_interface").count() == 1
    jobs.kv_job(spark, base, ["meta_device", "meta_interface:device_id:flow_index"], stamp(5))
    got = {(r.table, r.key): r.value for r in jobs.kv(spark, base).collect()}
    assert got[("meta_device", "hub-1")] == "hub-1__v1"
    assert got[("meta_interface:device_id:flow_index", "hub-1:410")] == "hub-1::customer-4"


def test_snapshot_source_and_archive(spark, base, tmp_path):
    rows = files.snapshot(spark.read.parquet(f"{base}/meta_device"), LookupSpec.parse("meta_device:@loopback_ip")).collect()
    assert {(r.id, r.loopback_ip) for r in rows} == {("hub-1", "192.0.2.1"), ("hub-1", "192.0.2.2"), ("rim-2", "192.0.2.9")}
    src = str(tmp_path / "in")
    kafka_rows(spark, ['{"b":1,"a":{"d":1,"c":2}}', "{nope"], src)
    jobs.message_archive_stream(messages.read_messages(spark, True, "json", path=src), str(tmp_path / "out"), str(tmp_path / "cp"), None).awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out/data_kafka_message").collect()
    assert [(r.topic, r.offset, r.value) for r in got] == [("t", 0, '{"a":{"c":2,"d":1},"b":1}')]


def test_specs_cover_all_tables():
    assert len(specs.ALL) == 18
