"""Flows enriched for a rollup: only what it reads is looked up."""

import pytest
from pyspark.sql import functions as F

from telescry.operators import flows, prefix, rollup

_WIRE = "ip_src string, ip_dst string, port_src string, port_dst string, ip_proto string, timestamp_start string, bytes string, packets string, as_src string, as_dst string, peer_ip_src string, iface_in string, iface_out string"


def _rows(spark):
    rows = [("10.1.0.1", "10.2.0.1", "1", "2", "tcp", "1700000000", "10", "1", None, "7", "192.0.2.1", "1", "2"),
            ("10.2.0.9", "10.1.0.9", "3", "4", "udp", "1700000000", "20", "2", "8", None, "192.0.2.1", "2", "3"),
            ("10.3.0.9", "10.1.0.9", "3", "4", "udp", "1700090000", "30", "3", "8", "8", "192.0.2.7", "1", None)]
    return spark.createDataFrame(rows, _WIRE)


def _lookups(spark, refs):
    stamp = F.lit("2024-01-01").cast("timestamp").alias("insert_time")
    blocks = spark.createDataFrame([("a", "a__v1", [("10.1.0.0", 16)], 7), ("b", "b__v1", [("10.2.0.0", 16)], 8)], "id string, ref string, ip_subnet array<struct<ip:string,len:int>>, as_id int")
    devices = spark.createDataFrame([("hub", "hub__v1", ["192.0.2.1"])], "id string, ref string, loopback_ip array<string>").select("*", stamp)
    interfaces = spark.createDataFrame([("hub::1", "hub::1__v1", "hub", 1, True), ("hub::2", "hub::2__v1", "hub", 2, False)], "id string, ref string, device_id string, flow_index int, edge boolean").select("*", stamp)
    return flows.FlowLookups(ip=prefix.subnet_index(blocks, ["ref", "as_id"]), as_refs=spark.createDataFrame(refs, "id int, ref string"), devices=devices, interfaces=interfaces)


def test_a_rollup_of_interfaces_joins_no_addresses(spark, monkeypatch):
    monkeypatch.setattr(flows, "lpm_resolve", lambda *_: pytest.fail("addresses were looked up"))
    found = flows.ingest(_rows(spark), _lookups(spark, [(7, "7__v1")]), wanted=rollup.INTERFACE.reads())
    rolled = rollup.rollup(found, rollup.INTERFACE, "1d").select("in_interface_id", "out_interface_id", "flow_count", "bit_count").collect()
    assert [r[:] for r in rolled] == [("hub::1", "hub::2", 1, 80)]


@pytest.mark.parametrize("refs", [[(7, "7__v1"), (8, "8__v1")], [(7, "7__v1"), (8, "8__v1"), (8, "8__v2"), (None, "x"), (None, "y")]])
@pytest.mark.parametrize("kind", [rollup.EDGE_AS, rollup.INTERFACE, rollup.IP_VERSION])
def test_wanted_columns_are_those_of_whole_flows(spark, refs, kind):
    """Also where a lookup has a key twice, which gives its rows twice."""
    known = _lookups(spark, refs)
    whole, part = (flows.ingest(_rows(spark), known, wanted=w) for w in (None, kind.reads()))
    assert set(part.columns) == kind.reads()
    key = lambda df: sorted(map(str, df.select(*sorted(kind.reads())).collect()))
    assert key(part) == key(whole)


def test_rows_are_filtered_before_they_are_joined_by_address(spark):
    """Small lookups come first, so a filter on their columns stands below the other joins."""
    found = rollup.EDGE_AS.rows(flows.ingest(_rows(spark), _lookups(spark, [(7, "7__v1")]), wanted=rollup.EDGE_AS.reads()))
    plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    joins = [n for n, line in enumerate(plan) if "Join LeftOuter" in line and "src_ip" in line]
    filters = [n for n, line in enumerate(plan) if "Filter" in line and "edge" in line]
    assert joins and filters and joins[0] < filters[0]
