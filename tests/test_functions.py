"""Scalar decoding against the reference's own cases and Python's ipaddress."""

import ipaddress

from pyspark.sql import functions as F

from telescry.functions import flow as ff
from telescry.functions import net, snmp, text


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(fn(F.col("v")).alias("r")).first().r


def test_addresses_match_python(spark):
    texts = ["10.0.0.1", "256.1.1.1", "01.2.3.4", "::", "::1", "2001:db8::1", "fe80::", "::ffff:10.0.0.1", "::ffff:a00:1",
             "64:ff9b::1.2.3.4", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7", "1::2::3", ":1::2", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8",
             "2001:DB8::A", "abc", "", "12345::", "1:2:3:4:5:6:1.2.3.4", ":::", "1.2.3", "g::1", "1:2:3:4:5:6:7:8::", None]
    rows = net.with_address(spark.createDataFrame([(t,) for t in texts], "ip string"), "ip").collect()
    for r in rows:
        try:
            a = ipaddress.ip_address(r.ip or "")
        except ValueError:
            assert r.family is None, r
            continue
        if a.version == 6 and a.ipv4_mapped:
            a = a.ipv4_mapped
        assert (r.family, r.hi % 2**64, r.lo % 2**64) == (a.version, int(a) >> 64 if a.version == 6 else 0, int(a) % 2**64), r


def test_address_or_cidr(spark):
    got = {t: one(spark, t, net.address_or_cidr) for t in ("10.0.0.1", "10.0.0.0/8", "2001:db8::1", "bad", "10.0.0.0/x", "::1.2.3.4")}
    assert {k: tuple(v) if v else None for k, v in got.items()} == {
        "10.0.0.1": ("10.0.0.1", 32), "10.0.0.0/8": ("10.0.0.0", 8), "2001:db8::1": ("2001:db8::1", 128), "bad": None,
        "10.0.0.0/x": None, "::1.2.3.4": ("::1.2.3.4", 128)}


def as_path(spark, value, mode="reference"):
    df = spark.createDataFrame([(value,)], "v string").select(ff.as_numbers(F.col("v")).alias("n"))
    df = df.withColumn("s", ff.run_starts(F.col("n")))
    r = df.select(ff.path_without_repeats(F.col("n"), F.col("s")).alias("p"), ff.path_padding(F.col("n"), F.col("s"), mode).alias("q")).first()
    return r.p, r.q


def test_as_path(spark):
    assert as_path(spark, "65001_65001_65002_65003_65003_65003") == ([65001, 65002, 65003], [1, 2, 1])
    assert as_path(spark, "65001_65001_65002_65003_65003_65003", "true_run_length") == ([65001, 65002, 65003], [2, 1, 3])
    assert as_path(spark, "x_y") == ([], [])
    assert as_path(spark, None) == (None, None)


def test_port_names(spark):
    # bit layouts of the vendor table: physical, channel, virtual, lag, breakout, invalid
    physical = (1 << 25) | (2 << 21) | (3 << 15)
    cases = {
        str(physical): "1/2/3",
        str((1 << 29) | physical | 7): "1/2/3.7",
        str((0b0100 << 28) | 5): "virtual-5",
        str((0b0101 << 28) | 12): "lag-12",
        str((0b011 << 29) | (1 << 18) | (2 << 14) | (3 << 6) | 4): "1/2/c3/4",
        str(0x1E000000): None,
        "not_a_number": None,
    }
    for raw, want in cases.items():
        assert one(spark, raw, snmp.port_name) == want, raw


def test_sap_and_address_indexes(spark):
    physical = (1 << 25) | (2 << 21) | (3 << 15)
    assert one(spark, f"100.{physical}.200", snmp.sap_name) == "100-1/2/3-200"
    assert one(spark, f"100.{physical}.200.5", snmp.sap_queue) == "5"
    assert one(spark, f"100.{physical}", snmp.sap_name) is None
    assert one(spark, "1.4.203.0.113.7", snmp.address_text) == "203.0.113.7"
    assert one(spark, "2.16.32.1.13.184.0.7.0.0.0.0.0.0.0.0.0.9", snmp.address_text) == "2001:0db8:0007:0000:0000:0000:0000:0009"
    for bad in ("3.4.203.0.113.7", "1.4.203", "2.16.32.1", "a.4.1.2.3.4", ""):
        assert one(spark, bad, snmp.address_text) is None, bad


def test_coercions(spark):
    assert [one(spark, v, text.to_flag) for v in ("true", "True", "1", "yes", None)] == [True, True, True, False, False]
    assert [one(spark, v, text.int_or_zero) for v in ("7", "x", None)] == [7, 0, None]
    assert one(spark, '["192.0.2.1", "192.0.2.2"]', text.string_array) == ["192.0.2.1", "192.0.2.2"]
    assert one(spark, "not json", text.string_array) == []
    assert one(spark, "01:02:03", text.duration_seconds) == 3723
    assert one(spark, "1:00:00:01", text.duration_seconds) == 86401
    assert one(spark, "1:2", text.duration_seconds) is None
    assert str(one(spark, "2020-01-32", text.day_or_epoch)) == "1970-01-01"
    assert one(spark, '{"b":[1,{"d":1,"c":2}],"a":"x"}', text.canonical_json) == '{"a":"x","b":[1,{"c":2,"d":1}]}'


def test_named_groups_become_positions():
    pattern, groups = snmp.positional_pattern(r"(?:slot)?[.](?P<value>\w+)[.](?P<queue_num>\d+)")
    assert pattern == r"^(?:(?:slot)?[.](\w+)[.](\d+))" and groups == {"value": 1, "queue_num": 2}


def test_bad_windows():
    import pytest

    from telescry.functions.timing import parse_window

    assert parse_window("5M") == (5, "m") and parse_window("3mo") == (3, "mo")
    for bad in ("5", "m5", "5x", "", "0m"):
        with pytest.raises(ValueError):
            parse_window(bad)
