"""Joins against brute force, merges, versions and streams on small frames."""

import ipaddress
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from telescry.config import FlowConfig, Policy, parse_list, parse_pairs
from telescry.operators import flows, keyed, lookup, prefix, ranges, rollup, snapshot, versioned
from telescry.operators.snapshot import LookupSpec
from telescry.operators.versioned import EntitySpec
from telescry.streaming.run import fan_out, run_stream, watermarked_rollup


def random_net(rng, v6):
    bits = 128 if v6 else 32
    base = int(ipaddress.ip_address("2001:db8::" if v6 else "10.0.0.0"))
    length = rng.choice([0, 8, 20, 31, 32, 48, 63, 64, 65, 100, 128] if v6 else [0, 1, 8, 9, 12, 24, 31, 32])
    value = base + rng.getrandbits(bits - 16 if v6 else 24)
    net = ipaddress.ip_network((value, length), strict=False)
    return net


@pytest.mark.parametrize(("few", "lengths"), [(400_000, 0), (0, 0), (400_000, 129)])
def test_longest_prefix_matches_brute_force(spark, monkeypatch, few, lengths):
    monkeypatch.setattr(prefix, "BROADCAST_ROWS", few)
    monkeypatch.setattr(prefix, "FEW_LENGTHS", {4: lengths, 6: lengths})
    rng = random.Random(7)
    nets = [random_net(rng, i % 2) for i in range(120)] + [ipaddress.ip_network("10.1.0.0/16"), ipaddress.ip_network("10.1.2.0/24")]
    rows = [(f"{i:04d}", f"r{i}", [(str(n.network_address), n.prefixlen)], i) for i, n in enumerate(nets)]
    rows.append(("x", "bad", [("10.0.0.0", 40), ("nope", 8), ("::ffff:10.9.0.0", 16)], 1))
    blocks = spark.createDataFrame(rows, "id string, ref string, ip_subnet array<struct<ip:string,len:int>>, as_id int")
    index = prefix.subnet_index(blocks, ["ref", "as_id"])
    ips = [str(ipaddress.ip_address(int(n.network_address) + rng.randrange(min(n.num_addresses, 2**60)))) for n in nets for _ in range(2)]
    ips += ["::ffff:10.9.1.1", "8.8.8.8", "junk", "", None, "2001:DB8::1"]
    known = [(n, f"r{i}") for i, n in enumerate(nets)] + [(ipaddress.ip_network("10.9.0.0/16"), "bad")]

    def expect(text):
        try:
            ip = ipaddress.ip_address(text or "")
        except ValueError:
            return None
        ip = ip.ipv4_mapped or ip if ip.version == 6 else ip
        best = None
        for n, ref in known:  # later entries of the same prefix win, as ids ascend
            if n.version == ip.version and ip in n and (best is None or n.prefixlen >= best[0]):
                best = (n.prefixlen, ref)
        return best and best[1]

    df = spark.createDataFrame([(i, ip) for i, ip in enumerate(ips)], "n int, ip string")
    got = {r.n: r.ref for r in prefix.lpm_join(df, "ip", index, {"ref": "ref"}).collect()}
    assert got == {i: expect(ip) for i, ip in enumerate(ips)}


@pytest.mark.parametrize(("v6", "lengths"), [(False, 0), (True, 0), (False, 129)])
def test_search_of_nested_prefixes(spark, monkeypatch, v6, lengths):
    """Many prefixes inside one another, at nearly every length, so that searches follow markers and are led astray."""
    monkeypatch.setattr(prefix, "FEW_LENGTHS", {4: lengths, 6: lengths})
    rng, bits = random.Random(17 + v6), 128 if v6 else 32
    base = int(ipaddress.ip_address("2001:db8::" if v6 else "10.1.2.0"))
    spread = 70 if v6 else 10
    nets = sorted({ipaddress.ip_network((base + rng.getrandbits(spread), rng.randint(bits - spread - 8, bits)), strict=False) for _ in range(150)}, key=str)
    rows = [(f"{i:03d}", [(str(n.network_address), n.prefixlen)], i) for i, n in enumerate(nets)]
    index = prefix.subnet_index(spark.createDataFrame(rows, "id string, ip_subnet array<struct<ip:string,len:int>>, v int"), ["v"])
    ips = sorted({str(ipaddress.ip_address(base + rng.getrandbits(spread))) for _ in range(200)} | {str(n.network_address) for n in nets})
    best = lambda inside: max(((n.prefixlen, k) for k, n in enumerate(nets) if inside(n)), default=(0, None))[1]
    joined = prefix.lpm_join(spark.createDataFrame([(ip,) for ip in ips], "ip string"), "ip", index, {"v": "v"})
    assert {r.ip: r.v for r in joined.collect()} == {ip: best(lambda n, a=ipaddress.ip_address(ip): a in n) for ip in ips}
    probes = sorted({ipaddress.ip_network((base + rng.getrandbits(spread), rng.randint(bits - spread - 8, bits)), strict=False) for _ in range(150)}, key=str)
    covered = prefix.cidr_join(spark.createDataFrame([(str(p),) for p in probes], "net string"), "net", index, {"v": "v"})
    assert {r.net: r.v for r in covered.collect()} == {str(p): best(lambda n, p=p: p.subnet_of(n)) for p in probes}


def test_search_takes_few_joins(spark):
    for n, joins in ((33, 6), (129, 8), (1, 1), (0, 0)):
        assert n.bit_length() == joins
    assert all(len(prefix.search_path(at, 129)) <= 8 for at in range(129))
    nets = [(f"{k}", [(f"10.0.{k}.0", 8 + k)], k) for k in range(24)]
    search = prefix.searchable(prefix.subnet_index(spark.createDataFrame(nets, "id string, ip_subnet array<struct<ip:string,len:int>>, v int"), ["v"]))
    assert search.lengths == {4: list(range(8, 32))} and search.entries.count() <= 24 * 5


def test_cidr_join_matches_brute_force(spark):
    rng = random.Random(3)
    nets = list({random_net(rng, i % 2) for i in range(80)})
    rows = [(f"{i:03d}", [(str(n.network_address), n.prefixlen)], i) for i, n in enumerate(nets)]
    index = prefix.subnet_index(spark.createDataFrame(rows, "id string, ip_subnet array<struct<ip:string,len:int>>, v int"), ["v"])
    probes = [random_net(rng, i % 2) for i in range(150)]
    df = spark.createDataFrame([(i, str(p)) for i, p in enumerate(probes)] + [(-1, "bad")], "n int, net string")
    got = {r.n: r.v for r in prefix.cidr_join(df, "net", index, {"v": "v"}).collect()}
    for i, p in enumerate(probes):
        covering = [(n.prefixlen, k) for k, n in enumerate(nets) if n.version == p.version and p.subnet_of(n)]
        assert got[i] == (max(covering)[1] if covering else None), p
    assert got[-1] is None


def test_ranges_match_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for i in range(300):
        a = rng.choice([rng.randrange(-50, 70000), rng.randrange(0, 2**40)])
        rows.append((rng.choice(["TCP", "udp"]), a, a + rng.choice([0, 1, 7, 1000, 2**33]), f"id{i:03d}"))
    df = spark.createDataFrame(rows, "protocol string, a bigint, b bigint, id string")
    index = ranges.range_index(ranges.range_table(df, "a", "b", "protocol", "id"))
    probes = [(rng.choice(["tcp", "udp", "icmp"]), rng.choice([r[1], r[2], r[1] - 1, r[2] + 1, (r[1] + r[2]) // 2])) for r in rows for _ in range(2)]
    got = ranges.range_join(spark.createDataFrame(probes, "k string, v bigint"), index, F.col("k"), F.col("v"), "id").distinct().collect()
    found = {(r.k, r.v): r.id for r in got}
    for k, v in probes:
        hits = [(a, b, i) for p, a, b, i in rows if p.lower() == k and a <= v <= b]
        assert found[(k, v)] == (min(hits)[2] if hits else None)
    ports = {(r.key, r.port): r.value for r in ranges.port_dimension(index).collect()}
    for k in ("tcp", "udp"):
        for v in (0, 1, 53, 443, 30000, 65535):
            hits = [(a, b, i) for p, a, b, i in rows if p.lower() == k and a <= v <= b]
            assert ports.get((k, v)) == (min(hits)[2] if hits else None)
    assert max(v for _, v in ports) <= 65535


def test_range_rules(spark):
    rows = [("TCP", "105", "100", "app-x"), ("tcp", "80", "81", "app-http"), ("tcp", "x", "9", "no"), (None, "1", "2", "no"), ("udp", "1", "2", "")]
    df = spark.createDataFrame(rows, "protocol string, port_range_min string, port_range_max string, id string")
    known = {(r.key, r.port) for r in ranges.port_dimension(ranges.cache_ranges(df)).collect()}
    assert known == {("tcp", p) for p in (80, 81, 100, 101, 102, 103, 104, 105)}
    exact = {(r.key, r.port) for r in ranges.port_dimension(ranges.dictionary_ranges(df)).collect()}
    assert exact == {("tcp", 80), ("tcp", 81), ("udp", 1), ("udp", 2)}


def test_lookup_specs():
    assert LookupSpec.parse("meta_device") == LookupSpec("meta_device")
    assert LookupSpec.parse("meta_if:device_id:@ip") == LookupSpec("meta_if", ("device_id", "ip"), ("ip",))
    assert parse_pairs("100:blue, 2:a:b,junk") == {"100": "blue", "2": "a:b"} and parse_list(" a,,b ") == ("a", "b")


def test_required_lookup_fields(spark):
    df = spark.createDataFrame([("a", "a__v1", 1, datetime(2024, 1, 1)), ("b", "b__v1", None, datetime(2024, 1, 1))], "id string, ref string, as_id int, insert_time timestamp")
    ids = lambda spec: {r.id for r in snapshot.lookup_rows(df, spec).collect()}
    assert ids(LookupSpec.parse("t:as_id")) == {"a"} and ids(LookupSpec.parse("t:as_id", require_fields=False)) == {"a", "b"}


def test_versions_order_numerically(spark):
    rows = [("a", f"a__v{i}", f"h{i}", datetime(2024, 1, 1)) for i in (2, 10, 9)]
    got = snapshot.current(spark.createDataFrame(rows, "id string, ref string, hash string, insert_time timestamp")).collect()
    assert [(r.ref, r.hash) for r in got] == [("a__v10", "h10")]


def test_unconfigured_lookup_behaves_as_empty(spark):
    df = spark.createDataFrame([(1, ["a"])], "k int, ids array<string>")
    assert lookup.lookup_join(df, None, {"k": "id"}, {"ref": "r"}).first().r is None
    assert lookup.lookup_array(df, "k", "ids", None, "r").first().r == [None]
    assert lookup.lookup_array(df, "k", "ids", None, "r", keep_misses=False).first().r == []


SPEC = EntitySpec("t", {"name": "text"}, required=("id", "name"))


def staged(spark, *records):
    rows = [(i, f'{{"id":"{k}","name":"{v}"}}') for i, (k, v) in enumerate(records)]
    return versioned.stage(spark.createDataFrame(rows, "pos int, row_json string"), SPEC)


def test_force_update_of_a_new_id(spark):
    got = versioned.upsert_versions(staged(spark, ("a", "x")), None, SPEC, force=True).collect()
    assert [r.ref for r in got] == ["a__v1"]


def test_force_bumps_unchanged(spark):
    first = versioned.upsert_versions(staged(spark, ("a", "x")), None, SPEC)
    got = versioned.upsert_versions(staged(spark, ("a", "x"), ("b", "y")), first, SPEC, force=True).collect()
    assert {r.ref for r in got} == {"a__v2", "b__v1"}
    assert versioned.upsert_versions(staged(spark, ("a", "x")), first, SPEC).count() == 0


def test_list_self_references(spark):
    spec = EntitySpec("t", {"child_id": "texts"}, list_refs=(("child", "t"),), self_list_refs=("child",))
    rows = [(0, '{"id":"item1","child_id":["item2","item3","old"]}'), (1, '{"id":"item2"}'), (2, '{"id":"item3"}')]
    batch = versioned.stage(spark.createDataFrame(rows, "pos int, row_json string"), spec)
    known = spark.createDataFrame([("old", "old__v7")], "id string, ref string")
    got = {r.id: r.child_ref for r in versioned.upsert_versions(versioned.with_refs(batch, spec, {"t": known}), None, spec).collect()}
    assert got == {"item1": ["item2__v1", "item3__v1", "old__v7"], "item2": [], "item3": []}


def test_policy_scopes(spark):
    cfg = FlowConfig(policy=Policy(scope=("x",)), community_scopes={"100": "community1"})
    df = spark.createDataFrame([(65001, 65002, "65000:100"), (0, None, "no-colon"), (5, 5, None)], "s bigint, d bigint, rd string")
    got = [r.r for r in df.select(flows.scope_list(cfg, F.col("s"), F.col("d"), F.col("rd")).alias("r")).collect()]
    assert got == [["x", "as:65001", "as:65002", "comm:community1"], ["x"], ["x", "as:5"]]
    off = FlowConfig(auto_scopes=False)
    assert df.select(flows.scope_list(off, F.col("s"), F.col("d"), F.col("rd")).alias("r")).first().r == []


def test_merges(spark):
    df = spark.createDataFrame([("k", 1, 5, None), ("k", 2, None, "b"), ("k", 3, None, None)], "k string, t int, a int, b string")
    r = snapshot.coalesce_latest(df, ["k"], ["a", "b"], F.col("t")).first()
    assert (r.a, r.b) == (5, "b")
    last = snapshot.keep_last(df, ["k"], [F.col("t")]).first()
    assert (last.t, last.a, last.b) == (3, None, None)


def test_expiry(spark):
    rows = [("t", "a", "1", datetime(2024, 1, 1), 60), ("t", "b", "2", datetime(2024, 1, 1), None), ("t", "a", "0", datetime(2023, 1, 1), None)]
    kv = spark.createDataFrame(rows, "table string, key string, value string, updated_at timestamp, expires int")
    at = lambda s: {r.key: r.value for r in keyed.kv_view(kv, F.lit(s).cast("timestamp")).collect()}
    assert at("2024-01-01 00:00:59") == {"a": "1", "b": "2"} and at("2024-01-01 00:01:00") == {"b": "2"}


def test_window_validation(spark):
    df = spark.createDataFrame([(datetime(2024, 2, 29, 13, 7),)], "start_time timestamp")
    from telescry.functions.timing import time_bucket

    got = {w: df.select(time_bucket(F.col("start_time"), w)).first()[0] for w in ("5m", "12H", "1w", "3mo", "5y")}
    assert got == {"5m": datetime(2024, 2, 29, 13, 5), "12H": datetime(2024, 2, 29, 12), "1w": datetime(2024, 2, 26), "3mo": datetime(2024, 1, 1), "5y": datetime(2020, 1, 1)}
    with pytest.raises(ValueError):
        time_bucket(F.col("start_time"), "5 minutes")


FLOW_SCHEMA = "start_time timestamp, policy_originator string, policy_level string, policy_scope array<string>, ip_version int, bit_count bigint, packet_count bigint"


def flow_rows(spark, *times):
    return spark.createDataFrame([(t, "o", "l", ["s"], 4, 8, 1) for t in times], FLOW_SCHEMA)


def test_watermarked_rollup_drops_only_late_rows(spark, tmp_path):
    src = str(tmp_path / "in")
    flow_rows(spark, datetime(2024, 1, 1, 0, 1), datetime(2024, 1, 1, 0, 2)).write.mode("append").parquet(src)
    stream = spark.readStream.schema(FLOW_SCHEMA).parquet(src)
    rolled = watermarked_rollup(stream, rollup.IP_VERSION, "5m", "10 minutes")
    q = rolled.writeStream.outputMode("update").format("memory").queryName("rolled").start()
    q.processAllAvailable()
    flow_rows(spark, datetime(2024, 1, 1, 1, 0)).write.mode("append").parquet(src)
    q.processAllAvailable()
    flow_rows(spark, datetime(2024, 1, 1, 0, 3), datetime(2024, 1, 1, 0, 58)).write.mode("append").parquet(src)
    q.processAllAvailable()
    q.stop()
    got = {(r.start_time, r.flow_count) for r in spark.table("rolled").collect()}
    assert got == {(datetime(2024, 1, 1, 0, 0), 2), (datetime(2024, 1, 1, 1, 0), 1), (datetime(2024, 1, 1, 0, 55), 1)}


def test_fan_out(spark, tmp_path):
    src, seen = str(tmp_path / "in"), []
    flow_rows(spark, datetime(2024, 1, 1)).write.parquet(src)
    stream = spark.readStream.schema(FLOW_SCHEMA).parquet(src)
    handle = fan_out([
        (lambda b: b.filter("ip_version = 4"), lambda df, i: seen.append(("four", df.count()))),
        (lambda b: b.filter("ip_version = 6"), lambda df, i: seen.append(("six", df.count())))])
    run_stream(stream, handle, str(tmp_path / "cp"), None).awaitTermination()
    assert seen == [("four", 1), ("six", 0)]


def test_keyed_state(spark, tmp_path):
    """Order by message time, state over restarts, and expiry of single fields."""
    import time

    from telescry.streaming.state import keyed_state, run_once

    src, schema = str(tmp_path / "in"), "table string, key string, field string, value string, at timestamp, seq long"
    at = lambda h: datetime(2024, 1, 1, h)

    def run(checkpoint, ttl, *rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        seen = []
        query = keyed_state(spark.readStream.schema(schema).parquet(src), ttl).writeStream.outputMode("update")
        run_once(query.foreachBatch(lambda batch, _: seen.extend((r.key, r.field, r.value, r.updates) for r in batch.collect())).option("checkpointLocation", str(tmp_path / checkpoint)), spark)
        return sorted(seen)

    first = (("t", "a", "x", "1", at(5), 2), ("t", "a", "x", "0", at(5), 1), ("t", "a", "y", "2", at(1), 1), ("t", "b", "x", None, at(1), 1))
    assert run("long", 86400, *first) == [("a", "x", "1", 2), ("a", "y", "2", 1)]
    # a new query with the same checkpoint; "late" is older by message time
    assert run("long", 86400, ("t", "a", "x", "3", at(6), 0), ("t", "a", "x", "late", at(2), 9), ("t", "c", "x", "n", None, None)) == [("a", "x", "3", 4), ("c", "x", "n", 1)]
    assert run("short", 1, ("t", "d", "x", "7", at(1), 1))
    time.sleep(2)
    assert run("short", 1, ("t", "d", "x", "8", at(0), 1)) == [("d", "x", "8", 1)]  # what it would not have replaced has expired


def test_replayed_lookup_equals_plain_replay(spark, tmp_path):
    """Readers see what the messages before them wrote, over batches, restarts and partitions, not what they write themselves."""
    from telescry.streaming.state import replayed_lookup, run_once

    src, schema = str(tmp_path / "in"), "table string, key string, value string, writes int, partition int, offset long"
    rng, held, offset = random.Random(5), {}, 0
    for number in range(3):
        rows, wanted = [], []
        for partition in (0, 1):
            for _ in range(40):
                offset += 1
                key = rng.choice("abc")
                if rng.random() < 0.7:
                    rows.append(("t", key, None, 0, partition, offset))
                    wanted.append((key, partition, offset, held.get(key)))
                if rng.random() < 0.5:
                    held[key] = f"v{offset}"
                    rows.append(("t", key, held[key], 1, partition, offset))
        rng.shuffle(rows)
        spark.createDataFrame(rows, schema).write.mode("append").parquet(src)
        seen = []
        query = replayed_lookup(spark.readStream.schema(schema).parquet(src)).writeStream.outputMode("append")
        run_once(query.foreachBatch(lambda batch, _, seen=seen: seen.extend((r.key, r.partition, r.offset, r.seen) for r in batch.collect())).option("checkpointLocation", str(tmp_path / "ckpt")), spark)
        assert sorted(seen, key=str) == sorted(wanted, key=str), number


def test_replayed_values_expire(spark, tmp_path):
    import time

    from telescry.streaming.state import replayed_lookup, run_once

    src, schema = str(tmp_path / "in"), "table string, key string, value string, writes int, partition int, offset long"

    def run(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        seen = []
        query = replayed_lookup(spark.readStream.schema(schema).parquet(src), 1).writeStream.outputMode("append")
        run_once(query.foreachBatch(lambda batch, _: seen.extend(r.seen for r in batch.collect())).option("checkpointLocation", str(tmp_path / "ckpt")), spark)
        return seen

    assert run(("t", "a", "x", 1, 0, 1), ("t", "a", None, 0, 0, 2)) == ["x"]
    time.sleep(2)
    assert run(("t", "a", None, 0, 0, 3)) == [None]


def test_label_words_of_64_bits(spark):
    from telescry.functions import flow as ff

    df = spark.createDataFrame([(["0000000000001234", "ff-ff-ff-ff-ff-ff-ff-ff", "00", "1ffffffffffffffff", "zz"],)], "t array<string>")
    words = ff.label_words(F.col("t"))
    r = df.select(ff.label_values(words).alias("v"), ff.label_exp(words).alias("e")).first()
    assert r.v == [0x123, (1 << 60) - 1, 0, None] and r.e == [2, 7, 0, None]


def test_rollup_compaction_that_broke_off(spark, tmp_path):
    from datetime import date

    from telescry.operators import rollup
    from telescry.sinks import tables as sinks
    from telescry.streaming.run import compact_rollup, read_rollup, rollup_sink

    base, kind = str(tmp_path), rollup.IP_VERSION
    sink = rollup_sink(kind, "1d", base)
    for writer, number, day in (("a", 0, 1), ("a", 1, 1), ("b", 0, 1), ("b", 1, 2)):
        sink(flow_rows(spark, datetime(2024, 1, day)), sinks.Batch(writer, number))
    total = lambda: sorted((str(r.start_time), r.flow_count) for r in read_rollup(spark, base, kind, "1d").collect())
    want = [("2024-01-01 00:00:00", 3), ("2024-01-02 00:00:00", 1)]
    assert total() == want
    compact_rollup(spark, base, kind, "1d", date(2024, 1, 2), 1)
    assert total() == want
    sink(flow_rows(spark, datetime(2024, 1, 1)), sinks.Batch("a", 2))  # a late batch beside the sum
    want[0] = (want[0][0], 4)
    assert total() == want
    # a write aside that is complete is finished by the next reader, one that is not is dropped
    table = sinks.rollup_table(kind, "1d")
    old = sinks.batch_folders(spark, table, base, date(2024, 1, 2))
    rows = read_rollup(spark, base, kind, "1d").filter("start_time < '2024-01-02'")
    aside = f"{base}/{table.name}.replacing"
    spark.createDataFrame([(p,) for p in old], "value string").write.text(f"{aside}/_old")
    sinks._write(sinks.declared(rows, table.columns).withColumn("dt", F.to_date("start_time")), f"{aside}/rows", ["dt"], (), sinks.Batch("compact", 2))
    assert total() == want
    spark.createDataFrame([("x",)], "value string").write.text(f"{aside}/_old")
    assert total() == want and not sinks.path_exists(spark, aside)
    compact_rollup(spark, base, kind, "1d", date(2024, 1, 2), 3)
    assert total() == want
