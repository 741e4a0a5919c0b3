"""Lexical search, compression classifier and conversation repair on small fixtures, against brute force."""

import hashlib
import heapq
import math
import random
import re
import zlib
from itertools import product

import numpy as np
import pytest

from telescry.llm import compression, lexical, repair

WORDS = "the of and an ering tion house River río straße 2024 x9 zebra quartz".split()
DOCS = "doc_id long, text string, score long, rank string, item_id string, label string"


def docs_of(spark, rows):
    return spark.createDataFrame([(k, t, 1, "r", "i", "l") for k, t in rows], DOCS)


def bm25(docs, item, k):
    """The contract, spelt out."""
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    found = [(key, t) for key, t in ((key, term.findall(low(text))) for key, text in docs) if t]
    n_docs, words = len(found), sum(len(t) for _, t in found)
    df = {x: sum(x in t for _, t in found) for x in set(term.findall(low(item)))}
    out = []
    for key, t in found:
        m = 100 - 75 + ((75 * len(t) * n_docs) // words)
        score = sum(
            math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * ((1000000000 * t.count(x)) // (1000 * t.count(x) + 8 * m)) for x in term.findall(low(item)) if x in t)
        if score > 0:
            out.append((-score, key is None, key or 0))
    return [(None if null else key, -s) for s, null, key in sorted(out)[:k]]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    weights = [40, 30, 30, 20, 10, 8, 5, 3, 2, 2, 1, 1, 1, 1]
    rows = [(k, " ".join(rng.choices(WORDS, weights, k=rng.randint(1, 60))) + rng.choice([".", "!", "\n"])) for k in range(300)]
    rows += [(400 + k, "zebra quartz of the river, " * 3) for k in range(25)]  # equal scores
    return rows + [(900, None), (901, ""), (902, " -- \x00 "), (None, "zebra house"), (None, "zebra house"), (3, "Zebra ZEBRA zebra"), (903, "the " * 5000 + "zebra")]


@pytest.mark.parametrize("limits", [(32_768, 1_000_000, 1024, 0.125), (40, 90, 8, 0.3), (64, 10**6, 4, 0.0), (64, 10**6, 16, 9.0)])
def test_ranked_search_equals_brute_force(spark, texts, monkeypatch, limits):
    for name, value in zip(("SHARD_DOCS", "SHARD_POSTINGS", "WINDOW", "SHORT_SHARE"), limits):
        monkeypatch.setattr(lexical, name, value)
    items = [(1, "the zebra of quartz"), (2, "river RIVER river"), (3, "nothing here"), (4, ""), (5, None), (6, "the the and zebra 2024 of x9"), (7, "río straße"), (1, "the zebra of quartz"), (8, "an"), (8, "house")]
    asked = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    got = lexical.rank_documents(docs_of(spark, texts).repartition(3), asked, k=10).collect()
    want = {}
    for i, text in {1: items[0][1], 2: items[1][1], 3: items[2][1], 6: items[5][1], 7: items[6][1], 8: "an house"}.items():
        want |= {(i, place): row for place, row in enumerate(bm25(texts, text, 10), 1)}
    assert {(r.item_id, r.rank): (r.doc_id, r.score) for r in got} == want
    assert len(got) == len(want)


def test_search_blocks_of_items_and_empty_tables(spark, texts):
    asked = spark.createDataFrame([(k, f"{a} {b}") for k, (a, b) in enumerate(product(WORDS[:4], WORDS[-4:]))], "item_id long, text string")
    docs = docs_of(spark, texts)
    one, many = (sorted(map(tuple, lexical.rank_documents(docs, asked, 5, block_terms=b).collect())) for b in (10**6, 3))
    assert one == many and one
    assert lexical.rank_documents(docs.limit(0), asked).count() == 0
    assert lexical.rank_documents(docs, asked.limit(0)).count() == 0


def test_search_skips(texts):
    """Once good documents are known, few candidates of the frequent terms come up."""
    rng = random.Random(9)
    n = 30_000
    places = [np.sort(rng.sample(range(n), m)) for m in (20, 15_000, 29_000)]
    shard = lexical.Shard(np.arange(3), np.cumsum([0] + [len(p) for p in places]), np.concatenate(places), np.full(sum(map(len, places)), 10), n)
    best, stats = lexical.Best(5), {}
    lexical.search_shard(shard, [(0, 900), (1, 20), (2, 1)], best, list(range(n)), stats)
    assert stats["candidates"] < 0.1 * stats["postings"]
    score = lambda d: 10 * sum(w for p, w in zip(places, (900, 20, 1)) if d in set(p.tolist()))
    assert best.rows == sorted((-score(int(d)), False, int(d)) for d in places[0])[:5]


LINES = ["The house by the river was of old stone and tions.", "An evening of quiet tion, then the birds went home.", "Le ciel est clair, la mer est belle."]


def labelled(spark, n):
    rng = random.Random(2)
    good = lambda: " ".join(rng.choice(LINES) + " " + rng.choice(WORDS) for _ in range(rng.randint(3, 30)))
    bad = lambda: " | ".join(rng.choice(["Home", "Cart$$$", "BUY!!", "###", "Login"]) + str(rng.randint(0, 99)) for _ in range(rng.randint(10, 80)))
    rows = [(k, good() if k % 3 else bad(), int(k % 3 > 0)) for k in range(n)]
    docs = docs_of(spark, [r[:2] for r in rows] + [(n, None), (n + 1, ""), (None, good()), (5, good()), (n + 2, good() * 400)])
    labels = spark.createDataFrame([(k, q, 0, "x") for k, _, q in rows] + [(0, None, None, None), (None, 1, 0, "x"), (1, 0, 0, "x")], "doc_id long, quality int, toxic int, text string")
    return docs, labels


def test_compression_classifier_tells_held_out_texts(spark):
    docs, labels = labelled(spark, 400)
    rows = compression.score_texts(docs, compression.learn(docs, labels)).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    held = [r for r in rows if r.held_out and r.doc_id < 400]
    assert len(held) > 40 and all(r.predicted == int(r.doc_id % 3 > 0) for r in held)
    again = compression.score_texts(docs, compression.learn(docs, labels)).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))


def test_compression_measures_whole_texts():
    model = compression.Model(b"menu | cart | login " * 40, b"the river and the house " * 40, 0.5, (0.0, 1.0, 0.0))
    scorer = compression.Scorer(model)
    text = "the house and the river " * 2000 + "é menu | cart" * 30
    n, bad, good = scorer.measures(text)
    data = text.encode()
    assert n == len(data) and b"".join(compression.pieces_of(text)) == data
    parts = [data[k : k + 256] for k in range(0, len(data), 256)]
    for got, sizer in zip((bad, good), scorer.sizers):
        assert got == sum(len(sizer.compress(p)) - sizer.least for p in parts)
    assert scorer.measures(None) == scorer.measures("") == (0, 0, 0)


def test_compression_without_classes(spark):
    docs, labels = labelled(spark, 30)
    one = compression.score_texts(docs, compression.learn(docs, labels.filter("quality = 1")))
    assert {round(r.score, 3) for r in one.collect()} == {1.0}
    none = compression.score_texts(docs, compression.learn(docs, labels.limit(0)))
    assert {r.score for r in none.collect()} == {0.5}
    assert compression.score_texts(docs.limit(0), compression.learn(docs.limit(0), labels)).count() == 0


# Conversation repair

def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return sorted(out, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3][:200], hashlib.sha256(r[3].encode()).digest()))


def plain_repair(rows):
    """Cheapest edits by Dijkstra over (row, roles so far), in the order (cost, audit)."""
    rows = damage(rows)
    seen, faults = set(), []
    for _, _, role, text in rows:
        body = text.strip("\x20\x09\x0a\x0b\x0c\x0d")
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    initials = [r[2][:1] for r in rows]
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    step = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}  # by the last initial
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, last, lines = heapq.heappop(heap)
        if (at, last) in done:
            continue
        done.add((at, last))
        if at == len(rows) and last in ("", "a"):
            illegal = sum(a + b not in {"su", "ua", "au"} for a, b in zip(initials, initials[1:]))
            digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
            return (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, digest)
        for c, name in (("u", "user"), ("a", "assistant")):
            if c in step[last]:
                heapq.heappush(heap, (cost + 2, audit + "I", at, step[last][c], (*lines, name + ":")))
        if at < len(rows):
            _, _, role, text = rows[at]
            heapq.heappush(heap, (cost + 3, audit + "D", at + 1, last, lines))
            if faults[at] not in ("blank", "duplicate"):
                extra = int(faults[at] == "truncated")
                if role[:1] in step[last]:
                    heapq.heappush(heap, (cost + extra, audit + "K", at + 1, step[last][role[:1]], (*lines, f"{role}:{text}")))
                for c, name in (("u", "user"), ("a", "assistant")):
                    if c in step[last]:
                        heapq.heappush(heap, (cost + 2 + extra, audit + "R", at + 1, step[last][c], (*lines, f"{name}:{text}")))
    raise AssertionError


def conversations():
    rng = random.Random(11)
    roles = ["user", "assistant", "system", "tool", None, "", "user", "assistant", "usher"]
    say = ["Yes.", "No", "Why?", " \t", None, "", "Well! ", "x" * 300 + "1.", "x" * 300 + "2", "été"]
    rows = []
    for conv in range(120):
        for turn in range(rng.randint(1, 9)):
            rows.append((conv, rng.choice([turn, turn, turn + 2, None]), rng.choice(roles), rng.choice(say) if rng.random() < 0.4 else f"line {rng.random()}."))
    rows += [(None, k, "user" if k % 2 else "assistant", f"t {k % 5}!") for k in range(9)]
    rows += [(-1, 3, "user", "same.")] * 7 + [(-2, 10**12, "user", "far."), (-2, -5, "assistant", "near.")]
    return rows


def check_repair(spark, rows, expected):
    schema = "conv_id long, turn long, role string, text string, gaps string, cost string, number string, cell string, hash string, copy string"
    frame = spark.createDataFrame([(*r, *"abcdef") for r in rows], schema).repartition(3)
    got = {r.conv_id: tuple(r)[1:] for r in repair.repair(frame).collect()}
    assert got == expected
    return frame


def by_conversation(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    return groups


@pytest.mark.parametrize("limits", [(128, 1 << 18, 64), (2, 1 << 18, 2), (3, 10, 2)])
def test_repair_equals_dijkstra(spark, monkeypatch, limits):
    for name, value in zip(("SPAN_ROWS", "SPAN_CHARS", "FAN"), limits):
        monkeypatch.setattr(repair, name, value)
    rows = conversations()
    want = {conv: plain_repair(group) for conv, group in by_conversation(rows).items()}
    want |= {conv: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for conv, group in by_conversation(rows).items() if not damage(group)}
    frame = check_repair(spark, rows, want)
    assert repair.repair(frame.limit(0)).count() == 0


def test_repair_of_one_long_conversation_over_many_spans(spark):
    """A conversation that many range partitions share, with a long run of equal rows."""
    rng = random.Random(4)
    rows = [(7, k, rng.choice(["user", "assistant", "user", "assistant", "system"]), rng.choice([f"line {k}.", f"line {k}", ""])) for k in range(1200)]
    rows += [(7, 1300, "user", "again and again.")] * 700 + [(8, 1, "user", "Hi."), (8, 2, "assistant", "Hello.")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # which would put rows this few together
    spans = repair.spans_of(repair.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)))
    held = [r["n"] for r in spans.filter("conv_id = 7").groupBy("part").agg({"span": "count"}).withColumnRenamed("count(span)", "n").collect()]
    assert len(held) == 4 and sum(held) > 12  # equal rows too are dealt over tasks
    check_repair(spark, rows, {conv: plain_repair(group) for conv, group in by_conversation(rows).items()})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_cells_do_not_depend_on_the_split():
    """The chart over aligned spans equals the least over all splits of all spans (full CYK)."""
    rng = random.Random(6)
    for _ in range(60):
        cells = [repair.row_cell(rng.choice("suax"), rng.choice(["", "truncated", "blank", "duplicate"])) for _ in range(rng.randint(1, 7))]
        n = len(cells)
        chart = {(i, i + 1): c for i, c in enumerate(cells)}
        for length in range(2, n + 1):
            for i in range(n - length + 1):
                best = {}
                for j in range(i + 1, i + length):
                    for key, value in repair.combined(chart[i, j], chart[j, i + length]).items():
                        repair.better(best, key, value)
                chart[i, i + length] = best
        assert repair.parse(cells) == chart[0, n]
