"""Operators on small fixtures: edge cases, brute force and exact round trips."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from telescry.llm import chat, dac, html, mixing, ngram_join, packing, pii, quality, tokens, topk, toxicity

public_tokenizers = pytest.importorskip("public_tokenizers")

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, size string"
SYLLABLES = "an er tion the ing ou re st ea in".split()


def prose(rng, words):
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(7)
    base = [prose(rng, n) for n in (80, 120, 200, 60, 400)]
    texts = [*base, *base[:2], *[near(rng, base[4], k) for k in range(1, 14)], *[near(rng, base[2], k) for k in (1, 3, 5, 8)], None, "", " \n\t ", "one", "one two", "One  TWO", "ÉTÉ été", prose(rng, 6000)]
    rows = [(k, t, "en", [None, "b", "a", "é"][k % 4], len(t or ""), "x", "y") for k, t in enumerate(texts)]
    rows += [rows[2], (None, base[3], None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def near(rng, text, edits):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = prose(rng, 1) + "x"
    return " ".join(words)


def shingle_sets(texts, width):
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out.append({tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    return out


def components(ids, texts, width, percent):
    sets = shingle_sets(texts, width)
    up = {i: i for i in ids}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in zip(ids, sets):
        for j, b in zip(ids, sets):
            if a and b and i != j and 100 * len(a & b) >= percent * len(a | b):
                x, y = top(i), top(j)
                up[max(x, y)] = min(x, y)
    return {i: (len(s), top(i)) for i, s in zip(ids, sets)}


@pytest.mark.parametrize(("width", "percent"), [(4, 85), (5, 80)])
def test_similarity_components(docs, width, percent):
    rows = docs.filter("doc_id is not null").select("doc_id", "text").distinct().collect()
    want = components([r.doc_id for r in rows], [r.text for r in rows], width, percent)
    got = ngram_join.similarity_components(docs, ngram_join.Likeness(width, percent)).collect()
    assert len(got) == docs.count()
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id]
    assert len({c for _, c in want.values()}) < len(want) - 5


def test_similarity_of_large_groups(spark, monkeypatch):
    """Chains of near copies whose ends are no links, with blocks of few rows."""
    monkeypatch.setattr(ngram_join, "_BLOCK", 7)
    rng = random.Random(3)
    chain = [prose(rng, 150)]
    for _ in range(40):
        chain.append(near(rng, chain[-1], 2))
    shared = prose(rng, 30)
    texts = chain + [shared + " " + prose(rng, 20) for _ in range(30)]
    rows = list(enumerate(texts))
    want = components([k for k, _ in rows], texts, 4, 85)
    got = ngram_join.similarity_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), ngram_join.Likeness(4, 85)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_part_keys_of_links_meet():
    rng, like = random.Random(1), ngram_join.Likeness(4, 85)
    for n in [1, 2, 3, 5, 8, 13, 14, 20, 40, 90, 200, 900]:
        for _ in range(20):
            own = np.unique(np.array([rng.getrandbits(64) for _ in range(n)], np.uint64))
            b = like.largest(n)
            drop = rng.randint(0, like.most_difference(n, n) // 2)
            other = np.unique(np.concatenate([own[drop:], np.array([rng.getrandbits(64) for _ in range(rng.randint(0, max(0, b - n + drop)))], np.uint64)]))
            common = len(np.intersect1d(own, other))
            if len(other) and like.linked(len(own), len(other), common):
                assert np.intersect1d(ngram_join.part_keys(own, like), ngram_join.part_keys(other, like)).size


def test_components_of_a_path(spark):
    from telescry.llm.components import connected

    links = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 90), (90, 95), (5, 5)], "a long, b long")
    got = {r.node: r.component for r in connected(links).collect()}
    assert got == {k: 0 for k in range(61)} | {90: 90, 95: 90, 100: 90}


def test_representatives(docs):
    kept = ngram_join.representatives(docs, ngram_join.Likeness(4, 85))
    assert kept.columns == docs.columns
    comps = ngram_join.similarity_components(docs, ngram_join.Likeness(4, 85)).filter("doc_id is not null")
    assert kept.filter("doc_id is not null").count() == comps.select("component_id").distinct().count()


def judged(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    tri = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, t in enumerate(tri) if tri.count(t) > 1 for k in range(3)}
    lines = text.split("\n")
    dup = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) and x in lines[:k] for k, x in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_quality_counts_and_verdict(docs):
    rng = random.Random(2)
    texts = [prose(rng, 60), "a b c a b c a b", "x\nx\n \n \nx", "the the the the", "a|b#c", "é ü\x0bß\x1cz", "menu | home | about | us\n" + prose(rng, 100)]
    for t in texts:
        j = quality.judge(t)
        assert (j["n_words"], j["word_chars"], j["n_symbols"], j["n_dup_lines"], j["n_repeat_words"]) == judged(t), t
    clean = quality.judge(texts[-1])
    assert clean["kept"] and clean["n_lines_removed"] == 1 and "menu" not in clean["clean_text"]
    assert not quality.judge("\n".join(["word*** another### third$$$"] * 2 + [prose(rng, 5)]) + " " + prose(rng, 60).replace(" ", "%%% "))["kept"]
    rows = quality.verdicts(docs).collect()
    assert len(rows) == docs.count() and all(not r.kept for r in rows if r.n_words < 50)
    out = quality.clean_lines(docs)
    assert out.filter("doc_id = 4").first().kept is True and "source" in out.columns


def test_tag_paths():
    page = ("<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href=x>Menu</a></ul></nav><header><p>Site, name.</header><div class='ad'>Buy, now!</div>"
            "<article><h1>Head</h1><p><b>One &amp; two,\n three.<br><p>Four <i>fi</i>ve.</article><section id=comments><p>No, never.</section><footer>&copy; x</footer></body>")
    assert html.main_text(page) == "Head\nOne & two, three.\nFour five."
    assert html.main_text(page.replace("article>", "div>")) == "Head\nOne & two, three.\nFour five."
    assert html.main_text(page[: page.index("Four") + 2]) == "Head\nOne & two, three.\nFo"
    assert html.main_text(page[: page.index("<article")]) == html.main_text("") == html.main_text(None) == ""
    assert html.main_text("<p>a<p>b <!-- c -->d<script>x<p>y</script>e &lt;f&gt;</p") == "a\nb de <f>"
    assert html.main_text("<div>" * 3000 + "deep, text." + "</div>" * 10) == "deep, text."


_BODY = [f"Paragraph {w}, of the story, goes on; and on, until it says what, where and why it happened, to whom." for w in "one two three four five".split()]


@pytest.mark.parametrize("tag", ["article", "main", "div"])
def test_scores_choose_inside_the_article(tag):
    """Nothing but the paths tells these remarks from the story."""
    body = "".join(f"<p>{x}</p>" for x in _BODY)
    noise = "<div class=q1><span>Only today</span></div><div class=q2><div><div>See it now</div></div></div>"
    page = f"<body><{tag}><h1>Head</h1>{noise}{body}<section><div><b>Ann</b> said nice</div></section></{tag}></body>"
    assert html.main_text(page) == "\n".join(["Head", *_BODY])


def test_whole_article_without_article_tags():
    long = " ".join(_BODY)
    entries = [f"{x} {k}" for k, x in enumerate(_BODY)]
    items = "".join(f"<li>{x}</li>" for x in entries)
    assert html.main_text(f"<body><div class=content><h1>Head</h1><p>Short.</p><p>{_BODY[0]}</p><ul>{items}</ul></div></body>") == "\n".join(["Head", "Short.", _BODY[0], *entries])
    assert html.main_text(f"<body><div><h1>Head</h1><div class=body><p>{long}</p><p>Short.</p></div></div></body>") == f"Head\n{long}\nShort."
    sections = "".join(f"<section><h2>Part {k}</h2><p>{x}</p></section>" for k, x in enumerate([_BODY[0], long * 20, "Short, end."]))
    assert html.main_text(f"<body><div>{sections}</div></body>") == f"Part 0\n{_BODY[0]}\nPart 1\n{long * 20}\nPart 2\nShort, end."
    assert html.main_text(f"<h1>Head</h1><p>{long}</p><blockquote>Short</blockquote>") == f"Head\n{long}\nShort"
    assert html.main_text(f"<body><div class=x><h3>Links</h3><div>a</div></div><div><p>{long}</p></div></body>") == long


def test_pages(spark):
    df = spark.createDataFrame([(1, None, None, "z"), (2, "u", "<p>x, y.", "z")], "page_id long, url string, html string, text string")
    assert [tuple(r) for r in html.extract(df).orderBy("page_id").collect()] == [(1, None, "", 0), (2, "u", "x, y.", 5)]
    assert html.extract(df.limit(0)).collect() == []


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            luhn = sum(sum(divmod(int(d) * (1 + k % 2), 10)) for k, d in enumerate(reversed(digits))) % 10 == 0
            if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 13 <= len(digits) <= 19 and luhn, "phone": 9 <= len(digits) <= 15}[kind]:
                out.append((kind, *m.span()))
    return out


def test_personal_data_base(docs, empty):
    rng = random.Random(5)
    for _ in range(20_000):
        t = "".join(rng.choice("a.@-_1 +(0é2)5 9") for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(t) == plain_spans(t), t
    t = "ü 4539 1488 0343 6467 x a.b@c.de 10.0.0.256 10.0.0.1 +1 (555) 123-4567."
    assert [k for k, *_ in pii.base_spans(t)] == ["email", "ip", "card", "phone"]
    assert pii.masked(t, pii.base_spans(t)) == "ü <card> x <email> 10.0.0.256 <ip> <phone>."
    rows = pii.find(docs, []).collect()
    assert len(rows) == docs.count() and all(r.base_sha256 == hashlib.sha256(b"").hexdigest() for r in rows)
    assert pii.patterns_of(empty) == [] and pii.find(empty, []).collect() == []
    assert pii.redacted(docs, []).columns == docs.columns


def test_personal_data_bootstrap(spark):
    cards = [c for c in (f"{n:016d}" for n in range(4539148803436400, 4539148803439400)) if pii._luhn(c)][:60]
    texts = [f"some words and account number {c} in a text" for c in cards] + ["another account number 4539148803436468 here", "page 12 of 30 and version 4539148803436468"]
    found = pii.patterns_of(spark.createDataFrame([(t,) for t in texts], "text string"))
    assert "number _ 9" in found
    assert [k for k, *_ in pii.spans(texts[-2], set(found))] == ["context"] and pii.spans(texts[-1], set(found)) == []


def test_personal_data_of_any_number_of_patterns(spark):
    """A pattern of nine seeds that discovers something, behind 20,100 patterns of ten that do not."""
    word = lambda k: "".join("abcdefghij"[int(d)] for d in f"{k:05d}")
    rows = [(k, " ".join(f"{word(k)} 10.{k >> 8}.{k & 255}.{j}" for j in range(10)), "x") for k in range(20_100)]
    rows += [(30_000 + j, f"lodger 11.0.0.{j} .", "x") for j in range(9)] + [(40_000, "lodger 11.0.0.999 .", "x"), (40_000, "lodger 11.0.0.999 .", "x"), (None, None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    trusted = pii.pattern_table(df)
    assert "lodger _ 9.9.9.9" in [r.pattern for r in trusted.collect()] and trusted.count() < 100
    got = [(r.doc_id, r.n_context, r.spans) for r in pii.find(df, trusted).filter("n_context > 0 or doc_id is null").collect()]
    assert sorted(got, key=str) == [(40_000, 1, "context:7:17")] * 2 + [(None, 0, "")]
    out = pii.redacted(df, trusted)
    assert out.columns == df.columns and [r.text for r in out.filter("doc_id = 40000").collect()] == ["lodger <context> ."] * 2 and out.count() == len(rows)


def test_personal_data_of_several_tokens(spark):
    """Phones and cards that the detectors miss, by trusted words before or after and whatever way they are written."""
    rng = random.Random(9)
    cards = [c for c in (f"{n:016d}" for n in range(4539148803436400, 4539148803439400)) if pii._luhn(c)][:60]
    texts = [f"{prose(rng, 8)} phone +1 ({k + 100}) 555-{k + 7000} {prose(rng, 5)}" for k in range(60)]
    texts += [f"{prose(rng, 8)} paid with {c} {prose(rng, 5)}" for c in cards]
    texts += [f"{prose(rng, 8)} +1 ({k + 300}) 555-{k + 7000} is mine {prose(rng, 5)}" for k in range(60)]
    planted = {"my phone (017) 555-7713 rings": "(017) 555-7713", "her phone 017 555 7713, 12 times": "017 555 7713", "we paid with 4539 1488 0343 6468 then": "4539 1488 0343 6468",
               "so 017 555 7714 is mine": "017 555 7714", "page 12 of 30 and 4539 1488 0343 6468 units": None, "a phone 12 years old": None}
    df = spark.createDataFrame([(k, t) for k, t in enumerate([*texts, *planted])], "doc_id long, text string").repartition(3)
    trusted = pii.pattern_table(df)
    listed = {r.pattern for r in trusted.collect()}
    masked = {r.doc_id: r.text for r in pii.redacted(df, trusted).collect()}
    found = {r.doc_id: r.spans for r in pii.find(df, trusted).collect()}
    for k, (text, surface) in enumerate(planted.items(), len(texts)):
        assert masked[k] == (text.replace(surface, "<context>") if surface else text)
        assert found[k] == pii.written(pii.spans(text, listed))


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_cached_tokens_equal_the_tokenizer(name, monkeypatch, docs):
    monkeypatch.setattr(tokens, "_MOST", 50)
    monkeypatch.setattr(tokens, "_CHARS", 400)
    encoder = tokens.Encoder(public_tokenizers.path(name))
    rng = random.Random(11)
    texts = [r.text or "" for r in docs.collect()]
    texts += ["".join(rng.choice(["a", "B", " ", "  ", "\n", "\t", "é", "1", "'s", ".", "!", " ", "\x1c", "語", "<|endoftext|>", "word", "İ", "é"]) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_added_tokens_in_texts(name):
    texts = ["a <|endoftext|> b", "plain", "x<|endoftext|>y", "", "<|startoftext|>\n", "<|ENDOFTEXT|> z", "<|endoftext|", "two <|endoftext|><|endoftext|>"]
    for text, ids in zip(texts, tokens.Encoder(public_tokenizers.path(name)).encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == plain_ids(name, text)[:-1], text


def test_addressable_codes():
    rng = np.random.default_rng(1)
    for n, top in [(0, 1), (1, 2**32), (511, 300), (512, 256), (513, 70_000), (5000, 50_257), (3000, 2**32)]:
        ids = rng.integers(0, top, n, dtype=np.uint32)
        codes = dac.Codes(dac.pack(ids))
        assert len(codes) == n and (codes.run(0, n) == ids).all()
        for _ in range(50 if n else 0):
            a, b = sorted(rng.integers(0, n + 1, 2))
            assert (codes.run(a, b) == ids[a:b]).all()
            at = int(rng.integers(0, n))
            assert codes[at] == ids[at]


def plain_ids(name, text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(name)).encode(text or "", add_special_tokens=False).ids + [2]


def test_token_files(spark, docs, empty, tmp_path, monkeypatch):
    monkeypatch.setattr(dac, "_SHARD_TOKENS", 500)
    name = "byte_bpe_50k.json"
    some = docs.filter("doc_id is not null").select("doc_id", "text").distinct()
    dac.write_tokens(some, str(tmp_path / "codes"), public_tokenizers.path(name))
    start = 0
    got = {r.doc_id: r for r in dac.read_tokens(spark, str(tmp_path / "codes")).collect()}
    for r in some.orderBy("doc_id").collect():
        ids = plain_ids(name, r.text)
        assert got[r.doc_id].start == start and np.frombuffer(got[r.doc_id].ids, "<u4").tolist() == ids
        start += len(ids)
    dac.write_tokens(empty, str(tmp_path / "none"), public_tokenizers.path(name))
    assert dac.read_tokens(spark, str(tmp_path / "none")).collect() == []


def test_packing(docs, empty):
    name = "word_bpe_49k.json"
    rows = packing.pack_documents(docs, public_tokenizers.path(name), window=64, most_open=5).collect()
    pieces, windows = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append((r.start, r.ids, r.doc_tokens))
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for w in windows.values():
        at = 0
        for offset, length in sorted(w):
            assert offset == at and length > 0
            at += length
        assert at <= 64 and at & (at - 1) == 0
    for d in docs.filter("doc_id is not null and doc_id <> 2").collect():
        own = sorted(pieces[d.doc_id])
        assert np.frombuffer(b"".join(i for _, i, _ in own), "<u4").tolist() == plain_ids(name, d.text) and {n for *_, n in own} == {len(plain_ids(name, d.text))}
    assert packing.pack_documents(empty, public_tokenizers.path(name)).collect() == []


def test_sum_of_squares_level():
    packer = packing.SumOfSquares(window=10)
    packer.counts[[3, 6]] = [4, 1]
    # 3 + 3 = 6: 3^2 + 2^2; 6 + 3 = 9: 4^2 + 0 + 1^2; new: 5^2 + 1
    assert packer._level(3) == 3


def test_mixing(spark, docs, empty):
    rows = mixing.balance(docs, group_rows=5).collect()
    assert len(rows) == docs.count()
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 2
    assert all(r.source_size == sizes[r.source] for r in rows)
    order = sorted(s for s in sizes if s is not None) + [None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    left, target, open_ = 1.5 * sum(sizes.values()), {}, set(order)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > 2 * sizes[s]}
        for s in full or open_:
            target[s] = 2 * sizes[s] if full else weight[s] * level
            left -= target[s]
        open_ -= full or set(open_)
    assert all(r.target == pytest.approx(target[r.source]) for r in rows)
    again = mixing.balance(docs.repartition(5), group_rows=5).collect()
    assert sorted((str(r.doc_id), r.size, r.taken) for r in rows) == sorted((str(r.doc_id), r.size, r.taken) for r in again)
    assert mixing.mixed(docs).columns == docs.columns
    assert mixing.balance(empty).collect() == [] and mixing.mixed(empty).collect() == []


def test_mixing_meets_targets(spark):
    rng = random.Random(4)
    rows = [(k, "w " * rng.choice([3, 20, 80, 300]), rng.choice("aabc")) for k in range(3000)]
    out = mixing.balance(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    for r in out.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect():
        assert r.taken == pytest.approx(r.target, rel=0.002)


def labelled(spark, rng):
    texts, labels = [], []
    for k in range(600):
        words = prose(rng, 60).split()
        if toxic := k % 4 == 0:
            for _ in range(3):
                words.insert(rng.randrange(60), rng.choice(["grumbel", "snarkoff", "vexigen", "vexitum"]))
        texts.append((k, " ".join(words), "en"))
        labels.append((k, int(toxic)))
    return spark.createDataFrame(texts, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_held_out(spark, docs, empty):
    texts, labels = labelled(spark, random.Random(6))
    grammar = toxicity.learn(texts, labels)
    rows = toxicity.score_texts(texts, grammar).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all((zlib.crc32(str(r.doc_id).encode()) % 4 == 2) == r.held_out for r in rows)
    assert sum(r.predicted == r.toxic for r in held) / len(held) > 0.97
    scored = toxicity.score_texts(docs, grammar).collect()
    assert len(scored) == docs.count() and all(0 <= r.score <= 1 for r in scored)
    blank = toxicity.learn(texts, labels.filter("toxic > 5"))
    assert blank.words == {} and toxicity.score_texts(empty, blank).collect() == []


def test_grammar_patterns():
    grammar = toxicity.Grammar({"oaf": 1.0}, {"dolt": 0.9})
    matches = toxicity.Scorer(grammar).matches
    assert matches("You oaf. He is not an oaf! They said oaf; doltish oaf") == [("targeted", 1.0), ("negated", 1.0), ("reported", 1.0), ("plain", 0.9), ("plain", 1.0)]
    assert matches("I will kill it. Will they kill time?")[0] == ("plain", toxicity.THREAT_PRECISION)
    assert matches(None) == matches("kill") == []


def test_snapshot_collapse(spark):
    def conv(key, *turns):
        return [(key, k * 300, "user" if k % 2 == 0 else "assistant", t, "x") for k, t in enumerate(turns)]

    rows = conv(1, "a", "b") + conv(2, "a", "b", "c", "d") + conv(3, "a") + conv(4, "a", "x") + conv(5, "a", "x") + conv(6, "b") + conv(7, None, "q") + conv(8, "", "q") + conv(None, "n")
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, line string").repartition(3)
    got = {r.conv_id: (r.n_turns, r.text) for r in chat.rendered(df).collect()}
    assert set(got) == {2, 4, 6, 7, 8}
    assert got[4] == (2, "<|user|>\na\n<|assistant|>\nx\n") and got[7] == got[8]
    assert chat.rendered(df.limit(0)).collect() == []


def test_exact_search(spark, monkeypatch):
    monkeypatch.setattr(topk, "CHUNK_ROWS", 40)
    monkeypatch.setattr(topk, "QUERY_ROWS", 3)
    monkeypatch.setattr(topk, "SAMPLE_ROWS", 12)
    rng = np.random.default_rng(3)
    rows = [(k, [float(x) for x in rng.normal(size=6).round(1)]) for k in range(300)] + [(k, [0.5] * 6) for k in range(300, 330)]
    odd = [(400, None), (401, []), (402, [1.0, None]), (403, [float("nan")] * 6), (404, [1.0, 2.0]), (450, [2.0, 1.0]), (None, [1.0] * 6)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.top_k(df, df.filter("vec_id % 50 = 0")).collect()}
    whole = {k: np.floor(256 * np.float32(v).astype(np.float64)).astype(np.int64) for k, v in rows + [(404, [1.0, 2.0]), (450, [2.0, 1.0])]}
    want = {}
    for q in [k for k in whole if k % 50 == 0]:
        scores = sorted((-int(whole[q] @ v), k) for k, v in whole.items() if k != q and len(v) == len(whole[q]))
        want |= {(q, n + 1): (k, -s) for n, (s, k) in enumerate(scores[:5])}
    assert got == want
    assert topk.top_k(df.limit(0), df).collect() == []


