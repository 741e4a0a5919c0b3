"""Each stage of the corpus job against plain Python on the rows that its predecessor kept."""

import random
import re
from collections import Counter, defaultdict

import pytest
from test_llm_operators import components, near, prose

import corpus_pipeline as job

public_tokenizers = pytest.importorskip("public_tokenizers")

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def repeated(found):
    windows = [tuple(found[k : k + 3]) for k in range(len(found) - 2)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    return len({k + i for k, w in enumerate(windows) if w in often for i in range(3)})


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows of each stage, by name, and those of run()."""
    rng = random.Random(21)
    line = lambda n: prose(rng, n).capitalize() + "."
    text = lambda: "\n".join(line(rng.randint(8, 20)) for _ in range(rng.randint(6, 14)))
    base = [text() for _ in range(24)]
    texts = base + [base[0], base[1], near(rng, base[2], 1), near(rng, near(rng, base[2], 1), 1)]
    texts += [b + f"\nMail {prose(rng, 1)}{k}@mail.example.org about it, and nothing else but that." for k, b in enumerate(text() for _ in range(4))]
    texts += [None, "", "Too short.", "so it goes " * 60, "\n".join(["Home | News | Shop | Cart | Help"] * 30)]
    rows = [(k, t, "en", [f"s{k % 3}", None][k % 7 == 3], len(t or "")) for k, t in enumerate(texts)]
    folder = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), {"documents": rows}
    for name, stage in job.STAGES:
        docs = job.stage_table(stage(spark, docs, folder), name)
        out[name] = docs.collect()
    return out, job.run(spark, folder).collect()


def test_quality_rules(stages):
    rows, _ = stages
    before = {r[0]: r[1] for r in rows["documents"]}
    kept = {r.doc_id: r for r in rows["quality_rules"]}
    for key, text in before.items():
        found = words(text)
        if len(found) < 50 or 100 * repeated(found) > 50 * len(found):
            assert key not in kept
    assert set(range(32)) <= set(kept)  # prose stays, and as it was
    assert all(kept[k].text == before[k] and kept[k].n_chars == len(before[k]) for k in range(24))


def test_near_duplicates(stages):
    rows, _ = stages
    before = {r.doc_id: r for r in rows["quality_rules"]}
    want = components(list(before), [r.text for r in before.values()], 5, 80)
    assert sorted(tuple(r) for r in rows["near_duplicates"]) == sorted(tuple(before[k]) for k in {c for _, c in want.values()})
    assert len(rows["near_duplicates"]) < len(before)


def test_personal_data(stages):
    rows, _ = stages
    before, after = ({r.doc_id: r.text for r in rows[n]} for n in ("near_duplicates", "personal_data"))
    assert after == {k: EMAIL.sub("<email>", t) for k, t in before.items()}
    assert sum("<email>" in t for t in after.values()) == 4


def test_mix_sources(stages):
    rows, _ = stages
    before = {r.doc_id: r for r in rows["personal_data"]}
    taken = Counter(r.doc_id for r in rows["mix_sources"])
    assert all(tuple(r) == tuple(before[r.doc_id]) for r in rows["mix_sources"]) and max(taken.values()) <= 2
    size, total = defaultdict(int), defaultdict(int)
    for k, r in before.items():
        n = len(words(r.text))
        size[r.source] += n
        total[r.source] += n * taken[k]
    names = sorted(size, key=lambda s: (s is None, s or ""))
    share, weights, targets = 1.5 * sum(size.values()), {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}, {}
    while True:  # sources that pass twice their size get that, the others share the rest
        rest = [s for s in names if s not in targets]
        level = (share - sum(targets.values())) / sum(weights[s] for s in rest) if rest else 0
        over = [s for s in rest if weights[s] * level > 2 * size[s]]
        if not over:
            break
        targets |= {s: 2 * size[s] for s in over}
    targets |= {s: weights[s] * level for s in rest}
    longest = max(len(words(r.text)) for r in before.values())
    assert all(abs(total[s] - targets[s]) <= longest for s in names)


def test_pack_windows(stages):
    from tokenizers import Tokenizer

    rows, whole = stages
    encode = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode
    wanted = Counter()
    for r in rows["mix_sources"]:
        ids = [*encode(r.text or "", add_special_tokens=False).ids, 2]
        wanted.update((r.doc_id, k, x) for k, x in enumerate(ids))
    for result in (rows["pack_windows"], whole):
        found, windows = Counter(), defaultdict(list)
        for r in result:
            ids = memoryview(bytes(r.ids)).cast("I")
            found.update((r.doc_id, r.start + k, x) for k, x in enumerate(ids))
            assert len(ids) == r.length
            windows[r.sequence_id].append((r.offset, r.length))
        assert found == wanted
        for pieces in windows.values():
            end = 0
            for offset, length in sorted(pieces):
                assert offset == end
                end += length
            assert end <= 4096


def test_columns_that_clash_with_inner_names(spark):
    """Names that the stages use inside come through as columns of the input; nulls, repeats and empty tables pass."""
    names = ["kept", "clean_text", "n_words", "copies", "_copies", "_row", "_copy", "_first", "_discovered", "_text_sha256", "rate", "size", "_doc_id", "component_id"]
    rng = random.Random(5)
    text = "\n".join(prose(rng, 15).capitalize() + "." for _ in range(8))
    rows = [(1, text, "en", "a", 3), (1, text, "en", "a", 3), (2, None, None, None, None), (None, text + " Write to me@mail.example.org.", "en", None, 5), (3, "", "en", "a", 0)]
    docs = spark.createDataFrame([(*r, *(f"{n}!" for n in names)) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in names))
    for name, stage in job.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns
        found = out.collect()
        assert found and all(r[n] == f"{n}!" for r in found for n in names), name
        assert stage(spark, docs.limit(0), "").count() == 0
    assert job.STAGES[-1][1](spark, docs, "").count() > 0
