"""Exact search over several chunks of vectors and groups of queries, held against all inner products."""

import numpy as np
import pytest

from telescry.llm import topk

SCHEMA = "vec_id long, embedding array<float>"


@pytest.fixture
def small_chunks(spark, monkeypatch):
    """Several chunks and groups, each dealt to a task of its own as on a cluster, instead of all tasks merged into one."""
    monkeypatch.setattr(topk, "CHUNK_ROWS", 40)
    monkeypatch.setattr(topk, "QUERY_ROWS", 3)
    monkeypatch.setattr(topk, "SAMPLE_ROWS", 12)
    held = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "31"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def best(rows, k=5):
    """(query, rank, vector, score) of every row whose id is divisible by 50, by all products with the rows of other ids."""
    whole = [(key, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for key, v in rows]
    scores = {}
    for q, query in whole:
        if q % 50 == 0:
            scores.setdefault(q, []).extend((-sum(a * b for a, b in zip(query, v, strict=True)), key) for key, v in whole if key != q)
    return sorted((q, place, key, -s) for q, pairs in scores.items() for place, (s, key) in enumerate(sorted(pairs)[:k], 1))


def found(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(r) for r in topk.top_k(df, df.filter("vec_id % 50 = 0")).collect())


def vectors(ids):
    rng = np.random.default_rng(5)
    return [(k, [float(x) for x in rng.normal(size=6).round(1)]) for k in ids]


def test_chunks_meet_their_queries_in_separate_tasks(spark, small_chunks):
    rows = vectors(range(-100, 400))
    assert found(spark, rows) == best(rows)


def test_queries_that_repeat_an_id_share_a_ranking(spark, small_chunks):
    rows = vectors([*range(150), *range(150), 50, 50, 100])
    assert found(spark, rows) == best(rows)


def test_scores_are_exact_at_any_size_of_components(spark, small_chunks):
    rows = [(k, [abs(x) for x in v]) for k, v in vectors(range(200))]
    rows += [(201, [-1e16] * 6), (202, [-1e30] * 6), (203, [3e12, 0.0, 0.0, 0.0, 0.0, 0.0]), (250, [0.0, 0.0, 0.0, 0.0, 0.0, 1e13])]
    assert found(spark, rows) == best(rows)
