"""Exact top-k search by block-at-a-time pruning.

Vectors are turned into whole numbers, so that scores are exact.  Each chunk of vectors is laid out along pivots of its own,
in document ranges (blocks) that keep every dimension's largest and smallest value.  For a query, the sum over the dimensions
of its best product with a block bounds every score in the block.  Blocks are taken by falling bound, in runs that double,
and scored through their rows until the bound is below the k-th best score; that starts at the k-th best score in a fixed sample of all
vectors, which is a lower bound of the final one.  Chunks and groups of queries have bounded sizes, so more machines
always help; the best rows of the chunks are merged at the end.

Defined cases: vectors that are null, empty or hold null, NaN or infinite components take no part; vectors of other dimensions than
the query's are no candidates; rows that repeat a vec_id are candidates of their own, except for queries with that vec_id, and
queries that repeat one share a ranking of all their scores; an empty table gives no rows; other columns are not read.
Components of any finite size are exact; a score among the best of a chunk that 64 bits cannot hold is an error.
"""

from __future__ import annotations

from itertools import groupby, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql import types as T

from telescry.llm.common import map_rows, stage_table

CHUNK_ROWS, QUERY_ROWS, SAMPLE_ROWS, BLOCK_ROWS, RUN_BLOCKS, PIVOTS = 8192, 8192, 2048, 32, 8, 128
_EXACT, _LONG = 2.0**53, 2.0**62
_OUT = "query_id long, vec_id long, score long"


def whole_numbers(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, size and vec (little-endian doubles: floors of the scaled components) of the vectors that take part."""

    def rows(batch):
        keys, sizes, out = [], [], []
        for key, vector in zip(batch["vec_id"], batch["embedding"], strict=True):
            if key is None or not vector or any(x is None for x in vector):
                continue
            floors = np.floor(np.asarray(vector, np.float64) * scale)
            if np.isfinite(floors).all():
                keys.append(key)
                sizes.append(len(floors))
                out.append(floors.astype("<f8").tobytes())
        yield {"vec_id": keys, "size": sizes, "vec": out}

    return map_rows(vectors.select("vec_id", "embedding"), "vec_id long, size int, vec binary", rows)


def _matrix(column, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<f8").reshape(-1, size)


def _exact(*sides: np.ndarray) -> list[np.ndarray]:
    """Both sides as doubles where every sum of products is exact in them, else as 64-bit integers or as integers of any size."""
    a, b = (float(np.abs(x).max(initial=0)) for x in sides)
    top = a * b * sides[0].shape[1]
    if top < _EXACT:
        return list(sides)
    return [x.astype(np.int64) if top < _LONG else np.vectorize(int, otypes=[object])(x) for x in sides]


def _huge(rows: np.ndarray) -> np.ndarray:
    """Whether a row's products with rows of its kind can exceed 64 bits."""
    return np.abs(rows).max(axis=1, initial=0) >= (_LONG / rows.shape[1]) ** 0.5


def search_chunk(query_ids, queries, floors, ids, vectors, k: int) -> list[tuple[int, int, int]]:
    """(query, vector, score) of the best ``k`` rows of one chunk for each query, as far as they reach the query's floor."""
    queries, vectors = _exact(queries, vectors)
    pivots = vectors[np.linspace(0, len(vectors) - 1, min(PIVOTS, len(vectors))).astype(int)]
    order = np.lexsort((ids, (vectors @ pivots.T).argmax(axis=1)))
    ids, vectors = ids[order], vectors[order]
    starts = np.arange(0, len(ids), BLOCK_ROWS)
    high, low = np.maximum.reduceat(vectors, starts), np.minimum.reduceat(vectors, starts)
    bounds = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
    out = []
    for q, query, floor, bound in zip(query_ids, queries, floors, bounds, strict=True):
        best: list[tuple[int, int]] = []  # (-score, id), ascending
        last = -np.inf if floor is None else floor
        blocks, run = np.argsort(-bound, kind="stable"), RUN_BLOCKS
        while len(blocks) and bound[blocks[0]] >= last:
            taken, blocks, run = blocks[:run], blocks[run:], 2 * run
            at = (starts[taken[bound[taken] >= last], None] + np.arange(BLOCK_ROWS)).ravel()
            at = at[at < len(ids)]
            scores = vectors[at] @ query
            hits = np.flatnonzero((scores >= last) & (ids[at] != q))
            if len(hits):
                best = sorted(best + [(-int(scores[h]), int(ids[at[h]])) for h in hits])[:k]
                if len(best) == k:
                    last = max(last, -best[-1][0])
        out += [(int(q), v, -s) for s, v in best]
    return out


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` best vectors by inner product, ties to the smaller vec_id."""
    spark = vectors.sparkSession
    found = stage_table(whole_numbers(vectors, scale), "vectors")
    asked = whole_numbers(queries, scale)
    sample = found.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).collect()  # a fixed number of vectors
    by_size: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for size in {r["size"] for r in sample}:
        own = [r for r in sample if r["size"] == size]
        sampled = _matrix([bytes(r.vec) for r in own], size)
        by_size[size] = (np.array([r.vec_id for r in own])[~_huge(sampled)], sampled[~_huge(sampled)])
    shared = spark.sparkContext.broadcast(by_size)

    def floors(batch):
        out = []
        for key, size, vec in zip(batch["vec_id"], batch["size"], batch["vec"], strict=True):
            ids, rows = shared.value.get(size, (np.zeros(0, np.int64), np.zeros((0, size))))
            query = _matrix([vec], size)
            if np.count_nonzero(ids != key) < k or _huge(query).any():
                out.append(None)
                continue
            query, rows = _exact(query, rows)
            out.append(int(np.sort((rows @ query[0])[ids != key])[-k]))
        yield batch | {"floor": out}

    asked = stage_table(map_rows(asked, "vec_id long, size int, vec binary, floor long", floors), "queries")
    chunks, groups = -(-found.count() // CHUNK_ROWS), -(-asked.count() // QUERY_ROWS)
    if not chunks or not groups:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    # cogroup does not bring its keys to one type, and equal numbers of different types are dealt to different tasks
    rows = found.withColumn("chunk", F.pmod(F.xxhash64("vec_id", "vec"), F.lit(chunks)).cast("int")).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    sent = asked.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int")).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    arrow = to_arrow_schema(T._parse_datatype_string(_OUT))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            size = left["size"][0].as_py()
            query_ids, queries, floors = left["vec_id"].to_numpy(), _matrix(left["vec"].to_pylist(), size), np.array(left["floor"].to_pylist(), object)
            ids, vectors = right["vec_id"].to_numpy(), _matrix(right["vec"].to_pylist(), size)
            # rows with huge components are searched apart, so that the others keep machine numbers
            for q in (_huge(queries), ~_huge(queries)):
                for v in (_huge(vectors), ~_huge(vectors)):
                    if q.any() and v.any():
                        out += search_chunk(query_ids[q], queries[q], floors[q], ids[v], vectors[v], k)
            out.sort(key=lambda hit: (hit[0], -hit[2], hit[1]))
            out = [hit for _, hits in groupby(out, key=lambda hit: hit[0]) for hit in islice(hits, k)]
        return pa.table([pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else ([], [], []))], schema=arrow)

    pairs = sent.groupBy("chunk", "part", "size").cogroup(rows.select("chunk", "part", "size", "vec_id", "vec").groupBy("chunk", "part", "size")).applyInArrow(search, _OUT)
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
