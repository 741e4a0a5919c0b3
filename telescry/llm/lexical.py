"""Ranked lexical search, term-at-a-time for short lists and document-at-a-time for long ones.

**Index.**  One pass over the documents keeps, for the terms that any item asks for, the postings (place, frequency) of shards
of bounded size: documents in the order of a task's input, at most ``SHARD_DOCS`` of them or ``SHARD_POSTINGS`` postings.
Shards are rows of a Parquet table with their posting lists side by side; statistics (documents, terms, document
frequencies) are sums over its narrow columns.

**Search.**  For each shard and item, the shortest lists are added up term-at-a-time into one accumulator list, sorted by
place, as long as together they hold at most ``SHORT_SHARE`` of the shard's documents.  The accumulators then act as one more iterator
with a bound (their largest sum) beside the long lists.  Document-at-a-time, the weakest iterators, whose bounds together stay below
the item's k-th best score, bring up no candidates of their own.  Those come from the other iterators, in windows of places that double; a
candidate is skipped where what it has plus the bounds of the iterators still to probe stays below the k-th best, and else leaps to its
place in the next one.  The k-th best score of an item is carried from shard to shard within a task.  Each task
gives its ``k`` best rows of an item; those are ranked in two steps, so that no item's rows meet in one task unreduced.

Items are taken in blocks of about ``BLOCK_TERMS`` terms, so what a task is sent about them has a bound; each block is one pass.

Defined cases: a null or empty text has no terms and is no document of the statistics; items without terms give no rows; the rows
of an item that repeats its item_id are one item with the terms of its different texts; rows that repeat a doc_id are documents of their own;
documents without doc_id come after others of the same score; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from telescry.llm.common import stage_table

SHARD_DOCS, SHARD_POSTINGS, BLOCK_TERMS = 32_768, 1_000_000, 200_000
SHORT_SHARE, WINDOW = 0.125, 1024
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERM = re.compile(TERM)
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text: str | None) -> list[str]:
    """The terms of a text, in order; only A-Z are lower-cased."""
    return _TERM.findall(text.translate(_LOWER)) if text else []


@dataclass
class Shard:
    """Postings of one shard: those of term t at starts[t]:starts[t + 1], in ascending place; contributions are weight-free."""

    terms: np.ndarray  # ascending numbers of the terms that occur
    starts: np.ndarray
    places: np.ndarray
    parts: np.ndarray  # what one occurrence of the term in an item adds, before its weight
    docs: int

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray] | None:
        at = int(np.searchsorted(self.terms, term))
        if at == len(self.terms) or self.terms[at] != term:
            return None
        span = slice(self.starts[at], self.starts[at + 1])
        return self.places[span], self.parts[span]


class Best:
    """The k best (score, order) of an item so far; ``floor`` is what a further row must reach."""

    def __init__(self, k: int):
        self.k, self.rows, self.floor = k, [], 1

    def add(self, rows: list[tuple]) -> None:
        """Rows are (-score, doc_id is null, doc_id or 0)."""
        self.rows = sorted(self.rows + rows)[: self.k]
        if len(self.rows) == self.k:
            self.floor = max(self.floor, -self.rows[-1][0])


def accumulate(lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Term-at-a-time: the places of all lists in ascending order, each with its sum."""
    places = np.concatenate([p for p, _ in lists]) if lists else np.zeros(0, np.int64)
    sums = np.concatenate([s for _, s in lists]) if lists else np.zeros(0, np.int64)
    if not len(places):
        return places, sums
    order = np.argsort(places, kind="stable")
    places, sums = places[order], sums[order]
    first = np.flatnonzero(np.r_[True, places[1:] != places[:-1]])
    return places[first], np.add.reduceat(sums, first)


def _leap(places: np.ndarray, scores: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The scores of the wanted places in a list, 0 where it has none."""
    at = np.searchsorted(places, wanted)
    at[at == len(places)] = 0
    return np.where(places[at] == wanted, scores[at], 0) if len(places) else np.zeros(len(wanted), np.int64)


def search_shard(shard: Shard, item: list[tuple[int, int]], best: Best, keys, stats: dict | None = None) -> None:
    """Offer the documents of a shard to an item of (term, weight times its repeats)."""
    lists = [(found[0], found[1] * weight) for term, weight in item if weight and (found := shard.postings(term))]
    lists.sort(key=lambda x: len(x[0]))
    room, short = shard.docs * SHORT_SHARE, 0
    while short < len(lists) and len(lists[short][0]) <= room:
        room -= len(lists[short][0])
        short += 1
    merged = lists[short:] + ([accumulate(lists[:short])] if short else [])
    iterators = sorted(((int(s.max()), p, s) for p, s in merged), key=lambda x: x[0])
    bounds = np.cumsum([0] + [b for b, _, _ in iterators])  # bounds[i]: all that a document can get from the i weakest
    if stats is not None:
        stats["postings"] = stats.get("postings", 0) + sum(len(p) for p, _ in lists)
    low, width = 0, WINDOW
    while low < shard.docs:
        # a document that only the weakest iterators have stays below the floor: those are probed and bring up no candidates
        probed = int(np.searchsorted(bounds, best.floor, side="left")) - 1
        if probed == len(iterators):
            return
        cut = [(p[a:b], s[a:b]) for _, p, s in iterators[probed:] for a, b in [np.searchsorted(p, (low, low + width))]]
        places, scores = accumulate(cut)
        low, width = low + width, 2 * width
        if stats is not None:
            stats["candidates"] = stats.get("candidates", 0) + len(places)
        for k in range(probed - 1, -1, -1):
            alive = scores + bounds[k + 1] >= best.floor
            places, scores = places[alive], scores[alive]
            if not len(places):
                break
            scores = scores + _leap(iterators[k][1], iterators[k][2], places)
        hits = np.flatnonzero(scores >= best.floor)
        if len(hits) > best.k:  # only the best k scores can stay, with all rows of the last of them
            hits = hits[scores[hits] >= np.partition(scores[hits], len(hits) - best.k)[len(hits) - best.k]]
        if len(hits):
            best.add([(-int(scores[h]), keys[places[h]] is None, keys[places[h]] or 0) for h in hits])


def _binary(a: np.ndarray, kind: str) -> bytes:
    return a.astype(kind).tobytes()


def index_shards(docs: DataFrame, vocabulary: dict[str, int]) -> DataFrame:
    """One row per shard: doc_id array, binary lengths, terms, starts, places, frequencies, and its counts."""
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType([
        T.StructField("docs", T.LongType()), T.StructField("words", T.LongType()), T.StructField("doc_id", T.ArrayType(kind)), T.StructField("lengths", T.BinaryType()),
        T.StructField("term", T.ArrayType(T.IntegerType())), T.StructField("df", T.ArrayType(T.IntegerType())), T.StructField("places", T.BinaryType()), T.StructField("times", T.BinaryType()),
    ])
    arrow = to_arrow_schema(schema)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # the terms of one block of items

    def run(batches):
        number = shared.value.get
        keys, lengths, terms, places, times = [], [], [], [], []

        def flush():
            term, place, time = np.array(terms, np.int64), np.array(places, np.int64), np.array(times, np.int64)
            order = np.argsort(term, kind="stable")
            names, df = np.unique(term, return_counts=True)
            row = (len(keys), sum(lengths), keys, _binary(np.array(lengths, np.int64), "<i8"), names, df, _binary(place[order], "<i4"), _binary(time[order], "<i4"))
            return pa.RecordBatch.from_arrays([pa.array([x], type=f.type) for x, f in zip(row, arrow, strict=True)], schema=arrow)

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = terms_of(text)
                if not found:
                    continue
                counts: dict[int, int] = {}
                for t in map(number, found):
                    if t is not None:
                        counts[t] = counts.get(t, 0) + 1
                terms += counts
                times += counts.values()
                places += [len(keys)] * len(counts)
                keys.append(key)
                lengths.append(len(found))
                if len(keys) >= SHARD_DOCS or len(terms) >= SHARD_POSTINGS:
                    yield flush()
                    keys, lengths, terms, places, times = [], [], [], [], []
        if keys:
            yield flush()

    return docs.select("doc_id", "text").filter("text is not null").mapInArrow(run, schema)


def _shard(docs: int, words: int, row: dict) -> Shard:
    """A row of the index with the parts of the score that do not depend on an item."""
    df, lengths = np.array(row["df"], np.int64), np.frombuffer(row["lengths"], "<i8")
    places, times = np.frombuffer(row["places"], "<i4").astype(np.int64), np.frombuffer(row["times"], "<i4").astype(np.int64)
    m = 100 - 75 + (75 * lengths * docs) // words
    parts = (1_000_000_000 * times) // (1000 * times + 8 * m[places])
    return Shard(np.array(row["term"], np.int64), np.r_[0, np.cumsum(df)], places, parts, len(lengths))


def _rank_block(docs: DataFrame, items: list[tuple[object, list[str]]], kind: T.DataType, k: int) -> DataFrame:
    """item_id, doc_id, score: the ``k`` best rows of every task for each of a block of items."""
    names = sorted({t for _, terms in items for t in terms})
    numbers = {t: i for i, t in enumerate(names)}
    index = stage_table(index_shards(docs, numbers), "lexical-index")
    totals = index.agg(F.sum("docs").alias("docs"), F.sum("words").alias("words")).first()
    n, words = int(totals["docs"] or 0), int(totals["words"] or 0)
    pairs = index.select(F.explode(F.arrays_zip("term", "df")).alias("x")).groupBy("x.term").agg(F.sum("x.df").alias("df"))
    weights = {r.term: math.floor(1000 * math.log((2 * n + 2) / (2 * r.df + 1))) for r in pairs.collect()}  # one row per term of the block
    asked = []
    for item_id, terms in items:
        repeats: dict[int, int] = {}
        for t in terms:
            repeats[numbers[t]] = repeats.get(numbers[t], 0) + 1
        asked.append((item_id, [(t, weights.get(t, 0) * r) for t, r in repeats.items()]))
    schema = T.StructType([T.StructField("item_id", kind), docs.schema["doc_id"], T.StructField("score", T.LongType()), T.StructField("part", T.IntegerType())])
    arrow = to_arrow_schema(schema)
    shared = docs.sparkSession.sparkContext.broadcast(asked)

    def run(batches):
        best = [Best(k) for _ in shared.value]
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                shard = _shard(n, words, row)
                for (_, item), own in zip(shared.value, best, strict=True):
                    search_shard(shard, item, own, row["doc_id"])
        part = TaskContext.get().partitionId()
        out = [(item_id, None if null else key, -score, part) for (item_id, _), own in zip(shared.value, best, strict=True) for score, null, key in own.rows]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out, strict=True), arrow, strict=True)], schema=arrow)

    return index.select("doc_id", "lengths", "term", "df", "places", "times").mapInArrow(run, schema)


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: each item's ``k`` best documents with a score above 0, ties to the smaller doc_id."""
    spark, kind = docs.sparkSession, items.schema["item_id"].dataType
    texts = items.select("item_id", "text").filter("text is not null").distinct()
    sized = texts.withColumn("terms", F.size(F.regexp_extract_all("text", F.lit(TERM), F.lit(0)))).filter("terms > 0")
    blocks = -(-int(sized.agg(F.sum("terms")).first()[0] or 0) // block_terms)
    found = spark.createDataFrame([], T.StructType([T.StructField("item_id", kind), docs.schema["doc_id"], T.StructField("score", T.LongType()), T.StructField("part", T.IntegerType())]))
    for block in range(blocks):
        # about ``block_terms`` terms: the hash spreads items evenly
        rows = sized.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).groupBy("item_id").agg(F.array_sort(F.collect_list("text")).alias("texts")).collect()
        if rows:
            asked = [(r.item_id, [t for text in r.texts for t in terms_of(text)]) for r in rows]
            found = found.unionByName(stage_table(_rank_block(docs, asked, kind, k), "lexical-best"))
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    first = F.row_number().over(W.partitionBy("item_id", F.col("part").bitwiseAND(F.lit(63))).orderBy(*order))
    last = F.row_number().over(W.partitionBy("item_id").orderBy(*order))
    few = found.withColumn("place", first).filter(F.col("place") <= k)
    return few.withColumn("rank", last).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
