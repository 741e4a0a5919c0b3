"""Similarity join on word shingles by parity sketches.

A document is its set of distinct shingles.  Two sets of Jaccard similarity t or more differ in at most
``(a + b) (1 - t) / (1 + t)`` shingles.  Each size band cuts the space of shingles into more parts than that, and the XOR of
the hashes that fall into a part is the part's parity sketch: by the pigeonhole principle linked documents agree in some
part.  A document may leave out as many parts as the band has in excess of its own bound; it leaves out those with the
fewest shingles (an order that depends on a part's content alone, so that what agrees is left out by both or by neither) and
sends the others as keys to one shuffle.

Documents that share a key are compared in rounds.  First each is verified against the smallest document of its keys.
Then, where a key still holds several components, its documents are compared across components by bit-parity sketches
whose Hamming distance never exceeds the true difference, keys with many documents in blocks; what passes is verified
on the whole sets, until nothing untested is left.  Exact copies are one set from the start.  No link between different
texts is lost and no key's pairs are written out.

Defined cases: texts that are null, empty or without words have no set and no links; texts shorter than a shingle are one
shingle; rows that share a doc_id are one node; a null doc_id links with nothing and has a null component; an empty table
gives no rows; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql import types as T

from telescry.llm.common import free_name, map_rows, stage_table, text_of
from telescry.llm.components import connected

_STEP, _EXCESS, _BLOCK, _SINGLE_ROUNDS = 1.5, 1.3, 2000, 2
_U = np.uint64


@dataclass(frozen=True)
class Likeness:
    """Links need ``percent`` * union <= 100 * intersection of shingles of ``width`` words."""

    width: int = 5
    percent: int = 80

    def most_difference(self, a: int, b: int) -> int:
        return (a + b) * (100 - self.percent) // (100 + self.percent)

    def largest(self, n: int) -> int:
        """The size of the largest set that a set of ``n`` may link with."""
        return n * 100 // self.percent

    def linked(self, a: int, b: int, common: int) -> bool:
        return 100 * common >= self.percent * (a + b - common)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; bytes.lower and bytes.split change A-Z and cut at ASCII white space only."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, _U)
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), _U, len(words))
    width = min(width, len(words))
    total = np.full(len(codes) - width + 1, width, _U)
    for k in range(width):
        total = total * _U(0x9E3779B97F4A7C15) + codes[k : len(codes) - width + 1 + k]
    return np.unique(_mixed(total))


@lru_cache
def _bands() -> list[int]:
    """The largest size of each band."""
    ends = [1]
    while ends[-1] < 1 << 40:
        ends.append(max(ends[-1] + 1, int(ends[-1] * _STEP)))
    return ends


def part_keys(own: np.ndarray, like: Likeness) -> np.ndarray:
    """The keys of a set: in its size band, and in the next one if that holds sizes it may link with."""
    n, ends, keys = len(own), _bands(), []
    home = bisect_left(ends, n)
    for band in (home, home + 1):
        if band > home and like.largest(n) <= ends[home]:
            break
        parts = int((like.most_difference(ends[band], ends[band]) + 1) * _EXCESS)
        send = like.most_difference(n, min(like.largest(n), ends[band])) + 1
        part = ((own >> _U(32)) * _U(parts)) >> _U(32)
        starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        count, sketch = np.zeros(parts, np.int64), np.zeros(parts, _U)
        at = part[starts].astype(np.int64)
        count[at] = np.diff(starts, append=n)
        sketch[at] = np.bitwise_xor.reduceat(own, starts)
        chosen = np.lexsort((np.arange(parts), count))[parts - send :]
        keys.append(_mixed(sketch[chosen] + _U(0x9E3779B97F4A7C15) * (chosen.astype(_U) + _U(1)) + _U(0xD1B54A32D192ED03) * (count[chosen].astype(_U) * _U(64) + _U(band))))
    return np.concatenate(keys)


def parity_bits(own: np.ndarray) -> bytes:
    """Bit sketch of the set: as many bits as shingles or up to twice as many, a power of two, each flipped by its shingles."""
    bits = max(64, 1 << (len(own) - 1).bit_length())
    return np.packbits((np.bincount((own & _U(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def _folded(sketch: bytes, size: int) -> np.ndarray:
    """The sketch as if made with fewer bits."""
    out = np.frombuffer(sketch, np.uint8)
    while len(out) > size:
        out = out[: len(out) // 2] ^ out[len(out) // 2 :]
    return out


def _keys(docs: DataFrame, like: Likeness) -> DataFrame:
    kind = docs.schema["doc_id"].dataType
    arrow = to_arrow_schema(T.StructType([T.StructField("key", T.LongType()), T.StructField("id", kind)]))

    def run(batches):
        met = set()  # of sets in this task, so that copies are sent once
        for batch in batches:
            rows = batch.to_pydict()
            held, keys, ids = 0, [], []
            for k, text in enumerate(rows["text"]):
                own = shingles(text, like.width)
                mark = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
                if len(own) and mark not in met and rows["doc_id"][k] is not None:
                    met.add(mark)
                    keys.append(part_keys(own, like))
                    ids.append(np.full(len(keys[-1]), k))
                    held += len(keys[-1])
                if keys and (held > 500_000 or k + 1 == len(rows["text"])):
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), batch.column(0).take(pa.array(np.concatenate(ids)))], schema=arrow)
                    held, keys, ids = 0, [], []
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), batch.column(0).take(pa.array(np.concatenate(ids)))], schema=arrow)

    return docs.select("doc_id", "text").mapInArrow(run, f"key long, id {kind.simpleString()}")


def _described(docs: DataFrame, like: Likeness) -> DataFrame:
    """doc_id, n, mark (a 128-bit hash of the set) and sketch of every document."""

    def rows(batch):
        sets = [shingles(x, like.width) for x in batch["text"]]
        yield {
            "doc_id": batch["doc_id"], "n": [len(s) for s in sets],
            "mark": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], "sketch": [parity_bits(s) if len(s) else None for s in sets],
        }

    return map_rows(docs.select("doc_id", "text"), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n long, mark binary, sketch binary", rows)


def _sets(docs: DataFrame, like: Likeness) -> DataFrame:
    def rows(batch):
        yield {"m": batch["doc_id"], "own": [shingles(x, like.width).tobytes() for x in batch["text"]]}

    return map_rows(docs.select("doc_id", "text"), f"m {docs.schema['doc_id'].dataType.simpleString()}, own binary", rows)


def _near(pairs: DataFrame, sets: DataFrame, like: Likeness) -> DataFrame:
    """The pairs (a, b) whose sizes and bit sketches allow a link."""
    kind = pairs.schema["a"].dataType.simpleString()
    half = sets.select(F.col("m"), "n", "sketch")
    joined = pairs.join(half.withColumnsRenamed({"m": "a", "n": "na", "sketch": "sa"}), "a").join(half.withColumnsRenamed({"m": "b", "n": "nb", "sketch": "sb"}), "b")

    def rows(batch):
        keep = []
        for k, (a, b, x, y) in enumerate(zip(batch["na"], batch["nb"], batch["sa"], batch["sb"], strict=True)):
            if max(a, b) <= like.largest(min(a, b)):
                size = min(len(x), len(y))
                if int(np.bitwise_count(_folded(x, size) ^ _folded(y, size)).sum()) <= like.most_difference(a, b):
                    keep.append(k)
        yield {c: [batch[c][k] for k in keep] for c in ("a", "b")}

    return map_rows(joined.select("a", "b", "na", "nb", "sa", "sb"), f"a {kind}, b {kind}", rows)


def _verified(pairs: DataFrame, sets: DataFrame, like: Likeness) -> DataFrame:
    """The pairs (a, b) that are links by their whole sets."""
    kind = pairs.schema["a"].dataType.simpleString()
    joined = pairs.join(sets.select(F.col("m").alias("a"), F.col("own").alias("x")), "a").join(sets.select(F.col("m").alias("b"), F.col("own").alias("y")), "b")

    def rows(batch):
        keep = []
        for k, (x, y) in enumerate(zip(batch["x"], batch["y"], strict=True)):
            x, y = np.frombuffer(x, _U), np.frombuffer(y, _U)
            if like.linked(len(x), len(y), len(np.intersect1d(x, y, assume_unique=True))):
                keep.append(k)
        yield {c: [batch[c][k] for k in keep] for c in ("a", "b")}

    return map_rows(joined.select("a", "b", "x", "y"), f"a {kind}, b {kind}", rows)


def _pairs_in_groups(group: np.ndarray, differ: np.ndarray, block: np.ndarray, n: np.ndarray, like: Likeness) -> tuple[np.ndarray, np.ndarray]:
    """Rows of one group, of different components and fitting sizes; of groups between two blocks, one row of each block.

    Rows are sorted by group, so that rows of a group stand at most the largest group's size apart.
    """
    left, right = [], []
    rows = np.arange(len(group))
    for apart in range(1, len(group)):
        rows = rows[: np.searchsorted(rows, len(group) - apart)]
        rows = rows[group[rows] == group[rows + apart]]
        if not len(rows):
            break
        other = rows + apart
        small, large = np.minimum(n[rows], n[other]), np.maximum(n[rows], n[other])
        good = (differ[rows] != differ[other]) & (large <= small * 100 // like.percent) & ((block[rows] < 0) | (block[rows] != block[other]))
        left.append(rows[good])
        right.append(other[good])
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *left]), np.concatenate([empty, *right])


def _apart(sketches: list[bytes], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hamming distances of the sketches of pairs of rows, each at the smaller one's bits."""
    sizes, out = np.array([len(s) for s in sketches]), np.zeros(len(left), np.int64)
    least = np.minimum(sizes[left], sizes[right])
    for size in np.unique(least):
        these = np.flatnonzero(least == size)
        used, place = np.unique(np.concatenate([left[these], right[these]]), return_inverse=True)
        bits = np.stack([_folded(sketches[k], size) for k in used]).view(np.uint64)
        for at in range(0, len(these), 20_000):
            part = slice(at, at + 20_000)
            x, y = bits[place[: len(these)][part]], bits[place[len(these) :][part]]
            out[these[part]] = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
    return out


def _across(members: DataFrame, like: Likeness) -> DataFrame:
    """Pairs (a, b, far) of different components that share a key and pass sizes and bit sketches.

    members: key, m, component, n, sketch of keys with several components.  A key with many documents is cut into
    blocks, and each pair of its blocks is a group of its own.
    """
    kind = members.schema["m"].dataType.simpleString()
    blocks = members.groupBy("key").agg(F.ceil(F.count("*") / _BLOCK).cast("int").alias("blocks"))
    placed = members.join(blocks, "key").withColumn("own", F.pmod(F.xxhash64("m"), F.col("blocks")).cast("int"))
    spread = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    i, j = F.least("own", "other"), F.greatest("own", "other")
    spread = spread.select(
        F.xxhash64("key", i, j).alias("part"), "key", i.alias("i"), j.alias("j"), F.when(i == j, -1).otherwise(F.col("own")).alias("block"), "m", F.xxhash64("component").alias("differ"), "n", "sketch")

    def compare(batches):
        held: pa.Table | None = None

        def found(rows: pa.Table) -> pa.RecordBatch:
            marks = np.stack([rows[c].to_numpy() for c in ("key", "i", "j")])
            group = np.concatenate([[0], np.cumsum((marks[:, 1:] != marks[:, :-1]).any(axis=0))])
            n = rows["n"].to_numpy()
            left, right = _pairs_in_groups(group, rows["differ"].to_numpy(), rows["block"].to_numpy(), n, like)
            far = _apart(rows["sketch"].to_pylist(), left, right)
            near = far <= (n[left] + n[right]) * (100 - like.percent) // (100 + like.percent)
            m = rows["m"].combine_chunks()
            return pa.RecordBatch.from_arrays([m.take(pa.array(left[near])), m.take(pa.array(right[near])), pa.array(far[near], pa.int64())], names=["a", "b", "far"])

        for batch in batches:  # the last group of a batch may go on in the next
            rows = pa.table(batch) if held is None else pa.concat_tables([held, pa.table(batch)])
            last = {c: rows[c][-1].as_py() for c in ("key", "i", "j")}
            ends = np.logical_and.reduce([rows[c].to_numpy() == last[c] for c in last])
            start = int(np.argmax(ends))
            if start:
                yield found(rows.slice(0, start))
            held = rows.slice(start)
        if held is not None:
            yield found(held)

    dealt = spread.repartition("part").sortWithinPartitions("key", "i", "j", "m").drop("part")
    found = dealt.mapInArrow(compare, f"a {kind}, b {kind}, far long")
    return found.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.min("far").alias("far"))


def similarity_components(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links, itself included) of every document."""
    described = stage_table(_described(docs, like), "shingle-sets")
    kind = docs.schema["doc_id"].dataType
    by_mark = described.filter("n > 0 and doc_id is not null").groupBy("mark").agg(F.min("doc_id").alias("m"))
    canon = stage_table(described.filter("n > 0 and doc_id is not null").select("doc_id", "mark").join(by_mark, "mark").select("doc_id", "m"), "set-members")
    # rows of copies that several tasks sent meet in one key, where they are one set again
    keys = _keys(docs, like)
    same = W.partitionBy("key")
    shared = keys.withColumn("low", F.min("id").over(same)).withColumn("high", F.max("id").over(same)).filter("low < high").select("key", "id")
    shared = stage_table(shared, "shared-keys")
    shared = shared.join(canon.withColumnRenamed("doc_id", "id").distinct(), "id").select("key", "m").distinct()
    several = shared.groupBy("key").agg(F.min("m").alias("low"), F.max("m").alias("high")).filter("low < high").select("key", "low")
    shared = stage_table(shared.join(several, "key"), "shared-sets")
    members = shared.select("m").distinct()
    sets = stage_table(described.join(members, described["doc_id"] == members["m"]).select("m", "n", "sketch").distinct(), "candidate-sketches")

    def whole(pairs: DataFrame) -> DataFrame:
        """The links among untested pairs, by sets made of the texts of their documents."""
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
        return stage_table(_verified(pairs, stage_table(_sets(docs.join(wanted, "doc_id", "left_semi"), like), "whole-sets"), like), "links")

    tested = stage_table(_near(shared.filter("m <> low").groupBy(F.col("m").alias("a")).agg(F.min("low").alias("b")), sets, like), "tested")
    links = whole(tested)
    stars, turn = connected(links), 0
    while True:
        stars = stage_table(stars, "components")
        placed = shared.select("key", "m").join(stars, shared["m"] == stars["node"], "left").select("key", "m", F.coalesce("component", "m").alias("component"))
        mixed = placed.groupBy("key").agg(F.min("component").alias("c"), F.max("component").alias("d")).filter("c < d").select("key")
        open_members = placed.join(mixed, "key").join(sets, "m")
        found = _across(open_members, like).join(tested.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")
        found = stage_table(found, "untested")
        if found.isEmpty():
            break
        turn += 1
        if turn <= _SINGLE_ROUNDS:  # the nearest one first: most others are then in its component
            found = found.groupBy("a").agg(F.min_by("b", F.struct("far", "b")).alias("b"))
        found = stage_table(found.select("a", "b"), "tested")
        links = whole(found)
        tested = tested.union(found)
        last = turn > _SINGLE_ROUNDS  # every open pair has been tested
        stars = connected(stars.select(F.col("node").alias("a"), F.col("component").alias("b")).union(links))
        if last:
            break
    ends = canon.join(stars, canon["m"] == stars["node"], "left").groupBy("doc_id").agg(F.min(F.coalesce("component", "m")).alias("component_id"))
    rows = described.select("doc_id", F.col("n").alias("n_shingles")).join(ends, "doc_id", "left")
    return rows.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").cast(kind).alias("component_id"))


def representatives(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """The rows of ``docs`` that stand for their component: its smallest doc_id, of repeated rows the first by text.

    Rows with a null doc_id stay.
    """
    kept = similarity_components(docs, like).filter("doc_id = component_id").select("doc_id").distinct()
    first = F.row_number().over(W.partitionBy("doc_id").orderBy("text"))
    place = free_name("_first", docs)
    rows = docs.join(kept, "doc_id", "left_semi").withColumn(place, first).filter(F.col(place) == 1).select(*docs.columns)
    return rows.union(docs.filter("doc_id is null"))
