"""Token ids as directly addressable codes.

An id is split into chunks of eight bits.  Level k holds the k-th chunks of the ids that have one, and a bitmap that says
which of them go on; a directory of running counts for every 512 bits turns a place of one level into its place on the
next.  So any token, and any run of tokens, is read without decoding what stands before it.

A shard file is one row of a Parquet table: the documents' ids and first places, and the codes of their tokens one after
the other, so that any store that Spark writes to will do.  Shards of a part follow each other, parts ascend by doc_id.

Defined cases: a null text is empty and has only the end id; an empty table gives an empty table; rows that repeat a doc_id
are documents of their own, ordered by text; a null doc_id comes first; other columns are not read.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from telescry.llm.common import map_rows, text_of
from telescry.llm.tokens import encoder

_MAGIC, _BLOCK = b"DAC1", 512
_SHARD_TOKENS = 1_000_000


def pack(ids: np.ndarray) -> bytes:
    """The codes of unsigned 32-bit ids."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        chunk, rest = (rest & 255).astype(np.uint8), rest >> 8
        more = rest > 0
        counts = np.add.reduceat(more, np.arange(0, len(more), _BLOCK), dtype=np.uint32) if len(more) else np.zeros(0, np.uint32)
        directory = np.concatenate([[0], np.cumsum(counts, dtype=np.uint32)]).astype("<u4")
        levels.append(struct.pack("<QI", len(chunk), len(directory)) + chunk.tobytes() + np.packbits(more, bitorder="little").tobytes() + directory.tobytes())
        if not more.any():
            return _MAGIC + struct.pack("<I", len(levels)) + b"".join(levels)
        rest = rest[more]


class Codes:
    """Reads tokens of packed ids by their places."""

    def __init__(self, data: bytes):
        if data[:4] != _MAGIC:
            raise ValueError("not a file of directly addressable codes")
        (depth,), at, self.levels = struct.unpack_from("<I", data, 4), 8, []
        for _ in range(depth):
            n, m = struct.unpack_from("<QI", data, at)
            bits = at + 12 + n
            directory = bits + (n + 7) // 8
            self.levels.append((np.frombuffer(data, np.uint8, n, at + 12), np.frombuffer(data, np.uint8, (n + 7) // 8, bits), np.frombuffer(data, "<u4", m, directory)))
            at = directory + 4 * m

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def _rank(self, level: int, place: int) -> int:
        """Set bits of the level before the place."""
        _, bits, directory = self.levels[level]
        block = place // _BLOCK
        inside = np.unpackbits(bits[block * _BLOCK // 8 : (place + 7) // 8], bitorder="little")[: place - block * _BLOCK]
        return int(directory[block]) + int(inside.sum())

    def run(self, start: int, stop: int, level: int = 0) -> np.ndarray:
        """The ids at start <= place < stop."""
        chunk, bits, _ = self.levels[level]
        out = chunk[start:stop].astype(np.uint32)
        if level + 1 < len(self.levels) and start < stop:
            more = np.unpackbits(bits[start // 8 : (stop + 7) // 8], bitorder="little")[start % 8 :][: stop - start].astype(bool)
            first = self._rank(level, start)
            out[more] |= self.run(first, first + int(more.sum()), level + 1) << 8
        return out

    def __getitem__(self, place: int) -> int:
        return int(self.run(place, place + 1)[0])


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2) -> None:
    """Encode every document and write shard files in ascending doc_id order below ``path``."""
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType([
        T.StructField("part", T.LongType()), T.StructField("shard", T.LongType()), T.StructField("shard_start", T.LongType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("doc_id", T.ArrayType(kind)), T.StructField("doc_start", T.ArrayType(T.LongType())), T.StructField("codes", T.BinaryType()),
    ])
    arrow = to_arrow_schema(schema)
    end = struct.pack("<I", end_id)

    def run(batches):
        part, encode = TaskContext.get().partitionId(), encoder(tokenizer).encode
        shard = before = held = 0
        keys, starts, pieces = [], [], []

        def flush():
            codes = pack(np.frombuffer(b"".join(pieces), "<u4"))
            return pa.RecordBatch.from_arrays([pa.array([x], type=f.type) for x, f in zip((part, shard, before, held, keys, starts, codes), arrow, strict=True)], schema=arrow)

        for batch in batches:
            rows = batch.to_pydict()
            for key, ids in zip(rows["doc_id"], encode(rows["text"]), strict=True):
                keys.append(key)
                starts.append(held)
                pieces.append(ids + end)
                held += len(ids) // 4 + 1
                if held >= _SHARD_TOKENS:
                    yield flush()
                    shard, before, held = shard + 1, before + held, 0
                    keys, starts, pieces = [], [], []
        if keys:
            yield flush()

    texts = docs.select("doc_id", text_of().alias("text"))
    texts.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(run, schema).write.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (tokens of all documents before it) and ids (little-endian unsigned 32 bits) of every document."""
    files = spark.read.parquet(path)
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))  # one row per written partition

    first = F.coalesce(F.sum("tokens").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = files.join(F.broadcast(parts.select("part", first.alias("part_start"))), "part")
    kind = files.schema["doc_id"].dataType.elementType.simpleString()

    def rows(batch):
        for key, starts, n, before, shard, data in zip(*(batch[c] for c in ("doc_id", "doc_start", "n_tokens", "part_start", "shard_start", "codes")), strict=True):
            codes = Codes(data)
            yield {
                "doc_id": key, "start": [before + shard + s for s in starts],
                "ids": [codes.run(a, b).astype("<u4").tobytes() for a, b in zip(starts, [*starts[1:], n], strict=True)],
            }

    return map_rows(placed.select("doc_id", "doc_start", "n_tokens", "part_start", "shard_start", "codes"), f"doc_id {kind}, start long, ids binary", rows)
