"""Packing documents into training windows by sum of squares.

Documents longer than a window fill whole windows first; what is left of them, and shorter documents whole, go one by one
to the fill level that makes the sum of the squared numbers of open windows over all levels least.  Each task packs the
documents of its own partition with a level array of its own, so nothing is shuffled.  When a task ends, or holds
``most_open`` open windows, the open windows are joined and cut anew into full ones; the end of the last is cut into
windows of powers of two, which need no padding.

Defined cases: a null or empty text has only the end id; repeated rows are documents of their own; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql import types as T

from telescry.llm.common import text_of
from telescry.llm.tokens import encoder

#: A piece: document key, first token, bytes of its ids, tokens of the document.
Piece = tuple[object, int, bytes, int]


class SumOfSquares:
    """Packs pieces online; ``add`` and ``close`` yield finished windows as lists of pieces."""

    def __init__(self, window: int = 4096, most_open: int = 1024):
        self.window, self.most_open = window, most_open
        self.levels: list[list[list[Piece]]] = [[] for _ in range(window)]
        self.counts = np.zeros(window + 1, np.int64)  # open windows by fill; the count of full ones stays 0
        self.open = 0

    def _level(self, size: int) -> int:
        """The fill level to put ``size`` tokens on; 0 is a new window."""
        here, there = self.counts[1 : self.window - size + 1], self.counts[size + 1 : self.window + 1]
        change = 2 * (there - here) + 2
        change[-1:] -= 1  # a window that gets full leaves the levels
        change[here == 0] = np.iinfo(np.int64).max
        new = 2 * int(self.counts[size]) + 1
        if not len(change) or int(least := change.min()) > new:
            return 0
        return len(change) - int(np.argmax(change[::-1] == least))

    def add(self, key, ids: bytes) -> Iterator[list[Piece]]:
        total, wide = len(ids) // 4, 4 * self.window
        whole = len(ids) // wide * wide
        for at in range(0, whole, wide):
            yield [(key, at // 4, ids[at : at + wide], total)]
        if whole == len(ids):
            return
        size = (len(ids) - whole) // 4
        level = self._level(size)
        pieces = self.levels[level].pop() if level else []
        pieces.append((key, whole // 4, ids[whole:], total))
        if level:
            self.counts[level] -= 1
            self.open -= 1
        if level + size == self.window:
            yield pieces
            return
        self.levels[level + size].append(pieces)
        self.counts[level + size] += 1
        self.open += 1
        if self.open >= self.most_open:
            yield from self.close()

    def close(self) -> Iterator[list[Piece]]:
        """Joins the open windows, fullest first, and cuts them into full windows and at last into powers of two."""
        left = [piece for level in reversed(self.levels) for pieces in level for piece in pieces]
        rest = sum(len(p[2]) for p in left) // 4
        self.levels, self.open = [[] for _ in range(self.window)], 0
        self.counts[:] = 0
        room, pieces = 0, []
        left.reverse()
        while left:
            if not room:
                room = self.window if rest >= self.window else 1 << rest.bit_length() - 1
                rest -= room
            key, start, ids, total = left.pop()
            if len(ids) > 4 * room:
                left.append((key, start + room, ids[4 * room :], total))
                ids = ids[: 4 * room]
            pieces.append((key, start, ids, total))
            room -= len(ids) // 4
            if not room:
                yield pieces
                pieces = []


def pack_documents(docs: DataFrame, tokenizer: str, window: int = 4096, end_id: int = 2, most_open: int = 1024) -> DataFrame:
    """doc_id, start, length, ids, doc_tokens, sequence_id and offset of every piece."""
    schema = T.StructType([docs.schema["doc_id"]] + T._parse_datatype_string("start long, length long, ids binary, doc_tokens long, sequence_id long, offset long").fields)
    arrow = to_arrow_schema(schema)
    end = struct.pack("<I", end_id)

    def run(batches):
        packer, encode = SumOfSquares(window, most_open), encoder(tokenizer).encode
        number = count(TaskContext.get().partitionId() << 40)

        def windows():
            for batch in batches:
                rows = batch.to_pydict()
                for key, ids in zip(rows["doc_id"], encode(rows["text"]), strict=True):
                    yield from packer.add(key, ids + end)
            yield from packer.close()

        out: list[tuple] = []
        size = 0
        for pieces in windows():
            sequence, offset = next(number), 0
            for key, start, ids, total in pieces:
                out.append((key, start, len(ids) // 4, ids, total, sequence, offset))
                offset += len(ids) // 4
            size += offset
            if size > 1_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out, strict=True), arrow, strict=True)], schema=arrow)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out, strict=True), arrow, strict=True)], schema=arrow)

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(run, schema)
