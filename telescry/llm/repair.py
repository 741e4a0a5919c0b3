"""Conversation structure repair by weighted interval parsing (CYK).

**Grammar.**  Repaired role initials must spell ``(s?(ua)+)?``.  Its automaton has the states ``START``, ``SYSTEM``, ``USER`` and
``REPLY``; the grammar in Chomsky normal form has a nonterminal [p, q] for each pair of states, "what leads from p to q", with the rules
[p, q] -> [p, r] [r, q] and, for a row, what keeping, re-roling or deleting it does to the state.  A cell of the chart holds for a
span of rows and each nonterminal the least (cost, audit).  The insertion closure adds what inserted rows do before and after
a span.  As the nonterminals are closed under the binary rule, every split of a span gives the same cell, so the chart is filled bottom-up by
span length over aligned spans only: rows, pairs of rows, pairs of those, and so on.  Audits of one cell that cost the same differ before
either ends, so the least audit of a span is made of least audits of its parts.

**Spread.**  Rows are range-sorted into spans of at most ``SPAN_ROWS`` rows or ``SPAN_CHARS`` characters of one conversation; rows that are
equal in every column, or a conversation of any length, are dealt over many tasks.  Cells of spans are combined
``FAN`` at a time until each conversation has one; its audit is then cut by spans again, so that the repaired text is put together
span by span and hashed in a stream.

Defined cases: null turns come first; null conv_ids are one conversation; a null role or text is one space, and a null conv_id or turn is one in the
damage key; rows of the same turn come by role, by the first 200 characters of the text, by its SHA-256; a row that repeats another
in every column is a row of its own (and a duplicate); an empty role has an empty initial; a conversation without rows has zeros and
empty strings; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from telescry.llm.common import stage_table

SPAN_ROWS, SPAN_CHARS, FAN = 128, 1 << 18, 64

START, SYSTEM, USER, REPLY = range(4)
STATES = range(4)
#: What each role initial does to the state.
MOVES = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, REPLY: USER}, "a": {USER: REPLY}}
ENDS = (START, REPLY)
#: Roles that a row can be given.
GIVEN = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

_LEGAL = {"su", "ua", "au"}
Cell = dict[tuple[int, int], tuple[int, str]]


def better(cell: Cell, key: tuple[int, int], value: tuple[int, str]) -> None:
    if key not in cell or value < cell[key]:
        cell[key] = value


def combined(left: Cell, right: Cell) -> Cell:
    """The cell of a span from those of its two parts: [p, q] -> [p, r] [r, q]."""
    out: Cell = {}
    for (p, r), (cost, audit) in left.items():
        for q in STATES:
            if (found := right.get((r, q))) is not None:
                better(out, (p, q), (cost + found[0], audit + found[1]))
    return out


def insertion_closure() -> Cell:
    """What inserted rows alone lead from and to, at least cost; nothing at no cost."""
    cell: Cell = {(p, p): (0, "") for p in STATES}
    one = {(p, MOVES[c][p]): (INSERT, "I") for c in GIVEN for p in MOVES[c]}
    while True:
        longer = combined(cell, one)
        wider = dict(cell)
        for key, value in longer.items():
            better(wider, key, value)
        if wider == cell:
            return cell
        cell = wider


CLOSURE = insertion_closure()


@lru_cache(maxsize=4096)
def row_cell(initial: str, fault: str) -> Cell:
    """The closed cell of one row, not to be changed; ``fault`` is blank, duplicate, truncated or empty."""
    cell: Cell = {(p, p): (DELETE, "D") for p in STATES}
    if fault not in ("blank", "duplicate"):
        extra = TRUNCATED if fault == "truncated" else 0
        for p, q in MOVES.get(initial, {}).items():
            better(cell, (p, q), (extra, "K"))
        for c in GIVEN:
            for p, q in MOVES[c].items():
                better(cell, (p, q), (REROLE + extra, "R"))
    return combined(combined(CLOSURE, cell), CLOSURE)


def parse(cells: list[Cell]) -> Cell:
    """Bottom-up by span length: neighbours, then neighbours of those, until one span is left."""
    while len(cells) > 1:
        cells = [combined(*cells[k : k + 2]) if k + 1 < len(cells) else cells[k] for k in range(0, len(cells), 2)]
    return cells[0] if cells else dict(CLOSURE)


def cheapest(cell: Cell) -> tuple[int, str]:
    return min(cell[START, q] for q in ENDS if (START, q) in cell)


def apply(rows: Iterable[tuple[str, str]], audit: str, state: int) -> tuple[list[str], int]:
    """The repaired ``role:text`` lines of rows, and the state after them."""
    source, lines = iter(rows), []
    for edit in audit:
        role, text = next(source) if edit != "I" else ("", "")
        if edit == "D":
            continue
        if edit == "K":
            initial = role[:1]
        else:
            initial = next(c for c in GIVEN if state in MOVES[c])
            role = GIVEN[initial]
        state = MOVES[initial][state]
        lines.append(f"{role}:{text}")
    return lines, state


def damage_kind() -> Column:
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    return F.crc32(key) % 20


def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the damage, and the row's ``salt``, which tells equal rows apart."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    kind = damage_kind()
    hurt = turns.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"), kind.alias("kind"), F.monotonically_increasing_id().alias("salt"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return hurt.filter("kind <> 0").select("*", copies.alias("copy")).drop("kind", "copy")


def _kind(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def spans_of(rows: DataFrame) -> DataFrame:
    """One row per span: part, span (in order of the sort), conv_id, and arrays turns, roles, texts, faults (blank or truncated), hashes."""
    schema = T.StructType([T.StructField("part", T.LongType()), T.StructField("span", T.LongType()), T.StructField("conv_id", _kind(rows, "conv_id")), T.StructField("turns", T.ArrayType(_kind(rows, "turn")))] + [
        T.StructField(c, T.ArrayType(T.StringType())) for c in ("roles", "texts", "faults")] + [T.StructField("hashes", T.ArrayType(T.BinaryType()))])
    arrow = to_arrow_schema(schema)
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", F.substring("text", 1, 200), "hash", "salt"]
    hashed = rows.withColumn("hash", F.unhex(F.sha2("text", 256)))

    def run(batches):
        part, span, held = TaskContext.get().partitionId(), 0, None
        turns, roles, texts, faults, hashes, chars = [], [], [], [], [], 0

        def flush():
            row = (part, span, held, turns, roles, texts, faults, hashes)
            return pa.RecordBatch.from_arrays([pa.array([x], type=f.type) for x, f in zip(row, arrow, strict=True)], schema=arrow)

        for batch in batches:
            for conv, turn, role, text, digest in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "hash")), strict=True):
                if turns and (conv != held or len(turns) >= SPAN_ROWS or chars > SPAN_CHARS):
                    yield flush()
                    span += 1
                    turns, roles, texts, faults, hashes, chars = [], [], [], [], [], 0
                held = conv
                turns.append(turn)
                roles.append(role)
                texts.append(text)
                hashes.append(digest)
                chars += len(text)
                last = text.rstrip("\x20\x09\x0a\x0b\x0c\x0d")[-1:]
                faults.append("blank" if not last else "" if last in ".!?" else "truncated")
        if turns:
            yield flush()

    return hashed.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", "hash").mapInArrow(run, schema)


def numbered(spans: DataFrame) -> DataFrame:
    """Spans with their number in the order of the sort, from one row per written partition."""
    sizes = spans.groupBy("part").agg(F.count("*").alias("spans"))
    before = F.coalesce(F.sum("spans").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return spans.join(F.broadcast(sizes.select("part", before.alias("before"))), "part").withColumn("number", F.col("before") + F.col("span")).drop("before", "part", "span")


def first_places(spans: DataFrame) -> DataFrame:
    """number and the places in the span of rows whose role and text no earlier row of the conversation has."""
    rows = spans.select("conv_id", "number", F.posexplode(F.arrays_zip("roles", "hashes")).alias("place", "row"))
    first = rows.groupBy("conv_id", "row").agg(F.min(F.struct("number", "place")).alias("first"))
    return first.groupBy("first.number").agg(F.collect_set("first.place").alias("fresh"))  # at most ``SPAN_ROWS`` places


# A summary: everything of a span that its conversation's result needs, put together from neighbouring spans.
_COUNTS = ("blank", "duplicate", "truncated", "illegal", "distinct")
_SUMMARY = "number long, sizes array<struct<number:long,rows:long>>, first string, last string, least {t}, most {t}, first_turn {t}, last_turn {t}, " + ", ".join(f"{c} long" for c in _COUNTS) + ", cell array<struct<p:int,q:int,cost:long,audit:string>>"


def _as_rows(cell: Cell) -> list[dict]:
    return [{"p": p, "q": q, "cost": cost, "audit": audit} for (p, q), (cost, audit) in sorted(cell.items())]


def _as_cell(rows: list[dict]) -> Cell:
    return {(r["p"], r["q"]): (r["cost"], r["audit"]) for r in rows}


def summary(number: int, turns: list, roles: list[str], faults: list[str], fresh: list[int]) -> dict:
    """The summary of one span."""
    fresh_places, initials = set(fresh), [r[:1] for r in roles]
    found = [f if f == "blank" else "duplicate" if k not in fresh_places else f for k, f in enumerate(faults)]
    cells = [row_cell(c, f) for c, f in zip(initials, found, strict=True)]
    known = [t for t in turns if t is not None]
    return {
        "number": number, "sizes": [{"number": number, "rows": len(roles)}], "first": initials[0], "last": initials[-1],
        "least": known[0] if known else None, "most": known[-1] if known else None, "first_turn": turns[0], "last_turn": turns[-1],
        "blank": found.count("blank"), "duplicate": found.count("duplicate"), "truncated": found.count("truncated"),
        "illegal": sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:])), "distinct": len(set(known)), "cell": _as_rows(parse(cells)),
    }


def merged(parts: list[dict]) -> dict:
    """The summary of neighbouring spans, in order."""
    out = dict(parts[0])
    for before, part in zip(parts, parts[1:]):
        for c in _COUNTS:
            out[c] += part[c]
        out["illegal"] += before["last"] + part["first"] not in _LEGAL
        out["distinct"] -= part["first_turn"] is not None and before["last_turn"] == part["first_turn"]
    low, high = [p["least"] for p in parts if p["least"] is not None], [p["most"] for p in parts if p["most"] is not None]
    out |= {"last": parts[-1]["last"], "last_turn": parts[-1]["last_turn"], "least": low[0] if low else None, "most": high[-1] if high else None}
    return out | {"sizes": [s for p in parts for s in p["sizes"]], "cell": _as_rows(parse([_as_cell(p["cell"]) for p in parts]))}


def _summaries(spans: DataFrame, fresh: DataFrame) -> DataFrame:
    schema = T.StructType([T.StructField("conv_id", _kind(spans, "conv_id"))] + T._parse_datatype_string(_SUMMARY.format(t=_kind(spans, "turns").elementType.simpleString())).fields)
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            rows = batch.to_pylist()
            out = [{"conv_id": r["conv_id"]} | summary(r["number"], r["turns"], r["roles"], r["faults"], r["fresh"] or []) for r in rows]
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return spans.select("conv_id", "number", "turns", "roles", "faults").join(fresh, "number", "left").mapInArrow(run, schema)


def _one_per_conversation(found: DataFrame) -> DataFrame:
    """Combine the summaries of neighbouring spans, ``FAN`` at a time, until each conversation has one."""
    schema = found.schema
    arrow = to_arrow_schema(schema)

    def merge(rows: pa.Table) -> pa.Table:
        parts = sorted(rows.select(schema.names).to_pylist(), key=lambda r: r["number"])
        return pa.Table.from_pylist([merged(parts)], schema=arrow)

    step = 1
    while True:
        most = found.groupBy("conv_id").agg(F.count("*").alias("spans")).agg(F.max("spans")).first()[0]
        if (most or 0) <= 1:
            return found
        step *= FAN
        joined = found.withColumn("group", F.floor(F.col("number") / step)).groupBy("conv_id", "group").applyInArrow(merge, schema)
        found = stage_table(joined, "conversation-spans")


def _slices(found: DataFrame) -> DataFrame:
    """number, audit and state before it of every span, from the audits of whole conversations."""
    schema = T._parse_datatype_string("number long, audit string, state int")
    arrow = to_arrow_schema(schema)

    def slices(row: dict):
        _, audit = cheapest(_as_cell(row["cell"]))
        at, state = 0, START
        opened = SYSTEM if (len(audit) - audit.count("D")) % 2 else USER  # pairs, or a system row and pairs
        for k, span in enumerate(row["sizes"]):
            rest, start = span["rows"], at
            before, last = state, k == len(row["sizes"]) - 1  # rows inserted between two spans go with the later one
            while at < len(audit) and (rest or last):
                rest -= audit[at] != "I"
                if audit[at] != "D":
                    state = opened if state == START else REPLY if state == USER else USER
                at += 1
            yield {"number": span["number"], "audit": audit[start:at], "state": before}

    def run(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                yield from pa.Table.from_pylist(list(slices(batch.slice(at, 1).to_pylist()[0])), schema=arrow).to_batches()

    return found.mapInArrow(run, schema)


def _digests(lines: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of its spans' texts, newline-joined, in a stream over sorted rows."""
    schema = T.StructType([T.StructField("conv_id", _kind(lines, "conv_id")), T.StructField("repaired_sha256", T.StringType())])
    arrow = to_arrow_schema(schema)

    def run(batches):
        held, digest, started = None, None, False
        out: list[tuple] = []
        for batch in batches:
            for conv, text in zip(batch.column("conv_id").to_pylist(), batch.column("lines").to_pylist(), strict=True):
                if digest is None or conv != held:
                    if digest is not None:
                        out.append((held, digest.hexdigest()))
                    held, digest, started = conv, hashlib.sha256(), False
                if text is not None:
                    digest.update(("\n" if started else "").encode() + text.encode("utf-8", "surrogatepass"))
                    started = True
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out, strict=True), arrow, strict=True)], schema=arrow)
                out = []
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], type=f.type) for x, f in zip((held, digest.hexdigest()), arrow, strict=True)], schema=arrow)

    order = [F.col("conv_id").asc_nulls_first(), "number"]
    return lines.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "lines").mapInArrow(run, schema)


def repaired_spans(spans: DataFrame, slices: DataFrame) -> DataFrame:
    """conv_id, number and ``lines``: the repaired ``role:text`` rows of each span, newline-joined (null where none are left)."""
    schema = T.StructType([T.StructField("conv_id", _kind(spans, "conv_id")), T.StructField("number", T.LongType()), T.StructField("lines", T.StringType())])
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                lines, _ = apply(zip(r["roles"], r["texts"], strict=True), r["audit"], r["state"])
                out.append({"conv_id": r["conv_id"], "number": r["number"], "lines": "\n".join(lines) if lines else None})
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return spans.select("conv_id", "number", "roles", "texts").join(slices, "number").mapInArrow(run, schema)


def repair(turns: DataFrame) -> DataFrame:
    """One row per conv_id: gaps, counts of faults and illegal neighbours, the repair's cost and audit, and the SHA-256 of the repaired text."""
    spans = numbered(stage_table(spans_of(damaged(turns)), "conversation-rows"))
    found = _one_per_conversation(stage_table(_summaries(spans, first_places(spans)), "conversation-spans"))
    digests = _digests(repaired_spans(spans, stage_table(_slices(found), "conversation-audits"))).withColumnRenamed("conv_id", "repaired_id")
    ends = F.filter("cell", lambda c: (c["p"] == START) & c["q"].isin(*ENDS))
    best = F.array_min(F.transform(ends, lambda c: F.struct(c["cost"].alias("cost"), c["audit"].alias("audit"))))
    counts = found.select("conv_id", F.coalesce(F.col("most") - F.col("least") + 1 - F.col("distinct"), F.lit(0)).cast("long").alias("gaps"), *_COUNTS[:4], best.alias("best"))
    columns = ["conv_id", "gaps", *_COUNTS[:4], F.col("best.cost").alias("cost"), F.col("best.audit").alias("audit"), "repaired_sha256"]
    some = counts.join(digests, F.col("conv_id").eqNullSafe(F.col("repaired_id"))).select(*columns)
    left = turns.groupBy("conv_id").agg(F.max(damage_kind() != 0).alias("stays")).filter("not stays")
    none = left.select("conv_id", *(F.lit(0).cast("long").alias(c) for c in ("gaps", *_COUNTS[:4], "cost")), F.lit("").alias("audit"), F.sha2(F.lit(""), 256).alias("repaired_sha256"))
    return some.unionByName(none)
