"""Personal data: fixed detectors, and identifiers discovered by bootstrapping from them.

What the detectors find are seeds.  Every token with a digit or an @ is an instance, and so is every run of such tokens in
a line.  One or two words before or after an instance, with its shape, its class (how many digits, an @, letters and digits)
or, for two words before, with nothing else, are lexical patterns.  The graph of patterns and instances is scored in turns
by Spark jobs: a pattern is as good as the share of its instances that are believed, an instance is believed if it is a seed
or if the best patterns before and after it point to it.  Patterns that many different seeds support and hardly anything
else matches then mark unseen identifiers of kind ``context`` in all texts: a run as one, else its tokens.  Words without
a digit and an @, such as names, are no instances.

Defined cases: a null text is empty; repeated rows are searched one by one; an empty table gives no rows; other columns
stay as they are in ``redacted`` and are not read by ``find``.  Patterns stay a table of the cluster, of any number: they
are joined with the instances, and what they point to with the texts by the texts' digests.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telescry.llm.common import free_name, map_rows, stage_table, text_of

KINDS = ("email", "ip", "card", "phone", "context")
Span = tuple[str, int, int]

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")  # from the middle of digits nothing matches that does not match from their start
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_QUAD = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_SIGN = re.compile(r"[0-9@]")
_GAP = re.compile(r"\)?[^\S\n\r]+(?:[-/.\u2013][^\S\n\r]+)?\(?")  # between tokens of a run
_TOKEN = re.compile(r"\S+")
_EDGE = "\"'()[]{}<>,.;:!?#*$%&|"
_KEY, _FOUND = "_text_sha256", "_discovered"
_REACH = 80  # characters before and after an instance in which its pattern words are looked for


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Seeds: leftmost non-overlapping matches of each kind that pass its rule, by kind and start."""
    out: list[Span] = []
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append(("email", start, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(digits := m[0].replace(" ", "").replace("-", "")) <= 19 and _luhn(digits):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_DIGIT.findall(m[0])) <= 15]
    return out


def _shape(surface: str) -> str:
    """Runs of digits, capital and other letters as 9, A and a."""
    low = re.sub(r"[0-9]+", "9", surface)
    return re.sub(r"[a-z]+", "a", re.sub(r"[^\W\d_A-Z]+", "a", re.sub(r"[A-Z]+", "A", low)))[:40]


def _class(surface: str) -> str:
    if "@" in surface:
        return "<@>"
    if surface.lower() != surface.upper():
        return "<a9>"
    if _QUAD.fullmatch(surface):
        return "<9.9.9.9>"
    digits = len(_DIGIT.findall(surface))
    return "<9>" if digits < 7 else "<7-12>" if digits < 13 else "<13-19>" if digits < 20 else "<20>"


def _patterns(text: str, start: int, end: int, whole: bool) -> list[tuple[str, bool]]:
    """The lexical patterns of an instance and whether their words come after it; parts of runs have those with shapes only."""
    clean = lambda words: [w.strip(_EDGE).lower() or w for w in words]
    before, after = clean(text[max(0, start - _REACH) : start].split()[-2:]), clean(text[end : end + _REACH].split()[:2])
    surface = text[start:end]
    kinds = (_shape(surface), _class(surface)) if whole else (_shape(surface),)
    out = [(f"{' '.join(before[-k:])} _ {x}", False) for k in (1, 2) if len(before) >= k for x in kinds]
    out += [(f"_ {x} {' '.join(after[:k])}", True) for k in (1, 2) if len(after) >= k for x in kinds]
    return [*out, (f"{' '.join(before)} _", False)] if whole and len(before) == 2 else out


def instances(text: str, seeds: list[Span]) -> list[tuple[int, int, bool, tuple[int, int]]]:
    """(start, end, whether a seed, run): the seeds, tokens with a digit or an @ that no seed touches, and runs of these."""
    out, taken = [], sorted({(a, b) for _, a, b in seeds})
    out += [(a, b, True, (a, b)) for a, b in taken]
    run: list[tuple[int, int]] = []

    def end_run():
        if run:
            a, b = run[0][0], run[-1][1]
            a -= len(run) > 1 and text[a - 1 : a] == "(" and ")" in text[a:b]
            out.extend((x, y, False, (a, b)) for x, y in run)
            if len(run) > 1:
                out.append((a, b, False, (a, b)))
        run.clear()

    at, k = 0, 0
    while m := _SIGN.search(text, at):
        start = m.start()
        while start > at and not text[start - 1].isspace():
            start -= 1
        end = _TOKEN.match(text, start).end()
        at = end
        while k < len(taken) and taken[k][1] <= start:
            k += 1
        if k < len(taken) and taken[k][0] < end:
            continue
        token = text[start:end]
        inner = token.strip(_EDGE)
        if inner:
            start += token.index(inner)
            if run and not _GAP.fullmatch(text, run[-1][1], start):
                end_run()
            run.append((start, start + len(inner)))
    end_run()
    return out


def pattern_table(docs: DataFrame, turns: int = 3, support: int = 5, trust: float = 0.8) -> DataFrame:
    """The trusted patterns, from all texts, but for those that no instance besides the seeds has: they point to nothing."""

    def rows(batch):
        out = {"pattern": [], "after": [], "instance": [], "seed": []}
        for text in batch["text"]:
            text = text or ""
            for a, b, known, run in instances(text, base_spans(text)):
                surface = text[a:b] if b - a <= 64 else hashlib.sha256(text[a:b].encode("utf-8", "surrogatepass")).hexdigest()
                for p, after in _patterns(text, a, b, (a, b) == run):
                    for name, value in zip(out, (p, after, surface, known), strict=True):
                        out[name].append(value)
        yield out

    edges = map_rows(docs.select("text"), "pattern string, after boolean, instance string, seed boolean", rows)
    edges = stage_table(edges.groupBy("pattern", "after", "instance").agg(F.max("seed").alias("seed")), "pattern-graph")
    # patterns that few different seeds support cannot be trusted, whatever their instances turn out to be
    strong = edges.groupBy("pattern").agg(F.count_if("seed").alias("seeds")).filter(F.col("seeds") >= support)
    edges = stage_table(edges.join(strong, "pattern"), "pattern-graph")
    belief = F.when(F.col("seed"), 1.0).otherwise(0.0)
    scored = edges.withColumn("belief", belief)
    for _ in range(turns):
        trusted = scored.groupBy("pattern").agg((F.sum("belief") / (F.count("*") + 1)).alias("trust"))
        # patterns of the same words are no independent evidence: only the best of each side counts
        side = lambda after: F.coalesce(F.max(F.when(F.col("after") == after, F.col("trust"))), F.lit(0.0))
        pointed = edges.join(trusted, "pattern").groupBy("instance").agg((1 - (1 - side(False)) * (1 - side(True))).alias("pointed"))
        scored = stage_table(
            edges.join(pointed, "instance").withColumn("belief", F.when(F.col("seed"), 1.0).when(F.col("pointed") >= trust, F.col("pointed")).otherwise(0.0)).drop("pointed"), "pattern-beliefs")
    last = scored.groupBy("pattern").agg((F.sum("belief") / (F.count("*") + 1)).alias("trust"), F.bool_and("seed").alias("idle"))
    return stage_table(last.filter((F.col("trust") >= trust) & ~F.col("idle")).select("pattern"), "trusted-patterns")


def patterns_of(docs: DataFrame, turns: int = 3, support: int = 5, trust: float = 0.8) -> list[str]:
    """The patterns of a small table as a list, for ``spans``."""
    return [r.pattern for r in pattern_table(docs, turns, support, trust).collect()]


def spans(text: str | None, trusted: Collection[str] = frozenset()) -> list[Span]:
    """Seeds, then identifiers that trusted patterns point to."""
    text = text or ""
    seeds = base_spans(text)
    if not trusted:
        return seeds
    hits: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for a, b, known, run in instances(text, seeds):
        if not known and any(p in trusted for p, _ in _patterns(text, a, b, (a, b) == run)):
            hits.setdefault(run, []).append((a, b))
    return seeds + [("context", a, b) for run in sorted(hits) for a, b in ([run] if run in hits[run] else hits[run])]


def written(found: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn(_KEY, F.unhex(F.sha2(text_of(), 256)))


def _patterns_as_table(docs: DataFrame, trusted: DataFrame | Collection[str]) -> DataFrame:
    return trusted if isinstance(trusted, DataFrame) else docs.sparkSession.createDataFrame([(p,) for p in trusted], "pattern string")


def discovered(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """Digest of a text and the starts and ends of what trusted patterns point to in it, for texts where they do."""

    def rows(batch):
        out = {_KEY: [], "start": [], "end": [], "run_start": [], "run_end": [], "pattern": []}
        for key, text in zip(batch[_KEY], batch["text"], strict=True):
            text = text or ""
            for a, b, known, run in instances(text, base_spans(text)):
                for p, _ in () if known else _patterns(text, a, b, (a, b) == run):
                    for name, value in zip(out, (key, a, b, *run, p), strict=True):
                        out[name].append(value)
        yield out

    candidates = map_rows(_keyed(docs.select("text")), f"{_KEY} binary, start long, end long, run_start long, run_end long, pattern string", rows)
    hits = candidates.join(trusted, "pattern", "left_semi").select(_KEY, "run_start", "run_end", F.array("start", "end").alias("span")).distinct()
    run = F.array("run_start", "run_end")
    runs = hits.groupBy(_KEY, "run_start", "run_end").agg(F.max(F.col("span") == run).alias("whole"), F.collect_list("span").alias("parts"))
    runs = runs.select(_KEY, F.when(F.col("whole"), F.array(run)).otherwise(F.col("parts")).alias("parts"))
    return runs.groupBy(_KEY).agg(F.sort_array(F.flatten(F.collect_list("parts"))).alias(_FOUND))


def find(docs: DataFrame, trusted: DataFrame | Collection[str]) -> DataFrame:
    """doc_id, spans (kind, start, end) and the counts and digest of the seeds."""

    def rows(batch):
        found = [base_spans(x or "") for x in batch["text"]]
        out = {f"n_{k}": [sum(s[0] == k for s in f) for f in found] for k in KINDS[:-1]}
        shown = [written(f) for f in found]
        yield out | {"doc_id": batch["doc_id"], _KEY: batch[_KEY], "base_sha256": [hashlib.sha256(x.encode()).hexdigest() for x in shown], "spans": shown}

    kind = docs.schema["doc_id"].dataType.simpleString()
    base = map_rows(_keyed(docs.select("doc_id", "text")), f"doc_id {kind}, {_KEY} binary, " + ", ".join(f"n_{k} long" for k in KINDS[:-1]) + ", base_sha256 string, spans string", rows)
    both = base.join(discovered(docs, _patterns_as_table(docs, trusted)), _KEY, "left")
    more = F.transform(_FOUND, lambda s: F.concat(F.lit("context:"), s[0], F.lit(":"), s[1]))
    return both.select(
        "doc_id", *(f"n_{k}" for k in KINDS[:-1]), F.coalesce(F.size(_FOUND).cast("long"), F.lit(0)).alias("n_context"), "base_sha256",
        F.concat_ws(",", F.when(F.col("spans") != "", F.col("spans")), more).alias("spans"))


def masked(text: str | None, found: list[Span]) -> str | None:
    """The text with each span, or spans that overlap, as the kind of the first in angle brackets."""
    if not text or not found:
        return text
    out, end = [], 0
    for kind, a, b in sorted(found, key=lambda s: (s[1], -s[2])):
        if a >= end:
            out += [text[end:a], f"<{kind}>"]
        end = max(end, b)
    return "".join([*out, text[end:]])


def redacted(docs: DataFrame, trusted: DataFrame | Collection[str]) -> DataFrame:
    """``docs`` with masked texts."""
    key, spans_column = free_name(_KEY, docs), free_name(_FOUND, docs)

    def rows(batch):
        more = batch.pop(spans_column)
        yield batch | {"text": [masked(x, base_spans(x or "") + [("context", a, b) for a, b in f or ()]) for x, f in zip(batch["text"], more, strict=True)]}

    found = discovered(docs, _patterns_as_table(docs, trusted)).select(F.col(_KEY).alias(key), F.col(_FOUND).alias(spans_column))
    both = docs.withColumn(key, F.unhex(F.sha2(text_of(), 256))).join(found, key, "left").drop(key)
    return map_rows(both, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), rows)
