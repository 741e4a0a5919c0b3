"""Toxicity by a weighted finite-state pattern grammar.

Five transducers read the words of a clause one by one: insults (words and word stems with weights), threats (an
announcement, then an act of harm), targets (words for persons), negation (reaching over a few words) and reported speech.
Their composition marks each insult or threat with the state of the others, and a clause is scored by what it matched: the
entry's precision times the precision of its pattern.  A text's score is the noisy-or of its clauses.

The lexicon is learnt from labelled texts: a word or stem enters when its share among toxic texts is too large to be chance,
given how many words and stems were tried.  Near copies of a training text count once.  At most ``sample`` labelled texts
are used, those with the smallest hashes of doc_id, so that the model's cost has a bound; scoring reads everything.

Defined cases: null and empty texts get the lowest score; without usable labels the lexicon is empty; a doc_id labelled more
than once is toxic if any label says so; null labels are skipped; rows that repeat a doc_id are scored one by one; other
columns than doc_id, text and toxic are not read.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telescry.llm.common import map_rows, stage_table, text_of
from telescry.llm.ngram_join import shingles

_WORDS = re.compile(r"[^\W\d_]+")
_CLAUSE = re.compile(r"[.;:!?\n]+")
_STEMS = range(4, 9)

# Words of the closed classes, in the four languages of the corpus.
TARGETS = frozenset("you your yours yourself he him she her they them their tu te toi vous votre vos du dich dir dein deine ihr euch usted ustedes ti vosotros".split())
NEGATIONS = frozenset("not no never neither nor without isn aren wasn don doesn didn pas jamais ni sans nicht kein keine nie niemals ohne nunca jamás tampoco sin".split())
REPORTS = frozenset("said says say told claimed wrote called quoted reported dit disait écrit sagte sagt schrieb nannte dijo dice escribió llamó".split())
ANNOUNCEMENTS = frozenset("will shall gonna must should vais va werde wird soll voy va debe".split())
HARMS = frozenset("kill hurt beat shoot burn destroy stab murder tuer frapper töten schlagen umbringen matar golpear".split())

_NEGATION_REACH = 3
#: Precision of each pattern before any label is seen, and the labelled texts that this prior is worth.
PRIOR = {"plain": 0.95, "targeted": 0.97, "negated": 0.6, "reported": 0.6}
_PRIOR_WEIGHT = 2.0
THREAT_PRECISION = 0.5


@dataclass
class Grammar:
    """The insult transducer's entries, and the precision of each pattern."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    patterns: dict[str, float] = field(default_factory=lambda: dict(PRIOR))
    base: float = 0.02

    def insult(self, word: str) -> float:
        """The largest weight of the word and its stems."""
        best = self.words.get(word, 0.0)
        for k in _STEMS:
            if len(word) > k and (w := self.stems.get(word[:k], 0.0)) > best:
                best = w
        return best

    def matches(self, words: list[str], weight) -> list[tuple[str, float]]:
        """(pattern, entry precision) of each insult and threat of one clause; ``weight`` gives a word's insult weight."""
        negated = announced = 0
        reported = False
        targeted = not TARGETS.isdisjoint(words)
        out = []
        for word in words:
            w = weight(word)
            if word in HARMS and announced:
                w = max(w, THREAT_PRECISION)
            if w:
                out.append(("reported" if reported else "negated" if negated else "targeted" if targeted else "plain", w))
            negated = _NEGATION_REACH if word in NEGATIONS else max(0, negated - 1)
            announced = _NEGATION_REACH if word in ANNOUNCEMENTS else max(0, announced - 1)
            reported = reported or word in REPORTS
        return out


class Scorer:
    """Applies a grammar; remembers the insult weight of each word it met."""

    def __init__(self, grammar: Grammar, most: int = 1_000_000):
        self.grammar, self.most, self.known = grammar, most, {}

    def _weight(self, word: str) -> float:
        if (w := self.known.get(word)) is None:
            if len(self.known) > self.most:
                self.known.clear()
            w = self.known[word] = self.grammar.insult(word)
        return w

    def matches(self, text: str | None) -> list[tuple[str, float]]:
        low = (text or "").lower()
        words = set(_WORDS.findall(low))
        if not any([self._weight(w) for w in words]) and HARMS.isdisjoint(words):
            return []
        return [m for clause in _CLAUSE.split(low) for m in self.grammar.matches(_WORDS.findall(clause), self._weight)]

    def score(self, text: str | None) -> float:
        clean = 1 - self.grammar.base
        for pattern, w in self.matches(text):
            clean *= 1 - self.grammar.patterns[pattern] * w
        return 1 - clean


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """doc_id, text, toxic of at most ``sample`` labelled texts that are not held out, near copies once."""
    labelled = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = labelled.filter(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select("doc_id", "text").filter("text is not null").join(F.broadcast(chosen), "doc_id")  # at most ``sample`` small rows

    def rows(batch):
        marks = [int(s[0]) >> 1 if len(s := shingles(x, 5)) else 0 for x in batch["text"]]
        yield batch | {"mark": marks}

    kind = docs.schema["doc_id"].dataType.simpleString()
    marked = stage_table(map_rows(texts.select("doc_id", "text", F.col("toxic").cast("int")), f"doc_id {kind}, text string, toxic int, mark long", rows), "labelled")
    first = marked.groupBy("mark", "toxic").agg(F.min("doc_id").alias("doc_id")).select("doc_id")
    return marked.join(F.broadcast(first), "doc_id", "left_semi").select("doc_id", "text", "toxic")


def _counted(sample: DataFrame) -> DataFrame:
    """entry, toxic texts and other texts that have it; entries are words, and stems ending in ``*``."""

    def rows(batch):
        counts: dict[str, list[int]] = {}
        for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
            words = set(_WORDS.findall(text.lower()))
            for entry in words | {w[:k] + "*" for w in words for k in _STEMS if len(w) > k}:
                counts.setdefault(entry, [0, 0])[0 if toxic else 1] += 1
        yield {"entry": list(counts), "toxic": [c[0] for c in counts.values()], "other": [c[1] for c in counts.values()]}

    return map_rows(sample.select("text", "toxic"), "entry string, toxic long, other long", rows).groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def _varied(texts: DataFrame, ranked: dict[str, tuple[int, float]]) -> Grammar:
    """A grammar of the entries that stand between different words in different toxic texts.

    Words that only near copies of one text share keep their neighbours, whatever the copies are called; they go.
    """

    def rows(batch):
        entries, sides, marks = [], [], []
        for k, (text, label) in enumerate(zip(batch["text"], batch["toxic"], strict=True)):
            words = _WORDS.findall(text.lower()) if label else []
            for before, word, after in zip(["", *words], words, [*words[1:], ""], strict=False):
                for e in (word, *(word[:k] + "*" for k in _STEMS if len(word) > k)):
                    if e in ranked:
                        entries.append(e)
                        sides.append(f"{before} {after}")
                        marks.append(batch["doc_id"][k])
        yield {"entry": entries, "sides": sides, "doc_id": marks}

    kind = texts.schema["doc_id"].dataType.simpleString()
    found = map_rows(texts, f"entry string, sides string, doc_id {kind}", rows).distinct().groupBy("entry").agg(
        F.countDistinct("sides").alias("sides"), F.countDistinct("doc_id").alias("texts"))
    kept = {r.entry: ranked[r.entry][1] for r in found.filter("sides >= 3 and sides >= 0.6 * texts").collect()}  # entries of the lexicon at most
    return Grammar({e: p for e, p in kept.items() if e[-1] != "*"}, {e[:-1]: p for e, p in kept.items() if e[-1] == "*"})


def learn(docs: DataFrame, labels: DataFrame, sample: int = 12_000, entries: int = 20_000, chance: float = 0.01, least_precision: float = 0.9) -> Grammar:
    """The grammar with lexicon and pattern precisions learnt from the labelled texts."""
    texts = stage_table(training_sample(docs, labels, sample), "training-texts")
    sizes = texts.agg(F.sum("toxic").alias("toxic"), F.count("*").alias("all")).first()
    toxic, other = int(sizes["toxic"] or 0), int(sizes["all"]) - int(sizes["toxic"] or 0)
    if not toxic or not other:
        return Grammar()
    counted = stage_table(_counted(texts).filter("toxic >= 3"), "entry-counts")
    tried = counted.count()
    # the share of toxic texts among those that have the entry, and how unlikely it is if the entry were neutral
    rate = toxic / (toxic + other)
    seen = F.col("toxic") + F.col("other")
    excess = F.col("toxic") * F.log(F.col("toxic") / (seen * rate)) + F.when(F.col("other") > 0, F.col("other") * F.log(F.col("other") / (seen * (1 - rate)))).otherwise(0.0)
    scored = counted.withColumn("excess", excess).withColumn("precision", F.col("toxic") / (seen + 0.5))
    bar = math.log(max(1, tried) / chance)
    best = scored.filter((F.col("excess") > bar) & (F.col("precision") >= least_precision)).orderBy(F.desc("excess"), "entry").limit(entries).select("entry", "precision").collect()
    grammar = _varied(texts, {r.entry: (k, r.precision) for k, r in enumerate(best)})

    def rows(batch):
        scorer, counts = Scorer(grammar), dict.fromkeys(PRIOR, (0, 0))
        for text, label in zip(batch["text"], batch["toxic"], strict=True):
            for pattern in {p for p, _ in scorer.matches(text)}:
                a, b = counts[pattern]
                counts[pattern] = (a + (label > 0), b + (label <= 0))
        yield {"pattern": list(counts), "toxic": [c[0] for c in counts.values()], "other": [c[1] for c in counts.values()]}

    seen_patterns = map_rows(texts.select("text", "toxic"), "pattern string, toxic long, other long", rows).groupBy("pattern").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    for r in seen_patterns.collect():  # one row per pattern of the grammar
        grammar.patterns[r.pattern] = (r.toxic + _PRIOR_WEIGHT * PRIOR[r.pattern]) / (r.toxic + r.other + _PRIOR_WEIGHT)
    return grammar


def score_texts(docs: DataFrame, grammar: Grammar, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted and n_matches of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(grammar)  # at most ``entries`` entries
    scorers: list[Scorer] = []

    def rows(batch):
        if not scorers:
            scorers.append(Scorer(shared.value))
        found = [scorers[0].matches(x) for x in batch["text"]]
        grammar = shared.value
        clean = [(1 - grammar.base) * float(np.prod([1 - grammar.patterns[p] * w for p, w in m])) for m in found]
        yield {"doc_id": batch["doc_id"], "score": [1 - c for c in clean], "n_matches": [len(m) for m in found]}

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = map_rows(docs.select("doc_id", text_of().alias("text")), f"doc_id {kind}, score double, n_matches long", rows)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "n_matches")
