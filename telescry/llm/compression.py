"""Quality by compression: texts compress better with a dictionary built from texts of their own kind.

Two zstandard dictionaries are built from labelled texts, one from good ones and one from bad ones.  A text is compressed in pieces
of ``PIECE`` bytes, each on its own with either dictionary, so that a long text does not become its own dictionary; every byte is in one
piece.  With the sizes added up to b (bad) and g (good), the normalised difference is (b - g) / (b + g), and the rate is their mean
per byte; both are drawn to neutral values where there is little text.  A logistic curve over the difference and the rate,
fitted to labelled texts that no dictionary was built from, makes the score: the chance that the label is 1.  (The rate tells texts
that repeat themselves, which both dictionaries compress alike.)

The dictionaries are trained in tasks, from about ``pieces`` different pieces a class, those with the smallest hashes, of at most ``sample`` labelled texts a
class; the curve is fitted to at most ``sample`` labelled texts.  Scoring reads everything.

Defined cases: null and empty texts get the score of a neutral difference and rate; without labelled texts of both classes every text
gets the share of good labels (0.5 without any); a doc_id labelled more than once has its largest label; null labels and labels
without doc_id are skipped; equal texts with equal labels are learnt from once; rows that repeat a doc_id are scored one by one;
empty tables give no rows; other columns than doc_id, text and quality are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telescry.llm.common import map_rows, stage_table, text_of

PIECE, DICTIONARY, LEVEL = 256, 32_768, 3
#: Bytes of neutral text that every text is weighed with.
NEUTRAL = 64


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def pieces_of(text: str | None) -> list[bytes]:
    """The bytes of the whole text, cut every ``PIECE`` bytes."""
    data = (text or "").encode("utf-8", "surrogatepass")
    return [data[k : k + PIECE] for k in range(0, len(data), PIECE)]


def build_dictionary(pieces: list[bytes]) -> bytes:
    """A trained dictionary, or, of pieces too few to train one, their own last bytes."""
    try:
        return zstandard.train_dictionary(DICTIONARY, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[-DICTIONARY:]


class Sizer:
    """Compressed bytes of texts with one dictionary."""

    def __init__(self, dictionary: bytes):
        shared = zstandard.ZstdCompressionDict(dictionary)
        shared.precompute_compress(level=LEVEL)
        self.compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_checksum=False, write_content_size=False, write_dict_id=False).compress
        self.least = len(self.compress(b""))

    def size(self, pieces: list[bytes]) -> int:
        compress = self.compress
        return sum([len(compress(p)) for p in pieces]) - self.least * len(pieces)


@dataclass
class Model:
    """Dictionaries of bad and good texts, the neutral rate and the logistic curve over (1, difference, rate)."""

    bad: bytes = b""
    good: bytes = b""
    rate: float = 0.5
    curve: tuple[float, float, float] = (0.0, 0.0, 0.0)


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.sizers = [Sizer(model.bad), Sizer(model.good)] if model.bad and model.good else []

    def measures(self, text: str | None) -> tuple[int, int, int]:
        """Bytes of the text, and of it compressed with the dictionaries of bad and good texts."""
        pieces = pieces_of(text)
        bad, good = (s.size(pieces) for s in self.sizers) if self.sizers else (0, 0)
        return sum(map(len, pieces)), bad, good


def features(n: np.ndarray, bad: np.ndarray, good: np.ndarray, rate: float) -> np.ndarray:
    """Rows (1, normalised difference, rate)."""
    n, bad, good = (np.asarray(x, np.float64) for x in (n, bad, good))
    neutral = NEUTRAL * rate
    return np.stack([np.ones_like(n), (bad - good) / (bad + good + 2 * neutral), ((bad + good) / 2 + neutral) / (n + NEUTRAL)], axis=1)


def fit_curve(x: np.ndarray, y: np.ndarray, weight: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton steps on scaled columns with a ridge of ``weight``; the first column is constant."""
    mean, scale = x[:, 1:].mean(axis=0), x[:, 1:].std(axis=0) + 1e-9
    z = np.c_[np.ones(len(x)), (x[:, 1:] - mean) / scale]
    w, ridge = np.zeros(z.shape[1]), np.diag([1e-6] + [weight] * (z.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -35, 35)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (p - y) + ridge @ w)
        w = w - step
        if np.abs(step).max() < 1e-10:
            break
    slopes = w[1:] / scale
    return np.r_[w[0] - slopes @ mean, slopes]


def labelled_texts(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """text, good, builds: labelled texts that are not held out; ``builds`` marks those for the dictionaries, others fit the curve."""
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg((F.max("quality") > 0).cast("int").alias("good"))
    known = known.filter(~held_out(F.col("doc_id"))).withColumn("hash", F.xxhash64("doc_id")).withColumn("builds", F.col("hash") % 2 == 0)
    order = ["hash", "doc_id"]
    built = [known.filter(F.col("builds") & (F.col("good") == c)).orderBy(*order).limit(sample) for c in (0, 1)]
    chosen = built[0].unionByName(built[1]).unionByName(known.filter(~F.col("builds")).orderBy(*order).limit(sample))
    texts = docs.select("doc_id", "text").filter("text is not null").join(F.broadcast(chosen), "doc_id")  # at most 3 x ``sample`` small rows
    return texts.withColumn("mark", F.sha2("text", 256)).groupBy("mark", "good", "builds").agg(F.first("text").alias("text")).drop("mark")


def learn(docs: DataFrame, labels: DataFrame, sample: int = 4_000, pieces: int = 20_000) -> Model:
    texts = stage_table(labelled_texts(docs, labels, sample), "labelled")
    seen = {r.good: r["count"] for r in texts.groupBy("good").count().collect()}  # two rows
    share = seen.get(1, 0) / sum(seen.values()) if seen else 0.5
    flat = Model(curve=(float(np.log(max(share, 1e-6) / max(1 - share, 1e-6))), 0.0, 0.0))

    def cut(batch):
        found = [(g, p) for t, g in zip(batch["text"], batch["good"], strict=True) for p in pieces_of(t)]
        yield {"good": [g for g, _ in found], "piece": [p for _, p in found]}

    cuts = map_rows(texts.filter("builds").select("text", "good"), "good int, piece binary", cut).distinct()
    cuts = stage_table(cuts.withColumn("place", F.pmod(F.xxhash64("piece"), F.lit(1 << 30))), "labelled-pieces")
    sizes = {r.good: r["count"] for r in cuts.groupBy("good").count().collect()}  # two rows
    bar = F.create_map(*[F.lit(x) for g, n in (sizes or {0: 1}).items() for x in (g, int((1 << 30) * min(1.0, pieces / n)))])
    cuts = cuts.filter(F.col("place") < bar[F.col("good")])

    def build(rows: pa.Table) -> pa.Table:
        found = sorted(zip(rows["place"].to_pylist(), rows["piece"].to_pylist(), strict=True))
        return pa.table({"good": pa.array([rows["good"][0].as_py()], pa.int32()), "dictionary": pa.array([build_dictionary([p for _, p in found])], pa.binary())})

    built = {r.good: bytes(r.dictionary) for r in cuts.groupBy("good").applyInArrow(build, "good int, dictionary binary").collect()}  # two rows
    if not built.get(0) or not built.get(1):
        return flat
    model = Model(built[0], built[1])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of bounded size

    def measure(batch):
        scorer = Scorer(shared.value)
        n, bad, good = zip(*[scorer.measures(t) for t in batch["text"]], strict=True)
        yield {"n": n, "bad": bad, "good": good, "label": batch["good"]}

    measured = map_rows(texts.filter("not builds").select("text", "good"), "n long, bad long, good long, label int", measure).orderBy("n", "bad", "good", "label").collect()  # at most ``sample`` rows
    if len({r.label for r in measured}) < 2:
        return flat
    n, bad, good, label = (np.array([r[c] for r in measured], np.float64) for c in ("n", "bad", "good", "label"))
    model.rate = float((bad + good).sum() / 2 / max(1.0, n.sum()))
    model.curve = tuple(float(w) for w in fit_curve(features(n, bad, good, model.rate), label))
    return model


def score_texts(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted, and difference and rate of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of bounded size
    scorers: list[Scorer] = []

    def rows(batch):
        if not scorers:
            scorers.append(Scorer(shared.value))
        found = features(*zip(*[scorers[0].measures(t) for t in batch["text"]], strict=True), shared.value.rate)
        scores = 1 / (1 + np.exp(-np.clip(found @ np.array(shared.value.curve), -35, 35)))
        yield {"doc_id": batch["doc_id"], "score": scores.tolist(), "difference": found[:, 1].tolist(), "rate": found[:, 2].tolist()}

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = map_rows(docs.select("doc_id", text_of().alias("text")), f"doc_id {kind}, score double, difference double, rate double", rows)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "difference", "rate")
