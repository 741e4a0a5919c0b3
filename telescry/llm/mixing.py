"""Mixing sources to target weights by entropy balancing.

Every document gets the rate ``r`` that keeps the rates closest to 1 (in relative entropy) while the words taken of
its source meet the source's target and no rate passes ``most``.  The optimum is an exponential tilt,
``r = min(most, exp(tilt * size))`` with one dual variable per source.  The duals are found by Newton steps, one Spark
job each, over the table of (source, size, documents); a bracket around each dual replaces steps that leave it.
Rates are rounded to whole copies in groups of about ``group_rows`` documents of a source, from the longest to the
shortest, each document taking up the deviation of those before it.

Defined cases: a null text has size 0 and no copies taken; a null source is a source of its own, the last one; repeated
rows are documents of their own; an empty table gives no rows.  Only doc_id, source and text are read; other columns of
the input come back through ``mixed``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from telescry.llm.common import WORD, free_name, stage_table

_STEPS, _NEAR = 60, 1e-9


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Adds number, weight and target to (source, source_size, ...): one row per source.

    The level at which weights times level, each cut at ``most`` times the source, add up to the share is found from
    running sums in the order in which sources reach their cut.
    """
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    by_name, by_cut = W.orderBy(F.col("source").asc_nulls_last()), W.orderBy("cut_at", "number")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("number") - 1, F.lit(len(weights))) + 1).cast("int"))
    cut = F.lit(float(most)) * F.col("source_size")
    numbered = sources.withColumn("number", F.row_number().over(by_name)).withColumn("weight", weight)
    numbered = numbered.withColumn("cut_at", cut / F.col("weight"))
    level = (F.lit(float(share)) * F.sum("source_size").over(everything) - F.coalesce(F.sum(cut).over(by_cut.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))) / F.sum("weight").over(
        by_cut.rowsBetween(0, W.unboundedFollowing))
    levelled = numbered.withColumn("level", level).withColumn(
        "level", F.coalesce(F.min(F.when(F.col("level") <= F.col("cut_at"), F.struct("cut_at", "number", "level"))).over(everything)["level"], F.max("cut_at").over(everything)))
    return levelled.withColumn("target", F.least(F.col("weight") * F.col("level"), cut)).drop("cut_at", "level", "weight")


def _rate(tilt: Column, size: Column, most: float) -> Column:
    return F.least(F.lit(float(most)), F.exp(F.least(tilt * size, F.lit(math.log(most) + 1))))


def solve(histogram: DataFrame, sources: DataFrame, most: float) -> DataFrame:
    """``sources`` with its dual ``tilt``: histogram has (number, size, documents) with sizes above 0."""
    size, target, total = F.col("size"), F.col("target"), F.col("source_size")
    full = target >= total * most * (1 - 1e-12)
    state = stage_table(
        sources.withColumn("hi", F.when(target > total, F.lit(math.log(most))).otherwise(0.0))
        .withColumn("lo", F.when((target < total) & (target > 0), -F.log(total / target)).otherwise(0.0))
        .withColumn("tilt", F.when(full, F.lit(math.log(most))).otherwise(0.0)).withColumn("done", full | (total <= 0)),
        "tilts",
    )
    for _ in range(_STEPS):
        rate = _rate(F.col("tilt"), size, most)
        words = F.col("documents") * size * rate
        slope = F.when(rate < most, words * size).otherwise(0.0)
        sums = (
            histogram.join(state.filter("not done").select("number", "tilt"), "number").groupBy("number")
            # decimals add up to the same in any order, so that reruns agree
            .agg(F.sum(words.cast("decimal(38,9)")).cast("double").alias("words"), F.sum(slope.cast("decimal(38,6)")).cast("double").alias("slope"))
        )
        near = F.coalesce(F.abs(F.col("words") - target) <= _NEAR * target, F.lit(False)) | (F.col("hi") - F.col("lo") < 1e-15)
        low, high = F.when(F.col("words") < target, F.col("tilt")).otherwise(F.col("lo")), F.when(F.col("words") >= target, F.col("tilt")).otherwise(F.col("hi"))
        # Newton on the logarithm of the words, which is closer to a line
        step = F.col("tilt") + F.log(target / F.col("words")) * F.col("words") / F.col("slope")
        inside = F.coalesce((step > F.col("l")) & (step < F.col("h")), F.lit(False))
        state = stage_table(
            state.join(sums, "number", "left").withColumn("now", F.col("done") | near).withColumn("l", low).withColumn("h", high)
            .withColumn("tilt", F.when(F.col("now"), F.col("tilt")).when(inside, step).otherwise((F.col("l") + F.col("h")) / 2))
            .withColumn("lo", F.when(F.col("now"), F.col("lo")).otherwise(F.col("l"))).withColumn("hi", F.when(F.col("now"), F.col("hi")).otherwise(F.col("h")))
            .withColumn("done", F.col("now")).select(*state.columns),
            "tilts",
        )
        if state.filter("not done").isEmpty():
            break
    return state


def _round(rows: pd.DataFrame) -> pd.DataFrame:
    """Whole copies of one group, by error diffusion from the longest document to the shortest."""
    rows = rows.sort_values(["size", "doc_id"], ascending=[False, True], kind="stable", na_position="last")
    open_words, copies = 0.0, np.zeros(len(rows), np.int64)
    for k, (size, rate) in enumerate(zip(rows["size"].to_numpy(), rows["rate"].to_numpy(), strict=True)):
        if size > 0:
            open_words += size * rate
            copies[k] = min(max(round(open_words / size), math.floor(rate + 1e-9)), math.ceil(rate - 1e-9))
            open_words -= size * copies[k]
    return rows.drop(columns=["number", "rate", "part"]).assign(copies=copies)


def balance(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0, group_rows: int = 500, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken (copies * size) and the ``carry`` columns of every document."""
    sized = stage_table(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), *carry), "sizes")
    histogram = stage_table(sized.groupBy("source", "size").agg(F.count("*").alias("documents")), "size-histogram")
    sources = histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("documents")).alias("source_size"), F.sum("documents").alias("rows"))
    sources = stage_table(targets(sources, weights, share, most), "sources")
    numbered = histogram.filter("size > 0").join(sources.select("number", F.col("source").alias("s")), F.col("source").eqNullSafe(F.col("s"))).select("number", "size", "documents")
    tilts = solve(stage_table(numbered, "numbered-histogram"), sources, most).withColumnRenamed("source", "s")
    rated = sized.join(tilts, F.col("source").eqNullSafe(F.col("s"))).select(
        "doc_id", "source", "size", "source_size", "target", *carry, "number", _rate(F.col("tilt"), F.col("size"), most).alias("rate"),
        F.pmod(F.xxhash64("doc_id", F.lit("mix")), F.ceil(F.col("rows") / group_rows)).alias("part"),
    )
    schema = ", ".join(f"`{c}` {rated.schema[c].dataType.simpleString()}" for c in ["doc_id", "source", "size", "source_size", "target", *carry])
    return rated.groupBy("number", "part").applyInPandas(_round, schema + ", copies long").withColumn("taken", F.col("copies") * F.col("size"))


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it has copies."""
    row, copies, copy = (free_name(n, docs) for n in ("_row", "_copies", "_copy"))
    rows = stage_table(docs.withColumn(row, F.monotonically_increasing_id()), "mix-input")  # written, so that row numbers stay
    taken = balance(rows.select("doc_id", "source", "text", row), carry=[row], **how).filter("copies > 0").select(row, F.col("copies").alias(copies))
    return rows.join(taken, row).withColumn(copy, F.explode(F.array_repeat(F.lit(0), F.col(copies).cast("int")))).select(*docs.columns)
