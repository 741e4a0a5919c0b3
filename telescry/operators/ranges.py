"""Integer range joins (C6, D6, D7) as equi joins.

A range ``[lo, hi]`` is cut into aligned power-of-two blocks (at most two per level).  A probe value is
expanded once per level that occurs and joined on ``(key, level, value >> level)``.  Overlapping ranges
are reduced to one winner per block before the join, so nothing multiplies on the fact side, ranges may
be as wide as they like and no key is sorted or gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_PORT = 65535


def range_table(df: DataFrame, lo: str, hi: str, key: str, value: str, fold_key: bool = True,
                swap: bool = True) -> DataFrame:
    """Distinct ``key, lo, hi, value``; null and non-numeric bounds are skipped.

    ``fold_key`` lower-cases the key and ``swap`` turns reversed bounds round (the lookup cache does
    both, the server-side range dictionary neither: there a reversed range is empty).
    """
    a, b = F.col(lo).try_cast("bigint"), F.col(hi).try_cast("bigint")
    k = F.col(key).cast("string")
    rows = df.select(
        (F.lower(k) if fold_key else k).alias("key"),
        (F.least(a, b) if swap else a).alias("lo"),
        (F.greatest(a, b) if swap else b).alias("hi"),
        F.col(value).alias("value"),
        a.isNotNull().alias("_a"), b.isNotNull().alias("_b"),
    )
    rows = rows.filter(F.col("_a") & F.col("_b") & F.col("key").isNotNull() & (F.col("lo") <= F.col("hi")))
    return rows.select("key", "lo", "hi", "value").distinct()


def _blocks(ranges: DataFrame) -> DataFrame:
    """``key, level, block, cand``: the aligned blocks of each ``[lo, hi]``, at most two a level, none larger than the range."""
    levels = F.sequence(F.lit(0), F.length(F.bin(F.col("hi") - F.col("lo") + 1)) - 1)
    rows = ranges.select("key", "lo", "hi", "value", F.explode(levels).alias("level"))
    size = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("level"))
    first = F.call_function("shiftright", F.col("lo") + size - 1, F.col("level"))
    end = F.call_function("shiftright", F.col("hi") + 1, F.col("level"))
    odd = lambda c: F.pmod(F.col(c), F.lit(2)) == 1
    inner = rows.select("*", first.alias("_first"), end.alias("_end")).filter("_first < _end")
    ends = F.array(F.when(odd("_first"), F.col("_first")), F.when(odd("_end"), F.col("_end") - 1))
    cut = inner.select("key", "level", F.struct("lo", "hi", "value").alias("cand"), F.explode(ends).alias("block"))
    return cut.filter("block IS NOT NULL")


def range_index(ranges: DataFrame) -> DataFrame:
    """Winner per block: the value of the range with the smallest ``(lo, hi, value)``."""
    return _blocks(ranges).groupBy("key", "level", "block").agg(F.min("cand").alias("cand"))


def range_resolve(probes: DataFrame, index: DataFrame) -> DataFrame:
    """Winner per distinct ``key, v`` of the probes: ``key, v, value``; misses are left out."""
    distinct = probes.filter(F.col("key").isNotNull() & F.col("v").isNotNull()).distinct()
    levels = index.agg(F.collect_set("level")).scalar()  # one value: at most 63 numbers
    cand = distinct.withColumn("_levels", levels).select("key", "v", F.explode("_levels").alias("level"))
    cand = cand.withColumn("block", F.call_function("shiftright", F.col("v"), F.col("level")))
    # the planner takes the probes for as few as before they were exploded: it must not broadcast them
    hits = cand.hint("merge").join(index, ["key", "level", "block"])
    return hits.groupBy("key", "v").agg(F.min("cand").alias("cand")).select("key", "v", F.col("cand.value").alias("value"))


def range_join(df: DataFrame, index: DataFrame, key: Column, value: Column, out: str) -> DataFrame:
    """Value of the covering range with the smallest ``(lo, hi)``, null if no range covers it."""
    keyed = df.withColumn("_rk", key).withColumn("_rv", value.try_cast("bigint"))
    best = range_resolve(keyed.select(F.col("_rk").alias("key"), F.col("_rv").alias("v")), index)
    side = best.select(F.col("key").alias("_bk"), F.col("v").alias("_bv"), F.col("value").alias(out))
    joined = keyed.join(side, (F.col("_rk") == F.col("_bk")) & (F.col("_rv") == F.col("_bv")), "left")
    return joined.drop("_rk", "_rv", "_bk", "_bv")


def port_dimension(index: DataFrame) -> DataFrame:
    """The whole 16-bit port space resolved once: ``key, port, value`` for every covered port.

    Ports have 16 bits: a flow whose port is any other number has no application, whatever the ranges say.

    At most 65536 rows per key, whatever the facts hold, so fact joins need neither a pass over their
    distinct ports nor a range condition.
    """
    start = F.call_function("shiftleft", F.col("block"), F.col("level"))
    end = F.call_function("shiftleft", F.col("block") + 1, F.col("level")) - 1
    inside = index.select("key", "cand", F.greatest(start, F.lit(0)).alias("a"), F.least(end, F.lit(MAX_PORT)).alias("b"))
    ports = inside.select("key", "cand", F.explode(F.when(F.col("a") <= F.col("b"), F.sequence("a", "b"))).alias("port"))
    best = ports.groupBy("key", "port").agg(F.min("cand").alias("cand"))
    return best.select("key", "port", F.col("cand.value").alias("value"))


def cache_ranges(applications: DataFrame) -> DataFrame:
    """D6 index: keys folded, reversed bounds turned, empty ids count as unknown."""
    rows = range_table(applications, "port_range_min", "port_range_max", "protocol", "id")
    return range_index(rows.filter(F.col("value").isNotNull() & (F.col("value") != "")))


def dictionary_ranges(applications: DataFrame) -> DataFrame:
    """D7 index: keys and bounds as they are."""
    return range_index(range_table(applications, "port_range_min", "port_range_max", "protocol", "id",
                                   fold_key=False, swap=False))
