"""Cumulative-snapshot collapse: logs that repeat a conversation after each turn keep only its longest state.

The turns of a conversation are numbered in order.  The hash of a prefix is the XOR of the 128-bit hashes of its turns, each
taken with its place, so it rolls from turn to turn and adds up over pieces of a conversation: turns are numbered and
hashed in pieces of ``_PIECE`` turn numbers, and pieces are put together by their counts and hashes.  A conversation whose
whole hash is the prefix hash of a longer one goes by an anti-join; of equal ones the smallest conv_id stays.  What is left is
rendered in a chat template.

Defined cases: null roles and texts are told apart from empty ones in the hash and rendered as empty; null turns come first;
turns with the same number are ordered by role and text, and a row that repeats another in every column is a turn of its own;
rows with a null conv_id are left out; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from telescry.llm.common import stage_table

_PIECE = 256


def _lane(seed: str) -> Column:
    """64 bits of the turn's content and place."""
    content = F.concat_ws("\x1f", F.lit(seed), F.col("place").cast("string"), F.coalesce(F.concat(F.lit("="), F.col("role")), F.lit("-")), F.coalesce(F.concat(F.lit("="), F.col("text")), F.lit("-")))
    return F.xxhash64(F.sha2(content, 256))


def prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, piece, place (from 1), role, text and the hash lanes ``a``, ``b`` of the conversation up to the turn."""
    rows = turns.filter("conv_id is not null").select("conv_id", "turn", "role", "text", F.coalesce(F.floor(F.col("turn") / _PIECE).cast("long"), F.lit(-(1 << 60))).alias("piece"))
    inner = W.partitionBy("conv_id", "piece").orderBy("turn", "role", "text")
    local = rows.withColumn("local", F.row_number().over(inner))
    counts = local.groupBy("conv_id", "piece").agg(F.count("*").alias("turns"))
    before = W.partitionBy("conv_id").orderBy("piece").rowsBetween(W.unboundedPreceding, -1)
    places = counts.withColumn("first", F.coalesce(F.sum("turns").over(before), F.lit(0)))
    placed = local.join(places, ["conv_id", "piece"]).withColumn("place", F.col("first") + F.col("local")).drop("turns", "first")
    hashed = stage_table(placed.withColumn("a", _lane("a")).withColumn("b", _lane("b")), "chat-turns")
    whole = hashed.groupBy("conv_id", "piece").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    starts = whole.select("conv_id", "piece", F.coalesce(F.bit_xor("a").over(before), F.lit(0)).alias("a0"), F.coalesce(F.bit_xor("b").over(before), F.lit(0)).alias("b0"))
    rolling = W.partitionBy("conv_id", "piece").orderBy("place").rowsBetween(W.unboundedPreceding, 0)
    rolled = hashed.withColumn("a", F.bit_xor("a").over(rolling)).withColumn("b", F.bit_xor("b").over(rolling)).join(starts, ["conv_id", "piece"])
    return rolled.select("conv_id", "piece", "place", "role", "text", F.col("a").bitwiseXOR(F.col("a0")).alias("a"), F.col("b").bitwiseXOR(F.col("b0")).alias("b"))


def maximal(turns: DataFrame) -> DataFrame:
    """The turns (conv_id, piece, place, role, text, turns) of conversations that no other one continues or repeats."""
    rolled = stage_table(prefixes(turns), "chat-prefixes")
    lengths = rolled.groupBy("conv_id").agg(F.max("place").alias("turns"))
    marked = stage_table(rolled.select("conv_id", "place", "a", "b").join(lengths, "conv_id"), "chat-marks")
    inner = marked.filter("place < turns").select("place", "a", "b").distinct()
    ends = marked.filter("place = turns").groupBy(F.col("turns").alias("place"), "a", "b").agg(F.min("conv_id").alias("conv_id"))
    kept = ends.join(inner, ["place", "a", "b"], "left_anti").select("conv_id", F.col("place").alias("turns"))
    return rolled.drop("a", "b").join(kept, "conv_id")


def rendered(turns: DataFrame, start: str = "<|", end: str = "|>") -> DataFrame:
    """conv_id, n_turns and text: each turn as its role between marks, a line feed, its text and a line feed."""
    line = F.concat(F.lit(start), F.coalesce("role", F.lit("")), F.lit(end + "\n"), F.coalesce("text", F.lit("")), F.lit("\n"))
    texts = lambda key, value: F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct(key, value))), lambda s: s[value]))
    pieces = maximal(turns).withColumn("line", line).groupBy("conv_id", "piece", "turns").agg(texts("place", "line").alias("line"))
    return pieces.groupBy("conv_id", F.col("turns").alias("n_turns")).agg(texts("piece", "line").alias("text"))
