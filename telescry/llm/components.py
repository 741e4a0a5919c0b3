"""Connected components of links, by stars: every job halves what is left of long chains, no links go to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telescry.llm.common import stage_table


def connected(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b), component being the smallest node reachable.

    Large stars hang the larger neighbours of a node on its smallest one, small stars the smaller neighbours; the links
    that no longer change are stars around the components' smallest nodes.
    """
    now = stage_table(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "stars")
    while True:
        both = now.union(now.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).filter("a <> b").distinct()
        large = stage_table(large, "stars")
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).filter("a <> b").union(low.select("a", F.col("low").alias("b"))).distinct()
        following = stage_table(small, "stars")
        if now.count() == following.count() and now.join(following, ["a", "b"], "left_anti").isEmpty():
            break
        now = following
    ends = now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    return ends.union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
