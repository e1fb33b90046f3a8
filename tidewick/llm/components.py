"""Connected components by alternating star contraction, on tables only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewick.llm.common import kept


def components(links: DataFrame, nodes: tuple[str, str] = ("a", "b")) -> DataFrame:
    """(node, component) for every node in ``links``; component is the least node that can be reached.

    Each round links every node to the least node of its neighbourhood, first the larger neighbours,
    then the smaller ones; a path of n nodes is done in about log n rounds. Each round's links are a
    written table, so a round restarts from it. The number of links never grows. A null node or a link
    of a node to itself adds nothing; no links give no rows.
    """
    a, b = (F.col(c) for c in nodes)
    links = kept(links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
                 .filter("a != b").distinct(), "links")
    while True:
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = kept(large.distinct(), "links")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(
            F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("l"))
        small = kept(small.select("l.a", "l.b").filter("a != b").distinct(), "links")
        if _done(small, links):
            return small.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                small.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        links = small


def _done(new: DataFrame, old: DataFrame) -> bool:
    """Whether a round changed nothing: same number of links and the same sums over their hashes."""
    def mark(df: DataFrame):
        h = F.xxhash64("a", "b")
        return df.agg(F.count(F.lit(1)), F.sum(h.bitwiseAND(0xFFFFFFFF)), F.sum(F.shiftrightunsigned(h, 32))).first()
    return mark(new) == mark(old)
