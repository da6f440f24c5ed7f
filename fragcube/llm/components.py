"""Connected components of a table of links, by alternating stars.

Each round lets every node hand its larger neighbours to its smallest one, then
its smaller neighbours to their smallest; the links of a component shrink to a
star around its smallest node in a number of rounds that grows with the
logarithm of its diameter.  Links stay a table, each round is one job that writes to the
shared folder, and only a few sums per round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fragcube.session import materialise_observed


def _stored(links: DataFrame) -> tuple[DataFrame, dict]:
    """The links, stored, and a signature of them, taken on the way."""
    sums = F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum"), F.bit_xor(F.xxhash64("b", "a")).alias("xor")
    return materialise_observed(links, "links", *sums)


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """``links`` point from the larger node ``a`` to the smaller ``b``."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    handed = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
    return handed.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and the smallest ``component`` node, for nodes that are not the smallest of their component.

    ``links``: two long columns ``a`` and ``b``; nulls and loops are ignored.
    """
    ends = links.filter("a is not null and b is not null and a <> b")
    current, seen = _stored(ends.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while seen["n"]:
        current, now = _stored(_small_star(_large_star(current)))
        if now == seen:
            break
        seen = now
    return current.select(F.col("a").alias("node"), F.col("b").alias("component"))
