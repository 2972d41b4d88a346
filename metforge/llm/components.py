"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metforge.session import stored


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Links of each node moved to the least node around it: those to larger nodes, or else to smaller ones.

    ``links`` has (a, b) with a > b.
    """
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if large:
        around = both
    else:
        around = links
    least = around.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("m", "a").alias("m"))
    moved = around.join(least, around["a"] == least["node"])
    if large:
        moved = moved.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("node").alias("a"), F.col("m").alias("b")))
    return moved.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of every node that has a link ``(a, b)``; the component is its least node.

    Each round is written to the shared folder, and only a count and a checksum reach the driver.
    """
    now = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = lambda t: tuple(t.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
    before = state(now)
    while before[0]:
        now = stored(_star(_star(now, True), False), "links")
        after = state(now)
        if after == before:
            break
        before = after
    ids = now.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("node"), "component")
    return ids.unionByName(ids.select(F.col("component").alias("node"), "component").distinct())
