"""Connected components of a distributed graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(id, component): of each id in ``edges`` (a, b) the smallest id it is connected to.

    Large star and small star in turn: every node hangs its larger neighbours, then
    its smaller ones, on the smallest of its neighbourhood, until nothing changes. The
    minima are combined in the map tasks; the joins back are equi-joins, whose hot
    keys (a centre with many neighbours) AQE can split. Edges never exceed the
    input's, and each half round is written to the shared folder. The driver sees a
    count and a sum per round.
    """
    now = saved(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    before = None
    for _ in range(most_rounds):
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # the minima are written, so that the joins deal both sides anew and can split a hot centre
        least = saved(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "edge-minima")
        # large star: (neighbour, least) for neighbours above the node itself
        large = now.select(F.col("b").alias("a"), F.col("a").alias("v")).join(least, "a").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = saved(large.distinct(), "edges")
        # small star: the node and its smaller neighbours hang on the smallest of them
        small_least = saved(large.groupBy("a").agg(F.min("b").alias("m")), "edge-minima")
        small = large.join(small_least, "a").select(F.col("b").alias("v"), "m", "a")
        hung = small.select(F.col("v").alias("a"), F.col("m").alias("b")).union(small.select("a", F.col("m").alias("b")))
        now = saved(hung.filter("a <> b").distinct(), "edges")
        # ids may be any numbers: their digests are summed, as decimals
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if mark == before:
            break
        before = mark
    else:
        raise RuntimeError("components did not settle")
    stars = now.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return stars.union(now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
