"""Connected components of a graph in DataFrames, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_written, written


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _hooked(pairs: DataFrame, keep: str) -> DataFrame:
    """Each u's neighbours v, given the least of u and all its neighbours as m."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.join(least, "u").select("u", "v", F.least("u", "m").alias("m")).where(keep)


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Edges (u, v) of 64-bit ids to rows (node, root): root is the least node of node's component.

    Every round aggregates to minima before it joins, so a hub with most of the edges is never
    gathered in one task. Self-loops and repeated edges are harmless; nodes in no edge are absent.
    """
    edges = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = _mark(edges)
    for _ in range(rounds):
        if not mark[0]:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _hooked(both, "v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct()
        after = written(small, "edges")
        drop_written(edges)
        edges, before, mark = after, mark, _mark(after)
        if mark == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
