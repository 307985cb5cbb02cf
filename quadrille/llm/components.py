"""Connected components of an edge table, without collecting edges or labels to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import materialise

MAX_ROUNDS = 60
#: Edges of one hub that one task can take; tables with fewer are joined without looking for hubs.
FEW = 200_000


def components(edges: DataFrame) -> DataFrame:
    """(node, component: its least node) for every node of the edges (a, b), by large-star and small-star rounds.

    Both kinds of round only re-hang edges at the least neighbour, so the edges' number never grows, and the rounds are
    about as many as the logarithm of the longest path. Null ends and loops are left out; an empty table gives none. Hubs
    with over a thousandth of the edges, fewer than two thousand, are broadcast, so that no task gets all of one's edges.
    """
    edges = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    edges, mark = _settled(edges)
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        large = _join(both, least, 2 * mark[0]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        hung = _join(large, least, mark[0])
        small = hung.select("v", "m").union(least.select("u", "m")).toDF("u", "v").where("u != v").distinct()
        edges, now = _settled(small)
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _join(rows: DataFrame, least: DataFrame, total: int) -> DataFrame:
    if total <= FEW:
        return rows.join(least.drop("n"), "u")
    hot, cold = (least.where(f"n * 1000 {sign} {total}").drop("n") for sign in (">", "<="))
    return rows.join(F.broadcast(hot), "u").unionByName(rows.join(F.broadcast(hot.select("u")), "u", "left_anti").join(cold, "u"))


def _settled(edges: DataFrame) -> tuple[DataFrame, tuple]:
    edges = materialise(edges, "edges")
    return edges, tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
