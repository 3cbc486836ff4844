"""Connected components without a driver-side graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kinlink.llm.store import cut, drop


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (a, b), component being the smallest node reachable.

    Alternating large-star and small-star steps: each round is aggregations and equi-joins over edges, the number of
    rounds grows with the logarithm of the graph. Each round is written to the shared folder. Self-loops, repeated
    edges and rows with a null end are ignored; an empty table gives an empty table.
    """
    now = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a is not null and b is not null and a <> b").distinct())
    state = None
    while True:
        after = cut(_small_star(_large_star(now)))
        drop(now)
        now = after
        new = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == state or not new[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b").distinct())
        state = new


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the smallest of it and its neighbours."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
    rest = edges.join(least, F.col("a") == F.col("u")).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.union(least.select("u", "m")).distinct()
