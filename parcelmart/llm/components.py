"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmart.llm.common import stored


def _star(edges: DataFrame) -> DataFrame:
    """Every neighbour of a node linked to the smallest of them; columns ``a`` > ``b`` in and out.

    Large star: a node's larger neighbours move to its smallest; small star: its smaller neighbours and itself do.
    Minima combine before the shuffle, and the joins have nothing above them that needs a key's rows together, so a
    node with very many neighbours is split among tasks.
    """
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = both.filter("b > a").join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    large = stored(large.union(edges.join(smallest, "a").filter("m < a").select("a", F.col("m").alias("b"))).distinct(), "large")
    low = large.groupBy("a").agg(F.min("b").alias("m"))
    moved = large.join(low, "a").filter("b <> m").select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
    return stored(moved.union(low.select("a", F.col("m").alias("b"))).distinct(), "small")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id`` and ``component`` (the smallest id that can be reached) of every node that has an edge to another.

    NULL ends and loops are ignored, repeated edges count once. Rounds go on until the edges form stars; their number
    grows with the logarithm of the longest chain.
    """
    high, low = F.greatest(a, b).cast("bigint"), F.least(a, b).cast("bigint")
    known = edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    current = stored(known.select(high.alias("a"), low.alias("b")).distinct(), "edges")
    while True:
        # Done when no smaller end is itself linked to something smaller, and no node to two.
        ends = current.select(F.col("b").alias("id"), F.lit(0).alias("down")).distinct()
        starts = current.groupBy("a").agg(F.count(F.lit(1)).alias("down")).withColumnRenamed("a", "id")
        both = ends.union(starts).groupBy("id").agg(F.count(F.lit(1)).alias("roles"), F.max("down").alias("down"))
        if both.filter("roles > 1 OR down > 1").isEmpty():
            return current.select(F.col("a").alias("id"), F.col("b").alias("component"))
        current = _star(current)
