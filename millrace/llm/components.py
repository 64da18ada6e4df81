"""Connected components of a graph that is given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import staged

MAX_ROUNDS = 60


def _pairs(edges: DataFrame) -> DataFrame:
    """Distinct edges with the smaller node first."""
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the smallest node among them."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b")


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    joined = edges.join(least, "b")
    own, others = joined.select(F.col("m").alias("a"), "b"), joined.select(F.col("m").alias("a"), F.col("a").alias("b"))
    return own.unionAll(others)


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a, b``); the root is the smallest node.

    Rounds of star contractions until every node points at its root; each round is a table
    of the scratch folder. A hub is aggregated before it is joined.
    """
    now = staged(_pairs(edges), "edges")
    for _ in range(MAX_ROUNDS):
        after = staged(_pairs(_small_star(_pairs(_large_star(now)))), "edges")
        if _mark(after) == _mark(now):
            roots = after.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
            return roots.unionAll(after.select(F.col("b").alias("node"), F.col("a").alias("root")))
        now = after
    raise RuntimeError("the components did not settle")


def _mark(edges: DataFrame) -> tuple:
    hashed = F.xxhash64("a", "b").cast("decimal(20,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(hashed)).first())
