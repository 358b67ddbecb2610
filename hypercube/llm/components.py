"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hypercube.llm.common import written


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node links to the node's smallest neighbour."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.filter("b > a").join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours link to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = (down.join(least, "a").filter("b <> m")
             .select(F.col("b").alias("a"), F.col("m").alias("b")))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """Rows ``(node, root)`` for every node of ``edges(a, b)`` but the roots.

    Alternates large-star and small-star rounds until the edge list, compared
    by count and hash sum, no longer changes; it then links each node to the
    smallest node of its component.  Each round is written to the shared
    folder.  Minima are pre-aggregated before they are shuffled, so a node
    with very many neighbours is never gathered.  No edges give no rows.
    """
    current = written(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    before = _state(current)
    while before[0]:
        current = written(_small_star(_large_star(current)), "edges")
        after = _state(current)
        if after == before:
            break
        before = after
    return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
