"""Connected components by alternating large-star and small-star rounds.

Each round joins edges with each node's smallest neighbour; every round's
edges are a written table in the shared folder, so lineage stays short and a
lost executor re-reads files.  The smallest neighbours are a written table
too: the join then has an exchange of its own on both sides, and Spark splits
the partition of a node with very many neighbours (it cannot where the join
shares the aggregate's partitioning).  Nothing but two numbers a round (edge
count and a sum of edge hashes) reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Edges that a task of a round writes, about (16 bytes each).
TASK_EDGES = 250_000


def _print(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(r)


def _written(rows: DataFrame, n: int) -> DataFrame:
    """A stage table in as many files as ``n`` edges need: a few components
    do not make a file for each shuffle partition in each round."""
    return cut_lineage(rows.coalesce(1 + n // TASK_EDGES), "edges")


def _large_star(edges: DataFrame, n: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = _written(least.select("u", F.least("u", "m").alias("m")), n)
    return both.where("v > u").join(least, "u").select(
        F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame, n: int) -> DataFrame:
    least = _written(edges.groupBy("u").agg(F.min("v").alias("m")), n)
    moved = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(u, v): each node that has an edge, except the smallest of its
    component, with that smallest node.  Any ordered key type will do;
    self-loops, null ends, repeated and reversed edges are allowed."""
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"),
                     F.col(a).isNull().alias("x"), F.col(b).isNull().alias("y"))
    e = cut_lineage(e.where("u > v and not x and not y").select("u", "v").distinct(), "edges")
    seen = _print(e)
    while seen[0]:
        e = _written(_small_star(_written(_large_star(e, seen[0]), seen[0]), seen[0]), seen[0])
        now = _print(e)
        if now == seen:
            break
        seen = now
    return e
