"""Connected components of an edge table by alternating star contraction.

Every round hangs the larger neighbours of each node on its smallest neighbour,
then the smaller ones, until only stars are left. The smallest neighbour comes
from a grouped minimum (combined before the shuffle) and is joined back, so a
node with very many links is neither gathered nor collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node that has an edge to another node and isn't the
    smallest of its component; root is that smallest node. Loops and repeated
    edges are harmless, edges with a null end are left out."""
    edges = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges = cut_lineage(edges)

    def mark(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()

    before = mark(edges)
    if before[0] == 0:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    for _ in range(max_rounds):
        edges = cut_lineage(_small_star(_large_star(edges)))
        now = mark(edges)
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
    raise RuntimeError(f"no stars after {max_rounds} rounds")
