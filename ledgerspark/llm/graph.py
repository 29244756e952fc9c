"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm import base


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``edges`` (two long columns): component is the smallest node reachable.

    Large-star and small-star steps by turns: every node passes its smallest neighbour on to its larger (smaller)
    neighbours, until the edges are the stars around the smallest nodes. Each round is a written table, so lineage stays
    short. Nodes with very many neighbours are split by Spark's skew join, as the other side has one row per node.
    Null ends and loops are left out; an empty table gives an empty result.
    """
    now = base.materialize(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct(), "edges")
    state = _state(now)
    while state[0]:
        after = base.materialize(_small_star(_large_star(now)), "edges")
        new = _state(after)
        base.discard(now)
        now = after
        if new == state:
            break
        state = new
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    """Number of edges and a checksum that does not depend on their order."""
    mixed = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.sum(mixed.bitwiseAND(F.lit(0xFFFFFFFF))), F.sum(F.shiftrightunsigned(mixed, 32))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v"), F.col("u")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    return both.join(least, F.col("u") == F.col("w")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges lead from larger to smaller nodes here."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least.withColumnRenamed("u", "w"), F.col("u") == F.col("w")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()
