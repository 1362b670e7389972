"""Connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlework.session import stored


def components(edges: DataFrame) -> DataFrame:
    """``id`` and ``component`` (its smallest id) of every node of the edges (a, b).

    Alternating large and small stars: each round links neighbours to the smallest one
    nearby, until nothing changes. Work and rows of a round are those of the edges; a
    node of many edges is split by the skew join. Loops and repeated edges do no harm.
    """
    edges = stored(_tidy(edges.select("a", "b")), "edges")
    seen = None
    while (state := _state(edges)) != seen:
        seen = state
        edges = stored(_small_star(_large_star(edges)), "edges")
    labels = edges.select(F.col("b").alias("id"), F.col("a").alias("component"))
    roots = edges.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct()
    return labels.unionByName(roots)


def _tidy(edges: DataFrame) -> DataFrame:
    """The smaller end first, no loops, no copies."""
    return (
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )


def _state(edges: DataFrame):
    # Sums of hashes of all edges: they change if any edge does.
    return tuple(
        edges.agg(
            F.count("*"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
            F.sum(F.xxhash64("b", "a").cast("decimal(38,0)")),
        ).first()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest one (or the node)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return _tidy(both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    joined = edges.join(least, "b")
    return _tidy(
        joined.select(F.col("m").alias("a"), F.col("a").alias("b")).unionByName(
            least.select(F.col("m").alias("a"), "b")
        )
    )
