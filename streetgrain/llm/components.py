"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each vertex point to the smallest vertex around it."""
    around = _both(edges)
    least = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    moved = around.where("b > a").join(least, "a")
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each vertex, and the vertex, point to the smallest of them. Edges run from large to small."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a")
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every vertex that is not the smallest of its component.

    ``edges`` has long columns ``a`` and ``b``; repeats and loops do no harm.
    Each pass is written to the shared folder, so lineage stays short and a lost
    executor costs one pass. No vertex gathers its neighbours: a pass is a
    minimum per vertex, joined back, and Spark splits the join at hubs.
    """
    now = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    mark = _mark(now)
    while mark[0]:
        now = written(_small_star(_large_star(now).distinct()).where("a <> b").distinct(), "edges")
        new = _mark(now)
        if new == mark:
            break
        mark = new
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
