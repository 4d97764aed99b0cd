"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyhealth.llm.common import staged


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row.n, row.x


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest one."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b"), F.col("m").alias("a")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node's smaller neighbours, and itself, move to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("b"), F.col("m").alias("a"))
    own = least.select(F.col("u").alias("b"), F.col("m").alias("a"))
    return moved.unionByName(own).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (smallest node of its component) of every node in
    ``edges`` (columns a, b). The rounds end when nothing moves, which takes
    about log2 of the longest path; every round is a written table."""
    edges = staged(edges.select("a", "b").where("a <> b").distinct(), "edges")
    before = _state(edges)
    while True:
        edges = staged(_small_star(_large_star(edges)).select("a", "b"), "edges")
        now = _state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
