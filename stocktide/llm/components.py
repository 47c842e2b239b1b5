"""Connected components by alternating large and small stars.

Each half step replaces a node's neighbours by the smallest node near it, so links only
ever point to smaller nodes and long chains halve. Every step is one aggregation and
one join over (node, node) rows, written to the shared folder; no list of a node's
neighbours is ever built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide.session import staged

MOST_ROUNDS = 60  # rounds grow with the logarithm of the longest chain


def _both(links: DataFrame) -> DataFrame:
    return links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    near = _both(links)
    least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return near.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b").filter("a < b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    # a < b: every node b looks at its smaller neighbours
    least = links.groupBy("b").agg(F.min("a").alias("m"))
    moved = links.join(least, "b")
    return (
        moved.select(F.col("m").alias("a"), F.col("a").alias("b")).filter("a < b")
        .unionAll(least.select(F.col("m").alias("a"), "b")).distinct()
    )


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` (smallest node reachable) for every node of ``links`` (a, b) that
    is not the smallest of its component itself."""
    current = staged(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "links")
    mark = _mark(current)
    for _ in range(MOST_ROUNDS):
        current = staged(_small_star(_large_star(current)), "links")
        before, mark = mark, _mark(current)
        if mark == before:
            return current.select(F.col("b").alias("node"), F.col("a").alias("component"))
    raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
