"""Connected components of a link table by alternating large-star and
small-star steps: every step is joins and partial aggregates over link rows,
staged as a table, so nothing is collected and no component meets in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first()
    return row[0], row[1]


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the least node it knows."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links itself and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a long, b long): component
    is the least node reachable. Self links and nulls are ignored; an empty
    table gives no rows."""
    edges = staged(links.where("a <> b").select("a", "b").distinct(), "links")
    before = _digest(edges)
    while True:
        edges = staged(_large_star(edges).where("a <> b").distinct(), "large_star")
        edges = staged(_small_star(edges).where("a <> b").distinct(), "small_star")
        now = _digest(edges)
        if now == before:
            break
        before = now
    pairs = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return pairs.union(edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
