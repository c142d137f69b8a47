"""Connected components of a table of links, by alternating star contraction in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.session import store


def connected_components(links: DataFrame) -> DataFrame:
    """Rows (id, component): the smallest id reachable, for every id in ``links`` (a, b).

    Each round points all larger neighbours of an id at its smallest neighbour (large star),
    then all smaller ones (small star), until the links are stars around smallest ids. Every
    round is a stored table; only two tests for emptiness come to the driver. Minima are combined
    before the shuffle. A hub's links are joined to its minimum, not gathered in a group.
    """
    edges = store(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a <> b")
        .distinct(),
        "links",
    )
    while not _is_stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = store(large.where("a <> b").distinct(), "large-star")
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(lower, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            lower.select("a", F.col("m").alias("b"))
        )
        edges = store(small.where("a <> b").distinct(), "small-star")
    ends = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return ends.unionByName(roots)


def _is_stars(edges: DataFrame) -> bool:
    """Every id has one smaller neighbour, which has none itself."""
    several = edges.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not several.isEmpty():
        return False
    inner = edges.select(F.col("b").alias("a")).join(edges, "a", "left_semi")
    return inner.isEmpty()
