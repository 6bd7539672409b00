"""Connected components of a link table by alternating large-star and small-star steps.

Every step is a pre-aggregated minimum per node and a join of the links with it.  The minima are written
before the join: both of its sides are then plain exchanges, so adaptive execution can split a node with a
third of all links, which has one row on the other side.  Each round is written to the shared folder, and
the one before it is deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import spent, written


def _large_star(links: DataFrame, label: str) -> DataFrame:
    """From each node, larger neighbours move to its least neighbour (links: a > b)."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # Nodes that are less than all their neighbours, such as the centres of stars, keep their links.
    least = both.groupBy("a").agg(F.min("b").alias("m")).where("m < a").select(F.col("a").alias("b"), "m")
    least = written(least, f"{label}_least")
    return _next(links.join(least, "b", "left").select("a", F.coalesce("m", "b").alias("b")), label, links, least)


def _small_star(links: DataFrame, label: str) -> DataFrame:
    """From each node, it and its smaller neighbours move to the least of them."""
    least = written(links.groupBy("a").agg(F.min("b").alias("m")), f"{label}_least")
    moved = links.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _next(moved.unionByName(least.select("a", F.col("m").alias("b"))), label, links, least)


def _next(links: DataFrame, label: str, *before: DataFrame) -> DataFrame:
    links = written(links.distinct(), label)
    spent(*before)
    return links


def connected(links: DataFrame, label: str = "components") -> DataFrame:
    """(a, b), b the least node of a's component, for each node a that isn't it.  ``links``: columns a, b."""
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where(F.col("a") != F.col("b")).distinct()
    links, before = written(links, label), None
    while True:
        mark = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark[0] == 0 or mark == before:
            return links
        before = mark
        links = _small_star(_large_star(links, label), label)
