"""Connected components: of links too many for one machine, and of those within one task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendloom.llm.common import cut_lineage


def _with_least(links: DataFrame) -> DataFrame:
    """links (a, b) with m: the least of a and all its neighbours b.

    The minimum is pre-aggregated, and kept before it is joined, so that Spark can split the join at hub nodes.
    """
    least = cut_lineage(links.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
    return links.join(least, "a")


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component): the least node that each linked node reaches. links has two columns of one sortable type.

    Alternates large-star and small-star steps (each an aggregation and a join on the node) until nothing changes; the
    number of rounds grows with the logarithm of a component's size. Each round is cut off by a checkpoint. Self-links
    and repeated links are fine, links with a null are left out, no links give no rows.
    """
    a, b = links.columns
    links = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    links = cut_lineage(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    if links.isEmpty():
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    state = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _with_least(both).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        small = _with_least(large).select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x")).select("x.*")
        links = cut_lineage(small.where("a <> b").distinct())
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.count_distinct("b")).first()
        if now == state or now[0] == 0:
            break
        state = now
    node = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return node.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the sets of a[i] and b[i] for all i at once. root[x] is x for the least of a set, else one that is less."""
    while len(a):
        a, b = least_of(root, a), least_of(root, b)
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))


def least_of(root: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The least of each x's set."""
    while True:
        up = root[x]
        if (up == x).all():
            return x
        x = up
