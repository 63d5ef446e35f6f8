"""Connected components of a distributed edge list by alternating star steps.

A large star ties every larger neighbour of a node to the smallest one, a small star does so for
the smaller neighbours; both keep the components, and repeating them leaves one star per component.
Hubs are joined by ``attach_by_key``, which leaves the rows of hot nodes where they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.operators.scale import attach_by_key
from basketry.session import cut


def _with_least(edges: DataFrame) -> DataFrame:
    """(a, b, least): least is the smallest of a and all its b."""
    least = edges.groupBy("a").agg(F.least("a", F.min("b")).alias("least"), F.count("*").alias("degree"))
    return attach_by_key(edges, least, "a", "degree")


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): the smallest node it is linked with.

    Self links and repeated links do no harm; no edges give no rows.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    edges = cut(edges)
    seen = _fingerprint(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _with_least(both).filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = cut(large.filter("a <> b").distinct())
        starred = _with_least(large)  # here every b is smaller than its a
        small = starred.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            starred.select("a", F.col("least").alias("b"))
        )
        edges = cut(small.filter("a <> b").distinct())
        now = _fingerprint(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
