"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: each vertex links its larger neighbours to its smallest one. Small star: each vertex links its
    smaller neighbours and itself to the smallest. ``edges``: (a, b) with a > b, distinct."""
    if large:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("w")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("w")))
    else:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("w"))
    least = C.saved(both.groupBy("u").agg(F.least(F.min("w"), F.col("u")).alias("m")), "star-least")
    joined = both.join(least, "u")
    if large:
        linked = joined.where(F.col("w") > F.col("u")).select(F.col("w").alias("a"), F.col("m").alias("b"))
    else:
        linked = joined.select(F.col("w").alias("a"), F.col("m").alias("b")).unionByName(joined.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return linked.where("a <> b").distinct()


def _settled(pairs: DataFrame) -> bool:
    """Whether the graph is disjoint stars: one edge for each larger vertex, and no centre is one."""
    return pairs.groupBy("a").count().where("count > 1").isEmpty() and pairs.join(pairs.select(F.col("b").alias("a")), "a", "left_semi").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(v, component) for each vertex of ``edges`` (columns a, b: bigint); the component is its smallest vertex.

    Every contraction is a partial aggregate and an equi-join (a hot vertex is split by the engine), written to
    the shared folder; the number of rounds grows with the logarithm of the longest path."""
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    pairs = C.saved(pairs, "star-edges")
    large = True
    while not _settled(pairs):
        # both contractions keep what is connected, so disjoint stars are the components
        pairs = C.saved(_star(pairs, large), "star-large" if large else "star-small")
        large = not large
    # every edge now leads from a vertex to the smallest of its component
    return pairs.select(F.col("a").alias("v"), F.col("b").alias("component")).unionByName(pairs.select(F.col("b").alias("v"), F.col("b").alias("component"))).distinct()
