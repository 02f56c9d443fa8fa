"""Connected components of an edge list, as DataFrame joins and aggregations.

Alternating large-star and small-star steps; every step's edges are checkpointed to the
shared folder, so a lost executor re-reads them and lineage stays short. Minima are
partially aggregated and the joins are plain shuffle joins (AQE splits a hot node). Only a
count and a checksum per step reach the driver. Steps: O(log^2 n), in practice four to six.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint


def _star(edges: DataFrame) -> DataFrame:
    """(u, v, m) with m the least of u and its neighbours, over both directions of each edge."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # Written out, so that the join has an exchange of its own on either side and AQE can
    # split a hub (a node with a large part of all edges).
    least = checkpoint(both.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("_m")))
    return both.join(least, F.col("u") == F.col("_u")).select("u", "v", F.least("u", "_m").alias("m"))


def _round(edges: DataFrame) -> DataFrame:
    large = _star(edges).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")) \
        .where(F.col("u") != F.col("v")).distinct()
    large = checkpoint(large)
    least = checkpoint(large.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("_m")))
    joined = large.join(least, F.col("u") == F.col("_u"))
    small = joined.select(F.col("v").alias("u"), F.col("_m").alias("v")).where(F.col("u") != F.col("v")) \
        .unionByName(least.select(F.col("_u").alias("u"), F.col("_m").alias("v")))
    return small.distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): every node of an edge with the least node of its component."""
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col("u") != F.col("v"))
    e = checkpoint(e.distinct())
    mark = None
    while True:
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark or not now[0]:
            break
        mark = now
        e = checkpoint(_round(e))
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
