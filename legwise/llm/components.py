"""Connected components by alternating star contractions.

Every round is two aggregations and joins over the edges, written to the shared
folder; hot nodes are aggregated before the shuffle.  The rounds end when the edges
are stars around the smallest node of their component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from legwise.staging import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node are linked with the smallest of it and its neighbours."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked with the smallest of them; edges go from larger to smaller."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a")
    return joined.select("a", F.col("m").alias("b")).unionAll(
        joined.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    )


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, its component's smallest node, for every node with an edge (``a``, ``b``)."""
    ordered = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    current, state = stage(ordered, "edges"), None
    while True:
        # order-free sums of the edges, taken as they are written; equal sums of two rounds mean nothing moved
        sums = Observation()
        step = _small_star(_large_star(current)).distinct()
        moved = F.count(F.lit(1)).alias("edges"), F.bit_xor(F.xxhash64("a", "b")).alias("hash")
        current = stage(step.observe(sums, *moved), "edges")
        now = sums.get
        if now == state:
            break
        state = now
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)
