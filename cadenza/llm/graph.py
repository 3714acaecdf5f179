"""Connected components of a link table, by alternating star contraction.

Each round is two grouped minima and two joins over the links; the state is a
checkpoint in the shared folder, so a lost executor costs a re-read. The number
of rounds is logarithmic in the longest path, not linear. Nothing but the
convergence test (a count and a checksum) reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import checkpoint_ready


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    return (both.join(least, "a").where("b > a")
            .select(F.col("m").alias("a"), "b").where("a != b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    joined = edges.join(least, "b").where("a != m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return joined.union(least.select(F.col("m").alias("a"), "b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (two columns of longs,
    no nulls): the smallest node that its links reach, itself included."""
    checkpoint_ready(edges.sparkSession)
    a, b = (F.col(c) for c in edges.columns[:2])
    edges = edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a != b").distinct()
    edges = edges.checkpoint()
    mark = None
    while True:
        now = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
        if now == mark or now[0] == 0:
            break
        mark = now
        edges = _small_star(_large_star(edges)).checkpoint()
    leaves = edges.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return leaves.union(edges.select("a", "a").distinct())
