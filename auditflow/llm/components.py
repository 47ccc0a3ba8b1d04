"""Connected components by alternating stars over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditflow.session import checkpointed


def _state(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """``(node, component)``: the smallest node that each node of an edge reaches.

    Ids are longs.  Edges with a null end and loops carry no link; a node that only
    loops gets no row.  Every round joins edges with one row per node, so the edges of
    a hub are split over tasks; minima are combined before the shuffle.  Rounds go on
    until nothing changes, which takes about the logarithm of the longest path.
    """
    ends = edges.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    pairs = checkpointed(ends.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = _state(pairs)
    while state[0]:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = checkpointed(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = checkpointed(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = checkpointed(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = checkpointed(small.union(low.select("u", F.col("m").alias("v"))).distinct())
        before, state = state, _state(pairs)
        if state == before:
            break
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
