"""Set operations over keyed rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_union(*frames: DataFrame, key: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [f.select(key) for f in frames]).distinct()


def symmetric_difference(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys on one side only, with the side, in one shuffle."""
    both = a.select(*keys, F.lit(1).alias("s")).unionByName(b.select(*keys, F.lit(2).alias("s")))
    sides = both.groupBy(*keys).agg(F.min("s").alias("lo"), F.max("s").alias("hi"))
    return sides.where("lo = hi").select(*keys, F.when(F.col("lo") == 1, "left").otherwise("right").alias("side"))


def same_set(a: DataFrame, b: DataFrame, by: str, key: str) -> DataFrame:
    """Per group: do both sides hold the same keys.  No group is collected."""
    both = a.select(by, key, F.lit(1).alias("s")).unionByName(b.select(by, key, F.lit(2).alias("s")))
    sides = both.groupBy(by, key).agg(F.min("s").alias("lo"), F.max("s").alias("hi"))
    return sides.groupBy(by).agg((F.count(F.when(F.col("lo") == F.col("hi"), 1)) == 0).alias("equal"))


def subset_violations(a: DataFrame, b: DataFrame, by: list[str], key: str) -> DataFrame:
    """Keys of ``a`` that ``b`` lacks in the same group."""
    return a.select(*by, key).distinct().join(b.select(*by, key), [*by, key], "left_anti")


def forbidden_present(df: DataFrame, forbidden: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(forbidden.select(*keys), keys, "left_semi")


def is_subset(a: Column, b: Column) -> Column:
    return F.size(F.array_except(a, b)) == 0
