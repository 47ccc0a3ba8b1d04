"""Ordered computation over keys that may hold a large share of all rows.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task.  The
functions here first ask whether any key exceeds a row limit.  If none does, the
plain window is used.  Otherwise rows of hot keys are cut into consecutive ranges
of the order columns, each range is computed on its own, and one small row per
range carries the running value into the next range.  Results are the same.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditflow.session import checkpointed

HOT_ROWS_CONF = "spark.auditflow.hotRows"
HOT_ROWS = 1_000_000
MAX_RANGES = 10_000


def hot_rows(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(HOT_ROWS_CONF, str(HOT_ROWS)))


def split_hot(df: DataFrame, keys: list[str], order: list[str]) -> tuple[DataFrame, bool]:
    """Add ``_range``: 0 for ordinary keys, else the range of the whole ``order``.

    Rows of all hot keys are dealt out by range of all order columns, so equal values of
    the first one are split as well, and one range holds about ``hot_rows`` rows whichever
    key they belong to.  The ranges are written down, since every use must see the same.
    """
    limit = hot_rows(df)
    hot = df.groupBy(*keys).count().where(F.col("count") > limit)
    total = hot.agg(F.sum("count")).first()[0]
    if not total:
        return df.withColumn("_range", F.lit(0)), False
    n = min(MAX_RANGES, max(2, math.ceil(total / limit)))
    hot_keys = hot.select(*[F.col(k).alias(f"_h_{k}") for k in keys])
    on = None
    for k in keys:
        eq = F.col(k).eqNullSafe(F.col(f"_h_{k}"))
        on = eq if on is None else on & eq
    dealt = df.join(hot_keys, on, "left_semi").repartitionByRange(n, *[F.col(c).asc_nulls_first() for c in order])
    dealt = checkpointed(dealt.withColumn("_range", F.spark_partition_id() + 1))
    rest = df.join(hot_keys, on, "left_anti").withColumn("_range", F.lit(0))
    return rest.unionByName(dealt), True


def _order(order: list[str], reverse: bool) -> list[Column]:
    return [F.col(c).desc_nulls_last() if reverse else F.col(c).asc_nulls_first() for c in order]


_AGG = {
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "last": lambda c: F.last(c, ignorenulls=True),
}


def running(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    values: dict[str, tuple[str, Column]],
    *,
    inclusive: bool = True,
    reverse: bool = False,
) -> DataFrame:
    """Running ``sum``, ``min``, ``max`` or ``last`` non-null value per key.

    ``order`` must be a total order within a key.  ``reverse`` walks it backwards,
    so an exclusive ``last`` is then the nearest following value.
    """
    names = {f"_in_{name}": column for name, (_, column) in values.items()}
    prepared = df.withColumns(names)
    cut, split = split_hot(prepared, keys, order)
    end = 0 if inclusive else -1
    inner_keys = [*keys, "_range"] if split else keys
    window = Window.partitionBy(*inner_keys).orderBy(*_order(order, reverse))
    frame = window.rowsBetween(Window.unboundedPreceding, end)
    local = cut.withColumns({f"_lo_{n}": _AGG[k](F.col(f"_in_{n}")).over(frame) for n, (k, _) in values.items()})
    if not split:
        done = local.withColumns({n: F.col(f"_lo_{n}") for n in values})
        return done.select(*[c for c in df.columns if c not in values], *values)

    def whole(kind: str, name: str) -> Column:
        column = F.col(f"_in_{name}")
        if kind != "last":
            return _AGG[kind](column)
        position = F.struct(*order)
        pick = F.min_by if reverse else F.max_by
        return pick(F.when(column.isNotNull(), column), F.when(column.isNotNull(), position))

    totals = cut.groupBy(*keys, "_range").agg(*[whole(k, n).alias(f"_t_{n}") for n, (k, _) in values.items()])
    over = Window.partitionBy(*keys).orderBy(F.col("_range").desc() if reverse else F.col("_range"))
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col("_range").alias("_k_range"),
        *[_AGG[k](F.col(f"_t_{n}")).over(before).alias(f"_c_{n}") for n, (k, _) in values.items()],
    )
    on = F.col("_range") == F.col("_k_range")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    joined = local.join(carried, on, "left")

    def merge(kind: str, name: str) -> Column:
        lo, carry = F.col(f"_lo_{name}"), F.col(f"_c_{name}")
        if kind == "sum":
            return F.when(lo.isNull() & carry.isNull(), F.lit(None)).otherwise(
                F.coalesce(lo, F.lit(0)) + F.coalesce(carry, F.lit(0))
            )
        if kind == "min":
            return F.least(lo, carry)
        if kind == "max":
            return F.greatest(lo, carry)
        return F.coalesce(lo, carry)

    done = joined.withColumns({n: merge(k, n) for n, (k, _) in values.items()})
    return done.select(*[c for c in df.columns if c not in values], *values)


def numbered(df: DataFrame, keys: list[str], order: list[str], name: str = "n", reverse: bool = False) -> DataFrame:
    """``row_number`` per key that survives a hot key."""
    out = running(df, keys, order, {name: ("sum", F.lit(1))}, reverse=reverse)
    return out.withColumn(name, F.col(name).cast("bigint"))


def previous(df: DataFrame, keys: list[str], order: list[str], column: str, name: str) -> DataFrame:
    """``lag(column)`` per key; a null value stays a null value."""
    wrapped = F.struct(F.col(column).alias("v"))
    out = running(df, keys, order, {name: ("last", wrapped)}, inclusive=False)
    return out.withColumn(name, F.col(f"{name}.v"))


def segments(
    df: DataFrame, keys: list[str], order: list[str], item: Column, name: str, size: int = 1000
) -> DataFrame:
    """Ordered lists per key in arrays of at most ``size`` items, one row each.

    ``segment`` counts from 0, so a key of any size is kept whole across rows.
    """
    rows = numbered(df.withColumn("_item", item), keys, order, "_n")
    cut = rows.withColumn("segment", F.floor((F.col("_n") - 1) / size).cast("bigint"))
    grouped = cut.groupBy(*keys, "segment").agg(
        F.array_sort(F.collect_list(F.struct("_n", "_item"))).alias("_list"), F.count("*").alias("n_items")
    )
    return grouped.select(*keys, "segment", "n_items", F.col("_list._item").alias(name))


def pick_first(df: DataFrame, keys: list[str], order: list[Column], columns: list[str] | None = None) -> DataFrame:
    """The first row per key by ``order``; partial aggregation runs before the shuffle."""
    keep = columns or [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*keep), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in keep])


def pick_last(df: DataFrame, keys: list[str], order: list[Column], columns: list[str] | None = None) -> DataFrame:
    keep = columns or [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*keep), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in keep])
