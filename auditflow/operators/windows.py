"""Ordered operators: latest, first, nearest following, recent, ranks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditflow.functions.layout import js_length
from auditflow.operators import ranges


def latest_per_key(df: DataFrame, keys: list[str], stamp: str, tie: str) -> DataFrame:
    """Newest row per key; of equal stamps the first listed wins."""
    numeric = F.col(tie)
    return ranges.pick_last(df, keys, [F.col(stamp), -numeric])


def recent_topics(pages: DataFrame, n: int = 5) -> DataFrame:
    """Topics of the last ``n`` normal pages of the unit before each ability page.

    A unit ends where an ability page follows a normal page, so two adjacent
    ability pages share one unit.  Fewer than ``n`` topics need review.
    """
    keys = ["book_id"]
    is_normal = F.col("route") == "normal"
    rows = ranges.previous(pages, keys, ["pos"], "route", "prev_route")
    opens = (is_normal & (F.col("prev_route") == "ability")).cast("int")
    rows = ranges.running(rows.withColumn("_o", F.coalesce(opens, F.lit(0))), keys, ["pos"], {
        "unit": ("sum", F.col("_o")), "idx": ("sum", is_normal.cast("int"))})
    normal = rows.where(is_normal).select(*keys, "unit", "idx", "topic")
    ability = rows.where(~is_normal).select(*keys, "pos", "unit", "idx")
    wanted = ability.select("*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("back"))
    found = wanted.withColumn("idx", F.col("idx") - F.col("back")).join(normal, [*keys, "unit", "idx"], "left")
    lists = found.groupBy(*keys, "pos").agg(
        F.array_sort(F.collect_list(F.when(F.col("topic").isNotNull(), F.struct("back", "topic")))).alias("l"))
    return lists.select(*keys, "pos", F.col("l.topic").alias("topics"), F.when(
        F.size("l") == n, "resolved").otherwise("needs_review").alias("status"))


def next_matching(df: DataFrame, keys: list[str], order: list[str], predicate: Column, value: Column, name: str) -> DataFrame:
    """``value`` of the first later row of the key for which the predicate holds."""
    return ranges.running(df, keys, order, {name: ("last", F.when(predicate, value))}, inclusive=False, reverse=True)


def longest_per_group(df: DataFrame, keys: list[str], text: str, pos: str) -> DataFrame:
    """Longest text per key, in UTF-16 units, first on ties."""
    return ranges.pick_first(df, keys, [-js_length(text), F.col(pos)])


def first_k(df: DataFrame, keys: list[str], predicate: Column, pos: str, k: int) -> DataFrame:
    """First ``k`` rows per key; ranks above ``k`` are cut before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(pos)
    return df.where(predicate).withColumn("n", F.row_number().over(window)).where(F.col("n") <= k)


def illegal_transitions(events: DataFrame, allowed: DataFrame, keys: list[str], order: list[str], state: str, start: str) -> DataFrame:
    """Steps between neighbouring events that the transition table does not list."""
    steps = ranges.previous(events, keys, order, state, "from_state")
    steps = steps.withColumn("from_state", F.coalesce("from_state", F.lit(start)))
    legal = allowed.select(F.col("from_state"), F.col("to_state").alias(state))
    return steps.join(legal, ["from_state", state], "left_anti")


def current_state(events: DataFrame, item: str, order: list[str], state: str) -> DataFrame:
    return events.groupBy(item).agg(
        F.max_by(state, F.struct(*order)).alias("state"),
        F.count(F.when(F.col(state) == "planned", 1)).alias("attempts"))


def first_wins(df: DataFrame, keys: list[str], item: str, order: list[Column]) -> DataFrame:
    """The first item keeps a logical key, later items conflict and name it; a null key is a key."""
    first = ranges.pick_first(df.select(*keys, item, *[o.alias(f"_o{i}") for i, o in enumerate(order)]), keys,
                              [F.col(f"_o{i}") for i in range(len(order))], [item]).withColumnRenamed(item, "winner")
    named = first.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "winner")
    same = reduce(Column.__and__, [df[k].eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    return df.join(named, same).select(*df.columns, "winner").withColumn("conflict", F.col("winner") != F.col(item))


def route_template(pages: DataFrame, variants: list[dict]) -> DataFrame:
    """Template of the one matching variant with the highest priority.

    ``variants`` are dicts with template, priority and a ``when`` condition text.
    No match, or a tie at the top, needs review.
    """
    hits = F.filter(F.array(*[
        F.when(F.expr(v["when"]), F.struct(F.lit(v["priority"]).alias("priority"), F.lit(v["template"]).alias("template")))
        for v in variants]), lambda h: h.isNotNull())
    rows = pages.withColumn("_hits", hits)
    top = F.array_max(F.transform("_hits", lambda h: h["priority"]))
    best = F.filter("_hits", lambda h: h["priority"] == F.col("_top"))
    rows = rows.withColumn("_top", top).withColumn("_best", best)
    one = F.size("_best") == 1
    return rows.withColumn("template", F.when(one, F.col("_best")[0]["template"])).withColumn(
        "status", F.when(one, "resolved").otherwise("needs_review")).drop("_hits", "_top", "_best")


def first_with_fallback(df: DataFrame, keys: list[str], predicates: list[Column], pos: str, value: str) -> DataFrame:
    """Value of the first row meeting the first predicate, else the second, and so on."""
    picks = [F.min_by(F.when(p, F.col(value)), F.when(p, F.col(pos))) for p in predicates]
    return df.groupBy(*keys).agg(F.coalesce(*picks).alias(value))


def assign_rows(elements: DataFrame, rows: DataFrame, expected: DataFrame) -> DataFrame:
    """The n-th element of a column goes to the n-th row center of its page.

    A column whose count differs from ``expected`` is flagged, not cut.
    """
    placed = ranges.numbered(elements, ["page_id", "column_id"], ["top_px", "element_id"], "row_no")
    centers = ranges.numbered(rows, ["page_id"], ["center_px"], "row_no").select("page_id", "row_no", "center_px")
    counts = elements.groupBy("page_id", "column_id").agg(F.count("*").alias("n_found")).join(
        expected, ["page_id", "column_id"], "left")
    bad = counts.withColumn("count_mismatch", ~F.col("n_found").eqNullSafe(F.col("n_expected")))
    return placed.join(bad.select("page_id", "column_id", "count_mismatch"), ["page_id", "column_id"]).join(
        centers, ["page_id", "row_no"], "left")


def row_centres(blocks: DataFrame, gap: float, least: int = 2) -> DataFrame:
    """``page_id, center_px, n_blocks``: rows of a page from the backgrounds that repeat in them.

    ``blocks (page_id, block_id, top_px, height_px)``: the middles of the blocks of a page
    are taken in order, and one that is more than ``gap`` below the one before begins a
    new row.  A row needs ``least`` blocks and has their mean as its centre.  Blocks
    without a place or a height are left out.
    """
    middle = F.col("top_px") + F.col("height_px") / 2
    placed = blocks.select("page_id", "block_id", middle.cast("double").alias("_mid")).where("_mid IS NOT NULL")
    order = ["_mid", "block_id"]
    steps = ranges.previous(placed, ["page_id"], order, "_mid", "_before")
    begins = F.when(F.col("_before").isNull() | (F.col("_mid") - F.col("_before") > gap), 1).otherwise(0)
    rows = ranges.running(steps, ["page_id"], order, {"_row": ("sum", begins)})
    found = rows.groupBy("page_id", "_row").agg(F.avg("_mid").alias("center_px"), F.count("*").alias("n_blocks"))
    return found.where(F.col("n_blocks") >= least).drop("_row")


def is_sorted(column: Column | str) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.array_sort(c) == c


def ordered(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.orderBy(*keys)


def first_last(df: DataFrame, order: list[str]) -> DataFrame:
    """First and last row of a report in one pass."""
    row, at = F.struct(*df.columns), F.struct(*order)
    both = df.agg(F.min_by(row, at).alias("f"), F.max_by(row, at).alias("l"))
    first = both.select(F.lit("first").alias("which"), "f.*")
    return first.unionByName(both.select(F.lit("last").alias("which"), "l.*"))
