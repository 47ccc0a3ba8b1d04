"""Aggregate reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditflow.operators import ranges
from auditflow.operators.checks import violations

# Ledger states.
NORMAL_STATES = ["pending", "planned", "preflighted", "applied", "saved", "verified", "verified_skip"]
EXCEPTION_STATES = ["needs_review", "conflict", "failed", "outcome_unknown"]
ALL_STATES = NORMAL_STATES + EXCEPTION_STATES


def annotation_summary(placed: DataFrame, found: DataFrame) -> DataFrame:
    """One row over the planned annotations; valid iff there is no error row.

    A page is a page of a file.
    """
    audio = F.col("type") == "audio"
    counts = placed.agg(
        F.count("*").alias("annotation_count"), F.count_distinct("path", "page").alias("affected_page_count"),
        F.min("page").alias("first_page"), F.max("page").alias("last_page"),
        F.count(F.when(audio, 1)).alias("audio_count"),
        F.count(F.when(F.col("type") == "transcript", 1)).alias("transcript_count"),
        F.count_distinct(F.when(audio, F.lower("audio_path"))).alias("unique_audio_file_count"))
    problems = found.agg(
        F.count(F.when(F.col("severity") == "error", 1)).alias("error_count"),
        F.count(F.when(F.col("severity") == "warning", 1)).alias("warning_count"))
    # Both sides are one-row aggregates.
    return counts.crossJoin(F.broadcast(problems)).withColumn("valid", F.col("error_count") == 0)


def affected_pages(placed: DataFrame) -> DataFrame:
    return placed.select("path", "page").distinct().orderBy("path", "page")


def plan_by_page(placed: DataFrame, size: int = 1000) -> DataFrame:
    """Annotations of each page of a file in input order, in segments of bounded length."""
    measures = ["page_width", "page_height", "scale"]
    item = F.struct("id", "pos", "type", "left_px", "top_px", "width_px", "height_px")
    # as texts, since keys of floating type are dealt out anew by every step
    rows = placed.select("path", "page", *[(F.col(c) + 0.0).cast("string").alias(c) for c in measures], "pos", item.alias("item"))
    out = ranges.segments(rows, ["path", "page", *measures], ["pos"], F.col("item"), "annotations", size)
    out = out.withColumns({c: F.col(c).cast(placed.schema[c].dataType) for c in measures})
    return out.withColumn("canvas_height", F.col("page_height") * F.col("scale"))


def distribution(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")).orderBy("value")


def mismatch_report(df: DataFrame, columns: list[str], expected: int) -> DataFrame:
    wrong = F.lit(False)
    for c in columns:
        wrong = wrong | ~F.col(c).eqNullSafe(F.lit(expected))
    return df.where(wrong)


def longest_by(df: DataFrame, length: Column, order: str) -> DataFrame:
    """The row with the greatest length, first on ties."""
    row = F.max_by(F.struct(*df.columns), F.struct(length, -F.col(order)))
    return df.agg(row.alias("_r")).select("_r.*")


def verification_report(pages: DataFrame, errors: DataFrame, order: str = "position") -> DataFrame:
    """Totals over verified pages and the pages with errors."""
    bad = errors.where("severity = 'error'").select(F.col("entity_id").alias("_e")).distinct().withColumn("_bad", F.lit(1))
    rows = pages.join(bad, F.col("page_id").cast("string") == F.col("_e"), "left")
    return rows.agg(
        F.count("*").alias("page_count"), F.sum("module_count").cast("bigint").alias("module_total"),
        F.count("_bad").alias("failure_count"),
        F.min_by("page_id", order).alias("first_page"), F.max_by("page_id", order).alias("last_page"))


def ledger_summary(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Counts for every state including zero, and the items that need attention."""
    domain = items.sparkSession.createDataFrame([(s,) for s in ALL_STATES], "state string")
    counts = items.groupBy("state").agg(F.count("*").alias("n"))
    summary = domain.join(counts, "state", "left").select("state", F.coalesce("n", F.lit(0)).alias("n"))
    attention = items.where(F.col("state").isin(EXCEPTION_STATES))
    return summary, attention


def ledger_complete(items: DataFrame) -> DataFrame:
    done = F.col("state").isin("verified", "verified_skip")
    return items.agg(F.count("*").alias("total"), F.count(F.when(done, 1)).alias("n_done")).withColumn(
        "complete", F.col("total") == F.col("n_done"))


def duplicate_report(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def distinct_equals(df: DataFrame, keys: list[str], column: str, n: int) -> DataFrame:
    counted = df.groupBy(*keys).agg(F.count_distinct(column).alias("n"))
    entity = F.concat_ws("/", *[F.col(k).cast("string") for k in keys])
    return violations(counted.where(F.col("n") != n), entity, "distinct_count",
                      F.concat(F.lit(f"expected {n}, got "), F.col("n").cast("string")))


def required_passed(required: DataFrame, checks: DataFrame) -> DataFrame:
    """Per run: does every required check have a passed report."""
    ok = checks.where("status = 'passed'").select("run_id", "required_key").distinct().withColumn("_ok", F.lit(True))
    rows = required.join(ok, ["run_id", "required_key"], "left")
    return rows.groupBy("run_id").agg(
        F.bool_and(F.coalesce("_ok", F.lit(False))).alias("passed"), F.count("*").alias("n_required"))


def fidelity_gate(snapshots: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """Full fidelity of captures.

    ``sections`` is a map of completeness flags, ``warnings`` an array of codes.
    The font section and font warnings do not count.
    """
    whole = F.forall(F.map_entries("sections"), lambda e: (e["key"] == "fonts") | e["value"].eqNullSafe(F.lit(True)))
    quiet = F.forall("warnings", lambda w: w == "FONT_MAPPING_EMPTY")
    rows = snapshots.withColumn("full_fidelity", F.coalesce(whole & quiet, F.lit(False)))
    if expected is None:
        return rows
    return rows.join(expected, "route", "left").withColumn(
        "gate", F.col("full_fidelity") & F.col("module_count").eqNullSafe(F.col("n_modules")))


def module_cardinality(modules: DataFrame, pages: DataFrame, expected: DataFrame) -> DataFrame:
    """Pages whose module counts per type differ from their route; extra types and unknown routes are errors."""
    counts = modules.groupBy("page_id", "module_type").agg(F.count("*").alias("n"))
    want = pages.join(expected, "route").select("page_id", "module_type", "n_expected")
    both = want.join(counts, ["page_id", "module_type"], "full").where(
        ~F.coalesce("n", F.lit(0)).eqNullSafe(F.coalesce("n_expected", F.lit(0))))
    message = F.concat(F.col("module_type"), F.lit(": expected "), F.coalesce("n_expected", F.lit(0)).cast("string"),
                       F.lit(", got "), F.coalesce("n", F.lit(0)).cast("string"))
    unknown = pages.join(expected.select("route").distinct(), "route", "left_anti")
    named = F.concat(F.lit("route "), F.coalesce(F.col("route").cast("string"), F.lit("?")), F.lit(" has no expectation"))
    return violations(both, "page_id", "module_cardinality", message).unionByName(violations(unknown, "page_id", "route_unknown", named))


def warning_histogram(warnings: DataFrame, code: str = "code") -> DataFrame:
    return warnings.groupBy(F.col(code).alias("code")).agg(F.count("*").alias("n"))


def book_rollup(pages: DataFrame, book: str, measures: dict[str, Column]) -> DataFrame:
    """Measures per book with a grand total."""
    rolled = pages.rollup(book).agg(F.grouping(book).alias("_g"), *[m.alias(n) for n, m in measures.items()])
    return rolled.withColumn("is_total", F.col("_g") == 1).drop("_g")


def bijection_check(df: DataFrame, a: str, b: str) -> DataFrame:
    """Values bound to more than one partner, in either direction."""
    pairs = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(a, b).distinct()

    def side(key: str, other: str) -> DataFrame:
        many = pairs.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
        return violations(many, key, f"{key}_to_many_{other}", F.concat(F.col("n").cast("string"), F.lit(f" values of {other}")))

    return side(a, b).unionByName(side(b, a))


def set_report(required: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """Missing, unexpected and repeated keys in one aggregation."""
    tag = lambda df, r, p: df.select(*keys, F.lit(r).alias("r"), F.lit(p).alias("p"))
    both = tag(required, 1, 0).unionByName(tag(present, 0, 1)).groupBy(*keys).agg(
        F.sum("r").cast("bigint").alias("n_required"), F.sum("p").cast("bigint").alias("n_present"))
    status = F.when(F.col("n_present") == 0, "missing").when(F.col("n_required") == 0, "unexpected").when(
        F.col("n_present") > 1, "duplicate")
    return both.withColumn("status", status).where("status IS NOT NULL")
