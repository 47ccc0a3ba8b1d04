"""Sources mixed to target weights by weighted fair queueing, in DataFrame operations only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditflow.llm.common import checkpointed, row_key, text_of, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
EPOCHS = 2
SEED = "mix-1"
#: Slices of virtual time; one slice is sorted exactly to find the cut.
SLICES = 4096
#: Rows of a source that share a slice of the shuffle order, on average at most.
SLICE_ROWS = 50_000


def shuffle_key(doc_id: Column, seed: str = SEED) -> Column:
    """Position of a document in the shuffled order of its source."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(doc_id.cast("string"), F.lit("null"))))


def sized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: str = SEED) -> DataFrame:
    """Narrow rows ``doc_id, row_key, source, size, h``; size is the number of words, 0 for a null text."""
    return docs.select(
        F.col(doc_id).alias("doc_id"), row_key(doc_id, text).alias("row_key"), F.col(source).alias("source"),
        word_count(text_of(text)).alias("size"), shuffle_key(F.col(doc_id), seed).alias("h"),
    )


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """``source, source_size, target`` from rows ``source, source_size``, one per source.

    Sources in code point order, null last, take the weights in turn.  A target stops
    at ``epochs`` times the size of its source; filling the sources in order of size
    by weight reshares the excess in one pass, since a full source never raises the
    level of the ones before it.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = sizes.withColumn("n", F.row_number().over(order) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("n") % len(weights) + 1).cast("int"))
    ranked = ranked.select("source", "source_size", "n", weight.alias("w"), (F.col("source_size") * float(epochs)).alias("cap"))
    ranked = ranked.withColumns({"budget": F.sum("source_size").over(every) * share, "weights": F.sum("w").over(every)})
    filled = Window.orderBy(F.col("cap") / F.col("w"), "n")
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.col("weights") - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    ranked = ranked.withColumn("level", level)
    ranked = ranked.withColumn("full", F.col("cap") <= F.col("w") * F.col("level"))
    final = F.max(F.when(~F.col("full"), F.col("level"))).over(every)
    return ranked.withColumn("final", final).select(
        "source", "source_size", F.when(F.col("full"), F.col("cap")).otherwise(F.col("w") * F.col("final")).alias("target"), "budget"
    )


def fair_mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
             weights: tuple = WEIGHTS, share: float = SHARE, seed: str = SEED) -> DataFrame:
    """One row per document: ``doc_id, row_key, source, size, source_size, target, finish, copies, taken``.

    ``finish`` holds the virtual finish times of the two passes over a source, words of
    the source up to and including the document divided by the target; ``copies`` those
    that lie before the cut, where the words of all sources together reach the budget.

    A null source is a source of its own, a null id one more id; ties of the shuffle
    order are broken by id and size, and repeated rows are interchangeable.  Documents
    without words take no part: size 0, no copies.  An empty table gives no rows.
    Running sums go over slices of the shuffle order, whose totals are added up first,
    so no source is in one task.
    """
    rows = checkpointed(sized(docs, doc_id, text, source, seed))
    digits = max(2, math.ceil(math.log(max(rows.count(), 1) / SLICE_ROWS, 16)))
    rows = rows.withColumn("slice", F.substring("h", 1, digits))
    totals = checkpointed(rows.groupBy("source", "slice").agg(F.sum("size").alias("words")))
    targets = checkpointed(source_targets(totals.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share))
    ahead = F.sum("words").over(Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1))
    starts = totals.select("source", "slice", F.coalesce(ahead, F.lit(0)).alias("ahead"))
    same = F.col("s.source").eqNullSafe(F.col("t.source"))
    offsets = checkpointed(starts.alias("s").join(targets.alias("t"), same).select(
        F.col("s.source").alias("o_source"), F.col("s.slice").alias("o_slice"), "ahead", "source_size", "target", "budget"))
    within = Window.partitionBy("source", "slice").orderBy("h", F.col("doc_id").isNull(), "doc_id", "size", "row_key").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    summed = rows.withColumn("upto", F.sum("size").over(within))
    placed = summed.join(offsets, F.col("source").eqNullSafe(F.col("o_source")) & (F.col("slice") == F.col("o_slice")))
    finish = F.array(*[(F.col("ahead") + F.col("upto") + F.col("source_size") * e) / F.col("target") for e in range(EPOCHS)])
    placed = checkpointed(placed.select(
        "doc_id", "row_key", "source", "size", "h", "source_size", "target", "budget",
        F.when((F.col("size") > 0) & (F.col("target") > 0), finish).alias("finish")))
    return _cut(placed)


def _cut(placed: DataFrame) -> DataFrame:
    """Keep the finish times before the point where all words together reach the budget."""
    plays = placed.where("finish IS NOT NULL").select(
        F.posexplode("finish").alias("epoch", "at"), "size", "h", "doc_id", "source", "budget")
    # Times past twice the end of the mix share one slice, which can never hold the cut.
    plays = plays.withColumn("part", F.least(F.floor(F.col("at") * SLICES), F.lit(2 * SLICES)).cast("int"))
    parts = plays.groupBy("part").agg(F.sum("size").alias("words"), F.first("budget").alias("budget"))
    order = Window.orderBy("part")
    upto = parts.withColumn("upto", F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    over = upto.where("upto > budget").agg(
        F.min(F.struct("part", (F.col("upto") - F.col("words")).alias("ahead"))).alias("c")).select("c.part", "c.ahead")
    edge = plays.join(F.broadcast(over), "part")
    exact = Window.orderBy("at", "source", "h", "epoch", "doc_id", "size")
    sums = F.sum("size").over(exact.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    last = edge.select(F.struct("at", "source", "h", "epoch").alias("k"), (F.col("ahead") + sums <= F.col("budget")).alias("fits"), "part")
    bound = checkpointed(last.groupBy("part").agg(F.max(F.when(F.col("fits"), F.col("k"))).alias("cut")))
    # One row, whatever the input: the slice of the cut and the last play that fits, both null if all fit.
    joined = placed.crossJoin(F.broadcast(bound.agg(F.max("part").alias("part"), F.max("cut").alias("cut"))))
    copies = F.when(F.col("finish").isNull(), F.array().cast("array<double>")).otherwise(F.filter(
        "finish", lambda at, e: F.col("part").isNull() | (F.floor(at * SLICES) < F.col("part"))
        | F.coalesce(F.struct(at.alias("at"), F.col("source").alias("source"), F.col("h").alias("h"), e.alias("epoch")) <= F.col("cut"),
                     F.lit(False))))
    out = joined.withColumn("copies", copies)
    return out.select("doc_id", "row_key", "source", "size", "source_size", "target", "finish", "copies",
                      (F.col("size") * F.size("copies")).cast("long").alias("taken"))


ORACLE = f"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         md5('{SEED}|' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS n FROM s),
w AS (SELECT *, CASE n % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w, source_size * 2.0::DOUBLE AS cap,
             CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE AS budget FROM r),
l AS (SELECT *, (budget - coalesce(sum(cap) OVER f, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER f, 0)) AS level
      FROM w WINDOW f AS (ORDER BY cap / w, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
u AS (SELECT *, cap <= w * level AS is_full FROM l),
t AS (SELECT source, source_size, budget,
             CASE WHEN is_full THEN cap ELSE w * max(CASE WHEN NOT is_full THEN level END) OVER () END AS target FROM u),
c AS (SELECT d.*, t.source_size, t.target, t.budget,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY h, doc_id IS NULL, doc_id, d.size ROWS UNBOUNDED PRECEDING) AS upto,
             row_number() OVER () AS row_no
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
p AS (SELECT c.*, e.epoch, CAST(upto + source_size * e.epoch AS DOUBLE) / target AS fin
      FROM c CROSS JOIN (VALUES (0), (1)) AS e(epoch) WHERE c.size > 0 AND target > 0),
q AS (SELECT row_no, size, sum(size) OVER (ORDER BY fin, source NULLS FIRST, h, epoch, doc_id, size ROWS UNBOUNDED PRECEDING) <= budget AS fits FROM p),
k AS (SELECT row_no, CAST(sum(CASE WHEN fits THEN size ELSE 0 END) AS BIGINT) AS taken FROM q GROUP BY row_no)
SELECT doc_id, c.size, source_size, target, coalesce(k.taken, 0) AS taken FROM c LEFT JOIN k USING (row_no)"""
