"""Joins of the audit: sources, versions, catalogs, checks, receipts, evidence."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditflow.functions.text import compact_text, normalize_name, normalize_path, normalize_volume
from auditflow.operators import ranges
from auditflow.operators.checks import explode_rules
from auditflow.operators.tree import collect_named_values
from auditflow.session import checkpointed

# Points of the source score.
POINTS = {
    "subject": 15, "grade": 15, "volume": 15, "book_name_exact": 20, "book_name_contains": 10,
    "catalog_path_exact": 20, "catalog_name_sort_exact": 15,
}
HIGH, MEDIUM = 65, 40
CORE = ["subject", "grade", "volume"]


def source_view(df: DataFrame, prefix: str) -> DataFrame:
    """Normalised metadata columns of one side, named ``<prefix>_…``."""
    sort = F.nullif(F.coalesce(F.col("catalog_sort").cast("string"), F.lit("")), F.lit(""))
    made = {
        "subject": compact_text("subject"), "grade": compact_text("grade"), "volume": normalize_volume("volume"),
        "book": compact_text("book_name"), "path": normalize_path("catalog_path"),
        "name": compact_text("catalog_name"), "sort": sort,
    }
    return df.withColumns({f"{prefix}_{k}": v for k, v in made.items()}).drop(
        "subject", "grade", "volume", "book_name", "catalog_path", "catalog_name", "catalog_sort")


def score_pairs(pairs: DataFrame) -> DataFrame:
    """Score each given query and candidate pair (``q_…`` and ``c_…`` columns)."""
    def both(field: str) -> Column:
        return F.col(f"q_{field}").isNotNull() & F.col(f"c_{field}").isNotNull()

    def same(field: str) -> Column:
        return F.coalesce(F.col(f"q_{field}") == F.col(f"c_{field}"), F.lit(False))

    rejections = F.filter(F.array(*[F.when(both(f) & ~same(f), F.lit(f"{f}_mismatch")) for f in CORE]), lambda r: r.isNotNull())
    core = reduce(lambda a, b: a + b, [F.when(same(f), POINTS[f]).otherwise(0) for f in CORE])
    contains = both("book") & (F.contains("q_book", "c_book") | F.contains("c_book", "q_book"))
    name = F.when(same("book"), POINTS["book_name_exact"]).when(contains, POINTS["book_name_contains"]).otherwise(0)
    place = F.when(same("path"), POINTS["catalog_path_exact"]).when(
        same("name") & same("sort"), POINTS["catalog_name_sort_exact"]).otherwise(0)
    missing = reduce(lambda a, b: a | b, [F.col(f"c_{f}").isNull() for f in CORE])
    out = pairs.withColumn("rejections", rejections).withColumn("eligible", F.size("rejections") == 0)
    out = out.withColumn("score", F.when(F.col("eligible"), core + name + place).otherwise(0))
    confidence = (
        F.when(~F.col("eligible"), "rejected")
        .when((F.col("score") >= HIGH) & ~missing, "high")
        .when(F.col("score") >= MEDIUM, "medium").otherwise("low")
    )
    return out.withColumn("confidence", confidence)


def match_source(query: DataFrame, candidates: DataFrame, lists: DataFrame) -> DataFrame:
    """Scores for queries against their own candidate lists.

    ``lists`` holds (query_id, candidate_id); a candidate listed twice for a query
    is counted once and flagged.
    """
    listed = lists.groupBy("query_id", "candidate_id").agg((F.count("*") > 1).alias("duplicate_candidate"))
    pairs = listed.join(source_view(query, "q"), "query_id").join(source_view(candidates, "c"), "candidate_id")
    return score_pairs(pairs)


def rank_candidates(scored: DataFrame, key: str = "query_id") -> DataFrame:
    """Position of each candidate by falling score, then by id in the order of the Unicode collation.

    Ids that the collation holds for equal follow in binary order.
    """
    ordered = scored.withColumns({"_neg": -F.col("score"), "_id": F.collate(F.col("candidate_id").cast("string"), "UNICODE")})
    return ranges.numbered(ordered, [key], ["_neg", "_id", "candidate_id"], "rank").drop("_neg", "_id")


def unique_top(scored: DataFrame, confirmations: DataFrame | None = None, key: str = "query_id") -> DataFrame:
    """Best eligible candidate per query if it stands alone; selection needs a confirmation."""
    eligible = scored.where("eligible").groupBy(key, "score").agg(
        F.count("*").alias("n"), F.min("candidate_id").alias("candidate_id"))
    best = ranges.pick_last(eligible, [key], [F.col("score")], ["score", "n", "candidate_id"])
    unique = (F.col("score") > 0) & (F.col("n") == 1)
    every = scored.select(key).distinct().join(best, key, "left")
    out = every.select(
        key, F.col("score").alias("top_score"), F.coalesce(F.col("n"), F.lit(0)).alias("n_top"),
        F.coalesce(unique, F.lit(False)).alias("unique_top"), F.when(unique, F.col("candidate_id")).alias("top_candidate_id"))
    if confirmations is None:
        return out.withColumn("selected_candidate_id", F.lit(None).cast("string"))
    chosen = confirmations.where("confirmed").select(key, F.col("candidate_id").alias("selected_candidate_id"))
    legal = chosen.join(
        scored.where("eligible").select(key, F.col("candidate_id").alias("selected_candidate_id")),
        [key, "selected_candidate_id"], "left_semi").distinct()
    return out.join(legal, key, "left")


# Characters of a short piece; characters of a long one, and how many long pieces in a row share one mark.
GRAM, SPAN, WINDOW = 3, 12, 13
LONG = SPAN + WINDOW - 1
# Short needles that a task holds at once.
HELD = 50_000
# A mask of pieces has two to this power bits, 16 MB.
MASK_BITS = 27


def _packed(codes: np.ndarray, size: int) -> np.ndarray:
    """Every piece of ``size`` characters as one number, 21 bits a character."""
    n = max(len(codes) - size + 1, 0)
    out = codes[:n]
    for i in range(1, size):
        out = (out << np.uint64(21)) | codes[i:n + i]
    return out


def _grams(codes: np.ndarray) -> np.ndarray:
    return np.unique(_packed(codes, min(GRAM, len(codes))))


def _all_grams(codes: np.ndarray) -> np.ndarray:
    return np.unique(np.concatenate([_packed(codes, n) for n in range(1, GRAM + 1)]))


def _marks(codes: np.ndarray) -> np.ndarray:
    """The least hash of a piece of ``SPAN`` characters among each ``WINDOW`` in a row; two texts with the same ``LONG`` characters share one."""
    n = len(codes) - SPAN + 1
    if n < WINDOW:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for i in range(SPAN):
        h = h * np.uint64(0x9E3779B97F4A7C15) + codes[i:n + i]
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(np.lib.stride_tricks.sliding_window_view(h ^ (h >> np.uint64(32)), WINDOW).min(axis=1))


def _places(pieces: np.ndarray) -> np.ndarray:
    """The bit of each piece in a mask."""
    return (pieces * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - MASK_BITS)


def _mask(pieces: DataFrame) -> Broadcast:
    """A mask of one size for any number of rows, with the bit of each ``piece`` set."""
    @F.pandas_udf("long")
    def place(piece: pd.Series) -> pd.Series:
        return pd.Series(_places(piece.to_numpy().view(np.uint64)).view(np.int64))

    # Spark counts the bits of a bucket from one
    at = pieces.select((place("piece") + 1).alias("at"))
    buckets = at.groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    out = np.zeros((1 << MASK_BITS) // 8, np.uint8)
    for bucket, bits in buckets.collect():
        out[(bucket - 1) * len(bits):bucket * len(bits)] = np.frombuffer(bits, np.uint8)
    return pieces.sparkSession.sparkContext.broadcast(out)


def _pieces(text: Column, of: Callable[[np.ndarray], np.ndarray], mask: Broadcast | None = None) -> Column:
    """The pieces of a text, one row each; of those outside of ``mask`` none."""
    def some(pieces: np.ndarray) -> np.ndarray:
        if mask is None:
            return pieces
        at = _places(pieces)
        return pieces[(mask.value[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1]

    @F.pandas_udf("array<long>")
    def made(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: some(of(np.frombuffer(x.encode("utf-32-le"), "<u4").astype(np.uint64))).view(np.int64))

    return F.explode(made(text)).alias("piece")


def contained_names(needles: DataFrame, names: DataFrame) -> DataFrame:
    """``(needle, name)``: distinct needles that are a proper piece of a name; ``names`` may have more columns, which depend on the name.

    A needle is looked up by the one of its pieces that the fewest names have: one of up to
    ``LONG - 1`` characters by three characters, or by itself if it is shorter, a longer
    one by a mark, of which a text has about one in seven characters.  Names meet ``HELD``
    short needles at a time, in the tasks that hold their texts.  Marks leave their task
    with the hash of the name, and only those that may be of a needle, by a mask of a fixed
    size.  What is found is compared in full.  The texts of the names are dealt out once,
    by their hash, and written nowhere else.  Null and empty texts contain nothing and are
    contained in nothing.
    """
    needles = needles.select(F.col(needles.columns[0]).alias("needle")).where("needle <> ''").distinct()
    needles = checkpointed(needles.withColumn("number", F.monotonically_increasing_id()))
    first, *more = names.columns
    given = names.select(F.col(first).alias("name"), *more).where("name <> ''")
    # names of equal hashes lie together, so equal names meet there and what is found by hash needs no other order; a name is far dearer
    # to take apart than to move, so the number of tasks is not left to the size
    session = given.sparkSession
    tasks = max(int(session.conf.get("spark.sql.shuffle.partitions")), 4 * session.sparkContext.defaultParallelism)
    names = given.withColumn("id", F.xxhash64("name")).repartition(tasks, "id").distinct()
    short = F.length("needle") < LONG

    def rarest(own: DataFrame, of: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
        """The piece of each needle that the fewest names have; a needle with a piece that no name has is in none."""
        # how often a name is repeated only bears on the choice of a piece
        held = given.select(_pieces(F.col("name"), of, _mask(own))).groupBy("piece").agg(F.count("*").alias("n"))
        least = own.join(held, "piece", "left").groupBy("number").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "piece")).alias("r"))
        return checkpointed(least.where("r.n > 0").select("number", F.col("r.piece").alias("piece")))

    by_gram = rarest(needles.where(short).select("number", _pieces(F.col("needle"), _grams)), _all_grams)
    parts = max(1, -(-by_gram.count() // HELD))
    spread = names.select("name", *more, _pieces(F.col("name"), _all_grams, _mask(by_gram)))
    looked = by_gram.join(needles, "number").select("needle", "piece", F.pmod("number", F.lit(parts)).alias("part"))
    inside = reduce(DataFrame.union, [spread.join(F.broadcast(looked.where(F.col("part") == i)), "piece").select("needle", "name", *more) for i in range(parts)])
    by_mark = rarest(needles.where(~short).select("number", _pieces(F.col("needle"), _marks)), _marks)
    found = names.select("id", _pieces(F.col("name"), _marks, _mask(by_mark))).join(by_mark, "piece").select("number", "id").distinct()
    every = inside.union(found.join(needles, "number").join(names, "id").select("needle", "name", *more))
    return every.where((F.length("name") > F.length("needle")) & F.contains("name", "needle"))


def recall_top(query: DataFrame, candidates: DataFrame) -> DataFrame:
    """Best score, number of best candidates and the unique best one, over all candidates.

    Candidates are counted per set of features (known core fields, book name, place)
    and each query looks those counts up, so no query meets its candidates row by
    row.  A count for "at least these features" is exact for the best score: a
    candidate with more features would have raised it.
    """
    q, c = source_view(query, "q"), source_view(candidates, "c")

    def mask(prefix: str) -> Column:
        return reduce(lambda a, b: a + b, [
            F.when(F.col(f"{prefix}_{f}").isNull(), 0).otherwise(1 << i) for i, f in enumerate(CORE)])

    q, c = q.withColumn("q_mask", mask("q")), c.withColumn("c_mask", mask("c"))
    masks = F.explode(F.array(*[F.lit(m) for m in range(8)]))

    def core_key(prefix: str) -> list[Column]:
        shared = F.col("q_mask").bitwiseAND(F.col("c_mask"))
        return [F.when(shared.bitwiseAND(F.lit(1 << i)) != 0, F.col(f"{prefix}_{f}")).alias(f"k_{f}")
                for i, f in enumerate(CORE)]

    q_names = q.select("q_book").where("q_book IS NOT NULL").distinct()
    c_names = c.select("c_book").where("c_book IS NOT NULL").distinct()
    inside_c = contained_names(q_names, c_names).select(F.col("name").alias("c_book"), F.col("needle").alias("q_book"))
    inside_q = contained_names(c_names, q_names).select(F.col("name").alias("q_book"), F.col("needle").alias("c_book"))

    places = F.explode(F.array(*[
        F.when(ok, F.struct(F.lit(kind).alias("kind"), value.alias("value"), F.lit(points).alias("points")))
        for kind, ok, value, points in [
            ("none", F.lit(True), F.lit(""), 0),
            ("path", F.col("place_path").isNotNull(), F.col("place_path"), POINTS["catalog_path_exact"]),
            ("sort", F.col("place_name").isNotNull() & F.col("place_sort").isNotNull(),
             F.to_json(F.array("place_name", "place_sort")), POINTS["catalog_name_sort_exact"])]]))

    def with_place(df: DataFrame, prefix: str) -> DataFrame:
        renamed = df.withColumnsRenamed({f"{prefix}_path": "place_path", f"{prefix}_name": "place_name", f"{prefix}_sort": "place_sort"})
        return renamed.withColumn("_p", places).where("_p IS NOT NULL").drop("place_path", "place_name", "place_sort")

    # Candidate side: no name, own name, and names of queries found inside the own name.
    c_rows = with_place(c.withColumn("q_mask", masks), "c")
    c_base = c_rows.select("candidate_id", "c_mask", "q_mask", "c_book", *core_key("c"), "_p.kind", "_p.value")
    c_none = c_base.withColumns({"n_kind": F.lit("none"), "n_value": F.lit("")})
    c_own = c_base.where("c_book IS NOT NULL").withColumns({"n_kind": F.lit("own"), "n_value": F.col("c_book")})
    c_in = c_base.join(inside_c, "c_book").withColumns({"n_kind": F.lit("in"), "n_value": F.col("q_book")}).drop("q_book")
    lookup = ["c_mask", "q_mask", "k_subject", "k_grade", "k_volume", "kind", "value", "n_kind", "n_value"]
    counts = c_none.unionByName(c_own).unionByName(c_in).groupBy(*lookup).agg(
        F.count("*").alias("n"), F.min("candidate_id").alias("candidate_id"))

    # Query side: the same features as lookups with their points.
    q_rows = with_place(q.withColumn("c_mask", masks), "q")
    shared = F.col("q_mask").bitwiseAND(F.col("c_mask"))
    q_base = q_rows.select(
        "query_id", "c_mask", "q_mask", "q_book", *core_key("q"), "_p.kind", "_p.value",
        (F.bit_count(shared) * 15 + F.col("_p.points")).alias("points"))
    def named(df: DataFrame, kind: str, value: Column, extra: int) -> DataFrame:
        return df.withColumns({"n_kind": F.lit(kind), "n_value": value, "points": F.col("points") + extra})
    known = q_base.where("q_book IS NOT NULL")
    asks = (
        named(q_base, "none", F.lit(""), 0)
        .unionByName(named(known, "own", F.col("q_book"), POINTS["book_name_exact"]))
        .unionByName(named(known, "in", F.col("q_book"), POINTS["book_name_contains"]))
        .unionByName(named(known.join(inside_q, "q_book"), "own", F.col("c_book"), POINTS["book_name_contains"]).drop("c_book"))
    )
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"x_{k}")) for k in lookup])
    hits = asks.join(counts.withColumnsRenamed({k: f"x_{k}" for k in lookup}), on)
    per_score = hits.groupBy("query_id", "points").agg(F.sum("n").alias("n"), F.min("candidate_id").alias("candidate_id"))
    best = ranges.pick_last(per_score, ["query_id"], [F.col("points")], ["points", "n", "candidate_id"])
    unique = (F.col("points") > 0) & (F.col("n") == 1)
    return query.select("query_id").join(best, "query_id", "left").select(
        "query_id", F.col("points").alias("top_score"), F.coalesce("n", F.lit(0)).alias("n_top"),
        F.coalesce(unique, F.lit(False)).alias("unique_top"), F.when(unique, F.col("candidate_id")).alias("top_candidate_id"))


def missing(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.join(right.select(*keys).distinct(), keys, "left_anti")


def keep_known(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.join(right.select(*keys), keys, "left_semi")


def drop_known(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.join(right.select(*keys), keys, "left_anti")


def zip_by_position(source: DataFrame, target: DataFrame, keys: list[str], order: list[str], source_id: str, target_id: str) -> DataFrame:
    """The n-th source row of a key meets the n-th target row; leftovers are flagged."""
    s = ranges.numbered(source, keys, order, "position").select(*keys, "position", F.col(source_id).alias("source_id"))
    t = ranges.numbered(target, keys, order, "position").select(*keys, "position", F.col(target_id).alias("target_id"))
    status = F.when(F.col("target_id").isNull(), "missing_target").when(F.col("source_id").isNull(), "extra_target").otherwise("paired")
    return s.join(t, [*keys, "position"], "full").withColumn("status", status)


def join_progress(target: DataFrame, source: DataFrame, receipts: DataFrame, key: str, source_key: str, pos: str) -> DataFrame:
    """Targets without a receipt, each with the first source of its source key or marked as without one."""
    first = ranges.pick_first(source, [source_key], [F.col(pos)]).withColumn("_found", F.lit(True))
    joined = target.join(receipts.select(key), key, "left_anti").join(first, source_key, "left")
    return joined.withColumn("status", F.when(F.col("_found"), "open").otherwise("source_unknown")).drop("_found")


def pair_practice_analysis(pages: DataFrame) -> DataFrame:
    """Analysis pages with the topic of the one practice page of the same number."""
    keys = ["book_id", "sequence"]
    counted = pages.groupBy(*keys).agg(
        F.count(F.when(F.col("kind") == "practice", 1)).alias("n_practice"),
        F.count(F.when(F.col("kind") == "analysis", 1)).alias("n_analysis"),
        F.min(F.when(F.col("kind") == "practice", F.col("topic"))).alias("practice_topic"))
    rows = pages.where("kind = 'analysis'").drop("topic").join(counted, keys)
    paired = (F.col("n_practice") == 1) & (F.col("n_analysis") == 1)
    return rows.withColumn("topic", F.when(paired, F.col("practice_topic"))).withColumn(
        "status", F.when(paired, "paired").otherwise("needs_review")).drop("practice_topic")


def cover_required_checks(required: DataFrame, reported: DataFrame, legacy: bool = False) -> DataFrame:
    """Whether each required check is reported exactly once.

    A rule check is met by a report of its rule or of no rule, an acceptance check
    by a report of no rule.  Reports are counted before the join.
    """
    counts = reported.groupBy("run_id", "id", F.col("rule_id").alias("_rule")).agg(
        F.count("*").alias("n"), F.min("status").alias("status"))
    exact = counts.where("_rule IS NOT NULL")
    open_ = counts.where("_rule IS NULL").select("run_id", "id", F.col("n").alias("n_open"), F.col("status").alias("open_status"))
    rows = required.join(
        exact.withColumnRenamed("_rule", "rule_id"), ["run_id", "id", "rule_id"], "left").join(open_, ["run_id", "id"], "left")
    total = F.coalesce("n", F.lit(0)) + F.coalesce("n_open", F.lit(0))
    gap = "not_tested" if legacy else "missing"
    outcome = F.when(total == 1, "covered").when(total > 1, "ambiguous").otherwise(gap)
    status = F.when(total == 1, F.coalesce("status", "open_status"))
    if legacy:
        status = F.when(total == 0, "not_tested").otherwise(status)
    return rows.select("run_id", "required_key", "id", "rule_id", total.alias("n_reports"), outcome.alias("outcome"), status.alias("check_status"))


def _both_sides(old: DataFrame, new: DataFrame, keys: list[str], old_id: str, new_id: str) -> DataFrame:
    rows = old.select(*keys, F.col(old_id).alias("o"), F.lit(None).cast(new.schema[new_id].dataType).alias("n")).unionByName(
        new.select(*keys, F.lit(None).cast(old.schema[old_id].dataType).alias("o"), F.col(new_id).alias("n")))
    return rows.groupBy(*keys).agg(
        F.count("o").alias("n_old"), F.count("n").alias("n_new"), F.min("o").alias("old_id"), F.min("n").alias("new_id"))


def map_versions(old: DataFrame, new: DataFrame, keys: list[str], id_col: str = "id") -> DataFrame:
    """Old and new ids that share a content key; repeated keys go to review."""
    both = _both_sides(old, new, keys, id_col, id_col)
    one = (F.col("n_old") <= 1) & (F.col("n_new") <= 1)
    status = (
        F.when(~one, "needs_review").when(F.col("n_old") == 0, "added")
        .when(F.col("n_new") == 0, "removed").otherwise("mapped"))
    return both.select(
        *keys, F.when(one, F.col("old_id")).alias("old_id"), F.when(one, F.col("new_id")).alias("new_id"),
        "n_old", "n_new", status.alias("status"))


def match_catalogs(source: DataFrame, target: DataFrame) -> DataFrame:
    """Catalogs one to one by normalised name and ordinal."""
    def side(df: DataFrame) -> DataFrame:
        return df.select("catalog_id", normalize_name(F.lower("name")).alias("name"), "ordinal")

    both = _both_sides(side(source), side(target), ["name", "ordinal"], "catalog_id", "catalog_id")
    status = (
        F.when((F.col("n_old") > 1) | (F.col("n_new") > 1), "ambiguous").when(F.col("n_new") == 0, "missing_target")
        .when(F.col("n_old") == 0, "unexpected_target").otherwise("matched"))
    ok = status == "matched"
    return both.select(
        "name", "ordinal", F.when(ok, F.col("old_id")).alias("source_catalog_id"),
        F.when(ok, F.col("new_id")).alias("target_catalog_id"), status.alias("status"))


def bind_receipts(receipts: DataFrame, provenance: DataFrame, ledger: DataFrame) -> DataFrame:
    """Violations of the ties between a receipt, its provenance run and its ledger item."""
    p = provenance.select("run_id", *[F.col(c).alias(f"p_{c}") for c in provenance.columns if c != "run_id"])
    led = ledger.select("item_id", *[F.col(c).alias(f"l_{c}") for c in ledger.columns if c != "item_id"])
    rows = receipts.join(p, "run_id", "left").join(led, "item_id", "left")
    differs = lambda a, b: ~F.col(a).eqNullSafe(F.col(b))
    have_p, have_l = F.col("p_integrity_hash").isNotNull(), F.col("l_run_id").isNotNull()
    return explode_rules(rows.withColumn("entity_id", F.col("item_id")), [
        ("run_unknown", "error", ~have_p),
        ("ledger_item_missing", "error", ~have_l),
        ("provenance_hash_mismatch", "error", have_p & differs("provenance_integrity_hash", "p_integrity_hash")),
        ("carrier_mismatch", "error", have_p & differs("carrier_block_id", "p_carrier_block_id")),
        ("source_book_mismatch", "error", have_p & differs("source_book_id", "p_source_book_id")),
        ("target_book_mismatch", "error", have_p & differs("target_book_id", "p_target_book_id")),
        ("target_catalog_not_slide", "error", differs("target_catalog_id", "slide_id")),
        ("ledger_run_mismatch", "error", have_l & differs("run_id", "l_run_id")),
        ("ledger_result_hash_mismatch", "error", have_l & differs("page_hash", "l_save_readback_hash")),
    ])


def relative_path(base: Column, rel: Column) -> Column:
    """Path of ``rel`` seen from folder ``base``; null if it is absolute or leaves the root."""
    parts = F.filter(F.split(F.concat_ws("/", base, rel), "/"), lambda s: ~s.isin("", "."))
    escape = F.array(F.lit("\u0000"))

    def walk(acc: Column, part: Column) -> Column:
        return (
            F.when(acc == escape, escape)
            .when((part == "..") & (F.size(acc) == 0), escape)
            .when(part == "..", F.slice(acc, F.lit(1), F.size(acc) - 1))
            .otherwise(F.concat(acc, F.array(part))))

    out = F.aggregate(parts, F.array().cast("array<string>"), walk)
    return F.when(rel.startswith("/") | (out == escape), F.lit(None)).otherwise(F.array_join(out, "/"))


# Artifacts that one forward case links.
EVIDENCE_ROLES = ["source", "template", "target_before", "target_after", "save_receipt", "provenance_readback", "acceptance_report"]


def verify_evidence_chain(links: DataFrame, files: DataFrame) -> DataFrame:
    """Violations per forward case.

    ``links`` has case_id, role, base, artifact, artifact_sha256, claimed_hash and
    linked_id; ``files`` has path, sha256, canonical_hash and ids.
    """
    resolved = links.withColumn("path", relative_path(F.col("base"), F.col("artifact")))
    f = files.select("path", "sha256", "canonical_hash", "ids")
    rows = resolved.join(f, "path", "left").withColumn("entity_id", F.col("case_id").cast("string"))
    found = F.col("sha256").isNotNull()
    named = lambda text: F.concat(F.col("role"), F.lit(f" {text}"))
    per_link = explode_rules(rows, [
        ("path_escapes_root", "error", F.col("path").isNull(), named("path")),
        ("artifact_missing", "error", F.col("path").isNotNull() & ~found, named("file")),
        ("artifact_sha_mismatch", "error", found & (F.col("artifact_sha256") != F.col("sha256")), named("sha")),
        ("canonical_hash_mismatch", "error", found & ~F.col("claimed_hash").eqNullSafe(F.col("canonical_hash")), named("hash")),
        ("linked_id_absent", "error", found & F.col("linked_id").isNotNull() & ~F.array_contains("ids", F.col("linked_id")), named("id")),
    ])
    pick = lambda role, c: F.max(F.when(F.col("role") == role, F.col(c)))
    cases = links.groupBy(F.col("case_id").cast("string").alias("entity_id")).agg(
        F.count_distinct("role").alias("n_roles"),
        pick("target_before", "linked_id").alias("b_id"), pick("target_after", "linked_id").alias("a_id"),
        pick("target_before", "claimed_hash").alias("b_hash"), pick("target_after", "claimed_hash").alias("a_hash"))
    per_case = explode_rules(cases, [
        ("links_incomplete", "error", F.col("n_roles") < len(EVIDENCE_ROLES)),
        ("target_changed_identity", "error", F.col("b_id") != F.col("a_id")),
        ("target_unchanged", "error", F.col("b_hash") == F.col("a_hash")),
    ])
    return per_link.unionByName(per_case)


def artifact_closure(starts: DataFrame, edges: DataFrame) -> DataFrame:
    """Everything reachable from each start: (root, node, depth).

    One join per depth with the newly found nodes only, until a depth finds none; each
    frontier is checkpointed, so a lost executor does not replay earlier depths.
    """
    links = edges.select(F.col("src").alias("node"), "dst").distinct()
    frontier = starts.select("root", "node").distinct().withColumn("depth", F.lit(0))
    seen = checkpointed(frontier)
    frontier = seen
    depth = 0
    while True:
        depth += 1
        step = frontier.join(links, "node").select("root", F.col("dst").alias("node")).distinct()
        fresh = checkpointed(step.join(seen, ["root", "node"], "left_anti").withColumn("depth", F.lit(depth)))
        if fresh.isEmpty():
            return seen
        seen = seen.unionByName(fresh)
        frontier = fresh


def normal_path(path: Column) -> Column:
    """A path without empty, ``.`` and resolvable ``..`` steps; what leaves its start keeps leading ``..``."""
    def step(done: Column, part: Column) -> Column:
        back = (part == "..") & (F.size(done) > 0) & (F.coalesce(F.element_at(done, -1), F.lit("")) != "..")
        return F.when(part.isin("", "."), done).when(back, F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(F.concat(done, F.array(part)))

    return F.array_join(F.aggregate(F.split(path, "/"), F.array().cast("array<string>"), step), "/")


def file_references(files: DataFrame, root: str = "/work", keys: tuple[str, ...] = ("artifact", "evidence_artifact")) -> DataFrame:
    """``(src, dst)``: files that a JSON file names at any depth, as paths below ``root``.

    ``files (path, raw)`` with paths below the root.  A reference is taken from the
    folder of the file that holds it; an absolute one counts from the root if it lies
    there.  What leaves the root keeps its ``..`` or its leading slash.
    """
    docs = files.select(F.col("path").alias("src"), F.try_parse_json("raw").alias("doc")).where("doc IS NOT NULL")
    named = collect_named_values(docs, "doc", list(keys)).where(F.schema_of_variant("value") == "STRING")
    said = named.select("src", F.try_variant_get("value", "$", "string").alias("said"))
    return said.select("src", _resolved(F.regexp_replace("src", "[^/]*$", ""), F.col("said"), root).alias("dst")).distinct()


def _resolved(folder: Column, said: Column, root: str) -> Column:
    base = root.rstrip("/") + "/"
    absolute = F.concat(F.lit("/"), normal_path(said))
    inside = F.when(absolute.startswith(base), F.substring(absolute, F.lit(len(base) + 1), F.length(absolute))).otherwise(absolute)
    return F.when(said.startswith("/"), inside).otherwise(normal_path(F.concat(folder, said)))


def file_closure(starts: DataFrame, files: DataFrame, root: str = "/work") -> DataFrame:
    """Every file that a start reaches through references: ``root, node, depth, status``.

    ``starts (root, node)`` names the first files, ``files (path, raw)`` all of them.
    ``status`` is ``ok``, ``escape`` for what leaves the root, ``missing`` or
    ``invalid_json``; only sound files are followed, and cycles end where they close.
    """
    first = starts.select("root", _resolved(F.lit(""), F.col("node"), root).alias("node"))
    edges = file_references(files, root)
    reached = artifact_closure(first, edges)
    about = files.groupBy("path").agg(F.max(F.try_parse_json("raw").isNotNull()).alias("sound")).withColumnRenamed("path", "node")
    node = F.col("node")
    escaped = (node == "..") | node.startswith("../") | node.startswith("/")
    return reached.join(about, "node", "left").select("root", "node", "depth", F.when(escaped, "escape").when(F.col("sound").isNull(), "missing").when(
        ~F.col("sound"), "invalid_json").otherwise("ok").alias("status"))


def plan_modules(expected: DataFrame, existing: DataFrame) -> DataFrame:
    """Action per element; a page is ready only if none of its elements is blocked."""
    linked = existing.select("element_id").distinct().withColumn("linked", F.lit(True))
    rows = expected.join(linked, "element_id", "left")
    action = F.when(F.col("linked"), "skip").when(F.col("locator_valid"), "create").otherwise("blocked")
    rows = rows.withColumn("action", action).drop("linked")
    pages = rows.groupBy("page_id").agg(F.count(F.when(F.col("action") == "blocked", 1)).alias("_b"))
    return rows.join(pages, "page_id").withColumn("page_ready", F.col("_b") == 0).drop("_b")


def plan_refinement(base: DataFrame, cur: DataFrame, want: DataFrame, keys: list[str]) -> DataFrame:
    """Three-way plan per key.

    Each side has the keys and ``value`` (canonical text, a JSON null is the text
    ``null``); ``want`` may have ``is_delete``.  The sides meet in one aggregation,
    one shuffle instead of two full outer joins.
    """
    def side(df: DataFrame, tag: str) -> DataFrame:
        gone = F.col("is_delete") if "is_delete" in df.columns else F.lit(False)
        return df.select(*keys, F.lit(tag).alias("s"), F.col("value").cast("string").alias("v"), gone.alias("d"))

    merged = side(base, "b").unionByName(side(cur, "c")).unionByName(side(want, "w")).groupBy(*keys)
    pick = lambda tag, c: F.max(F.when(F.col("s") == tag, F.col(c)))
    has = lambda tag: F.count(F.when(F.col("s") == tag, 1)) > 0
    rows = merged.agg(
        has("b").alias("baseline_present"), has("c").alias("current_present"), has("w").alias("want_listed"),
        pick("b", "v").alias("baseline_value"), pick("c", "v").alias("current_value"), pick("w", "v").alias("want_value"),
        F.coalesce(pick("w", "d"), F.lit(False)).alias("is_delete"))
    rows = rows.withColumn("desired_present", F.col("want_listed") & ~F.col("is_delete"))
    boxed = lambda present, value: F.when(present, F.struct(value.alias("v")))
    b = boxed(F.col("baseline_present"), F.col("baseline_value"))
    c = boxed(F.col("current_present"), F.col("current_value"))
    goal = F.when(F.col("is_delete"), F.lit(None)).when(
        F.col("want_listed"), F.struct(F.col("want_value").alias("v"))).otherwise(b)
    same_goal, done, untouched = goal.eqNullSafe(b), c.eqNullSafe(goal), c.eqNullSafe(b)
    kind = F.when(same_goal | done, "noop").when(untouched, "safe").otherwise("conflict")
    reason = (
        F.when(same_goal, "desired_did_not_change_from_baseline").when(done, "current_already_matches_desired")
        .when(untouched, "current_matches_baseline").otherwise("current_and_desired_diverged_from_baseline"))
    return rows.select(
        *keys, kind.alias("classification"), reason.alias("reason"),
        F.when(F.col("desired_present"), "set").otherwise("delete").alias("operation"),
        "baseline_present", "current_present", "desired_present", "baseline_value", "current_value",
        F.when(F.col("desired_present"), F.col("want_value")).alias("desired_value"))
