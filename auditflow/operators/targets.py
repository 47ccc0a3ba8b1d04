"""Checks of converted pages and of their modules, and of a whole ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditflow.functions.canon import SHA_PATTERN, blank_to_null
from auditflow.functions.layout import spacer_ok
from auditflow.functions.text import html_text
from auditflow.operators import checks as K
from auditflow.operators.checks import explode_rules
from auditflow.operators.report import ALL_STATES

# Locator modules and the page role they lead to, module names and types.
LOCATORS = [("查看英文原文", "english"), ("查看中文翻译", "translation"), ("查看重点词汇", "vocabulary"), ("查看拼读内容", "phonics")]
LOCATOR_TYPE = 80
AUDIO, ORAL_PK, ORAL_TEST, MNEMONIC = "美文随身听", "口语PK", "口语AI测评", "巧记单词"
N_MODULES = 8


def verify_targets(plans: DataFrame, targets: DataFrame, modules: DataFrame, book_id: str, elements: list[str], forbidden: str) -> DataFrame:
    """Violations of converted pages against their source plans.

    ``plans`` and ``targets`` meet on ``position``; ``modules`` belong to target
    pages and of a repeated name the last counts.
    """
    here = lambda name: F.when(F.col("name") == name, F.col("pos"))
    names = [*(name for name, _ in LOCATORS), AUDIO, ORAL_PK, ORAL_TEST, MNEMONIC]
    values = F.struct("module_type", "resource_id", "module_catalog_id", "file_id", "url", "agent_id", "text_id", "guid")
    picks = {"audio": (AUDIO, {"type": "module_type", "file": "file_id", "url": "url"}), "pk": (ORAL_PK, {"agent": "agent_id", "text": "text_id"}),
             "test": (ORAL_TEST, {"agent": "agent_id", "text": "text_id"}), "mn": (MNEMONIC, {"type": "module_type", "guid": "guid"}),
             **{f"loc{i}": (name, {"type": "module_type", "res": "resource_id", "cat": "module_catalog_id"}) for i, (name, _) in enumerate(LOCATORS)}}
    last = modules.where(F.col("name").isin(names)).groupBy("page_id").agg(*[F.max_by(values, here(n)).alias(f"_{i}") for i, n in enumerate(names)])
    last = last.select("page_id", *[F.col(f"_{names.index(name)}.{c}").alias(f"{k}_{f}") for k, (name, fields) in picks.items() for f, c in fields.items()])
    # elements first: counts of distinct values beside each other would send every module several times
    per_element = modules.groupBy("page_id", "element_id").agg(F.count("*").alias("n"))
    counts = per_element.groupBy("page_id").agg(
        F.sum("n").alias("n_modules"), F.count("element_id").alias("n_elements"),
        F.count(F.when(F.col("element_id").isin(elements), 1)).alias("n_template"),
        F.sum(F.when(F.col("element_id") == forbidden, F.col("n"))).alias("n_forbidden"))
    per_page = counts.join(last, "page_id", "left")
    p = plans.select("position", *[F.col(c).alias(f"p_{c}") for c in plans.columns if c != "position"])
    rows = p.join(targets, "position", "full").join(per_page, "page_id", "left")
    differs = lambda a, b: ~F.col(a).cast("string").eqNullSafe(F.col(b).cast("string"))
    have = F.col("page_id").isNotNull()
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    rules = [
        ("position_unmatched", "error", ~have | F.col("p_name").isNull()),
        ("wrong_book", "error", have & ~F.col("book_id").cast("string").eqNullSafe(F.lit(book_id))),
        ("wrong_slide", "error", have & differs("catalog_id", "page_id")),
        ("catalog_name", "error", have & differs("catalog_name", "p_name")),
        ("catalog_sort", "error", have & differs("catalog_sort", "position")),
        ("dirty", "error", F.col("dirty")),
        ("module_count", "error", have & (n("n_modules") != N_MODULES)),
        ("module_elements", "error", have & (n("n_elements") != N_MODULES)),
        ("module_set", "error", have & (n("n_template") != len(elements))),
        ("module_forbidden", "error", n("n_forbidden") > 0),
    ]
    for i, (_, role) in enumerate(LOCATORS):
        there = F.coalesce(F.col(f"loc{i}_type") == LOCATOR_TYPE, F.lit(False))
        wrong_res = differs(f"loc{i}_res", f"p_{role}_block")
        rules += [
            (f"locator_{role}", "error", have & ~there),
            (f"locator_{role}_resource", "error", there & wrong_res),
            (f"locator_{role}_catalog", "error", there & ~wrong_res & differs(f"loc{i}_cat", "page_id")),
        ]
    audio = F.coalesce(F.col("audio_type") == 77, F.lit(False))
    wrong_file = differs("audio_file", "p_audio_file")
    pk, test = F.coalesce(F.col("pk_agent") == 27, F.lit(False)), F.coalesce(F.col("test_agent") == 34, F.lit(False))
    mn = F.coalesce(F.col("mn_type") == 79, F.lit(False))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    spacer = F.col("spacer_width").isNotNull()
    rules += [
        ("audio", "error", have & ~audio), ("audio_file", "error", audio & wrong_file),
        ("audio_url", "error", audio & ~wrong_file & differs("audio_url", "p_audio_url")),
        ("oral_pk", "error", have & ~pk), ("oral_pk_text", "error", pk & (text("pk_text") != text("p_pk_text"))),
        ("oral_test", "error", have & ~test), ("oral_test_text", "error", test & (text("test_text") != text("p_test_text"))),
        ("mnemonic", "error", have & ~mn), ("mnemonic_guid", "error", mn & differs("mn_guid", "p_guid")),
        ("spacer_missing", "error", have & ~spacer),
        ("spacer", "error", spacer & ~spacer_ok(*[F.col(f"spacer_{c}") for c in ("width", "height", "type", "color", "elements")])),
        ("block_width", "error", n("n_bad_width") > 0), ("block_type", "error", n("n_bad_type") > 0),
        ("title_text", "error", have & (html_text("title_html") != html_text("p_name"))),
        ("article_text", "error", have & (html_text("article_html") != html_text("p_article"))),
        ("completeness_warning", "error", n("n_other_warnings") > 0),
    ]
    return explode_rules(rows.withColumn("entity_id", F.col("position")), rules)


def page_resource_scope(locators: DataFrame, targets: DataFrame, source_blocks: DataFrame) -> DataFrame:
    """Locators lead to a block of the source page, carry the target catalog, and stay in family and grade.

    ``locators``: page_id, element_id, resource_id, catalog_id; ``targets``: page_id,
    source_page_id, family, grade; ``source_blocks``: resource_id, page_id, family, grade.
    """
    t = targets.select("page_id", "source_page_id", F.col("family").alias("t_family"), F.col("grade").alias("t_grade"))
    # A repeated resource is one violation, judged by its smallest row; it never multiplies locators.
    b = source_blocks.groupBy("resource_id").agg(F.min(F.struct("page_id", "family", "grade")).alias("_b"), F.count("*").alias("n_resource")).select(
        "resource_id", F.col("_b.page_id").alias("b_page"), F.col("_b.family").alias("b_family"), F.col("_b.grade").alias("b_grade"), "n_resource")
    rows = locators.join(t, "page_id", "left").join(b, "resource_id", "left").withColumn(
        "entity_id", F.concat_ws("/", F.col("page_id").cast("string"), F.col("element_id").cast("string")))
    known = F.col("b_page").isNotNull()
    return explode_rules(rows, [
        ("target_unknown", "error", F.col("source_page_id").isNull()),
        ("resource_unknown", "error", ~known),
        ("resource_repeated", "error", F.col("n_resource") > 1),
        ("resource_other_page", "error", known & (F.col("b_page") != F.col("source_page_id"))),
        ("catalog_not_target", "error", ~F.col("catalog_id").eqNullSafe(F.col("page_id"))),
        ("family_mismatch", "error", known & (F.col("b_family") != F.col("t_family"))),
        ("grade_mismatch", "error", known & (F.col("b_grade") != F.col("t_grade"))),
    ])


def locator_resolution(locators: DataFrame, source_blocks: DataFrame) -> DataFrame:
    """A locator must target a block and read back its source book, catalog and block."""
    b = source_blocks.groupBy("resource_id").agg(F.min(F.struct("book_id", "catalog_id")).alias("_b"), F.count("*").alias("n_resource")).select(
        "resource_id", F.col("_b.book_id").alias("b_book"), F.col("_b.catalog_id").alias("b_catalog"), "n_resource")
    rows = locators.join(b, "resource_id", "left").withColumn("entity_id", F.col("module_id"))
    resolved = F.col("source_book_id").isNotNull() & F.col("source_catalog_id").isNotNull()
    known = F.col("b_book").isNotNull()
    return explode_rules(rows, [
        ("target_not_block", "error", ~F.col("target_type").eqNullSafe(F.lit("block"))),
        ("resource_only", "error", F.col("resource_id").isNotNull() & ~resolved),
        ("block_unknown", "error", resolved & ~known),
        ("resource_repeated", "error", F.col("n_resource") > 1),
        ("book_mismatch", "error", resolved & known & (F.col("source_book_id") != F.col("b_book"))),
        ("catalog_mismatch", "error", resolved & known & (F.col("source_catalog_id") != F.col("b_catalog"))),
    ])


def _blank(c: str) -> Column:
    return blank_to_null(F.col(c).cast("string")).isNull()


def validate_ledger(items: DataFrame, key: Column) -> DataFrame:
    """Violations of ledger items, alone and across items.

    ``key`` recomputes the idempotency key from the columns of an item.
    """
    bound = F.col("state").isin("preflighted", "applied", "saved", "verified", "verified_skip")
    p = ~_blank("prospective")
    rows = items.withColumn("_key", key).withColumn("entity_id", F.col("item_id"))
    found = explode_rules(rows, [
        ("item_id", "error", _blank("item_id")), ("lock_key", "error", _blank("lock_key")),
        ("lock_key_is_item", "error", (F.col("lock_key") == F.col("item_id").cast("string")) & _blank("target_book_id")),
        ("target_identity", "error", _blank("stable_identity") | F.col("scope").isNull()),
        ("identity_not_prospective", "error", p & ~F.col("stable_identity").eqNullSafe(F.col("prospective"))),
        ("prospective_required", "error", _blank("target_book_id") & ~p),
        ("promoted_book", "error", ~_blank("promoted_book_id") & ~F.col("promoted_book_id").eqNullSafe(F.col("target_book_id"))),
        ("state", "error", ~F.coalesce(F.col("state").isin(ALL_STATES), F.lit(False))),
        ("history_empty", "error", F.coalesce("n_history", F.lit(0)) == 0),
        ("idempotency_form", "error", F.col("idempotency_key").isNotNull() & ~F.col("idempotency_key").rlike(SHA_PATTERN)),
        ("idempotency_required", "error", bound & _blank("idempotency_key")),
        ("fingerprint_required", "error", bound & F.col("source_snapshot_hash").isNull()),
        ("idempotency_mismatch", "error", bound & F.col("source_snapshot_hash").isNotNull() & ~F.col("idempotency_key").eqNullSafe(F.col("_key"))),
    ])
    twice = items.groupBy("item_id").agg(F.count("*").alias("n")).where("n > 1")
    found = found.unionByName(K.violations(twice, "item_id", "item_duplicate"))

    def one_partner(a: str, b: str, code: str) -> DataFrame:
        pairs = items.where(~_blank(a) & ~_blank(b)).groupBy(a).agg(F.min(b).alias("lo"), F.max(b).alias("hi"))
        return K.violations(pairs.where("lo <> hi"), a, code)

    return (
        found.unionByName(one_partner("prospective", "lock_key", "prospective_many_locks"))
        .unionByName(one_partner("lock_key", "prospective", "lock_many_prospectives"))
        .unionByName(one_partner("promoted_book_id", "stable_identity", "book_many_identities")))
