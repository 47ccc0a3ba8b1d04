"""Snapshot tables: roles, names, texts, catalogs, plans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditflow.functions import text as X
from auditflow.functions.canon import ordered_hash
from auditflow.functions.layout import js_length
from auditflow.operators import ranges
from auditflow.operators.checks import explode_rules
from auditflow.session import checkpointed

# Block roles of a dialogue course by block name.
CATALOG_ROLES = [
    ("dialogue", "name", r"2-对话"),
    ("learning_path", "name", r"3-口语学习路径"),
    ("words", "name", r"4-单词和句型"),
    ("write", "name", r"(?i)5-write"),
]
# Selected texts as (field, block role, element name, name of a parent).
CATALOG_TEXTS = [
    ("prompt_zh", "dialogue", "一级标题（中文）", None),
    ("title_en", "dialogue", "一级标题（英文）", None),
    ("learning_en", "learning_path", "一级标题（英文）", None),
    ("learning_zh", "learning_path", "一级标题（中文）", None),
    ("sentences", "words", "文本 框", "句型"),
    ("words_en", "words", "文本框", "单词"),
    ("words_zh", "words", "中文翻译", "单词"),
]
# Named modules and their types; the first is the dialogue audio, the rest the path entries.
CATALOG_MODULES = [
    ("按钮-磨耳朵", 77), ("按钮-看口语视频", 78), ("按钮-听句型讲解", 78), ("按钮-单词巧记", 79),
    ("按钮-句型巧练", 82), ("按钮-AI口语跟读测评", 79), ("按钮-口语PK", 87),
]
PRINT_MODULE = 84
# Block roles of a reading page and its modules as (role, type, agent).
READING_ROLES = [
    ("english", "name", r"^2-英文文本"), ("translation", "name", r"^3-翻译文本"), ("button", "name", r"^4-按钮"),
    ("vocabulary", "name", r"^5-一级标题"), ("mnemonic", "name", r"^7-按钮"), ("phonics", "name", r"^8-一级"),
]
READING_MODULES = [("audio", 77, None), ("agent27", 87, 27), ("agent34", 87, 34), ("courseware", 79, None)]
# Block roles of a thinking course by template id.
COURSE_ROLES = [
    ("question", "template_id", r"^10042$"), ("key", "template_id", r"^10043$"), ("method", "template_id", r"^10045$"),
    ("summary", "template_id", r"^10046$"), ("variant", "template_id", r"^10048$"), ("analysis", "template_id", r"^10049$"),
    ("variant_key", "template_id", r"^10050$"), ("ability", "template_id", r"^11542$"),
]


def classify_blocks(blocks: DataFrame, rules: list[tuple[str, str, str]], name: str = "role") -> DataFrame:
    """Role of each block by the first rule (role, column, pattern) that matches."""
    role = F.lit(None).cast("string")
    for value, column, pattern in reversed(rules):
        role = F.when(F.coalesce(F.col(column).cast("string").rlike(pattern), F.lit(False)), value).otherwise(role)
    return blocks.withColumn(name, role)


def with_topic(pages: DataFrame, name: str) -> DataFrame:
    return pages.withColumns({"topic": X.topic_of(name), "sequence": X.sequence_of(name)})


def normalize_modules(modules: DataFrame, doc: str = "doc") -> DataFrame:
    """Flat module columns from the captured item; a missing config is an empty object."""
    get = lambda path, kind: F.try_variant_get(doc, path, kind)
    return modules.select(
        *[c for c in modules.columns if c != doc],
        get("$.elementId", "string").alias("element_id"), get("$.blockId", "string").alias("block_id"),
        get("$.normalized.type", "int").alias("module_type"), get("$.normalized.modelId", "string").alias("model_id"),
        F.coalesce(get("$.normalized.config", "variant"), F.parse_json(F.lit("{}"))).alias("config"))


def module_names(modules: DataFrame, index: DataFrame, keys: list[str]) -> DataFrame:
    """Element name per module; of repeated element ids the last wins."""
    names = index.groupBy(*keys, "element_id").agg(F.max_by("name", "pos").alias("element_name"))
    return modules.join(names, [*keys, "element_id"], "left")


def attach_rich_text(blocks: DataFrame, rich: DataFrame, order: list[str], size: int = 1000) -> DataFrame:
    """Trimmed texts of each block in order, in segments; a block without text has an empty list."""
    lists = ranges.segments(rich, ["block_id"], order, F.trim(F.coalesce("plain_text", F.lit(""))), "texts", size)
    out = blocks.join(lists, "block_id", "left")
    return out.withColumn("texts", F.coalesce("texts", F.array().cast("array<string>")))


def selected_elements(blocks: DataFrame, elements: DataFrame) -> DataFrame:
    """Elements that fill a text field of the catalog, with the field name."""
    roles = classify_blocks(blocks, CATALOG_ROLES).where("role IS NOT NULL").select("catalog_id", "block_id", "role")
    rows = elements.where("type = 'text'").join(roles, ["catalog_id", "block_id"])
    field = F.lit(None).cast("string")
    for value, role, name, parent in CATALOG_TEXTS:
        hit = (F.col("role") == role) & (F.col("name") == name)
        if parent is not None:
            hit = hit & F.array_contains("parent_names", parent)
        field = F.when(hit, value).otherwise(field)
    return rows.withColumn("field", field).where("field IS NOT NULL")


def classify_warnings(warnings: DataFrame, selected: DataFrame, modules: DataFrame) -> DataFrame:
    """Warnings with ``relevant`` set where they touch a selected text or a module."""
    chosen = selected.select("catalog_id", "element_id").unionByName(modules.select("catalog_id", "element_id")).distinct()
    return warnings.join(chosen.withColumn("_r", F.lit(True)), ["catalog_id", "element_id"], "left").withColumn(
        "relevant", F.coalesce("_r", F.lit(False))).drop("_r")


def extract_catalogs(
    blocks: DataFrame, elements: DataFrame, modules: DataFrame, warnings: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One record per catalog, its classified warnings and the violations."""
    roles = classify_blocks(blocks, CATALOG_ROLES)
    per_role = roles.groupBy("catalog_id").agg(
        *[F.count(F.when(F.col("role") == r, 1)).alias(f"n_{r}") for r, _, _ in CATALOG_ROLES],
        *[F.min(F.when(F.col("role") == r, F.col("block_id"))).alias(f"block_{r}") for r, _, _ in CATALOG_ROLES])
    # Two branches need the selected texts; flattening the trees twice would cost more.
    chosen = checkpointed(selected_elements(blocks, elements))
    texts = chosen.groupBy("catalog_id").agg(
        *[F.count(F.when(F.col("field") == f, 1)).alias(f"n_{f}") for f, *_ in CATALOG_TEXTS],
        *[F.min_by(F.when(F.col("field") == f, F.col("content")), F.when(F.col("field") == f, F.col("element_id"))).alias(f"html_{f}")
          for f, *_ in CATALOG_TEXTS])
    named = [F.when((F.col("element_name") == n) & (F.col("module_type") == k), F.col("model_id")) for n, k in CATALOG_MODULES]
    printed = F.when(F.col("module_type") == PRINT_MODULE, F.col("model_id"))
    mods = modules.groupBy("catalog_id").agg(
        *[F.count(c).alias(f"n_module{i}") for i, c in enumerate(named)],
        *[F.min(c).alias(f"module{i}") for i, c in enumerate(named)],
        F.count(printed).alias("n_print"), F.min(printed).alias("print_model"))
    classified = classify_warnings(warnings, chosen, modules)
    warned = classified.groupBy("catalog_id").agg(
        F.count(F.when(F.col("relevant"), 1)).alias("n_relevant"), F.count(F.when(~F.col("relevant"), 1)).alias("n_excluded"))
    rows = per_role.join(texts, "catalog_id", "left").join(mods, "catalog_id", "left").join(warned, "catalog_id", "left")
    joined = lambda f: F.array_join(X.html_lines(f"html_{f}"), " ")
    rows = rows.withColumns({
        "s": X.html_lines("html_sentences"), "en": X.html_lines("html_words_en"), "zh": X.html_lines("html_words_zh")})
    n = F.size("s")
    catalogs = rows.select(
        "catalog_id", joined("title_en").alias("title_en"), joined("prompt_zh").alias("prompt_zh"),
        joined("learning_en").alias("learning_en"), joined("learning_zh").alias("learning_zh"),
        F.col("s").alias("sentences"),
        F.when(n.between(2, 5), "resolved_from_source_structure").otherwise("needs_visual_or_semantic_resolution").alias("sentence_status"),
        F.transform("en", lambda w, i: F.struct(w.alias("english"), F.when(F.size("zh") == 4, F.get("zh", i)).alias("chinese"))).alias("words"),
        F.col("zh").alias("words_chinese_raw"),
        F.when(F.size("zh") == 4, "resolved_from_source_paragraphs").otherwise("needs_visual_or_semantic_resolution").alias("word_pairing_status"),
        F.col("module0").alias("audio_model"),
        F.array(*[F.col(f"module{i}") for i in range(1, len(CATALOG_MODULES))]).alias("entries"), "print_model",
        *[F.col(f"block_{r}") for r, _, _ in CATALOG_ROLES],
        F.coalesce("n_relevant", F.lit(0)).alias("n_relevant"), F.coalesce("n_excluded", F.lit(0)).alias("n_excluded"),
        (F.coalesce("n_relevant", F.lit(0)) == 0).alias("scoped_complete"))
    wrong = lambda c: F.coalesce(F.col(c), F.lit(0)) != 1
    found = explode_rules(rows.withColumn("entity_id", F.col("catalog_id")), [
        *[(f"block_{r}", "error", wrong(f"n_{r}")) for r, _, _ in CATALOG_ROLES],
        *[(f"text_{f}", "error", wrong(f"n_{f}")) for f, *_ in CATALOG_TEXTS],
        *[(f"module_{i}", "error", wrong(f"n_module{i}")) for i in range(len(CATALOG_MODULES))],
        ("module_print", "error", wrong("n_print")),
    ])
    return catalogs, classified, found


def apply_overrides(catalogs: DataFrame, warnings: DataFrame, overrides: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Catalogs with explicit overrides, warnings with ``accepted``, and violations.

    An override that breaks a rule is reported and not applied.
    """
    warnings = checkpointed(warnings)
    o = overrides.select("catalog_id", F.col("sentences").alias("o_sentences"), "sentence_evidence",
                         F.col("words_english").alias("o_en"), F.col("words_chinese").alias("o_zh"), "word_pairing_evidence",
                         "accept_relevant_warnings")
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    rows = catalogs.join(o, "catalog_id", "left")
    has_s, has_en, has_zh = (F.col(c).isNotNull() for c in ("o_sentences", "o_en", "o_zh"))
    bad_s = has_s & ~F.size("o_sentences").between(2, 5)
    bad_en, bad_zh = has_en & (F.size("o_en") != 4), has_zh & (F.size("o_zh") != 4)
    english = F.coalesce("o_en", F.transform("words", lambda w: w["english"]))
    short = has_zh & ~bad_zh & (F.size(english) != 4)
    no_ev_s, no_ev_w = has_s & blank("sentence_evidence"), (has_en | has_zh) & blank("word_pairing_evidence")
    rows = rows.withColumns({
        "_ok_s": has_s & ~bad_s & ~no_ev_s,
        "_ok_w": (has_en | has_zh) & ~bad_en & ~bad_zh & ~short & ~no_ev_w,
        "_bad_s": bad_s, "_bad_en": bad_en, "_bad_zh": bad_zh, "_short": short, "_no_s": no_ev_s, "_no_w": no_ev_w})
    words = F.transform(english, lambda e, i: F.struct(e.alias("english"), F.coalesce(
        F.get("o_zh", i), F.get("words", i)["chinese"]).alias("chinese")))
    explicit = F.lit("resolved_from_explicit_source_override")

    accepted = overrides.select("catalog_id", F.explode("accept_relevant_warnings").alias("a")).groupBy(
        "catalog_id", F.col("a.code").alias("code"), F.col("a.target_element_id").alias("element_id")).agg(
        F.count("*").alias("n_accept"))
    relevant = ranges.numbered(warnings.where("relevant"), ["catalog_id", "code", "element_id"], ["pos"], "_n")
    marked = relevant.join(accepted, ["catalog_id", "code", "element_id"], "left").withColumn(
        "accepted", F.coalesce(F.col("_n") <= F.col("n_accept"), F.lit(False))).drop("_n", "n_accept")
    all_warnings = marked.unionByName(warnings.where("NOT relevant").withColumn("accepted", F.lit(False)))
    left_over = marked.where("NOT accepted").groupBy("catalog_id").agg(F.count("*").alias("_left"))
    out = rows.join(left_over, "catalog_id", "left").select(
        "catalog_id", "title_en", F.when(F.col("_ok_s"), F.col("o_sentences")).otherwise(F.col("sentences")).alias("sentences"),
        F.when(F.col("_ok_s"), explicit).otherwise(F.col("sentence_status")).alias("sentence_status"),
        F.when(F.col("_ok_w"), words).otherwise(F.col("words")).alias("words"),
        F.when(F.col("_ok_w"), explicit).otherwise(F.col("word_pairing_status")).alias("word_pairing_status"),
        F.coalesce("_left", F.lit(0)).alias("n_relevant"), F.col("_left").isNull().alias("scoped_complete"))
    found = explode_rules(rows.withColumn("entity_id", F.col("catalog_id")), [
        ("sentences_count", "error", F.col("_bad_s")), ("sentence_evidence_required", "error", F.col("_no_s")),
        ("words_english_count", "error", F.col("_bad_en")), ("words_chinese_count", "error", F.col("_bad_zh")),
        ("words_english_required", "error", F.col("_short")), ("word_evidence_required", "error", F.col("_no_w"))])
    counts = warnings.where("relevant").groupBy("catalog_id", "code", "element_id").agg(F.count("*").alias("n"))
    lost = accepted.join(counts, ["catalog_id", "code", "element_id"], "left").where("n_accept > coalesce(n, 0)")
    lost_rows = explode_rules(lost.withColumn("entity_id", F.col("catalog_id")), [
        ("accepted_warning_not_found", "error", F.lit(True), F.concat_ws("/", "code", "element_id"))])
    return out, all_warnings, found.unionByName(lost_rows)


def unresolved_catalogs(catalogs: DataFrame) -> DataFrame:
    """Catalogs that may not enter a manifest."""
    open_words = F.exists("words", lambda w: F.coalesce(w["english"], F.lit("")).eqNullSafe("") | F.coalesce(w["chinese"], F.lit("")).eqNullSafe(""))
    return explode_rules(catalogs.withColumn("entity_id", F.col("catalog_id")), [
        ("sentence_count", "error", ~F.size("sentences").between(2, 5)),
        ("word_pairing_unresolved", "error", open_words)])


def build_bindings(rules: DataFrame, applied: DataFrame, pages: DataFrame) -> DataFrame:
    """One binding per page and rule of its pack, applied or skipped, with its hash."""
    rows = pages.join(rules, "pack_id").join(applied, ["page_id", "rule_id"], "left")
    is_applied = F.col("block_id").isNotNull()
    entity = F.when(is_applied, F.col("block_id").cast("string")).otherwise(F.concat(F.lit("route-"), F.col("rule_id").cast("string")))
    out = rows.select(
        F.col("page_id").cast("string").alias("page_id"), F.col("rule_id").cast("string").alias("rule_id"),
        F.when(is_applied, "applied").otherwise("skipped").alias("status"),
        F.when(is_applied, "block").otherwise("route").alias("entity_kind"), entity.alias("entity_id"),
        F.when(is_applied, "declared block").otherwise("no block on this route").alias("reason"))
    return out.withColumn("binding_hash", ordered_hash("entity_id", "entity_kind", "page_id", "rule_id", "status"))


def source_plan(blocks: DataFrame, rich: DataFrame, modules: DataFrame) -> DataFrame:
    """Per page: role blocks, the article, modules, and the list of missing roles."""
    roles = classify_blocks(blocks, READING_ROLES)
    first = lambda hit, c: F.min_by(F.when(hit, F.col(c)), F.when(hit, F.col("pos")))
    per_page = roles.groupBy("page_id").agg(
        *[first(F.col("role") == r, "block_id").alias(r) for r, _, _ in READING_ROLES])
    # The english block id is unique, so this join keeps one row per text.
    english = per_page.where("english IS NOT NULL").select("page_id", F.col("english").alias("block_id"))
    articles = ranges.pick_first(
        rich.join(english, "block_id"), ["page_id"], [-js_length("display_text"), F.col("pos")], ["element_id", "display_text"])
    hits = []
    for role, kind, agent in READING_MODULES:
        hit = F.col("module_type") == kind
        if agent is not None:
            hit = hit & (F.col("agent_id") == agent)
        hits.append(first(hit, "model_id").alias(role))
    mods = modules.groupBy("page_id").agg(*hits)
    rows = per_page.join(articles, "page_id", "left").join(mods, "page_id", "left")
    required = [r for r, _, _ in READING_ROLES] + ["article"] + [r for r, _, _ in READING_MODULES]
    rows = rows.withColumn("article", F.col("element_id"))
    lacking = F.filter(F.array(*[F.when(F.col(r).isNull(), F.lit(r)) for r in required]), lambda r: r.isNotNull())
    return rows.select(
        "page_id", *required, F.rtrim("display_text").alias("plain_text"), lacking.alias("missing"))


def manifest_completeness(plans: DataFrame) -> DataFrame:
    """A violation per page that lacks a role, naming the roles."""
    return explode_rules(plans.withColumn("entity_id", F.col("page_id")), [
        ("roles_missing", "error", F.size("missing") > 0, F.array_join("missing", ","))])


def emphasis_runs(rich: DataFrame, colors: list[str] | None = None) -> DataFrame:
    """Runs in the emphasis color, without their link."""
    wanted = [c.lower().replace(" ", "") for c in colors or X.EMPHASIS_COLORS]
    runs = rich.select("element_id", F.posexplode("runs").alias("pos", "run"))
    color = F.replace(F.lower("run.formats.color"), F.lit(" "), F.lit(""))
    return runs.where(color.isin(wanted)).select(
        "element_id", "pos", F.col("run.text").alias("text"), color.alias("color"))


# Approval type that each execution mode needs.
APPROVAL_TYPES = {
    "trial": "trial_authorization", "batch": "batch_authorization", "legacy_inferred": "legacy_source_confirmation",
}


def normalize_approvals(runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Approval records per run and the violations.

    ``approvals`` is an array of structs with text, id, type, status, confirmed_by
    and n_evidence; a plain text stands for a confirmed approval of the mode's type.
    """
    needed = F.when(F.col("mode") == "batch", APPROVAL_TYPES["batch"]).when(
        F.col("mode") == "legacy_inferred", APPROVAL_TYPES["legacy_inferred"]).otherwise(APPROVAL_TYPES["trial"])
    rows = runs.withColumn("needed", needed).select("run_id", "mode", "needed", F.posexplode_outer("approvals").alias("pos", "a"))
    plain = F.col("a.text").isNotNull()
    records = rows.where("a IS NOT NULL").select(
        "run_id", "pos", "needed",
        F.when(plain, F.concat(F.lit("approval-"), (F.col("pos") + 1).cast("string"))).otherwise(
            F.coalesce("a.id", F.concat(F.lit("approval-"), (F.col("pos") + 1).cast("string")))).alias("id"),
        F.when(plain, F.col("needed")).otherwise(F.col("a.type")).alias("type"),
        F.when(plain, "confirmed").otherwise(F.coalesce("a.status", F.lit("confirmed"))).alias("status"),
        F.when(plain, "user").otherwise(F.col("a.confirmed_by")).alias("confirmed_by"),
        F.when(plain, 1).otherwise(F.coalesce("a.n_evidence", F.lit(0))).alias("n_evidence"))
    per_record = explode_rules(records.withColumn("entity_id", F.concat_ws("/", F.col("run_id").cast("string"), "id")), [
        ("approval_type", "error", ~F.coalesce(F.col("type").isin(list(APPROVAL_TYPES.values())), F.lit(False))),
        ("approval_unconfirmed", "error", F.col("status") != "confirmed"),
        ("approval_evidence", "error", F.col("n_evidence") == 0)])
    matched = records.where((F.col("type") == F.col("needed")) & (F.col("status") == "confirmed")).select("run_id").distinct()
    lacking = runs.join(matched, "run_id", "left_anti")
    per_run = explode_rules(lacking.withColumn("entity_id", F.col("run_id")), [("approval_of_mode_missing", "error", F.lit(True))])
    return records.drop("needed"), per_record.unionByName(per_run)


def module_readback(modules: DataFrame) -> DataFrame:
    """Source book and catalog from the first content entry that names its catalog."""
    hit = F.try_element_at(F.filter("content", lambda x: x["catalog_content_en"].isNotNull()), F.lit(1))
    return modules.withColumn("_hit", hit).select(
        *[c for c in modules.columns if c != "content"],
        F.col("_hit.book_id").alias("source_book_id"), F.col("_hit.catalog_id").alias("source_catalog_id"))
