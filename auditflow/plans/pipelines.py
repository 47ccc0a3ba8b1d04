"""Pipelines: tables in, tables out."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditflow.functions import text as X
from auditflow.functions.canon import canonical_hash, idempotency_key, set_print, struct_hash
from auditflow.functions.layout import js_length
from auditflow.operators import annotations, batch, extract, matching, ranges, receipts, report, targets, windows
from auditflow.operators.checks import valid_entities
from auditflow.operators.tree import collect_named_values, flatten_tree
from auditflow.session import checkpointed


class AnnotationPlan(NamedTuple):
    pages: DataFrame
    summary: DataFrame
    violations: DataFrame


def annotation_tables(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pages and annotations of parsed annotation files (path, doc)."""
    page = F.posexplode(F.try_variant_get("doc", "$.pdf.pages", "array<variant>")).alias("pos", "v")
    get = lambda k: F.try_variant_get("v", f"$.{k}", "string")
    pages = docs.select("path", page).select(
        "path", F.col("pos").cast("bigint").alias("pos"), X.positive_integer(get("page")).alias("page"), X.finite_number(get("width")).alias("width"), X.finite_number(get("height")).alias("height"))
    item = F.posexplode(F.try_variant_get("doc", "$.annotations", "array<variant>")).alias("pos", "v")
    ann = docs.select("path", item).select(
        "path", get("id").alias("id"), F.col("pos").cast("bigint").alias("pos"), get("type").alias("type"), X.positive_integer(get("page")).alias("page"),
        *[X.finite_number(get(k)).alias(k) for k in ("x", "y", "width", "height")],
        *[get(k).alias(k) for k in ("unit", "audio_path", "question", "text")])
    return pages, ann


def annotation_import_plan(ann: DataFrame, pages: DataFrame, media: DataFrame, size: int = 1000, relative: bool = False) -> AnnotationPlan:
    """Validated placement of the annotations of any number of files, page by page.

    Scaled and judged rows are written nowhere: placement, summary and violations each
    read what they need of them, and only violations look for the first place of an id.
    """
    rows = annotations.judged_annotations(ann, pages, media, relative)
    placed = annotations.placed(rows)
    found = annotations.annotation_violations(rows).unionByName(annotations.page_violations(pages))
    return AnnotationPlan(report.plan_by_page(placed, size), report.annotation_summary(placed, found), found)


class SnapshotTables(NamedTuple):
    blocks: DataFrame
    elements: DataFrame
    modules: DataFrame
    warnings: DataFrame


def snapshot_tables(captures: DataFrame) -> SnapshotTables:
    """Flat tables of page captures (catalog_id, doc)."""
    snap = captures.select("catalog_id", F.try_variant_get("doc", "$.snapshot", "variant").alias("s"))
    listed = lambda p: F.posexplode(F.try_variant_get("s", p, "array<variant>")).alias("pos", "v")
    get = lambda p, t="string": F.try_variant_get("v", p, t)
    raw = snap.select("catalog_id", listed("$.blocks"))
    named = raw.where(get("$.template_data_content.elements", "variant").isNotNull())
    blocks = named.select(
        "catalog_id", get("$.id", "bigint").alias("block_id"), "pos", F.coalesce(get("$.template_data_content.name"), F.lit("")).alias("name"))
    roots = named.select("catalog_id", get("$.id", "bigint").alias("block_id"), get("$.template_data_content.elements", "variant").alias("root"))
    node = lambda p: F.try_variant_get("node", p, "string")
    elements = flatten_tree(roots, "root").select(
        "catalog_id", "block_id", node("$.id").alias("element_id"), node("$.type").alias("type"), node("$.name").alias("name"),
        "parent_names", node("$.content").alias("content"))
    items = snap.select("catalog_id", listed("$.digitalModules.items")).select(
        "catalog_id", "pos", get("$.elementId").alias("element_id"), get("$.normalized.type", "int").alias("module_type"), get("$.normalized.modelId", "bigint").alias("model_id"))
    index = snap.select("catalog_id", listed("$.elementIndex")).select("catalog_id", "pos", get("$.elementId").alias("element_id"), get("$.name").alias("name"))
    modules = extract.module_names(items, index, ["catalog_id"])
    warnings = snap.select("catalog_id", listed("$.completeness.warnings")).select(
        "catalog_id", "pos", get("$.code").alias("code"), get("$.target.elementId").alias("element_id"))
    return SnapshotTables(blocks, elements, modules, warnings)


class SourceManifest(NamedTuple):
    catalogs: DataFrame
    warnings: DataFrame
    violations: DataFrame
    missing: DataFrame


def latest_captures(captures: DataFrame) -> DataFrame:
    """Newest parsed capture per catalog, one without a time last; the choice is made without the documents."""
    at = F.unix_micros(F.col("captured_at").cast("timestamp"))
    keyed = captures.where("doc IS NOT NULL").select("catalog_id", "path", at.isNull().alias("_timeless"), (-at).alias("_age"))
    newest = ranges.pick_first(keyed, ["catalog_id"], [F.col("_timeless"), F.col("_age"), F.col("path")], ["path"])
    return captures.where("doc IS NOT NULL").join(newest, ["catalog_id", "path"], "left_semi")


def source_manifest(captures: DataFrame, wanted: DataFrame, overrides: DataFrame) -> SourceManifest:
    """Catalog records of the wanted catalogs from their newest parsed captures.

    Every capture that could not be parsed is a violation, and a wanted catalog without
    any parsed one is missing.
    """
    asked = checkpointed(captures.join(wanted.select("catalog_id"), "catalog_id", "left_semi"))
    unparsed = asked.where("doc IS NULL").select(
        F.col("catalog_id").cast("string").alias("entity_id"), F.lit("capture_unparsed").alias("rule_code"), F.lit("error").alias("severity"), F.col("path").alias("message"))
    # all tables of a capture are read from it, so it is parsed and chosen once
    chosen = checkpointed(latest_captures(asked).select("catalog_id", "doc"))
    catalogs, warnings, found = extract.extract_catalogs(*snapshot_tables(chosen))
    done, judged, broken = extract.apply_overrides(catalogs, warnings, overrides)
    found = found.unionByName(broken).unionByName(extract.unresolved_catalogs(done))
    found = found.unionByName(unparsed)
    return SourceManifest(done, judged, found, matching.missing(wanted, asked.where("doc IS NOT NULL"), ["catalog_id"]))


def variant_profile(captures: DataFrame) -> DataFrame:
    """How titles, sentences and word counts vary: rows (metric, key, value)."""
    chosen = checkpointed(latest_captures(checkpointed(captures.where("doc IS NOT NULL"))).select("catalog_id", "doc"))
    tables = snapshot_tables(chosen)
    texts = extract.selected_elements(tables.blocks, tables.elements)
    lines = X.html_lines("content", angle_entities=False)
    rows = texts.withColumn("_l", lines).groupBy("catalog_id").agg(
        F.max(F.when(F.col("field") == "sentences", F.size("_l"))).alias("n_sentences"),
        F.max(F.when(F.col("field") == "sentences", F.array_max(F.transform("_l", js_length)))).alias("longest"),
        F.max(F.when(F.col("field") == "words_en", F.size("_l"))).alias("n_english"),
        F.max(F.when(F.col("field") == "words_zh", F.size("_l"))).alias("n_chinese"))
    titles = chosen.select("catalog_id", js_length(F.try_variant_get("doc", "$.snapshot.identity.catalogName", "string")).alias("title_length"))
    # four reports start from these rows
    rows = checkpointed(rows.join(titles, "catalog_id"))
    spread = report.distribution(rows, "n_sentences").select(
        F.lit("sentence_count").alias("metric"), F.col("value").cast("string").alias("key"), F.col("n").alias("value"))
    wrong = report.mismatch_report(rows, ["n_english", "n_chinese"], 4).select(
        F.col("catalog_id").cast("string").alias("key"), F.expr("stack(2, 'english_words', CAST(n_english AS BIGINT), 'chinese_words', CAST(n_chinese AS BIGINT))").alias("metric", "value")
    ).select("metric", "key", "value")
    top = lambda name, c: report.longest_by(rows, F.col(c), "catalog_id").select(
        F.lit(name).alias("metric"), F.col("catalog_id").cast("string").alias("key"), F.col(c).cast("bigint").alias("value"))
    return spread.unionByName(wrong).unionByName(top("longest_title", "title_length")).unionByName(top("longest_sentence", "longest"))


def course_manifest(pages: DataFrame, blocks: DataFrame, rich: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Full course: one record per page, and the variants of its exercises.

    ``pages`` (book_id, pos, page_id, name), ``blocks`` (page_id, pos, block_id,
    template_id), ``rich`` (block_id, pos, plain_text).
    """
    pages = extract.with_topic(pages, "name").withColumn(
        "route", F.when(F.col("name").contains("能力达标"), "ability").otherwise("normal"))
    roles = extract.classify_blocks(blocks, extract.COURSE_ROLES)
    first = lambda role: F.min_by(F.when(F.col("role") == role, F.col("block_id")), F.when(F.col("role") == role, F.col("pos")))
    per_page = roles.groupBy("page_id").agg(
        first("question").alias("problem_block"), first("key").alias("key_block"), first("method").alias("method_block"),
        first("summary").alias("summary_block"), first("ability").alias("content_block"))
    keys = per_page.where("key_block IS NOT NULL").select("page_id", F.col("key_block").alias("block_id"))
    text = rich.withColumn("plain_text", F.trim(F.coalesce("plain_text", F.lit("")))).join(keys, "block_id")
    other = F.col("plain_text") != "关键点"
    guide = windows.first_with_fallback(
        text, ["page_id"], [other & (F.col("plain_text") != "") & (F.length("plain_text") <= 80), other], "pos", "plain_text")
    recent = windows.recent_topics(pages.select("book_id", "pos", "route", "topic"))
    out = pages.join(per_page, "page_id", "left").join(guide.withColumnRenamed("plain_text", "method_guide"), "page_id", "left").join(
        recent, ["book_id", "pos"], "left")
    variants = roles
    for role, name in (("analysis", "analysis_block"), ("variant_key", "key_block")):
        variants = windows.next_matching(variants, ["page_id"], ["pos"], F.col("role") == role, F.col("block_id"), name)
    variants = variants.where("role = 'variant'").select("page_id", F.col("block_id").alias("prompt_block"), "analysis_block", "key_block")
    return out, variants


def paired_course_manifest(pages: DataFrame, timeline: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Exercise and analysis pages: topics by unique pairing, courses next to their exercise.

    ``timeline`` (page_id, pos, kind, item_id) lists exercises and courses in page order.
    """
    topics = matching.pair_practice_analysis(pages)
    nearest = windows.next_matching(timeline, ["page_id"], ["pos"], F.col("kind") == "course", F.col("item_id"), "course_id")
    return topics, nearest.where("kind = 'exercise'").select("page_id", F.col("item_id").alias("exercise_id"), "course_id")


def reading_plan(captures: DataFrame, blocks: DataFrame, rich: DataFrame, modules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Source plan of the newest capture of each page, and its missing roles.

    ``captures`` (page_id, capture_id, captured_at); the other tables carry capture_id.
    """
    newest = windows.latest_per_key(captures, ["page_id"], "captured_at", "capture_id").select("page_id", "capture_id")
    kept = lambda df: df.join(newest, "capture_id").drop("capture_id")
    plans = extract.source_plan(kept(blocks), rich, kept(modules))
    return plans, extract.manifest_completeness(plans)


def build_provenance(
    source: DataFrame, target: DataFrame, snapshots: DataFrame, rules: DataFrame, applied: DataFrame, required: DataFrame, reported: DataFrame
) -> DataFrame:
    """Sealed provenance record per pair of pages, with gate, bindings and restriction.

    ``source`` and ``target`` (book_id, pos, page_id) meet by position; ``snapshots``
    (page_id, sections, warnings, pack_id) belong to targets.
    """
    pairs = matching.zip_by_position(source, target, ["book_id"], ["pos"], "page_id", "page_id").where("status = 'paired'")
    gate = report.fidelity_gate(snapshots).select("page_id", "pack_id", "full_fidelity")
    pages = pairs.withColumnRenamed("target_id", "page_id").join(gate, "page_id").where("full_fidelity")
    bound = extract.build_bindings(rules, applied, pages.select("page_id", "pack_id"))
    counts = bound.groupBy("page_id").agg(
        F.count("*").alias("n_bindings"), F.count(F.when(F.col("status") == "applied", 1)).alias("n_applied"),
        set_print(F.col("binding_hash")).alias("bindings_print"))
    covered = matching.cover_required_checks(required, reported, legacy=True).groupBy("run_id").agg(
        F.bool_and(F.coalesce(F.col("check_status") == "passed", F.lit(False))).alias("passed"))
    out = pages.withColumn("page_id", F.col("page_id").cast("string")).join(counts, "page_id").join(
        covered.withColumn("page_id", F.col("run_id").cast("string")).drop("run_id"), "page_id", "left")
    out = out.withColumn("restricted", ~F.coalesce("passed", F.lit(True)))
    record = [F.col("page_id").alias("run_id"), F.col("source_id").cast("string").alias("source_id"), "n_bindings", "n_applied", "bindings_print", "restricted"]
    return out.withColumn("integrity_hash", struct_hash(*record)).select(*record, "integrity_hash")


def create_receipts(exports: DataFrame, saves: DataFrame, expected: DataFrame, verified_at: str) -> DataFrame:
    """Receipt text per run; only meant for runs without violations."""
    from auditflow.sources.scans import unwrap_envelope

    x = unwrap_envelope(exports, "envelope").select("run_id", F.col("data").alias("x"), canonical_hash("envelope").alias("x_hash"))
    s = unwrap_envelope(saves, "envelope").select("run_id", F.col("data").alias("s"), canonical_hash("envelope").alias("s_hash"))
    rows = expected.join(x, "run_id").join(s, "run_id").withColumn("blocks", F.try_variant_get("x", "$.blocks", "array<variant>"))
    carrier = F.try_element_at(F.filter("blocks", lambda b: F.try_variant_get(b, "$.uuid", "string") == F.col("carrier_block_id")), F.lit(1))
    stated = lambda p: F.coalesce(F.get_json_object("provenance", f"$.{p}"), F.lit("unknown"))
    rows = rows.select(
        "run_id", "carrier_block_id", "x_hash", "s_hash", F.col("target_catalog_id").cast("string").alias("slide"), F.size("blocks").alias("n_blocks"),
        F.try_variant_get("s", "$.contentHash", "string").alias("page"), F.try_variant_get("s", "$.persistedContentHash", "string").alias("persisted"),
        canonical_hash(F.to_json(F.try_variant_get("x", "$.blocks", "variant"))).alias("blocks_hash"), canonical_hash(F.to_json(carrier)).alias("carrier_hash"),
        canonical_hash("provenance").alias("provenance_hash"), *[stated(p).alias(p) for p in ("source_book_id", "source_catalog_id", "target_book_id")])
    slide, lit = F.col("slide"), F.lit
    save = [lit("editor_save_verified").alias("tool"), lit("current").alias("scope"), slide.alias("slide_id"), lit(True).alias("saved"), lit("current").alias("saved_scope"),
            F.array(slide).alias("saved_slides"), lit(True).alias("verified"), lit("current").alias("verified_scope"), F.array(slide).alias("verified_slides"),
            F.col("page").alias("content_hash"), F.col("persisted").alias("persisted_content_hash"), lit(False).alias("dirty"), F.col("s_hash").alias("envelope_hash")]
    export = [lit("editor_export_slide").alias("tool"), slide.alias("slide_id"), F.col("n_blocks").alias("block_count"), F.col("page").alias("page_content_hash"),
              F.col("blocks_hash"), F.col("carrier_hash").alias("carrier_block_hash"), F.col("x_hash").alias("envelope_hash")]
    head = [lit(1).alias("schema_version"), lit(receipts.RECEIPT_KIND).alias("kind"), F.col("run_id").cast("string").alias("run_id"),
            F.col("provenance_hash").alias("provenance_integrity_hash"), F.col("carrier_block_id"),
            F.struct(slide.alias("slide_id"), "source_book_id", "source_catalog_id", "target_book_id", slide.alias("target_catalog_id")).alias("identity")]
    return receipts.seal_receipts(rows, head, save, export, lit(verified_at)).select("run_id", "raw")


def verify_readbacks(exports: DataFrame, saves: DataFrame, expected: DataFrame, verified_at: str) -> tuple[DataFrame, DataFrame]:
    """Index of runs with their validity and receipt, and all violations."""
    found = checkpointed(receipts.validate_readbacks(exports, saves, expected))
    runs = valid_entities(expected.select("run_id"), found, "run_id")
    fine = runs.where("valid").select("run_id")
    made = checkpointed(create_receipts(exports, saves, expected.join(fine, "run_id", "left_semi"), verified_at))
    faults = receipts.validate_receipts(made, "raw", "run_id")
    index = runs.join(made.select("run_id", F.col("raw").alias("receipt")), "run_id", "left")
    checked = valid_entities(index.withColumnRenamed("valid", "readback_valid"), faults, "run_id")
    has_valid = F.col("receipt").isNotNull() & F.col("valid")
    return checked.withColumn("receipt_valid", has_valid).drop("valid"), found.unionByName(faults)


def forward_evidence(cases: DataFrame, artifacts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links of forward cases with the hashes they claim, and their violations.

    ``cases`` (case_id, role, path, linked_id, artifact_sha256, claimed_hash),
    ``artifacts`` (path, raw JSON text).
    """
    docs = artifacts.withColumn("doc", F.try_parse_json("raw"))
    ids = collect_named_values(docs.select(F.col("path").alias("file"), "doc"), "doc", ["source_id", "target_id", "book_id", "bookId"])
    # A file names few ids, and the list is of one file.
    per_file = ids.groupBy(F.col("file").alias("path")).agg(F.collect_set(F.try_variant_get("value", "$", "string")).alias("ids"))
    files = docs.select("path", F.sha2("raw", 256).alias("sha256"), canonical_hash("raw").alias("canonical_hash")).join(per_file, "path", "left")
    files = files.withColumn("ids", F.coalesce("ids", F.array().cast("array<string>")))
    links = cases.select(
        "case_id", "role", F.lit("").alias("base"), F.col("path").alias("artifact"), "artifact_sha256", "claimed_hash", "linked_id")
    return links, matching.verify_evidence_chain(links, files)


def target_verification(
    plans: DataFrame, captures: DataFrame, modules: DataFrame, book_id: str, elements: list[str], forbidden: str
) -> tuple[DataFrame, DataFrame]:
    """Report and violations of the newest capture of each target page."""
    newest = windows.latest_per_key(captures, ["position"], "captured_at", "capture_id").drop("capture_id", "captured_at")
    found = targets.verify_targets(plans, newest, modules, book_id, elements, forbidden)
    counts = modules.groupBy("page_id").agg(F.count("*").alias("module_count"))
    pages = newest.select("position", "page_id").join(counts, "page_id", "left").select(
        F.col("position").alias("page_id"), "position", "module_count")
    return report.verification_report(pages, found), found


def init_ledger(items: DataFrame, registry: DataFrame) -> DataFrame:
    """Items with their idempotency key, first state and the reason for it.

    ``registry`` (idempotency_key, status, verified_hash) is what earlier ledgers claimed.
    An item that brings no fingerprint has no key yet and is pending.
    """
    key = idempotency_key(
        F.col("source_snapshot_hash"), F.col("template_snapshot_hash"), F.col("rule_pack_hash"), F.col("stable_identity"), F.col("catalog_scope"))
    keyed = items.withColumn("idempotency_key", F.when(F.col("source_snapshot_hash").isNotNull(), key))
    bare = keyed.where("idempotency_key IS NULL")
    keyed = windows.first_wins(keyed.where("idempotency_key IS NOT NULL"), ["idempotency_key"], "item_id", [F.col("position")])
    rows = keyed.join(registry.select("idempotency_key", "status", "verified_hash"), "idempotency_key", "left").unionByName(bare, allowMissingColumns=True)
    verified = F.col("status") == "verified"
    same = F.coalesce(F.col("verified_hash") == F.col("target_before_hash"), F.lit(False))
    state = (
        F.when(verified & same, "verified_skip").when(verified, "conflict").when(F.col("conflict"), "conflict")
        .when(F.col("status").isNotNull() & (F.col("status") != "superseded"), "conflict").otherwise("pending"))
    reason = (
        F.when(verified & same, "logical_work_already_verified").when(verified, "verified_identity_target_drift")
        .when(F.col("conflict"), "duplicate_logical_work_in_ledger")
        .when(F.col("status").isNotNull() & (F.col("status") != "superseded"), "logical_work_claimed_elsewhere"))
    return rows.withColumn("state", state).withColumn("reason", reason)


def identity_clashes(items: DataFrame) -> DataFrame:
    """Items whose prospective identity and lock key are not bound one to one, by the first rule they break."""
    pairs = items.select("item_id", "prospective", "lock_key").where("prospective IS NOT NULL AND lock_key IS NOT NULL")

    def many(a: str, b: str, code: str) -> DataFrame:
        bad = pairs.groupBy(a).agg(F.min(b).alias("low"), F.max(b).alias("high")).where("low <> high").select(a)
        return pairs.join(bad, a, "left_semi").select("item_id", F.lit(code).alias("clash"))

    both = many("prospective", "lock_key", "prospective_many_locks").union(many("lock_key", "prospective", "lock_many_prospectives"))
    return both.groupBy("item_id").agg(F.max("clash").alias("clash"))


def batch_ledger(items: DataFrame, registry: DataFrame, events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Items with state and reason after the whole batch, and every event with what came of it.

    ``items`` (item_id, position, the fingerprint columns or null, target_before_hash,
    resolved_template_id, stable_identity, catalog_scope, prospective, lock_key),
    ``registry`` (idempotency_key, status, owner, verified_hash), ``events`` (seq, item_id,
    op, evidence_ok, recovery, reason, the fingerprint columns, token, holder,
    result_hash).  Items whose identities clash are held back: their events are not
    taken.  All others start as ``init_ledger`` says and share the registry while they
    run, so a claim, a drift or a verified result of one item decides about the next.
    Nothing is kept of the replay: whoever writes both frames runs it twice.
    """
    fingerprint = ["source_snapshot_hash", "template_snapshot_hash", "rule_pack_hash", "resolved_template_id"]
    prints = struct_hash(*fingerprint)
    first = init_ledger(items, registry).join(identity_clashes(items), "item_id", "left")
    start = checkpointed(first.select(
        "item_id", F.col("state").alias("first_state"), F.coalesce("clash", "reason").alias("first_reason"), F.col("idempotency_key").alias("first_key"),
        F.when(F.col("source_snapshot_hash").isNotNull(), prints).alias("first_identity"), F.col("target_before_hash").alias("first_target"), "clash",
        "stable_identity", "catalog_scope"))
    about = start.where("clash IS NULL").select("item_id", "stable_identity", "catalog_scope")
    key = idempotency_key(
        F.col("source_snapshot_hash"), F.col("template_snapshot_hash"), F.col("rule_pack_hash"), F.col("stable_identity"), F.col("catalog_scope"))
    shown = F.col("source_snapshot_hash").isNotNull()
    asked = events.join(about, "item_id").withColumns({
        "idempotency_key": F.when(shown, key), "identity": F.when(shown, prints), "target_before": F.col("target_before_hash")})
    done = batch.replay_batch(start.where("clash IS NULL"), asked, registry)
    return batch.final_states(start, done), done


def state_print(df: DataFrame, keys: list[str], value: str = "value") -> Column:
    """Order-free print of a keyed state from the hashes of its rows."""
    return set_print(struct_hash(*keys, value))


def refinement_plan(base: DataFrame, cur: DataFrame, want: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Operations per key and one summary row with counts and state prints."""
    plan = matching.plan_refinement(base, cur, want, keys)
    kinds = plan.agg(*[F.count(F.when(F.col("classification") == k, 1)).alias(k) for k in ("safe", "noop", "conflict")])
    prints = cur.agg(state_print(cur, keys).alias("current_print")).crossJoin(want.agg(state_print(want, keys).alias("desired_print")))
    return plan, kinds.crossJoin(prints)


def source_recall(query: DataFrame, candidates: DataFrame, confirmations: DataFrame | None = None) -> DataFrame:
    """Best source per query over all candidates; a choice needs a confirmation."""
    best = matching.recall_top(query, candidates)
    if confirmations is None:
        return best.withColumn("selected_candidate_id", F.lit(None).cast("string"))
    pairs = matching.match_source(query, candidates, confirmations.where("confirmed").select("query_id", "candidate_id"))
    legal = pairs.where("eligible").select("query_id", F.col("candidate_id").alias("selected_candidate_id"))
    return best.join(legal, "query_id", "left")


