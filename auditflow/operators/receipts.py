"""Save receipts, readback receipts and the readback of exported pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditflow.functions.canon import FNV_PATTERN, SHA_PATTERN, canonical_hash, json_string, page_content_hash, tagged_sha, text_of_part
from auditflow.operators.checks import DOMAINS, explode_rules, failed_rules
from auditflow.operators.tree import key_paths
from auditflow.sources.scans import unwrap_envelope

# Keys of the decoded save result, its optional keys, and of a receipt.
SAVE_KEYS = [
    "scope", "slideId", "saved", "savedScope", "savedSlides", "verified", "verifiedScope", "verifiedSlides",
    "contentHash", "persistedContentHash", "dirty", "warnings",
]
SAVE_OPTIONAL = [
    "authoringContentHash", "persistedAuthoringContentHash", "normalizationOnly", "reconciled", "reloadedContentHash", "businessDiffPaths",
]
RECEIPT_KEYS = [
    "schema_version", "kind", "run_id", "provenance_integrity_hash", "carrier_block_id", "identity", "save", "export",
    "verified_at", "artifact_integrity",
]
IDENTITY_KEYS = ["slide_id", "source_book_id", "source_catalog_id", "target_book_id", "target_catalog_id"]
RECEIPT_SAVE_KEYS = [
    "tool", "scope", "slide_id", "saved", "saved_scope", "saved_slides", "verified", "verified_scope", "verified_slides",
    "content_hash", "persisted_content_hash", "dirty", "envelope_hash", "receipt_hash",
]
RECEIPT_EXPORT_KEYS = [
    "tool", "slide_id", "block_count", "page_content_hash", "blocks_hash", "carrier_block_hash", "envelope_hash", "receipt_hash",
]
RECEIPT_KIND = "semantic_provenance_readback_receipt"
PROVENANCE_KEY = "ai_semantic_provenance"


def _keys(doc: Column, path: str) -> Column:
    return F.map_keys(F.try_variant_get(doc, path, "map<string,variant>"))


def _lit(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _exact(keys: Column, wanted: list[str]) -> Column:
    same = (F.size(keys) == len(wanted)) & (F.size(F.array_except(_lit(wanted), keys)) == 0)
    return F.coalesce(same, F.lit(False))


def save_receipt_rules(doc: Column, slide: Column, missing: Column | None = None) -> list[tuple]:
    """Rules over a decoded save result; ``slide`` is the expected page."""
    text = lambda p: F.try_variant_get(doc, f"$.{p}", "string")
    flag = lambda p: F.try_variant_get(doc, f"$.{p}", "boolean")
    has = lambda p: F.try_variant_get(doc, f"$.{p}", "variant").isNotNull()
    items = lambda p: F.try_variant_get(doc, f"$.{p}", "array<string>")
    fnv = lambda p: F.coalesce(text(p).rlike(FNV_PATTERN), F.lit(False))
    only_slide = lambda p: items(p).eqNullSafe(F.array(slide))
    empty = lambda p: F.size(items(p)).eqNullSafe(F.lit(0))
    keys = _keys(doc, "$")
    stray = F.size(F.array_except(keys, _lit(SAVE_KEYS + SAVE_OPTIONAL))) > 0
    lacking = F.size(F.array_except(_lit(SAVE_KEYS), keys)) > 0
    is_bool = lambda p: F.schema_of_variant(F.try_variant_get(doc, f"$.{p}", "variant")) == "BOOLEAN"
    authoring = has("authoringContentHash") | has("persistedAuthoringContentHash")
    return [
        ("save_keys", "error", F.coalesce(stray | lacking, F.lit(True))),
        ("save_scope", "error", ~text("scope").eqNullSafe(F.lit("current"))),
        ("save_slide", "error", ~text("slideId").eqNullSafe(slide)),
        ("save_saved", "error", ~(flag("saved").eqNullSafe(F.lit(True)) & text("savedScope").eqNullSafe(F.lit("current")))),
        ("save_verified", "error", ~(flag("verified").eqNullSafe(F.lit(True)) & text("verifiedScope").eqNullSafe(F.lit("current")))),
        ("save_slides", "error", ~(only_slide("savedSlides") & only_slide("verifiedSlides"))),
        ("save_hash_form", "error", ~(fnv("contentHash") & fnv("persistedContentHash"))),
        ("save_hash_differs", "error", ~text("contentHash").eqNullSafe(text("persistedContentHash"))),
        ("save_authoring_hash", "error", authoring & ~(
            fnv("authoringContentHash") & fnv("persistedAuthoringContentHash")
            & text("authoringContentHash").eqNullSafe(text("persistedAuthoringContentHash")))),
        ("save_flags", "error", (has("normalizationOnly") & ~is_bool("normalizationOnly")) | (has("reconciled") & ~is_bool("reconciled"))),
        ("save_reloaded_hash", "error", text("reloadedContentHash").isNotNull() & ~fnv("reloadedContentHash")),
        ("save_diff_paths", "error", has("businessDiffPaths") & ~empty("businessDiffPaths")),
        ("save_dirty", "error", ~flag("dirty").eqNullSafe(F.lit(False))),
        ("save_warnings", "error", ~empty("warnings")),
    ]


def validate_save_receipts(df: DataFrame, raw: str = "raw", slide: str = "slide_id") -> DataFrame:
    """Violations of decoded save results (JSON text) per slide."""
    rows = df.withColumn("_doc", F.try_parse_json(raw)).withColumn("entity_id", F.col(slide).cast("string"))
    return explode_rules(rows, save_receipt_rules(F.col("_doc"), F.col(slide).cast("string")))


# Types of a receipt's fields where they are not text.
RECEIPT_TYPES = {
    "schema_version": "BIGINT", "export.block_count": "BIGINT", "save.saved": "BOOLEAN", "save.verified": "BOOLEAN", "save.dirty": "BOOLEAN",
    "save.saved_slides": "ARRAY<STRING>", "save.verified_slides": "ARRAY<STRING>",
}
RECEIPT_PARTS = {"identity": IDENTITY_KEYS, "save": RECEIPT_SAVE_KEYS, "export": RECEIPT_EXPORT_KEYS, "artifact_integrity": ["algorithm", "canonical_hash"]}
RECEIPT_FIELDS = [k for k in RECEIPT_KEYS if k not in RECEIPT_PARTS] + [f"{part}.{k}" for part, keys in RECEIPT_PARTS.items() for k in keys]


def _receipt_schema(record: str) -> str:
    """Type of a receipt of regular shape, as ``record`` is named by the one that asks, keys in order."""
    def fields(keys: list[str], prefix: str) -> str:
        kinds = [(k, fields(RECEIPT_PARTS[k], k + ".") if k in RECEIPT_PARTS else RECEIPT_TYPES.get(prefix + k, "STRING")) for k in sorted(keys)]
        return f"{record}<{', '.join(f'{k}: {kind}' for k, kind in kinds)}>"

    return fields(RECEIPT_KEYS, "")


def _field(path: str) -> str:
    return "r_" + path.replace(".", "_")


def receipt_fields(df: DataFrame, raw: str = "raw") -> DataFrame:
    """The table with the fields, key lists and hashes of its receipts as columns named ``r_…``, all read once.

    A receipt whose keys and types are all as they should be is read as one record, whose
    texts in key order are canonical.  Any other is taken apart field by field: a field that
    is absent or of another type is null, and so is every field of a text that is no JSON.
    """
    doc, regular, record = F.col("r_doc"), F.col("r_regular"), F.col("r_record")
    rows = df.withColumn("r_doc", F.try_parse_json(raw))
    rows = rows.withColumn("r_regular", F.coalesce(F.schema_of_variant("r_doc") == _receipt_schema("OBJECT"), F.lit(False)))
    rows = rows.withColumn("r_record", F.when(regular, F.from_json(raw, _receipt_schema("STRUCT"))))
    either = lambda fast, slow: F.when(regular, fast).otherwise(slow)
    get = lambda p, kind: F.try_variant_get(doc, f"$.{p}" if p else "$", kind)
    inner = lambda part: record[part] if part else record

    def field(path: str) -> Column:
        kind = "double" if path == "export.block_count" else RECEIPT_TYPES.get(path, "string").lower()
        value = record
        for step in path.split("."):
            value = value[step]
        return either(value.cast(kind), get(path, kind))

    def text_without(part: str, keys: list[str], drop: str) -> Column:
        kept = F.struct(*[inner(part)[k].alias(k) for k in sorted(keys) if k != drop])
        return either(F.to_json(kept), text_of_part(get(part, "map<string,variant>"), drop))

    parts = {"": RECEIPT_KEYS, **RECEIPT_PARTS}
    rows = rows.withColumns({
        **{_field(p): field(p) for p in RECEIPT_FIELDS},
        **{f"r_keys_{part}": either(_lit(sorted(keys)), F.map_keys(get(part, "map<string,variant>"))) for part, keys in parts.items()},
        "r_save_hash": text_without("save", RECEIPT_SAVE_KEYS, "receipt_hash"), "r_export_hash": text_without("export", RECEIPT_EXPORT_KEYS, "receipt_hash"),
        "r_whole_hash": text_without("", RECEIPT_KEYS, "artifact_integrity"),
    })
    return rows.withColumns({c: tagged_sha(F.col(c)) for c in ("r_save_hash", "r_export_hash", "r_whole_hash")}).drop("r_doc", "r_regular", "r_record")


def _in_key_order(record: Column, keys: list[str], without: str) -> Column:
    inner = lambda k: _in_key_order(record[k], RECEIPT_PARTS[k], "") if k in RECEIPT_PARTS else record[k]
    return F.struct(*[inner(k).alias(k) for k in sorted(keys) if k != without])


def seal_receipts(df: DataFrame, head: list[Column], save: list[Column], export: list[Column], verified_at: Column) -> DataFrame:
    """The table with the text of a receipt per row as ``raw``.

    ``head`` are the fields before the parts ``save`` and ``export``, both without their
    hashes.  Each hash is a column of its own, so that it is computed once.
    """
    part = lambda name, cols: tagged_sha(F.to_json(_in_key_order(F.struct(*cols), RECEIPT_PARTS[name], "receipt_hash")))
    rows = df.withColumns({"r_save_hash": part("save", save), "r_export_hash": part("export", export)})
    body = [
        *head, F.struct(*save, F.col("r_save_hash").alias("receipt_hash")).alias("save"),
        F.struct(*export, F.col("r_export_hash").alias("receipt_hash")).alias("export"), verified_at.alias("verified_at")]
    whole = F.to_json(_in_key_order(F.struct(*body), RECEIPT_KEYS, "artifact_integrity"))
    rows = rows.withColumn("r_whole_hash", tagged_sha(whole))
    integrity = F.struct(F.lit("sha256-canonical-json").alias("algorithm"), F.col("r_whole_hash").alias("canonical_hash"))
    return rows.withColumn("raw", F.to_json(F.struct(*body, integrity.alias("artifact_integrity")))).drop("r_save_hash", "r_export_hash", "r_whole_hash")


def receipt_rules() -> list[tuple]:
    """Rules over the columns of ``receipt_fields``: keys, flags, hashes, identities."""
    text = lambda p: F.col(_field(p))
    keys = lambda part, wanted: _exact(F.col(f"r_keys_{part}"), wanted)
    is_sha = lambda p: F.coalesce(text(p).rlike(SHA_PATTERN), F.lit(False))
    is_fnv = lambda p: F.coalesce(text(p).rlike(FNV_PATTERN), F.lit(False))
    eq = lambda p, v: text(p).eqNullSafe(F.lit(v))
    filled = lambda p: F.trim(F.coalesce(text(p), F.lit(""))) != ""
    slide = text("identity.slide_id")
    saved = (
        eq("save.saved", True) & eq("save.saved_scope", "current") & eq("save.verified", True)
        & eq("save.verified_scope", "current") & eq("save.dirty", False))
    filled_identity = F.lit(True)
    for k in IDENTITY_KEYS:
        filled_identity = filled_identity & filled(f"identity.{k}")
    count = F.col("r_export_block_count")
    return [
        ("receipt_keys", "error", ~keys("", RECEIPT_KEYS)),
        ("receipt_kind", "error", ~(F.col("r_schema_version").eqNullSafe(F.lit(1)) & eq("kind", RECEIPT_KIND))),
        ("receipt_run", "error", ~(filled("run_id") & filled("carrier_block_id"))),
        ("receipt_provenance_hash", "error", ~is_sha("provenance_integrity_hash")),
        ("receipt_time", "error", ~(F.coalesce(text("verified_at").rlike(DOMAINS["iso_utc"]), F.lit(False)) & text("verified_at").try_cast("timestamp").isNotNull())),
        ("identity_keys", "error", ~(keys("identity", IDENTITY_KEYS) & filled_identity)),
        ("save_keys", "error", ~keys("save", RECEIPT_SAVE_KEYS)),
        ("save_tool", "error", ~(eq("save.tool", "editor_save_verified") & eq("save.scope", "current"))),
        ("save_flags", "error", ~saved),
        ("save_page_hash", "error", ~(is_fnv("save.content_hash") & text("save.content_hash").eqNullSafe(text("save.persisted_content_hash")))),
        ("save_envelope_hash", "error", ~is_sha("save.envelope_hash")),
        ("save_receipt_hash", "error", ~F.coalesce(text("save.receipt_hash") == F.col("r_save_hash"), F.lit(False))),
        ("export_keys", "error", ~keys("export", RECEIPT_EXPORT_KEYS)),
        ("export_tool", "error", ~eq("export.tool", "editor_export_slide")),
        ("export_block_count", "error", ~F.coalesce((count >= 1) & (count == F.floor(count)), F.lit(False))),
        ("export_hashes", "error", ~(is_fnv("export.page_content_hash") & is_sha("export.blocks_hash") & is_sha("export.carrier_block_hash") & is_sha("export.envelope_hash"))),
        ("export_receipt_hash", "error", ~F.coalesce(text("export.receipt_hash") == F.col("r_export_hash"), F.lit(False))),
        ("slide_mismatch", "error", ~(text("identity.target_catalog_id").eqNullSafe(slide) & text("save.slide_id").eqNullSafe(slide) & text("export.slide_id").eqNullSafe(slide))),
        ("slides_lists", "error", ~(F.col("r_save_saved_slides").eqNullSafe(F.array(slide)) & F.col("r_save_verified_slides").eqNullSafe(F.array(slide)))),
        ("page_hash_mismatch", "error", ~text("save.content_hash").eqNullSafe(text("export.page_content_hash"))),
        ("integrity_keys", "error", ~(keys("artifact_integrity", ["algorithm", "canonical_hash"]) & eq("artifact_integrity.algorithm", "sha256-canonical-json"))),
        ("canonical_hash", "error", ~F.coalesce(text("artifact_integrity.canonical_hash") == F.col("r_whole_hash"), F.lit(False))),
    ]


def validate_receipts(df: DataFrame, raw: str = "raw", key: str = "receipt_id") -> DataFrame:
    """Violations of readback receipts: keys, flags, hashes, identities."""
    rows = df.select(F.col(key).cast("string").alias("entity_id"), F.col(raw).alias("raw"))
    return explode_rules(receipt_fields(rows), receipt_rules())


# Fields of transition evidence that must be those of the receipt's identity.
BOUND_IDENTITY = ["source_book_id", "source_catalog_id", "target_book_id", "target_catalog_id"]


def bind_receipt_files(transitions: DataFrame, files: DataFrame, items: DataFrame) -> DataFrame:
    """Violations per item of the receipt files that its verified transition names.

    ``transitions`` (item_id, receipt_path, receipt_sha256, run_id, provenance_hash,
    carrier_block_id, slide_id, the four book and catalog ids, result_hash), ``files``
    (path, raw text), ``items`` (item_id, the four ids as far as the ledger knows them,
    promoted_book_id, save_readback_hash).  A receipt is read once for all items that
    name it, judged by its own rules and then against both sides: ids that the ledger
    holds bind the transition, ids of the transition bind the receipt, and a promoted
    target book stands for the planned one.  Blank ledger ids bind nothing.  A file or
    an item that is absent is one violation; nothing further is asked of it.  Paths and item
    ids are unique in ``files`` and ``items``; null ids name nothing.
    """
    named = transitions.select(F.col("receipt_path").alias("path")).distinct()
    read = receipt_fields(files.join(named, "path", "left_semi").select(F.col("path").alias("receipt_path"), "raw"))
    kept = ["run_id", "provenance_integrity_hash", "carrier_block_id", "identity.slide_id", *[f"identity.{c}" for c in BOUND_IDENTITY]]
    read = read.select(
        "receipt_path", tagged_sha(F.col("raw")).alias("r_sha256"), failed_rules(receipt_rules()).alias("r_faults"), *[_field(c) for c in kept])
    known = items.select("item_id", F.lit(True).alias("l_known"), F.col("save_readback_hash").alias("l_saved"), *[
        (F.coalesce("promoted_book_id", c) if c == "target_book_id" else F.col(c)).alias(f"l_{c}") for c in BOUND_IDENTITY])
    rows = transitions.join(read, "receipt_path", "left").join(known, "item_id", "left")
    blank = lambda c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) == ""
    differs = lambda a, b: ~F.col(a).cast("string").eqNullSafe(F.col(b).cast("string"))
    hashed = lambda c: F.coalesce(F.col(c).rlike(SHA_PATTERN), F.lit(False))
    file, item = F.col("r_sha256").isNotNull(), F.col("l_known").isNotNull()
    told = ["receipt_sha256", "run_id", "provenance_hash", "carrier_block_id", "slide_id", *BOUND_IDENTITY, "result_hash"]
    lacking = F.array_join(F.filter(F.array(*[F.when(blank(c), F.lit(c)) for c in told]), lambda c: c.isNotNull()), ",")
    bound = []
    for c in BOUND_IDENTITY:
        bound.append((f"{c}_not_of_item", "error", item & ~blank(f"l_{c}") & ~blank(c) & differs(c, f"l_{c}"), F.col(f"l_{c}").cast("string")))
        bound.append((f"{c}_not_of_receipt", "error", file & ~blank(c) & differs(c, _field(f"identity.{c}")), F.col(_field(f"identity.{c}"))))
    told_and = lambda c, failed: file & ~blank(c) & failed
    found = failed_rules([
        ("receipt_file_missing", "error", ~file),
        ("ledger_item_missing", "error", ~item),
        ("evidence_incomplete", "error", lacking != "", lacking),
        ("receipt_file_hash", "error", told_and("receipt_sha256", differs("receipt_sha256", "r_sha256"))),
        ("run_differs", "error", told_and("run_id", differs("run_id", "r_run_id"))),
        ("provenance_hash_differs", "error", told_and("provenance_hash", differs("provenance_hash", "r_provenance_integrity_hash"))),
        ("carrier_differs", "error", told_and("carrier_block_id", differs("carrier_block_id", "r_carrier_block_id"))),
        ("slide_differs", "error", told_and("slide_id", differs("slide_id", "r_identity_slide_id"))),
        *bound,
        ("target_catalog_not_slide", "error", ~blank("target_catalog_id") & ~blank("slide_id") & differs("target_catalog_id", "slide_id")),
        ("result_not_saved", "error", item & (~hashed("result_hash") | differs("result_hash", "l_saved"))),
    ])
    every = F.concat(found, F.coalesce("r_faults", F.filter(found, lambda _: F.lit(False))))
    return rows.select(F.col("item_id").cast("string").alias("entity_id"), F.explode(every).alias("_r")).select("entity_id", "_r.*")


def export_blocks(data_text: Column | str) -> Column:
    """Stored texts of the blocks of an export, nested JSON in its original key order."""
    whole = F.from_json(F.get_json_object(data_text, "$.blocks"), "array<map<string,string>>")
    parsed = F.try_variant_get(F.try_parse_json(data_text), "$.blocks", "array<variant>")

    def stored(block: Column, value: Column) -> Column:
        plain = F.to_json(F.map_filter(F.try_variant_get(value, "$", "map<string,variant>"),
                                       lambda k, _: ~k.isin("template_info", "template_data_content")))
        info = F.try_variant_get(value, "$.template_info", "map<string,variant>")
        content = F.from_json(block["template_info"], "map<string,string>")["content"]
        quoted = F.schema_of_variant(F.try_variant_get(value, "$.template_info.content", "variant")) == "STRING"
        return F.struct(
            plain.alias("rest"), block["template_data_content"].alias("data"), F.to_json(info).alias("info"),
            F.when(quoted, json_string(content)).otherwise(content).alias("info_content"))

    return F.zip_with(whole, parsed, stored)


def validate_readbacks(exports: DataFrame, saves: DataFrame, expected: DataFrame) -> DataFrame:
    """Violations per run of the page read back after a save.

    ``exports`` and ``saves`` have run_id and the tool envelope; ``expected`` has
    run_id, carrier_block_id, target_catalog_id and the provenance text.
    """
    x = unwrap_envelope(exports, "envelope").select(
        "run_id", F.col("data").alias("x_data"), F.col("error").alias("x_error"),
        F.get_json_object("envelope", "$.content[0].text").alias("x_text"))
    s = unwrap_envelope(saves, "envelope").select("run_id", F.col("data").alias("s_data"), F.col("error").alias("s_error"))
    rows = expected.join(x, "run_id", "left").join(s, "run_id", "left")
    rows = rows.withColumn("_blocks", F.try_variant_get("x_data", "$.blocks", "array<variant>"))
    rows = rows.withColumn("_hash", page_content_hash(export_blocks("x_text")))
    carriers = F.filter("_blocks", lambda b: F.try_variant_get(b, "$.uuid", "string") == F.col("carrier_block_id"))
    rows = rows.withColumn("_carriers", carriers).withColumn("_carrier", F.try_element_at("_carriers", F.lit(1)))
    found_prov = F.to_json(F.try_variant_get("_carrier", f"$.template_data_content.{PROVENANCE_KEY}", "variant"))
    paths = key_paths(rows.select("run_id", "x_data"), "x_data", PROVENANCE_KEY)
    counted = paths.groupBy("run_id").agg(F.count("*").alias("n_paths"), F.min("path").alias("first_path"))
    rows = rows.join(counted, "run_id", "left")
    slide = F.col("target_catalog_id").cast("string")
    have_x, have_s = F.col("x_data").isNotNull(), F.col("s_data").isNotNull()
    direct = F.coalesce("first_path", F.lit("")).rlike(rf"^\$\.blocks\[\d+\]\.template_data_content\.{PROVENANCE_KEY}$")
    saved_hash = F.try_variant_get("s_data", "$.contentHash", "string")
    save_rules = [(code, sev, have_s & failed) for code, sev, failed in save_receipt_rules(F.col("s_data"), slide)]
    return explode_rules(rows.withColumn("entity_id", F.col("run_id")), [
        ("export_envelope", "error", ~have_x, F.coalesce("x_error", F.lit("missing"))),
        ("save_envelope", "error", ~have_s, F.coalesce("s_error", F.lit("missing"))),
        ("export_keys", "error", have_x & ~_exact(_keys(F.col("x_data"), "$"), ["slideId", "blocks"])),
        ("export_slide", "error", have_x & ~F.try_variant_get("x_data", "$.slideId", "string").eqNullSafe(slide)),
        *save_rules,
        ("page_hash", "error", have_x & have_s & ~F.col("_hash").eqNullSafe(saved_hash)),
        ("carrier_count", "error", have_x & ~F.size("_carriers").eqNullSafe(F.lit(1))),
        ("carrier_missing_provenance", "error", have_x & (F.size("_carriers") == 1) & found_prov.isNull()),
        ("provenance_paths", "error", have_x & ~((F.coalesce("n_paths", F.lit(0)) == 1) & direct)),
        ("provenance_differs", "error", found_prov.isNotNull() & ~canonical_hash(found_prov).eqNullSafe(canonical_hash("provenance"))),
    ])


def carrier_audit(pages: DataFrame, doc: str = "doc") -> DataFrame:
    """Per page: number of provenance carriers and what to do about it.

    ``pages`` has page_id, the exported document and recorded_carrier (block uuid).
    """
    carried = F.filter(F.try_variant_get(doc, "$.blocks", "array<variant>"), lambda b: F.try_variant_get(
        b, f"$.template_data_content.{PROVENANCE_KEY}", "variant").isNotNull())
    rows = pages.withColumn("_uuids", F.transform(carried, lambda b: F.try_variant_get(b, "$.uuid", "string")))
    paths = key_paths(pages.select("page_id", doc), doc, PROVENANCE_KEY).groupBy("page_id").agg(F.count("*").alias("_n"))
    rows = rows.join(paths, "page_id", "left").withColumn("n_carriers", F.coalesce("_n", F.lit(0)))
    match = F.get("_uuids", F.lit(0)).eqNullSafe(F.col("recorded_carrier"))
    action = (
        F.when(F.col("n_carriers") == 0, "restore").when(F.col("n_carriers") > 1, "stop")
        .when(match, "ok").otherwise("carrier_mismatch"))
    return rows.select("page_id", "n_carriers", action.alias("action"))
