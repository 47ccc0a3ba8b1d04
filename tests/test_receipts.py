"""Receipts of regular and irregular shape, and their binding to transitions and items."""

import hashlib
import json

from auditflow.operators import receipts as R

FNV, SHA = "fnv1a32:0000000a", "sha256:" + "1" * 64


def canonical(value):
    text = json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    return "sha256:" + hashlib.sha256(text.encode()).hexdigest()


def receipt(**changes):
    save = {
        "tool": "editor_save_verified", "scope": "current", "slide_id": "7", "saved": True, "saved_scope": "current", "saved_slides": ["7"], "verified": True,
        "verified_scope": "current", "verified_slides": ["7"], "content_hash": FNV, "persisted_content_hash": FNV, "dirty": False, "envelope_hash": SHA}
    export = {
        "tool": "editor_export_slide", "slide_id": "7", "block_count": 3, "page_content_hash": FNV, "blocks_hash": SHA, "carrier_block_hash": SHA, "envelope_hash": SHA}
    body = {
        "schema_version": 1, "kind": R.RECEIPT_KIND, "run_id": 'r"\\é\u2028', "provenance_integrity_hash": SHA, "carrier_block_id": "c",
        "identity": {"slide_id": "7", "source_book_id": "1", "source_catalog_id": "2", "target_book_id": "3", "target_catalog_id": "7"},
        "save": save | {"receipt_hash": canonical(save)}, "export": export | {"receipt_hash": canonical(export)}, "verified_at": "2024-03-01T00:00:00.000Z"}
    body |= changes
    return body | {"artifact_integrity": {"algorithm": "sha256-canonical-json", "canonical_hash": canonical(body)}}


def codes(rows):
    found = {}
    for r in rows:
        found.setdefault(r["entity_id"], set()).add(r["rule_code"])
    return found


def test_shapes_of_receipts(spark):
    good = receipt()
    turned = json.dumps(dict(reversed(list(good.items()))), indent=2)
    texts = {
        "plain": json.dumps(good), "turned": turned, "escaped": json.dumps(good, ensure_ascii=False),
        "more": json.dumps(receipt(more=1)), "typed": json.dumps(good).replace('"dirty": false', '"dirty": "false"'),
        "exponent": json.dumps(good).replace('"block_count": 3', '"block_count": 3e0'), "broken": json.dumps(good)[:-1], "none": None}
    df = spark.createDataFrame(list(texts.items()), "receipt_id string, raw string")
    found = codes(R.validate_receipts(df).collect())
    assert not {"plain", "turned", "escaped", "exponent"} & set(found)
    assert found["more"] == {"receipt_keys"}
    assert {"save_receipt_hash", "canonical_hash"} <= found["typed"]
    assert found["broken"] == found["none"] and {"receipt_keys", "save_keys", "canonical_hash"} <= found["none"]


def test_binding_of_receipt_files(spark):
    raw = json.dumps(receipt())
    told = {
        "receipt_path": "a", "receipt_sha256": "sha256:" + hashlib.sha256(raw.encode()).hexdigest(), "run_id": 'r"\\é\u2028', "provenance_hash": SHA, "carrier_block_id": "c",
        "slide_id": "7", "source_book_id": "1", "source_catalog_id": "2", "target_book_id": "3", "target_catalog_id": "7", "result_hash": SHA}
    moves = {
        1: {}, 2: {"receipt_path": None}, 3: {"receipt_sha256": SHA}, 4: {"source_catalog_id": "9"}, 5: {"target_catalog_id": "8"},
        6: {"run_id": None, "result_hash": None}, 7: {}, 8: {}, 9: {"target_book_id": "5"}}
    names = ["item_id", *told]
    transitions = spark.createDataFrame([(i, *(told | change).values()) for i, change in moves.items()], ", ".join(f"{n} {'int' if n == 'item_id' else 'string'}" for n in names))
    files = spark.createDataFrame([("a", raw, 1)], "path string, raw string, item_id int")
    item = ("1", "2", "3", "7", None, SHA)
    held = {i: item for i in moves if i != 7}
    held[8] = ("1", " ", "6", "7", "3", None)
    items = spark.createDataFrame(
        [(i, *v) for i, v in held.items()], "item_id int, source_book_id string, source_catalog_id string, target_book_id string, target_catalog_id string, promoted_book_id string, save_readback_hash string")
    found = codes(R.bind_receipt_files(transitions, files, items).collect())
    assert found == {
        "2": {"receipt_file_missing", }, "3": {"receipt_file_hash"}, "4": {"source_catalog_id_not_of_item", "source_catalog_id_not_of_receipt"},
        "5": {"target_catalog_id_not_of_item", "target_catalog_id_not_of_receipt", "target_catalog_not_slide"},
        "6": {"evidence_incomplete", "result_not_saved"}, "7": {"ledger_item_missing"}, "8": {"result_not_saved"},
        "9": {"target_book_id_not_of_item", "target_book_id_not_of_receipt"}}
    assert not R.bind_receipt_files(transitions.limit(0), files, items).collect()
