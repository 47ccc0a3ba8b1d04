"""Times queries and prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores, BENCH_QUERIES an
optional comma list of queries (``all`` for every one), BENCH_COLD=1 adds a first
untimed-in-total cold run of each.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from auditflow import queries as registry  # noqa: E402
from auditflow.session import cpus, local_session  # noqa: E402

HEADLINE = [
    "A1_scan_json", "A3_file_fingerprint", "A5_ingest_envelope_lines", "A6_unwrap_envelope",
    "B1_flatten_tree", "B5_page_lines", "B6_page_text", "B7_restyle_pages", "B20_rule_bindings", "B21_source_plan",
    "C1_scale_annotations", "C2_resolve_media", "C4_attach_rich_text", "C5_zip_by_position", "C9_match_source", "C10_plan_refinement",
    "C13_cover_required_checks", "C14_match_existing", "C16_bind_receipts", "C17_verify_evidence_chain",
    "D1_annotation_summary", "D2_plan_by_page", "D12_module_cardinality", "D14_book_rollup",
    "E1_latest_per_key", "E2_recent_topics", "E3_next_matching", "E8_first_wins", "E11_assign_rows", "F1_rank_candidates",
    "G4_same_set", "H2_canonical_hash", "H3_fnv1a32", "H9_layout_plan", "V1_validate_annotations", "V5_maturity_gate",
    "V14_validate_match_audit", "V16_page_resource_scope", "J1_ledger_state_machine", "J2_claim_registry", "J5_lease_handover",
    "J7_apply_token_check", "V10_validate_receipts", "V11_validate_readback", "L7_verify_readbacks", "L1_annotation_import_plan", "L4_course_manifest", "L11_refinement_plan",
]


def run(build, spark, folder: str) -> float:
    started = time.perf_counter()
    build(spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    chosen = os.environ.get("BENCH_QUERIES", "")
    every = registry.queries()
    names = list(every) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    spark = local_session(cpus(), "auditflow-bench", os.environ.get("BENCH_MEMORY", "12g"))
    run(every["D13_warning_histogram"], spark, folder)
    cold, warm, failed = {}, {}, {}
    for name in names:
        try:
            if os.environ.get("BENCH_COLD"):
                cold[name] = run(every[name], spark, folder)
            warm[name] = run(every[name], spark, folder)
        except Exception as error:  # noqa: BLE001
            failed[name] = str(error)[:200]
        if os.environ.get("BENCH_VERBOSE"):
            print(name, cold.get(name), warm.get(name), failed.get(name), file=sys.stderr, flush=True)
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").count()
    scale = re.search(r"sf([0-9.]+)", folder)
    print(json.dumps({
        "metric": "seconds over headline queries", "value": round(sum(warm.values()), 3), "unit": "sec", "queries": warm, "cold": cold,
        "lineitem_rows_per_sec": {n: int(lines / s) for n, s in warm.items() if n[0] in "CDEV" and s},
        "failed": failed, "sf": float(scale.group(1)) if scale else None}))
    spark.stop()


if __name__ == "__main__":
    main()
