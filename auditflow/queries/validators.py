"""Validation jobs.  Inputs are tampered in known ways; the oracle names the expected violations."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditflow.functions.canon import canonical_hash, idempotency_key, page_content_hash, tagged_sha
from auditflow.operators import annotations as A
from auditflow.operators import packs as PD
from auditflow.operators import extract as E
from auditflow.operators import provenance as P
from auditflow.operators import receipts as R
from auditflow.operators import rulepacks as U
from auditflow.operators import seals
from auditflow.operators import targets as T
from auditflow.queries import query
from auditflow.queries.extract import PLAN_SQL, plan
from auditflow.queries.reports import FOUND


def tally(found: DataFrame) -> DataFrame:
    return found.groupBy("entity_id", "rule_code").agg(F.count("*").alias("n"))


def cases(source: str, entity: str, rules: list[tuple[str, str]]) -> str:
    """Rows (entity_id, rule_code) for every rule whose condition holds."""
    listed = ", ".join(f"CASE WHEN {cond} THEN '{code}' END" for code, cond in rules)
    return f"SELECT entity_id, rule_code FROM (SELECT CAST({entity} AS STRING) AS entity_id, unnest([{listed}]) AS rule_code FROM {source}) WHERE rule_code IS NOT NULL"


def tallied(body: str, ctes: str = "") -> str:
    prefix = f"WITH {ctes} " if ctes else ""
    return f"{prefix}SELECT entity_id, rule_code, count(*) AS n FROM ({body}) GROUP BY ALL"


def union(*parts: str) -> str:
    return " UNION ALL ".join(parts)


def expected(source: str, entity: str, key: str, modulus: int, codes: dict[int, list[str]]) -> str:
    """Expected codes by the remainder that chose the tampering."""
    return cases(source, entity, [(c, f"{key} % {modulus} = {r}") for r, cs in codes.items() for c in cs])


def spark_sql(text: str) -> str:
    return text.replace("SHA(", "sha2_text(")


@query("V1_validate_annotations", tallied("SELECT entity_id, rule_code FROM found", FOUND))
def _(t):
    return tally(A.validate_annotations(t.fx_annotation, t.fx_page, t.fx_media))


PACKS = """
SELECT CAST(o_orderkey AS STRING) AS pack_id, CASE WHEN o_orderkey % 19 = 0 THEN 2 ELSE 1 END AS schema_version, CASE WHEN o_orderkey % 7 = 0 THEN 'Bad Name' ELSE 'pack-' || CAST(o_orderkey AS STRING) END AS skill_name,
  CASE WHEN o_orderkey % 11 = 0 THEN ' ' ELSE 'Pack' END AS display_name, CASE WHEN o_orderkey % 5 = 0 THEN '1.0' ELSE '1.0.2' END AS version, CASE o_orderstatus WHEN 'P' THEN 'open' ELSE 'draft' END AS status, 'family' AS book_family,
  CASE WHEN o_orderkey % 3 = 0 THEN 'odd' ELSE 'hybrid' END AS style_policy, CASE WHEN o_orderkey % 4 = 0 THEN 'odd' END AS module_policy, 'stop' AS on_missing, CASE WHEN o_orderkey % 6 = 0 THEN 'keep_target' ELSE 'skip' END AS on_ambiguous FROM orders"""
PACK_RULES = """
SELECT CAST(l_orderkey AS STRING) AS pack_id, 'r' || CAST(l_linenumber AS STRING) AS rule_id, CASE WHEN l_suppkey % 9 = 0 THEN NULL ELSE CAST(l_suppkey % 4 AS INT) END AS rule_order, 'do' AS intent, CASE WHEN l_tax < 0.01 THEN '' ELSE 'always' END AS when_text,
  CASE l_returnflag WHEN 'A' THEN 'keep_target' ELSE 'skip' END AS on_missing, CASE l_returnflag WHEN 'R' THEN 'keep_target' ELSE 'skip' END AS on_ambiguous FROM lineitem"""
PACK_VARIANTS = "SELECT CAST(l_orderkey AS STRING) AS pack_id, 'v' || CAST(l_suppkey % 5 AS STRING) AS variant_id, l_linenumber AS priority FROM lineitem"
PACK_CHECKS = """
SELECT CAST(l_orderkey AS STRING) AS pack_id, 'r' || CAST(l_linenumber AS STRING) AS rule_id, 'c' || CAST(l_partkey % 3 AS STRING) AS check_id, 'see' AS intent, CASE WHEN l_partkey % 8 = 0 THEN 'fatal' ELSE 'error' END AS severity FROM lineitem WHERE l_quantity > 5
UNION ALL SELECT CAST(o_orderkey AS STRING), NULL, 'accept', '', 'warning' FROM orders WHERE o_orderstatus <> 'O'"""
PACK_FEEDBACK = """
SELECT CAST(l_orderkey AS STRING) AS pack_id, 'f' || CAST(l_suppkey % 6 AS STRING) AS feedback_id, CASE WHEN l_partkey % 2 = 0 THEN 'instance_fix' ELSE 'praise' END AS classification, 'note' AS summary,
  CASE WHEN l_partkey % 5 <> 0 THEN l_partkey % 3 = 0 END AS confirmed, l_linestatus = 'F' AS resolved, CASE WHEN l_suppkey % 2 = 0 THEN 'done' END AS resolution FROM lineitem WHERE l_returnflag = 'R'"""
PACK_REFS = "SELECT CAST(l_orderkey AS STRING) AS pack_id, 'example' AS owner, 'r' || CAST(l_suppkey % 8 AS STRING) AS rule_id FROM lineitem"


def _dup(cte: str, keys: str, code: str, where: str = "true") -> str:
    return f"SELECT pack_id AS entity_id, '{code}' AS rule_code FROM {cte} WHERE {where} GROUP BY pack_id, {keys} HAVING count(*) > 1"


@query("V2_validate_rule_pack", tallied(union(
    cases("(SELECT p.*, (SELECT count(*) FROM ru WHERE ru.pack_id = p.pack_id) AS nr, (SELECT count(*) FROM ck WHERE ck.pack_id = p.pack_id AND rule_id IS NULL) AS na FROM pk p)", "pack_id", [
        ("schema_version", "schema_version <> 1"), ("skill_name", "NOT regexp_matches(skill_name, '^[a-z0-9]+(-[a-z0-9]+)*$')"), ("display_name", "trim(display_name) = ''"),
        ("version", "version = '1.0'"), ("status", "status = 'open'"), ("style_policy", "style_policy = 'odd'"), ("module_policy", "module_policy = 'odd'"), ("on_ambiguous", "on_ambiguous = 'keep_target'"),
        ("rules_empty", "nr = 0"), ("acceptance_empty", "na = 0")]),
    cases("(SELECT ru.*, nc FROM ru LEFT JOIN (SELECT pack_id, rule_id, count(*) AS nc FROM ck WHERE rule_id IS NOT NULL GROUP BY 1, 2) USING (pack_id, rule_id))", "pack_id", [
        ("rule_order", "rule_order IS NULL"), ("rule_when", "when_text = ''"), ("rule_on_ambiguous", "on_ambiguous = 'keep_target'"), ("rule_checks_empty", "nc IS NULL")]),
    cases("ck", "pack_id", [("check_intent", "intent = ''"), ("check_severity", "severity = 'fatal'")]),
    cases("fb", "pack_id", [("feedback_classification", "classification = 'praise'"), ("feedback_confirmed", "confirmed IS NULL"), ("feedback_resolution", "resolved AND resolution IS NULL")]),
    _dup("ru", "rule_id", "rule_id_duplicate"), _dup("ru", "rule_order", "rule_order_duplicate", "rule_order IS NOT NULL"), _dup("va", "variant_id", "variant_id_duplicate"),
    _dup("va", "priority", "variant_priority_duplicate"), _dup("ck", "rule_id, check_id", "check_id_duplicate"), _dup("fb", "feedback_id", "feedback_id_duplicate"),
    "SELECT pack_id, 'reference_unknown_rule' FROM rf WHERE NOT EXISTS (SELECT 1 FROM ru WHERE ru.pack_id = rf.pack_id AND ru.rule_id = rf.rule_id)"),
    f"pk AS ({PACKS}), ru AS ({PACK_RULES}), va AS ({PACK_VARIANTS}), ck AS ({PACK_CHECKS}), fb AS ({PACK_FEEDBACK}), rf AS ({PACK_REFS})"))
def _(t):
    return tally(U.validate_rule_packs(*[t.sql(s) for s in (PACKS, PACK_RULES, PACK_VARIANTS, PACK_CHECKS, PACK_FEEDBACK, PACK_REFS)]))


SELECTORS = """
SELECT o_orderkey AS selector_id, CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'slot 3' ELSE 'lesson title' END AS role, CASE WHEN o_orderkey % 7 = 0 THEN -1 ELSE 1 END AS card_min,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_orderkey % 6 = 1 THEN 0 ELSE 2 END AS card_max FROM orders"""
SELECTOR_EVIDENCE = """
SELECT l_orderkey AS selector_id, CASE l_returnflag WHEN 'A' THEN 'semantic' WHEN 'R' THEN 'structure' ELSE 'other' END AS class, CASE l_linenumber WHEN 2 THEN 'element_id' WHEN 3 THEN 'Bad Kind' ELSE 'layout' END AS kind,
  CASE l_suppkey % 5 WHEN 0 THEN 'the slot_id' WHEN 1 THEN '123' ELSE 'title above list' END AS claim, CASE WHEN l_suppkey % 9 = 0 THEN '' ELSE 'two columns wide' END AS observation FROM lineitem"""


@query("V3_validate_selectors", tallied(union(
    cases("(SELECT s.*, coalesce(n, 0) AS n, coalesce(ns, 0) AS ns, coalesce(nt, 0) AS nt FROM s LEFT JOIN (SELECT selector_id, count(*) AS n, count(*) FILTER (WHERE class = 'semantic') AS ns, count(*) FILTER (WHERE class = 'structure') AS nt FROM e GROUP BY 1) USING (selector_id))", "selector_id", [
        ("role_required", "role = ''"), ("role_id_disguise", "role = 'slot 3'"), ("cardinality_min", "card_min < 0"), ("cardinality_order", "card_max < card_min"), ("evidence_too_few", "n < 2"),
        ("semantic_evidence_missing", "n >= 2 AND ns = 0"), ("structure_evidence_missing", "n >= 2 AND nt = 0")]),
    cases("e", "selector_id", [("evidence_class", "class = 'other'"), ("evidence_kind", "kind = 'Bad Kind'"), ("evidence_kind_is_id", "kind = 'element_id'"),
        ("claim_id_disguise", "claim IN ('the slot_id', '123')"), ("observation_required", "observation = ''")])),
    f"s AS ({SELECTORS}), e AS ({SELECTOR_EVIDENCE})"))
def _(t):
    return tally(U.validate_selectors(t.sql(SELECTORS), t.sql(SELECTOR_EVIDENCE)))


ACTIONS = """
SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN repeat('{"type":"atomic_sequence","intent":"x","required_capabilities":["deep"],"steps":[', 9) || '{"type":"leaf","intent":"y"}' || repeat(']}', 9)
  WHEN o_orderkey % 5 = 0 THEN '{"type":"copy","intent":"x","style_policy":"odd","steps":[{"type":"z","intent":"z"}]}'
  WHEN o_orderkey % 7 = 0 THEN '{"type":"atomic_sequence","intent":" ","steps":[]}'
  ELSE '{"type":"atomic_sequence","intent":"x","required_capabilities":["cap_' || o_orderstatus || '","save"],"steps":[{"type":"a","intent":"b","required_capabilities":["save"]},{"type":"","intent":"c"}]}' END AS raw FROM orders"""


def steps(t):
    return U.flatten_actions(t.sql(ACTIONS).withColumn("action", F.try_parse_json("raw")), ["o_orderkey"])


@query("V4_flatten_actions", """
SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 10 WHEN o_orderkey % 5 = 0 OR o_orderkey % 7 = 0 THEN 1 ELSE 3 END AS n_steps, CASE WHEN o_orderkey % 11 = 0 THEN 9 WHEN o_orderkey % 5 = 0 OR o_orderkey % 7 = 0 THEN 0 ELSE 1 END AS max_depth,
  CASE WHEN o_orderkey % 11 = 0 THEN 1 WHEN o_orderkey % 5 = 0 OR o_orderkey % 7 = 0 THEN 0 ELSE 2 END AS n_capabilities,
  CASE WHEN o_orderkey % 11 = 0 THEN 1 WHEN o_orderkey % 5 = 0 THEN 2 WHEN o_orderkey % 7 = 0 THEN 2 ELSE 1 END AS n_violations FROM orders""")
def _(t):
    rows = steps(t)
    empty = t.spark.createDataFrame([], "o_orderkey bigint, capabilities array<string>")
    needed = U.needed_capabilities(rows, empty, ["o_orderkey"]).groupBy("o_orderkey").agg(F.count("*").alias("c"))
    found = U.action_violations(rows, F.col("o_orderkey")).groupBy(F.col("entity_id").cast("bigint").alias("o_orderkey")).agg(F.count("*").alias("v"))
    base = rows.groupBy("o_orderkey").agg(F.count("*").alias("n_steps"), F.max("depth").alias("max_depth"))
    return base.join(needed, "o_orderkey", "left").join(found, "o_orderkey", "left").select(
        "o_orderkey", F.col("n_steps").cast("int").alias("n_steps"), "max_depth", F.coalesce("c", F.lit(0)).cast("int").alias("n_capabilities"), F.coalesce("v", F.lit(0)).cast("int").alias("n_violations"))


HEX = "'sha256:' || repeat('0', 64)"
G_PACKS = "SELECT o_orderkey AS pack_id, CASE o_orderstatus WHEN 'F' THEN 'validated' WHEN 'O' THEN 'trial_approved' ELSE 'draft' END AS status, o_orderkey % 5 <> 0 AS approved FROM orders"
G_TEMPLATES = f"SELECT o_orderkey AS pack_id, 'default' AS template, CASE WHEN o_orderkey % 6 = 0 THEN 'none' ELSE {HEX} END AS snapshot_hash FROM orders"
G_NEEDED = "SELECT DISTINCT l_orderkey AS pack_id, 'cap' || CAST(l_suppkey % 4 AS STRING) AS capability FROM lineitem"
G_AVAILABLE = "SELECT DISTINCT l_orderkey AS pack_id, 'cap' || CAST(l_partkey % 4 AS STRING) AS capability FROM lineitem"
G_CASES = """SELECT l_orderkey AS pack_id, CAST(l_suppkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) AS case_id, CASE l_returnflag WHEN 'N' THEN 'failed' ELSE 'passed' END AS status,
 'a' || CAST(l_partkey % 50 AS STRING) AS artifact, CAST(l_suppkey % 30 AS STRING) AS source_id, 'h' || CAST(l_suppkey % 37 AS STRING) AS source_hash, 't' || CAST(l_partkey % 40 AS STRING) AS target_id, 'u' || CAST(l_partkey % 45 AS STRING) AS target_hash FROM lineitem"""
G_ACCEPT = "SELECT o_orderkey AS pack_id, 'acc1' AS check_id FROM orders UNION ALL SELECT o_orderkey, 'acc2' FROM orders"
G_RESULTS = """SELECT l_orderkey AS pack_id, CAST(l_suppkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) AS case_id, CASE WHEN l_tax > 0.06 THEN 'accX' WHEN l_tax > 0.03 THEN 'acc2' ELSE 'acc1' END AS check_id,
 CASE l_linestatus WHEN 'F' THEN 'passed' ELSE 'failed' END AS status FROM lineitem"""
G_FEEDBACK = "SELECT o_orderkey AS pack_id, 'fb' AS feedback_id, o_orderkey % 3 <> 0 AS confirmed, CASE WHEN o_orderkey % 2 = 0 THEN true END AS resolved FROM orders"
_DIMS = ["artifact", "source_id", "source_hash", "target_id", "target_hash"]


@query("V5_maturity_gate", tallied(union(
    "SELECT CAST(pack_id AS STRING) AS entity_id, 'template_hash' AS rule_code FROM te JOIN ex USING (pack_id) WHERE snapshot_hash = 'none'",
    "SELECT CAST(pack_id AS STRING), 'approval_missing' FROM pk WHERE status <> 'draft' AND NOT approved",
    "SELECT CAST(pack_id AS STRING), 'capability_unavailable' FROM (SELECT * FROM ne EXCEPT SELECT * FROM av) JOIN ex USING (pack_id)",
    "SELECT CAST(v.pack_id AS STRING), 'forward_tests_too_few' FROM v LEFT JOIN pa USING (pack_id) GROUP BY v.pack_id HAVING count(pa.case_id) < 2",
    *[f"SELECT CAST(pack_id AS STRING), 'forward_{d}_repeated' FROM pa GROUP BY pack_id, {d} HAVING count(*) > 1" for d in _DIMS],
    "SELECT CAST(pa.pack_id AS STRING), CASE WHEN r.result IS NULL THEN 'acceptance_missing' ELSE 'acceptance_not_passed' END FROM pa JOIN ac USING (pack_id) LEFT JOIN re r ON r.pack_id = pa.pack_id AND r.case_id = pa.case_id AND r.check_id = ac.check_id WHERE r.result IS NULL OR r.result <> 'passed'",
    "SELECT CAST(pack_id AS STRING), 'acceptance_unknown' FROM re WHERE check_id = 'accX' AND EXISTS (SELECT 1 FROM pa WHERE pa.pack_id = re.pack_id AND pa.case_id = re.case_id)",
    "SELECT CAST(pack_id AS STRING), 'feedback_open' FROM fb JOIN v USING (pack_id) WHERE NOT coalesce(confirmed AND resolved, false)"),
    f"pk AS ({G_PACKS}), te AS ({G_TEMPLATES}), ne AS ({G_NEEDED}), av AS ({G_AVAILABLE}), cs AS ({G_CASES}), ac AS ({G_ACCEPT}), fb AS ({G_FEEDBACK}), ex AS (SELECT pack_id FROM pk WHERE status <> 'draft'), v AS (SELECT pack_id FROM pk WHERE status = 'validated'), "
    f"pa AS (SELECT cs.* FROM cs JOIN v USING (pack_id) WHERE status = 'passed'), re AS (SELECT pack_id, case_id, check_id, max(status) AS result FROM ({G_RESULTS}) GROUP BY 1, 2, 3)"))
def _(t):
    return tally(U.maturity_gate(*[t.sql(s) for s in (G_PACKS, G_TEMPLATES, G_NEEDED, G_AVAILABLE, G_CASES, G_ACCEPT, G_RESULTS, G_FEEDBACK)]))


AR_REPORTS = "SELECT o_orderkey AS report_id, CASE WHEN o_orderkey % 9 = 0 THEN 2 ELSE 1 END AS schema_version, CASE WHEN o_orderkey % 8 = 0 THEN 'x' ELSE CAST(o_orderkey AS STRING) END AS case_id, CAST(o_orderkey AS STRING) AS expected_case_id, CASE o_orderstatus WHEN 'P' THEN 'failed' ELSE 'passed' END AS status FROM orders"
AR_CHECKS = "SELECT l_orderkey AS report_id, 'k' || CAST(l_linenumber AS STRING) AS check_id, CASE l_linestatus WHEN 'F' THEN 'passed' ELSE 'open' END AS status FROM lineitem"
AR_EVIDENCE = "SELECT l_orderkey AS report_id, 'k' || CAST(l_linenumber AS STRING) AS check_id, 'f' || CAST(l_partkey AS STRING) AS artifact, CASE WHEN l_suppkey % 10 = 0 THEN 'zz' ELSE 's' || CAST(l_partkey AS STRING) END AS artifact_sha256 FROM lineitem WHERE l_returnflag <> 'N'"
AR_FILES = "SELECT 'f' || CAST(p_partkey AS STRING) AS path, 's' || CAST(p_partkey AS STRING) AS sha256 FROM part WHERE p_size <> 3"


@query("V6_validate_acceptance_report", tallied(union(
    cases("(SELECT r.*, n FROM r LEFT JOIN (SELECT report_id, count(*) AS n FROM c GROUP BY 1) USING (report_id))", "report_id", [("schema_version", "schema_version <> 1"), ("case_binding", "case_id = 'x'"), ("status_not_passed", "status = 'failed'"), ("checks_empty", "n IS NULL")]),
    cases("(SELECT c.*, n FROM c LEFT JOIN (SELECT report_id, check_id, count(*) AS n FROM e GROUP BY 1, 2) USING (report_id, check_id))", "report_id", [("check_not_passed", "status = 'open'"), ("check_evidence_empty", "n IS NULL")]),
    "SELECT CAST(report_id AS STRING), 'check_duplicate' FROM c GROUP BY report_id, check_id HAVING count(*) > 1",
    cases("(SELECT e.*, sha256 FROM e LEFT JOIN f ON artifact = path)", "report_id", [("artifact_missing", "sha256 IS NULL"), ("artifact_sha_mismatch", "sha256 <> artifact_sha256")])),
    f"r AS ({AR_REPORTS}), c AS ({AR_CHECKS}), e AS ({AR_EVIDENCE}), f AS ({AR_FILES})"))
def _(t):
    return tally(U.validate_acceptance_reports(*[t.sql(s) for s in (AR_REPORTS, AR_CHECKS, AR_EVIDENCE, AR_FILES)]))


# Runs bind the lines of an order: one source and one target block per line.
RUNS = """
SELECT o_orderkey AS run_id, CASE o_orderstatus WHEN 'F' THEN 'trial' WHEN 'O' THEN 'batch' ELSE 'legacy_inferred' END AS mode, 'sb' || CAST(o_custkey % 9 AS STRING) AS source_book_id, 'sc' AS source_catalog_id,
  'tb' || CAST(o_custkey % 4 AS STRING) AS target_book_id, CAST(o_orderkey AS STRING) AS target_catalog_id, o_orderkey % 3 = 0 AS restricted, o_orderkey % 3 <> 0 AS required_passed FROM orders"""
LINE = "CAST(l_suppkey AS STRING) || '.' || CAST(l_partkey AS STRING)"
RULES = "SELECT o_orderkey AS run_id, 'r1' AS rule_id FROM orders UNION ALL SELECT o_orderkey, 'r2' FROM orders UNION ALL SELECT o_orderkey, 'r3' FROM orders"
BINDINGS = f"SELECT l_orderkey AS run_id, 'r' || CAST(l_linenumber AS STRING) AS rule_id, CASE WHEN l_suppkey % 14 = 0 THEN 'odd' ELSE 'applied' END AS status, CASE WHEN l_partkey % 10 = 0 THEN '' ELSE 'moved' END AS action_summary, CASE WHEN l_partkey % 6 = 0 THEN NULL ELSE {HEX} END AS result_hash FROM lineitem"
ITEM_BASE = f"""
SELECT l_orderkey AS run_id, 'r' || CAST(l_linenumber AS STRING) AS rule_id, 'source' AS side, 'sb' || CAST(o_custkey % 9 AS STRING) AS book_id, 'sc' AS catalog_id, {LINE} AS block_id, CASE WHEN l_suppkey % 8 = 0 THEN 'Block' ELSE 'block' END AS entity_kind,
  CASE WHEN l_suppkey % 13 = 0 THEN 'other' ELSE {LINE} END AS entity_id, 'title' AS semantic_role, {HEX} AS snapshot_hash, l_partkey % 12 = 0 AS tampered FROM lineitem JOIN orders ON l_orderkey = o_orderkey
UNION ALL SELECT l_orderkey, 'r' || CAST(l_linenumber AS STRING), 'target', 'tb' || CAST(o_custkey % 4 AS STRING), CASE WHEN l_partkey % 7 = 0 THEN 'elsewhere' ELSE CAST(o_orderkey AS STRING) END, {LINE}, 'text', 'e1', 'title',
  CASE WHEN l_partkey % 15 = 0 THEN 'none' ELSE {HEX} END, false FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_suppkey % 11 <> 0"""
IDENT = """'{"block_id":"' || block_id || '","book_id":"' || book_id || '","catalog_id":"' || catalog_id || '","entity_id":"' || entity_id || '","entity_kind":"' || entity_kind || '","side":"' || side || '"}'"""
ITEMS = f"""SELECT *, CASE WHEN tampered THEN {HEX} ELSE 'sha256:' || SHA('{{"identity":' || {IDENT} || ',"semantic_role":"' || semantic_role || '","snapshot_hash":"' || snapshot_hash || '"}}') END AS binding_hash FROM ({ITEM_BASE})"""
EV_BASE = f"""SELECT run_id, rule_id, side, book_id, catalog_id, CASE WHEN bad THEN 'lost' ELSE block_id END AS block_id, entity_kind, entity_id, 'snapshot' AS kind, 'seen' AS summary, {HEX} AS artifact_hash
 FROM (SELECT *, length(block_id) % 5 = 0 AS bad FROM ({ITEM_BASE})) WHERE side = 'source' AND length(block_id) <> 4"""
EVIDENCE = f"""SELECT *, 'sha256:' || SHA('{{"artifact_hash":"' || artifact_hash || '","identity":' || {IDENT} || ',"kind":"snapshot","summary":"seen"}}') AS evidence_hash FROM ({EV_BASE})"""


def duck(text: str) -> str:
    return text.replace("SHA(", "sha256(")


def run_tables(t):
    def made(text):
        return t.sql(text.replace("SHA(", "audit_sha("))

    # Spark names the function differently, so the shared text gets it as a SQL function.
    t.spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION audit_sha(x STRING) RETURNS STRING RETURN sha2(x, 256)")
    return t.sql(RUNS), t.sql(RULES), t.sql(BINDINGS), made(ITEMS).drop("tampered"), made(EVIDENCE)


V7_CTES = duck(f"ru AS ({RUNS}), rl AS ({RULES}), bi AS ({BINDINGS}), it AS ({ITEMS}), ev AS ({EVIDENCE}), st AS (SELECT run_id FROM ru WHERE mode <> 'legacy_inferred')")
V7_BODY = union(
    cases("""(SELECT bi.*, mode, coalesce(ns, 0) AS ns, coalesce(nt, 0) AS nt, coalesce(ne, 0) AS ne FROM bi JOIN ru USING (run_id) LEFT JOIN (SELECT run_id, rule_id, count(*) FILTER (WHERE side = 'source') AS ns, count(*) FILTER (WHERE side = 'target') AS nt FROM it GROUP BY 1, 2) USING (run_id, rule_id)
      LEFT JOIN (SELECT run_id, rule_id, count(*) AS ne FROM ev GROUP BY 1, 2) USING (run_id, rule_id))""", "run_id", [
        ("binding_status", "status = 'odd'"), ("binding_summary", "action_summary = ''"), ("binding_evidence_empty", "ne = 0"), ("binding_sides_empty", "mode <> 'legacy_inferred' AND (ns = 0 OR nt = 0)"),
        ("binding_result_hash", "mode <> 'legacy_inferred' AND result_hash IS NULL")]),
    cases("(SELECT run_id, rule_id, sum(b) AS b, sum(r) AS r FROM (SELECT run_id, rule_id, 1 AS b, 0 AS r FROM bi UNION ALL SELECT run_id, rule_id, 0, 1 FROM rl) GROUP BY 1, 2)", "run_id", [
        ("rule_uncovered", "b = 0"), ("rule_unknown", "r = 0"), ("rule_bound_twice", "b > 1")]),
    cases("(SELECT it.* FROM it JOIN st USING (run_id))", "run_id", [
        ("identity_entity_kind", "entity_kind = 'Block'"), ("identity_scope", "catalog_id = 'elsewhere'"), ("identity_block", "entity_kind = 'block' AND entity_id <> block_id"),
        ("binding_snapshot_hash", "snapshot_hash = 'none'"), ("binding_hash_mismatch", "tampered")]),
    """SELECT CAST(run_id AS STRING), 'evidence_unbound' FROM ev JOIN st USING (run_id) WHERE NOT EXISTS (SELECT 1 FROM it WHERE it.run_id = ev.run_id AND it.rule_id = ev.rule_id AND it.side = ev.side AND it.book_id = ev.book_id
       AND it.catalog_id = ev.catalog_id AND it.block_id = ev.block_id AND it.entity_kind = ev.entity_kind AND it.entity_id = ev.entity_id)""",
    "SELECT CAST(run_id AS STRING), 'binding_duplicate' FROM it JOIN st USING (run_id) GROUP BY run_id, rule_id, side, binding_hash HAVING count(*) > 1",
    "SELECT CAST(run_id AS STRING), 'evidence_duplicate' FROM ev JOIN st USING (run_id) GROUP BY run_id, rule_id, evidence_hash HAVING count(*) > 1")


@query("V7_validate_bindings", tallied(V7_BODY, V7_CTES))
def _(t):
    return tally(P.validate_bindings(*run_tables(t)))


REQ = "SELECT o_orderkey AS run_id, 'rule:r1:c1' AS required_key, 'c1' AS id, 'r1' AS rule_id FROM orders UNION ALL SELECT o_orderkey, 'acceptance:c2', 'c2', NULL FROM orders"
REP = "SELECT l_orderkey AS run_id, 'c' || CAST(l_linenumber AS STRING) AS id, CASE WHEN l_linenumber = 1 AND l_suppkey % 2 = 0 THEN 'r1' END AS rule_id, CASE l_returnflag WHEN 'A' THEN 'passed' WHEN 'R' THEN 'passed' ELSE 'weird' END AS status, CASE l_linestatus WHEN 'F' THEN 1 ELSE 0 END AS n_evidence FROM lineitem"


@query("V8_validate_provenance", tallied(union(
    V7_BODY,
    cases("co", "run_id", [("check_uncovered", "n = 0"), ("check_ambiguous", "n > 1")]),
    cases("rp", "run_id", [("check_status", "status = 'weird'"), ("check_evidence", "status = 'passed' AND n_evidence = 0")]),
    cases("(SELECT ru.*, ok FROM ru JOIN (SELECT run_id, bool_and(n = 1 AND status = 'passed') AS ok FROM co GROUP BY 1) USING (run_id))", "run_id", [
        ("restricted_flag", "restricted <> (NOT ok OR mode = 'legacy_inferred')"), ("required_passed_flag", "required_passed <> ok")]),
    cases("ru", "run_id", [("approval_of_mode_missing", "mode <> 'batch'"), ("baseline_hash", "run_id % 17 = 3"), ("integrity_hash", "run_id % 17 IN (3, 5)")])),
    V7_CTES + f", rp AS ({REP}), co AS (SELECT q.run_id, q.required_key, count(rp.id) AS n, min(rp.status) AS status FROM ({REQ}) q LEFT JOIN rp ON rp.run_id = q.run_id AND rp.id = q.id AND (rp.rule_id IS NULL OR rp.rule_id = q.rule_id) GROUP BY 1, 2)"))
def _(t):
    runs, rules, bindings, items, evidence = run_tables(t)
    base = F.to_json(F.struct(F.col("run_id").alias("z"), F.col("mode").alias("a")))
    body = F.concat(F.lit('{"run_id":"'), F.col("run_id").cast("string"), F.lit('","baseline":'), base, F.lit(',"baseline_hash":"'), canonical_hash(base), F.lit('"}'))
    sealed = F.concat(F.expr("substring(_body, 1, length(_body) - 1)"), F.lit(',"integrity_hash":"'), canonical_hash("_body"), F.lit('"}'))
    tamper = F.when(F.col("run_id") % 17 == 3, F.replace("provenance", F.lit('"a":'), F.lit('"b":'))).when(
        F.col("run_id") % 17 == 5, F.replace("provenance", F.lit('{"run_id":"'), F.lit('{"run_id":"x'))).otherwise(F.col("provenance"))
    runs = runs.withColumn("_body", body).withColumn("provenance", sealed).withColumn("provenance", tamper).drop("_body")
    runs = runs.withColumn("approvals", F.array(F.struct(
        F.lit(None).cast("string").alias("text"), F.lit("a1").alias("id"), F.lit("batch_authorization").alias("type"), F.lit("confirmed").alias("status"),
        F.lit("me").alias("confirmed_by"), F.lit(1).alias("n_evidence"))))
    return tally(P.validate_provenance(runs, rules, bindings, items, evidence, t.sql(REQ), t.sql(REP)))


SAVES = """
SELECT o_orderkey AS slide_id, o_orderkey % 9 AS k, '{"scope":"current","slideId":' || CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey AS STRING) ELSE '"' || CAST(o_orderkey AS STRING) || '"' END
  || ',"saved":true,"savedScope":"current","savedSlides":["' || CAST(o_orderkey AS STRING) || '"],"verified":true,"verifiedScope":"current","verifiedSlides":["' || CAST(o_orderkey AS STRING) || '"],"contentHash":"fnv1a32:0000000a","persistedContentHash":"fnv1a32:0000000a","dirty":false,"warnings":[]}' AS clean FROM orders"""
SAVE_TAMPER = """CASE k WHEN 1 THEN replace(clean, '"scope":"current"', '"scope":"all"') WHEN 2 THEN replace(clean, ',"warnings":[]', '') WHEN 3 THEN replace(clean, '"dirty":false', '"dirty":true')
  WHEN 4 THEN replace(clean, '"contentHash":"fnv1a32:0', '"contentHash":"fnv1a32:1') WHEN 5 THEN replace(clean, '"warnings":[]', '"warnings":["w"]') WHEN 6 THEN replace(clean, '{"scope"', '{"more":1,"scope"')
  WHEN 7 THEN replace(clean, '{"scope"', '{"authoringContentHash":"fnv1a32:0000000b","scope"') WHEN 8 THEN replace(clean, '"savedSlides":[', '"savedSlides":["q",') ELSE clean END"""


@query("V9_validate_save_receipt", tallied(expected("orders", "o_orderkey", "o_orderkey", 9, {
    1: ["save_scope"], 2: ["save_keys", "save_warnings"], 3: ["save_dirty"], 4: ["save_hash_differs"], 5: ["save_warnings"], 6: ["save_keys"], 7: ["save_authoring_hash"], 8: ["save_slides"]})))
def _(t):
    return tally(R.validate_save_receipts(t.sql(SAVES).withColumn("raw", F.expr(SAVE_TAMPER))))


def receipts(t, tamper: bool = True) -> DataFrame:
    """Sealed readback receipts of all orders, seven of eight tampered after sealing."""
    slide, one = F.col("o_orderkey").cast("string"), F.lit("sha256:" + "1" * 64)
    page = F.concat(F.lit("fnv1a32:"), F.lpad(F.lower(F.hex("o_orderkey")), 8, "0"))
    save = [F.lit("editor_save_verified").alias("tool"), F.lit("current").alias("scope"), slide.alias("slide_id"), F.lit(True).alias("saved"), F.lit("current").alias("saved_scope"),
            F.array(slide).alias("saved_slides"), F.lit(True).alias("verified"), F.lit("current").alias("verified_scope"), F.array(slide).alias("verified_slides"),
            page.alias("content_hash"), page.alias("persisted_content_hash"), F.lit(False).alias("dirty"), one.alias("envelope_hash")]
    export = [F.lit("editor_export_slide").alias("tool"), slide.alias("slide_id"), F.lit(3).alias("block_count"), page.alias("page_content_hash"),
              one.alias("blocks_hash"), one.alias("carrier_block_hash"), one.alias("envelope_hash")]
    head = [F.lit(1).alias("schema_version"), F.lit(R.RECEIPT_KIND).alias("kind"), F.concat(F.lit("run"), slide).alias("run_id"), one.alias("provenance_integrity_hash"), F.lit("carrier").alias("carrier_block_id"),
            F.struct(slide.alias("slide_id"), F.lit("1").alias("source_book_id"), F.lit("2").alias("source_catalog_id"), F.lit("3").alias("target_book_id"), slide.alias("target_catalog_id")).alias("identity")]
    rows = R.seal_receipts(t.orders.select("o_orderkey"), head, save, export, F.lit("2024-03-01T00:00:00.000Z"))
    rows = rows.select(F.col("o_orderkey").alias("receipt_id"), (F.col("o_orderkey") % 8).alias("k"), F.col("raw").alias("clean"))
    changed = F.expr("""CASE k WHEN 1 THEN replace(clean, '"dirty":false', '"dirty":true') WHEN 2 THEN replace(clean, '"block_count":3', '"block_count":0') WHEN 3 THEN replace(clean, '"kind":', '"kindx":')
      WHEN 4 THEN replace(clean, '000Z"', '000+1"') WHEN 5 THEN replace(clean, 'sha256-canonical-json', 'md5') WHEN 6 THEN replace(clean, '"identity":{"slide_id":"', '"identity":{"slide_id":"x') WHEN 7 THEN replace(clean, '"run_id":"run', '"run_id":"rum') ELSE clean END""")
    return rows.withColumn("raw", changed if tamper else F.col("clean"))


@query("V10_validate_receipts", tallied(expected("orders", "o_orderkey", "o_orderkey", 8, {
    1: ["save_flags", "save_receipt_hash", "canonical_hash"], 2: ["export_block_count", "export_receipt_hash", "canonical_hash"], 3: ["receipt_keys", "receipt_kind", "canonical_hash"],
    4: ["receipt_time", "canonical_hash"], 5: ["integrity_keys"], 6: ["slide_mismatch", "slides_lists", "canonical_hash"], 7: ["canonical_hash"]})))
def _(t):
    return tally(R.validate_receipts(receipts(t)))


L6_RUNS = """SELECT o_orderkey AS run_id, CASE o_orderkey % 5 WHEN 0 THEN 'trial' WHEN 1 THEN 'batch' WHEN 2 THEN 'legacy_inferred' END AS execution_mode,
  CASE o_custkey % 3 WHEN 0 THEN 'i1' WHEN 1 THEN ' ' END AS batch_item_id, CASE WHEN o_custkey % 4 < 2 THEN o_custkey % 4 = 0 END AS batch FROM orders"""


@query("L6_execution_limits", f"""
WITH v AS (SELECT l_orderkey AS run_id, count(*) FILTER (WHERE l_linenumber = 1) = 1 AND min(CASE WHEN l_linenumber = 1 THEN l_returnflag END) = 'A' AS passed FROM lineitem GROUP BY 1),
 m AS (SELECT run_id, coalesce(execution_mode, CASE WHEN trim(batch_item_id) <> '' OR batch THEN 'batch' ELSE 'legacy_inferred' END) AS mode, coalesce(passed, false) AS passed FROM ({L6_RUNS}) LEFT JOIN v USING (run_id))
SELECT run_id, mode, CASE mode WHEN 'batch' THEN 'batch_authorization' WHEN 'trial' THEN 'trial_authorization' ELSE 'legacy_source_confirmation' END AS required_authorization_type, NOT passed OR mode = 'legacy_inferred' AS restricted,
  concat_ws(',', CASE WHEN NOT passed THEN 'required_error_validation_incomplete' END, CASE WHEN mode = 'legacy_inferred' THEN 'legacy_inferred_record_manual_only' END) AS reasons FROM m""")
def _(t):
    required = t.sql("SELECT o_orderkey AS run_id, 'acceptance:c1' AS required_key, 'c1' AS id, CAST(NULL AS STRING) AS rule_id FROM orders")
    reported = t.sql("SELECT l_orderkey AS run_id, 'c' || CAST(l_linenumber AS STRING) AS id, CAST(NULL AS STRING) AS rule_id, CASE l_returnflag WHEN 'A' THEN 'passed' ELSE 'failed' END AS status FROM lineitem")
    return P.execution_limits(t.sql(L6_RUNS), required, reported).select(
        "run_id", "mode", "required_authorization_type", "restricted", F.array_join("restriction_reasons", ",").alias("reasons"))


# Transitions of orders with the receipts above as files; fixed shares name another file, hash, run, book, page or result.
R_TRANSITIONS = """SELECT o_orderkey AS item_id, CASE WHEN o_orderkey % 17 = 3 THEN 'f/none' ELSE 'f/' || CAST(o_orderkey AS STRING) END AS receipt_path, 'run' || CAST(o_orderkey AS STRING) AS run_id,
  'sha256:' || repeat(CASE WHEN o_orderkey % 19 = 0 THEN '2' ELSE '1' END, 64) AS provenance_hash, CASE WHEN o_orderkey % 23 = 0 THEN 'other' ELSE 'carrier' END AS carrier_block_id, CAST(o_orderkey AS STRING) AS slide_id,
  CASE WHEN o_orderkey % 29 = 0 THEN '9' ELSE '1' END AS source_book_id, CASE WHEN o_orderkey % 31 = 0 THEN ' ' ELSE '2' END AS source_catalog_id, '3' AS target_book_id,
  CASE WHEN o_orderkey % 37 = 0 THEN 'x' ELSE CAST(o_orderkey AS STRING) END AS target_catalog_id, 'sha256:' || repeat('a', 64) AS result_hash FROM orders"""
R_ITEMS = """SELECT o_orderkey AS item_id, '1' AS source_book_id, CAST(NULL AS STRING) AS source_catalog_id, CASE WHEN o_orderkey % 2 = 0 THEN '7' ELSE '3' END AS target_book_id,
  CASE WHEN o_orderkey % 43 = 0 THEN '8' WHEN o_orderkey % 2 = 0 THEN '3' END AS promoted_book_id, CAST(o_orderkey AS STRING) AS target_catalog_id,
  CASE WHEN o_orderkey % 47 <> 0 THEN 'sha256:' || repeat('a', 64) END AS save_readback_hash FROM orders WHERE o_orderkey % 41 <> 0"""


@query("C16_bind_receipt_files", f"""
WITH x AS (SELECT t.*, item_id % 8 AS k, item_id % 17 <> 3 AS f, l.item_id IS NOT NULL AS known, l.source_book_id AS lb, coalesce(l.promoted_book_id, l.target_book_id) AS lt, l.target_catalog_id AS lc, l.save_readback_hash AS ls
   FROM ({R_TRANSITIONS}) t LEFT JOIN ({R_ITEMS}) l USING (item_id)),
 c AS (SELECT item_id, unnest(list_concat([CASE WHEN NOT f THEN 'receipt_file_missing' END, CASE WHEN NOT known THEN 'ledger_item_missing' END, CASE WHEN item_id % 31 = 0 THEN 'evidence_incomplete' END,
   CASE WHEN f AND item_id % 13 = 0 THEN 'receipt_file_hash' END, CASE WHEN f AND k = 7 THEN 'run_differs' END, CASE WHEN f AND item_id % 19 = 0 THEN 'provenance_hash_differs' END,
   CASE WHEN f AND item_id % 23 = 0 THEN 'carrier_differs' END, CASE WHEN f AND k = 6 THEN 'slide_differs' END, CASE WHEN source_book_id <> lb THEN 'source_book_id_not_of_item' END,
   CASE WHEN f AND source_book_id <> '1' THEN 'source_book_id_not_of_receipt' END, CASE WHEN target_book_id <> lt THEN 'target_book_id_not_of_item' END,
   CASE WHEN target_catalog_id <> lc THEN 'target_catalog_id_not_of_item' END, CASE WHEN f AND target_catalog_id <> slide_id THEN 'target_catalog_id_not_of_receipt' END,
   CASE WHEN target_catalog_id <> slide_id THEN 'target_catalog_not_slide' END, CASE WHEN known AND ls IS NULL THEN 'result_not_saved' END],
   CASE WHEN NOT f THEN [] ELSE CASE k WHEN 1 THEN ['save_flags', 'save_receipt_hash', 'canonical_hash'] WHEN 2 THEN ['export_block_count', 'export_receipt_hash', 'canonical_hash'] WHEN 3 THEN ['receipt_keys', 'receipt_kind', 'canonical_hash']
     WHEN 4 THEN ['receipt_time', 'canonical_hash'] WHEN 5 THEN ['integrity_keys'] WHEN 6 THEN ['slide_mismatch', 'slides_lists', 'canonical_hash'] WHEN 7 THEN ['canonical_hash'] ELSE [] END END)) AS rule_code FROM x)
SELECT CAST(item_id AS STRING) AS entity_id, rule_code FROM c WHERE rule_code IS NOT NULL""")
def _(t):
    made = receipts(t).select(F.concat(F.lit("f/"), F.col("receipt_id").cast("string")).alias("path"), "receipt_id", "raw")
    stated = F.when(F.col("receipt_id") % 13 == 0, F.lit("sha256:" + "0" * 64)).otherwise(tagged_sha(F.col("raw")))
    moves = t.sql(R_TRANSITIONS).join(made.select(F.col("receipt_id").alias("item_id"), stated.alias("receipt_sha256")), "item_id")
    return R.bind_receipt_files(moves, made.select("path", "raw"), t.sql(R_ITEMS)).select("entity_id", "rule_code")


def readback_inputs(t):
    """Export and save envelopes of all documents, six of seven tampered."""
    docs = t.documents.select("doc_id", (F.col("doc_id") % 7).alias("k"), "text", "source")
    prov = F.concat(F.lit('{"run_id":"'), F.col("doc_id").cast("string"), F.lit('","z":1,"a":{"k":2}}'))
    second = F.when(F.col("k") == 2, F.concat(F.lit(',"inner":{"ai_semantic_provenance":'), prov, F.lit("}"))).otherwise("")
    export = F.concat(
        F.lit('{"slideId":"'), F.col("doc_id").cast("string"), F.lit('","blocks":[{"id":1,"uuid":"u1","template_data_content":{"name":"top","ai_semantic_provenance":'), prov,
        F.lit('},"template_info":{"kind":"x","content":{"b":1,"a":2}}},{"id":2,"uuid":"u2","template_data_content":{"words":'), F.to_json(F.array("text")), second, F.lit('},"template_info":null}]}'))
    rows = docs.withColumn("prov", prov).withColumn("export", export)
    rows = rows.withColumn("hash", page_content_hash(R.export_blocks("export")))
    sent = F.when(F.col("k") == 1, F.replace("export", F.lit('"name":"top"'), F.lit('"name":"tip"'))).otherwise(F.col("export"))
    envelope = lambda c: F.to_json(F.struct(F.array(F.struct(F.lit("text").alias("type"), c.alias("text"))).alias("content")))
    slide = F.col("doc_id").cast("string")
    save = F.to_json(F.struct(
        F.lit("current").alias("scope"), slide.alias("slideId"), F.lit(True).alias("saved"), F.lit("current").alias("savedScope"), F.array(slide).alias("savedSlides"), F.lit(True).alias("verified"),
        F.lit("current").alias("verifiedScope"), F.array(slide).alias("verifiedSlides"), F.col("hash").alias("contentHash"), F.col("hash").alias("persistedContentHash"), (F.col("k") == 4).alias("dirty"),
        F.array().cast("array<string>").alias("warnings")))
    exports = rows.select(F.col("doc_id").alias("run_id"), F.when(F.col("k") == 6, F.lit('{"content":[]}')).otherwise(envelope(sent)).alias("envelope"))
    saves = rows.select(F.col("doc_id").alias("run_id"), envelope(save).alias("envelope"))
    wanted = rows.select(
        F.col("doc_id").alias("run_id"), F.when(F.col("k") == 3, "u9").otherwise("u1").alias("carrier_block_id"), slide.alias("target_catalog_id"),
        F.when(F.col("k") == 5, F.replace("prov", F.lit('"z":1'), F.lit('"z":2'))).otherwise(F.col("prov")).alias("provenance"))
    return exports, saves, wanted


@query("V11_validate_readback", tallied(expected("documents", "doc_id", "doc_id", 7, {
    1: ["page_hash"], 2: ["provenance_paths"], 3: ["carrier_count"], 4: ["save_dirty"], 5: ["provenance_differs"], 6: ["export_envelope"]})))
def _(t):
    return tally(R.validate_readbacks(*readback_inputs(t)))


LEDGER_ITEMS = f"""
SELECT CAST(CASE WHEN k = 9 THEN o_orderkey - 1 ELSE o_orderkey END AS STRING) AS item_id, CASE WHEN k = 1 THEN ' ' ELSE 'lock' || CAST(o_orderkey AS STRING) END AS lock_key, CASE WHEN k = 6 THEN '' ELSE 'b' || CAST(o_orderkey AS STRING) END AS target_book_id,
  CASE WHEN k = 7 THEN 'p' || CAST(o_orderkey AS STRING) WHEN k = 10 THEN 'shared' END AS prospective, CASE WHEN k = 10 THEN 'shared' ELSE 'b' || CAST(o_orderkey AS STRING) END AS stable_identity, 'whole_book' AS scope,
  CASE WHEN k = 8 THEN 'x' || CAST(o_orderkey AS STRING) END AS promoted_book_id, CASE WHEN k = 2 THEN 'odd' WHEN k IN (4, 5) THEN 'applied' ELSE 'planned' END AS state, CASE WHEN k = 3 THEN 0 ELSE 1 END AS n_history, k,
  {HEX} AS source_snapshot_hash, {HEX} AS template_snapshot_hash, {HEX} AS rule_pack_hash FROM (SELECT o_orderkey, CAST(o_orderkey % 11 AS INT) AS k FROM orders)"""


@query("V12_validate_ledger", tallied(union(
    expected("orders", "o_orderkey", "o_orderkey", 11, {1: ["lock_key"], 2: ["state"], 3: ["history_empty"], 4: ["idempotency_required", "idempotency_mismatch"], 5: ["idempotency_mismatch"], 6: ["prospective_required"],
        7: ["identity_not_prospective"], 8: ["promoted_book"]}),
    "SELECT CAST(o_orderkey - 1 AS STRING), 'item_duplicate' FROM orders WHERE o_orderkey % 11 = 9",
    "SELECT DISTINCT 'shared', 'prospective_many_locks' FROM orders WHERE o_orderkey % 11 = 10")))
def _(t):
    key = idempotency_key(F.col("source_snapshot_hash"), F.col("template_snapshot_hash"), F.col("rule_pack_hash"), F.col("stable_identity"), F.col("scope"))
    items = t.sql(LEDGER_ITEMS)
    stated = F.when(F.col("k") == 4, None).when(F.col("k") == 5, F.expr(HEX)).otherwise(key)
    return tally(T.validate_ledger(items.withColumn("idempotency_key", stated), key))


ELEMENTS = [f"m{i}" for i in range(1, 9)]


def target_tables(t):
    plans = t.sql("""SELECT o_orderkey + 1 AS position, 'Topic &amp; ' || o_orderpriority AS name, 'Read  ' || o_orderpriority || '.' AS article, o_orderkey*10 + 1 AS english_block, o_orderkey*10 + 2 AS translation_block, o_orderkey*10 + 3 AS vocabulary_block,
       o_orderkey*10 + 4 AS phonics_block, 'f' || CAST(o_orderkey AS STRING) AS audio_file, 'http://a' AS audio_url, 't1' AS pk_text, 't2' AS test_text, 'g1' AS guid FROM orders""")
    targets = t.sql("""SELECT o_orderkey + 1 AS position, o_orderkey AS page_id, CASE WHEN k = 1 THEN '999' ELSE '500' END AS book_id, CASE WHEN k = 2 THEN o_orderkey + 1 ELSE o_orderkey END AS catalog_id, 'Topic &amp; ' || o_orderpriority AS catalog_name, o_orderkey + 1 AS catalog_sort,
       k = 3 AS dirty, CASE WHEN k = 13 THEN '<p>other</p>' ELSE '<p>Topic <b>&amp;</b></p> ' || o_orderpriority END AS title_html, 'Read<br>' || o_orderpriority || ' .' AS article_html, CASE WHEN k <> 10 THEN 375 END AS spacer_width, 20 AS spacer_height, 'phone' AS spacer_type,
       CASE WHEN k = 11 THEN '#000000' ELSE '#cecece' END AS spacer_color, 0 AS spacer_elements, CASE WHEN k = 12 THEN 1 ELSE 0 END AS n_bad_width, 0 AS n_bad_type, CASE WHEN k = 14 THEN 2 ELSE 0 END AS n_other_warnings
       FROM (SELECT *, o_orderkey % 17 AS k FROM orders) WHERE k <> 15""")
    names = ["查看英文原文", "查看中文翻译", "查看重点词汇", "查看拼读内容", "美文随身听", "口语PK", "口语AI测评", "巧记单词"]
    listed = ", ".join(f"named_struct('i', {i}, 'name', '{n}')" for i, n in enumerate(names, 1))
    modules = t.sql(f"""SELECT o_orderkey AS page_id, m.i AS pos, CASE WHEN m.i = 8 AND k = 16 THEN 'mx' ELSE concat('m', m.i) END AS element_id, m.name AS name,
       CASE WHEN m.i <= 4 THEN CASE WHEN m.i = 1 AND k = 5 THEN 81 ELSE 80 END WHEN m.i = 5 THEN 77 WHEN m.i <= 7 THEN 87 ELSE 79 END AS module_type, CASE WHEN m.i <= 4 THEN o_orderkey*10 + CASE WHEN m.i = 4 AND k = 6 THEN 9 ELSE m.i END END AS resource_id,
       o_orderkey AS module_catalog_id, CASE WHEN k = 7 THEN 'zz' ELSE concat('f', o_orderkey) END AS file_id, 'http://a' AS url, CASE WHEN m.i = 6 THEN CASE WHEN k = 8 THEN 28 ELSE 27 END WHEN m.i = 7 THEN 34 END AS agent_id, CASE WHEN m.i = 6 THEN 't1' ELSE 't2' END AS text_id, CASE WHEN k = 9 THEN 'g2' ELSE 'g1' END AS guid
       FROM (SELECT o_orderkey, o_orderkey % 17 AS k, explode(array({listed})) AS m FROM orders) WHERE NOT (k = 4 AND m.i = 8)""")
    return plans, targets, modules


V13_CODES = {1: ["wrong_book"], 2: ["wrong_slide"], 3: ["dirty"], 4: ["module_count", "module_elements", "module_set", "mnemonic"], 5: ["locator_english"], 6: ["locator_phonics_resource"], 7: ["audio_file"], 8: ["oral_pk"],
             9: ["mnemonic_guid"], 10: ["spacer_missing"], 11: ["spacer"], 12: ["block_width"], 13: ["title_text"], 14: ["completeness_warning"], 15: ["position_unmatched"], 16: ["module_set", "module_forbidden"]}


@query("V13_verify_targets", tallied(expected("orders", "o_orderkey + 1", "o_orderkey", 17, V13_CODES)))
def _(t):
    return tally(T.verify_targets(*target_tables(t), "500", ELEMENTS, "mx"))


def inferences(t) -> DataFrame:
    """Stored source inferences of all customers, tampered by remainder."""
    rows = t.customer.select("c_custkey", (F.col("c_custkey") % 10).alias("k"), F.col("c_nationkey").cast("string").alias("book"), "c_mktsegment")
    cands = F.concat(F.lit('[{"candidate_id":"'), "book", F.lit('","name":"'), "c_mktsegment", F.lit('"},{"book_id":"'), F.concat("book", F.lit("x")), F.lit('","candidate_id":"'), F.concat("book", F.lit("x")), F.lit('"}]'))
    score = lambda i, e, s: F.concat(F.lit('{"candidate_id":"'), i, F.lit(f'","eligible":{e},"score":{s},"evidence":[]}}'))
    rows = rows.withColumn("c", cands).withColumn("scores", F.concat(F.lit("["), score(F.col("book"), "true", 65), F.lit(","), score(F.concat("book", F.lit("x")), "false", 0), F.lit("]")))
    text = F.concat(
        F.lit('{"kind":"legacy_inferred_source","automatic_write":false,"candidate_set_input":'), "c", F.lit(',"candidate_set_input_hash":"'), canonical_hash("c"), F.lit('","candidate_set":'), "c", F.lit(',"candidate_set_hash":"'), canonical_hash("c"),
        F.lit('","scores":'), "scores", F.lit(',"manual_confirmation":{"confirmed":true,"confirmed_by":"me","confirmed_at":"now","candidate_id":"'), "book", F.lit('","reason":"seen","evidence":[]},"selected_candidate_id":"'), "book",
        F.lit('","selected_score":65,"selected_evidence":[]}'))
    rows = rows.withColumn("clean", text)
    swap = lambda a, b: F.replace("clean", a if not isinstance(a, str) else F.lit(a), b if not isinstance(b, str) else F.lit(b))
    changed = (
        F.when(F.col("k") == 1, swap('"automatic_write":false', '"automatic_write":true'))
        .when(F.col("k") == 2, swap('"confirmed":true', '"confirmed":false'))
        .when(F.col("k") == 3, swap('"selected_score":65', '"selected_score":40'))
        .when(F.col("k") == 4, swap('"reason":"seen"', '"reason":" "'))
        .when(F.col("k") == 5, swap('"candidate_set_hash":"sha256:', '"candidate_set_hash":"sha512:'))
        .when(F.col("k") == 6, swap('"eligible":true', '"eligible":false'))
        .when(F.col("k") == 7, swap('"selected_evidence":[]', '"selected_evidence":[1]'))
        .when(F.col("k") == 8, swap('"eligible":false,"score":0', '"eligible":false,"score":1')).otherwise(F.col("clean")))
    return rows.select(F.col("c_custkey").alias("run_id"), F.when(F.col("k") == 9, "other").otherwise(F.col("book")).alias("source_book_id"), changed.alias("inference"))


@query("V14_validate_match_audit", tallied(expected("customer", "c_custkey", "c_custkey", 10, {
    1: ["automatic_write"], 2: ["unconfirmed"], 3: ["selected_score"], 4: ["confirmation_evidence"], 5: ["candidate_set_hash"], 6: ["selected_not_eligible"], 7: ["selected_evidence"], 9: ["selected_not_source"]})))
def _(t):
    return tally(P.validate_match_audit(inferences(t)))


@query("V15_manifest_completeness", f"WITH {PLAN_SQL} SELECT CAST(page_id AS STRING) AS entity_id, 'roles_missing' AS rule_code, missing AS message FROM pl WHERE missing <> ''")
def _(t):
    return E.manifest_completeness(plan(t)).select("entity_id", "rule_code", "message")


LOC = "SELECT l_orderkey AS page_id, l_orderkey*1000000 + l_suppkey*10 + l_linenumber AS element_id, l_partkey AS resource_id, CASE WHEN l_suppkey % 12 = 0 THEN 0 ELSE l_orderkey END AS catalog_id FROM lineitem"
LOC_TARGETS = "SELECT o_orderkey AS page_id, o_custkey % 50 AS source_page_id, o_custkey % 4 AS family, o_custkey % 3 AS grade FROM orders WHERE o_orderstatus <> 'P'"
LOC_BLOCKS = "SELECT p_partkey AS resource_id, p_partkey % 50 AS page_id, p_size % 4 AS family, p_size % 3 AS grade FROM part WHERE p_size <> 5"


@query("V16_page_resource_scope", tallied(cases("""(SELECT l.*, t.source_page_id, t.family AS tf, t.grade AS tg, b.page_id AS bp, b.family AS bf, b.grade AS bg FROM l LEFT JOIN t ON t.page_id = l.page_id LEFT JOIN b ON b.resource_id = l.resource_id)""",
    "CAST(page_id AS STRING) || '/' || CAST(element_id AS STRING)", [("target_unknown", "source_page_id IS NULL"), ("resource_unknown", "bp IS NULL"), ("resource_other_page", "bp <> source_page_id"), ("catalog_not_target", "catalog_id <> page_id"),
     ("family_mismatch", "bf <> tf"), ("grade_mismatch", "bg <> tg")]), f"l AS ({LOC}), t AS ({LOC_TARGETS}), b AS ({LOC_BLOCKS})"))
def _(t):
    return tally(T.page_resource_scope(t.sql(LOC), t.sql(LOC_TARGETS), t.sql(LOC_BLOCKS)))


CARRIERS = """
SELECT doc_id AS page_id, CASE WHEN doc_id % 6 = 5 THEN 'u9' ELSE 'u1' END AS recorded_carrier, '{"blocks":[{"uuid":"u1","template_data_content":{' || CASE WHEN doc_id % 6 <> 0 THEN '"ai_semantic_provenance":{"run_id":"' || source || '"}' ELSE '' END
  || '}},{"uuid":"u2","template_data_content":{' || CASE WHEN doc_id % 6 = 1 THEN '"ai_semantic_provenance":{}' ELSE '' END || '}}]}' AS raw FROM documents"""


@query("V17_carrier_audit", """
SELECT doc_id AS page_id, CASE doc_id % 6 WHEN 0 THEN 0 WHEN 1 THEN 2 ELSE 1 END AS n_carriers, CASE doc_id % 6 WHEN 0 THEN 'restore' WHEN 1 THEN 'stop' WHEN 5 THEN 'carrier_mismatch' ELSE 'ok' END AS action FROM documents""")
def _(t):
    pages = t.sql(CARRIERS).select("page_id", "recorded_carrier", F.try_parse_json("raw").alias("doc"))
    return R.carrier_audit(pages)


PRINTS = f"""
SELECT o_orderkey AS item_id, o_custkey AS ledger_id, CASE WHEN o_orderkey % 5 = 0 THEN 'x' ELSE {HEX} END AS source_snapshot_hash, {HEX} AS template_snapshot_hash, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE {HEX} END AS target_before_hash,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'sha256:' || repeat(CASE WHEN o_orderkey % 4 = 0 THEN 'a' ELSE 'b' END, 64) END AS rule_pack_hash, CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE 't' END AS resolved_template_id FROM orders"""
LEDGERS = "SELECT c_custkey AS ledger_id, 'sha256:' || repeat('b', 64) AS rule_pack_hash FROM customer"


@query("V18_validate_fingerprint", tallied(cases("orders", "o_orderkey", [("source_snapshot_hash", "o_orderkey % 5 = 0"), ("target_before_hash", "o_orderkey % 7 = 0"), ("rule_pack_differs", "o_orderkey % 3 <> 0 AND o_orderkey % 4 = 0"), ("resolved_template_id", "o_orderkey % 11 = 0")])))
def _(t):
    return tally(P.validate_fingerprints(t.sql(PRINTS), t.sql(LEDGERS)))


LOCATORS = """
SELECT l_orderkey*1000000 + l_suppkey*10 + l_linenumber AS module_id, CASE l_returnflag WHEN 'N' THEN 'page' ELSE 'block' END AS target_type, l_partkey AS resource_id, CASE WHEN l_suppkey % 6 <> 0 THEN l_partkey % 20 END AS source_book_id,
  CASE WHEN l_suppkey % 6 <> 0 THEN l_partkey % CASE WHEN l_suppkey % 5 = 0 THEN 29 ELSE 30 END END AS source_catalog_id FROM lineitem"""
SOURCE_BLOCKS = "SELECT p_partkey AS resource_id, p_partkey % CASE WHEN p_size = 9 THEN 19 ELSE 20 END AS book_id, p_partkey % 30 AS catalog_id FROM part WHERE p_size <> 4"


@query("V19_locator_resolution", tallied(cases("(SELECT l.*, b.book_id, b.catalog_id FROM l LEFT JOIN b ON b.resource_id = l.resource_id)", "module_id", [("target_not_block", "target_type = 'page'"), ("resource_only", "source_book_id IS NULL"),
    ("block_unknown", "source_book_id IS NOT NULL AND book_id IS NULL"), ("book_mismatch", "source_book_id <> book_id"), ("catalog_mismatch", "source_catalog_id <> catalog_id")]), f"l AS ({LOCATORS}), b AS ({SOURCE_BLOCKS})"))
def _(t):
    return tally(T.locator_resolution(t.sql(LOCATORS), t.sql(SOURCE_BLOCKS)))


# Ledgers of the orders of a customer.  The seal is taken of the sound ledger; fixed shares then lose their order, an item, a field or the seal itself.
def _ledger_sql(agg: str, sha: str) -> tuple[str, str]:
    item = "'{\"item_id\":\"' || CAST(o_orderkey AS STRING) || '\",\"state\":\"' || o_orderstatus || '\"}'"
    skill = "'{\"name\":\"s\",\"rule_pack_hash\":\"sha256:' || repeat('a', 64) || '\"}'"
    sealed = f"""SELECT c AS ledger, t, {sha.format(f"""'{{"created_at":"c","items":[' || j || '],"ledger_id":"L' || CAST(c AS STRING) || '","schema_version":2,"skill":' || {skill} || ',"updated_at":"u"}}'""")} AS seal
 FROM (SELECT c, c % 11 AS t, coalesce({agg}, '') AS j FROM (SELECT c_custkey AS c, o_orderkey, {item} AS item FROM customer LEFT JOIN orders ON o_custkey = c_custkey) AS o GROUP BY c) AS g"""
    heads = f"""SELECT ledger, CASE t WHEN 1 THEN '[]' WHEN 2 THEN '{{' ELSE '{{"schema_version":' || CASE t WHEN 3 THEN '1' ELSE '2' END || ',"ledger_id":"' || CASE t WHEN 4 THEN ' ' ELSE 'L' || CAST(ledger AS STRING) END
 || '","skill":' || CASE t WHEN 5 THEN '"none"' WHEN 6 THEN '{{"rule_pack_hash":"x"}}' ELSE {skill} END || ',"updated_at":"u", "created_at":"' || CASE t WHEN 7 THEN 'd' ELSE 'c' END
 || '","integrity_hash":"' || CASE t WHEN 8 THEN 'md5:' || seal ELSE 'sha256:' || seal END || '"}}' END AS head FROM ({sealed}) AS s"""
    items = f"""SELECT o_custkey AS ledger, CASE o_custkey % 11 WHEN 9 THEN -o_orderkey ELSE o_orderkey END AS position, CASE WHEN o_custkey % 11 = 10 AND o_orderkey % 4 = 0 THEN {item.replace('o_orderstatus', "'?'")} ELSE {item} END AS item
 FROM orders UNION ALL SELECT -1, 1, '{{}}'"""
    return heads, items


_HEADS, _ITEMS = _ledger_sql("string_agg(item, ',' ORDER BY o_orderkey) FILTER (WHERE o_orderkey IS NOT NULL)", "sha256({})")


@query("V12_ledger_seal", f"""
WITH h AS ({_HEADS}), i AS ({_ITEMS}), a AS (SELECT ledger, string_agg(item, ',' ORDER BY position) AS j FROM i GROUP BY 1),
v AS (SELECT coalesce(h.ledger, a.ledger) AS ledger, head, coalesce(h.ledger % 11, -1) AS t, j FROM h FULL JOIN a ON a.ledger = h.ledger),
k AS (SELECT *, t NOT IN (-1, 1, 2) AS known, CASE WHEN t NOT IN (-1, 1, 2) THEN 'sha256:' || sha256('{{"created_at":' || (head::JSON->'created_at') || ',"items":[' || coalesce(j, '') || '],"ledger_id":' || (head::JSON->'ledger_id') || ',"schema_version":'
  || (head::JSON->'schema_version') || ',"skill":' || (head::JSON->'skill') || ',"updated_at":' || (head::JSON->'updated_at') || '}}') END AS seal, CASE WHEN t NOT IN (-1, 1, 2) THEN head::JSON->>'integrity_hash' END AS said FROM v)
SELECT * FROM (SELECT CAST(ledger AS STRING) AS entity_id, unnest([CASE WHEN head IS NULL THEN 'ledger_missing' END, CASE WHEN t IN (1, 2) THEN 'ledger_not_object' END, CASE WHEN t = 3 THEN 'schema_version' END,
  CASE WHEN t = 4 THEN 'ledger_id' END, CASE WHEN t = 5 THEN 'skill_not_object' END, CASE WHEN t = 6 THEN 'rule_pack_hash' END, CASE WHEN known AND j IS NULL THEN 'items_empty' END,
  CASE WHEN t = 8 THEN 'integrity_form' END, CASE WHEN known AND t <> 8 AND said <> seal THEN 'integrity_mismatch' END]) AS rule_code FROM k) WHERE rule_code IS NOT NULL""")
def _(t):
    heads, items = _ledger_sql("listagg(item, ',') WITHIN GROUP (ORDER BY o_orderkey)", "sha2({}, 256)")
    # of customers without orders the one empty row is no item
    heads = heads.replace("listagg(item", "listagg(CASE WHEN o_orderkey IS NOT NULL THEN item END")
    return seals.validate_ledger_heads(t.sql(heads), t.sql(items)).select("entity_id", "rule_code")


# One sound pack, and what is wrong with each of the others: text to replace, what it becomes, the codes and paths that follow.
_EVIDENCE = '[{"class":"semantic","kind":"text_role","claim":"the main title of a page","observation":"large type above the list"},{"class":"structure","kind":"layout","claim":"first in its column","observation":"nothing stands above it"}]'
_SELECTOR = '{"role":"title of the lesson","cardinality":{"min":1,"max":null},"evidence":' + _EVIDENCE + '}'
_CHECK = '{"id":"kept","intent":"text stays","severity":"error","required_capabilities":["editor_read"]}'
PACK = ('{"schema_version":1,"identity":{"skill_name":"a-skill","display_name":"A skill","version":"1.0.0","status":"draft","book_family":"readers"},"applicability":{"intent":"lessons","include":{"any":[1]}},'
        '"templates":{"default":{"template_id":7,"intent":"plain","snapshot_hash":null,"anchors":[{"kind":"heading","value":"x"}]},"variants":[{"template_id":"t","intent":"two","id":"two","priority":1,"when":"two columns"}]},'
        '"defaults":{"style_policy":"none","on_missing":"stop","on_ambiguous":"skip"},"rules":[{"id":"first","order":1,"intent":"move it","when":"always","scope":{"intent":"all"},"source":' + _SELECTOR + ',"target":' + _SELECTOR.replace('"title of', '"heading of')
        + ',"action":{"type":"atomic_sequence","intent":"all at once","required_capabilities":["editor_write"],"steps":[{"type":"copy","intent":"copy it","required_capabilities":["editor_copy"]}]},"on_missing":"stop","on_ambiguous":"stop","validate":[' + _CHECK + ']}],"acceptance":['
        + _CHECK + '],"training":{"feedback":[{"id":"f1","classification":"instance_fix","summary":"one page","confirmed":true}],"examples":[{"id":"e1","kind":"positive","description":"a page","rule_ids":["first"]}]},"forward_tests":[{"id":"t1","source_label":"book","status":"pending"}]}')
_R, _T = "$.rules[0]", "$.templates"
PACK_FAULTS = [
    ("", "", []),
    ('{"schema_version":1,', '{"schema_version":2,"extra":0,', [("field_domain", "$.schema_version"), ("field_unknown", "$.extra")]),
    ('"skill_name":"a-skill","display_name":"A skill"', '"skill_name":"A_Skill","display_name":" "', [("field_domain", "$.identity.skill_name"), ("field_blank", "$.identity.display_name")]),
    ('"applicability":{"intent":"lessons","include":{"any":[1]}}', '"applicability":{"include":[],"only":1}', [("field_missing", "$.applicability.intent"), ("field_type", "$.applicability.include"), ("field_unknown", "$.applicability.only")]),
    ('"snapshot_hash":null', '"snapshot_hash":"sha256:1"', [("field_domain", f"{_T}.default.snapshot_hash")]),
    ('{"kind":"heading","value":"x"}', '{"kind":"block_id","intent":"aid"},{"kind":"source_id","value":1,"optional":true},{"kind":"Bad","value":null,"note":1}', [("field_missing", f"{_T}.default.anchors[0].value"),
        ("anchor_runtime_id", f"{_T}.default.anchors[0]"), ("anchor_id_not_optional", f"{_T}.default.anchors[0]"), ("anchor_id_without_intent", f"{_T}.default.anchors[1]"), ("field_domain", f"{_T}.default.anchors[2].kind"), ("field_unknown", f"{_T}.default.anchors[2].note")]),
    ('"variants":[{"template_id":"t","intent":"two","id":"two","priority":1,', '"variants":[{"template_id":"t","intent":"two","id":"two","priority":1.5,"when":"x"},{"template_id":true,"intent":"two","id":"two","priority":2,', [
        ("field_type", f"{_T}.variants[0].priority"), ("field_type", f"{_T}.variants[1].template_id"), ("id_duplicate", f'{_T}.variants "two"')]),
    ('"style_policy":"none","on_missing":"stop"', '"style_policy":null,"module_policy":"odd","on_missing":"later"', [("field_type", "$.defaults.style_policy"), ("field_domain", "$.defaults.module_policy"), ("field_domain", "$.defaults.on_missing")]),
    ('"role":"heading of the lesson","cardinality":{"min":1,"max":null},"evidence":' + _EVIDENCE, '"role":"heading of the lesson","cardinality":{"min":1,"max":null}', [("field_missing", f"{_R}.target.evidence")]),
    ('"heading of the lesson","cardinality":{"min":1,"max":null},"evidence":[{"class":"semantic","kind":"text_role","claim":"the main title of a page","observation":"large type above the list"}',
     '"heading of the lesson","cardinality":{"min":3,"max":2},"evidence":[{"class":"semantic","kind":"text_role","intent":"old shape","value":"old value"}', [("cardinality_order", f"{_R}.target.cardinality"),
        ("field_unknown", f"{_R}.target.evidence[0].intent"), ("field_unknown", f"{_R}.target.evidence[0].value"), ("field_missing", f"{_R}.target.evidence[0].claim"), ("field_missing", f"{_R}.target.evidence[0].observation")]),
    ('"role":"heading of the lesson"', '"role":"main slot: title-source"', [("role_id_disguise", f"{_R}.target")]),
    ('"role":"title of the lesson","cardinality":{"min":1,"max":null},"evidence":[{"class":"semantic","kind":"text_role","claim":"the main title of a page"', '"role":"title of the lesson","cardinality":{"min":-1,"max":"2"},"evidence":[{"class":"structure","kind":"element_id","claim":"match element_id abc as the title"', [
        ("claim_id_disguise", f"{_R}.source.evidence[0]"), ("evidence_kind_is_id", f"{_R}.source.evidence[0]"), ("semantic_evidence_missing", f"{_R}.source.evidence"), ("field_too_small", f"{_R}.source.cardinality.min"), ("field_type", f"{_R}.source.cardinality.max")]),
    ('"role":"title of the lesson",', '"optional_fingerprints":[{"kind":"source_id","value":"source-1","intent":"auxiliary only"}],"role":"title of the lesson",', []),
    ('"role":"title of the lesson",', '"optional_fingerprints":[{"kind":"color","value":{},"intent":""},7],"role":"title of the lesson",', [("fingerprint_kind_not_id", f"{_R}.source.optional_fingerprints[0]"),
        ("field_type", f"{_R}.source.optional_fingerprints[0].value"), ("field_blank", f"{_R}.source.optional_fingerprints[0].intent"), ("field_type", f"{_R}.source.optional_fingerprints[1]")]),
    ('"steps":[{"type":"copy"', '"style_policy":"odd","parameters":{"a":{"b":1}},"steps":[{"type":"atomic_sequence","intent":"x","required_capabilities":[]},{"type":"copy","steps":[],"tool":"x"', [("field_domain", f"{_R}.action.style_policy"),
        ("steps_missing", f"{_R}.action.steps[0]"), ("field_too_small", f"{_R}.action.steps[0].required_capabilities"), ("steps_forbidden", f"{_R}.action.steps[1]"), ("field_too_small", f"{_R}.action.steps[1].steps"), ("field_unknown", f"{_R}.action.steps[1].tool")]),
    ('"steps":[{"type":"copy","intent":"copy it","required_capabilities":["editor_copy"]}]', '"steps":' + '[{"type":"atomic_sequence","intent":"x","required_capabilities":["a"],"steps":' * 9 + '[{"type":"copy","intent":"x","required_capabilities":["a","a"]}]' + "}]" * 9, [
        ("action_depth", f"{_R}.action" + ".steps[0]" * 9), ("capability_duplicate", f"{_R}.action" + ".steps[0]" * 10 + '.required_capabilities "a"')]),
    ('"acceptance":[', '"acceptance":[{"id":"kept","intent":"again","severity":"fatal","required_capabilities":["Bad"]},', [("id_duplicate", '$.acceptance "kept"'), ("field_domain", "$.acceptance[0].severity"), ("field_domain", "$.acceptance[0].required_capabilities[0]")]),
    ('"confirmed":true', '"confirmed":"yes","resolved":true,"promoted_to_rule_ids":["first","gone"]', [("field_type", "$.training.feedback[0].confirmed"), ("feedback_resolution", "$.training.feedback[0]"), ("reference_unknown_rule", "$.training.feedback[0].promoted_to_rule_ids[1]")]),
    ('"status":"pending"', '"status":"passed"', [("forward_evidence_required", "$.forward_tests[0]")]),
    ('"status":"draft"', '"status":"validated"', [("execution_required", "$"), ("template_hash_required", f"{_T}.default"), ("template_hash_required", f"{_T}.variants[0]"), ("forward_tests_too_few", "$.forward_tests")]),
    ('"status":"draft"', '"status":"trial_approved"', [("execution_required", "$"), ("template_hash_required", f"{_T}.default"), ("template_hash_required", f"{_T}.variants[0]")]),
    ('"forward_tests":[', '"execution":{"capability_snapshot":{},"trial_approval":{"approved":true,"evidence":[]},"forward_cases":[],"more":1},"forward_tests":[', [("field_unknown", "$.execution.more"), ("approval_evidence_empty", "$.execution.trial_approval")]),
    (PACK, "[]", [("field_type", "$")]),
]


def _pack_cases() -> str:
    rows = [f"({n}, '{code}', '{path}')" for n, (_, _, faults) in enumerate(PACK_FAULTS) for code, path in faults]
    return f"c(n, rule_code, message) AS (VALUES {', '.join(rows)})"


@query("V2_pack_documents", f"WITH {_pack_cases()} SELECT CAST(doc_id AS STRING) AS entity_id, rule_code, message FROM documents JOIN c ON c.n = doc_id % {len(PACK_FAULTS)}")
def _(t):
    texts = F.array(*[F.lit(PACK.replace(old, new, 1) if old else PACK) for old, new, _ in PACK_FAULTS])
    packs = t.documents.select(F.col("doc_id").alias("pack_id"), F.parse_json(F.element_at(texts, (F.col("doc_id") % len(PACK_FAULTS) + 1).cast("int"))).alias("doc"))
    return PD.validate_pack_documents(packs).select("entity_id", "rule_code", "message")
