"""Rule packs: structure, selectors, actions, maturity, acceptance reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditflow.operators import checks as K
from auditflow.operators.checks import DOMAINS, explode_rules
from auditflow.operators.tree import flatten_tree

# Domains of a rule pack.
STATUSES = ["draft", "trial_approved", "validated", "deprecated"]
STYLE = ["preserve_target", "copy_source_rich_text", "hybrid", "none"]
MODULE = ["reuse_model_relation", "clone_if_supported", "none"]
ON_MISSING = ["stop", "needs_review", "skip", "keep_target"]
ON_AMBIGUOUS = ["stop", "needs_review", "skip"]
FEEDBACK = ["instance_fix", "rule_refinement", "new_variant", "acceptance_refinement"]
MAX_DEPTH = 8


def _blank(c: str) -> Column:
    return F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) == ""


def _not_in(c: str, values: list[str]) -> Column:
    return ~F.coalesce(F.col(c).isin(values), F.lit(False))


def _not_like(c: str, domain: str) -> Column:
    return ~F.coalesce(F.col(c).rlike(DOMAINS[domain]), F.lit(False))


def _repeats(df: DataFrame, keys: list[str], code: str, message: Column) -> DataFrame:
    rows = df.groupBy("pack_id", *keys).agg(F.count("*").alias("n")).where("n > 1")
    return K.violations(rows, "pack_id", code, message)


def validate_rule_packs(
    packs: DataFrame, rules: DataFrame, variants: DataFrame, checks: DataFrame, feedback: DataFrame, references: DataFrame
) -> DataFrame:
    """Violations per pack; messages name the part at fault.

    ``checks`` with a null rule_id are acceptance checks; ``references`` are
    (pack_id, owner, rule_id) from feedback and examples.
    """
    rule_counts = rules.groupBy("pack_id").agg(F.count("*").alias("n_rules"))
    accept = checks.where("rule_id IS NULL").groupBy("pack_id").agg(F.count("*").alias("n_accept"))
    p = packs.join(rule_counts, "pack_id", "left").join(accept, "pack_id", "left").withColumn("entity_id", F.col("pack_id"))
    found = explode_rules(p, [
        ("schema_version", "error", ~F.col("schema_version").eqNullSafe(F.lit(1))),
        ("skill_name", "error", _not_like("skill_name", "skill_name")),
        ("display_name", "error", _blank("display_name")),
        ("version", "error", _not_like("version", "semver")),
        ("status", "error", _not_in("status", STATUSES)),
        ("book_family", "error", _blank("book_family")),
        ("style_policy", "error", _not_in("style_policy", STYLE)),
        ("module_policy", "error", F.col("module_policy").isNotNull() & _not_in("module_policy", MODULE)),
        ("on_missing", "error", _not_in("on_missing", ON_MISSING)),
        ("on_ambiguous", "error", _not_in("on_ambiguous", ON_AMBIGUOUS)),
        ("rules_empty", "error", F.col("n_rules").isNull()),
        ("acceptance_empty", "error", F.col("n_accept").isNull()),
    ])
    per_rule = checks.where("rule_id IS NOT NULL").groupBy("pack_id", "rule_id").agg(F.count("*").alias("n_checks"))
    r = rules.join(per_rule, ["pack_id", "rule_id"], "left").withColumn("entity_id", F.col("pack_id"))
    name = F.concat(F.lit("rule "), F.coalesce("rule_id", F.lit("?")))
    found = found.unionByName(explode_rules(r, [
        ("rule_id", "error", _not_like("rule_id", "pack_id"), name),
        ("rule_order", "error", F.col("rule_order").isNull(), name),
        ("rule_intent", "error", _blank("intent"), name),
        ("rule_when", "error", _blank("when_text"), name),
        ("rule_on_missing", "error", _not_in("on_missing", ON_MISSING), name),
        ("rule_on_ambiguous", "error", _not_in("on_ambiguous", ON_AMBIGUOUS), name),
        ("rule_checks_empty", "error", F.col("n_checks").isNull(), name),
    ]))
    c = checks.withColumn("entity_id", F.col("pack_id"))
    check = F.concat(F.lit("check "), F.coalesce("check_id", F.lit("?")))
    found = found.unionByName(explode_rules(c, [
        ("check_id", "error", _not_like("check_id", "pack_id"), check),
        ("check_intent", "error", _blank("intent"), check),
        ("check_severity", "error", _not_in("severity", ["error", "warning"]), check),
    ]))
    f = feedback.withColumn("entity_id", F.col("pack_id"))
    note = F.concat(F.lit("feedback "), F.coalesce("feedback_id", F.lit("?")))
    found = found.unionByName(explode_rules(f, [
        ("feedback_classification", "error", _not_in("classification", FEEDBACK), note),
        ("feedback_summary", "error", _blank("summary"), note),
        ("feedback_confirmed", "error", F.col("confirmed").isNull(), note),
        ("feedback_resolution", "error", F.coalesce("resolved", F.lit(False)) & _blank("resolution"), note),
    ]))
    text = lambda label, c: F.concat(F.lit(f"{label} "), F.col(c).cast("string"))
    found = found.unionByName(_repeats(rules, ["rule_id"], "rule_id_duplicate", text("rule", "rule_id")))
    found = found.unionByName(_repeats(rules.where("rule_order IS NOT NULL"), ["rule_order"], "rule_order_duplicate", text("order", "rule_order")))
    found = found.unionByName(_repeats(variants, ["variant_id"], "variant_id_duplicate", text("variant", "variant_id")))
    found = found.unionByName(_repeats(variants, ["priority"], "variant_priority_duplicate", text("priority", "priority")))
    found = found.unionByName(_repeats(checks, ["rule_id", "check_id"], "check_id_duplicate", text("check", "check_id")))
    found = found.unionByName(_repeats(feedback, ["feedback_id"], "feedback_id_duplicate", text("feedback", "feedback_id")))
    unknown = references.join(rules.select("pack_id", "rule_id").distinct(), ["pack_id", "rule_id"], "left_anti")
    return found.unionByName(K.violations(unknown, "pack_id", "reference_unknown_rule", F.concat_ws(" ", "owner", "rule_id")))


def validate_selectors(selectors: DataFrame, evidence: DataFrame) -> DataFrame:
    """Selectors need semantic and structure evidence that is no identifier in disguise."""
    seen = evidence.groupBy("selector_id").agg(
        F.count("*").alias("n_evidence"), F.count(F.when(F.col("class") == "semantic", 1)).alias("n_semantic"),
        F.count(F.when(F.col("class") == "structure", 1)).alias("n_structure"))
    s = selectors.join(seen, "selector_id", "left").withColumn("entity_id", F.col("selector_id"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    fake = lambda c: ~_blank(c) & (K.is_id_disguise(c) | K.is_identifier_only(c))
    found = explode_rules(s, [
        ("role_required", "error", _blank("role")),
        ("role_id_disguise", "error", fake("role")),
        ("cardinality_min", "error", ~F.coalesce(F.col("card_min") >= 0, F.lit(False))),
        ("cardinality_max", "error", F.col("card_max") < 0),
        ("cardinality_order", "error", F.col("card_max") < F.col("card_min")),
        ("evidence_too_few", "error", zero("n_evidence") < 2),
        ("semantic_evidence_missing", "error", (zero("n_evidence") >= 2) & (zero("n_semantic") == 0)),
        ("structure_evidence_missing", "error", (zero("n_evidence") >= 2) & (zero("n_structure") == 0)),
    ])
    kind_bad = _not_like("kind", "anchor_kind")
    e = evidence.withColumn("entity_id", F.col("selector_id"))
    return found.unionByName(explode_rules(e, [
        ("evidence_class", "error", _not_in("class", ["semantic", "structure"])),
        ("evidence_kind", "error", kind_bad),
        ("evidence_kind_is_id", "error", ~kind_bad & (K.is_id_kind("kind") | K.is_id_disguise("kind"))),
        ("claim_required", "error", _blank("claim")), ("claim_id_disguise", "error", fake("claim")),
        ("observation_required", "error", _blank("observation")), ("observation_id_disguise", "error", fake("observation")),
    ]))


def flatten_actions(rules: DataFrame, keys: list[str], action: str = "action") -> DataFrame:
    """Steps of each rule's action with depth; only an atomic sequence has steps."""
    wrapped = rules.withColumn("_root", F.try_parse_json(F.concat(F.lit("["), F.to_json(action), F.lit("]")))).select(*keys, "_root")
    nodes = flatten_tree(wrapped, "_root", child="steps", name="type", levels=MAX_DEPTH + 2)
    nodes = nodes.where(F.forall("parent_names", lambda n: n == "atomic_sequence"))
    get = lambda p, t: F.try_variant_get("node", p, t)
    return nodes.select(
        *keys, F.array_join(F.col("path").cast("array<string>"), ".").alias("path"), (F.col("depth") - 1).alias("depth"),
        get("$.type", "string").alias("type"), get("$.intent", "string").alias("intent"),
        get("$.style_policy", "string").alias("style_policy"), get("$.module_policy", "string").alias("module_policy"),
        get("$.required_capabilities", "array<string>").alias("capabilities"),
        F.size(get("$.steps", "array<variant>")).alias("n_steps"), get("$.steps", "variant").isNotNull().alias("has_steps"))


def action_violations(steps: DataFrame, entity: Column) -> DataFrame:
    sequence = F.col("type") == "atomic_sequence"
    deep = F.col("depth") > MAX_DEPTH
    return explode_rules(steps.withColumn("entity_id", entity), [
        ("action_depth", "error", deep), ("action_type", "error", ~deep & _blank("type")), ("action_intent", "error", ~deep & _blank("intent")),
        ("style_policy", "error", ~deep & F.col("style_policy").isNotNull() & _not_in("style_policy", STYLE)),
        ("module_policy", "error", ~deep & F.col("module_policy").isNotNull() & _not_in("module_policy", MODULE)),
        ("steps_missing", "error", ~deep & sequence & ~F.coalesce(F.col("n_steps") > 0, F.lit(False))),
        ("steps_forbidden", "error", ~deep & ~F.coalesce(sequence, F.lit(False)) & F.col("has_steps")),
    ])


def needed_capabilities(steps: DataFrame, checks: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct capabilities of actions and checks per pack."""
    a = steps.where(F.col("depth") <= MAX_DEPTH).select(*keys, F.explode("capabilities").alias("capability"))
    return a.unionByName(checks.select(*keys, F.explode("capabilities").alias("capability"))).distinct()


def maturity_gate(
    packs: DataFrame, templates: DataFrame, needed: DataFrame, available: DataFrame, cases: DataFrame,
    acceptance: DataFrame, results: DataFrame, feedback: DataFrame
) -> DataFrame:
    """What keeps a pack from its declared status.

    Trial and validated packs need hashes, approval and capabilities; validated
    ones also two independent passed forward cases, all acceptance results and
    closed feedback.
    """
    executable = packs.where(F.col("status").isin("trial_approved", "validated"))
    validated = packs.where(F.col("status") == "validated").select("pack_id")
    ids = executable.select("pack_id")
    bad_hash = templates.join(ids, "pack_id", "left_semi").where(_not_like("snapshot_hash", "sha256"))
    found = K.violations(bad_hash, "pack_id", "template_hash", F.col("template").cast("string"))
    found = found.unionByName(K.violations(
        executable.where(~F.coalesce(F.col("approved"), F.lit(False))), "pack_id", "approval_missing"))
    lacking = needed.join(ids, "pack_id", "left_semi").join(available, ["pack_id", "capability"], "left_anti")
    found = found.unionByName(K.violations(lacking, "pack_id", "capability_unavailable", F.col("capability")))
    passed = cases.where("status = 'passed'").join(validated, "pack_id", "left_semi")
    counts = validated.join(passed.groupBy("pack_id").agg(F.count("*").alias("n")), "pack_id", "left")
    found = found.unionByName(K.violations(counts.where("coalesce(n, 0) < 2"), "pack_id", "forward_tests_too_few"))
    dimensions = ("artifact", "source_id", "source_hash", "target_id", "target_hash")
    stacked = ", ".join(f"'forward_{d}_repeated', CAST({d} AS STRING)" for d in dimensions)
    values = passed.select("pack_id", F.expr(f"stack({len(dimensions)}, {stacked})").alias("rule_code", "message"))
    again = values.groupBy("pack_id", "rule_code", "message").agg(F.count("*").alias("n")).where("n > 1")
    found = found.unionByName(again.select(F.col("pack_id").cast("string").alias("entity_id"), "rule_code", F.lit("error").alias("severity"), "message"))
    required = passed.select("pack_id", "case_id").join(acceptance, "pack_id")
    state = results.groupBy("pack_id", "case_id", "check_id").agg(F.max("status").alias("result"))
    judged = required.join(state, ["pack_id", "case_id", "check_id"], "left")
    where = F.concat_ws("/", F.col("case_id").cast("string"), F.col("check_id"))
    found = found.unionByName(K.violations(judged.where("result IS NULL"), "pack_id", "acceptance_missing", where))
    found = found.unionByName(K.violations(judged.where("result <> 'passed'"), "pack_id", "acceptance_not_passed", where))
    stray = state.join(passed.select("pack_id", "case_id"), ["pack_id", "case_id"], "left_semi").join(
        acceptance, ["pack_id", "check_id"], "left_anti")
    found = found.unionByName(K.violations(stray, "pack_id", "acceptance_unknown", where))
    open_notes = feedback.join(validated, "pack_id", "left_semi").where(
        ~F.coalesce(F.col("confirmed") & F.col("resolved"), F.lit(False)))
    return found.unionByName(K.violations(open_notes, "pack_id", "feedback_open", F.col("feedback_id").cast("string")))


def validate_acceptance_reports(reports: DataFrame, checks: DataFrame, evidence: DataFrame, files: DataFrame) -> DataFrame:
    """Reports bind their case, every check is passed, evidence files match their hash."""
    counts = checks.groupBy("report_id").agg(F.count("*").alias("n_checks"))
    r = reports.join(counts, "report_id", "left").withColumn("entity_id", F.col("report_id"))
    found = explode_rules(r, [
        ("schema_version", "error", ~F.col("schema_version").eqNullSafe(F.lit(1))),
        ("case_binding", "error", ~F.col("case_id").eqNullSafe(F.col("expected_case_id"))),
        ("status_not_passed", "error", ~F.col("status").eqNullSafe(F.lit("passed"))),
        ("checks_empty", "error", F.col("n_checks").isNull()),
    ])
    shown = evidence.groupBy("report_id", "check_id").agg(F.count("*").alias("n_evidence"))
    c = checks.join(shown, ["report_id", "check_id"], "left").withColumn("entity_id", F.col("report_id"))
    found = found.unionByName(explode_rules(c, [
        ("check_not_passed", "error", ~F.col("status").eqNullSafe(F.lit("passed")), F.col("check_id")),
        ("check_evidence_empty", "error", F.col("n_evidence").isNull(), F.col("check_id")),
    ]))
    twice = checks.groupBy("report_id", "check_id").agg(F.count("*").alias("n")).where("n > 1")
    found = found.unionByName(K.violations(twice, "report_id", "check_duplicate", F.col("check_id")))
    e = evidence.join(files.select("path", "sha256"), F.col("artifact") == F.col("path"), "left").withColumn("entity_id", F.col("report_id"))
    return found.unionByName(explode_rules(e, [
        ("artifact_missing", "error", F.col("sha256").isNull(), F.col("artifact")),
        ("artifact_sha_mismatch", "error", F.col("sha256") != F.col("artifact_sha256"), F.col("artifact")),
    ]))
