"""Whole rule packs as JSON documents: structure by a compiled schema, then the rules between fields."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditflow.operators.checks import DOMAINS, failed_rules, is_id_disguise, is_id_kind, is_identifier_only
from auditflow.operators.rulepacks import FEEDBACK, MAX_DEPTH, MODULE, ON_AMBIGUOUS, ON_MISSING, STATUSES, STYLE
from auditflow.operators.schema import Shape, boolean, compile_schema, document_nodes, integer, items, optional, record, schema_faults, text
from auditflow.session import checkpointed

PACK_ID, ANCHOR = DOMAINS["pack_id"], DOMAINS["anchor_kind"]
# Kinds of anchors that only exist while an editor runs.
RUNTIME_ANCHORS = ["element_id", "runtime_element_id", "block_id", "runtime_block_id", "slot_id"]

_OPEN = Shape("object", required=False)
_HASH = text(DOMAINS["sha256"], required=False, nullable=True)
_APPLIES = record(intent=text(), include=_OPEN, exclude=_OPEN)
_CAPABILITIES = items(text(DOMAINS["capability"]), least=1)
_CHECK = record(id=text(PACK_ID), intent=text(), severity=text(among=["error", "warning"]), required_capabilities=_CAPABILITIES)
_ANCHORS = items(record(kind=text(ANCHOR), value=Shape(), optional=optional(boolean()), intent=optional(text())), required=False)
_TEMPLATE = {"template_id": Shape("label"), "intent": text(), "snapshot_hash": _HASH, "anchors": _ANCHORS}
_SELECTOR = record(
    role=text(), cardinality=record(min=integer(0), max=integer(0, nullable=True)),
    evidence=items(record(**{"class": text(among=["semantic", "structure"]), "kind": text(ANCHOR), "claim": text(), "observation": text()}), least=2),
    optional_fingerprints=items(record(kind=text(ANCHOR), value=Shape("label"), intent=text()), required=False),
    include=optional(text()), exclude=optional(text()))
_ACTION = record(
    type=text(), intent=text(), required_capabilities=_CAPABILITIES, content_policy=optional(text()), style_policy=text(among=STYLE, required=False),
    module_policy=text(among=MODULE, required=False), selection_policy=optional(text()), layout_policy=optional(text()), parameters=_OPEN,
    steps=items(Shape(), least=1, required=False))
_RULE = record(
    id=text(PACK_ID), order=integer(), intent=text(), when=text(), scope=_APPLIES, source=_SELECTOR, target=_SELECTOR, action=_ACTION,
    on_missing=text(among=ON_MISSING), on_ambiguous=text(among=ON_AMBIGUOUS), validate=items(_CHECK, least=1))
_EXECUTION = record(
    capability_snapshot=Shape("object"), trial_approval=record(approved=boolean(), evidence=items(text())), forward_cases=items(Shape("object")))
RULE_PACK = record(
    schema_version=integer(among=["1"]),
    identity=record(skill_name=text(DOMAINS["skill_name"]), display_name=text(), version=text(DOMAINS["semver"]), status=text(among=STATUSES), book_family=text()),
    applicability=_APPLIES,
    templates=record(default=record(**_TEMPLATE), variants=items(record(**_TEMPLATE, id=text(PACK_ID), priority=integer(), when=text()))),
    defaults=record(style_policy=text(among=STYLE), module_policy=text(among=MODULE, required=False), on_missing=text(among=ON_MISSING), on_ambiguous=text(among=ON_AMBIGUOUS)),
    rules=items(_RULE, least=1), acceptance=items(_CHECK, least=1),
    training=record(
        feedback=items(record(
            id=text(PACK_ID), classification=text(among=FEEDBACK), summary=text(), confirmed=boolean(), resolved=optional(boolean()),
            resolution=optional(text()), promoted_to_rule_ids=items(Shape(), required=False))),
        examples=items(record(id=text(PACK_ID), kind=text(among=["positive", "negative"]), description=text(), rule_ids=items(text(), required=False)))),
    forward_tests=items(record(
        id=text(PACK_ID), source_label=text(), status=text(among=["pending", "passed", "failed", "needs_review"]), evidence_artifact=optional(text()))),
    execution=optional(_EXECUTION))
SELECTORS = ["$.rules[].source", "$.rules[].target"]
ACTIONS = ["$.rules[].action", "$.rules[].action.steps[]"]
TEMPLATES = ["$.templates.default", "$.templates.variants[]"]
#: Lists whose members must differ in a field: pattern of the member, field, depth of the list that it is unique in.
UNIQUE = [("$.rules[]", "id"), ("$.rules[]", "order"), ("$.templates.variants[]", "id"), ("$.templates.variants[]", "priority"), ("$.rules[].validate[]", "id"),
          ("$.acceptance[]", "id"), ("$.training.feedback[]", "id"), ("$.training.examples[]", "id"), ("$.forward_tests[]", "id")]


def _get(name: str, kind: str = "string") -> Column:
    return F.try_variant_get("value", f"$.{name}", kind)


def _has(name: str) -> Column:
    return F.coalesce(F.array_contains(F.map_keys(F.try_variant_get("value", "$", "map<string,variant>")), name), F.lit(False))


def _text(name: str) -> Column:
    return F.when(F.schema_of_variant(_get(name, "variant")) == "STRING", _get(name))


def _fake(value: Column) -> Column:
    return (F.trim(value) != "") & (is_id_disguise(value) | is_identifier_only(value))


def validate_pack_documents(packs: DataFrame, pack_id: str = "pack_id", doc: str = "doc") -> DataFrame:
    """Violations of rule packs given as VARIANT documents: ``entity_id, rule_code, severity, message``.

    Structure comes from ``RULE_PACK``: unknown and missing fields, kinds, blanks,
    domains and lists that are too short, anywhere in the pack.  Between fields: both
    classes of evidence, identifiers in disguise, fingerprints and anchors, cardinality,
    steps of sequences, repeated names, references to rules, resolved feedback, passed
    forward tests, hashes and approval of executable packs.  A document that is no
    object breaks ``field_type`` at ``$``; a null document has no nodes but its root.
    """
    nodes = checkpointed(document_nodes(packs.select(F.col(pack_id).alias("pack"), F.col(doc).alias("doc")), "doc"))
    found = [schema_faults(nodes, compile_schema(packs.sparkSession, RULE_PACK), ["pack"])]

    # no two groups share a pattern, so a node is judged by the rules of its own group and by no others
    checks: list[tuple[list[str], list[tuple]]] = []

    def rules(patterns: list[str], failing: list[tuple[str, Column]]) -> None:
        checks.append((patterns, [(code, "error", failed, F.col("path")) for code, failed in failing]))

    low, high = _get("min", "double"), _get("max", "double")
    rules([f"{s}.cardinality" for s in SELECTORS], [("cardinality_order", (high < low) & (high == F.floor(high)) & (low == F.floor(low)))])
    rules(SELECTORS, [("role_id_disguise", _fake(_text("role")))])
    classes = F.transform(F.try_variant_get("value", "$", "array<variant>"), lambda e: F.coalesce(F.try_variant_get(e, "$.class", "string"), F.lit("")))
    enough = F.size(classes) >= 2
    rules([f"{s}.evidence" for s in SELECTORS], [(f"{c}_evidence_missing", enough & ~F.array_contains(classes, c)) for c in ("semantic", "structure")])
    kind = _text("kind")
    formed = kind.rlike(ANCHOR)
    rules([f"{s}.evidence[]" for s in SELECTORS], [
        ("evidence_kind_is_id", formed & (is_id_kind(kind) | is_id_disguise(kind))),
        ("claim_id_disguise", _fake(_text("claim"))), ("observation_id_disguise", _fake(_text("observation")))])
    rules([f"{s}.optional_fingerprints[]" for s in SELECTORS], [("fingerprint_kind_not_id", formed & ~is_id_kind(kind))])
    rules([f"{t}.anchors[]" for t in TEMPLATES], [
        ("anchor_runtime_id", kind.isin(RUNTIME_ANCHORS)), ("anchor_id_not_optional", is_id_kind(kind) & ~F.coalesce(_get("optional", "boolean"), F.lit(False))),
        ("anchor_id_without_intent", is_id_kind(kind) & ~_has("intent"))])
    sequence = _text("type").eqNullSafe(F.lit("atomic_sequence"))
    depth = F.regexp_count("path", F.lit(r"\.steps\[\d+\]"))
    rules(ACTIONS, [("action_depth", depth == MAX_DEPTH + 1), ("steps_missing", sequence & ~_has("steps")), ("steps_forbidden", ~sequence & _has("steps"))])
    rules(["$.training.feedback[]"], [("feedback_resolution", _get("resolved", "boolean") & ~_has("resolution"))])
    rules(["$.forward_tests[]"], [("forward_evidence_required", (_text("status") == "passed") & ~_has("evidence_artifact"))])
    # what an executable pack needs
    executable = F.try_variant_get("value", "$.identity.status", "string").isin("trial_approved", "validated")
    approved = F.coalesce(F.try_variant_get("value", "$.execution.trial_approval.approved", "boolean"), F.lit(False))
    rules(["$"], [("execution_required", executable & ~_has("execution")), ("approval_required", executable & _has("execution") & ~approved)])
    rules(["$.execution.trial_approval"], [("approval_evidence_empty", _get("approved", "boolean") & (F.size(_get("evidence", "array<variant>")) == 0))])
    judged = [(F.col("pattern").isin(patterns), failed_rules(failing)) for patterns, failing in checks]
    broken = reduce(lambda done, group: done.when(*group), judged[1:], F.when(*judged[0]))
    ruled = nodes.where(F.col("pattern").isin([p for patterns, _ in checks for p in patterns]))
    found.append(ruled.select("pack", F.explode(broken).alias("_r")).select("pack", "_r.rule_code", "_r.message"))
    status = nodes.where("pattern = '$.identity.status'").select("pack", F.try_variant_get("value", "$", "string").alias("status"))
    unhashed = nodes.where(F.col("pattern").isin(TEMPLATES) & (~_has("snapshot_hash") | (F.coalesce(F.schema_of_variant(_get("snapshot_hash", "variant")), F.lit("VOID")) == "VOID")))
    unhashed = unhashed.join(status.where("status IN ('trial_approved', 'validated')"), "pack", "left_semi")
    found.append(unhashed.select("pack", F.lit("template_hash_required").alias("rule_code"), F.col("path").alias("message")))
    passed = nodes.where((F.col("pattern") == "$.forward_tests[]") & (_text("status") == "passed")).groupBy("pack").agg(F.count("*").alias("n"))
    few = status.where("status = 'validated'").join(passed, "pack", "left").where("coalesce(n, 0) < 2")
    found.append(few.select("pack", F.lit("forward_tests_too_few").alias("rule_code"), F.lit("$.forward_tests").alias("message")))
    # names that repeat within their list
    fields = F.filter(F.array(*[F.when(F.col("pattern") == p, F.struct(F.lit(f).alias("field"), F.to_json(_get(f, "variant")).alias("name"))) for p, f in UNIQUE]),
                      lambda u: u["name"].isNotNull())
    members = nodes.where(F.col("pattern").isin([p for p, _ in UNIQUE])).select("pack", F.regexp_replace("path", r"\[\d+\]$", "").alias("list"), F.explode(fields).alias("u"))
    twice = members.groupBy("pack", "list", "u").agg(F.count("*").alias("n")).where("n > 1")
    found.append(twice.select("pack", F.concat("u.field", F.lit("_duplicate")).alias("rule_code"), F.concat_ws(" ", "list", "u.name").alias("message")))
    listed = [f"{p}.required_capabilities" for p in (*ACTIONS, "$.rules[].validate[]", "$.acceptance[]")]
    names = nodes.where(F.col("pattern").isin([f"{p}[]" for p in listed])).select("pack", F.regexp_replace("path", r"\[\d+\]$", "").alias("list"), F.to_json("value").alias("name"))
    found.append(names.groupBy("pack", "list", "name").agg(F.count("*").alias("n")).where("n > 1").select(
        "pack", F.lit("capability_duplicate").alias("rule_code"), F.concat_ws(" ", "list", "name").alias("message")))
    # rules that feedback and examples name
    known = nodes.where("pattern = '$.rules[].id'").select("pack", F.try_variant_get("value", "$", "string").alias("name")).distinct()
    named = nodes.where(F.col("pattern").isin("$.training.feedback[].promoted_to_rule_ids[]", "$.training.examples[].rule_ids[]")).select(
        "pack", "path", F.try_variant_get("value", "$", "string").alias("name"))
    found.append(named.join(known, ["pack", "name"], "left_anti").select("pack", F.lit("reference_unknown_rule").alias("rule_code"), F.col("path").alias("message")))
    every = reduce(DataFrame.union, [f.select(F.col("pack").cast("string").alias("entity_id"), "rule_code", "message") for f in found])
    return every.select("entity_id", "rule_code", F.lit("error").alias("severity"), "message")
