"""Predicates and small checks.  A check yields violation rows and never throws."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Text domains.
DOMAINS = {
    "sha256": r"^sha256:[a-f0-9]{64}$",
    "fnv1a32": r"^fnv1a32:[a-f0-9]{8}$",
    "semver": r"^\d+\.\d+\.\d+$",
    "skill_name": r"^(?=.{1,63}$)[a-z0-9]+(?:-[a-z0-9]+)*$",
    "pack_id": r"^[a-z0-9][a-z0-9_-]*$",
    "capability": r"^[a-z][a-z0-9_.:-]*$",
    "anchor_kind": r"^[a-z][a-z0-9_-]*$",
    "entity_kind": r"^[a-z][a-z0-9_-]*$",
    "iso_utc": r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{3})?Z$",
}
# Words that give away a runtime identifier.
SPOOF = r"(?i)(^|[^a-z0-9])(?:slot|slot_id|element_id|block_id|node_id|source_id|template_id|runtime_id|identifier)(?:[^a-z0-9]|$)"
SPOOF_ZH = r"(?i)(?:插槽|槽位|元素\s*ID|区块\s*ID|节点\s*ID|运行时\s*ID)"
# Texts that are nothing but an identifier.
IDENTIFIER_ONLY = [
    r"^\d+$",
    r"(?i)^[a-f0-9]{8}-[a-f0-9-]{27,}$",
    r"(?i)^[a-z][a-z0-9_.:-]*$",
    r"(?:插槽|槽位)",
    r"(?i)^(?:slot|element|block|source|template|node|id)[\s:_#-]*[a-z0-9_.:-]+$",
    r"(?i)^(?:插槽|槽位|元素|区块)[\s:_#-]*[a-z0-9_.:-]+$",
]
# Kinds that name an identifier.
ID_KIND = [
    r"(^|_)(?:id|ids)(?:_|$)",
    r"(?:source|template|element|block|slot|node)_?(?:id|key|name)$",
    r"^(?:slot|slot_name|source_id|template_source_id)$",
]
VIOLATION = ["entity_id", "rule_code", "severity", "message"]


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def failed_rules(rules: list[tuple]) -> Column:
    """List of the rules that fail, as structs of rule_code, severity and message.

    A rule is ``(code, severity, failed)`` or ``(code, severity, failed, message)``;
    an unknown outcome counts as not failed.
    """
    none = F.array().cast("array<struct<rule_code:string,severity:string,message:string>>")
    entries = []
    for rule in rules:
        code, severity, failed = rule[:3]
        message = rule[3] if len(rule) > 3 else F.lit(code.replace("_", " "))
        entry = F.struct(F.lit(code).alias("rule_code"), F.lit(severity).alias("severity"), message.cast("string").alias("message"))
        entries.append(F.when(F.coalesce(failed, F.lit(False)), F.array(entry)).otherwise(none))
    # not filtered: a lambda would have every rule interpreted row by row, and parts that rules share computed once for each
    return F.concat(*entries)


def explode_rules(df: DataFrame, rules: list[tuple], entity: str = "entity_id") -> DataFrame:
    """One violation row per row and failed rule, in a single pass; rules as in ``failed_rules``."""
    rows = df.select(F.col(entity).cast("string").alias("entity_id"), failed_rules(rules).alias("_failed"))
    # the outer form, since a plain explode of a column has the optimizer judge every rule once more in a filter on its size
    return rows.select("entity_id", F.explode_outer("_failed").alias("_r")).where("_r IS NOT NULL").select("entity_id", "_r.*")


def violations(df: DataFrame, entity: Column | str, code: str, message: Column | None = None, severity: str = "error") -> DataFrame:
    return df.select(
        _col(entity).cast("string").alias("entity_id"), F.lit(code).alias("rule_code"),
        F.lit(severity).alias("severity"), (message if message is not None else F.lit(code.replace("_", " "))).alias("message"))


def valid_entities(entities: DataFrame, found: DataFrame, key: str = "entity_id") -> DataFrame:
    """An entity is valid iff no error row names it."""
    errors = found.where("severity = 'error'").select(F.col("entity_id").alias("_e")).distinct()
    return entities.join(errors.withColumn("_bad", F.lit(True)), F.col(key).cast("string") == F.col("_e"), "left").withColumn(
        "valid", F.col("_bad").isNull()).drop("_e", "_bad")


def require_one(df: DataFrame, keys: list[str], predicate: Column, label: str) -> DataFrame:
    """Groups in which the predicate does not hold for exactly one row."""
    counted = df.groupBy(*keys).agg(F.count(F.when(predicate, 1)).alias("n"))
    entity = F.concat_ws("/", *[F.col(k).cast("string") for k in keys])
    message = F.concat(F.lit(f"{label}: expected 1 match, got "), F.col("n").cast("string"))
    return violations(counted.where("n <> 1"), entity, "expected_one", message)


def check_pattern(df: DataFrame, entity: str, column: str, domain: str) -> DataFrame:
    good = F.coalesce(F.col(column).rlike(DOMAINS[domain]), F.lit(False))
    return violations(df.where(~good), entity, f"{domain}_pattern", F.coalesce(F.col(column), F.lit("")))


def check_enum(df: DataFrame, entity: str, column: str, domain: DataFrame, value: str = "value") -> DataFrame:
    known = domain.select(F.col(value).alias("_v")).distinct()
    return violations(df.join(known, F.col(column) == F.col("_v"), "left_anti"), entity, f"{column}_invalid",
                      F.coalesce(F.col(column), F.lit("")))


def check_required(df: DataFrame, entity: str, when: Column, column: str) -> DataFrame:
    """``column`` must be non-blank wherever ``when`` holds."""
    blank = F.trim(F.coalesce(F.col(column).cast("string"), F.lit(""))) == ""
    return violations(df.where(when & blank), entity, f"{column}_required")


def is_id_disguise(text: Column | str) -> Column:
    c = _col(text)
    return F.coalesce(c.rlike(SPOOF) | c.rlike(SPOOF_ZH), F.lit(False))


def is_id_kind(kind: Column | str) -> Column:
    c = _col(kind)
    out = F.lit(False)
    for pattern in ID_KIND:
        out = out | c.rlike(pattern)
    return F.coalesce(out, F.lit(False))


def is_identifier_only(text: Column | str) -> Column:
    c = F.trim(F.coalesce(_col(text), F.lit("")))
    out = c == ""
    for pattern in IDENTIFIER_ONLY:
        out = out | c.rlike(pattern)
    return out


def id_disguise(df: DataFrame, entity: str, columns: list[str]) -> DataFrame:
    """Texts that present an identifier as evidence."""
    return explode_rules(df.withColumn("entity_id", F.col(entity).cast("string")), [
        (f"{c}_id_disguise", "error", is_id_disguise(c) | is_identifier_only(c)) for c in columns])


def key_violations(df: DataFrame, entity: str, column: str, required: list[str], allowed: list[str]) -> DataFrame:
    """Unknown and missing keys of a JSON object column."""
    keys = F.coalesce(F.json_object_keys(column), F.array().cast("array<string>"))
    lit = lambda values: F.array(*[F.lit(v) for v in values]).cast("array<string>")
    unknown = F.array_except(keys, lit(sorted({*required, *allowed})))
    missing = F.array_except(lit(required), keys)
    base = df.select(F.col(entity).alias("_id"), unknown.alias("_u"), missing.alias("_m"))
    rows = base.select("_id", F.explode(F.concat(
        F.transform("_u", lambda k: F.struct(F.lit("unknown_key").alias("code"), k.alias("key"))),
        F.transform("_m", lambda k: F.struct(F.lit("missing_key").alias("code"), k.alias("key"))))).alias("_r"))
    return rows.select(
        F.col("_id").cast("string").alias("entity_id"), F.col("_r.code").alias("rule_code"),
        F.lit("error").alias("severity"), F.col("_r.key").alias("message"))
