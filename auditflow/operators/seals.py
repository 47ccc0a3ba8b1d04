"""Sealed ledgers: one hash over a head and the items that follow it, spread over many rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditflow.functions.canon import canonical_json
from auditflow.operators.checks import explode_rules
from auditflow.operators.digest import streamed_digest

# Version of a ledger and the shape of its hashes.
LEDGER_VERSION = "2"
SHA = r"^sha256:[a-f0-9]{64}$"
SEAL = "integrity_hash"


def _quoted(text: Column) -> Column:
    """A text as JSON."""
    listed = F.to_json(F.array(text))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def ledger_seals(heads: DataFrame, items: DataFrame) -> DataFrame:
    """``(ledger, seal)``: hash of the canonical JSON of each ledger without its own seal.

    ``heads (ledger, head)`` holds the JSON of a ledger without its items,
    ``items (ledger, position, item)`` the JSON of each item.  Canonical JSON sorts the
    keys of a ledger, so its items are a list in the middle: every other entry and every
    item is one row, and a streamed digest reads them in order.  No ledger is put
    together anywhere, however many items it has.
    """
    entry = F.explode(F.map_entries(F.from_json("head", "map<string,variant>"))).alias("e")
    entries = heads.select("ledger", entry).select("ledger", F.col("e.key").alias("key"), F.col("e.value").alias("value"))
    entries = entries.where(~F.col("key").isin(SEAL, "items")).select(
        "ledger", "key", F.lit(None).cast("long").alias("position"), F.concat(_quoted(F.col("key")), F.lit(":"), F.to_json("value")).alias("text"))
    bounds = items.groupBy("ledger").agg(F.min("position").alias("low"), F.max("position").alias("high"))
    about = heads.select("ledger").join(bounds, "ledger", "left")
    listed = items.select("ledger", "position", canonical_json("item").alias("json")).join(about, "ledger")
    begins, ends = F.col("position") == F.col("low"), F.col("position") == F.col("high")
    listed = listed.select("ledger", F.lit("items").alias("key"), F.col("position").cast("long").alias("position"), F.concat(
        F.when(begins, '"items":[').otherwise(""), F.coalesce("json", F.lit("null")), F.when(ends, "]").otherwise("")).alias("text"))
    bare = about.where("low IS NULL").select("ledger", F.lit("items").alias("key"), F.lit(None).cast("long").alias("position"), F.lit('"items":[]').alias("text"))
    opening, closing = [heads.select("ledger", F.lit(key).alias("key"), F.lit(None).cast("long").alias("position"), F.lit(text).alias("text"))
                        for key, text in (("", "{"), ("\U0010ffff", "}"))]
    # the separator goes before every text but the first two and the last one
    every = entries.union(listed).union(bare)
    first = every.groupBy("ledger").agg(F.min(F.struct("key", F.coalesce("position", F.lit(-1).cast("long")).alias("at"))).alias("first"))
    is_first = (F.col("key") == F.col("first.key")) & (F.coalesce("position", F.lit(-1).cast("long")) == F.col("first.at"))
    parted = every.join(first, "ledger").select("ledger", "key", "position", F.when(is_first, F.col("text")).otherwise(F.concat(F.lit(","), "text")).alias("text"))
    told = streamed_digest(opening.union(parted).union(closing), ["ledger"], ["key", "position"], "text")
    return told.select("ledger", F.concat(F.lit("sha256:"), "sha256").alias("seal"))


def validate_ledger_heads(heads: DataFrame, items: DataFrame) -> DataFrame:
    """Violations of the heads and seals of ledgers, as columns ``entity_id, rule_code, severity, message``.

    A head that is no JSON object, a missing list of items and a ledger without one are
    violations too; items whose ledger has no head are named by ``ledger_missing``.
    """
    get = lambda k: F.try_variant_get("doc", f"$.{k}", "string")
    docs = heads.withColumn("doc", F.try_parse_json("head"))
    counts = items.groupBy("ledger").agg(F.count("*").alias("n"))
    sound = docs.where("try_variant_get(doc, '$', 'map<string,variant>') IS NOT NULL")
    seals = ledger_seals(sound.select("ledger", "head"), items)
    rows = docs.join(counts, "ledger", "full").join(seals, "ledger", "left")
    rows = rows.withColumn("entity_id", F.col("ledger").cast("string"))
    object_ = F.try_variant_get("doc", "$", "map<string,variant>").isNotNull()
    known = F.col("head").isNotNull() & F.coalesce(object_, F.lit(False))
    skill = F.try_variant_get("doc", "$.skill", "map<string,variant>").isNotNull()
    formed = F.coalesce(get(SEAL).rlike(SHA), F.lit(False))
    return explode_rules(rows, [
        ("ledger_missing", "error", F.col("head").isNull()),
        ("ledger_not_object", "error", F.col("head").isNotNull() & ~known),
        ("schema_version", "error", known & ~get("schema_version").eqNullSafe(F.lit(LEDGER_VERSION))),
        ("ledger_id", "error", known & (F.trim(F.coalesce(get("ledger_id"), F.lit(""))) == "")),
        ("skill_not_object", "error", known & ~skill),
        ("rule_pack_hash", "error", known & skill & ~F.coalesce(get("skill.rule_pack_hash").rlike(SHA), F.lit(False))),
        ("items_empty", "error", known & F.col("n").isNull()),
        ("integrity_form", "error", known & ~formed),
        ("integrity_mismatch", "error", known & formed & ~get(SEAL).eqNullSafe(F.col("seal"))),
    ])
