"""JSON documents against a compiled schema: one small table, joined to the nodes of all documents at once.

A schema is a nested description made with ``text``, ``integer``, ``boolean``, ``items``,
``record`` and ``anything``.  Compiled, it is one row per path pattern, where list
places read ``[]`` and a list inside a list of the same name folds into one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditflow.operators.tree import json_nodes
from auditflow.session import checkpointed


@dataclass(frozen=True)
class Shape:
    kind: str = "any"  # any, text, label (text or number), integer, boolean, object, array
    required: bool = True
    nullable: bool = False
    like: str | None = None
    among: tuple[str, ...] | None = None
    least: int | None = None
    fields: tuple[tuple[str, Shape], ...] | None = None
    element: Shape | None = None


def optional(shape: Shape) -> Shape:
    return replace(shape, required=False)


def text(like: str | None = None, among: Sequence[str] | None = None, **options) -> Shape:
    """A text that is not blank, of a pattern or a domain."""
    return Shape("text", like=like, among=tuple(among) if among else None, **options)


def integer(least: int | None = None, among: Sequence[str] | None = None, **options) -> Shape:
    return Shape("integer", least=least, among=tuple(among) if among else None, **options)


def boolean() -> Shape:
    return Shape("boolean")


def items(element: Shape, least: int = 0, **options) -> Shape:
    return Shape("array", element=element, least=least, **options)


def record(**fields: Shape) -> Shape:
    """An object with these fields and no others."""
    return Shape("object", fields=tuple(fields.items()))


FOLDED = ("steps",)
COMPILED = ("pattern string, kind string, nullable boolean, pattern_like string, among array<string>, least int, "
            "allowed array<string>, required array<string>")


def _rows(shape: Shape, pattern: str, deep: int = 0) -> Iterator[tuple]:
    fields = dict(shape.fields) if shape.fields is not None else None
    yield (pattern, shape.kind, shape.nullable, shape.like, list(shape.among) if shape.among else None, shape.least,
           sorted(fields) if fields is not None else None, [k for k, f in fields.items() if f.required] if fields is not None else None)
    for name, field in (fields or {}).items():
        if name in FOLDED:
            if deep > 1:
                continue
            field = replace(field, element=replace(shape, required=True))
        yield from _rows(field, f"{pattern}.{name}", deep + (name in FOLDED))
    if shape.element is not None:
        yield from _rows(shape.element, f"{pattern}[]", deep)


def compile_schema(spark: SparkSession, shape: Shape) -> DataFrame:
    """The schema as a table; its size is that of the description, whatever the documents are."""
    rows = {row[0]: row for row in _rows(shape, "$")}
    return spark.createDataFrame(list(rows.values()), COMPILED)


def pattern_of(path: Column) -> Column:
    """A path with list places as ``[]`` and steps inside of steps as one."""
    plain = F.regexp_replace(path, r"\[\d+\]", "[]")
    for name in FOLDED:
        plain = F.regexp_replace(plain, rf"(\.{name}\[\])+", f".{name}[]")
    return plain


def document_nodes(df: DataFrame, doc: str) -> DataFrame:
    """All values of VARIANT documents, the root included, with ``path`` and ``pattern``."""
    keep = [c for c in df.columns if c != doc]
    root = df.select(*keep, F.lit("$").alias("path"), F.col(doc).alias("value"))
    below = checkpointed(json_nodes(df, doc).select(*keep, "path", "value"))
    return root.union(below).withColumn("pattern", pattern_of(F.col("path")))


def schema_faults(nodes: DataFrame, schema: DataFrame, keep: list[str]) -> DataFrame:
    """``keep, rule_code, message`` of nodes that break the schema; the message is the path at fault.

    Nodes without a row are below something open or below an unknown field, which is
    named where it occurs.
    """
    # each reading of a value is made once, and only where its row of the schema asks for it
    shape = F.coalesce(F.schema_of_variant("value"), F.lit("VOID"))
    rows = nodes.join(F.broadcast(schema), "pattern").withColumn("_is", shape)
    listing = F.col("_is").startswith("OBJECT") & F.col("allowed").isNotNull()
    rows = rows.select(
        *keep, "path", "kind", "nullable", "pattern_like", "among", "least", "allowed", "required", "_is", listing.alias("_listing"),
        F.when(F.col("kind").isin("text", "integer"), F.try_variant_get("value", "$", "string")).alias("_said"),
        F.when(F.col("kind") == "integer", F.try_variant_get("value", "$", "double")).alias("_number"),
        F.when(F.col("kind") == "array", F.size(F.try_variant_get("value", "$", "array<variant>"))).alias("_count"),
        F.when(listing, F.map_keys(F.try_variant_get("value", "$", "map<string,variant>"))).alias("_keys"))
    kind, said, number, count = F.col("_is"), F.col("_said"), F.col("_number"), F.col("_count")
    keys = F.coalesce("_keys", F.array().cast("array<string>"))
    numeric = kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
    whole = numeric & (number == F.floor(number))
    want = F.col("kind")
    is_null = kind == "VOID"
    fits = (F.when(want == "any", True).when(want == "text", kind == "STRING").when(want == "label", (kind == "STRING") | numeric)
            .when(want == "integer", whole).when(want == "boolean", kind == "BOOLEAN")
            .when(want == "object", kind.startswith("OBJECT")).otherwise(kind.startswith("ARRAY")))
    fits = F.coalesce(fits, F.lit(False)) | (is_null & F.col("nullable"))
    blank = fits & (want == "text") & ~is_null & (F.trim(F.coalesce(said, F.lit(""))) == "")
    off = (F.when(F.col("among").isNotNull(), ~F.array_contains("among", said)).when(F.col("pattern_like").isNotNull(), ~F.regexp_like(said, F.col("pattern_like")))
           .otherwise(F.lit(False)))
    domain = fits & ~blank & ~is_null & (want.isin("text", "integer")) & off
    small = fits & ~is_null & F.when(want == "array", count < F.col("least")).when(want == "integer", number < F.col("least")).otherwise(F.lit(False))
    here = F.col("path")
    one = lambda failed, code: F.when(F.coalesce(failed, F.lit(False)), F.array(F.struct(F.lit(code).alias("rule_code"), here.alias("message"))))

    def each(values: Column, code: str) -> Column:
        listed = F.transform(values, lambda k: F.struct(F.lit(code).alias("rule_code"), F.concat(here, F.lit("."), k).alias("message")))
        return F.when(F.col("_listing"), listed)

    none = F.array().cast("array<struct<rule_code:string,message:string>>")
    found = [one(~fits, "field_type"), one(blank, "field_blank"), one(domain, "field_domain"), one(small, "field_too_small"),
             each(F.array_except(keys, "allowed"), "field_unknown"), each(F.array_except("required", keys), "field_missing")]
    return rows.select(*keep, F.explode(F.flatten(F.array(*[F.coalesce(f, none) for f in found]))).alias("_f")).select(*keep, "_f.*")
