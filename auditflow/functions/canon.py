"""Canonical JSON, hashes and stable identities as column expressions.

Keys sort as text at every level; numbers that look like keys are not special.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHA_PATTERN = r"^sha256:[a-f0-9]{64}$"
FNV_PATTERN = r"^fnv1a32:[a-f0-9]{8}$"
FINGERPRINT_FIELDS = [
    "source_snapshot_hash", "template_snapshot_hash", "rule_pack_hash",
    "target_before_hash", "resolved_template_id",
]


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def canonical_json(text: Column | str) -> Column:
    return F.to_json(F.try_parse_json(_col(text)))


def tagged_sha(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text, 256))


def canonical_hash(text: Column | str) -> Column:
    return tagged_sha(canonical_json(text))


def text_of_part(fields: Column | str, without: str) -> Column:
    """Canonical text of a document without one field, from its fields as ``map<string,variant>``.

    Fields come in key order at every level; the second reading gives numbers that were
    written with an exponent the form of all others.
    """
    return canonical_json(F.to_json(F.map_filter(_col(fields), lambda key, _: key != without)))


def record_json(*columns: Column | str) -> Column:
    """The record as JSON text, null fields included."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def set_print(hashes: Column) -> Column:
    """Print of a set of tagged hashes in any order: all 256 bits in eight sums, as hex digits.

    An aggregate with partial sums; repeated hashes count as often as they occur.
    """
    digits = F.substring_index(hashes, ":", -1)
    part = lambda i: F.conv(F.substring(digits, 8 * i + 1, 8), 16, 10).cast("bigint")
    return F.concat(*[F.lpad(F.lower(F.hex(F.coalesce(F.sum(part(i)), F.lit(0)))), 16, "0") for i in range(8)])


def struct_hash(*columns: Column | str) -> Column:
    """Canonical hash of a record made of columns; null is a value like any other."""
    return canonical_hash(record_json(*columns))


def fnv1a32(text: Column | str) -> Column:
    """FNV-1a over UTF-16 code units."""
    points = F.transform(F.regexp_extract_all(_col(text), F.lit("(?s)."), F.lit(0)), F.ascii)

    def mix(h: Column, unit: Column) -> Column:
        return (h.bitwiseXOR(unit) * F.lit(16777619)).bitwiseAND(F.lit(0xFFFFFFFF))

    def step(h: Column, point: Column) -> Column:
        p = point.cast("bigint")
        rest = p - 0x10000
        high = F.lit(0xD800) + F.shiftright(rest, 10)
        low = F.lit(0xDC00) + rest.bitwiseAND(F.lit(0x3FF))
        return F.when(p < 0x10000, mix(h, p)).otherwise(mix(mix(h, high), low))

    value = F.aggregate(points, F.lit(2166136261).cast("bigint"), step)
    return F.concat(F.lit("fnv1a32:"), F.lpad(F.lower(F.hex(value)), 8, "0"))


def ordered_hash(*columns: Column | str) -> Column:
    """Canonical hash of a record whose columns are given in key order at every level.

    Such a record is canonical as it is written, so it is not parsed again.
    """
    return tagged_sha(record_json(*columns))


@F.pandas_udf(T.StringType())
def fnv1a32_long(texts: pd.Series) -> pd.Series:
    """The same hash for long texts: one position of all texts of a batch at a time.

    Rows are ordered by length, so finished texts cost nothing more.
    """
    out = pd.Series([None] * len(texts), index=texts.index, dtype=object)
    known = texts.dropna()
    units = [np.frombuffer(t.encode("utf-16-le", "surrogatepass"), dtype="<u2") for t in known]
    order = sorted(range(len(units)), key=lambda i: -len(units[i]))
    sizes = np.array([len(units[i]) for i in order], dtype=np.int64)
    flat = np.concatenate([units[i] for i in order]).astype(np.uint64) if units else np.array([], dtype=np.uint64)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if units else sizes
    value = np.full(len(units), 2166136261, dtype=np.uint64)
    active = len(units)
    for position in range(int(sizes[0]) if units else 0):
        while sizes[active - 1] <= position:
            active -= 1
        step = (value[:active] ^ flat[starts[:active] + position]) * np.uint64(16777619)
        value[:active] = step & np.uint64(0xFFFFFFFF)
    hashed = [""] * len(units)
    for rank, i in enumerate(order):
        hashed[i] = f"fnv1a32:{int(value[rank]):08x}"
    out.loc[known.index] = hashed
    return out


def json_string(text: Column | str) -> Column:
    """A text as a JSON string literal."""
    listed = F.to_json(F.array(_col(text)))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def page_content_hash(blocks: Column | str) -> Column:
    """Hash of a page from its stored block texts.

    ``blocks`` is an array of structs with ``rest`` (JSON of the plain fields),
    ``data`` (template data), ``info`` (plain fields of the template info or null)
    and ``info_content``.  ``data`` and ``info_content`` become JSON strings, so
    they must be the original texts in their own key order.
    """
    def fields(text: Column, without: str) -> Column:
        kept = F.map_filter(F.try_parse_json(text).cast("map<string,variant>"), lambda k, _: k != without)
        inner = F.to_json(kept)
        return F.when(inner == "{}", F.lit("")).otherwise(
            F.concat(F.substring(inner, F.lit(2), F.length(inner) - 2), F.lit(",")))

    def shaped(block: Column, index: Column) -> Column:
        info = F.when(block["info"].isNull(), F.lit("null")).otherwise(F.concat(
            F.lit("{"), fields(block["info"], "content"), F.lit('"content":'), json_string(block["info_content"]), F.lit("}")))
        return F.concat(
            F.lit("{"), fields(block["rest"], "sort"), F.lit('"sort":'), (index + 1).cast("string"),
            F.lit(',"template_data_content":'), json_string(block["data"]), F.lit(',"template_info":'), info, F.lit("}"))

    listed = F.concat(F.lit("["), F.array_join(F.transform(_col(blocks), shaped), ","), F.lit("]"))
    return fnv1a32_long(canonical_json(listed))


def capability_hash(capabilities: Column | str, catalog_hash: Column | str) -> Column:
    return struct_hash(
        F.array_sort(_col(capabilities)).alias("capabilities"), _col(catalog_hash).alias("catalog_hash")
    )


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(F.trim(_col(c)), F.lit(""))


def lock_key(lock: Column | str, book: Column | str) -> Column:
    return F.coalesce(blank_to_null(lock), blank_to_null(book))


def stable_identity(explicit: Column | str, prospective: Column | str, book: Column | str, lock: Column | str) -> Column:
    return F.coalesce(blank_to_null(explicit), blank_to_null(prospective), blank_to_null(book), blank_to_null(lock))


def catalog_scope(catalog_id: Column | str, catalog_path: Column | str) -> Column:
    by_id, by_path = blank_to_null(catalog_id), blank_to_null(catalog_path)
    kind = F.when(by_id.isNotNull(), "catalog_id").when(by_path.isNotNull(), "catalog_path").otherwise("book_scope")
    return F.struct(kind.alias("kind"), F.coalesce(by_id, by_path, F.lit("whole_book")).alias("value"))


def idempotency_key(source: Column, template: Column, rule_pack: Column, identity: Column, scope: Column) -> Column:
    """Hash of the logical work; item id and target state stay out of it."""
    return struct_hash(
        F.lit(1).alias("schema_version"),
        source.alias("source_snapshot_hash"),
        template.alias("template_snapshot_hash"),
        rule_pack.alias("rule_pack_hash"),
        F.struct(identity.alias("book_stable_identity"), scope.alias("catalog_scope")).alias("target"),
    )


def fingerprint_diff(expected: str, current: str, fields: list[str] | None = None) -> Column:
    """Changed fields with both values, from two struct columns."""
    entries = [
        F.struct(
            F.lit(f).alias("field"),
            F.col(expected)[f].cast("string").alias("expected"),
            F.col(current)[f].cast("string").alias("current"),
        )
        for f in fields or FINGERPRINT_FIELDS
    ]
    return F.filter(F.array(*entries), lambda e: ~e["expected"].eqNullSafe(e["current"]))


def fingerprint_table(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Canonical text and both hashes of a record per key."""
    text = canonical_json(record_json(*columns))
    out = df.select(key, text.alias("canonical"))
    return out.withColumns({"sha256": tagged_sha(F.col("canonical")), "fnv": fnv1a32("canonical")})


def seal(df: DataFrame, columns: list[str], field: str) -> DataFrame:
    """Add the canonical hash of the named columns as ``field``."""
    return df.withColumn(field, struct_hash(*columns))
