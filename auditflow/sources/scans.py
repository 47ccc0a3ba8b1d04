"""Readers for captures, media, envelopes and overrides, and the report writer."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SNAPSHOT_NAME = r"^(\d+)-(\d+)-([a-f0-9]{64})\.json$"
END_MARKER = "__END__"
# Fixed value: largest media file, 70 MiB.
MEDIA_LIMIT = 70 * 1024 * 1024
OVERRIDES = """schema_version INT, catalogs MAP<STRING, STRUCT<
  sentences: ARRAY<STRING>, sentence_evidence: STRING,
  words_english: ARRAY<STRING>, words_chinese: ARRAY<STRING>, word_pairing_evidence: STRING,
  accept_relevant_warnings: ARRAY<STRUCT<code: STRING, target_element_id: STRING, reason: STRING>>>>"""


def with_document(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Parse a text column; bad texts keep their row and get an error."""
    doc = F.try_parse_json(F.col(raw))
    return df.withColumn("doc", doc).withColumn(
        "parse_error", F.when(F.col("doc").isNull(), F.lit("invalid_json"))
    )


def scan_json(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """One row per JSON file: path, raw text, parsed document, error."""
    text = spark.read.option("pathGlobFilter", glob).text(path, wholetext=True)
    rows = text.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("raw"))
    return with_document(rows)


def name_parts(df: DataFrame, name: Column, pattern: str, fields: list[str]) -> DataFrame:
    """Keep rows whose name matches and add its groups as columns."""
    kept = df.where(name.rlike(pattern))
    return kept.withColumns({f: F.regexp_extract(name, pattern, i + 1) for i, f in enumerate(fields)})


def scan_snapshots(
    spark: SparkSession, path: str, book_id: str | None = None, catalogs: DataFrame | None = None
) -> DataFrame:
    """Page captures of a book; names are filtered before any file is parsed."""
    text = spark.read.option("pathGlobFilter", "*-*-*.json").text(path, wholetext=True)
    named = text.select(
        F.col("value").alias("raw"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_modification_time").alias("mtime"),
    )
    parts = name_parts(named, F.col("file_name"), SNAPSHOT_NAME, ["book_id", "catalog_id", "file_hash"])
    if book_id is not None:
        parts = parts.where(F.col("book_id") == str(book_id))
    if catalogs is not None:
        parts = parts.join(catalogs.select(F.col("catalog_id").cast("string")), "catalog_id", "left_semi")
    parsed = with_document(parts)
    stamp = F.try_variant_get("doc", "$.meta.capturedAt", "string").try_cast("timestamp")
    return parsed.withColumn("captured_at", F.coalesce(stamp, F.col("mtime")))


def file_fingerprint(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    return files.load(path).select(
        "path", "length", F.col("modificationTime").alias("mtime"), F.sha2("content", 256).alias("sha256")
    )


def file_inventory(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Names and sizes; file contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    return files.load(path).select("path", F.regexp_extract("path", r"[^/]+$", 0).alias("basename"), "length")


def decode_envelope_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """``<base64 path> TAB <base64 json>`` lines; blank lines and the marker are left out."""
    tab = F.locate("\t", F.col(line))
    rows = lines.where((F.trim(F.col(line)) != "") & (F.col(line) != END_MARKER)).withColumn("_tab", tab)
    head = F.when(F.col("_tab") >= 2, F.expr(f"substring({line}, 1, _tab - 1)"))
    tail = F.when(F.col("_tab") >= 2, F.expr(f"substring({line}, _tab + 1)"))
    decoded = rows.withColumns({
        "out_path": F.try_to_binary(head, F.lit("base64")).cast("string"),
        "raw": F.try_to_binary(tail, F.lit("base64")).cast("string"),
    }).drop("_tab")
    error = F.when(F.col("out_path").isNull() | F.col("raw").isNull(), "malformed_line").when(
        F.col("doc").isNull(), "invalid_json")
    return decoded.withColumn("doc", F.try_parse_json("raw")).withColumn("error", error)


def ingest_envelope_lines(lines: DataFrame, file: str, pos: str, line: str = "value") -> DataFrame:
    """Envelope lines of each file up to its end marker."""
    ends = lines.where(F.col(line) == END_MARKER).groupBy(F.col(file).alias("_f")).agg(F.min(pos).alias("_end"))
    kept = lines.join(ends, F.col(file).eqNullSafe(F.col("_f")), "left").where(
        F.col("_end").isNull() | (F.col(pos) < F.col("_end")))
    return decode_envelope_lines(kept.drop("_f", "_end"), line)


def unwrap_envelope(df: DataFrame, column: str) -> DataFrame:
    """Payload of a tool envelope in ``data``, or the reason it is refused in ``error``."""
    doc = F.try_parse_json(F.col(column))
    keys = F.json_object_keys(column)
    items = F.try_variant_get("_env", "$.content", "array<variant>")
    item = F.try_variant_get("_env", "$.content[0]", "variant")
    text_kind = F.schema_of_variant(F.try_variant_get("_env", "$.content[0].text", "variant"))
    out = df.withColumn("_env", doc).withColumn(
        "_data", F.try_parse_json(F.try_variant_get("_env", "$.content[0].text", "string")))
    yes = lambda c: F.coalesce(c, F.lit(False))
    error = (
        F.when(~yes(keys == F.array(F.lit("content"))), "envelope_keys")
        .when(~yes(F.size(items) == 1), "content_count")
        .when(~yes(F.array_sort(F.json_object_keys(F.to_json(item))) == F.array(F.lit("text"), F.lit("type"))), "item_keys")
        .when(~yes(F.try_variant_get("_env", "$.content[0].type", "string") == "text"), "item_type")
        .when(~yes(text_kind == "STRING"), "text_not_string")
        .when(F.col("_data").isNull(), "text_not_json")
        .when(~F.schema_of_variant("_data").startswith("OBJECT"), "data_not_object")
    )
    return out.withColumn("error", error).withColumn(
        "data", F.when(F.col("error").isNull(), F.col("_data"))).drop("_env", "_data")


def load_overrides(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Override records per catalog; a wrong schema version is an error row."""
    parsed = df.select(F.from_json(raw, OVERRIDES).alias("o"))
    bad = ~F.coalesce((F.col("o.schema_version") == 1) & F.col("o.catalogs").isNotNull(), F.lit(False))
    rows = parsed.withColumn("error", F.when(bad, "override_schema"))
    exploded = rows.select("error", F.explode_outer("o.catalogs").alias("catalog_id", "v"))
    return exploded.select("catalog_id", "v.*", "error")


def read_overrides(spark: SparkSession, path: str) -> DataFrame:
    return load_overrides(spark.read.text(path, wholetext=True).withColumnRenamed("value", "raw"))


def manifest_union(index: DataFrame, documents: DataFrame, *keys: str) -> DataFrame:
    """Documents that an index lists, with the index columns; ``loaded`` tells whether there is one.

    ``keys``, by default the path, must name one document; where paths repeat, they need a
    further column.  Null is a key like any other.
    """
    keys = keys or ("path",)
    found = documents.withColumns({f"_{k}": F.col(k) for k in keys} | {"loaded": F.lit(True)}).drop(*keys)
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return index.join(found, same, "left").drop(*[f"_{k}" for k in keys]).withColumn("loaded", F.coalesce("loaded", F.lit(False)))


def write_report(df: DataFrame, path: str, fmt: str = "json") -> None:
    df.write.mode("overwrite").format(fmt).save(path)
