"""Scans, sources and sinks."""

from pyspark.sql import functions as F

from auditflow.fixtures import one_file_each
from auditflow.queries import query
from auditflow.session import work_folder
from auditflow.sources import scans as S


@query("A1_scan_json", """
WITH r AS (SELECT event_id, CASE WHEN event_id % 10 = 0 THEN substr(props, 1, length(props) - 1) ELSE props END AS raw
           FROM events)
SELECT event_id, CASE WHEN json_valid(raw) THEN CAST(json_extract_string(raw, '$.k') AS BIGINT) END AS k,
       CASE WHEN NOT json_valid(raw) THEN 'invalid_json' END AS parse_error
FROM r""")
def _(t):
    raw = t.sql("""SELECT event_id, CASE WHEN event_id % 10 = 0 THEN substr(props, 1, length(props) - 1)
                   ELSE props END AS raw FROM events""")
    return S.with_document(raw).select(
        "event_id", F.try_variant_get("doc", "$.k", "bigint").alias("k"), "parse_error")


URL = r"^https?://([^/]+)/(fr|en|de|es)/(\d+)"


@query("A2_scan_snapshots", r"""
SELECT page_id, regexp_extract(url, '^https?://([^/]+)/(fr|en|de|es)/(\d+)', 2) AS book_id,
       regexp_extract(url, '^https?://([^/]+)/(fr|en|de|es)/(\d+)', 3) AS catalog_id
FROM pages WHERE regexp_matches(url, '^https?://([^/]+)/(fr|en|de|es)/(\d+)')
 AND regexp_extract(url, '^https?://([^/]+)/(fr|en|de|es)/(\d+)', 2) = 'en'
 AND regexp_extract(url, '^https?://([^/]+)/(fr|en|de|es)/(\d+)', 3) IN (SELECT CAST(p_partkey AS STRING) FROM part)""")
def _(t):
    parts = S.name_parts(t.pages.select("page_id", "url"), F.col("url"), URL, ["host", "book_id", "catalog_id"])
    wanted = t.part.select(F.col("p_partkey").cast("string").alias("catalog_id"))
    kept = parts.where("book_id = 'en'").join(wanted, "catalog_id", "left_semi")
    return kept.select("page_id", "book_id", "catalog_id")


def text_files(t) -> str:
    """A folder with one text file per source of the documents."""
    folder = work_folder(t.spark)
    one_file_each(t.documents.select("source", "doc_id", F.col("text").alias("value"))).write.partitionBy("source").text(folder)
    return folder


FILE_OF = r"source=([^/]+)/[^/]+$"


@query("A3_file_fingerprint", """
SELECT source, CAST(sum(strlen(text) + 1) AS BIGINT) AS length, sha256(string_agg(text || chr(10), '' ORDER BY doc_id)) AS sha256 FROM documents GROUP BY source""")
def _(t):
    files = S.file_fingerprint(t.spark, text_files(t), "*.txt")
    return files.select(F.regexp_extract("path", FILE_OF, 1).alias("source"), "length", "sha256")


@query("A4_file_inventory", """
SELECT source, true AS named, CAST(sum(strlen(text) + 1) AS BIGINT) AS length, sum(strlen(text) + 1) > 73400320 AS too_large FROM documents GROUP BY source""")
def _(t):
    files = S.file_inventory(t.spark, text_files(t), "*.txt")
    return files.select(
        F.regexp_extract("path", FILE_OF, 1).alias("source"), F.col("basename").rlike(r"^part-[^/]*\.txt$").alias("named"), "length",
        (F.col("length") > S.MEDIA_LIMIT).alias("too_large"))


@query("A5_ingest_envelope_lines", """
WITH e AS (SELECT source, min(doc_id) AS last FROM documents WHERE doc_id % 97 = 96 GROUP BY source)
SELECT doc_id, CASE WHEN doc_id % 11 = 3 THEN NULL ELSE 'out/' || CAST(doc_id AS STRING) || '.json' END AS out_path,
       CASE WHEN doc_id % 11 = 3 OR doc_id % 13 = 5 THEN NULL ELSE sha256(text) END AS text_hash,
       CASE WHEN doc_id % 11 = 3 THEN 'malformed_line' WHEN doc_id % 13 = 5 THEN 'invalid_json' END AS error
FROM documents LEFT JOIN e USING (source)
WHERE (last IS NULL OR doc_id < last) AND doc_id % 17 <> 4""")
def _(t):
    lines = t.sql("""
      SELECT doc_id, source, CASE
        WHEN doc_id % 97 = 96 THEN '__END__'
        WHEN doc_id % 17 = 4 THEN '  '
        WHEN doc_id % 11 = 3 THEN 'no separator here'
        ELSE concat(base64(encode(concat('out/', doc_id, '.json'), 'UTF-8')), '\t',
                    base64(encode(CASE WHEN doc_id % 13 = 5 THEN '{"text":' ELSE to_json(named_struct('text', text)) END, 'UTF-8')))
        END AS value FROM documents""")
    rows = S.ingest_envelope_lines(lines, "source", "doc_id")
    return rows.select(
        "doc_id", "out_path", F.sha2(F.try_variant_get("doc", "$.text", "string"), 256).alias("text_hash"), "error")


ENVELOPES = """
SELECT event_id, CASE event_id % 8
  WHEN 0 THEN '{"content":[{"type":"text","text":"{\\"k\\":' || CAST(event_id AS STRING) || '}"}]}'
  WHEN 1 THEN '{"content":[{"type":"text","text":"{}"}],"more":1}'
  WHEN 2 THEN '{"content":[]}'
  WHEN 3 THEN '{"content":[{"type":"image","text":"{}"}]}'
  WHEN 4 THEN '{"content":[{"type":"text","text":"{broken"}]}'
  WHEN 5 THEN '{"content":[{"type":"text","text":"[1]"}]}'
  WHEN 6 THEN '{"content":[{"type":"text","text":7}]}'
  ELSE '{"content":[{"type":"text","text":"{}","x":1}]}' END AS env
FROM events"""


@query("A6_unwrap_envelope", """
SELECT event_id, CASE WHEN event_id % 8 = 0 THEN event_id END AS k,
  CASE event_id % 8 WHEN 0 THEN NULL WHEN 1 THEN 'envelope_keys' WHEN 2 THEN 'content_count' WHEN 3 THEN 'item_type'
    WHEN 4 THEN 'text_not_json' WHEN 5 THEN 'data_not_object' WHEN 6 THEN 'text_not_string' ELSE 'item_keys' END AS error
FROM events""")
def _(t):
    out = S.unwrap_envelope(t.sql(ENVELOPES.replace('\\"', '\\\\"')), "env")
    return out.select("event_id", F.try_variant_get("data", "$.k", "bigint").alias("k"), "error")


@query("A7_write_report", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def _(t):
    path = work_folder(t.spark)
    S.write_report(t.events.groupBy("event_type").agg(F.count("*").alias("n")), path)
    return t.spark.read.schema("event_type STRING, n BIGINT").json(path)


@query("A8_load_overrides", """
SELECT CAST(doc_id AS STRING) AS catalog_id, 2 + quality AS n_sentences, 'label ' || CAST(doc_id AS STRING) AS evidence,
       CASE WHEN toxic = 1 THEN 'override_schema' END AS error FROM labels""")
def _(t):
    raw = t.sql("""SELECT concat('{"schema_version":', 1 + toxic, ',"catalogs":{"', doc_id, '":{"sentences":["a","b"',
       CASE WHEN quality = 1 THEN ',"c"' ELSE '' END, '],"sentence_evidence":"label ', doc_id, '"}}}') AS raw FROM labels""")
    return S.load_overrides(raw).select(
        "catalog_id", F.size("sentences").alias("n_sentences"), F.col("sentence_evidence").alias("evidence"), "error")


@query("A9_manifest_union", """
SELECT page_id AS sort, url AS path, page_id % 5 <> 0 AS loaded,
       CASE WHEN page_id % 5 <> 0 THEN strlen(html) END AS n_bytes FROM pages""")
def _(t):
    index = t.pages.select(F.col("page_id").alias("sort"), F.col("url").alias("path"))
    docs = t.pages.where("page_id % 5 <> 0").select(F.col("page_id").alias("sort"), F.col("url").alias("path"), F.col("html").alias("doc"))
    # one url may belong to several pages
    return S.manifest_union(index, docs, "sort", "path").select(
        "sort", "path", "loaded", F.octet_length("doc").cast("bigint").alias("n_bytes"))
