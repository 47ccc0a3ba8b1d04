"""Scalar functions: canonical JSON, hashes, identities, layout."""

from pyspark.sql import functions as F

from auditflow.functions import canon as H
from auditflow.functions import layout as Y
from auditflow.queries import query


def duck_fnv(text: str) -> str:
    units = f"list_transform(string_split({text}, ''), lambda c: CAST(unicode(c) AS UBIGINT))"
    return (f"'fnv1a32:' || format('{{:08x}}', list_reduce(list_prepend(CAST(2166136261 AS UBIGINT), {units}), "
            "lambda h, c: (xor(h, c) * CAST(16777619 AS UBIGINT)) % CAST(4294967296 AS UBIGINT)))")


SHUFFLED = """
SELECT o_orderkey, '{"z":' || CAST(o_custkey AS STRING) || ', "a":{"y":"' || o_orderstatus || '","b":[3,1,{"d":null,"c":true}]}, "é":"' || o_orderpriority || '"}' AS raw FROM orders"""
CANON = """'{"a":{"b":[3,1,{"c":true,"d":null}],"y":"' || o_orderstatus || '"},"z":' || CAST(o_custkey AS STRING) || ',"é":"' || o_orderpriority || '"}'"""


@query("H1_canonical_json", f"SELECT o_orderkey, {CANON} AS canonical FROM orders")
def _(t):
    return t.sql(SHUFFLED).select("o_orderkey", H.canonical_json("raw").alias("canonical"))


@query("H2_canonical_hash", f"SELECT o_orderkey, 'sha256:' || sha256({CANON}) AS hash FROM orders")
def _(t):
    return t.sql(SHUFFLED).select("o_orderkey", H.canonical_hash("raw").alias("hash"))


@query("H3_fnv1a32", f"SELECT event_id, {duck_fnv('props')} AS fnv FROM events")
def _(t):
    return t.events.select("event_id", H.fnv1a32("props").alias("fnv"))


@query("H3_fingerprint_table", f"""
WITH c AS (SELECT c_custkey, '{{"c_mktsegment":"' || c_mktsegment || '","c_name":"' || c_name || '"}}' AS canonical FROM customer)
SELECT c_custkey, canonical, 'sha256:' || sha256(canonical) AS sha256, {duck_fnv('canonical')} AS fnv FROM c""")
def _(t):
    return H.fingerprint_table(t.customer, "c_custkey", ["c_name", "c_mktsegment"])


@query("H4_page_content_hash", f"""
WITH p AS (SELECT p_partkey, '[{{"id":' || CAST(p_partkey AS STRING) || ',"sort":1,"template_data_content":"{{\\\\"z\\\\":1,\\\\"name\\\\":\\\\"' || p_name || '\\\\"}}","template_info":null}},{{"id":0,"sort":2,"template_data_content":"{{}}","template_info":{{"content":"{{\\\\"b\\\\":2,\\\\"a\\\\":1}}","kind":"' || p_type || '"}}}}]' AS txt FROM part)
SELECT p_partkey, {duck_fnv('txt')} AS page_hash FROM p""".replace("\\\\", "\\"))
def _(t):
    blocks = t.part.select("p_partkey", F.array(
        F.struct(F.concat(F.lit('{"sort":9,"id":'), F.col("p_partkey").cast("string"), F.lit("}")).alias("rest"),
                 F.concat(F.lit('{"z":1,"name":"'), "p_name", F.lit('"}')).alias("data"),
                 F.lit(None).cast("string").alias("info"), F.lit(None).cast("string").alias("info_content")),
        F.struct(F.lit('{"id":0}').alias("rest"), F.lit("{}").alias("data"),
                 F.concat(F.lit('{"kind":"'), "p_type", F.lit('"}')).alias("info"), F.lit('{"b":2,"a":1}').alias("info_content"))).alias("blocks"))
    return blocks.select("p_partkey", H.page_content_hash("blocks").alias("page_hash"))


@query("H5_capability_hash", """
SELECT c_custkey, 'sha256:' || sha256('{"capabilities":["' || array_to_string(list_sort([lower(c_mktsegment), 'editor_save', 'a' || CAST(c_nationkey AS STRING)]), '","') || '"],"catalog_hash":"' || c_name || '"}') AS hash FROM customer""")
def _(t):
    caps = F.array(F.lower("c_mktsegment"), F.lit("editor_save"), F.concat(F.lit("a"), F.col("c_nationkey").cast("string")))
    return t.customer.select("c_custkey", H.capability_hash(caps, "c_name").alias("hash"))


IDENTITY = """
SELECT o_orderkey, 's' || CAST(o_custkey AS STRING) AS src, 't' || o_orderpriority AS tpl, 'r' AS pack, CASE WHEN o_orderkey % 2 = 0 THEN ' ' ELSE 'book' || CAST(o_custkey AS STRING) END AS explicit,
  CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'pro' || o_orderstatus END AS prospective, 'tb' || o_orderstatus AS book, CASE WHEN o_orderkey % 5 = 0 THEN ' lk ' END AS lock_raw,
  CASE WHEN o_orderkey % 7 = 0 THEN 'cat' END AS cid, CASE WHEN o_orderkey % 4 = 0 THEN '/a' ELSE '  ' END AS cpath FROM orders"""
IDENTITY_SQL = f"""
i AS ({IDENTITY}), k AS (SELECT *, coalesce(nullif(trim(explicit), ''), nullif(trim(prospective), ''), book) AS stable, coalesce(nullif(trim(lock_raw), ''), book) AS lock_key,
  CASE WHEN cid IS NOT NULL THEN 'catalog_id' WHEN trim(cpath) <> '' THEN 'catalog_path' ELSE 'book_scope' END AS kind, coalesce(cid, nullif(trim(cpath), ''), 'whole_book') AS value FROM i)"""


def _scope():
    return H.catalog_scope("cid", "cpath")


@query("H6_idempotency_key", f"""
WITH {IDENTITY_SQL} SELECT o_orderkey, 'sha256:' || sha256('{{"rule_pack_hash":"' || pack || '","schema_version":1,"source_snapshot_hash":"' || src || '","target":{{"book_stable_identity":"' || stable || '","catalog_scope":{{"kind":"' || kind || '","value":"' || value || '"}}}},"template_snapshot_hash":"' || tpl || '"}}') AS idempotency_key FROM k""")
def _(t):
    stable = H.stable_identity("explicit", "prospective", "book", "lock_raw")
    return t.sql(IDENTITY).select(
        "o_orderkey", H.idempotency_key(F.col("src"), F.col("tpl"), F.col("pack"), stable, _scope()).alias("idempotency_key"))


@query("H7_fingerprint_diff", """
SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 AND o_orderstatus <> 'F' THEN 'status:' || o_orderstatus || '>F' ELSE '' END AS diff FROM orders""")
def _(t):
    rows = t.orders.select("o_orderkey", F.struct(F.col("o_orderstatus").alias("status"), "o_custkey").alias("e"), F.struct(
        F.when(F.col("o_orderkey") % 4 == 0, "F").otherwise(F.col("o_orderstatus")).alias("status"), "o_custkey").alias("c"))
    diff = F.transform(H.fingerprint_diff("e", "c", ["status", "o_custkey"]), lambda d: F.concat(
        d["field"], F.lit(":"), d["expected"], F.lit(">"), d["current"]))
    return rows.select("o_orderkey", F.array_join(diff, ",").alias("diff"))


@query("H8_scope_and_lock", f"WITH {IDENTITY_SQL} SELECT o_orderkey, kind, value, stable, lock_key FROM k")
def _(t):
    return t.sql(IDENTITY).select(
        "o_orderkey", _scope()["kind"].alias("kind"), _scope()["value"].alias("value"),
        H.stable_identity("explicit", "prospective", "book", "lock_raw").alias("stable"), H.lock_key("lock_raw", "book").alias("lock_key"))


@query("H9_title_size", """
WITH t AS (SELECT p_partkey, length(p_name || repeat('x', p_size)) AS n FROM part)
SELECT p_partkey, CASE WHEN n <= 24 THEN 18 ELSE 16 END AS font_px, CASE WHEN n >= 30 THEN 2 ELSE 1 END AS lines, CASE WHEN n >= 30 THEN 48 END AS height_px, CASE WHEN n >= 30 THEN 24 ELSE 0 END AS shift_px FROM t""")
def _(t):
    return t.part.select("p_partkey", Y.title_size(F.expr("p_name || repeat('x', p_size)")).alias("s")).select("p_partkey", "s.*")


@query("H10_sentence_box", """
WITH s AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents), m AS (SELECT doc_id, len(l) AS n, list_max(list_transform(l, lambda x: length(x))) AS g FROM s)
SELECT doc_id, CASE WHEN n IN (2, 3) THEN 72 WHEN n = 4 THEN 96 WHEN n = 5 THEN 120 END AS box_h, CASE WHEN n IN (2, 3) THEN 588 WHEN n = 4 THEN 612 WHEN n = 5 THEN 636 END AS block_h,
 CASE WHEN n BETWEEN 2 AND 5 THEN CASE WHEN g > 55 THEN 11 WHEN g >= 50 THEN 12 WHEN n >= 4 OR g >= 45 THEN 13 ELSE 16 END END AS font_px FROM m""")
def _(t):
    return t.documents.select("doc_id", Y.sentence_box(F.split("text", "\n")).alias("s")).select("doc_id", "s.*")


@query("H11_word_columns", """
WITH w AS (SELECT p_partkey, length(p_name) AS a, length(p_type) AS b, length(p_brand) AS c, length(p_brand) AS d, p_size % 9 AS z FROM part),
 x AS (SELECT p_partkey, greatest(a, b)*9 + 6 AS w1, greatest(z, 2)*16 + 4 AS w2, greatest(c, 0)*9 + 6 AS w3, greatest(1, 0)*16 + 4 AS w4 FROM w), y AS (SELECT *, w1 + w2 + w3 + w4 + 18 AS total FROM x)
SELECT p_partkey, w1 || ',' || w2 || ',' || w3 || ',' || w4 AS widths, total AS total_px, round(least(1.0, CAST(262 AS DOUBLE) / total), 6) AS scale,
 CAST(greatest(10, floor(least(1.0, CAST(262 AS DOUBLE) / total) * 14)) AS INT) AS font_px FROM y""")
def _(t):
    en = F.array("p_name", "p_brand", "p_type")
    zh = F.array(F.expr("repeat('字', p_size % 9)"), F.lit("字"), F.lit("二字"))
    return t.part.select("p_partkey", Y.word_columns(en, zh).alias("s")).select(
        "p_partkey", F.array_join(F.col("s.widths").cast("array<string>"), ",").alias("widths"), "s.total_px", "s.scale", "s.font_px")


@query("H12_spacer_ok", """
SELECT event_id, coalesce(event_id % 3 = 0 AND event_id % 5 <> 0 AND user_id % 7 <> 0, false) AS ok FROM events""")
def _(t):
    w = F.when(F.col("event_id") % 3 == 0, 375).otherwise(794)
    color = F.when(F.col("event_id") % 5 != 0, "#cecece").otherwise("#ffffff")
    n = F.when(F.col("user_id") % 7 == 0, 1).otherwise(0)
    return t.events.select("event_id", Y.spacer_ok(w, F.lit(20), F.lit("phone"), color, n).alias("ok"))


STAMPS = """
SELECT event_id, CASE event_id % 5 WHEN 0 THEN '2024-01-' || CAST(10 + event_id % 20 AS STRING) || 'T00:00:00Z' WHEN 1 THEN '2024-02-30T00:00:00Z' WHEN 2 THEN '2024-01-05T10:20:30.123Z'
  WHEN 3 THEN '2024-01-05 10:20:30Z' ELSE '2024-01-05T10:20:30+01:00' END AS stamp FROM events"""


@query("H13_iso_utc", f"""
WITH s AS ({STAMPS}) SELECT event_id, CASE event_id % 5 WHEN 0 THEN epoch_us(CAST(replace(replace(stamp, 'T', ' '), 'Z', '') AS TIMESTAMP)) // 1000 WHEN 2 THEN 1704450030123 END AS ms FROM s""")
def _(t):
    return t.sql(STAMPS).select("event_id", F.unix_millis(Y.iso_utc("stamp")).alias("ms"))


@query("H14_js_length", "SELECT doc_id, length(text) + CASE WHEN doc_id % 2 = 0 THEN 2 ELSE 0 END AS n FROM documents")
def _(t):
    text = F.when(F.col("doc_id") % 2 == 0, F.concat("text", F.lit("😀"))).otherwise(F.col("text"))
    return t.documents.select("doc_id", Y.js_length(text).alias("n"))


@query("H15_card_plan", """
SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'drop_section' WHEN event_id % 7 = 1 THEN 'drop_second_card' WHEN event_id % 7 = 2 THEN 'keep' WHEN event_id % 7 <= 4 THEN 'clone_cards' ELSE 'stop' END AS plan FROM events""")
def _(t):
    return t.events.select("event_id", Y.card_plan(F.col("event_id") % 7).alias("plan"))


@query("H9_layout_plan", """
WITH d AS (SELECT doc_id AS page_id, length(source || ' ' || lang || repeat('t', CAST(n_chars % 30 AS INT))) AS n, string_split(text, chr(10)) AS l, length(lang) AS a, length(source) AS b FROM documents),
 m AS (SELECT *, len(l) AS k, list_max(list_transform(l, lambda x: length(x))) AS g, greatest(a, 5)*9 + 6 AS w1, greatest(b, 4)*9 + 6 AS w3 FROM d), y AS (SELECT *, w1 + 20 + w3 + 36 + 18 AS total FROM m)
SELECT page_id, CASE WHEN n <= 24 THEN 18 ELSE 16 END AS title_px, CASE WHEN n >= 30 THEN 2 ELSE 1 END AS title_lines, CASE WHEN n >= 30 THEN 24 ELSE 0 END AS shift_px,
 CASE WHEN k IN (2, 3) THEN 72 WHEN k = 4 THEN 96 WHEN k = 5 THEN 120 END AS box_h, CASE WHEN k IN (2, 3) THEN 588 WHEN k = 4 THEN 612 WHEN k = 5 THEN 636 END AS block_h,
 CASE WHEN k BETWEEN 2 AND 5 THEN CASE WHEN g > 55 THEN 11 WHEN g >= 50 THEN 12 WHEN k >= 4 OR g >= 45 THEN 13 ELSE 16 END END AS sentence_px,
 w1 || ',20,' || w3 || ',36' AS columns, total AS total_px, CAST(greatest(10, floor(least(1.0, CAST(262 AS DOUBLE) / total) * 14)) AS INT) AS word_px FROM y""")
def _(t):
    pages = t.documents.select(
        F.col("doc_id").alias("page_id"), F.expr("source || ' ' || lang || repeat('t', CAST(n_chars % 30 AS INT))").alias("title"),
        F.split("text", "\n").alias("sentences"), F.array("lang", "source", F.lit("three"), F.lit("four")).alias("en"),
        F.array(F.lit("一"), F.lit("二二"), F.lit("三"), F.lit("四")).alias("zh"))
    return Y.layout_plan(pages, "title", "sentences", "en", "zh")
