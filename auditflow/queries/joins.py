"""Joins and matching."""

from pyspark.sql import functions as F

from auditflow.operators import annotations as A
from auditflow.operators import matching as M
from auditflow.operators import ranges
from auditflow.queries import query
from auditflow.queries.reports import LAST_PAGE, MEDIA


@query("C1_scale_annotations", f"""
SELECT a.path, a.id, a.pos, a.page, 794.0/p.width AS scale, a.x*(794.0/p.width) AS left_px, a.y*(794.0/p.width) AS top_px,
  a.width*(794.0/p.width) AS width_px FROM fx_annotation a LEFT JOIN (SELECT * FROM {LAST_PAGE} WHERE page % 10 <> 0) p ON a.path = p.path AND a.page = p.page""")
def _(t):
    out = A.scale_annotations(t.fx_annotation, t.fx_page.where("page % 10 <> 0"))
    return out.select("path", "id", "pos", "page", "scale", "left_px", "top_px", "width_px")


@query("C2_resolve_media", f"""
SELECT path, id, pos, m.length AS audio_size, CASE WHEN type <> 'audio' THEN NULL WHEN m.length IS NULL THEN 'missing' WHEN places > 1 THEN 'ambiguous'
  WHEN m.length > 73400320 THEN 'too_large' ELSE 'ok' END AS media_status
FROM fx_annotation LEFT JOIN {MEDIA} m ON type = 'audio' AND regexp_extract(audio_path, '[^/]+$') = m.basename""")
def _(t):
    return A.resolve_media(t.fx_annotation, t.fx_media).select("path", "id", "pos", "audio_size", "media_status")


@query("C3_module_names", """
WITH idx AS (SELECT c_nationkey AS element_id, arg_max(c_name, c_custkey) AS name FROM customer WHERE c_nationkey % 5 <> 0 GROUP BY 1)
SELECT s_suppkey AS module_id, s_nationkey AS element_id, name AS element_name FROM supplier LEFT JOIN idx ON s_nationkey = element_id""")
def _(t):
    from auditflow.operators.extract import module_names
    modules = t.supplier.selectExpr("s_suppkey AS module_id", "s_nationkey AS element_id")
    index = t.customer.where("c_nationkey % 5 <> 0").selectExpr("c_nationkey AS element_id", "c_name AS name", "c_custkey AS pos")
    return module_names(modules, index, [])


@query("C4_attach_rich_text", """
WITH r AS (SELECT l_orderkey, l_shipdate, trim(' ' || l_returnflag || ' ') AS text,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS n FROM lineitem WHERE l_linenumber > 1)
SELECT o_orderkey AS block_id, CAST((n - 1) // 4 AS BIGINT) AS segment, count(text) AS n_texts,
  coalesce(string_agg(text, '|' ORDER BY n), '') AS texts
FROM orders LEFT JOIN r ON l_orderkey = o_orderkey GROUP BY 1, 2""")
def _(t):
    from auditflow.operators.extract import attach_rich_text
    blocks = t.orders.select(F.col("o_orderkey").alias("block_id"))
    rich = t.lineitem.where("l_linenumber > 1").selectExpr(
        "l_orderkey AS block_id", "concat(' ', l_returnflag, ' ') AS plain_text", "l_linenumber", "l_partkey", "l_suppkey")
    out = attach_rich_text(blocks, rich, ["l_linenumber", "l_partkey", "l_suppkey"], size=4)
    return out.select("block_id", "segment", F.size("texts").cast("bigint").alias("n_texts"), F.array_join("texts", "|").alias("texts"))


@query("C5_zip_by_position", """
WITH s AS (SELECT o_custkey AS c, o_orderkey AS source_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS position FROM orders WHERE o_orderstatus = 'F'),
 g AS (SELECT o_custkey AS c, o_orderkey AS target_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS position FROM orders WHERE o_orderstatus = 'O')
SELECT coalesce(s.c, g.c) AS o_custkey, coalesce(s.position, g.position) AS position, source_id, target_id,
  CASE WHEN target_id IS NULL THEN 'missing_target' WHEN source_id IS NULL THEN 'extra_target' ELSE 'paired' END AS status
FROM s FULL JOIN g ON s.c = g.c AND s.position = g.position""")
def _(t):
    return M.zip_by_position(
        t.orders.where("o_orderstatus = 'F'"), t.orders.where("o_orderstatus = 'O'"), ["o_custkey"], ["o_orderkey"],
        "o_orderkey", "o_orderkey")


@query("C6_join_progress", """
SELECT o_orderkey AS target_id, o_custkey AS source_key, f.l AS source_line, CASE WHEN f.k IS NULL THEN 'source_unknown' ELSE 'open' END AS status FROM orders
LEFT JOIN (SELECT l_suppkey AS k, min(l_orderkey*100 + l_linenumber) AS l FROM lineitem GROUP BY 1) f ON o_custkey = f.k
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def _(t):
    target = t.orders.selectExpr("o_orderkey AS target_id", "o_custkey AS source_key")
    source = t.lineitem.selectExpr("l_suppkey AS source_key", "l_orderkey*100 + l_linenumber AS source_line")
    receipts = t.lineitem.where("l_returnflag = 'R'").selectExpr("l_orderkey AS target_id")
    return M.join_progress(target, source, receipts, "target_id", "source_key", "source_line").select(
        "target_id", "source_key", "source_line", "status")


@query("C7_pair_practice_analysis", """
WITH p AS (SELECT page_id AS book_id, pos, pos // 2 AS sequence, role, text FROM fx_block WHERE role <> 'system'),
 g AS (SELECT book_id, sequence, count(*) FILTER (WHERE role = 'user') AS np, count(*) FILTER (WHERE role = 'assistant') AS na,
        min(text) FILTER (WHERE role = 'user') AS topic FROM p GROUP BY 1, 2)
SELECT p.book_id, p.pos, p.sequence, CASE WHEN np = 1 AND na = 1 THEN g.topic END AS topic,
  CASE WHEN np = 1 AND na = 1 THEN 'paired' ELSE 'needs_review' END AS status
FROM p JOIN g USING (book_id, sequence) WHERE role = 'assistant'""")
def _(t):
    pages = t.fx_block.where("role <> 'system'").selectExpr(
        "page_id AS book_id", "pos", "pos DIV 2 AS sequence",
        "CASE role WHEN 'user' THEN 'practice' ELSE 'analysis' END AS kind", "text AS topic")
    return M.pair_practice_analysis(pages).select("book_id", "pos", "sequence", "topic", "status")


@query("C8_next_block_of", """
SELECT a.page_id, a.pos, (SELECT min(b.pos) FROM fx_block b WHERE b.page_id = a.page_id AND b.pos > a.pos AND b.role = 'assistant') AS next_pos
FROM fx_block a WHERE a.role = 'user'""")
def _(t):
    from auditflow.operators.windows import next_matching
    out = next_matching(t.fx_block, ["page_id"], ["pos"], F.col("role") == "assistant", F.col("pos"), "next_pos")
    return out.where("role = 'user'").select("page_id", "pos", "next_pos")


LISTS = """
SELECT DISTINCT CAST(o_custkey AS STRING) AS query_id, CAST(l_suppkey AS STRING) AS candidate_id
FROM orders JOIN lineitem ON l_orderkey = o_orderkey"""

NORMAL = r"""
nq AS (SELECT query_id, subject AS s, grade AS g, CASE volume WHEN '1' THEN '上册' ELSE volume END AS v,
   regexp_replace(lower(book_name), '\s', '', 'g') AS b, array_to_string(list_transform(regexp_split_to_array(catalog_path, '[/>\\]'), lambda x: regexp_replace(lower(x), '\s+', '', 'g')), '/') AS p,
   lower(catalog_name) AS n, catalog_sort AS o FROM fx_query),
nc AS (SELECT candidate_id, subject AS s, grade AS g, CASE volume WHEN '1' THEN '上册' ELSE volume END AS v,
   regexp_replace(lower(book_name), '\s', '', 'g') AS b, array_to_string(list_transform(regexp_split_to_array(catalog_path, '[/>\\]'), lambda x: regexp_replace(lower(x), '\s+', '', 'g')), '/') AS p,
   lower(catalog_name) AS n, catalog_sort AS o FROM fx_candidate)"""
SCORE = """
coalesce(q.s <> c.s, false) OR coalesce(q.g <> c.g, false) OR coalesce(q.v <> c.v, false) AS rejected,
 CASE WHEN q.s = c.s THEN 15 ELSE 0 END + CASE WHEN q.g = c.g THEN 15 ELSE 0 END + CASE WHEN q.v = c.v THEN 15 ELSE 0 END
 + CASE WHEN q.b = c.b THEN 20 WHEN contains(q.b, c.b) OR contains(c.b, q.b) THEN 10 ELSE 0 END
 + CASE WHEN q.p = c.p THEN 20 WHEN q.n = c.n AND q.o = c.o THEN 15 ELSE 0 END AS raw_score,
 c.s IS NULL OR c.g IS NULL OR c.v IS NULL AS core_missing"""
SCORED = NORMAL + f""",
pairs AS (SELECT query_id, candidate_id, {SCORE} FROM (""" + LISTS + """) JOIN nq q USING (query_id) JOIN nc c USING (candidate_id)),
scored AS (SELECT query_id, candidate_id, NOT rejected AS eligible, CASE WHEN rejected THEN 0 ELSE raw_score END AS score,
  CASE WHEN rejected THEN 'rejected' WHEN raw_score >= 65 AND NOT core_missing THEN 'high' WHEN raw_score >= 40 THEN 'medium' ELSE 'low' END AS confidence FROM pairs)"""


def scored(t):
    return M.match_source(t.fx_query, t.fx_candidate, t.sql(LISTS))


@query("C9_match_source", f"WITH {SCORED} SELECT query_id, candidate_id, eligible, score, confidence FROM scored")
def _(t):
    return scored(t).select("query_id", "candidate_id", "eligible", "score", "confidence")


@query("F1_rank_candidates", f"""
WITH {SCORED} SELECT query_id, candidate_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, candidate_id) AS rank FROM scored""")
def _(t):
    return M.rank_candidates(scored(t)).select("query_id", "candidate_id", "score", "rank")


ACCENTS = """SELECT CAST(c_nationkey AS STRING) AS query_id, c_custkey % 3 AS score, CASE c_custkey % 7 WHEN 0 THEN 'é' WHEN 1 THEN 'E' WHEN 2 THEN 'e' WHEN 3 THEN 'Zu' WHEN 4 THEN 'z' WHEN 5 THEN 'É' ELSE 'ß-' END || CAST(c_custkey % 90 AS STRING)
  || CASE WHEN c_custkey % 4 = 0 THEN 'A' ELSE 'a' END || CAST(c_custkey AS STRING) AS candidate_id FROM customer"""


@query("F1_rank_collated", f"SELECT query_id, candidate_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, candidate_id COLLATE en, candidate_id) AS rank FROM ({ACCENTS})")
def _(t):
    return M.rank_candidates(t.sql(ACCENTS)).select("query_id", "candidate_id", "score", "rank")


# Names of any length: texts, pieces of them and short words.
LONG_NAMES = "SELECT text AS name FROM documents"
PIECES = """SELECT substring(text, CAST(1 + doc_id % 40 AS INT), CAST(1 + doc_id % 300 AS INT)) AS needle FROM documents UNION ALL SELECT lang FROM documents UNION ALL SELECT substring(text, 1, 2) FROM benchmark UNION ALL SELECT text || '?' FROM benchmark"""


@query("C9_contained_names", f"""
SELECT needle, sha256(name) AS name FROM (SELECT DISTINCT needle FROM ({PIECES})) JOIN (SELECT DISTINCT name FROM ({LONG_NAMES})) ON contains(name, needle) AND length(name) > length(needle) WHERE needle <> ''""")
def _(t):
    names = t.sql(LONG_NAMES).withColumn("sha", F.sha2("name", 256))
    return M.contained_names(t.sql(PIECES), names).select("needle", F.col("sha").alias("name"))


@query("F2_unique_top", f"""
WITH {SCORED}, b AS (SELECT query_id, max(score) FILTER (WHERE eligible) AS top_score FROM scored GROUP BY 1),
 n AS (SELECT b.query_id, b.top_score, count(candidate_id) AS n_top, min(candidate_id) AS cid FROM b LEFT JOIN scored s ON s.query_id = b.query_id AND s.eligible AND s.score = b.top_score GROUP BY 1, 2),
 conf AS (SELECT query_id, min(candidate_id) AS c FROM scored GROUP BY 1)
SELECT n.query_id, top_score, n_top, coalesce(top_score > 0 AND n_top = 1, false) AS unique_top,
  CASE WHEN top_score > 0 AND n_top = 1 THEN cid END AS top_candidate_id,
  CASE WHEN s.eligible THEN conf.c END AS selected_candidate_id
FROM n JOIN conf USING (query_id) JOIN scored s ON s.query_id = conf.query_id AND s.candidate_id = conf.c""")
def _(t):
    s = scored(t)
    confirmations = s.groupBy("query_id").agg(F.min("candidate_id").alias("candidate_id")).withColumn("confirmed", F.lit(True))
    return M.unique_top(s, confirmations)


def _json(c):
    return F.to_json(F.struct(F.col(c).alias("v")), {"ignoreNullFields": "false"})


@query("C10_plan_refinement", """
WITH m AS (SELECT coalesce(b.k, c.k, w.k) AS k, b.k IS NOT NULL AS bp, c.k IS NOT NULL AS cp, w.k IS NOT NULL AS wl,
   coalesce(w.is_delete, false) AS del, b.v AS bv, c.v AS cv, w.v AS wv
  FROM fx_base b FULL JOIN fx_cur c ON b.k = c.k FULL JOIN fx_want w ON w.k = coalesce(b.k, c.k)),
g AS (SELECT *, CASE WHEN del THEN '~' WHEN wl THEN wv WHEN bp THEN bv ELSE '~' END AS goal,
   CASE WHEN bp THEN bv ELSE '~' END AS base, CASE WHEN cp THEN cv ELSE '~' END AS now FROM m)
SELECT k, CASE WHEN goal = base OR now = goal THEN 'noop' WHEN now = base THEN 'safe' ELSE 'conflict' END AS classification,
  CASE WHEN goal = base THEN 'desired_did_not_change_from_baseline' WHEN now = goal THEN 'current_already_matches_desired'
   WHEN now = base THEN 'current_matches_baseline' ELSE 'current_and_desired_diverged_from_baseline' END AS reason,
  CASE WHEN wl AND NOT del THEN 'set' ELSE 'delete' END AS operation, bp AS baseline_present, cp AS current_present, wl AND NOT del AS desired_present
FROM g""")
def _(t):
    plan = M.plan_refinement(
        t.fx_base.withColumnRenamed("v", "value"), t.fx_cur.withColumnRenamed("v", "value"),
        t.fx_want.withColumnRenamed("v", "value"), ["k"])
    return plan.select("k", "classification", "reason", "operation", "baseline_present", "current_present", "desired_present")


@query("C11_missing", """
SELECT p_partkey AS k, 'unused' AS side FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_linenumber = 1)
UNION ALL SELECT DISTINCT l_partkey, 'unknown' FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 5)""")
def _(t):
    parts = t.part.selectExpr("p_partkey AS k", "p_size")
    used = t.lineitem.selectExpr("l_partkey AS k", "l_linenumber")
    unused = M.missing(parts, used.where("l_linenumber = 1"), ["k"]).select("k", F.lit("unused").alias("side"))
    unknown = M.missing(used.select("k").distinct(), parts.where("p_size > 5"), ["k"]).select("k", F.lit("unknown").alias("side"))
    return unused.unionByName(unknown)


@query("C12_keep_known", """
SELECT o_orderkey, o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) AS relevant FROM orders""")
def _(t):
    good = t.customer.where("c_acctbal > 0").selectExpr("c_custkey AS o_custkey")
    orders = t.orders.select("o_orderkey", "o_custkey")
    kept = M.keep_known(orders, good, ["o_custkey"]).select("o_orderkey", F.lit(True).alias("relevant"))
    return kept.unionByName(M.drop_known(orders, good, ["o_custkey"]).select("o_orderkey", F.lit(False).alias("relevant")))


REQUIRED = """
SELECT 'run' || CAST(p_partkey % 5 AS STRING) AS run_id, 'check:' || CAST(p_partkey AS STRING) AS required_key,
  'c' || CAST(p_partkey AS STRING) AS id, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE 'r' || CAST(p_partkey % 7 AS STRING) END AS rule_id FROM part"""
REPORTED = """
SELECT 'run' || CAST(k % 5 AS STRING) AS run_id, 'c' || CAST(k AS STRING) AS id,
  CASE WHEN nation % 4 = 0 THEN NULL ELSE 'r' || CAST((k + CASE WHEN nation % 5 = 0 THEN 1 ELSE 0 END) % 7 AS STRING) END AS rule_id,
  CASE nation % 3 WHEN 0 THEN 'passed' WHEN 1 THEN 'failed' ELSE 'warning' END AS status
FROM (SELECT c_custkey AS k, c_nationkey AS nation FROM customer UNION ALL SELECT s_suppkey, s_nationkey FROM supplier)"""


@query("C13_cover_required_checks", f"""
WITH q AS ({REQUIRED}), r AS ({REPORTED}),
 j AS (SELECT q.run_id, required_key, q.id, q.rule_id, count(r.id) AS n_reports, min(r.status) AS status
  FROM q LEFT JOIN r ON q.run_id = r.run_id AND q.id = r.id AND (r.rule_id IS NULL OR r.rule_id = q.rule_id) GROUP BY ALL)
SELECT run_id, required_key, id, rule_id, n_reports, CASE n_reports WHEN 0 THEN 'missing' WHEN 1 THEN 'covered' ELSE 'ambiguous' END AS outcome,
  CASE WHEN n_reports = 1 THEN status END AS check_status FROM j""")
def _(t):
    return M.cover_required_checks(t.sql(REQUIRED), t.sql(REPORTED))


PLANNED = """
SELECT l_orderkey*1000000 + l_suppkey*10 + l_linenumber AS pos, l_partkey % 50 AS page, CASE WHEN l_linenumber % 2 = 0 THEN 265 ELSE 506 END AS component,
  l_quantity*3 + (l_suppkey % 10)/8.0 AS left_px, l_quantity*2 + (l_orderkey % 9)/8.0 AS top_px FROM lineitem WHERE l_returnflag = 'A'"""
EXISTING = """
SELECT l_partkey % 50 AS page, CASE WHEN l_linenumber % 2 = 0 THEN 265 ELSE 506 END AS component,
  l_quantity*3 + (l_suppkey % 7)/8.0 AS left_px, l_quantity*2 + (l_orderkey % 5)/8.0 AS top_px, l_suppkey % 3 = 0 AS has_module FROM lineitem WHERE l_returnflag = 'R'"""


@query("C14_match_existing", f"""
WITH p AS ({PLANNED}), e AS (SELECT DISTINCT * FROM ({EXISTING}))
SELECT p.pos, p.page, p.component, CASE WHEN bool_or(e.has_module) THEN 'done' WHEN count(e.page) > 0 THEN 'partial' ELSE 'pending' END AS status
FROM (SELECT *, row_number() OVER () AS rid FROM p) p LEFT JOIN e ON p.page = e.page AND p.component = e.component AND abs(p.left_px - e.left_px) <= 0.5 AND abs(p.top_px - e.top_px) <= 0.5
GROUP BY p.rid, p.pos, p.page, p.component""")
def _(t):
    # Decimal division differs between engines; the positions are doubles here.
    as_double = lambda s: s.replace("8.0", "CAST(8 AS DOUBLE)")
    return A.match_existing(t.sql(as_double(PLANNED)), t.sql(as_double(EXISTING))).select("pos", "page", "component", "status")


@query("C15_map_versions", """
WITH o AS (SELECT doc_id, sha256(text) AS key FROM documents WHERE doc_id % 3 <> 0), n AS (SELECT doc_id + 1 AS doc_id, sha256(text) AS key FROM documents WHERE doc_id % 4 <> 0),
 a AS (SELECT key, count(*) AS n_old, min(doc_id) AS i FROM o GROUP BY 1), b AS (SELECT key, count(*) AS n_new, min(doc_id) AS i FROM n GROUP BY 1),
 j AS (SELECT coalesce(a.key, b.key) AS key, coalesce(n_old, 0) AS n_old, coalesce(n_new, 0) AS n_new, a.i AS oi, b.i AS ni FROM a FULL JOIN b ON a.key = b.key)
SELECT key, CASE WHEN n_old <= 1 AND n_new <= 1 THEN oi END AS old_id, CASE WHEN n_old <= 1 AND n_new <= 1 THEN ni END AS new_id, n_old, n_new,
  CASE WHEN n_old > 1 OR n_new > 1 THEN 'needs_review' WHEN n_old = 0 THEN 'added' WHEN n_new = 0 THEN 'removed' ELSE 'mapped' END AS status FROM j""")
def _(t):
    docs = t.documents.select("doc_id", F.sha2("text", 256).alias("key"))
    old = docs.where("doc_id % 3 <> 0").withColumnRenamed("doc_id", "id")
    new = docs.where("doc_id % 4 <> 0").select((F.col("doc_id") + 1).alias("id"), "key")
    return M.map_versions(old, new, ["key"])


RECEIPTS = """
SELECT o_orderkey AS item_id, 'run-' || CAST(o_custkey AS STRING) AS run_id, CASE WHEN o_orderkey % 10 = 0 THEN 'bad' ELSE 'prov-' || CAST(o_custkey AS STRING) END AS provenance_integrity_hash,
  CASE WHEN o_orderkey % 15 = 0 THEN 'carrier-x' ELSE 'carrier-' || CAST(o_custkey AS STRING) END AS carrier_block_id,
  CAST(o_custkey % 9 AS STRING) AS source_book_id, CASE WHEN o_orderkey % 21 = 0 THEN 'x' ELSE CAST(o_custkey % 4 AS STRING) END AS target_book_id, CAST(o_orderkey AS STRING) AS slide_id,
  CASE WHEN o_orderkey % 25 = 0 THEN '0' ELSE CAST(o_orderkey AS STRING) END AS target_catalog_id, 'page-' || CAST(o_orderkey AS STRING) AS page_hash FROM orders"""
RUNS = """
SELECT 'run-' || CAST(c_custkey AS STRING) AS run_id, 'prov-' || CAST(c_custkey AS STRING) AS integrity_hash, 'carrier-' || CAST(c_custkey AS STRING) AS carrier_block_id,
  CAST(c_custkey % 9 AS STRING) AS source_book_id, CAST(c_custkey % 4 AS STRING) AS target_book_id FROM customer WHERE c_custkey % 20 <> 0"""
ITEMS = """
SELECT l_orderkey AS item_id, 'run-' || CAST(min(o_custkey) AS STRING) AS run_id, CASE WHEN max(l_linenumber) < 5 THEN 'old' ELSE 'page-' || CAST(l_orderkey AS STRING) END AS save_readback_hash
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_orderkey"""


@query("C16_bind_receipts", f"""
WITH r AS ({RECEIPTS}), p AS ({RUNS}), l AS ({ITEMS}),
 j AS (SELECT r.*, p.integrity_hash AS ph, p.carrier_block_id AS pc, p.source_book_id AS ps, p.target_book_id AS pt, l.run_id AS lr, l.save_readback_hash AS lh
   FROM r LEFT JOIN p ON r.run_id = p.run_id LEFT JOIN l ON r.item_id = l.item_id)
SELECT CAST(item_id AS STRING) AS entity_id, code AS rule_code, 'error' AS severity FROM (
  SELECT item_id, unnest([CASE WHEN ph IS NULL THEN 'run_unknown' END, CASE WHEN lr IS NULL THEN 'ledger_item_missing' END,
   CASE WHEN provenance_integrity_hash <> ph THEN 'provenance_hash_mismatch' END, CASE WHEN carrier_block_id <> pc THEN 'carrier_mismatch' END,
   CASE WHEN source_book_id <> ps THEN 'source_book_mismatch' END, CASE WHEN target_book_id <> pt THEN 'target_book_mismatch' END,
   CASE WHEN target_catalog_id <> slide_id THEN 'target_catalog_not_slide' END, CASE WHEN run_id <> lr THEN 'ledger_run_mismatch' END,
   CASE WHEN page_hash <> lh THEN 'ledger_result_hash_mismatch' END]) AS code FROM j) WHERE code IS NOT NULL""")
def _(t):
    return M.bind_receipts(t.sql(RECEIPTS), t.sql(RUNS), t.sql(ITEMS)).select("entity_id", "rule_code", "severity")


ROLES = ["source", "template", "target_before", "target_after", "save_receipt", "provenance_readback", "acceptance_report"]
LINKS = " UNION ALL ".join(f"""
SELECT doc_id AS case_id, '{role}' AS role, 'cases/' || CAST(doc_id AS STRING) AS base,
  CASE WHEN doc_id % 31 = {i} THEN '../../../x.json' ELSE '../../files/./' || CAST(doc_id + {i} AS STRING) || '.json' END AS artifact,
  CASE WHEN doc_id % 29 = {i} THEN 'wrong' ELSE 'sha-' || CAST(doc_id + {i} AS STRING) END AS artifact_sha256,
  CASE WHEN doc_id % 23 = {i} THEN 'same' ELSE 'hash-' || CAST(doc_id + {i} AS STRING) END AS claimed_hash,
  CASE WHEN {i} IN (2, 3) THEN CASE WHEN doc_id % 19 = {i} THEN 'other' ELSE 'book-' || CAST((doc_id + 2) % 3 AS STRING) END END AS linked_id
FROM labels WHERE doc_id % 37 <> {i}""" for i, role in enumerate(ROLES))
FILES = """
SELECT 'files/' || CAST(doc_id AS STRING) || '.json' AS path, 'sha-' || CAST(doc_id AS STRING) AS sha256,
  'hash-' || CAST(doc_id AS STRING) AS canonical_hash, 'book-' || CAST(doc_id % 3 AS STRING) AS id FROM documents WHERE doc_id % 13 <> 0"""


@query("C17_verify_evidence_chain", f"""
WITH l AS ({LINKS}), f AS ({FILES}),
 p AS (SELECT *, CASE WHEN artifact = '../../../x.json' THEN NULL ELSE replace(artifact, '../../files/./', 'files/') END AS path FROM l),
 j AS (SELECT p.*, f.sha256, f.canonical_hash, f.id FROM p LEFT JOIN f ON p.path = f.path),
 v AS (SELECT case_id, role, unnest([CASE WHEN path IS NULL THEN 'path_escapes_root' END, CASE WHEN path IS NOT NULL AND sha256 IS NULL THEN 'artifact_missing' END,
   CASE WHEN artifact_sha256 <> sha256 THEN 'artifact_sha_mismatch' END, CASE WHEN claimed_hash <> canonical_hash THEN 'canonical_hash_mismatch' END,
   CASE WHEN linked_id <> id THEN 'linked_id_absent' END]) AS rule_code FROM j),
 g AS (SELECT case_id, count(DISTINCT role) AS n, max(linked_id) FILTER (WHERE role = 'target_before') AS bi, max(linked_id) FILTER (WHERE role = 'target_after') AS ai,
   max(claimed_hash) FILTER (WHERE role = 'target_before') AS bh, max(claimed_hash) FILTER (WHERE role = 'target_after') AS ah FROM l GROUP BY 1),
 w AS (SELECT case_id, '' AS role, unnest([CASE WHEN n < 7 THEN 'links_incomplete' END, CASE WHEN bi <> ai THEN 'target_changed_identity' END, CASE WHEN bh = ah THEN 'target_unchanged' END]) AS rule_code FROM g)
SELECT CAST(case_id AS STRING) AS entity_id, rule_code, count(*) AS n FROM (SELECT * FROM v UNION ALL SELECT * FROM w) WHERE rule_code IS NOT NULL GROUP BY ALL""")
def _(t):
    files = t.sql(FILES).withColumn("ids", F.array("id"))
    found = M.verify_evidence_chain(t.sql(LINKS), files)
    return found.groupBy("entity_id", "rule_code").agg(F.count("*").alias("n"))


CAT_NAME = "p_name || ' ' || CAST(p_partkey % 40 AS STRING)"
SOURCE_CATALOGS = "SELECT p_partkey AS catalog_id, {name} AS name, p_size AS ordinal FROM part"
TARGET_CATALOGS = "SELECT p_partkey + 7 AS catalog_id, {name} AS name, CASE WHEN p_brand < 'Brand#2' THEN p_size + 1 ELSE p_size END AS ordinal FROM part"


@query("C18_match_catalogs", f"""
WITH s AS ({SOURCE_CATALOGS.format(name=CAT_NAME)}), g AS ({TARGET_CATALOGS.format(name=CAT_NAME)}),
 a AS (SELECT name, ordinal, count(*) AS n, min(catalog_id) AS i FROM s GROUP BY 1, 2), b AS (SELECT name, ordinal, count(*) AS n, min(catalog_id) AS i FROM g GROUP BY 1, 2)
SELECT coalesce(a.name, b.name) AS name, coalesce(a.ordinal, b.ordinal) AS ordinal,
  CASE WHEN a.n = 1 AND b.n = 1 THEN a.i END AS source_catalog_id, CASE WHEN a.n = 1 AND b.n = 1 THEN b.i END AS target_catalog_id,
  CASE WHEN a.n > 1 OR b.n > 1 THEN 'ambiguous' WHEN b.n IS NULL THEN 'missing_target' WHEN a.n IS NULL THEN 'unexpected_target' ELSE 'matched' END AS status
FROM a FULL JOIN b ON a.name = b.name AND a.ordinal = b.ordinal""")
def _(t):
    return M.match_catalogs(
        t.sql(SOURCE_CATALOGS.format(name=f"concat('  ', upper({CAT_NAME}), ' ')")), t.sql(TARGET_CATALOGS.format(name=CAT_NAME)))


@query("C19_artifact_closure", """
WITH RECURSIVE e AS (SELECT CAST(conv_id AS STRING) || ':' || CAST(turn AS STRING) AS src,
   CASE WHEN role = 'system' THEN CAST(conv_id + 1 AS STRING) || ':0' ELSE CAST(conv_id AS STRING) || ':' || CAST(turn + 1 AS STRING) END AS dst FROM conversations),
 c(root, node, depth) AS (SELECT DISTINCT CAST(conv_id AS STRING) || ':0', CAST(conv_id AS STRING) || ':0', 0 FROM conversations
   UNION SELECT c.root, e.dst, c.depth + 1 FROM c JOIN e ON c.node = e.src)
SELECT root, node, min(depth) AS depth FROM c GROUP BY 1, 2""")
def _(t):
    edges = t.sql("""SELECT CAST(conv_id AS STRING) || ':' || CAST(turn AS STRING) AS src,
      CASE WHEN role = 'system' THEN CAST(conv_id + 1 AS STRING) || ':0' ELSE CAST(conv_id AS STRING) || ':' || CAST(turn + 1 AS STRING) END AS dst FROM conversations""")
    starts = t.sql("SELECT DISTINCT CAST(conv_id AS STRING) || ':0' AS root, CAST(conv_id AS STRING) || ':0' AS node FROM conversations")
    return M.artifact_closure(starts, edges)


# Files that name each other: the next one in the next folder, one of the same folder, the first of ten (a cycle), and some outside of the root.
REF_FILES = """SELECT 'd' || CAST(doc_id % 50 AS STRING) || '/f' || CAST(doc_id AS STRING) || '.json' AS path, CASE WHEN doc_id % 17 = 16 THEN '{broken' ELSE
 '{"meta":{"list":[[{"artifact":"../d' || CAST((doc_id + CASE WHEN doc_id % 10 = 9 THEN -9 ELSE 1 END) % 50 AS STRING) || '//f' || CAST(doc_id + CASE WHEN doc_id % 10 = 9 THEN -9 ELSE 1 END AS STRING) || '.json"}]]},"artifact":["d0/f0.json"]'
 || CASE WHEN doc_id % 30 = 4 THEN ',"evidence_artifact":"./x/../f' || CAST(doc_id + 50 AS STRING) || '.json"' ELSE '' END
 || CASE WHEN doc_id % 7 = 0 THEN ',"a":{"artifact":"/etc/x.json","b":{"artifact":"/work/d1/f1.json"}}' ELSE '' END
 || CASE WHEN doc_id % 11 = 0 THEN ',"c":[{"artifact":"../../out.json"}]' ELSE '' END || '}' END AS raw FROM documents"""


@query("C19_file_closure", """
WITH RECURSIVE d AS (SELECT doc_id, 'd' || CAST(doc_id % 50 AS STRING) || '/f' || CAST(doc_id AS STRING) || '.json' AS path FROM documents),
e AS (SELECT path AS src, unnest(['d' || CAST((doc_id + CASE WHEN doc_id % 10 = 9 THEN -9 ELSE 1 END) % 50 AS STRING) || '/f' || CAST(doc_id + CASE WHEN doc_id % 10 = 9 THEN -9 ELSE 1 END AS STRING) || '.json',
   CASE WHEN doc_id % 30 = 4 THEN 'd' || CAST(doc_id % 50 AS STRING) || '/f' || CAST(doc_id + 50 AS STRING) || '.json' END, CASE WHEN doc_id % 7 = 0 THEN '/etc/x.json' END, CASE WHEN doc_id % 7 = 0 THEN 'd1/f1.json' END,
   CASE WHEN doc_id % 11 = 0 THEN '../out.json' END]) AS dst FROM d WHERE doc_id % 17 <> 16),
c(root, node, depth) AS (SELECT doc_id, path, 0 FROM d WHERE doc_id % 20 < 2 UNION SELECT c.root, e.dst, c.depth + 1 FROM c JOIN e ON e.src = c.node WHERE e.dst IS NOT NULL AND c.depth < 40)
SELECT root, node, min(depth) AS depth, CASE WHEN node LIKE '../%' OR node LIKE '/%' THEN 'escape' WHEN d.doc_id IS NULL THEN 'missing' WHEN d.doc_id % 17 = 16 THEN 'invalid_json' ELSE 'ok' END AS status
FROM c LEFT JOIN d ON d.path = c.node GROUP BY 1, 2, 4""")
def _(t):
    starts = t.sql("SELECT doc_id AS root, 'd9/../d' || CAST(doc_id % 50 AS STRING) || '/./f' || CAST(doc_id AS STRING) || '.json' AS node FROM documents WHERE doc_id % 20 < 2")
    return M.file_closure(starts, t.sql(REF_FILES))


@query("C21_plan_modules", """
WITH r AS (SELECT p_partkey AS element_id, p_brand AS page_id, CASE WHEN p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'A' AND l_linenumber = 1) THEN 'skip'
   WHEN p_size % 10 <> 0 THEN 'create' ELSE 'blocked' END AS action FROM part)
SELECT element_id, page_id, action, NOT bool_or(action = 'blocked') OVER (PARTITION BY page_id) AS page_ready FROM r""")
def _(t):
    expected = t.part.selectExpr("p_partkey AS element_id", "p_brand AS page_id", "p_size % 10 <> 0 AS locator_valid")
    existing = t.lineitem.where("l_returnflag = 'A' AND l_linenumber = 1").selectExpr("l_partkey AS element_id")
    return M.plan_modules(expected, existing).select("element_id", "page_id", "action", "page_ready")
