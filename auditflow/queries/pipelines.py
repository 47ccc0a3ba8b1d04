"""Pipelines end to end."""

from pyspark.sql import functions as F

from auditflow.functions.canon import canonical_hash
from auditflow.operators import report as R
from auditflow.plans import pipelines as L
from auditflow.queries import query
from auditflow.queries.extract import BINDING_SQL, CATALOG, OVERRIDE_ROWS, PLAN_BLOCKS, PLAN_MODULES, PLAN_RICH
from auditflow.queries.joins import NORMAL, SCORE
from auditflow.queries.reports import FOUND, SCALED
from auditflow.queries.validators import ELEMENTS, readback_inputs, target_tables
from auditflow.sources.scans import with_document


def duck_print(digits: str) -> str:
    """Eight sums over the 64 hex digits of a hash, as in the order-free print."""
    return " || ".join(f"lpad(lower(to_hex(CAST(sum(CAST('0x' || substr({digits}, {8 * i + 1}, 8) AS BIGINT)) AS BIGINT))), 16, '0')" for i in range(8))


@query("L1_annotation_import_plan", f"""
WITH {SCALED}, {FOUND}, n AS (SELECT *, row_number() OVER (PARTITION BY path, page ORDER BY pos, id) AS n FROM sc), e AS (SELECT entity_id, count(*) FILTER (WHERE rule_code <> 'box_out_of_bounds') AS errors, count(*) AS problems FROM found GROUP BY 1)
SELECT path, page, CAST((n - 1) // 32 AS BIGINT) AS segment, count(*) AS n_items, round(min(ph * scale), 6) AS canvas_height, round(sum(x * scale), 3) AS left_sum, round(sum(y * scale), 3) AS top_sum,
  (SELECT count(*) FROM found WHERE rule_code <> 'box_out_of_bounds') AS error_count FROM n GROUP BY 1, 2, 3""")
def _(t):
    plan = L.annotation_import_plan(t.fx_annotation, t.fx_page, t.fx_media, size=32)
    rows = plan.pages.select(
        "path", "page", "segment", "n_items", F.round("canvas_height", 6).alias("canvas_height"),
        F.round(F.aggregate("annotations.left_px", F.lit(0.0), lambda a, v: a + v), 3).alias("left_sum"),
        F.round(F.aggregate("annotations.top_px", F.lit(0.0), lambda a, v: a + v), 3).alias("top_sum"))
    return rows.crossJoin(F.broadcast(plan.summary.select("error_count")))


# A capture as JSON text, built row by row; the older capture of a page has no text.
CAPTURES = """
SELECT doc_id AS catalog_id, concat('1814-', doc_id, '-', age, '.json') AS path, CASE age WHEN 0 THEN TIMESTAMP '2024-05-02 00:00:00' ELSE TIMESTAMP '2024-05-01 00:00:00' END AS captured_at, to_json(named_struct(
 'snapshot', named_struct('identity', named_struct('catalogName', concat(source, repeat('n', CAST(n_chars % 20 AS INT)))),
 'blocks', filter(array(
   named_struct('id', doc_id*10 + 1, 'template_data_content', named_struct('name', '2-对话', 'elements', array(named_struct('id', 'e1', 'type', 'text', 'name', '一级标题（中文）', 'content', concat('<p>', source, '</p>'), 'child_list', none), named_struct('id', 'e2', 'type', 'text', 'name', '一级标题（英文）', 'content', concat(lang, ' &amp; ', n_chars), 'child_list', none)))),
   named_struct('id', doc_id*10 + 2, 'template_data_content', named_struct('name', '3-口语学习路径', 'elements', array(named_struct('id', 'e3', 'type', 'text', 'name', '一级标题（英文）', 'content', concat('Path<br>', lang), 'child_list', none), named_struct('id', 'e4', 'type', 'text', 'name', '一级标题（中文）', 'content', concat('学习 ', source), 'child_list', none)))),
   named_struct('id', doc_id*10 + 3, 'template_data_content', named_struct('name', '4-单词和句型', 'elements', array(
     named_struct('id', 'g1', 'type', 'group', 'name', '句型', 'content', '', 'child_list', array(named_struct('id', 'e5', 'type', 'text', 'name', '文本 框', 'content', concat('<p>', replace(CASE age WHEN 0 THEN text ELSE '' END, '\\n', '</p><p>'), '</p>')))),
     named_struct('id', 'g2', 'type', 'group', 'name', '单词', 'content', '', 'child_list', array(named_struct('id', 'e6', 'type', 'text', 'name', '文本框', 'content', concat('<ul><li>', lang, '</li><li>', source, '</li> <li>three</li>', CASE WHEN n_chars % 2 = 0 THEN '<li>four</li>' ELSE '' END, '</ul>')),
       named_struct('id', 'e7', 'type', 'text', 'name', '中文翻译', 'content', concat('一<br>二<br/>三', CASE WHEN n_chars % 3 <> 0 THEN '<br>四' ELSE '' END))))))),
   named_struct('id', doc_id*10 + 4, 'template_data_content', named_struct('name', CASE WHEN doc_id % 50 <> 0 THEN '5-Write' ELSE 'x' END, 'elements', array(named_struct('id', 'e8', 'type', 'image', 'name', 'i', 'content', '', 'child_list', none))))), b -> true),
 'elementIndex', transform(sequence(1, 8), i -> named_struct('elementId', concat('m', i), 'name', element_at(array('按钮-磨耳朵', '按钮-看口语视频', '按钮-听句型讲解', '按钮-单词巧记', '按钮-句型巧练', '按钮-AI口语跟读测评', '按钮-口语PK', '打印'), i))),
 'digitalModules', named_struct('items', transform(sequence(1, CASE WHEN doc_id % 40 = 3 THEN 7 ELSE 8 END), i -> named_struct('elementId', concat('m', i), 'normalized', named_struct('type', element_at(array(77, 78, 78, 79, 82, 79, 87, 84), i), 'modelId', doc_id*100 + i)))),
 'completeness', named_struct('warnings', filter(array(named_struct('code', 'FONT_MAPPING_EMPTY', 'target', named_struct('elementId', CAST(NULL AS STRING))), CASE WHEN doc_id % 2 = 0 THEN named_struct('code', 'TEXT_LOST', 'target', named_struct('elementId', CASE WHEN doc_id % 5 = 0 THEN 'e5' ELSE 'x9' END)) END,
   CASE WHEN doc_id % 9 = 0 THEN named_struct('code', 'MODULE_STALE', 'target', named_struct('elementId', 'm4')) END), w -> w IS NOT NULL))))) AS raw
FROM (SELECT *, CAST(NULL AS ARRAY<STRUCT<id: STRING, type: STRING, name: STRING, content: STRING>>) AS none, explode(array(0, 1)) AS age FROM documents)"""


def captures(t):
    return with_document(t.sql(CAPTURES)).drop("raw", "parse_error")


@query("L2_source_manifest", f"""
WITH {CATALOG}, o AS (SELECT doc_id AS catalog_id, quality FROM labels),
 f AS (SELECT tx.catalog_id, title_en, sentences, coalesce(quality = 1 AND tx.catalog_id % 11 <> 0 AND tx.catalog_id % 7 <> 0, false) AS ok_s, o.catalog_id IS NOT NULL AS listed, n_relevant FROM tx JOIN wc USING (catalog_id) LEFT JOIN o USING (catalog_id))
SELECT CAST(catalog_id AS STRING) AS catalog_id, title_en, CASE WHEN ok_s THEN 3 ELSE len(sentences) END AS n_sentences,
  CASE WHEN ok_s THEN 'resolved_from_explicit_source_override' WHEN len(sentences) BETWEEN 2 AND 5 THEN 'resolved_from_source_structure' ELSE 'needs_visual_or_semantic_resolution' END AS sentence_status,
  n_relevant - CASE WHEN listed AND catalog_id % 10 = 0 THEN 1 ELSE 0 END = 0 AS scoped_complete FROM f
UNION ALL SELECT 'missing ' || CAST(s_suppkey - 1000000 AS STRING), NULL, NULL, NULL, NULL FROM supplier""")
def _(t):
    wanted = t.sql("SELECT doc_id AS catalog_id FROM documents UNION ALL SELECT s_suppkey - 1000000 FROM supplier")
    out = L.source_manifest(captures(t), wanted, t.sql(OVERRIDE_ROWS))
    rows = out.catalogs.select(
        F.col("catalog_id").cast("string").alias("catalog_id"), "title_en", F.size("sentences").alias("n_sentences"), "sentence_status", "scoped_complete")
    lost = out.missing.select(F.concat(F.lit("missing "), F.col("catalog_id").cast("string")).alias("catalog_id"))
    return rows.unionByName(lost, allowMissingColumns=True)


@query("L3_variant_profile", f"""
WITH {CATALOG}, r AS (SELECT tx.catalog_id, len(sentences) AS ns, list_max(list_transform(sentences, lambda s: length(s))) AS lg, len(en) AS ne, len(zh) AS nz, length(d.source) + d.n_chars % 20 AS tl FROM tx JOIN documents d ON d.doc_id = tx.catalog_id)
SELECT 'sentence_count' AS metric, CAST(ns AS STRING) AS key, count(*) AS value FROM r GROUP BY ns
UNION ALL SELECT unnest(['english_words', 'chinese_words']), CAST(catalog_id AS STRING), unnest([ne, nz]) FROM r WHERE ne <> 4 OR nz <> 4
UNION ALL (SELECT 'longest_title', CAST(catalog_id AS STRING), tl FROM r ORDER BY tl DESC, catalog_id LIMIT 1) UNION ALL (SELECT 'longest_sentence', CAST(catalog_id AS STRING), lg FROM r ORDER BY lg DESC, catalog_id LIMIT 1)""")
def _(t):
    return L.variant_profile(captures(t))


C_PAGES = "SELECT o_custkey AS book_id, o_orderkey AS pos, o_orderkey AS page_id, CASE o_orderstatus WHEN 'P' THEN '能力达标A' ELSE '学习之旅' || CAST(o_orderkey AS STRING) || '  ' || o_orderpriority END AS name FROM orders"
C_BLOCKS = "SELECT l_orderkey AS page_id, l_linenumber*100000000 + l_partkey*1000 + l_suppkey % 1000 AS pos, l_orderkey*10000000000 + l_linenumber*100000000 + l_partkey*1000 + l_suppkey % 1000 AS block_id, CASE l_linenumber WHEN 1 THEN 10042 WHEN 2 THEN 10043 WHEN 3 THEN 10045 WHEN 4 THEN 10048 WHEN 5 THEN 10049 WHEN 6 THEN 10050 ELSE 11542 END AS template_id FROM lineitem"
C_RICH = "SELECT l_orderkey*10000000000 + l_linenumber*100000000 + l_partkey*1000 + l_suppkey % 1000 AS block_id, 1 AS pos, CASE WHEN l_suppkey % 3 = 0 THEN '关键点' ELSE repeat('x', 85) END AS plain_text FROM lineitem UNION ALL SELECT l_orderkey*10000000000 + l_linenumber*100000000 + l_partkey*1000 + l_suppkey % 1000, 2, CASE WHEN l_partkey % 2 = 0 THEN ' guide ' ELSE '' END FROM lineitem"


@query("L4_course_manifest", f"""
WITH p AS ({C_PAGES}), b AS ({C_BLOCKS}), r AS ({C_RICH}),
 a AS (SELECT page_id, arg_min(block_id, pos) FILTER (WHERE template_id = 10042) AS problem_block, arg_min(block_id, pos) FILTER (WHERE template_id = 10043) AS key_block, arg_min(block_id, pos) FILTER (WHERE template_id = 11542) AS content_block FROM b GROUP BY 1),
 g AS (SELECT a.page_id, coalesce(arg_min(trim(plain_text), r.pos) FILTER (WHERE trim(plain_text) NOT IN ('', '关键点') AND length(trim(plain_text)) <= 80), arg_min(trim(plain_text), r.pos) FILTER (WHERE trim(plain_text) <> '关键点')) AS method_guide FROM a JOIN r ON r.block_id = a.key_block GROUP BY 1),
 l AS (SELECT *, CASE WHEN name LIKE '能力%' THEN 'ability' ELSE 'normal' END AS route, lag(name) OVER (PARTITION BY book_id ORDER BY pos) AS prev FROM p),
 u AS (SELECT *, sum(CASE WHEN route = 'normal' AND prev LIKE '能力%' THEN 1 ELSE 0 END) OVER (PARTITION BY book_id ORDER BY pos) AS unit FROM l),
 n AS (SELECT book_id, unit, trim(regexp_replace(name, '^学习之旅\\d+\\s*', '')) AS topic, row_number() OVER (PARTITION BY book_id, unit ORDER BY pos DESC) AS back FROM u WHERE route = 'normal'),
 t AS (SELECT x.page_id, string_agg(n.topic, '|' ORDER BY back) AS topics, count(n.topic) AS k FROM u x LEFT JOIN n ON n.book_id = x.book_id AND n.unit = x.unit AND back <= 5 WHERE x.route = 'ability' GROUP BY 1)
SELECT u.page_id, u.route, CASE WHEN u.route = 'ability' THEN '能力达标A' ELSE trim(regexp_replace(u.name, '^学习之旅\\d+\\s*', '')) END AS topic, problem_block, content_block, method_guide, coalesce(topics, '') AS topics,
  CASE WHEN u.route = 'ability' THEN CASE WHEN k = 5 THEN 'resolved' ELSE 'needs_review' END END AS status FROM u LEFT JOIN a USING (page_id) LEFT JOIN g USING (page_id) LEFT JOIN t USING (page_id)""".replace("\\\\", "\\"))
def _(t):
    pages, _ = L.course_manifest(t.sql(C_PAGES), t.sql(C_BLOCKS), t.sql(C_RICH))
    return pages.select("page_id", "route", "topic", "problem_block", "content_block", "method_guide", F.coalesce(F.array_join("topics", "|"), F.lit("")).alias("topics"), "status")


@query("L4_course_variants", f"""
WITH b AS ({C_BLOCKS}) SELECT page_id, block_id AS prompt_block, (SELECT min(c.block_id) FROM b c WHERE c.page_id = b.page_id AND c.pos > b.pos AND c.template_id = 10049) AS analysis_block,
  (SELECT min(c.block_id) FROM b c WHERE c.page_id = b.page_id AND c.pos > b.pos AND c.template_id = 10050) AS key_block FROM b WHERE template_id = 10048""")
def _(t):
    _, variants = L.course_manifest(t.sql(C_PAGES), t.sql(C_BLOCKS), t.sql(C_RICH))
    return variants


TIMELINE = "SELECT l_orderkey AS page_id, l_linenumber*100000000 + l_partkey*1000 + l_suppkey % 1000 AS pos, CASE l_returnflag WHEN 'A' THEN 'exercise' WHEN 'R' THEN 'course' ELSE 'text' END AS kind, l_partkey AS item_id FROM lineitem"


@query("L4_paired_courses", f"""
WITH b AS ({TIMELINE}) SELECT page_id, item_id AS exercise_id, (SELECT arg_min(c.item_id, c.pos) FROM b c WHERE c.page_id = b.page_id AND c.pos > b.pos AND c.kind = 'course') AS course_id FROM b WHERE kind = 'exercise'""")
def _(t):
    pages = t.fx_block.where("role <> 'system'").selectExpr(
        "page_id AS book_id", "pos", "pos DIV 2 AS sequence", "CASE role WHEN 'user' THEN 'practice' ELSE 'analysis' END AS kind", "text AS topic")
    _, courses = L.paired_course_manifest(pages, t.sql(TIMELINE))
    return courses


@query("L5_source_plan", f"""
WITH c AS (SELECT o_custkey, max(o_orderkey) AS o FROM orders GROUP BY 1), pb AS ({PLAN_BLOCKS}), pm AS ({PLAN_MODULES}),
 b AS (SELECT c.o_custkey AS page_id, count(DISTINCT CASE WHEN name <> 'other' THEN name END) AS roles FROM c JOIN pb ON pb.page_id = c.o GROUP BY 1),
 m AS (SELECT c.o_custkey AS page_id, count(DISTINCT CASE WHEN module_type = 77 THEN 'a' WHEN module_type = 79 THEN 'c' WHEN module_type = 87 THEN CAST(agent_id AS STRING) END) AS mods FROM c JOIN pm ON pm.page_id = c.o GROUP BY 1),
 e AS (SELECT c.o_custkey AS page_id, bool_or(name LIKE '2-英%') AS art FROM c JOIN pb ON pb.page_id = c.o GROUP BY 1)
SELECT page_id, 11 - roles - mods - CASE WHEN art THEN 1 ELSE 0 END AS n_missing FROM b JOIN m USING (page_id) JOIN e USING (page_id)""")
def _(t):
    caps = t.orders.selectExpr("o_custkey AS page_id", "o_orderkey AS capture_id", "o_orderkey AS captured_at")
    tag = lambda text: t.sql(text).withColumnRenamed("page_id", "capture_id")
    plans, _ = L.reading_plan(caps, tag(PLAN_BLOCKS), t.sql(PLAN_RICH), tag(PLAN_MODULES))
    return plans.select("page_id", F.size("missing").cast("bigint").alias("n_missing"))


@query("L6_build_provenance", f"""
WITH s AS (SELECT o_custkey AS b, o_orderkey AS source_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders WHERE o_orderstatus = 'F'),
 g AS (SELECT o_custkey AS b, o_orderkey AS target_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders WHERE o_orderstatus = 'O'),
 z AS (SELECT target_id, source_id FROM s JOIN g USING (b, n) WHERE target_id % 10 <> 0 AND target_id % 7 <> 0), {BINDING_SQL},
 h AS (SELECT *, 'sha256:' || sha256('{{"entity_id":"' || entity_id || '","entity_kind":"' || entity_kind || '","page_id":"' || page_id || '","rule_id":"' || rule_id || '","status":"' || status || '"}}') AS bh FROM bi),
 k AS (SELECT page_id, count(*) AS n_bindings, count(*) FILTER (WHERE status = 'applied') AS n_applied, {duck_print("substr(bh, 8)")} AS bindings_print FROM h GROUP BY 1),
 v AS (SELECT l_orderkey AS run_id, bool_or(l_linenumber = 1) AND min(CASE WHEN l_linenumber = 1 THEN l_returnflag END) = 'A' AND count(*) FILTER (WHERE l_linenumber = 1) = 1 AS passed FROM lineitem GROUP BY 1),
 f AS (SELECT CAST(z.target_id AS STRING) AS run_id, CAST(source_id AS STRING) AS source_id, n_bindings, n_applied, bindings_print, NOT coalesce(passed, false) AS restricted FROM z JOIN k ON k.page_id = CAST(z.target_id AS STRING) LEFT JOIN v ON v.run_id = z.target_id)
SELECT *, 'sha256:' || sha256('{{"bindings_print":"' || bindings_print || '","n_applied":' || CAST(n_applied AS STRING) || ',"n_bindings":' || CAST(n_bindings AS STRING) || ',"restricted":' || CAST(restricted AS STRING) || ',"run_id":"' || run_id || '","source_id":"' || source_id || '"}}') AS integrity_hash FROM f""")
def _(t):
    page = lambda s: t.orders.where(F.col("o_orderstatus") == s).selectExpr("o_custkey AS book_id", "o_orderkey AS pos", "o_orderkey AS page_id")
    snaps = t.orders.select(
        F.col("o_orderkey").alias("page_id"), (F.col("o_custkey") % 5).alias("pack_id"), F.create_map(F.lit("blocks"), F.col("o_orderkey") % 10 != 0, F.lit("fonts"), F.lit(False)).alias("sections"),
        F.when(F.col("o_orderkey") % 7 == 0, F.array(F.lit("BLOCK_LOST"))).otherwise(F.array(F.lit("FONT_MAPPING_EMPTY"))).alias("warnings"))
    rules = t.nation.selectExpr("n_nationkey AS rule_id", "n_regionkey AS pack_id")
    applied = t.lineitem.groupBy(F.col("l_orderkey").alias("page_id"), (F.col("l_suppkey") % 25).alias("rule_id")).agg(F.min("l_partkey").alias("block_id"))
    required = t.sql("SELECT o_orderkey AS run_id, 'acceptance:c1' AS required_key, 'c1' AS id, CAST(NULL AS STRING) AS rule_id FROM orders")
    reported = t.sql("SELECT l_orderkey AS run_id, 'c' || CAST(l_linenumber AS STRING) AS id, CAST(NULL AS STRING) AS rule_id, CASE l_returnflag WHEN 'A' THEN 'passed' ELSE 'failed' END AS status FROM lineitem")
    return L.build_provenance(page("F"), page("O"), snaps, rules, applied, required, reported)


@query("L7_verify_readbacks", "SELECT doc_id AS run_id, doc_id % 7 = 0 AS readback_valid, doc_id % 7 = 0 AS receipt_valid, doc_id % 7 = 0 AS has_receipt FROM documents")
def _(t):
    index, _ = L.verify_readbacks(*readback_inputs(t), "2024-05-01T00:00:00.000Z")
    return index.select("run_id", "readback_valid", "receipt_valid", F.col("receipt").isNotNull().alias("has_receipt"))


ROLE_LIST = "array('source', 'template', 'target_before', 'target_after', 'save_receipt', 'provenance_readback', 'acceptance_report')"


@query("L8_forward_evidence", """
WITH x AS (SELECT l.doc_id, count(d.doc_id) AS n, max(d.lang) FILTER (WHERE d.doc_id = l.doc_id + 2) AS b, max(d.lang) FILTER (WHERE d.doc_id = l.doc_id + 3) AS a FROM labels l LEFT JOIN documents d ON d.doc_id BETWEEN l.doc_id AND l.doc_id + 6 GROUP BY 1)
SELECT CAST(doc_id AS STRING) AS case_id, 7 - n AS n_missing, coalesce(a <> b, false) AS wrong_target,
  CASE WHEN doc_id % 13 = 0 AND doc_id IN (SELECT doc_id FROM documents) THEN 1 ELSE 0 END AS n_sha, CASE WHEN doc_id % 5 = 0 AND doc_id + 1 IN (SELECT doc_id FROM documents) THEN 1 ELSE 0 END AS n_hash FROM x""")
def _(t):
    artifacts = t.documents.select(F.concat(F.lit("a/"), F.col("doc_id").cast("string")).alias("path"), F.to_json(F.struct("doc_id", F.col("lang").alias("book_id"), "text")).alias("raw"))
    cases = t.sql(f"SELECT doc_id AS case_id, i, role FROM (SELECT doc_id, posexplode({ROLE_LIST}) AS (i, role) FROM labels)")
    before = t.documents.select((F.col("doc_id") - 2).alias("case_id"), "lang")
    cases = cases.join(before, "case_id", "left").select(
        "case_id", "role", F.concat(F.lit("a/"), (F.col("case_id") + F.col("i")).cast("string")).alias("path"),
        F.when(F.col("role").isin("target_before", "target_after"), F.col("lang")).alias("linked_id"))
    # What the cases claim: the right hashes, but for some sources and templates.
    true_hashes = artifacts.select("path", F.sha2("raw", 256).alias("sha"), canonical_hash("raw").alias("hash"))
    wrong_sha = (F.col("role") == "source") & (F.col("case_id") % 13 == 0)
    wrong_hash = (F.col("role") == "template") & (F.col("case_id") % 5 == 0)
    cases = cases.join(true_hashes, "path", "left").select(
        "case_id", "role", "path", "linked_id", F.when(wrong_sha, "0").otherwise(F.col("sha")).alias("artifact_sha256"),
        F.when(wrong_hash, "sha256:0").otherwise(F.col("hash")).alias("claimed_hash"))
    links, found = L.forward_evidence(cases, artifacts)
    per = found.groupBy(F.col("entity_id").alias("case_id")).agg(
        *[F.count(F.when(F.col("rule_code") == code, 1)).alias(n) for code, n in (
            ("artifact_missing", "n_missing"), ("artifact_sha_mismatch", "n_sha"), ("canonical_hash_mismatch", "n_hash"))],
        F.max(F.col("rule_code") == "linked_id_absent").alias("w"))
    every = links.select(F.col("case_id").cast("string").alias("case_id")).distinct()
    return every.join(per, "case_id", "left").select("case_id", *[F.coalesce(n, F.lit(0)).alias(n) for n in ("n_missing", "n_sha", "n_hash")], F.coalesce("w", F.lit(False)).alias("wrong_target"))


@query("L9_target_verification", f"""
SELECT count(*) FILTER (WHERE o_orderkey % 17 <> 15) AS page_count, CAST(sum(CASE o_orderkey % 17 WHEN 15 THEN 0 WHEN 4 THEN 7 ELSE 8 END) AS BIGINT) AS module_total, count(*) FILTER (WHERE o_orderkey % 17 NOT IN (0, 15)) AS failure_count,
  min(o_orderkey + 1) FILTER (WHERE o_orderkey % 17 <> 15) AS first_page, max(o_orderkey + 1) FILTER (WHERE o_orderkey % 17 <> 15) AS last_page FROM orders""")
def _(t):
    plans, pages, modules = target_tables(t)
    caps = pages.withColumns({"capture_id": F.lit(2), "captured_at": F.lit(20)}).unionByName(
        pages.withColumns({"capture_id": F.lit(1), "captured_at": F.lit(10), "dirty": F.lit(True)}))
    report, _ = L.target_verification(plans, caps, modules, "500", ELEMENTS, "mx")
    return report


# A batch over orders: items of one customer share logical work.  Fixed shares of them drift, fail, repeat work or show a wrong token.
B_ITEMS = """SELECT o_orderkey AS item_id, o_orderkey AS position, o_custkey AS g, CASE WHEN o_orderkey % 3 = 0 THEN 's' || CAST(o_custkey AS STRING) || '-' || CAST(o_orderkey % 2 AS STRING) END AS source_snapshot_hash,
  't' AS template_snapshot_hash, 'r' AS rule_pack_hash, 'x' AS resolved_template_id, 'b' || CAST(o_custkey AS STRING) AS stable_identity, 'whole_book' AS catalog_scope, 'h' || CAST(o_orderkey % 3 AS STRING) AS target_before_hash,
  'p' || CAST(o_custkey AS STRING) AS prospective, 'l' || CAST(CASE WHEN o_custkey % 40 = 7 AND o_orderkey % 4 = 0 THEN o_custkey + 1 ELSE o_custkey END AS STRING) AS lock_key FROM orders"""
B_REGISTRY = """SELECT DISTINCT o_custkey AS g, 's' || CAST(o_custkey AS STRING) || '-0' AS source, CASE o_custkey % 10 WHEN 0 THEN 'verified' WHEN 1 THEN 'applied' ELSE 'superseded' END AS status,
  'elsewhere' AS owner, CASE WHEN o_custkey % 10 = 0 THEN 'h0' END AS verified_hash FROM orders WHERE o_custkey % 10 <= 2"""
B_EVENTS = """SELECT CAST(pos AS BIGINT) * 1000000000 + item_id AS seq, item_id, g, CASE WHEN x < 4 THEN 'failed' WHEN x < 7 THEN 'outcome_unknown' WHEN x = 7 THEN 'needs_review' WHEN x = 8 THEN 'conflict'
    ELSE CASE pos % 6 WHEN 0 THEN 'planned' WHEN 1 THEN 'preflighted' WHEN 2 THEN 'authorize' WHEN 3 THEN 'applied' WHEN 4 THEN 'saved' ELSE 'verified' END END AS op,
  x % 31 <> 30 AS evidence_ok, x % 2 = 0 AS recovery, 'because ' || CAST(x AS STRING) AS reason, 's' || CAST(g AS STRING) || '-' || CAST((item_id + CASE WHEN pos > 7 THEN 1 ELSE 0 END) % 2 AS STRING) AS source_snapshot_hash,
  't' AS template_snapshot_hash, 'r' AS rule_pack_hash, CASE WHEN x % 23 = 22 THEN 'y' ELSE 'x' END AS resolved_template_id, 'h' || CAST(CASE WHEN x % 11 = 10 THEN 1 ELSE g % 2 END AS STRING) AS target_before_hash,
  'k' || CAST(CASE WHEN x % 17 = 16 THEN 0 ELSE pos - pos % 6 END AS STRING) AS token, CASE WHEN x % 19 = 18 THEN 'o2|n2' ELSE 'o1|n1' END AS holder, 'h' || CAST(x % 2 AS STRING) AS result_hash
FROM (SELECT o_orderkey AS item_id, o_custkey AS g, line * 3 + j AS pos, (o_orderkey * 7 + (line * 3 + j) * 13 + o_custkey) % 100 AS x
  FROM (SELECT DISTINCT l_orderkey, l_linenumber - 1 AS line FROM lineitem) AS l JOIN orders ON o_orderkey = l_orderkey CROSS JOIN (SELECT 0 AS j UNION ALL SELECT 1 UNION ALL SELECT 2) AS three) AS made"""
B_ALLOWED = """MAP {'pending': ['planned', 'needs_review', 'failed'], 'planned': ['preflighted', 'needs_review', 'conflict', 'failed', 'outcome_unknown'],
  'preflighted': ['applied', 'needs_review', 'conflict', 'failed', 'outcome_unknown'], 'applied': ['saved', 'needs_review', 'conflict', 'failed', 'outcome_unknown'],
  'saved': ['verified', 'needs_review', 'conflict', 'failed', 'outcome_unknown'], 'verified': [], 'verified_skip': [], 'needs_review': ['planned'], 'conflict': ['planned'], 'failed': ['planned'],
  'outcome_unknown': ['applied', 'saved', 'verified', 'needs_review', 'failed']}"""
_THING = "STRUCT(st VARCHAR, why VARCHAR, att BIGINT, rej BIGINT, key VARCHAR, ident VARCHAR, target VARCHAR, tok VARCHAR, tkey VARCHAR, holder VARCHAR)"
_CLAIM = "STRUCT(status VARCHAR, owner VARCHAR, hash VARCHAR)"
# One event of each customer a step: i is the item before it, k the record of the key it asks for.
B_REPLAY = f"""
WITH RECURSIVE i AS ({B_ITEMS}), q AS ({B_REGISTRY}),
clash AS (SELECT item_id, max(CASE WHEN ls > 1 AND ps > 1 THEN 'prospective_many_locks' WHEN ls > 1 THEN 'prospective_many_locks' WHEN ps > 1 THEN 'lock_many_prospectives' END) AS clash
  FROM (SELECT item_id, prospective, lock_key FROM i) JOIN (SELECT prospective, count(DISTINCT lock_key) AS ls FROM i GROUP BY 1) USING (prospective) JOIN (SELECT lock_key, count(DISTINCT prospective) AS ps FROM i GROUP BY 1) USING (lock_key) GROUP BY 1),
w AS (SELECT i.*, clash, CASE WHEN i.source_snapshot_hash IS NOT NULL THEN min(item_id) OVER (PARTITION BY i.source_snapshot_hash) END AS win, q.status, q.verified_hash FROM i JOIN clash USING (item_id) LEFT JOIN q ON q.source = i.source_snapshot_hash),
f AS (SELECT *, CASE WHEN status = 'verified' THEN CASE WHEN verified_hash = target_before_hash THEN 'verified_skip' ELSE 'conflict' END WHEN item_id <> win OR status = 'applied' THEN 'conflict' ELSE 'pending' END AS st,
  CASE WHEN status = 'verified' THEN CASE WHEN verified_hash = target_before_hash THEN 'logical_work_already_verified' ELSE 'verified_identity_target_drift' END
       WHEN item_id <> win THEN 'duplicate_logical_work_in_ledger' WHEN status = 'applied' THEN 'logical_work_claimed_elsewhere' END AS why FROM w),
e AS (SELECT v.*, CAST(v.item_id AS VARCHAR) AS item, source_snapshot_hash || resolved_template_id AS ident, row_number() OVER (PARTITION BY g ORDER BY seq) AS n FROM ({B_EVENTS}) v JOIN (SELECT item_id FROM f WHERE clash IS NULL) USING (item_id)),
r(g, n, its, ks, seq, item, accepted, now) AS (
  SELECT g, CAST(0 AS BIGINT), map_from_entries(list((CAST(item_id AS VARCHAR), CAST(row(st, why, 0, 0, source_snapshot_hash, source_snapshot_hash || resolved_template_id, target_before_hash, NULL, NULL, NULL) AS {_THING})))),
    coalesce((SELECT map_from_entries(list((source, CAST(row(status, owner, verified_hash) AS {_CLAIM})))) FROM q WHERE q.g = f.g), CAST(MAP {{}} AS MAP(VARCHAR, {_CLAIM}))), CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS BOOLEAN), CAST(NULL AS {_THING})
  FROM f WHERE clash IS NULL GROUP BY g
  UNION ALL
  SELECT g, n, map_concat(its, MAP {{item: now}}), CASE WHEN accepted AND nk IS NOT NULL THEN map_concat(ks, MAP {{akey: nk}}) ELSE ks END, seq, item, accepted, now FROM (
   SELECT *, CASE WHEN NOT accepted THEN struct_update(i, rej := i.rej + 1)
      WHEN op = 'authorize' AND drift THEN struct_update(i, st := 'planned', why := 'pre_apply_fingerprint_drift', att := i.att + 1, tok := NULL)
      WHEN op = 'authorize' THEN struct_update(i, tok := token, tkey := i.key, holder := holder, why := NULL)
      WHEN op = 'preflighted' THEN struct_update(i, key := akey, ident := ident, target := target_before_hash, tok := NULL,
        st := CASE verdict WHEN 'skip' THEN 'verified_skip' WHEN 'mine' THEN 'preflighted' ELSE 'conflict' END,
        why := CASE verdict WHEN 'changed' THEN 'verified_identity_target_drift' WHEN 'conflict' THEN 'logical_work_claimed_elsewhere' END)
      ELSE struct_update(i, st := op, why := CASE WHEN op IN ('needs_review', 'conflict', 'failed', 'outcome_unknown') THEN reason END, att := i.att + CASE WHEN op = 'planned' THEN 1 ELSE 0 END,
        tok := CASE WHEN op = 'applied' OR i.st = 'outcome_unknown' THEN NULL ELSE i.tok END) END::{_THING} AS now,
     CASE WHEN verdict <> 'mine' THEN NULL WHEN op = 'preflighted' AND (k IS NULL OR k.owner <> item) THEN CAST(row('preflighted', item, NULL) AS {_CLAIM})
       ELSE CAST(row(CASE WHEN op = 'authorize' THEN CASE WHEN NOT drift THEN 'apply_authorized' WHEN ident <> i.ident THEN 'superseded' ELSE 'planned' END ELSE op END, k.owner, CASE WHEN op = 'verified' THEN result_hash ELSE k.hash END) AS {_CLAIM}) END AS nk
   FROM (SELECT *, legal AND (op IN ('preflighted', 'planned') OR akey IS NULL OR verdict = 'mine') AS accepted FROM (
    SELECT *, CASE WHEN op = 'preflighted' THEN CASE WHEN k IS NULL OR (k.status = 'superseded' AND k.owner <> item) OR (k.owner = item AND k.status IN ('planned', 'preflighted', 'apply_authorized')) THEN 'mine'
        WHEN k.status = 'verified' THEN CASE WHEN k.hash = target_before_hash THEN 'skip' ELSE 'changed' END ELSE 'conflict' END
      WHEN k.owner = item AND (op <> 'authorize' OR drift OR k.status IN ('planned', 'preflighted', 'apply_authorized')) THEN 'mine' ELSE 'foreign' END AS verdict FROM (
     SELECT *, ks[akey] AS k, op = 'authorize' AND (ident IS DISTINCT FROM i.ident OR target_before_hash IS DISTINCT FROM i.target) AS drift FROM (
      SELECT *, CASE WHEN op = 'preflighted' THEN source_snapshot_hash ELSE i.key END AS akey,
        CASE WHEN op = 'authorize' THEN i.st = 'preflighted' ELSE list_contains(allowed[i.st], op) AND evidence_ok AND (i.st <> 'outcome_unknown' OR recovery)
          AND (op <> 'applied' OR i.st = 'outcome_unknown' OR coalesce(i.tok = token AND i.tkey = i.key AND i.holder = holder, false)) END AS legal
      FROM (SELECT r.g, e.n, e.seq, r.its, r.ks, e.item, e.op, e.evidence_ok, e.recovery, e.reason, e.source_snapshot_hash, e.ident, e.target_before_hash, e.token, e.holder, e.result_hash, r.its[e.item] AS i, {B_ALLOWED} AS allowed
        FROM r JOIN e ON e.g = r.g AND e.n = r.n + 1)))))))"""


def _batch(t):
    from auditflow.functions.canon import idempotency_key
    registry = t.sql(B_REGISTRY).select(
        idempotency_key(F.col("source"), F.lit("t"), F.lit("r"), F.concat(F.lit("b"), F.col("g").cast("string")), F.lit("whole_book")).alias("idempotency_key"), "status", "owner", "verified_hash")
    return L.batch_ledger(t.sql(B_ITEMS).drop("g"), registry, t.sql(B_EVENTS).drop("g"))


@query("L10_batch_ledger", f"""{B_REPLAY},
l AS (SELECT item_id, coalesce((SELECT arg_max(r.now, r.n) FROM r WHERE r.item = CAST(f.item_id AS VARCHAR)), CAST(row(st, coalesce(clash, why), 0, 0, NULL, NULL, NULL, NULL, NULL, NULL) AS {_THING})) AS x FROM f)
SELECT CAST(item_id AS VARCHAR) AS item_id, x.st AS state, x.why AS reason, x.att AS attempt, x.rej AS n_rejected FROM l""")
def _(t):
    return _batch(t)[0]


@query("L10_batch_events", f"{B_REPLAY} SELECT seq, item AS item_id, now.st AS state, now.why AS reason, accepted FROM r WHERE n > 0")
def _(t):
    return _batch(t)[1].select("seq", "item_id", "state", "reason", "accepted")


_STATE = """sha256('{"k":' || CAST(k AS STRING) || ',"value":' || CASE WHEN v IS NULL THEN 'null' ELSE '"' || v || '"' END || '}')"""


@query("L11_refinement_plan", f"""
WITH m AS (SELECT coalesce(b.k, c.k, w.k) AS k, b.k IS NOT NULL AS bp, c.k IS NOT NULL AS cp, w.k IS NOT NULL AS wl, coalesce(w.is_delete, false) AS del, b.v AS bv, c.v AS cv, w.v AS wv
  FROM fx_base b FULL JOIN fx_cur c ON b.k = c.k FULL JOIN fx_want w ON w.k = coalesce(b.k, c.k)),
g AS (SELECT CASE WHEN del THEN '~' WHEN wl THEN wv WHEN bp THEN bv ELSE '~' END AS goal, CASE WHEN bp THEN bv ELSE '~' END AS base, CASE WHEN cp THEN cv ELSE '~' END AS now FROM m),
x AS (SELECT count(*) FILTER (WHERE goal <> base AND now <> goal AND now = base) AS safe, count(*) FILTER (WHERE goal = base OR now = goal) AS noop, count(*) FILTER (WHERE goal <> base AND now <> goal AND now <> base) AS conflict FROM g)
SELECT *, (SELECT {duck_print(_STATE)} FROM fx_cur) AS current_print, (SELECT {duck_print(_STATE)} FROM fx_want) AS desired_print FROM x""")
def _(t):
    as_value = lambda df: df.withColumnRenamed("v", "value")
    _, summary = L.refinement_plan(as_value(t.fx_base), as_value(t.fx_cur), as_value(t.fx_want), ["k"])
    return summary


@query("L12_source_recall", f"""
WITH {NORMAL}, p AS (SELECT q.query_id, c.candidate_id, {SCORE} FROM nq q CROSS JOIN nc c), s AS (SELECT * FROM p WHERE NOT rejected),
 b AS (SELECT query_id, max(raw_score) AS top_score FROM s GROUP BY 1), n AS (SELECT b.query_id, top_score, count(*) AS n_top, min(candidate_id) AS cid FROM b JOIN s ON s.query_id = b.query_id AND s.raw_score = b.top_score GROUP BY 1, 2)
SELECT nq.query_id, top_score, coalesce(n_top, 0) AS n_top, coalesce(top_score > 0 AND n_top = 1, false) AS unique_top, CASE WHEN top_score > 0 AND n_top = 1 THEN cid END AS top_candidate_id FROM nq LEFT JOIN n USING (query_id)""")
def _(t):
    return L.source_recall(t.fx_query, t.fx_candidate).drop("selected_candidate_id")
