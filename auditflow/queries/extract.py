"""Extraction of catalogs, plans, bindings and readbacks."""

from pyspark.sql import functions as F

from auditflow.functions.canon import seal
from auditflow.operators import extract as B
from auditflow.queries import query
from auditflow.queries.texts import duck_lines


@query("B12_classify_blocks", """
SELECT p_partkey, CASE WHEN p_type LIKE 'ECON%' THEN 'dialogue' WHEN p_name LIKE '%ring' THEN 'words' WHEN CAST(p_size AS STRING) IN ('7', '8') THEN 'write' END AS role FROM part""")
def _(t):
    rules = [("dialogue", "p_type", "^ECON"), ("words", "p_name", "ring$"), ("write", "p_size", "^[78]$")]
    return B.classify_blocks(t.part, rules).select("p_partkey", "role")


@query("B14_normalize_modules", """
SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_partkey AS STRING) AS element_id, 60 + l_linenumber AS module_type, CASE WHEN l_tax > 0.02 THEN CAST(l_suppkey AS STRING) END AS model_id,
  CASE WHEN l_discount > 0.05 THEN '{"resourceId":' || CAST(l_suppkey AS STRING) || '}' ELSE '{}' END AS config FROM lineitem""")
def _(t):
    raw = t.sql("""SELECT l_orderkey, l_linenumber, l_partkey, parse_json(to_json(named_struct('elementId', CAST(l_partkey AS STRING), 'normalized',
      named_struct('type', 60 + l_linenumber, 'modelId', CASE WHEN l_tax > 0.02 THEN l_suppkey END,
        'config', CASE WHEN l_discount > 0.05 THEN named_struct('resourceId', l_suppkey) END)))) AS doc FROM lineitem""")
    return B.normalize_modules(raw).select(
        "l_orderkey", "l_linenumber", "l_partkey", "element_id", "module_type", "model_id", F.to_json("config").alias("config"))


CATALOG = f"""
el AS (SELECT catalog_id, element_id, {duck_lines('content')} AS l FROM fx_catelement),
tx AS (SELECT catalog_id, max(array_to_string(l, ' ')) FILTER (WHERE element_id = 'e2') AS title_en, max(array_to_string(l, ' ')) FILTER (WHERE element_id = 'e1') AS prompt_zh,
   max(array_to_string(l, ' ')) FILTER (WHERE element_id = 'e3') AS learning_en,
   any_value(l) FILTER (WHERE element_id = 'e5') AS sentences, any_value(l) FILTER (WHERE element_id = 'e6') AS en, any_value(l) FILTER (WHERE element_id = 'e7') AS zh FROM el GROUP BY 1),
wn AS (SELECT catalog_id, pos, code, element_id, coalesce(element_id IN ('e1','e2','e3','e4','e5','e6','e7','m1','m2','m3','m4','m5','m6','m7') OR (element_id = 'm8' AND catalog_id % 40 <> 3), false) AS relevant FROM fx_catwarning),
wc AS (SELECT catalog_id, count(*) FILTER (WHERE relevant) AS n_relevant, count(*) FILTER (WHERE NOT relevant) AS n_excluded FROM wn GROUP BY 1)"""


def catalog_tables(t):
    elements = t.sql("SELECT *, array(parent_name) AS parent_names FROM fx_catelement")
    return t.fx_catblock, elements, t.fx_catmodule, t.fx_catwarning


@query("B17_extract_catalog", f"""
WITH {CATALOG}
SELECT tx.catalog_id, title_en, prompt_zh, learning_en, len(sentences) AS n_sentences, sha256(array_to_string(sentences, '|')) AS sentence_text,
  CASE WHEN len(sentences) BETWEEN 2 AND 5 THEN 'resolved_from_source_structure' ELSE 'needs_visual_or_semantic_resolution' END AS sentence_status,
  array_to_string(en, '|') AS english, CASE WHEN len(zh) = 4 THEN array_to_string(list_slice(zh, 1, len(en)), '|') ELSE '' END AS chinese,
  CASE WHEN len(zh) = 4 THEN 'resolved_from_source_paragraphs' ELSE 'needs_visual_or_semantic_resolution' END AS word_pairing_status,
  tx.catalog_id*100 + 1 AS audio_model, array_to_string([tx.catalog_id*100 + 2, tx.catalog_id*100 + 3, tx.catalog_id*100 + 4, tx.catalog_id*100 + 5, tx.catalog_id*100 + 6, tx.catalog_id*100 + 7], ',') AS entries,
  CASE WHEN tx.catalog_id % 40 <> 3 THEN tx.catalog_id*100 + 8 END AS print_model, n_relevant, n_excluded, n_relevant = 0 AS scoped_complete,
  CAST(tx.catalog_id % 50 = 0 AS INT) + CAST(tx.catalog_id % 60 = 1 AS INT) + CAST(tx.catalog_id % 40 = 3 AS INT) AS n_violations
FROM tx JOIN wc USING (catalog_id)""")
def _(t):
    catalogs, _, found = B.extract_catalogs(*catalog_tables(t))
    n = found.groupBy(F.col("entity_id").alias("_e")).agg(F.count("*").alias("_n"))
    rows = catalogs.join(n, F.col("catalog_id").cast("string") == F.col("_e"), "left")
    return rows.select(
        "catalog_id", "title_en", "prompt_zh", "learning_en", F.size("sentences").alias("n_sentences"),
        F.sha2(F.array_join("sentences", "|"), 256).alias("sentence_text"), "sentence_status",
        F.array_join("words.english", "|").alias("english"), F.array_join("words.chinese", "|").alias("chinese"), "word_pairing_status",
        "audio_model", F.array_join(F.col("entries").cast("array<string>"), ",").alias("entries"), "print_model",
        "n_relevant", "n_excluded", "scoped_complete", F.coalesce("_n", F.lit(0)).cast("int").alias("n_violations"))


OVERRIDE_ROWS = """
SELECT doc_id AS catalog_id,
  CASE WHEN quality = 1 THEN CASE WHEN doc_id % 11 = 0 THEN array('a') ELSE array('a', 'b', source) END END AS sentences,
  CASE WHEN doc_id % 7 <> 0 THEN 'seen' ELSE '' END AS sentence_evidence,
  CASE WHEN doc_id % 3 = 0 THEN array('w1', 'w2', 'w3', 'w4') END AS words_english,
  CASE WHEN doc_id % 4 = 0 THEN CASE WHEN doc_id % 8 = 0 THEN array('甲', '乙', '丙', '丁') ELSE array('甲') END END AS words_chinese,
  CASE WHEN doc_id % 5 <> 0 THEN 'pairs' END AS word_pairing_evidence,
  CASE WHEN doc_id % 10 = 0 THEN array(named_struct('code', 'TEXT_LOST', 'target_element_id', 'e5', 'reason', 'ok')) END AS accept_relevant_warnings
FROM labels JOIN documents USING (doc_id)"""


@query("B18_apply_overrides", f"""
WITH {CATALOG}, o AS (SELECT l.doc_id AS catalog_id, quality, source FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
 f AS (SELECT tx.*, n_relevant, o.catalog_id AS oc, coalesce(quality = 1 AND tx.catalog_id % 11 <> 0 AND tx.catalog_id % 7 <> 0, false) AS ok_s,
   o.catalog_id IS NOT NULL AND tx.catalog_id % 3 = 0 AS has_en, o.catalog_id IS NOT NULL AND tx.catalog_id % 4 = 0 AS has_zh, source FROM tx JOIN wc USING (catalog_id) LEFT JOIN o USING (catalog_id)),
 g AS (SELECT *, has_zh AND catalog_id % 8 <> 0 AS bad_zh, has_zh AND catalog_id % 8 = 0 AND NOT has_en AND len(en) <> 4 AS short,
   (has_en OR has_zh) AND catalog_id % 5 = 0 AS no_ev FROM f),
 h AS (SELECT *, (has_en OR has_zh) AND NOT bad_zh AND NOT short AND NOT no_ev AS ok_w FROM g)
SELECT catalog_id, CASE WHEN ok_s THEN 'a|b|' || source ELSE array_to_string(sentences, '|') END AS sentences,
  CASE WHEN ok_s THEN 'resolved_from_explicit_source_override' WHEN len(sentences) BETWEEN 2 AND 5 THEN 'resolved_from_source_structure' ELSE 'needs_visual_or_semantic_resolution' END AS sentence_status,
  CASE WHEN ok_w AND has_en THEN 'w1|w2|w3|w4' ELSE array_to_string(en, '|') END AS english,
  CASE WHEN ok_w AND has_zh THEN '甲|乙|丙|丁' WHEN len(zh) = 4 THEN array_to_string(list_slice(zh, 1, CASE WHEN ok_w AND has_en THEN len(en) ELSE len(en) END), '|') ELSE '' END AS chinese,
  CASE WHEN ok_w THEN 'resolved_from_explicit_source_override' WHEN len(zh) = 4 THEN 'resolved_from_source_paragraphs' ELSE 'needs_visual_or_semantic_resolution' END AS word_pairing_status,
  n_relevant - CASE WHEN oc IS NOT NULL AND catalog_id % 10 = 0 THEN 1 ELSE 0 END AS n_relevant,
  n_relevant - CASE WHEN oc IS NOT NULL AND catalog_id % 10 = 0 THEN 1 ELSE 0 END = 0 AS scoped_complete,
  CAST(coalesce(quality_bad, 0) AS INT) AS n_violations
FROM (SELECT h.*, (SELECT CAST(q.quality = 1 AND h.catalog_id % 11 = 0 AS INT) + CAST(q.quality = 1 AND h.catalog_id % 7 = 0 AS INT) FROM labels q WHERE q.doc_id = h.catalog_id)
   + CAST(bad_zh AS INT) + CAST(short AS INT) + CAST(no_ev AS INT) AS quality_bad FROM h)""")
def _(t):
    catalogs, warnings, _ = B.extract_catalogs(*catalog_tables(t))
    out, _, found = B.apply_overrides(catalogs, warnings, t.sql(OVERRIDE_ROWS.replace("USING (doc_id)", "USING (doc_id)")))
    n = found.groupBy(F.col("entity_id").alias("_e")).agg(F.count("*").alias("_n"))
    return out.join(n, F.col("catalog_id").cast("string") == F.col("_e"), "left").select(
        "catalog_id", F.array_join("sentences", "|").alias("sentences"), "sentence_status",
        F.array_join("words.english", "|").alias("english"), F.array_join("words.chinese", "|").alias("chinese"), "word_pairing_status",
        "n_relevant", "scoped_complete", F.coalesce("_n", F.lit(0)).cast("int").alias("n_violations"))


@query("B19_seal", """
SELECT o_orderkey, 'sha256:' || sha256('{"o_custkey":' || CAST(o_custkey AS STRING) || ',"o_orderkey":' || CAST(o_orderkey AS STRING) || ',"o_orderstatus":' || CASE WHEN o_orderkey % 5 = 0 THEN 'null' ELSE '"' || o_orderstatus || '"' END || '}') AS integrity_hash FROM orders""")
def _(t):
    rows = t.orders.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderstatus")))
    return seal(rows, ["o_orderkey", "o_orderstatus", "o_custkey"], "integrity_hash").select("o_orderkey", "integrity_hash")


BINDING_SQL = """
pg AS (SELECT o_orderkey AS page_id, o_custkey % 5 AS pack_id FROM orders), ru AS (SELECT n_nationkey AS rule_id, n_regionkey AS pack_id FROM nation),
ap AS (SELECT l_orderkey AS page_id, l_suppkey % 25 AS rule_id, min(l_partkey) AS block_id FROM lineitem GROUP BY 1, 2),
bi AS (SELECT CAST(pg.page_id AS STRING) AS page_id, CAST(ru.rule_id AS STRING) AS rule_id, CASE WHEN block_id IS NULL THEN 'skipped' ELSE 'applied' END AS status,
  CASE WHEN block_id IS NULL THEN 'route' ELSE 'block' END AS entity_kind, CASE WHEN block_id IS NULL THEN 'route-' || CAST(ru.rule_id AS STRING) ELSE CAST(block_id AS STRING) END AS entity_id
  FROM pg JOIN ru USING (pack_id) LEFT JOIN ap ON ap.page_id = pg.page_id AND ap.rule_id = ru.rule_id)"""


def bindings(t):
    pages = t.orders.selectExpr("o_orderkey AS page_id", "o_custkey % 5 AS pack_id")
    rules = t.nation.selectExpr("n_nationkey AS rule_id", "n_regionkey AS pack_id")
    applied = t.lineitem.groupBy(F.col("l_orderkey").alias("page_id"), (F.col("l_suppkey") % 25).alias("rule_id")).agg(
        F.min("l_partkey").alias("block_id"))
    return B.build_bindings(rules, applied, pages)


@query("B20_rule_bindings", f"""
WITH {BINDING_SQL} SELECT *, 'sha256:' || sha256('{{"entity_id":"' || entity_id || '","entity_kind":"' || entity_kind || '","page_id":"' || page_id || '","rule_id":"' || rule_id || '","status":"' || status || '"}}') AS binding_hash FROM bi""")
def _(t):
    return bindings(t).drop("reason")


PLAN_BLOCKS = """
SELECT l_orderkey AS page_id, l_orderkey*1000000 + l_suppkey*1000 + l_linenumber*100 + l_partkey % 100 AS block_id, l_orderkey*1000000 + l_suppkey*1000 + l_linenumber*100 + l_partkey % 100 AS pos,
  CASE l_linenumber WHEN 1 THEN '2-英文文本' WHEN 2 THEN '3-翻译文本' WHEN 3 THEN '4-按钮' WHEN 4 THEN '5-一级标题' WHEN 5 THEN '7-按钮' WHEN 6 THEN '8-一级' ELSE 'other' END AS name FROM lineitem"""
PLAN_RICH = """
SELECT l_orderkey*1000000 + l_suppkey*1000 + l_linenumber*100 + l_partkey % 100 AS block_id, l_partkey AS pos, 'el' || CAST(l_partkey AS STRING) AS element_id,
  CASE WHEN l_tax < 0.04 THEN 'short ' ELSE 'much longer text ' END AS display_text FROM lineitem"""
PLAN_MODULES = """
SELECT l_orderkey AS page_id, l_orderkey*1000000 + l_suppkey*1000 + l_linenumber*100 + l_partkey % 100 AS pos, CASE l_suppkey % 4 WHEN 0 THEN 77 WHEN 1 THEN 87 WHEN 2 THEN 79 ELSE 80 END AS module_type,
  CASE WHEN l_partkey % 2 = 0 THEN 27 ELSE 34 END AS agent_id, l_suppkey AS model_id FROM lineitem"""
PLAN_SQL = f"""
pb AS ({PLAN_BLOCKS}), pr AS ({PLAN_RICH}), pm AS ({PLAN_MODULES}),
b AS (SELECT page_id, arg_min(block_id, pos) FILTER (WHERE name LIKE '2-英%') AS english, arg_min(block_id, pos) FILTER (WHERE name LIKE '3-%') AS translation, arg_min(block_id, pos) FILTER (WHERE name LIKE '4-%') AS button,
  arg_min(block_id, pos) FILTER (WHERE name LIKE '5-%') AS vocabulary, arg_min(block_id, pos) FILTER (WHERE name LIKE '7-%') AS mnemonic, arg_min(block_id, pos) FILTER (WHERE name LIKE '8-%') AS phonics FROM pb GROUP BY 1),
ar AS (SELECT page_id, element_id AS article, display_text FROM (SELECT b.page_id, pr.*, row_number() OVER (PARTITION BY b.page_id ORDER BY length(display_text) DESC, pos) AS rn FROM b JOIN pr ON pr.block_id = b.english) WHERE rn = 1),
m AS (SELECT page_id, arg_min(model_id, pos) FILTER (WHERE module_type = 77) AS audio, arg_min(model_id, pos) FILTER (WHERE module_type = 87 AND agent_id = 27) AS agent27,
  arg_min(model_id, pos) FILTER (WHERE module_type = 87 AND agent_id = 34) AS agent34, arg_min(model_id, pos) FILTER (WHERE module_type = 79) AS courseware FROM pm GROUP BY 1),
pl AS (SELECT b.page_id, english, translation, button, vocabulary, mnemonic, phonics, article, audio, agent27, agent34, courseware, rtrim(display_text) AS plain_text,
  array_to_string(list_filter([CASE WHEN english IS NULL THEN 'english' END, CASE WHEN translation IS NULL THEN 'translation' END, CASE WHEN button IS NULL THEN 'button' END, CASE WHEN vocabulary IS NULL THEN 'vocabulary' END,
   CASE WHEN mnemonic IS NULL THEN 'mnemonic' END, CASE WHEN phonics IS NULL THEN 'phonics' END, CASE WHEN article IS NULL THEN 'article' END, CASE WHEN audio IS NULL THEN 'audio' END, CASE WHEN agent27 IS NULL THEN 'agent27' END,
   CASE WHEN agent34 IS NULL THEN 'agent34' END, CASE WHEN courseware IS NULL THEN 'courseware' END], lambda x: x IS NOT NULL), ',') AS missing FROM b LEFT JOIN ar USING (page_id) LEFT JOIN m USING (page_id))"""


def plan(t):
    return B.source_plan(t.sql(PLAN_BLOCKS), t.sql(PLAN_RICH), t.sql(PLAN_MODULES))


@query("B21_source_plan", f"WITH {PLAN_SQL} SELECT * FROM pl")
def _(t):
    return plan(t).withColumn("missing", F.array_join("missing", ","))


RUNS = """
SELECT event_id AS element_id, array(
  named_struct('text', event_type, 'formats', named_struct('color', CASE event_id % 3 WHEN 0 THEN '#FE2E65' WHEN 1 THEN 'rgb(254,46, 101)' ELSE '#000000' END, 'link', 'http://x')),
  named_struct('text', props, 'formats', named_struct('color', CASE event_id % 5 WHEN 0 THEN 'rgb(254, 46, 101)' ELSE CAST(NULL AS STRING) END, 'link', CAST(NULL AS STRING)))) AS runs FROM events"""


@query("B22_emphasis_runs", """
SELECT event_id AS element_id, 0 AS pos, event_type AS text, CASE event_id % 3 WHEN 0 THEN '#fe2e65' ELSE 'rgb(254,46,101)' END AS color FROM events WHERE event_id % 3 <> 2
UNION ALL SELECT event_id, 1, props, 'rgb(254,46,101)' FROM events WHERE event_id % 5 = 0""")
def _(t):
    return B.emphasis_runs(t.sql(RUNS))


APPROVALS = """
SELECT doc_id AS run_id, CASE doc_id % 3 WHEN 0 THEN 'trial' WHEN 1 THEN 'batch' ELSE 'legacy_inferred' END AS mode, array(
  CASE WHEN quality = 1 THEN named_struct('text', 'yes', 'id', CAST(NULL AS STRING), 'type', CAST(NULL AS STRING), 'status', CAST(NULL AS STRING), 'confirmed_by', CAST(NULL AS STRING), 'n_evidence', 0)
   ELSE named_struct('text', CAST(NULL AS STRING), 'id', concat('a', doc_id), 'type', 'batch_authorization', 'status', CASE WHEN toxic = 1 THEN 'open' ELSE 'confirmed' END, 'confirmed_by', 'me', 'n_evidence', CAST(doc_id % 2 AS INT)) END) AS approvals FROM labels"""


@query("B23_normalize_approvals", """
SELECT entity_id, rule_code FROM (
 SELECT CAST(doc_id AS STRING) || '/a' || CAST(doc_id AS STRING) AS entity_id, unnest([CASE WHEN toxic = 1 THEN 'approval_unconfirmed' END, CASE WHEN doc_id % 2 = 0 THEN 'approval_evidence' END]) AS rule_code FROM labels WHERE quality = 0
 UNION ALL SELECT CAST(doc_id AS STRING), 'approval_of_mode_missing' FROM labels WHERE quality = 0 AND (toxic = 1 OR doc_id % 3 <> 1)) WHERE rule_code IS NOT NULL""")
def _(t):
    _, found = B.normalize_approvals(t.sql(APPROVALS))
    return found.select("entity_id", "rule_code")


@query("B24_module_readback", """
SELECT event_id, event_type AS module_type, CASE WHEN event_id % 3 = 0 THEN user_id WHEN event_id % 3 = 1 THEN user_id + 1 END AS source_book_id,
 CASE WHEN event_id % 3 = 0 THEN event_id WHEN event_id % 3 = 1 THEN event_id + 1 END AS source_catalog_id FROM events""")
def _(t):
    modules = t.sql("""SELECT event_id, event_type AS module_type, array(
       named_struct('catalog_content_en', CASE WHEN event_id % 3 = 0 THEN 'a' END, 'book_id', user_id, 'catalog_id', event_id),
       named_struct('catalog_content_en', CASE WHEN event_id % 3 <> 2 THEN 'b' END, 'book_id', user_id + 1, 'catalog_id', event_id + 1)) AS content FROM events""")
    return B.module_readback(modules)
