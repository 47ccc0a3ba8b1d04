"""Aggregations."""

from pyspark.sql import functions as F

from auditflow.operators import annotations as A
from auditflow.operators import report as R
from auditflow.queries import query

# The last descriptor of a page counts, and base names may occur in several folders.
LAST_PAGE = "(SELECT path, page, arg_max(width, pos) AS width, arg_max(height, pos) AS height FROM fx_page WHERE page > 0 GROUP BY path, page)"
MEDIA = "(SELECT basename, max(length) AS length, count(*) AS places FROM fx_media GROUP BY basename)"
SCALED = f"""
sc AS (SELECT a.*, p.width AS pw, p.height AS ph, 794.0/p.width AS scale FROM fx_annotation a JOIN {LAST_PAGE} p ON a.path = p.path AND a.page = p.page)"""
# Violations of annotations in the text of the oracle; V1 and L1 use it too.
FOUND = f"""
ids AS (SELECT path, id, min(pos) AS first_pos FROM fx_annotation GROUP BY path, id),
au AS (SELECT a.*, p.width AS pw, p.height AS ph, m.length AS size, m.places, ids.first_pos FROM fx_annotation a JOIN ids USING (path, id)
  LEFT JOIN {LAST_PAGE} p ON a.path = p.path AND a.page = p.page LEFT JOIN {MEDIA} m ON a.type = 'audio' AND regexp_extract(a.audio_path, '[^/]+$') = m.basename),
found AS (SELECT * FROM (SELECT path || '#' || id AS entity_id, pos, unnest([
  CASE WHEN pos > first_pos THEN 'id_duplicate' END, CASE WHEN type NOT IN ('audio', 'transcript') THEN 'type_invalid' END,
  CASE WHEN pw IS NULL THEN 'page_missing' END, CASE WHEN x + width > pw OR y + height > ph THEN 'box_out_of_bounds' END,
  CASE WHEN type = 'audio' AND size IS NULL THEN 'audio_file_missing' END, CASE WHEN type = 'audio' AND places = 1 AND size > 73400320 THEN 'audio_file_too_large' END, CASE WHEN type = 'audio' AND places > 1 THEN 'audio_file_ambiguous' END,
  CASE WHEN type = 'transcript' AND trim(question) = '' THEN 'question_missing' END, CASE WHEN type = 'transcript' AND trim(text) = '' THEN 'text_missing' END
  ]) AS rule_code FROM au) WHERE rule_code IS NOT NULL
  UNION ALL SELECT path || '#page ' || CAST(page AS STRING), NULL, 'page_descriptor_invalid' FROM fx_page WHERE page <= 0 GROUP BY path, page
  UNION ALL SELECT path || '#page ' || CAST(page AS STRING), NULL, 'page_descriptor_duplicate' FROM fx_page GROUP BY path, page HAVING count(*) > 1)"""


@query("D1_annotation_summary", f"""
WITH {SCALED}, {FOUND}
SELECT count(*) AS annotation_count, count(DISTINCT path || '#' || CAST(page AS STRING)) AS affected_page_count, min(page) AS first_page, max(page) AS last_page,
 count(*) FILTER (WHERE type = 'audio') AS audio_count, count(*) FILTER (WHERE type = 'transcript') AS transcript_count,
 count(DISTINCT lower(audio_path)) FILTER (WHERE type = 'audio') AS unique_audio_file_count,
 (SELECT count(*) FROM found WHERE rule_code <> 'box_out_of_bounds') AS error_count, (SELECT count(*) FROM found WHERE rule_code = 'box_out_of_bounds') AS warning_count,
 (SELECT count(*) FROM found WHERE rule_code <> 'box_out_of_bounds') = 0 AS valid FROM sc""")
def _(t):
    scaled = A.scale_annotations(t.fx_annotation, t.fx_page)
    found = A.validate_annotations(t.fx_annotation, t.fx_page, t.fx_media)
    return R.annotation_summary(A.placed(scaled), found)


@query("D2_plan_by_page", f"""
WITH {SCALED}, n AS (SELECT *, row_number() OVER (PARTITION BY path, page ORDER BY pos, id) AS n FROM sc)
SELECT path, page, CAST((n - 1) // 16 AS BIGINT) AS segment, round(min(scale), 9) AS scale, round(min(ph * scale), 6) AS canvas_height, count(*) AS n_items,
  string_agg(CAST(pos AS STRING), ',' ORDER BY n) AS positions FROM n GROUP BY 1, 2, 3""")
def _(t):
    plan = R.plan_by_page(A.placed(A.scale_annotations(t.fx_annotation, t.fx_page)), size=16)
    return plan.select("path", "page", "segment", F.round("scale", 9).alias("scale"), F.round("canvas_height", 6).alias("canvas_height"),
                       "n_items", F.array_join(F.col("annotations.pos").cast("array<string>"), ",").alias("positions"))


WORDS = """
SELECT doc_id, source || ' ' || lang AS name, text, length(text) - length(replace(text, chr(10), '')) + 1 AS n_sentences,
  2 + n_chars % 4 AS n_english, 3 + n_chars % 3 AS n_chinese FROM documents"""


@query("D3_distribution", f"WITH w AS ({WORDS}) SELECT n_sentences AS value, count(*) AS n FROM w GROUP BY 1")
def _(t):
    return R.distribution(t.sql(WORDS.replace("chr(10)", "'\\n'")), "n_sentences")


@query("D4_mismatch_report", f"WITH w AS ({WORDS}) SELECT doc_id, n_english, n_chinese FROM w WHERE n_english <> 4 OR n_chinese <> 4")
def _(t):
    return R.mismatch_report(t.sql(WORDS.replace("chr(10)", "'\\n'")), ["n_english", "n_chinese"], 4).select(
        "doc_id", "n_english", "n_chinese")


@query("D5_longest_by", "SELECT doc_id, length(text) AS len FROM documents ORDER BY length(text) DESC, doc_id LIMIT 1")
def _(t):
    return R.longest_by(t.documents.select("doc_id", F.length("text").alias("len")), F.col("len"), "doc_id")


@query("D6_verification_report", """
SELECT count(*) AS page_count, CAST(sum(o_custkey % 9) AS BIGINT) AS module_total, count(*) FILTER (WHERE o_orderstatus = 'P') AS failure_count,
  min(o_orderkey) AS first_page, max(o_orderkey) AS last_page FROM orders""")
def _(t):
    pages = t.orders.selectExpr("o_orderkey AS page_id", "o_orderkey AS position", "o_custkey % 9 AS module_count")
    errors = t.orders.where("o_orderstatus = 'P'").selectExpr("CAST(o_orderkey AS STRING) AS entity_id", "'error' AS severity")
    return R.verification_report(pages, errors)


@query("D7_ledger_summary", """
WITH s AS (SELECT unnest(['pending','planned','preflighted','applied','saved','verified','verified_skip','needs_review','conflict','failed','outcome_unknown']) AS state),
 c AS (SELECT item_id, arg_max(to_state, seq) AS state FROM fx_ledger_event GROUP BY 1)
SELECT s.state, count(c.item_id) AS n, max(CASE WHEN s.state IN ('needs_review','conflict','failed','outcome_unknown') THEN c.item_id END) AS last_attention
FROM s LEFT JOIN c ON s.state = c.state GROUP BY 1""")
def _(t):
    from auditflow.operators.windows import current_state
    summary, attention = R.ledger_summary(current_state(t.fx_ledger_event, "item_id", ["seq"], "to_state"))
    last = attention.groupBy("state").agg(F.max("item_id").alias("last_attention"))
    return summary.join(last, "state", "left")


@query("D8_duplicate_report", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def _(t):
    return R.duplicate_report(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("D9_distinct_equals", """
SELECT CAST(l_orderkey AS STRING) AS entity_id, 'distinct_count' AS rule_code, 'error' AS severity,
  'expected 4, got ' || CAST(count(DISTINCT l_linenumber) AS STRING) AS message FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT l_linenumber) <> 4""")
def _(t):
    return R.distinct_equals(t.lineitem, ["l_orderkey"], "l_linenumber", 4)


@query("D10_required_passed", """
WITH r AS (SELECT source AS run_id, doc_id AS required_key FROM documents), ok AS (SELECT doc_id FROM labels WHERE quality = 1)
SELECT run_id, bool_and(doc_id IS NOT NULL) AS passed, count(*) AS n_required FROM r LEFT JOIN ok ON required_key = doc_id GROUP BY 1""")
def _(t):
    required = t.documents.select(F.col("source").alias("run_id"), F.col("doc_id").alias("required_key"))
    checks = t.sql("""SELECT source AS run_id, labels.doc_id AS required_key, CASE WHEN quality = 1 THEN 'passed' ELSE 'failed' END AS status
                      FROM labels JOIN documents ON labels.doc_id = documents.doc_id""")
    return R.required_passed(required, checks)


@query("D11_fidelity_gate", """
WITH s AS (SELECT event_id, event_type IN ('view', 'click') AS normal, value > 3 AS blocks, event_id % 4 <> 0 AS warn_ok, event_id % 10 AS m FROM events)
SELECT event_id, blocks AND warn_ok AS full_fidelity, blocks AND warn_ok AND m = CASE WHEN normal THEN 9 ELSE 2 END AS gate FROM s""")
def _(t):
    snaps = t.events.select(
        "event_id", F.when(F.col("event_type").isin("view", "click"), "normal").otherwise("ability").alias("route"),
        F.create_map(F.lit("blocks"), F.col("value") > 3, F.lit("fonts"), F.lit(False)).alias("sections"),
        F.when(F.col("event_id") % 4 == 0, F.array(F.lit("FONT_MAPPING_EMPTY"), F.lit("BLOCK_LOST"))).otherwise(
            F.array(F.lit("FONT_MAPPING_EMPTY"))).alias("warnings"),
        (F.col("event_id") % 10).alias("module_count"))
    expected = t.spark.createDataFrame([("normal", 9), ("ability", 2)], "route string, n_modules int")
    return R.fidelity_gate(snaps, expected).select("event_id", "full_fidelity", "gate")


@query("D12_module_cardinality", """
WITH p AS (SELECT o_orderkey AS page_id, CASE o_orderstatus WHEN 'F' THEN 'ability' WHEN 'O' THEN 'practice' ELSE CASE WHEN o_orderkey % 3 = 0 THEN 'odd' ELSE 'analysis' END END AS route FROM orders),
 e(route, module_type, n_expected) AS (VALUES ('ability','A',1), ('ability','N',1), ('practice','R',2), ('practice','N',1), ('analysis','N',1)),
 w AS (SELECT page_id, module_type, n_expected FROM p JOIN e USING (route)),
 c AS (SELECT l_orderkey AS page_id, l_returnflag AS module_type, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT CAST(coalesce(w.page_id, c.page_id) AS STRING) AS entity_id, coalesce(w.module_type, c.module_type) || ': expected ' || CAST(coalesce(n_expected, 0) AS STRING) || ', got ' || CAST(coalesce(n, 0) AS STRING) AS message
FROM w FULL JOIN c ON w.page_id = c.page_id AND w.module_type = c.module_type WHERE coalesce(n, 0) <> coalesce(n_expected, 0)
UNION ALL SELECT CAST(page_id AS STRING), 'route ' || route || ' has no expectation' FROM p WHERE route NOT IN (SELECT route FROM e)""")
def _(t):
    pages = t.sql("SELECT o_orderkey AS page_id, CASE o_orderstatus WHEN 'F' THEN 'ability' WHEN 'O' THEN 'practice' ELSE CASE WHEN o_orderkey % 3 = 0 THEN 'odd' ELSE 'analysis' END END AS route FROM orders")
    modules = t.lineitem.selectExpr("l_orderkey AS page_id", "l_returnflag AS module_type")
    expected = t.spark.createDataFrame(
        [("ability", "A", 1), ("ability", "N", 1), ("practice", "R", 2), ("practice", "N", 1), ("analysis", "N", 1)],
        "route string, module_type string, n_expected int")
    return R.module_cardinality(modules, pages, expected).select("entity_id", "message")


@query("D13_warning_histogram", "SELECT event_type AS code, count(*) AS n FROM events GROUP BY 1")
def _(t):
    return R.warning_histogram(t.events, "event_type")


@query("D14_book_rollup", """
SELECT c_mktsegment, count(*) AS page_count, count(*) FILTER (WHERE o_orderstatus = 'F') AS full_fidelity, count(*) FILTER (WHERE o_orderstatus = 'P') AS bad_pages,
  grouping(c_mktsegment) = 1 AS is_total FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ROLLUP (c_mktsegment)""")
def _(t):
    pages = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return R.book_rollup(pages, "c_mktsegment", {
        "page_count": F.count("*"), "full_fidelity": F.count(F.when(F.col("o_orderstatus") == "F", 1)),
        "bad_pages": F.count(F.when(F.col("o_orderstatus") == "P", 1))})


@query("D15_bijection_check", """
WITH p AS (SELECT DISTINCT p_name AS lock_key, CAST(p_size AS STRING) || p_brand AS identity FROM part)
SELECT lock_key AS entity_id, 'lock_key_to_many_identity' AS rule_code, CAST(count(*) AS STRING) || ' values of identity' AS message FROM p GROUP BY 1 HAVING count(*) > 1
UNION ALL SELECT identity, 'identity_to_many_lock_key', CAST(count(*) AS STRING) || ' values of lock_key' FROM p GROUP BY 1 HAVING count(*) > 1""")
def _(t):
    pairs = t.part.selectExpr("p_name AS lock_key", "CAST(p_size AS STRING) || p_brand AS identity")
    return R.bijection_check(pairs, "lock_key", "identity").select("entity_id", "rule_code", "message")


@query("D16_set_report", """
WITH r AS (SELECT p_partkey AS k, 1 AS r, 0 AS p FROM part WHERE p_size > 3 UNION ALL SELECT l_partkey, 0, 1 FROM lineitem WHERE l_linenumber = 1),
 g AS (SELECT k, CAST(sum(r) AS BIGINT) AS n_required, CAST(sum(p) AS BIGINT) AS n_present FROM r GROUP BY 1)
SELECT *, CASE WHEN n_present = 0 THEN 'missing' WHEN n_required = 0 THEN 'unexpected' ELSE 'duplicate' END AS status FROM g WHERE n_present = 0 OR n_required = 0 OR n_present > 1""")
def _(t):
    required = t.part.where("p_size > 3").selectExpr("p_partkey AS k")
    return R.set_report(required, t.lineitem.where("l_linenumber = 1").selectExpr("l_partkey AS k"), ["k"])
