"""Filters and predicates."""

from pyspark.sql import functions as F

from auditflow.operators import annotations as A
from auditflow.operators import checks as K
from auditflow.queries import query
from auditflow.queries.reports import LAST_PAGE

MSG = "entity_id, rule_code, severity, message"


@query("P1_require_one", """
SELECT CAST(l_orderkey AS STRING) AS entity_id, 'expected_one' AS rule_code, 'error' AS severity,
  'first line: expected 1 match, got ' || CAST(count(*) FILTER (WHERE l_linenumber = 1) AS STRING) AS message
FROM lineitem GROUP BY l_orderkey HAVING count(*) FILTER (WHERE l_linenumber = 1) <> 1""")
def _(t):
    return K.require_one(t.lineitem, ["l_orderkey"], F.col("l_linenumber") == 1, "first line")


@query("P2_check_pattern", r"""
SELECT CAST(c_custkey AS STRING) AS entity_id, 'pack_id_pattern' AS rule_code, 'error' AS severity, v AS message
FROM (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN c_name WHEN 1 THEN lower(c_mktsegment) ELSE '_' || CAST(c_custkey AS STRING) END AS v FROM customer)
WHERE NOT regexp_matches(v, '^[a-z0-9][a-z0-9_-]*$')
UNION ALL
SELECT CAST(c_custkey AS STRING), 'semver_pattern', 'error', v
FROM (SELECT c_custkey, CAST(c_custkey % 5 AS STRING) || '.0' || CASE WHEN c_custkey % 2 = 0 THEN '.1' ELSE '' END AS v FROM customer)
WHERE NOT regexp_matches(v, '^\d+\.\d+\.\d+$')""")
def _(t):
    df = t.sql("""SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN c_name WHEN 1 THEN lower(c_mktsegment) ELSE '_' || CAST(c_custkey AS STRING) END AS pack,
        CAST(c_custkey % 5 AS STRING) || '.0' || CASE WHEN c_custkey % 2 = 0 THEN '.1' ELSE '' END AS version FROM customer""")
    return K.check_pattern(df, "c_custkey", "pack", "pack_id").unionByName(K.check_pattern(df, "c_custkey", "version", "semver"))


CLAIMS = """
SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'the slot_id of ' || text WHEN 1 THEN source WHEN 2 THEN CAST(doc_id AS STRING)
  WHEN 3 THEN '插槽' || lang WHEN 4 THEN 'block 12' ELSE text END AS claim FROM documents"""


# Fixed value: words that give away a runtime identifier.
SPOOF = r"(?i)(^|[^a-z0-9])(?:slot|slot_id|element_id|block_id|node_id|source_id|template_id|runtime_id|identifier)(?:[^a-z0-9]|$)"


@query("P3_id_disguise", r"""
WITH c AS (""" + CLAIMS + r""")
SELECT CAST(doc_id AS STRING) AS entity_id, 'claim_id_disguise' AS rule_code, 'error' AS severity, 'claim id disguise' AS message
FROM c WHERE regexp_matches(claim, 'SPOOF_PATTERN')
  OR regexp_matches(claim, '插槽|槽位') OR trim(claim) = '' OR regexp_matches(trim(claim), '^\d+$')
  OR regexp_matches(trim(claim), '(?i)^[a-z][a-z0-9_.:-]*$')
  OR regexp_matches(trim(claim), '(?i)^(?:slot|element|block|source|template|node|id)[\s:_#-]*[a-z0-9_.:-]+$')""".replace("SPOOF_PATTERN", SPOOF))
def _(t):
    return K.id_disguise(t.sql(CLAIMS), "doc_id", ["claim"])


# Evidence 2 to 12 levels deep, of one leaf in lists and objects; keys that name an identifier cover what is below them.
EVIDENCE = """
SELECT doc_id, CASE doc_id % 13 WHEN 0 THEN '{"block_id":' || nested || '}' WHEN 1 THEN '{"element_id":"free words","n":[1,' || nested || ']}' WHEN 2 THEN '[' || nested || ',"more free words"]' ELSE nested END AS claim
FROM (SELECT doc_id, repeat('{"claim":[', CAST(1 + doc_id % 6 AS INT)) || CASE doc_id % 10 WHEN 0 THEN '12' WHEN 1 THEN '"slot-7"' WHEN 2 THEN '"A full sentence"' WHEN 3 THEN 'true' WHEN 4 THEN 'null'
   WHEN 5 THEN '{"source_id":"a full sentence"}' WHEN 6 THEN '{}' WHEN 7 THEN '[[],{"note":"two words","x":1}]' WHEN 8 THEN '{"slot_name":{"deep":["not seen"]},"k":[]}' ELSE '"' || lang || '"' END
   || repeat(']}', CAST(1 + doc_id % 6 AS INT)) AS nested FROM documents) AS made
UNION ALL SELECT -1 - item_id, CASE item_id % 3 WHEN 0 THEN 'the slot_id of it' WHEN 1 THEN '"about the element_id"' ELSE text END FROM benchmark"""


@query("P3_nested_evidence", r"""
WITH e AS (""" + EVIDENCE + r"""),
p AS (SELECT doc_id, claim, CASE WHEN json_valid(claim) THEN claim::JSON ELSE to_json(claim) END AS j FROM e),
t AS (SELECT p.doc_id, j.type, j.atom->>'$' AS said, j.fullkey FROM p, json_tree(p.j) AS j),
shown AS (SELECT DISTINCT doc_id FROM t WHERE (type = 'BOOLEAN' OR (type = 'VARCHAR' AND NOT (trim(said) = '' OR regexp_matches(trim(said), '^\d+$') OR regexp_matches(trim(said), '(?i)^[a-z][a-z0-9_.:-]*$')
    OR regexp_matches(trim(said), '(?i)^(?:slot|element|block|source|template|node|id)[\s:_#-]*[a-z0-9_.:-]+$'))))
  AND NOT EXISTS (SELECT 1 FROM (SELECT unnest(string_split(replace(fullkey, '"', ''), '.')) AS k) WHERE regexp_matches(regexp_replace(k, '\[\d+\]', '', 'g'), '(^|_)(id|ids)(_|$)|(source|template|element|block|slot|node)_?(id|key|name)$|^(slot|slot_name|source_id|template_source_id)$')))
SELECT CAST(doc_id AS STRING) AS entity_id, 'claim_identifier_only' AS rule_code FROM p WHERE doc_id NOT IN (SELECT doc_id FROM shown)
UNION ALL SELECT CAST(doc_id AS STRING), 'claim_id_disguise' FROM p WHERE json_type(j) = 'VARCHAR' AND regexp_matches(j->>'$', 'SPOOF_PATTERN')""".replace("SPOOF_PATTERN", SPOOF))
def _(t):
    from auditflow.operators.tree import evidence_disguise
    return evidence_disguise(t.sql(EVIDENCE), "doc_id", "claim").select("entity_id", "rule_code")


@query("P4_check_enum", """
SELECT CAST(o_orderkey AS STRING) AS entity_id, 'o_orderstatus_invalid' AS rule_code, 'error' AS severity, o_orderstatus AS message
FROM orders WHERE o_orderstatus NOT IN ('F', 'O')""")
def _(t):
    domain = t.spark.createDataFrame([("F",), ("O",)], "value string")
    return K.check_enum(t.orders, "o_orderkey", "o_orderstatus", domain)


@query("P5_check_required", """
SELECT CAST(doc_id AS STRING) AS entity_id, 'resolution_required' AS rule_code, 'error' AS severity, 'resolution required' AS message
FROM labels WHERE quality = 1 AND NOT (toxic = 0 AND doc_id % 4 <> 0)""")
def _(t):
    df = t.labels.withColumn("resolution", F.when((F.col("toxic") == 0) & (F.col("doc_id") % 4 != 0), "done").otherwise("  "))
    return K.check_required(df, "doc_id", F.col("quality") == 1, "resolution")


@query("P6_out_of_bounds", f"""
SELECT a.path, a.id, a.pos, a.page FROM fx_annotation a JOIN {LAST_PAGE} p ON a.path = p.path AND a.page = p.page
WHERE a.x + a.width > p.width OR a.y + a.height > p.height""")
def _(t):
    scaled = A.scale_annotations(t.fx_annotation, t.fx_page)
    return scaled.where(A.out_of_bounds(scaled)).select("path", "id", "pos", "page")
