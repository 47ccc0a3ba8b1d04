"""Set operations."""

from pyspark.sql import functions as F

from auditflow.operators import checks as K
from auditflow.operators import sets as G
from auditflow.queries import query


@query("G1_key_union", "SELECT k FROM fx_base UNION SELECT k FROM fx_cur UNION SELECT k FROM fx_want")
def _(t):
    return G.key_union(t.fx_base, t.fx_cur, t.fx_want, key="k")


KEYED = """
SELECT event_id, CASE event_id % 4 WHEN 0 THEN '{"k":1,"z":2}' WHEN 1 THEN '{"kind":"x"}' WHEN 2 THEN props
  ELSE '{"k":2,"kind":"' || event_type || '"}' END AS doc FROM events"""


@query("G2_key_violations", f"""
WITH d AS ({KEYED}), k AS (SELECT event_id, json_keys(doc) AS ks FROM d)
SELECT CAST(event_id AS STRING) AS entity_id, 'unknown_key' AS rule_code, key AS message FROM (SELECT event_id, unnest(ks) AS key FROM k) WHERE key NOT IN ('k', 'kind')
UNION ALL SELECT CAST(event_id AS STRING), 'missing_key', 'k' FROM k WHERE NOT list_contains(ks, 'k')""")
def _(t):
    return K.key_violations(t.sql(KEYED), "event_id", "doc", ["k"], ["kind"]).select("entity_id", "rule_code", "message")


A, B = "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'A'", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R'"


@query("G3_symmetric_difference", f"""
SELECT *, 'left' AS side FROM (({A}) EXCEPT ({B})) UNION ALL SELECT *, 'right' FROM (({B}) EXCEPT ({A}))""")
def _(t):
    return G.symmetric_difference(t.sql(A), t.sql(B), ["l_orderkey", "l_linenumber"])


@query("G4_same_set", f"""
WITH a AS (SELECT DISTINCT * FROM ({A})), b AS (SELECT DISTINCT * FROM ({B})),
 j AS (SELECT coalesce(a.l_orderkey, b.l_orderkey) AS l_orderkey, a.l_linenumber = b.l_linenumber AS ok FROM a FULL JOIN b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber)
SELECT l_orderkey, bool_and(coalesce(ok, false)) AS equal FROM j GROUP BY 1""")
def _(t):
    return G.same_set(t.sql(A), t.sql(B), "l_orderkey", "l_linenumber")


@query("G5_subset_violations", f"({A}) EXCEPT ({B})")
def _(t):
    return G.subset_violations(t.sql(A), t.sql(B), ["l_orderkey"], "l_linenumber")


@query("G6_forbidden_present", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size = 7)")
def _(t):
    forbidden = t.part.where("p_size = 7").select(F.col("p_partkey").alias("l_partkey"))
    return G.forbidden_present(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), forbidden, ["l_partkey"])
