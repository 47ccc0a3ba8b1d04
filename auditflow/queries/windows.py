"""Windows, sorts and first or last picks."""

from pyspark.sql import functions as F

from auditflow.functions.layout import js_length
from auditflow.operators import windows as W
from auditflow.queries import query


@query("E1_latest_per_key", """
SELECT book_id, catalog_id, pos, doc FROM (SELECT *, row_number() OVER (PARTITION BY book_id, catalog_id ORDER BY date_trunc('day', captured_at) DESC, pos) AS rn FROM fx_snapshot) WHERE rn = 1""")
def _(t):
    snaps = t.fx_snapshot.withColumn("captured_at", F.date_trunc("day", "captured_at"))
    return W.latest_per_key(snaps, ["book_id", "catalog_id"], "captured_at", "pos").select("book_id", "catalog_id", "pos", "doc")


# Events of a user as pages of a book: errors are ability pages.
BOOK_PAGES = """
SELECT user_id AS book_id, event_id AS pos, CASE WHEN event_type = 'error' OR (event_type = 'signup' AND event_id % 2 = 0) THEN 'ability' ELSE 'normal' END AS route,
  event_type || ' ' || CAST(event_id AS STRING) AS topic FROM events"""


@query("E2_recent_topics", f"""
WITH p AS ({BOOK_PAGES}), l AS (SELECT *, lag(route) OVER (PARTITION BY book_id ORDER BY pos) AS prev FROM p),
 u AS (SELECT *, sum(CASE WHEN route = 'normal' AND prev = 'ability' THEN 1 ELSE 0 END) OVER (PARTITION BY book_id ORDER BY pos) AS unit FROM l),
 n AS (SELECT book_id, unit, pos, topic, row_number() OVER (PARTITION BY book_id, unit ORDER BY pos DESC) AS back FROM u WHERE route = 'normal')
SELECT a.book_id, a.pos, coalesce(string_agg(n.topic, '|' ORDER BY back), '') AS topics, CASE WHEN count(n.topic) = 5 THEN 'resolved' ELSE 'needs_review' END AS status
FROM u a LEFT JOIN n ON n.book_id = a.book_id AND n.unit = a.unit AND back <= 5 WHERE a.route = 'ability' GROUP BY 1, 2""")
def _(t):
    out = W.recent_topics(t.sql(BOOK_PAGES))
    return out.select("book_id", "pos", F.array_join("topics", "|").alias("topics"), "status")


@query("E3_next_matching", """
SELECT event_id, (SELECT min(b.event_id) FROM events b WHERE b.user_id = a.user_id AND b.event_id > a.event_id AND b.event_type = 'purchase') AS next_purchase FROM events a""")
def _(t):
    events = t.events.select("user_id", "event_id", "event_type")
    out = W.next_matching(events, ["user_id"], ["event_id"], F.col("event_type") == "purchase", F.col("event_id"), "next_purchase")
    return out.select("event_id", "next_purchase")


@query("E4_longest_per_group", """
WITH u AS (SELECT source, doc_id, length(text) + CASE WHEN doc_id % 3 = 0 THEN 2 * (doc_id % 500) ELSE 0 END AS n FROM documents)
SELECT source, doc_id, n FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, doc_id) AS rn FROM u) WHERE rn = 1""")
def _(t):
    # Signs outside the basic plane count as two units.
    texts = t.sql("SELECT source, doc_id, concat(text, CASE WHEN doc_id % 3 = 0 THEN repeat('\U0001F600', CAST(doc_id % 500 AS INT)) ELSE '' END) AS text FROM documents")
    return W.longest_per_group(texts, ["source"], "text", "doc_id").select("source", "doc_id", js_length("text").cast("bigint").alias("n"))


@query("E5_first_k", """
SELECT user_id, event_id, n FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events WHERE event_type = 'click') WHERE n <= 2""")
def _(t):
    events = t.events.select("user_id", "event_id", "event_type")
    return W.first_k(events, ["user_id"], F.col("event_type") == "click", "event_id", 2).select(
        "user_id", "event_id", F.col("n").cast("bigint").alias("n"))


@query("E6_illegal_transitions", """
WITH a(f, t) AS (VALUES ('pending','planned'),('pending','failed'),('planned','preflighted'),('planned','failed'),('preflighted','applied'),('preflighted','failed'),
  ('applied','saved'),('applied','failed'),('saved','failed'),('failed','planned')),
 l AS (SELECT item_id, seq, coalesce(lag(to_state) OVER (PARTITION BY item_id ORDER BY seq), 'pending') AS from_state, to_state FROM fx_ledger_event)
SELECT item_id, seq, from_state, to_state FROM l WHERE NOT EXISTS (SELECT 1 FROM a WHERE f = from_state AND t = to_state)""")
def _(t):
    from auditflow.operators.ledger import transition_table
    out = W.illegal_transitions(t.fx_ledger_event, transition_table(t.spark), ["item_id"], ["seq"], "to_state", "pending")
    return out.select("item_id", "seq", "from_state", "to_state")


@query("E7_current_state", """
SELECT item_id, arg_max(to_state, seq) AS state, count(*) FILTER (WHERE to_state = 'planned') AS attempts FROM fx_ledger_event GROUP BY 1""")
def _(t):
    return W.current_state(t.fx_ledger_event, "item_id", ["at_ts", "seq"], "to_state")


@query("E8_first_wins", """
WITH i AS (SELECT l_orderkey*1000000 + l_suppkey*10 + l_linenumber AS item, nullif(l_partkey, l_partkey // 7 * 7) AS l_partkey, l_suppkey FROM lineitem)
SELECT item, l_partkey, l_suppkey, min(item) OVER (PARTITION BY l_partkey, l_suppkey) AS winner, item <> min(item) OVER (PARTITION BY l_partkey, l_suppkey) AS conflict FROM i""")
def _(t):
    items = t.lineitem.selectExpr("l_orderkey*1000000 + l_suppkey*10 + l_linenumber AS item", "CASE WHEN l_partkey % 7 <> 0 THEN l_partkey END AS l_partkey", "l_suppkey")
    return W.first_wins(items, ["l_partkey", "l_suppkey"], "item", [F.col("item")])


VARIANTS = [
    {"template": "camp_ability", "priority": 30, "when": "p_type = 'ECONOMY' AND p_size > 40"},
    {"template": "practice_a", "priority": 20, "when": "p_brand = 'Brand#2'"},
    {"template": "practice_b", "priority": 20, "when": "p_size BETWEEN 10 AND 45"},
    {"template": "default", "priority": 1, "when": "p_type <> 'PROMO'"},
]


@query("E9_route_template", "WITH v AS (" + " UNION ALL ".join(
    f"SELECT p_partkey, '{v['template']}' AS template, {v['priority']} AS priority FROM part WHERE {v['when']}" for v in VARIANTS) + """),
 m AS (SELECT p_partkey, template, rank() OVER (PARTITION BY p_partkey ORDER BY priority DESC) AS r FROM v),
 g AS (SELECT p_partkey, count(*) AS n, min(template) AS template FROM m WHERE r = 1 GROUP BY 1)
SELECT part.p_partkey, CASE WHEN n = 1 THEN template END AS template, CASE WHEN n = 1 THEN 'resolved' ELSE 'needs_review' END AS status FROM part LEFT JOIN g ON g.p_partkey = part.p_partkey""")
def _(t):
    return W.route_template(t.part, VARIANTS).select("p_partkey", "template", "status")


@query("E10_first_with_fallback", """
WITH a AS (SELECT source, arg_min(text, doc_id) AS x FROM documents WHERE lang <> 'en' AND length(text) <= 400 GROUP BY 1),
 b AS (SELECT source, arg_min(text, doc_id) AS x FROM documents WHERE lang <> 'en' GROUP BY 1)
SELECT s.source, coalesce(a.x, b.x) AS text FROM (SELECT DISTINCT source FROM documents) s LEFT JOIN a USING (source) LEFT JOIN b USING (source)""")
def _(t):
    other = F.col("lang") != "en"
    return W.first_with_fallback(t.documents, ["source"], [other & (F.length("text") <= 400), other], "doc_id", "text")


@query("E11_assign_rows", """
WITH e AS (SELECT l_partkey AS page_id, l_linenumber AS column_id, l_quantity AS top_px, l_orderkey*1000 + l_suppkey AS element_id FROM lineitem),
 p AS (SELECT *, row_number() OVER (PARTITION BY page_id, column_id ORDER BY top_px, element_id) AS row_no, count(*) OVER (PARTITION BY page_id, column_id) AS n FROM e),
 c AS (SELECT page_id, center_px, row_number() OVER (PARTITION BY page_id ORDER BY center_px) AS row_no FROM (SELECT p_partkey AS page_id, unnest([p_size + 10, p_size + 30, p_size + 50]) AS center_px FROM part))
SELECT p.page_id, column_id, element_id, p.row_no, center_px, n <> 3 AS count_mismatch FROM p LEFT JOIN c ON c.page_id = p.page_id AND c.row_no = p.row_no""")
def _(t):
    elements = t.lineitem.selectExpr("l_partkey AS page_id", "l_linenumber AS column_id", "l_quantity AS top_px", "l_orderkey*1000 + l_suppkey AS element_id")
    rows = t.part.selectExpr("p_partkey AS page_id", "explode(array(p_size + 10, p_size + 30, p_size + 50)) AS center_px")
    expected = elements.select("page_id", "column_id").distinct().withColumn("n_expected", F.lit(3))
    return W.assign_rows(elements, rows, expected).select("page_id", "column_id", "element_id", "row_no", "center_px", "count_mismatch")


# Backgrounds of a page: one row a line, three blocks a row that are a few pixels off, and single blocks between rows.
BACKGROUNDS = """SELECT l_partkey % 500 AS page_id, l_orderkey*1000000 + l_suppkey*100 + l_linenumber*10 + j AS block_id,
  CASE WHEN j = 3 THEN 100*l_linenumber + 50 + l_partkey % 3 ELSE 100*l_linenumber - 20 + (l_suppkey*3 + j*5) % 9 - 4 END AS top_px, CASE WHEN j = 3 AND l_suppkey % 4 > 0 THEN NULL ELSE 40 - j END AS height_px
FROM (SELECT DISTINCT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem) AS l CROSS JOIN (SELECT 0 AS j UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3) AS js"""


@query("E11_row_centres", f"""
WITH b AS (SELECT page_id, block_id, top_px + height_px / 2.0 AS mid FROM ({BACKGROUNDS}) WHERE height_px IS NOT NULL),
s AS (SELECT *, CASE WHEN mid - lag(mid) OVER w <= 20 THEN 0 ELSE 1 END AS begins FROM b WINDOW w AS (PARTITION BY page_id ORDER BY mid, block_id)),
r AS (SELECT *, sum(begins) OVER (PARTITION BY page_id ORDER BY mid, block_id ROWS UNBOUNDED PRECEDING) AS no FROM s)
SELECT page_id, round(avg(mid), 6) AS center_px, count(*) AS n_blocks FROM r GROUP BY page_id, no HAVING count(*) >= 2""")
def _(t):
    return W.row_centres(t.sql(BACKGROUNDS), 20).withColumn("center_px", F.round("center_px", 6))


@query("F3_ordered", """
SELECT o_orderkey, o_custkey, list_sort(l) = l AS is_sorted FROM (SELECT o_orderkey, o_custkey, [o_orderstatus, o_orderpriority] AS l FROM orders)""")
def _(t):
    rows = t.orders.withColumn("is_sorted", W.is_sorted(F.array("o_orderstatus", "o_orderpriority")))
    return W.ordered(rows.select("o_orderkey", "o_custkey", "is_sorted"), ["o_custkey", "o_orderkey"])


@query("F4_first_last", """
(SELECT 'first' AS which, o_orderkey, o_custkey FROM orders ORDER BY o_custkey, o_orderkey LIMIT 1)
UNION ALL (SELECT 'last', o_orderkey, o_custkey FROM orders ORDER BY o_custkey DESC, o_orderkey DESC LIMIT 1)""")
def _(t):
    return W.first_last(t.orders.select("o_orderkey", "o_custkey"), ["o_custkey", "o_orderkey"])
