"""Trees, nested values, rich text and names."""

from pyspark.sql import functions as F

from auditflow.functions import text as X
from auditflow.operators import tree
from auditflow.queries import query

# A text as a tree: lines are elements and the sentences of a line are its children.
TEXT_TREE = r"""
SELECT doc_id, try_parse_json(to_json(transform(split(text, '\n'), (line, i) -> named_struct(
  'id', concat('l', length(line) % 7), 'name', concat('line', i), 'child_list',
  transform(split(line, '\\. '), (s, j) -> named_struct('id', concat('s', length(s) % 5), 'name', concat('s', j), 'content', s))))))
  AS root FROM documents"""

TREE_ROWS = """
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                 generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents),
sents AS (SELECT doc_id, i, unnest(string_split(line, '. ')) AS s,
                 generate_subscripts(string_split(line, '. '), 1) - 1 AS j FROM lines),
nodes AS (SELECT doc_id, CAST(i AS STRING) AS path, i, -1 AS j, 1 AS depth, '' AS parents, 'l' || CAST(length(line) % 7 AS STRING) AS id, NULL AS content FROM lines
          UNION ALL SELECT doc_id, CAST(i AS STRING) || '.' || CAST(j AS STRING), i, j, 2, 'line' || CAST(i AS STRING),
                 's' || CAST(length(s) % 5 AS STRING), s FROM sents)"""


def _path(c="path"):
    return F.array_join(F.col(c).cast("array<string>"), ".")


@query("B1_flatten_tree", f"WITH {TREE_ROWS} SELECT doc_id, path, depth, parents, content FROM nodes")
def _(t):
    nodes = tree.flatten_tree(t.sql(TEXT_TREE), "root", levels=4)
    return nodes.select(
        "doc_id", _path().alias("path"), "depth", F.array_join("parent_names", "/").alias("parents"),
        F.try_variant_get("node", "$.content", "string").alias("content"))


@query("B2_index_tree", f"""
WITH {TREE_ROWS}, r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, id ORDER BY i DESC, j DESC) AS rn,
   count(*) OVER (PARTITION BY doc_id, id) AS n_seen FROM nodes)
SELECT doc_id, id, path, n_seen, content FROM r WHERE rn = 1""")
def _(t):
    nodes = tree.flatten_tree(t.sql(TEXT_TREE), "root", levels=4)
    return tree.index_tree(nodes, ["doc_id"]).select(
        "doc_id", "id", _path().alias("path"), "n_seen",
        F.try_variant_get("node", "$.content", "string").alias("content"))


# The last field is nested 3 to 30 deep.
ORDER_DOCS = """
SELECT o_orderkey, try_parse_json(concat(rtrim('}', to_json(named_struct(
  'source_id', concat('s', o_orderkey),
  'target', named_struct('book_id', o_custkey, 'inner', named_struct('bookId', o_orderstatus, 'rank', o_orderpriority)),
  'links', array(
    named_struct('book_id', CAST(o_orderkey % 7 AS STRING), 'note', 'n', 'source_id', CAST(NULL AS STRING)),
    named_struct('book_id', CAST(NULL AS STRING), 'note', CAST(NULL AS STRING), 'source_id', o_orderstatus))
))), ',"deep":', repeat('{"inner":', CAST(3 + o_orderkey % 28 AS INT)), '{"book_id":"d"}', repeat('}', CAST(3 + o_orderkey % 28 AS INT)), '}')) AS doc FROM orders"""

NAMED = """
SELECT o_orderkey, '$.source_id' AS path, '"s' || CAST(o_orderkey AS STRING) || '"' AS value FROM orders
UNION ALL SELECT o_orderkey, '$.target.book_id', CAST(o_custkey AS STRING) FROM orders
UNION ALL SELECT o_orderkey, '$.target.inner.bookId', '"' || o_orderstatus || '"' FROM orders
UNION ALL SELECT o_orderkey, '$.links[0].book_id', '"' || CAST(o_orderkey % 7 AS STRING) || '"' FROM orders
UNION ALL SELECT o_orderkey, '$.links[1].source_id', '"' || o_orderstatus || '"' FROM orders
UNION ALL SELECT o_orderkey, '$.deep' || repeat('.inner', CAST(3 + o_orderkey % 28 AS INT)) || '.book_id', '"d"' FROM orders"""


@query("B3_collect_named_values", NAMED)
def _(t):
    rows = tree.collect_named_values(t.sql(ORDER_DOCS), "doc", ["source_id", "book_id", "bookId"])
    return rows.select("o_orderkey", "path", F.to_json("value").alias("value"))


@query("B4_key_paths", f"SELECT o_orderkey, path FROM ({NAMED}) WHERE path LIKE '%book_id'")
def _(t):
    return tree.key_paths(t.sql(ORDER_DOCS), "doc", "book_id").select("o_orderkey", "path")


def duck_lines(col: str) -> str:
    c = f"coalesce({col}, '')"
    for pattern in (r"<br\s*/?>", r"</p>\s*<p[^>]*>", r"</li>\s*<li[^>]*>"):
        c = f"regexp_replace({c}, '{pattern}', chr(10), 'gi')"
    c = f"regexp_replace({c}, '</?(?:ol|ul)[^>]*>', '', 'gi')"
    c = f"regexp_replace({c}, '<[^>]+>', '', 'g')"
    c = f"regexp_replace({c}, '&#39;|&apos;', '''', 'g')"
    for a, b in (("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&nbsp;", " ")):
        c = f"replace({c}, '{a}', '{b}')"
    c = f"list_transform(string_split(replace({c}, chr(13) || chr(10), chr(10)), chr(10)), lambda s: trim(regexp_replace(s, '\\s+', ' ', 'g')))"
    return f"list_filter({c}, lambda s: s <> '')"


@query("B5_page_lines", f"""
WITH l AS (SELECT page_id, {duck_lines('html')} AS lines FROM pages)
SELECT page_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS line_no FROM l""")
def _(t):
    lines = t.pages.select("page_id", F.posexplode(X.html_lines("html")).alias("i", "line"))
    return lines.select("page_id", (F.col("i") + 1).alias("line_no"), "line")


def duck_text(col: str) -> str:
    c = f"regexp_replace(coalesce({col}, ''), '<br\\s*/?>', ' ', 'gi')"
    c = f"regexp_replace({c}, '</(?:p|div|li|h[1-6])\\s*>', ' ', 'gi')"
    c = f"regexp_replace({c}, '<[^>]+>', '', 'g')"
    for a, b in (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;|&apos;", "''")):
        c = f"regexp_replace({c}, '{a}', '{b}', 'gi')"
    c = f"regexp_replace({c}, '\\s+', ' ', 'g')"
    return f"trim(regexp_replace({c}, '\\s+([.,!?;:])', '\\1', 'g'))"


@query("B6_page_text", f"SELECT page_id, {duck_text('html')} AS text FROM pages")
def _(t):
    return t.pages.select("page_id", X.html_text("html").alias("text"))


STYLED = """
SELECT page_id, html || CASE page_id % 4
  WHEN 0 THEN '<b class="x" style="color: red; font-size:3px; background-color:blue">w</b>'
  WHEN 1 THEN '<span id="q" style="font-size: 9px" lang="en">w</span>'
  WHEN 2 THEN '<SPAN style="COLOR:#fff;margin:0">w</SPAN><b>v</b> a < b'
  ELSE '<b style="margin:1px">w</b>' END AS html FROM pages"""


@query("B7_restyle_pages", r"""
WITH s AS (""" + STYLED + r"""),
tok AS (SELECT page_id, unnest(regexp_extract_all(html, '(<[^>]*>|[^<]+|<)', 1)) AS k,
               generate_subscripts(regexp_extract_all(html, '(<[^>]*>|[^<]+|<)', 1), 1) AS i FROM s),
kept AS (SELECT page_id, i, k, array_to_string(list_filter(list_transform(
    string_split(regexp_extract(k, '(?i)^<(?:b|span)\b[^>]*style="([^"]*)"[^>]*>$', 1), ';'), lambda p: trim(p)),
    lambda p: regexp_matches(p, '(?i)^(background-color|color)\s*:')), '; ') AS style FROM tok),
new AS (SELECT page_id, i, CASE
    WHEN regexp_matches(k, '(?i)^<b\b[^>]*>$') THEN CASE WHEN style <> '' THEN '<span style="' || style || ';">' ELSE '<span>' END
    WHEN lower(k) = '</b>' THEN '</span>'
    WHEN regexp_matches(k, '(?i)^<span\b[^>]*style="[^"]*"[^>]*>$') THEN
      '<span' || regexp_extract(k, '(?i)^<span\b([^>]*)style="([^"]*)"([^>]*)>$', 1)
      || CASE WHEN style <> '' THEN 'style="' || style || ';"' ELSE '' END
      || regexp_extract(k, '(?i)^<span\b([^>]*)style="([^"]*)"([^>]*)>$', 3) || '>'
    ELSE k END AS k FROM kept)
SELECT page_id, string_agg(k, '' ORDER BY i) AS html FROM new GROUP BY page_id""")
def _(t):
    return t.sql(STYLED).select("page_id", X.restyled("html").alias("html"))


@query("B8_annotation_payload", """
WITH e AS (SELECT doc_id, source, replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#39;') AS x FROM documents)
SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 77 ELSE 76 END AS module_type,
  CASE WHEN doc_id % 2 = 0 THEN '播放 ' || source ELSE '查看听力原文：' || source END AS name,
  CASE WHEN doc_id % 2 = 1 THEN '<strong>' || source || '</strong>' || regexp_replace(x, '\\r?\\n', '<br>', 'g') END AS config
FROM e""".replace("\\\\", "\\"))
def _(t):
    kind = F.when(F.col("doc_id") % 2 == 0, "audio").otherwise("transcript")
    return t.documents.select("doc_id", X.annotation_payload(kind, "source", "text").alias("p")).select("doc_id", "p.*")


# Ideographic, no-break and thin spaces around and inside a name.
WIDE = "concat('\u3000\u00a0', replace(text, ' a', CASE WHEN doc_id % 2 = 0 THEN '\u2009 a' ELSE '\ufeffa' END), '\u00a0\n')"


@query("B9_normalize_name", r"""
WITH w AS (SELECT doc_id, replace(text, ' a', CASE WHEN doc_id % 2 = 0 THEN '  a' ELSE ' a' END) AS name FROM documents)
SELECT doc_id, trim(regexp_replace(name, '\s+', ' ', 'g')) AS name FROM w""")
def _(t):
    return t.sql(f"SELECT doc_id, {WIDE} AS name FROM documents").select("doc_id", X.normalize_name("name").alias("name"))


VOLUMES = """
SELECT p_partkey, CASE p_size % 7 WHEN 0 THEN '上' WHEN 1 THEN ' 第一册' WHEN 2 THEN '1' WHEN 3 THEN '下册 '
   WHEN 4 THEN '2' WHEN 5 THEN '' ELSE 'Extra Vol' END AS volume,
 p_type || ' > ' || p_name || CASE WHEN p_size % 2 = 0 THEN '/ /' ELSE '/' END || p_brand AS path,
 CASE WHEN p_size % 5 = 0 THEN '  ' ELSE ' ' || p_name || ' ' END AS name FROM part"""


@query("B10_compact_and_paths", r"""
WITH v AS (""" + VOLUMES + r"""), c AS (SELECT *, nullif(regexp_replace(lower(volume), '\s+', '', 'g'), '') AS cv FROM v)
SELECT p_partkey, nullif(regexp_replace(lower(name), '\s+', '', 'g'), '') AS compact,
  CASE WHEN cv IN ('上','上册','第一册','1') THEN '上册' WHEN cv IN ('下','下册','第二册','2') THEN '下册' ELSE cv END AS volume,
  nullif(array_to_string(list_filter(list_transform(regexp_split_to_array(path, '[/>\\]'),
    lambda p: regexp_replace(lower(p), '\s+', '', 'g')), lambda p: p <> ''), '/'), '') AS path FROM c""")
def _(t):
    return t.sql(VOLUMES).select(
        "p_partkey", X.compact_text("name").alias("compact"), X.normalize_volume("volume").alias("volume"),
        X.normalize_path("path").alias("path"))


NUMBERS = """
SELECT l_orderkey, l_linenumber, l_partkey, CASE l_linenumber % 8
  WHEN 0 THEN ' ' || CAST(l_partkey AS STRING) || ' ' WHEN 1 THEN CAST(l_partkey AS STRING) || '.5' WHEN 2 THEN CASE WHEN l_orderkey % 2 = 0 THEN '' ELSE '0xFFFFFFFFFFFFFFFFFFFF ' END
  WHEN 3 THEN CAST(l_suppkey AS STRING) || 'e2' WHEN 4 THEN '0x1F' WHEN 5 THEN '1e999' WHEN 6 THEN '-' || CAST(l_suppkey AS STRING)
  ELSE CAST(l_suppkey AS STRING) || 'd' END AS raw FROM lineitem"""


@query("B11_finite_number", f"""
WITH n AS ({NUMBERS}), v AS (SELECT *, CASE l_linenumber % 8 WHEN 4 THEN 31.0 WHEN 5 THEN NULL WHEN 2 THEN CASE WHEN l_orderkey % 2 = 1 THEN 1208925819614629174706175.0::DOUBLE END
   WHEN 7 THEN NULL ELSE TRY_CAST(trim(raw) AS DOUBLE) END AS num FROM n)
SELECT l_orderkey, l_linenumber, l_partkey, CAST(num AS DOUBLE) AS num,
  CASE WHEN num > 0 AND num = floor(num) THEN TRY_CAST(num AS BIGINT) END AS pos_int FROM v""")
def _(t):
    return t.sql(NUMBERS).select(
        "l_orderkey", "l_linenumber", "l_partkey", X.finite_number("raw").alias("num"),
        X.positive_integer("raw").alias("pos_int"))


@query("B13_topic_and_sequence", r"""
SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN c_mktsegment ELSE c_mktsegment END AS topic,
  CASE WHEN c_custkey % 9 = 0 THEN 0 ELSE CAST(c_custkey AS INT) END AS sequence FROM customer""")
def _(t):
    named = t.sql("""SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN c_mktsegment
                     ELSE concat('学习之旅', c_custkey, '  ', c_mktsegment) END AS name FROM customer""")
    return named.select("c_custkey", X.topic_of("name").alias("topic"), X.sequence_of("name").alias("sequence"))


PROPS = """
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE
  '[{"paramName":"' || CASE WHEN event_id % 2 = 0 THEN 'subject_id' ELSE 'text_id' END || '","paramValue":"' || props_k || '"}]' END AS raw
FROM (SELECT event_id, regexp_extract(props, '[0-9]+', 0) AS props_k FROM events)"""
PROP_TYPE = "array<struct<paramName:string,paramValue:string>>"


@query("B15_ensure_property", f"""
WITH p AS ({PROPS})
SELECT event_id, CASE WHEN raw IS NULL THEN 1 WHEN event_id % 2 = 0 THEN 1 ELSE 2 END AS n_props,
  CASE WHEN raw IS NOT NULL AND event_id % 2 = 0 THEN json_extract_string(raw, '$[0].paramValue') ELSE '2' END AS subject FROM p""")
def _(t):
    p = t.sql(PROPS).withColumn("props", X.ensure_property(F.from_json("raw", PROP_TYPE), "subject_id", "2"))
    return p.select("event_id", F.size("props").alias("n_props"), X.property_value("props", "subject_id").alias("subject"))


@query("B16_property", f"""
WITH p AS ({PROPS})
SELECT event_id, CASE WHEN raw IS NOT NULL AND event_id % 2 = 1 THEN json_extract_string(raw, '$[0].paramValue') ELSE '' END AS text_id FROM p""")
def _(t):
    p = t.sql(PROPS).withColumn("props", F.from_json("raw", PROP_TYPE))
    return p.select("event_id", X.property_value("props", "text_id").alias("text_id"))



@query("C20_structural_diff", """
SELECT o_orderkey, '$.links[0].note' AS path, '"n"' AS before, '"m"' AS after, 'changed' AS change FROM orders WHERE o_orderkey % 3 = 0
UNION ALL SELECT o_orderkey, '$.deep' || repeat('.inner', CAST(3 + o_orderkey % 28 AS INT)) || '.book_id', '"d"', '"e"', 'changed' FROM orders WHERE o_orderkey % 4 = 0
UNION ALL SELECT o_orderkey, '$.target.inner.rank', '"' || o_orderpriority || '"', NULL, 'removed' FROM orders WHERE o_orderkey % 5 = 0
UNION ALL SELECT o_orderkey, '$.target.inner.grade', NULL, '"' || o_orderpriority || '"', 'added' FROM orders WHERE o_orderkey % 5 = 0""")
def _(t):
    rename = """SELECT o_orderkey, try_parse_json(replace(replace(to_json(doc), '"rank"', CASE WHEN o_orderkey % 5 = 0 THEN '"grade"' ELSE '"rank"' END),
                '"book_id":"d"', CASE WHEN o_orderkey % 4 = 0 THEN '"book_id":"e"' ELSE '"book_id":"d"' END)) AS doc FROM changed"""
    t.sql(ORDER_DOCS.replace("'note', 'n'", "'note', CASE WHEN o_orderkey % 3 = 0 THEN 'm' ELSE 'n' END")).createOrReplaceTempView("changed")
    return tree.structural_diff(t.sql(ORDER_DOCS), t.spark.sql(rename), ["o_orderkey"])


# Two versions of a page.  Of each seven, one is unchanged, one has a block before the others, one an element in another block, one two blocks
# in the other order, one lost an element, one repeats an anchor and one says something else.
def _page(first: str = "", one: str = "{B1}", two: str = "{B2}", three: str = '{"uuid":"b3","text":"x","n":1}', modules: str = '{"anchor":"m1"},{"anchor":"m2"}') -> str:
    b1 = '{"uuid":"b1","text":"x","elements":[{"elementId":"e1","t":1},{"elementId":"e2","t":2}]}'
    b2 = '{"uuid":"b2","elements":[{"elementId":"e3"},{"deep":{"list":[[{"elementId":"e4"}]]}}]}'
    return ('{"blocks":[' + first + one + "," + two + "," + three + '],"modules":[' + modules + "]}").replace("{B1}", b1).replace("{B2}", b2)


AFTER = [
    _page(), _page(first='{"uuid":"b0"},'), _page(one='{"uuid":"b1","text":"x","elements":[{"elementId":"e2","t":2}]}', two='{"uuid":"b2","elements":[{"elementId":"e3"},{"elementId":"e1","t":1},{"deep":{"list":[[{"elementId":"e4"}]]}}]}'),
    _page(one="{B2}", two="{B1}"), _page(two='{"uuid":"b2","elements":[{"elementId":"e3"}]}'), _page(modules='{"anchor":"m1"},{"anchor":"m2"},{"anchor":"m1"}'), _page(three='{"uuid":"b3","text":"y","m":1}')]


@query("C20_identity_survival", """
WITH ids(kind, id) AS (VALUES ('uuid', 'b1'), ('uuid', 'b2'), ('uuid', 'b3'), ('elementId', 'e1'), ('elementId', 'e2'), ('elementId', 'e3'), ('elementId', 'e4'), ('anchor', 'm1'), ('anchor', 'm2'), ('uuid', 'b0')),
odd(c, id, change, fields) AS (VALUES (1, 'b0', 'new', NULL), (2, 'e1', 'moved', ''), (3, 'b1', 'moved', ''), (3, 'b2', 'moved', ''), (4, 'e4', 'lost', NULL), (5, 'm1', 'repeated', ''), (6, 'b3', 'kept', 'm,n,text'))
SELECT o_orderkey, kind, ids.id, coalesce(odd.change, 'kept') AS change, CASE WHEN odd.c IS NULL THEN '' ELSE odd.fields END AS fields
FROM orders CROSS JOIN ids LEFT JOIN odd ON odd.c = o_orderkey % 7 AND odd.id = ids.id WHERE ids.id <> 'b0' OR o_orderkey % 7 = 1""")
def _(t):
    after = F.element_at(F.array(*[F.lit(a) for a in AFTER]), (F.col("o_orderkey") % 7 + 1).cast("int"))
    before = t.orders.select("o_orderkey", F.parse_json(F.lit(_page())).alias("doc"))
    found = tree.identity_diff(before, t.orders.select("o_orderkey", F.parse_json(after).alias("doc")), ["o_orderkey"], ["uuid", "elementId", "anchor"])
    return found.select("o_orderkey", "kind", "id", "change", F.array_join("fields", ",").alias("fields"))
