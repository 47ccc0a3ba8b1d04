"""Audit-shaped views over the driver tables.

Each view is one SQL text that both engines read, so a query and its oracle start
from the same rows.  A view may build on views defined before it.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

VIEWS: dict[str, str] = {
    "fx_page": """
SELECT 'book-' || CAST(f AS STRING) AS path, p_partkey + 1000000*again AS pos, p_partkey AS page, CAST(600 + 10*p_size + 20*f + 5*again AS DOUBLE) AS width,
       CAST(800 + 10*p_size AS DOUBLE) AS height
FROM part CROSS JOIN (SELECT 0 AS f, 0 AS again UNION ALL SELECT 1, 0 UNION ALL SELECT 2, 0 UNION ALL SELECT 2, -1) AS files
WHERE again = 0 OR p_partkey % 50 = 1""",
    "fx_annotation": """
SELECT 'book-' || CAST(l_orderkey % 3 AS STRING) AS path,
       CAST(CAST(floor(l_orderkey / 3) AS BIGINT) AS STRING) || '-' || CAST(l_linenumber AS STRING) AS id,
       l_orderkey*1000000 + l_suppkey*10 + l_linenumber AS pos,
       CASE l_returnflag WHEN 'A' THEN 'audio' WHEN 'R' THEN 'transcript' ELSE 'other' END AS type,
       l_partkey AS page, l_quantity*20 AS x, l_quantity*10 AS y,
       CAST(64 AS DOUBLE) AS width, CAST(64 AS DOUBLE) AS height,
       'audio/' || CAST(l_suppkey AS STRING) || '.mp3' AS audio_path,
       CASE WHEN l_linenumber = 1 THEN ' ' ELSE 'Question ' || CAST(l_linenumber AS STRING) END AS question,
       CASE WHEN l_linestatus = 'F' THEN 'line' ELSE '' END AS text
FROM lineitem""",
    "fx_media": """
SELECT 'media/' || CAST(s_suppkey AS STRING) || '.mp3' AS path, CAST(s_suppkey AS STRING) || '.mp3' AS basename,
       CAST(round(10000 * abs(s_acctbal)) AS BIGINT) AS length
FROM supplier WHERE s_suppkey % 3 <> 0
UNION ALL SELECT 'other/' || CAST(s_suppkey AS STRING) || '.mp3', CAST(s_suppkey AS STRING) || '.mp3', 7
FROM supplier WHERE s_suppkey % 10 = 1""",
    "fx_snapshot": """
SELECT event_type AS book_id, user_id AS catalog_id, ts AS captured_at, event_id AS pos, props AS doc
FROM events""",
    "fx_ledger_event": """
SELECT user_id AS item_id, ts AS at_ts, event_id AS seq,
       CASE event_type WHEN 'signup' THEN 'planned' WHEN 'view' THEN 'preflighted'
            WHEN 'click' THEN 'applied' WHEN 'purchase' THEN 'saved' ELSE 'failed' END AS to_state
FROM events""",
    "fx_block": """
SELECT conv_id AS page_id, turn AS pos, role, text FROM conversations""",
    "fx_base": "SELECT o_orderkey AS k, o_orderstatus AS v FROM orders WHERE o_orderkey % 11 <> 0",
    "fx_cur": """
SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS v
FROM orders WHERE o_orderkey % 13 <> 0""",
    "fx_want": """
SELECT o_orderkey AS k, CASE WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN 'Y'
            WHEN o_orderkey % 35 = 1 THEN 'X' ELSE o_orderstatus END AS v,
       o_orderkey % 19 = 0 AS is_delete
FROM orders WHERE o_orderkey % 17 <> 0""",
    "fx_query": """
SELECT CAST(c_custkey AS STRING) AS query_id, CAST(n_regionkey AS STRING) AS subject,
       CAST(c_nationkey AS STRING) AS grade,
       CASE WHEN c_acctbal < 0 THEN NULL WHEN c_custkey % 2 = 0 THEN '1' ELSE '2' END AS volume,
       'Reader ' || CAST(c_custkey % 200 AS STRING) AS book_name,
       CAST(n_regionkey AS STRING) || '/' || lower(c_mktsegment) AS catalog_path,
       c_mktsegment AS catalog_name, CAST(c_custkey % 7 AS STRING) AS catalog_sort
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "fx_candidate": """
SELECT CAST(s_suppkey AS STRING) AS candidate_id,
       CASE WHEN s_suppkey % 10 = 0 THEN NULL ELSE CAST(n_regionkey AS STRING) END AS subject,
       CAST(s_nationkey AS STRING) AS grade,
       CASE WHEN s_suppkey % 2 = 0 THEN '1' ELSE '2' END AS volume,
       'reader ' || CAST(s_suppkey AS STRING) AS book_name,
       CAST(n_regionkey AS STRING) || ' > ' || CASE s_suppkey % 3 WHEN 0 THEN 'BUILDING'
            WHEN 1 THEN 'machinery' ELSE 'other' END AS catalog_path,
       CASE s_suppkey % 2 WHEN 0 THEN 'HOUSEHOLD' ELSE 'AUTOMOBILE' END AS catalog_name,
       CAST(s_suppkey % 7 AS STRING) AS catalog_sort
FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    # One page capture per document: blocks, elements, modules and warnings.
    "fx_catblock": """
SELECT doc_id AS catalog_id, doc_id*10 + 1 AS block_id, 1 AS pos, '2-对话' AS name FROM documents
UNION ALL SELECT doc_id, doc_id*10 + 2, 2, '3-口语学习路径' FROM documents
UNION ALL SELECT doc_id, doc_id*10 + 3, 3, '4-单词和句型' FROM documents
UNION ALL SELECT doc_id, doc_id*10 + 4, 4, '5-Write' FROM documents WHERE doc_id % 50 <> 0
UNION ALL SELECT doc_id, doc_id*10 + 5, 5, '2-对话 copy' FROM documents WHERE doc_id % 60 = 1""",
    "fx_catelement": """
SELECT doc_id AS catalog_id, doc_id*10 + 1 AS block_id, 'e1' AS element_id, 'text' AS type, '一级标题（中文）' AS name, '' AS parent_name, '<p>' || source || '</p>' AS content FROM documents
UNION ALL SELECT doc_id, doc_id*10 + 1, 'e2', 'text', '一级标题（英文）', '', lang || ' &amp; ' || CAST(n_chars AS STRING) FROM documents
UNION ALL SELECT doc_id, doc_id*10 + 2, 'e3', 'text', '一级标题（英文）', '', 'Path<br>' || lang FROM documents
UNION ALL SELECT doc_id, doc_id*10 + 2, 'e4', 'text', '一级标题（中文）', '', '学习 ' || source FROM documents
UNION ALL SELECT doc_id, doc_id*10 + 3, 'e5', 'text', '文本 框', '句型', '<p>' || replace(text, chr(10), '</p><p>') || '</p>' FROM documents
UNION ALL SELECT doc_id, doc_id*10 + 3, 'e6', 'text', '文本框', '单词', '<ul><li>' || lang || '</li><li>' || source || '</li> <li>three</li>' || CASE WHEN n_chars % 2 = 0 THEN '<li>four</li>' ELSE '' END || '</ul>' FROM documents
UNION ALL SELECT doc_id, doc_id*10 + 3, 'e7', 'text', '中文翻译', '单词', '一<br>二<br/>三' || CASE WHEN n_chars % 3 <> 0 THEN '<br>四' ELSE '' END FROM documents""",
    "fx_catmodule": """
SELECT doc_id AS catalog_id, 'm1' AS element_id, '按钮-磨耳朵' AS element_name, 77 AS module_type, doc_id*100 + 1 AS model_id FROM documents
UNION ALL SELECT doc_id, 'm2', '按钮-看口语视频', 78, doc_id*100 + 2 FROM documents
UNION ALL SELECT doc_id, 'm3', '按钮-听句型讲解', 78, doc_id*100 + 3 FROM documents
UNION ALL SELECT doc_id, 'm4', '按钮-单词巧记', 79, doc_id*100 + 4 FROM documents
UNION ALL SELECT doc_id, 'm5', '按钮-句型巧练', 82, doc_id*100 + 5 FROM documents
UNION ALL SELECT doc_id, 'm6', '按钮-AI口语跟读测评', 79, doc_id*100 + 6 FROM documents
UNION ALL SELECT doc_id, 'm7', '按钮-口语PK', 87, doc_id*100 + 7 FROM documents
UNION ALL SELECT doc_id, 'm8', '打印', 84, doc_id*100 + 8 FROM documents WHERE doc_id % 40 <> 3""",
    "fx_catwarning": """
SELECT doc_id AS catalog_id, 1 AS pos, 'FONT_MAPPING_EMPTY' AS code, CAST(NULL AS STRING) AS element_id FROM documents
UNION ALL SELECT doc_id, 2, 'TEXT_LOST', CASE WHEN doc_id % 5 = 0 THEN 'e5' ELSE 'x9' END FROM documents WHERE doc_id % 2 = 0
UNION ALL SELECT doc_id, 3, 'MODULE_STALE', 'm4' FROM documents WHERE doc_id % 9 = 0""",
}

_WORD = re.compile(r"[A-Za-z_]\w*")


def _needs(sql: str) -> list[str]:
    """Views that a text uses, in definition order, with their own needs first."""
    found: set[str] = set()

    def visit(text: str) -> None:
        for word in set(_WORD.findall(text)):
            if word in VIEWS and word not in found:
                found.add(word)
                visit(VIEWS[word])

    visit(sql)
    return [name for name in VIEWS if name in found]


def oracle(sql: str) -> str:
    """Prefix a DuckDB text with the views it uses."""
    body = sql.strip()
    parts = ",\n".join(f"{name} AS ({VIEWS[name].strip()})" for name in _needs(body))
    if not parts:
        return body
    if body[:15].upper() == "WITH RECURSIVE ":
        return f"WITH RECURSIVE {parts},\n{body[15:]}"
    if body[:5].upper() == "WITH ":
        return f"WITH {parts},\n{body[5:]}"
    return f"WITH {parts}\n{body}"


def one_file_each(lines: DataFrame) -> DataFrame:
    """Rows ``source, value`` ready to be written as one file per source, in order of ``doc_id``."""
    return lines.repartition("source").sortWithinPartitions("source", "doc_id").select("source", "value")


class Tables:
    """Driver tables and audit views of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._frames:
            if name in VIEWS:
                self._frames[name] = self.sql(VIEWS[name])
            elif name in TABLES:
                self._frames[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            else:
                raise AttributeError(name)
        return self._frames[name]

    def sql(self, text: str) -> DataFrame:
        for word in set(_WORD.findall(text)):
            if word in TABLES or word in VIEWS:
                getattr(self, word).createOrReplaceTempView(word)
        return self.spark.sql(text)
