"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditflow.llm import chat, exact_dedup, gru_lm, kneser_ney, mixing, packing, prefix_trie, runs, simhash, token_counts, url_filter, voronoi, warc
from auditflow.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    judged = url_filter.judge_urls(table(spark, folder, "pages"), url_filter.rules_table(spark))
    return judged.drop("component")


def op2_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    scored = kneser_ney.quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return scored.drop("row_key")


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, folder, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


def op4_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    said = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)], said.schema)
    return chat.digests(chat.format_chats(said.union(probe)))


def op5_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.fair_mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return voronoi.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op8_pack(spark: SparkSession, folder: str) -> DataFrame:
    return packing.best_fit_pack(table(spark, folder, "documents")).drop("ids")


def op9_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    return gru_lm.score_documents(table(spark, folder, "documents"))


def op10_warc_derivatives(spark: SparkSession, folder: str) -> DataFrame:
    made = warc.derivatives(warc.page_responses(table(spark, folder, "pages")))
    return made.withColumnRenamed("key", "page_id").drop("record")


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return runs.digests(runs.periodic_runs(runs.with_planted_periods(table(spark, folder, "documents"))))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    said = prefix_trie.turn_sequences(table(spark, folder, "conversations"))
    return prefix_trie.digests(prefix_trie.prefix_trie(prefix_trie.rebuilt(said)))


def op13_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"), limit=1024)


EXACT_DEDUP_SQL = """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
           FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)"""

QUERIES: dict[str, Query] = {
    "op1_url_filter": op1_url_filter,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_chat_format": op4_chat_format,
    "op5_mix_sources": op5_mix_sources,
    "op6_top_k": op6_top_k,
    "op7_simhash": op7_simhash,
    "op8_pack": op8_pack,
    "op9_lm_score": op9_lm_score,
    "op10_warc_derivatives": op10_warc_derivatives,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_token_counts": op13_token_counts,
}

ORACLES: dict[str, str] = {
    "op1_url_filter": url_filter.ORACLE,
    "op3_exact_dedup": EXACT_DEDUP_SQL,
    "op4_chat_format": chat.ORACLE,
    "op5_mix_sources": mixing.ORACLE,
    "op6_top_k": voronoi.ORACLE,
    "op12_prefix_trie": prefix_trie.ORACLE,
}
