"""The corpus pipeline: documents judged, deduplicated twice, mixed and packed.

Every stage takes ``(spark, docs, sf_dir)`` and returns a table, which is written as
Parquet and read again as the documents of the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditflow.llm.common import checkpointed, keep_rows, keyed, one_of_each, split_by_keys, table
from auditflow.llm.exact_dedup import exact_dedup
from auditflow.llm.kneser_ney import quality_scores
from auditflow.llm.minhash import similar_texts
from auditflow.llm.mixing import fair_mix
from auditflow.llm.packing import best_fit_pack
from auditflow.session import work_folder

#: No SQL can express the language model of the first stage and the tokenizer of the last one.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity under trusted text is within the quantile of their language."""
    out = checkpointed(quality_scores(docs, table(spark, sf_dir, "labels")).where("NOT kept").select("row_key").distinct())
    rows, name = keyed(docs)
    sure, open_rows = split_by_keys(rows, name, out)
    fine = open_rows.join(out.withColumnRenamed("row_key", name), name, "left_anti")
    return sure.select(docs.columns).union(fine.select(docs.columns))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest id."""
    return keep_rows(docs, exact_dedup(docs).groupBy("row_key").agg(F.bool_or("kept").alias("kept"), F.count("*").alias("rows")))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word Jaccard similarity of 0.8 connects, the one with the smallest id."""
    found = similar_texts(docs)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row_key")).alias("first")
    stays = found.groupBy("component").agg(first).select(F.col("first.row_key").alias("row_key"), F.lit(True).alias("stays"))
    counts = found.groupBy("row_key").agg(F.count("*").alias("rows")).join(stays, "row_key", "left")
    return keep_rows(docs, counts.select("row_key", F.coalesce("stays", F.lit(False)).alias("kept"), "rows"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in the order of their virtual finish times."""
    plays = checkpointed(fair_mix(docs).select("row_key", "copies"))
    counts = plays.groupBy("row_key").agg(F.count("*").alias("rows"))
    rows, name = keyed(docs)
    at = name + "at"
    wanted = plays.where(F.size("copies") > 0).select(F.col("row_key").alias(name), F.explode("copies").alias(at))
    return one_of_each(rows, name, counts).join(wanted, name).orderBy(at).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 1024 tokens."""
    return best_fit_pack(docs).drop("ids")


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("mix", mix), ("pack", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
