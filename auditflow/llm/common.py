"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditflow.session import checkpointed, work_folder

__all__ = ["LOWER", "UPPER", "WORD", "Shelf", "ascii_lower", "checkpointed", "keep_rows", "keyed", "one_of_each", "row_key", "split_by_keys", "table", "text_of", "word_count"]

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: A word is a run of anything but the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_of(name: str) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Only A-Z are lower-cased."""
    return F.translate(text, UPPER, LOWER)


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def row_key(doc_id: str, text: str) -> Column:
    """64 bits of id and text; rows that agree in both share it and every decision."""
    return F.xxhash64(F.col(doc_id), F.col(doc_id).isNull(), F.col(text), F.col(text).isNull())


def keyed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, str]:
    """The rows with their key in a column of a free name, and that name."""
    name = "_row_key"
    while name.lower() in [c.lower() for c in docs.columns]:
        name += "_"
    return docs.withColumn(name, row_key(doc_id, text)), name


def split_by_keys(rows: DataFrame, name: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is surely not among ``keys (row_key)``, and the others, which need an exact look.

    The keys are folded into a bitmap of fixed size, at most 2**18 words of 64 bits, so
    it can be broadcast however many keys there are.  It has no false negatives.
    """
    def word(key: Column) -> Column:
        return F.shiftrightunsigned(key, 64 - 18)

    bit = F.expr("shiftleft(1L, cast(row_key & 63 AS int))")
    bitmap = checkpointed(keys.groupBy(word(F.col("row_key")).alias(name + "word")).agg(F.bit_or(bit).alias(name + "bits")))
    tagged = rows.withColumn(name + "word", word(F.col(name))).join(F.broadcast(bitmap), name + "word", "left")
    found = F.coalesce(F.expr(f"(shiftrightunsigned(`{name}bits`, cast(`{name}` & 63 AS int)) & 1) = 1"), F.lit(False))
    return tuple(tagged.where(w).select(*[F.col(f"`{c}`") for c in rows.columns]) for w in (~found, found))


def one_of_each(rows: DataFrame, name: str, counts: DataFrame) -> DataFrame:
    """One row for each key of ``counts (row_key, rows)``; only rows of keys that repeat are compared."""
    counts = counts.select(F.col("row_key").alias(name), "rows")
    single = rows.join(counts.where("rows = 1").select(name), name, "left_semi")
    many = rows.join(counts.where("rows > 1").select(name), name, "left_semi").dropDuplicates([name])
    return single.union(many)


def keep_rows(docs: DataFrame, judged: DataFrame) -> DataFrame:
    """One row of ``docs`` for each key of ``judged (row_key, kept, rows)`` that is kept.

    Rows that are kept and do not repeat, most of them, pass without a shuffle.
    """
    rows, name = keyed(docs)
    judged = checkpointed(judged)
    sure, open_rows = split_by_keys(rows, name, judged.where("NOT kept OR rows > 1").select("row_key"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return sure.select(*columns).union(one_of_each(open_rows, name, judged.where("kept")).select(*columns))


class Shelf:
    """Tables in a new folder of the shared one, dropped as soon as nothing needs them any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folder = spark, work_folder(spark)

    def put(self, name: str, rows: DataFrame) -> DataFrame:
        """The rows, written once; whatever made them is not needed again."""
        rows.write.parquet(f"{self.folder}/{name}")
        self._clean()
        return self.spark.read.schema(rows.schema).parquet(f"{self.folder}/{name}")

    def drop(self, *names: str) -> None:
        context = self.spark.sparkContext
        for name in names:
            path = context._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
        self._clean()

    def _clean(self) -> None:
        """Collect what the driver no longer refers to, upon which Spark deletes its shuffle files and broadcasts."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()
