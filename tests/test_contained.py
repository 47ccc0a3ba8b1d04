"""Names inside names, against brute force, and what the lookup keeps."""

import random

import pytest
from pyspark.sql import functions as F

from auditflow import queries as Q
from auditflow.operators import matching


def pairs(spark, needles, names):
    made = matching.contained_names(spark.createDataFrame([(x,) for x in needles], "a string"), spark.createDataFrame([(x,) for x in names], "b string"))
    return sorted(map(tuple, made.collect()))


@pytest.mark.parametrize("letters", ["ab", "abcdefgh ", "aé中😀\0"])
def test_equals_brute_force_at_every_length(spark, letters):
    rng = random.Random(letters)
    names = ["".join(rng.choices(letters, k=k)) for k in [0, 1, 2, 3, 22, 23, 24, 25, 26, 60, 300] for _ in range(3)] + ["a" * 40, None]
    needles = [n[i:i + k] for n in names if n for k in (1, 2, 3, 4, 22, 23, 24, 25, 30, 90) for i in (0, 1, len(n) - k) if 0 <= i <= len(n) - k]
    needles += ["".join(rng.choices(letters, k=k)) for k in (1, 3, 23, 24, 40)] + ["a" * 24, "", None]
    want = sorted({(x, n) for x in needles if x for n in names if n and x in n and len(n) > len(x)})
    assert len(want) > 100
    assert pairs(spark, needles, names) == want


def test_texts_are_kept_once(spark, monkeypatch):
    rng, kept = random.Random(1), []

    def noted(df, keep=matching.checkpointed):
        df = keep(df)
        texts = [c for c, kind in df.dtypes if kind == "string"]
        kept.append(df.select(F.sum(sum((F.length(c) for c in texts), F.lit(0)))).first()[0] or 0)
        return df

    monkeypatch.setattr(matching, "checkpointed", noted)
    names = ["".join(rng.choices("abcdefghijklmnop ", k=2000)) for _ in range(8)]
    assert pairs(spark, [n[40:140] for n in names], names) == sorted((n[40:140], n) for n in names)
    assert sum(kept) <= 2 * sum(map(len, names))


def test_marks_that_no_needle_has_stay_in_their_task(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choices("abcdefghijklmnop ", k=2000)) for _ in range(20)]
    names = spark.createDataFrame([(x,) for x in texts], "name string")
    marked = spark.createDataFrame([(x[40:140],) for x in texts[:3]], "needle string").select("needle", matching._pieces(F.substring("needle", 1, matching.LONG), matching._marks))
    every = names.select(matching._pieces(F.col("name"), matching._marks))
    met = names.select(matching._pieces(F.col("name"), matching._marks, matching._mask(marked)))
    assert every.count() > 5000
    assert sorted(map(tuple, met.collect())) == sorted(map(tuple, every.join(marked, "piece", "left_semi").collect())) and met.count() == 3


def test_needles_in_parts_find_the_same(spark, monkeypatch):
    monkeypatch.setattr(matching, "HELD", 3)
    names = ["unit one: letters", "unit two: numbers and letters", "a review of unit one and of unit two"]
    needles = ["unit", "one", "two", "let", "x", "n", "of", "letters", "unit one: letters", "numbers and", "review of unit one and of unit"]
    assert pairs(spark, needles, names) == sorted((x, n) for x in needles for n in names if x in n and x != n)


def test_query_reads_texts_of_every_length(spark, data):
    made = Q.queries()["C9_contained_names"](spark, data).select("name").distinct()
    every = spark.read.parquet(f"{data}/documents.parquet").where("n_chars > 3000").select(F.sha2("text", 256).alias("name")).distinct()
    assert every.count() > 5
    assert every.join(made, "name", "left_anti").isEmpty()
