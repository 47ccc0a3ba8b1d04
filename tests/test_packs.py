"""Rule pack documents: odd documents and the compiled schema."""

from pyspark.sql import functions as F

from auditflow.operators import packs, schema
from auditflow.queries.validators import PACK


def faults(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "pack_id long, raw string").withColumn("doc", F.try_parse_json("raw"))
    return sorted((r.entity_id, r.rule_code, r.message) for r in packs.validate_pack_documents(df).collect())


def test_odd_documents(spark):
    assert faults(spark, PACK, "3", None, "[]") == [("1", "field_type", "$"), ("2", "field_type", "$"), ("3", "field_type", "$")]
    found = faults(spark, "{}")
    assert {f[1] for f in found} == {"field_missing"} and len(found) == 9
    assert packs.validate_pack_documents(spark.createDataFrame([], "pack_id long, raw string").select("pack_id", F.try_parse_json("raw").alias("doc"))).count() == 0


def test_numbers_and_nulls_keep_their_kind(spark):
    numbers = PACK.replace('"order":1,', '"order":1.0,').replace('"priority":1,', '"priority":null,').replace('"max":null', '"max":0.5', 1)
    assert faults(spark, numbers) == [("0", "field_type", "$.rules[0].source.cardinality.max"), ("0", "field_type", "$.templates.variants[0].priority")]


def test_patterns_fold_steps(spark):
    paths = ["$.rules[3].action.steps[0].steps[12].type", "$.rules[0].action.steps[4].steps", "$.a[1][2]"]
    got = spark.createDataFrame([(p,) for p in paths], "p string").select(schema.pattern_of(F.col("p"))).collect()
    assert [r[0] for r in got] == ["$.rules[].action.steps[].type", "$.rules[].action.steps[].steps", "$.a[][]"]
