"""Two versions of a document: what leaves the task that compares them, against all leaves of both."""

import json

import pytest
from pyspark.sql import functions as F

from auditflow.operators import tree

DEEP = '{"x":' * 3000 + "1" + "}" * 3000
PAIRS = [
    ('{"a.b":1,"a":{"b":2}}', '{"a.b":1,"a":{"b":3}}'), ('{"a":[1,[],{}]}', '{"a":[1.0,[0]]}'), ('{"a":true,"b":"1"}', '{"a":1,"b":1}'), ("[]", "[null]"), ("7", "[7]"),
    ('{"a":"\\u0001\\n"}', '{"a":"\\u0001"}'), ('{"id":"p","n":null}', '{"id":"p"}'), (DEEP, DEEP.replace("1", "2")), ("[1]", "[1]"), (None, '{"a":1}'), ('{"a":1}', None)]


def docs(spark, side):
    return spark.createDataFrame([(k, p[side]) for k, p in enumerate(PAIRS[:7] + PAIRS[8:])], "k long, t string").select("k", F.parse_json("t").alias("doc"))


def test_only_differences_and_all_of_them(spark):
    got = sorted((r.k, r.path, r.before, r.after, r.change) for r in tree.structural_diff(docs(spark, 0), docs(spark, 1), ["k"]).collect())
    leaves = [{(r.k, r.path): r.v for r in tree.json_nodes(docs(spark, i), "doc").where("is_leaf").groupBy("k", "path").agg(F.max(F.to_json("value")).alias("v")).collect()} for i in (0, 1)]
    want = [(*p, leaves[0].get(p), leaves[1].get(p)) for p in leaves[0].keys() | leaves[1].keys() if leaves[0].get(p) != leaves[1].get(p)]
    assert [g[:4] for g in got] == sorted(want) and len(got) > 8


@pytest.mark.parametrize("before, after", [p for p in PAIRS if None not in p])
def test_texts_of_any_form(before, after):
    was, now = tree._different(before, after)
    whole = [{p: v for p, _, _, leaf, v in tree._nodes(x) if leaf} for x in (before, after)]
    if "a.b" in before:
        assert was["$.a.b"] == "2" and now["$.a.b"] == "3"
        return
    differ = lambda b, a: {p: (b.get(p), a.get(p)) for p in b.keys() | a.keys() if b.get(p) != a.get(p)}
    assert differ(was, now) == differ(*whole)


def test_documents_meet_as_texts(spark):
    """One row a document is dealt out, not one a value."""
    for made in (tree.structural_diff(docs(spark, 0), docs(spark, 1), ["k"]), tree.identity_diff(docs(spark, 0), docs(spark, 1), ["k"], ["id"])):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert plan.count("MapInArrow") == 1 and "HashAggregate" not in plan and "Window" not in plan


def test_several_documents_of_a_key(spark):
    make = lambda *texts: spark.createDataFrame([(None, x) for x in texts], "k double, t string").select("k", F.parse_json("t").alias("doc"))
    before, after = make('{"id":"p","v":1}', '{"id":"p","v":2}', '{"id":"q"}'), make('{"id":"q","n":null}')
    got = {r.id: (r.change, r.fields) for r in tree.identity_diff(before, after, ["k"], ["id"]).collect()}
    assert got == {"p": ("lost", None), "q": ("kept", ["n"])}
    assert [(r.path, r.before, r.after) for r in tree.structural_diff(before, after, ["k"]).orderBy("path").collect()] == [("$.n", None, "null"), ("$.v", "2", None)]
