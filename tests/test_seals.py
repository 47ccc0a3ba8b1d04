"""Digests and seals over texts that are spread over many rows."""

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from auditflow.operators.digest import streamed_digest
from auditflow.operators.seals import ledger_seals, validate_ledger_heads


@pytest.mark.parametrize("chunk", [1, 20, 1 << 20])
def test_digest_reads_rows_in_order(spark, chunk):
    rng = random.Random(chunk)
    rows = [(rng.choice(["a", "b", None]), n % 5, n, rng.choice(["", "x", "é€", None, "long " * 9])) for n in range(700)] + [("one", 0, 0, None)]
    df = spark.createDataFrame(rows, "who string, part int, at long, said string").repartition(7)
    got = {r.who: (r.n_texts, r.sha256) for r in streamed_digest(df, ["who"], ["part", "at"], "said", ", ", chunk).collect()}
    want = {}
    for who in ("a", "b", None, "one"):
        texts = [r[3] or "" for r in sorted((r for r in rows if r[0] == who), key=lambda r: r[1:3])]
        want[who] = (len(texts), hashlib.sha256(", ".join(texts).encode()).hexdigest())
    assert got == want
    assert streamed_digest(df.where("at < 0"), ["who"], ["at"], "said").count() == 0


def seal(ledger):
    return "sha256:" + hashlib.sha256(json.dumps(ledger, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()


def sealed(**changes):
    skill = {"rule_pack_hash": "sha256:" + "0" * 64, "name": "né \"q\""}
    ledger = {"schema_version": 2, "ledger_id": "L", "skill": skill, "z": None, "a": [1, {"y": 1, "b": []}], "items": [{"b": 1, "a": [n]} for n in range(40)]} | changes
    return ledger | {"integrity_hash": seal(ledger)}


def tables(spark, ledgers, drop=()):
    heads = [(n, json.dumps({k: v for k, v in x.items() if k != "items"})) for n, x in enumerate(ledgers)]
    items = [(n, at, json.dumps(item, indent=1)) for n, x in enumerate(ledgers) for at, item in enumerate(x["items"])]
    return (spark.createDataFrame([h for h in heads if h[0] not in drop], "ledger long, head string"),
            spark.createDataFrame(items, "ledger long, position int, item string").repartition(5))


def test_seal_is_the_hash_of_the_whole_ledger(spark):
    ledgers = [sealed(), sealed(items=[]), sealed(items=[{"only": 1}]), sealed(zz=1, A=2)]
    heads, items = tables(spark, ledgers)
    assert {r.ledger: r.seal for r in ledger_seals(heads, items).collect()} == {n: x["integrity_hash"] for n, x in enumerate(ledgers)}
    found = {(r.entity_id, r.rule_code) for r in validate_ledger_heads(heads, items).collect()}
    assert found == {("1", "items_empty")}


def test_tampering_shows(spark):
    moved, lost, head, key = sealed(), sealed(), sealed(), sealed()
    moved["items"] = [moved["items"][1], moved["items"][0], *moved["items"][2:]]
    lost["items"] = lost["items"][:-1]
    head["a"] = [1]
    key["integrity_hash"] = key["integrity_hash"].upper()
    heads, items = tables(spark, [moved, lost, head, key, sealed(skill=3), sealed()], drop=[5])
    found = {(r.entity_id, r.rule_code) for r in validate_ledger_heads(heads, items).collect()}
    assert found == {("0", "integrity_mismatch"), ("1", "integrity_mismatch"), ("2", "integrity_mismatch"), ("3", "integrity_form"), ("4", "skill_not_object"), ("5", "ledger_missing")}
    odd = spark.createDataFrame([(1, None), (2, "[1]"), (3, "{")], "ledger long, head string")
    found = {(r.entity_id, r.rule_code) for r in validate_ledger_heads(odd, items.where("ledger < 0")).collect()}
    assert found == {("1", "ledger_missing"), ("2", "ledger_not_object"), ("3", "ledger_not_object")}
    assert validate_ledger_heads(odd.where("ledger < 0"), items.where(F.lit(False))).count() == 0
