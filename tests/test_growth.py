"""Steps that must not be done more often as tables grow."""

import numpy as np
from pyspark.sql import functions as F

from auditflow.fixtures import Tables
from auditflow.operators import ledger as L
from auditflow.operators import packs, provenance, schema
from auditflow.operators import targets as T
from auditflow.plans import pipelines as P
from auditflow.queries.pipelines import CAPTURES
from auditflow.queries.validators import ELEMENTS, target_tables
from auditflow.sources.scans import with_document


def plan_text(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def one_by_one(rows):
    """Bindings kept when events are taken in order."""
    lock_of, owner_of, kept = {}, {}, set()
    for seq, p, lock in rows:
        if lock_of.get(p, lock) == lock and owner_of.get(lock, p) == p:
            lock_of[p], owner_of[lock] = lock, p
            kept.add(seq)
    return kept


def chain(n):
    return [(i, f"p{(i + 1) // 2}", f"l{i // 2}") for i in range(n)]


def bindings(spark, rows):
    return spark.createDataFrame([(*r, None, "planned") for r in rows], "seq bigint, prospective string, lock_key string, real_book string, state string")


def test_a_chain_in_one_range_takes_no_doubling(spark, monkeypatch):
    calls = []
    once = L.checkpointed
    monkeypatch.setattr(L, "checkpointed", lambda df: calls.append(1) or once(df))
    left = bindings(spark, chain(2048)).select("prospective", "lock_key", "real_book", F.col("seq").alias("at"))
    got = {r["at"] for r in L._settle_chains(left).where("keep").collect()}
    assert got == set(range(0, 2048, 2))
    assert len(calls) <= 4


def test_chains_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(L, "RANGE_ROWS", 17)
    places = np.random.default_rng(5).permutation(150)
    shuffled = sorted((int(places[i]), p, lock) for i, p, lock in chain(150))
    for rows in (chain(150), shuffled):
        kept, _ = L.identity_bindings(bindings(spark, rows))
        assert {r["seq"] for r in kept.collect()} == one_by_one(rows)


def captures(spark):
    docs = [(i, f"one\ntwo {i}", "en", "web", 5 + i) for i in range(1, 6)]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").createOrReplaceTempView("documents")
    return with_document(spark.sql(CAPTURES)).drop("raw", "parse_error")


def test_reports_of_variants_do_not_parse_captures_again(spark):
    assert "parsejson" not in plan_text(P.variant_profile(captures(spark))).lower()


def test_catalogs_do_not_parse_captures_again(spark):
    none = spark.createDataFrame([], "catalog_id bigint, sentences array<string>, sentence_evidence string, words_english array<string>, words_chinese array<string>, "
                                 "word_pairing_evidence string, accept_relevant_warnings array<struct<code:string,target_element_id:string>>")
    wanted = spark.range(1, 8).withColumnRenamed("id", "catalog_id")
    out = P.source_manifest(captures(spark), wanted, none)
    assert "parsejson" not in plan_text(out.catalogs).lower() + plan_text(out.missing).lower()
    assert {r["catalog_id"] for r in out.missing.collect()} == {6, 7}
    assert {r["catalog_id"] for r in out.catalogs.collect()} == set(range(1, 6))


def test_modules_are_not_sent_once_for_each_count(spark):
    found = T.verify_targets(*target_tables(Tables(spark, "/root/testdata/sf0.001")), "500", ELEMENTS, "mx")
    assert "Expand" not in plan_text(found)


def test_kinds_of_pack_nodes_are_found_once(spark):
    rows = spark.createDataFrame([(1, "$", "$", "{}")], "pack bigint, path string, pattern string, raw string")
    nodes = rows.select("pack", "path", "pattern", F.try_parse_json("raw").alias("value"))
    plan = plan_text(schema.schema_faults(nodes, schema.compile_schema(spark, packs.RULE_PACK), ["pack"]))
    assert plan.count("schemaOfVariant(") == 1


def test_a_provenance_text_is_parsed_once(spark):
    plan = plan_text(provenance.validate_seals(spark.createDataFrame([(1, "{}")], "run_id bigint, provenance string")))
    # the text itself, its baseline and its body
    assert plan.count("parseJson(") == 3
