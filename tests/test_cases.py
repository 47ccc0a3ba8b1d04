"""Literal cases: small inputs with a known outcome."""

import json

import pytest
from pyspark.sql import functions as F

from auditflow.functions import canon, layout, text
from auditflow.operators import annotations, extract, fold, ledger, matching, ranges, receipts, rulepacks, tree, windows
from auditflow.plans import pipelines
from auditflow.sources import scans


def rows(df):
    return [tuple(r) for r in df.collect()]


def one(spark, column, **values):
    return spark.range(1).select(column(**values) if callable(column) else column).first()[0]


def test_three_way(spark):
    side = lambda d: spark.createDataFrame([(k, json.dumps(v)) for k, v in d.items()], "k string, value string")
    plan = matching.plan_refinement(
        side({"title": "old", "button": "a", "layout": 1}), side({"title": "old", "button": "b", "layout": 2}),
        side({"title": "new", "button": "c", "layout": 2}), ["k"])
    assert {r.k: r.classification for r in plan.collect()} == {"title": "safe", "button": "conflict", "layout": "noop"}


def test_three_way_delete_already_done(spark):
    base = spark.createDataFrame([("x", "1")], "k string, value string")
    none = spark.createDataFrame([], "k string, value string")
    want = spark.createDataFrame([("x", None, True)], "k string, value string, is_delete boolean")
    row = matching.plan_refinement(base, none, want, ["k"]).first()
    assert (row.classification, row.reason, row.operation) == ("noop", "current_already_matches_desired", "delete")


def test_three_way_null_is_a_value(spark):
    base = spark.createDataFrame([("x", "null")], "k string, value string")
    none = spark.createDataFrame([], "k string, value string")
    want = spark.createDataFrame([("x", "1")], "k string, value string")
    assert matching.plan_refinement(base, none, want, ["k"]).first().classification == "conflict"


META = "subject string, grade string, volume string, book_name string, catalog_path string, catalog_name string, catalog_sort string"


def scored(spark, query, candidates):
    q = spark.createDataFrame([("q", *query)], "query_id string, " + META)
    c = spark.createDataFrame(candidates, "candidate_id string, " + META)
    lists = c.select(F.lit("q").alias("query_id"), "candidate_id")
    return q, c, matching.match_source(q, c, lists)


def test_source_match_exact_and_wrong_subject(spark):
    q, c, s = scored(spark, ("English", "3", "上", "Book A", "A/B", "Unit 1", "1"), [
        ("right", "english", "3", "1", "book a", "a > b", "Unit 1", "1"), ("wrong", "math", "3", "1", "book a", "a/b", "Unit 1", "1")])
    got = {r.candidate_id: (r.score, r.confidence, list(r.rejections)) for r in s.collect()}
    assert got == {"right": (85, "high", []), "wrong": (0, "rejected", ["subject_mismatch"])}
    assert matching.unique_top(s).first().top_candidate_id == "right"
    assert matching.recall_top(q, c).first().asDict() == {
        "query_id": "q", "top_score": 85, "n_top": 1, "unique_top": True, "top_candidate_id": "right"}


def test_source_match_without_metadata_is_never_unique(spark):
    q, c, s = scored(spark, (None,) * 7, [("only",) + (None,) * 7])
    top = matching.unique_top(s).first()
    assert (top.top_score, top.unique_top, top.top_candidate_id) == (0, False, None)
    assert matching.recall_top(q, c).first().unique_top is False


def test_source_match_missing_core_is_not_high(spark):
    _, _, s = scored(spark, ("e", "3", "1", "Book", "a/b", None, None), [("c", None, "3", "1", "book", "a/b", None, None)])
    assert (s.first().score, s.first().confidence) == (70, "medium")


def ledger_run(spark, events):
    df = spark.createDataFrame(events, "item_id string, seq int, to_state string, evidence string")
    return ledger.ledger_decisions(df, ["seq"])


SHA = "sha256:" + "a" * 64


def test_outcome_unknown_needs_readback(spark):
    path = [("i", 1, "planned", "{}"), ("i", 2, "outcome_unknown", '{"reason":"lost"}'),
            ("i", 3, "saved", json.dumps({"save_readback_hash": SHA})),
            ("i", 4, "saved", json.dumps({"save_readback_hash": SHA, "readback_recovery": True}))]
    assert [r.accepted for r in ledger_run(spark, path).orderBy("seq").collect()] == [True, True, False, True]


def test_legal_path_and_terminal_state(spark):
    full = {"fingerprint": {}, "target_after_hash": SHA, "save_readback_hash": SHA, "result_hash": SHA, "provenance_hash": SHA, "receipt": "r"}
    names = ["planned", "preflighted", "applied", "saved", "verified", "planned"]
    made = ledger_run(spark, [("i", n, s, json.dumps(full)) for n, s in enumerate(names)])
    state = ledger.ledger_states(made, ["seq"]).first()
    assert (state.state, state.attempt, state.n_rejected) == ("verified", 1, 1)


def claims(spark, events):
    df = spark.createDataFrame(
        [("k", n, *e) for n, e in enumerate(events)],
        "idempotency_key string, seq int, item_id string, action string, status string, result_hash string, target_before_hash string")
    return [r.disposition for r in ledger.claim_outcomes(df, ["seq"]).orderBy("seq").collect()]


def test_claims(spark):
    assert claims(spark, [("a", "claim", None, None, "x"), ("b", "claim", None, None, "x")]) == ["claimed", "conflict"]
    verified = [("a", "claim", None, None, "x"), ("a", "status", "verified", "h", None)]
    assert claims(spark, verified + [("b", "claim", None, None, "h")]) == ["claimed", "verified_skip"]
    assert claims(spark, verified + [("b", "claim", None, None, "other")]) == ["claimed", "verified_target_drift"]
    dropped = [("a", "claim", None, None, "x"), ("a", "status", "superseded", None, None)]
    assert claims(spark, dropped + [("b", "claim", None, None, "x")]) == ["claimed", "claimed_superseded"]
    assert claims(spark, dropped + [("a", "claim", None, None, "x")]) == ["claimed", "conflict"]


def test_same_work_twice_in_one_list(spark):
    items = spark.createDataFrame(
        [("first", 1, "s", "t", "r", "book", "all", "x"), ("second", 2, "s", "t", "r", "book", "all", "x")],
        "item_id string, position int, source_snapshot_hash string, template_snapshot_hash string, rule_pack_hash string, "
        "stable_identity string, catalog_scope string, target_before_hash string")
    registry = spark.createDataFrame([], "idempotency_key string, status string, verified_hash string")
    got = {r.item_id: (r.state, r.winner) for r in pipelines.init_ledger(items, registry).collect()}
    assert got == {"first": ("pending", "first"), "second": ("conflict", "first")}


def test_drift_before_apply(spark):
    schema = "item_id string, source_snapshot_hash string, template_snapshot_hash string, rule_pack_hash string, target_before_hash string, resolved_template_id string"
    row = ledger.drift(spark.createDataFrame([("i", "s", "t", "r", "b", "1")], schema), spark.createDataFrame([("i", "s", "t", "r", "c", "1")], schema)).first()
    assert (row.next_state, row.claim_status, [d.field for d in row.differences]) == ("planned", "planned", ["target_before_hash"])


def test_published_hash_values(spark):
    df = spark.createDataFrame([("abc", '{"b":1,"a":2}')], "s string, j string")
    row = df.select(canon.fnv1a32("s"), canon.canonical_json("j"), canon.canonical_hash("j")).first()
    import hashlib
    assert tuple(row) == ("fnv1a32:1a47e90b", '{"a":2,"b":1}', "sha256:" + hashlib.sha256(b'{"a":2,"b":1}').hexdigest())


def test_hash_counts_utf16_units(spark):
    def reference(value):
        h = 0x811C9DC5
        data = value.encode("utf-16-be")
        for i in range(0, len(data), 2):
            h = ((h ^ int.from_bytes(data[i:i + 2], "big")) * 0x01000193) & 0xFFFFFFFF
        return f"fnv1a32:{h:08x}"

    values = ["", "é", "学习", "a😀b", "\n\t", "x" * 5000]
    df = spark.createDataFrame([(v,) for v in values], "s string")
    assert [r[0] for r in df.select(canon.fnv1a32("s")).collect()] == [reference(v) for v in values]
    assert [r[0] for r in df.select(layout.js_length("s")).collect()] == [len(v.encode("utf-16-be")) // 2 for v in values]


def test_page_hash_keeps_stored_key_order(spark):
    export = {"slideId": "1", "blocks": [{"uuid": "u", "sort": 7, "template_data_content": {"z": 1, "a": [2]}, "template_info": {"k": 1, "content": {"y": 1, "b": 2}}}]}
    shaped = [{"uuid": "u", "sort": 1, "template_data_content": '{"z":1,"a":[2]}', "template_info": {"k": 1, "content": '{"y":1,"b":2}'}}]
    canonical = json.dumps(shaped, sort_keys=True, separators=(",", ":"))
    df = spark.createDataFrame([(json.dumps(export), canonical)], "x string, c string")
    got = df.select(canon.page_content_hash(receipts.export_blocks("x")), canon.fnv1a32("c")).first()
    assert got[0] == got[1]


def test_restyle(spark):
    html = '<b style="color:red;font-size:9px">a</b><b>c</b><br><span class="k" style="margin:0">d</span>&lt; e < f'
    df = spark.createDataFrame([(html,)], "h string")
    assert df.select(text.restyled("h")).first()[0] == '<span style="color:red;">a</span><span>c</span><br><span class="k" >d</span>&lt; e < f'


def test_entity_order(spark):
    df = spark.createDataFrame([("<p>&amp;lt;b&amp;gt;</p><p> x  y </p><p></p>",)], "h string")
    assert df.select(text.html_lines("h")).first()[0] == ["<b>", "x y"]


def test_numbers(spark):
    cases = {" 12 ": 12.0, "": None, "1e3": 1000.0, "0x1F": 31.0, "0b11": 3.0, "5d": None, "Infinity": None, "1e999": None, ".5": 0.5, "-3": -3.0}
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    assert [r[0] for r in df.select(text.finite_number("s")).collect()] == list(cases.values())


def test_long_numbers_and_wide_blanks(spark):
    cases = {"0x" + "F" * 20: float(int("F" * 20, 16)), "0b" + "10" * 35 + "1": float(int("10" * 35 + "1", 2)), "\u3000\t7\n\u00a0": 7.0,
             "0o" + "7" * 30: float(int("7" * 30, 8)), "0x" + "0" * 50 + "1F": 31.0, "0x20000000000001" + "0" * 9 + "1": float(int("20000000000001" + "0" * 9 + "1", 16)), "0x" + "F" * 400: None, "0x0": 0.0}
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    assert [r[0] for r in df.select(text.finite_number("s")).collect()] == list(cases.values())
    names = spark.createDataFrame([("\u3000a\u00a0\u2009 b\ufeff",)], "s string")
    assert names.select(text.normalize_name("s"), text.compact_text("s"), text.html_lines(F.concat("s", F.lit("<br>\u3000")))).first() == ("a b", "ab", ["a b"])


def test_broken_captures_leave_a_trace(spark):
    rows_in = [(1, "2024-01-01", "old", '{"snapshot":{}}'), (1, "2024-01-02", "broken", None), (2, None, "timeless", '{"snapshot":{}}'), (2, "2024-01-01", "timed", '{"snapshot":{}}'), (3, "2024-01-01", "lost", None)]
    caps = spark.createDataFrame(rows_in, "catalog_id bigint, captured_at string, path string, raw string").withColumn("doc", F.try_parse_json("raw"))
    assert rows(pipelines.latest_captures(caps).select("catalog_id", "path")) == [(1, "old"), (2, "timed")]
    wanted = spark.createDataFrame([(1,), (2,), (3,), (4,)], "catalog_id bigint")
    assert rows(matching.missing(wanted, caps.where("doc IS NOT NULL"), ["catalog_id"]).select("catalog_id")) == [(3,), (4,)]


def test_trees_of_any_depth(spark):
    def nested(n):
        return '[{"name":"x","child_list":' * n + '[]' + "}]" * n
    df = spark.createDataFrame([(n, nested(n)) for n in (1, 3, 8, 9, 30)] + [(0, "{}")], "id int, j string").select("id", F.try_parse_json("j").alias("root"))
    got = tree.flatten_tree(df, "root", levels=3).groupBy("id").agg(F.count("*").alias("n"), F.max("depth").alias("d"), F.max(F.size("parent_names")).alias("p"))
    assert rows(got) == [(n, n, n, n - 1) for n in (1, 3, 8, 9, 30)]
    deep = spark.createDataFrame([(1, '{"a":' * 25 + '{"key":[1,{"key":{}}]}' + "}" * 25)], "id int, j string").select("id", F.try_parse_json("j").alias("doc"))
    path = "$" + ".a" * 25 + ".key"
    assert sorted(r.path for r in tree.key_paths(deep, "doc", "key").collect()) == [path, f"{path}[1].key"]
    assert sorted(r.path for r in tree.json_nodes(deep, "doc").where("is_leaf").collect()) == [f"{path}[0]", f"{path}[1].key"]


def test_action_depth_limit(spark):
    def nested(n):
        return '{"type":"atomic_sequence","intent":"x","steps":[' * n + '{"type":"leaf","intent":"y"}' + "]}" * n
    df = spark.createDataFrame([("fits", nested(8)), ("deep", nested(9))], "rule string, j string").select("rule", F.try_parse_json("j").alias("action"))
    found = rulepacks.action_violations(rulepacks.flatten_actions(df, ["rule"]), F.col("rule"))
    assert rows(found.select("entity_id", "rule_code")) == [("deep", "action_depth")]


def test_envelope_path_rules(spark):
    df = spark.createDataFrame([("a/b", "../c.json"), ("a", "../../x"), ("", "/etc/x"), ("a", "./b//c")], "base string, rel string")
    got = [r[0] for r in df.select(matching.relative_path(F.col("base"), F.col("rel"))).collect()]
    assert got == ["a/c.json", None, None, "a/b/c"]


def test_recent_topics_adjacent_ability_pages_share_a_unit(spark):
    pages = [("b", i, "normal", f"t{i}") for i in range(1, 7)] + [("b", 7, "ability", "A"), ("b", 8, "ability", "B"), ("b", 9, "normal", "t9"), ("b", 10, "ability", "A")]
    df = spark.createDataFrame(pages, "book_id string, pos int, route string, topic string")
    got = {r.pos: (list(r.topics), r.status) for r in windows.recent_topics(df).collect()}
    five = ["t6", "t5", "t4", "t3", "t2"]
    assert got == {7: (five, "resolved"), 8: (five, "resolved"), 10: (["t9"], "needs_review")}


def test_segments_keep_long_groups_whole(spark):
    df = spark.range(2500).select(F.lit("k").alias("k"), F.col("id").alias("pos"))
    got = ranges.segments(df, ["k"], ["pos"], F.col("pos"), "items", 1000).orderBy("segment").collect()
    assert [(r.segment, r.n_items) for r in got] == [(0, 1000), (1, 1000), (2, 500)]
    assert [v for r in got for v in r.items] == list(range(2500))


def test_composed_map_equals_stepping():
    import random

    class Random(fold.Machine):
        start = "a|0"

        def moves(self, event):
            return event

    states = [f"{c}|{i}" for c in "abc" for i in range(4)]
    rng = random.Random(7)
    for _ in range(300):
        events = []
        for _ in range(rng.randrange(1, 12)):
            exact = {rng.choice(states): rng.choice(states) for _ in range(rng.randrange(3))}
            broad = (rng.choice("abc"), rng.choice(states), tuple(rng.sample(states, 1))) if rng.random() < 0.4 else None
            if broad:
                exact = {k: v for k, v in exact.items() if k.partition("|")[0] != broad[0]}
            events.append((exact, broad))
        composed = fold.Composed()
        for event in reversed(events):
            composed.prepend(*event)
        machine = Random()
        for state in states:
            now = state
            for event in events:
                now = machine.step(now, event) or now
            assert composed.end(state) == now


@pytest.mark.parametrize(("seed", "names", "share"), [(3, 8, 0.25), (4, 40, 0.9), (5, 25, 2.0)])
def test_identity_bindings_equal_taking_events_in_turn(spark, monkeypatch, seed, names, share):
    import random

    # above a share of one, every round but the first is one over chains
    monkeypatch.setattr(ledger, "ROUND_SHARE", share)
    rng = random.Random(seed)
    name = lambda kind: f"{kind}{rng.randrange(names)}"
    events = [(n, name("p"), name("l"), rng.choice([None, name("b")]), rng.choice(["planned", "pending", "saved"])) for n in range(90)]
    df = spark.createDataFrame(events, "seq int, prospective string, lock_key string, real_book string, state string")
    kept, found = ledger.identity_bindings(df)
    lock, pro, book, back, accepted = {}, {}, {}, {}, set()
    for n, p, k, b, state in events:
        if state == "saved":
            continue
        if lock.get(p, k) != k or pro.get(k, p) != p or (b and (book.get(p, b) != b or back.get(b, p) != p)):
            continue
        lock[p], pro[k] = k, p
        if b:
            book[p], back[b] = b, p
        accepted.add((p, k, b))
    assert {(r.prospective, r.lock_key, r.real_book) for r in kept.collect()} == accepted
    refused = {int(r.entity_id) for r in found.collect()}
    assert refused == {n for n, p, k, b, s in events if s == "saved" or (p, k, b) not in accepted}


def test_hot_keys_with_equal_values_are_split(spark):
    df = spark.range(5000).select(F.lit("k").alias("k"), F.lit(0).alias("score"), F.col("id").cast("string").alias("name"))
    spark.conf.set("spark.auditflow.hotRows", "500")
    try:
        cut, split = ranges.split_hot(df, ["k"], ["score", "name"])
        sizes = [r[0] for r in cut.groupBy("_range").agg(F.count("*")).select("count(1)").collect()]
    finally:
        spark.conf.unset("spark.auditflow.hotRows")
    assert split and sum(sizes) == 5000 and max(sizes) <= 1000


def test_identity_chain_of_any_length(spark):
    chain = [(n, f"p{(n + 1) // 2}", f"l{n // 2}", None, "planned") for n in range(100_000)]
    df = spark.createDataFrame(chain, "seq int, prospective string, lock_key string, real_book string, state string")
    kept, found = ledger.identity_bindings(df)
    assert sorted(r.seq for r in kept.collect()) == list(range(0, 100_000, 2))
    assert sorted(int(r.entity_id) for r in found.collect()) == list(range(1, 100_000, 2))


def test_closure_of_any_depth(spark):
    edges = spark.createDataFrame([(str(n), str(n + 1)) for n in range(66)], "src string, dst string")
    starts = spark.createDataFrame([("r", "0")], "root string, node string")
    assert sorted(r.depth for r in matching.artifact_closure(starts, edges).collect()) == list(range(67))


def test_nested_provenance_is_rejected(spark):
    doc = '{"blocks":[{"uuid":"u","template_data_content":{"ai_semantic_provenance":{"a":{"ai_semantic_provenance":{}}}}}]}'
    df = spark.createDataFrame([("p", "u", doc)], "page_id string, recorded_carrier string, j string").select(
        "page_id", "recorded_carrier", F.try_parse_json("j").alias("doc"))
    assert rows(receipts.carrier_audit(df)) == [("p", 2, "stop")]
    assert sorted(r.path for r in tree.key_paths(df.select("page_id", "doc"), "doc", "ai_semantic_provenance").collect()) == [
        "$.blocks[0].template_data_content.ai_semantic_provenance",
        "$.blocks[0].template_data_content.ai_semantic_provenance.a.ai_semantic_provenance"]


def test_key_order_does_not_change_the_hash(spark):
    import random

    def shuffled(value, rng):
        if isinstance(value, dict):
            keys = list(value)
            rng.shuffle(keys)
            return {k: shuffled(value[k], rng) for k in keys}
        return [shuffled(v, rng) for v in value] if isinstance(value, list) else value

    value = {"z": {"b": [1, {"y": None, "x": True}], "a": "é"}, "k": 3, "é": {}, "list": []}
    texts = [json.dumps(shuffled(value, random.Random(i)), ensure_ascii=False) for i in range(20)]
    df = spark.createDataFrame([(x,) for x in texts], "j string")
    assert df.select(canon.canonical_hash("j")).distinct().count() == 1


def test_refinement_classes_partition_the_keys(spark):
    import random

    rng = random.Random(5)
    side = lambda: {k: rng.choice("abc") for k in range(50) if rng.random() < 0.7}
    b, c, w = side(), side(), side()
    frame = lambda d: spark.createDataFrame(list(d.items()), "k int, value string")
    plan = matching.plan_refinement(frame(b), frame(c), frame(w), ["k"]).collect()
    assert sorted(r.k for r in plan) == sorted({*b, *c, *w})
    for r in plan:
        goal, base, now = w.get(r.k, b.get(r.k)), b.get(r.k), c.get(r.k)
        assert r.classification == ("noop" if goal == base or now == goal else "safe" if now == base else "conflict")


def test_latest_ignores_row_order(spark):
    data = [("k", 5, 2, "x"), ("k", 5, 1, "y"), ("k", 4, 0, "z")]
    for order in (data, data[::-1]):
        df = spark.createDataFrame(order, "key string, ts int, pos int, v string")
        assert windows.latest_per_key(df, ["key"], "ts", "pos").first().v == "y"


def test_approvals(spark):
    schema = "run_id string, mode string, approvals array<struct<text:string,id:string,type:string,status:string,confirmed_by:string,n_evidence:int>>"
    df = spark.createDataFrame([("a", "trial", [("ok", None, None, None, None, None)]), ("b", "batch", []), ("c", "batch", [(None, "x", "trial_authorization", "confirmed", "me", 1)])], schema)
    records, found = extract.normalize_approvals(df)
    assert rows(records.select("run_id", "id", "type").where("run_id = 'a'")) == [("a", "approval-1", "trial_authorization")]
    assert sorted(rows(found.select("entity_id", "rule_code"))) == [("b", "approval_of_mode_missing"), ("c", "approval_of_mode_missing")]


def test_scans_read_files(spark, tmp_path):
    folder = tmp_path / "snaps"
    folder.mkdir()
    name = "7-11-" + "a" * 64 + ".json"
    (folder / name).write_text('{"meta":{"capturedAt":"2024-05-01T00:00:00Z"},"snapshot":{}}')
    (folder / ("7-12-" + "b" * 64 + ".json")).write_text("{broken")
    (folder / "7-13-short.json").write_text("{}")
    got = scans.scan_snapshots(spark, str(folder), "7").orderBy("catalog_id").collect()
    assert [(r.catalog_id, r.parse_error, r.doc is not None) for r in got] == [("11", None, True), ("12", "invalid_json", False)]
    assert str(got[0].captured_at) == "2024-05-01 00:00:00"
    files = {r.path.rsplit("/", 1)[1]: r for r in scans.file_fingerprint(spark, str(folder)).collect()}
    import hashlib
    assert files[name].sha256 == hashlib.sha256((folder / name).read_bytes()).hexdigest()
    assert {r.basename for r in scans.file_inventory(spark, str(folder)).collect()} == {p.name for p in folder.iterdir()}
    assert scans.scan_json(spark, str(folder)).where("parse_error IS NULL").count() == 2
    (tmp_path / "o.json").write_text('{"schema_version":1,"catalogs":{"5":{"sentences":["a","b"],"sentence_evidence":"seen"}}}')
    over = scans.read_overrides(spark, str(tmp_path / "o.json")).first()
    assert (over.catalog_id, over.sentences, over.error) == ("5", ["a", "b"], None)


def test_annotation_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({
        "pdf": {"pages": [{"page": 1, "width": 397, "height": 500}]},
        "annotations": [{"id": "x", "type": "audio", "page": 1, "x": 10, "y": 20, "width": 5, "height": 5, "audio_path": "m/s.mp3"},
                        {"id": "x", "type": "transcript", "page": 2, "x": "q", "y": 1, "width": 1, "height": 1, "question": "", "text": "t"}]}))
    (tmp_path / "b.json").write_text(json.dumps({
        "pdf": {"pages": [{"page": 1, "width": 9000, "height": 500}, {"page": 1, "width": 794, "height": 500}]},
        "annotations": [{"id": "x", "type": "audio", "page": 1, "x": 10, "y": 20, "width": 5, "height": 5, "audio_path": "../m/s.mp3"}]}))
    pages, ann = pipelines.annotation_tables(scans.scan_json(spark, str(tmp_path)))
    media = spark.createDataFrame([("m/s.mp3", "s.mp3", 80 * 1024 * 1024)], "path string, basename string, length bigint")
    own = lambda df, name: df.where(F.col("path").endswith(name))
    both = pipelines.annotation_import_plan(ann, pages, media)
    assert [(r.path[-6:], r.scale) for r in both.pages.orderBy("path").collect()] == [("a.json", 2.0), ("b.json", 1.0)]
    assert sorted(r.rule_code for r in own(both.violations.withColumnRenamed("entity_id", "path"), "b.json#x").collect()) == ["audio_file_too_large"]
    around = spark.createDataFrame([("x/m/s.mp3", "s.mp3", 5), ("y/m/s.mp3", "s.mp3", 6)], media.schema)
    placed_at = own(ann, "b.json").withColumn("path", F.lit("x/json/b.json"))
    found = [annotations.resolve_media(placed_at, around, relative=r).first() for r in (True, False)]
    assert [(r.audio_size, r.media_status) for r in found] == [(5, "ok"), (6, "ambiguous")]
    plan = pipelines.annotation_import_plan(own(ann, "a.json"), own(pages, "a.json"), media)
    page = plan.pages.first()
    assert (page.scale, page.canvas_height, page.annotations[0].left_px) == (2.0, 1000.0, 20.0)
    assert sorted((r.rule_code) for r in plan.violations.collect()) == [
        "audio_file_too_large", "geometry_invalid", "id_duplicate", "page_missing", "question_missing"]


def test_manifest_paths_may_repeat(spark):
    index = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, "b")], "sort int, path string")
    docs = spark.createDataFrame([(1, "a", "x"), (2, "a", "yy"), (3, None, None)], "sort int, path string, doc string")
    found = scans.manifest_union(index, docs, "sort", "path").select("sort", "path", "loaded", "doc")
    assert sorted(rows(found)) == [(1, "a", True, "x"), (2, "a", True, "yy"), (3, None, True, None), (4, "b", False, None)]
    assert scans.manifest_union(index, docs.where("sort = 1").drop("sort")).where("loaded").count() == 2


def test_documents_are_walked_once_and_by_many_tasks(spark):
    text = r'{"a":[{"b \"c":"x:{}"},[],{}],"d":1.5,"e":{"f":null}}'
    docs = spark.createDataFrame([(1, text), (2, "7"), (3, None)], "k int, raw string").coalesce(1).select("k", F.parse_json("raw").alias("doc"))
    nodes = tree.json_nodes(docs, "doc")
    found = nodes.select("k", "path", "key", "depth", F.to_json("value"), "is_leaf")
    assert sorted(rows(found), key=str) == sorted([
        (1, "$.a", "a", 1, r'[{"b \"c":"x:{}"},[],{}]', False), (1, "$.a[0]", None, 2, r'{"b \"c":"x:{}"}', False), (1, '$.a[0].b "c', 'b "c', 3, '"x:{}"', True),
        (1, "$.a[1]", None, 2, "[]", True), (1, "$.a[2]", None, 2, "{}", True), (1, "$.d", "d", 1, "1.5", True),
        (1, "$.e", "e", 1, '{"f":null}', False), (1, "$.e.f", "f", 2, "null", True)], key=str)
    assert nodes.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
