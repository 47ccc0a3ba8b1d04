"""The batch ledger: items and shared claims replayed together, against taking events one by one."""

import random

import pytest

from auditflow.operators import batch
from auditflow.plans import pipelines

EVENTS = ("seq long, item_id string, op string, evidence_ok boolean, recovery boolean, reason string, idempotency_key string, identity string, "
          "target_before string, token string, holder string, result_hash string")
ITEMS = "item_id string, first_state string, first_reason string, first_key string, first_identity string, first_target string"
REGISTRY = "idempotency_key string, status string, owner string, verified_hash string"
COURSE = ["planned", "preflighted", "authorize", "applied", "saved", "verified"]


def one_by_one(items, events, registry):
    at = {i[0]: batch.Item(dict(zip(("item_id", *batch.ITEM), i, strict=True))) for i in items}
    records = {k: batch.Record({"known_status": s, "known_owner": o, "known_hash": h}) for k, s, o, h in registry}
    out = []
    for event in sorted(events):
        e = dict(zip(batch.EVENT, event, strict=True)) | {"verdict": None, "first_verdict": None}
        item = at[e["item_id"]]
        ask, status = item._wish(e)
        if ask:
            key = e["idempotency_key"] if ask == "claim" else item.key
            record = records.setdefault(key, batch.Record({"known_status": None, "known_owner": None, "known_hash": None}))
            e["verdict"] = record.step({"ask": ask, "item_id": e["item_id"], "status": status, "target": e["target_before"], "result": e["result_hash"]})
        row = item.step(e)
        out.append((row[0], *row[9:]))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rounds_equal_one_by_one(spark, seed):
    rng = random.Random(seed)
    items = [(f"i{n}", "pending", None, f"k{n % 3}" if n % 4 == 0 else None, "x", "h0") for n in range(25)]
    at, events = {}, []
    for seq in range(1500):
        n = rng.randrange(25)
        step = at[n] = (at.get(n, -1) + 1) % 6
        op = COURSE[step] if rng.random() < 0.85 else rng.choice(["failed", "conflict", "needs_review", "outcome_unknown", "planned", "verified_skip", "unheard_of"])
        events.append((seq, f"i{n}", op, rng.random() < 0.95, rng.random() < 0.5, "why", f"k{rng.randrange(6)}" if rng.random() < 0.97 else None,
                       rng.choice("xxxxy"), rng.choice(["h0", "h0", "h0", "h1"]), "t", rng.choice(["o", "o", "o", "p"]), rng.choice(["h0", "h1"])))
    registry = [("k4", "superseded", "elsewhere", None), ("k5", "verified", "elsewhere", "h1")]
    made = batch.replay_batch(spark.createDataFrame(items, ITEMS), spark.createDataFrame(events, EVENTS), spark.createDataFrame(registry, REGISTRY))
    got = sorted((r.seq, r.state, r.reason, r.attempt, r.accepted) for r in made.collect())
    assert got == one_by_one(items, events, registry)
    assert sum(r[4] for r in got) > 150


FINGERPRINT = "source_snapshot_hash string, template_snapshot_hash string, rule_pack_hash string, resolved_template_id string, target_before_hash string"


def run_batch(spark, steps, registry=()):
    """``steps``: (item, op, source, target before, token); items a, b and c may do the same work."""
    rows = [(seq, i, op, True, False, "why", s, "t", "r", "x", h, token, "o|n", "done") for seq, (i, op, s, h, token) in enumerate(steps)]
    events = spark.createDataFrame(rows, f"seq long, item_id string, op string, evidence_ok boolean, recovery boolean, reason string, {FINGERPRINT}, token string, holder string, result_hash string")
    items = spark.createDataFrame([(n, i, None, "t", "r", "x", None, "book", "all", f"p{n // 3}", f"l{n}" if n > 2 else "l") for n, i in enumerate("abcde")],
                                  f"position int, item_id string, {FINGERPRINT}, stable_identity string, catalog_scope string, prospective string, lock_key string")
    known = spark.createDataFrame(list(registry), REGISTRY)
    states, every = pipelines.batch_ledger(items, known, events)
    return {r.item_id: (r.state, r.reason, r.attempt) for r in states.collect()}, every


def test_claims_are_made_at_preflight(spark):
    course = lambda i, s="s": [(i, "planned", None, None, None), (i, "preflighted", s, "h", None), (i, "authorize", s, "h", i), (i, "applied", None, None, i),
                               (i, "saved", None, None, None), (i, "verified", None, None, None)]
    got, _ = run_batch(spark, course("a")[:2] + course("b")[:2])
    assert got["a"] == ("preflighted", None, 1) and got["b"] == ("conflict", batch.ELSEWHERE, 1) and got["c"] == ("pending", None, 0)
    # verified work is skipped if the target is as it was left, else it conflicts
    again = [("b", "planned", None, None, None), ("b", "preflighted", "s", "done", None), ("c", "planned", None, None, None), ("c", "preflighted", "s", "h", None)]
    got, _ = run_batch(spark, course("a") + again)
    assert got == {"a": ("verified", None, 1), "b": ("verified_skip", None, 1), "c": ("conflict", batch.CHANGED, 1), "d": ("pending", "prospective_many_locks", 0), "e": ("pending", "prospective_many_locks", 0)}


def test_drift_frees_the_claim_of_another_source_only(spark):
    start = [("a", "planned", None, None, None), ("a", "preflighted", "s", "h", None)]
    claim = [("b", "planned", None, None, None), ("b", "preflighted", "s", "h", None)]
    got, every = run_batch(spark, [*start, ("a", "authorize", "other", "h", "t"), *claim, ("a", "preflighted", "s", "h", None)])
    assert got["a"] == ("conflict", batch.ELSEWHERE, 2) and got["b"] == ("preflighted", None, 1)
    assert every.where("ask = 'drift'").first().state == "planned"
    got, _ = run_batch(spark, [*start, ("a", "authorize", "s", "changed", "t"), *claim])
    assert got["a"] == ("planned", batch.DRIFT, 2) and got["b"] == ("conflict", batch.ELSEWHERE, 1)


def test_tokens_and_empty_batches(spark):
    start = [("a", "planned", None, None, None), ("a", "preflighted", "s", "h", None), ("a", "authorize", "s", "h", "good")]
    assert run_batch(spark, [*start, ("a", "applied", None, None, "bad")])[0]["a"][0] == "preflighted"
    assert run_batch(spark, [*start, ("a", "applied", None, None, "good")])[0]["a"][0] == "applied"
    got, every = run_batch(spark, [], [("k", "verified", "elsewhere", "h")])
    assert set(got.values()) == {("pending", None, 0), ("pending", "prospective_many_locks", 0)} and every.count() == 0


def crowd(seed, n_items, n_keys, n_events):
    rng = random.Random(seed)
    items = [(f"i{n}", "pending", None, f"k{n % n_keys}" if n % 4 == 0 else None, "x", "h0") for n in range(n_items)]
    at, events = {}, []
    for seq in range(n_events):
        n = rng.randrange(n_items)
        step = at[n] = (at.get(n, -1) + 1) % 6
        op = COURSE[step] if rng.random() < 0.9 else rng.choice(["failed", "conflict", "outcome_unknown", "planned"])
        key = f"k{(n + rng.randrange(2)) % n_keys}" if rng.random() < 0.97 else None
        events.append((seq, f"i{n}", op, rng.random() < 0.95, True, "why", key, "x", rng.choice(["h0", "h0", "h1"]), "t", "o", rng.choice(["h0", "h1"])))
    return items, events, [("k1", "superseded", "elsewhere", None), ("k2", "verified", "elsewhere", "h1"), ("k0", "planned", "i0", None)]


def replayed(spark, items, events, registry):
    made = batch.replay_batch(spark.createDataFrame(items, ITEMS), spark.createDataFrame(events, EVENTS), spark.createDataFrame(registry, REGISTRY))
    return sorted((r.seq, r.state, r.reason, r.attempt, r.accepted) for r in made.collect())


def test_a_family_needs_no_rounds(spark, monkeypatch):
    def no_round(*_):
        raise AssertionError("replayed in rounds")

    monkeypatch.setattr(batch, "_ask", no_round)
    given = crowd(4, 40, 5, 800)
    assert replayed(spark, *given) == one_by_one(*given)


@pytest.mark.parametrize("together, steps", [(0, 4), (60, 4), (200_000, 1)])
def test_large_and_long_families_go_in_rounds(spark, monkeypatch, together, steps):
    monkeypatch.setattr(batch, "TOGETHER", together)
    monkeypatch.setattr(batch, "STEPS", steps)
    # some items on a few shared keys, others in a chain of keys that a step cannot follow
    items, events, registry = crowd(5, 30, 30, 300)
    apart = [(f"z{n}", "pending", None, None, "x", "h0") for n in range(3)]
    more = [(1000 + n, f"z{n % 3}", COURSE[n // 3], True, True, "why", f"z{n % 3 // 2}", "x", "h0", "t", "o", "h0") for n in range(18)]
    given = (items + apart, events + more, registry)
    assert replayed(spark, *given) == one_by_one(*given)


def test_events_are_not_written_down(spark, monkeypatch):
    kept = []

    def noted(df, keep=batch.checkpointed):
        df = keep(df)
        kept.append(df.count())
        return df

    monkeypatch.setattr(batch, "checkpointed", noted)
    given = crowd(6, 40, 5, 2000)
    assert replayed(spark, *given) == one_by_one(*given)
    assert kept and max(kept) < 500
