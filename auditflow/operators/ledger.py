"""Batch ledger: states, claims, drift, leases, identities, tokens, resume."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from auditflow.functions.canon import FINGERPRINT_FIELDS, fingerprint_diff
from auditflow.operators import ranges
from auditflow.operators.checks import explode_rules
from auditflow.operators.fold import Machine, fold_events
from auditflow.operators.report import ALL_STATES, EXCEPTION_STATES
from auditflow.session import checkpointed

# The states that may follow each state.
TRANSITIONS = {
    "pending": ["planned", "needs_review", "failed"],
    "planned": ["preflighted", "needs_review", "conflict", "failed", "outcome_unknown"],
    "preflighted": ["applied", "needs_review", "conflict", "failed", "outcome_unknown"],
    "applied": ["saved", "needs_review", "conflict", "failed", "outcome_unknown"],
    "saved": ["verified", "needs_review", "conflict", "failed", "outcome_unknown"],
    "verified": [],
    "verified_skip": [],
    "needs_review": ["planned"],
    "conflict": ["planned"],
    "failed": ["planned"],
    "outcome_unknown": ["applied", "saved", "verified", "needs_review", "failed"],
}
# Fixed value: a lease without a heartbeat for 30 minutes is stale.
STALE_AFTER_MS = 30 * 60 * 1000
SHA = r"^sha256:[a-f0-9]{64}$"


def transition_table(spark: SparkSession) -> DataFrame:
    rows = [(a, b) for a, targets in TRANSITIONS.items() for b in targets]
    return spark.createDataFrame(rows, "from_state string, to_state string")


@lru_cache(maxsize=None)
def ledger_moves(kind: str, to: str, ok: bool, recovery: bool) -> dict[str, str]:
    """States that one ledger event may leave, with the state it leads to."""
    if kind == "drift":
        return {"preflighted": "planned"}
    if kind == "skip":
        return {"planned": "verified_skip"}
    if not ok or to not in ALL_STATES or to == "verified_skip":
        return {}
    sources = [s for s, targets in TRANSITIONS.items() if to in targets]
    return {s: to for s in sources if s != "outcome_unknown" or recovery}


class LedgerMachine(Machine):
    start = "pending"
    columns = ["kind", "to_state", "evidence_ok", "recovery"]

    def moves(self, event):
        return ledger_moves(event[0], event[1], bool(event[2]), bool(event[3])), None


def evidence_ok(to: Column, evidence: Column) -> Column:
    """Does the evidence text (JSON) carry what its target state needs."""
    get = lambda k: F.get_json_object(evidence, f"$.{k}")
    hashed = lambda k: F.coalesce(get(k).rlike(SHA), F.lit(False))
    filled = lambda k: F.trim(F.coalesce(get(k), F.lit(""))) != ""
    return (
        F.when(to == "preflighted", F.coalesce(get("fingerprint").startswith("{"), F.lit(False)))
        .when(to == "applied", hashed("target_after_hash"))
        .when(to == "saved", hashed("save_readback_hash"))
        .when(to == "verified", hashed("result_hash") & hashed("provenance_hash") & filled("receipt"))
        .when(to.isin(EXCEPTION_STATES), filled("reason"))
        .otherwise(True))


def with_ledger_columns(events: DataFrame) -> DataFrame:
    """Fill the columns of the ledger machine from ``evidence`` or with open defaults."""
    made = {}
    if "kind" not in events.columns:
        made["kind"] = F.lit("transition")
    if "evidence_ok" not in events.columns:
        made["evidence_ok"] = evidence_ok(F.col("to_state"), F.col("evidence")) if "evidence" in events.columns else F.lit(True)
    if "recovery" not in events.columns:
        made["recovery"] = (F.coalesce(F.get_json_object("evidence", "$.readback_recovery") == "true", F.lit(False))
                            if "evidence" in events.columns else F.lit(False))
    return events.withColumns(made)


def ledger_decisions(events: DataFrame, order: list[str]) -> DataFrame:
    """Each event with the states around it and whether it was accepted."""
    return fold_events(with_ledger_columns(events), "item_id", order, LedgerMachine())


def ledger_states(decisions: DataFrame, order: list[str]) -> DataFrame:
    """Current state, attempts and rejected events per item."""
    planned = F.col("accepted") & (F.col("state_after") == "planned")
    return decisions.groupBy("item_id").agg(
        F.max_by("state_after", F.struct(*order)).alias("state"), F.count(F.when(planned, 1)).alias("attempt"),
        F.count(F.when(~F.col("accepted"), 1)).alias("n_rejected"))


# States of an owned and of an open claim.
OWNED = ["planned", "preflighted", "apply_authorized"]
OPEN_STATUSES = OWNED + ["applied", "saved", "needs_review", "conflict", "failed", "outcome_unknown"]


class ClaimMachine(Machine):
    """Registry record of one idempotency key: ``status:hash|item``."""

    start = "none:|"
    columns = ["action", "item_id", "status", "result_hash"]

    def moves(self, event):
        action, item, status, result = event
        if action == "claim":
            return {self.start: f"preflighted:|{item}"}, ("superseded:", f"preflighted:|{item}", (f"superseded:|{item}",))
        tag = f"{status}:{result or ''}" if status == "verified" else f"{status}:"
        return {f"{s}:|{item}": f"{tag}|{item}" for s in OPEN_STATUSES}, None


def claim_outcomes(claims: DataFrame, order: list[str], key: str = "idempotency_key") -> DataFrame:
    """Disposition of each claim: first claim wins, verified work is skipped or drifted."""
    rows = fold_events(claims.withColumn("item_id", F.col("item_id").cast("string")), key, order, ClaimMachine())
    rows = rows.where("action = 'claim'")
    status = F.substring_index(F.substring_index("state_before", "|", 1), ":", 1)
    verified_hash = F.expr("substring(substring_index(state_before, '|', 1), 10)")
    owner = F.expr("substring(state_before, locate('|', state_before) + 1)")
    same = owner == F.col("item_id")
    disposition = (
        F.when(status == "none", "claimed")
        .when(status == "verified", F.when(
            (verified_hash != "") & (verified_hash == F.col("target_before_hash")), "verified_skip").otherwise("verified_target_drift"))
        .when(same & status.isin(OWNED), "owned")
        .when(same, "conflict")
        .when(status == "superseded", "claimed_superseded")
        .otherwise("conflict"))
    return rows.select(key, "item_id", *order, disposition.alias("disposition"), F.when(status != "none", owner).alias("held_by"))


def drift(preflight: DataFrame, current: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Changed fingerprint fields before apply, the next state and what becomes of the claim.

    An item without a current fingerprint keeps its state and carries a ``violation``.
    """
    fields = fields or FINGERPRINT_FIELDS
    a = preflight.select("item_id", F.struct(*fields).alias("expected"))
    b = current.select("item_id", F.struct(*fields).alias("current"))
    lost = F.col("current").isNull()
    rows = a.join(b, "item_id", "left").withColumn("differences", F.when(~lost, fingerprint_diff("expected", "current", fields)))
    changed = F.size("differences") > 0
    identity = F.exists("differences", lambda d: d["field"] != "target_before_hash")
    return rows.select(
        "item_id", "differences", F.when(lost, None).when(changed, "planned").otherwise("apply_authorized").alias("next_state"),
        F.when(lost, None).when(identity, "superseded").when(changed, "planned").alias("claim_status"),
        F.when(lost, "current_fingerprint_missing").alias("violation"))


def stale_leases(heartbeats: DataFrame, now: Column, ms: int = STALE_AFTER_MS) -> DataFrame:
    """Age of each lease from its newest heartbeat, else from its acquisition."""
    latest = heartbeats.groupBy("lock_key").agg(
        F.max("heartbeat_at").alias("heartbeat_at"), F.max("acquired_at").alias("acquired_at"))
    seen = F.coalesce("heartbeat_at", "acquired_at")
    age = F.greatest(F.lit(0).cast("bigint"), F.unix_millis(now) - F.unix_millis(seen))
    return latest.select("lock_key", age.alias("age_ms"), F.coalesce(age >= ms, F.lit(False)).alias("stale"))


class LeaseMachine(Machine):
    """Holder of one lock: ``owner|nonce``."""

    start = "|"
    columns = ["action", "owner", "nonce", "seen_owner", "observed_nonce", "legal"]

    def moves(self, event):
        action, owner, nonce, seen_owner, observed, legal = event
        if not legal:
            return {}, None
        if action == "acquire":
            return {self.start: f"{owner}|{nonce}"}, None
        if action == "release":
            return {}, (owner, self.start, ())
        if action == "heartbeat":
            return {f"{owner}|{observed}": f"{owner}|{observed}"}, None
        return {f"{seen_owner}|{observed}": f"{owner}|{nonce}"}, None


def lease_decisions(events: DataFrame, order: list[str], ms: int = STALE_AFTER_MS) -> DataFrame:
    """Lease events with the holder around them.

    Columns: lock_key, at_ts, action, owner (of a transfer or recovery: the new one),
    from_owner, nonce (new), observed_nonce, reason, authorized_by, confirm_inactive.
    Who held a nonce and when it was last seen depends on events of that nonce only.
    """
    minted = F.col("action").isin("acquire", "transfer", "recover")
    seen_nonce = F.when(F.col("action") == "heartbeat", F.col("observed_nonce")).when(minted, F.col("nonce"))
    touches = events.where(minted | (F.col("action") == "heartbeat")).select(
        "lock_key", *order, seen_nonce.alias("n"), F.lit(0).alias("is_ask"),
        F.when(minted, F.col("owner")).alias("o"), F.col("at_ts").alias("t"))
    asks = events.where(F.col("action").isin("transfer", "recover")).select(
        "lock_key", *order, F.col("observed_nonce").alias("n"), F.lit(1).alias("is_ask"),
        F.lit(None).cast(events.schema["owner"].dataType).alias("o"), F.lit(None).cast("timestamp").alias("t"))
    known = ranges.running(touches.unionByName(asks), ["lock_key", "n"], [*order, "is_ask"], {
        "seen_owner": ("last", F.col("o")), "seen_at": ("last", F.col("t"))}, inclusive=False)
    known = known.where("is_ask = 1").select("lock_key", *order, "seen_owner", "seen_at")
    rows = events.join(known, ["lock_key", *order], "left")
    filled = (F.trim(F.coalesce("reason", F.lit(""))) != "") & (F.trim(F.coalesce("authorized_by", F.lit(""))) != "")
    stale = F.unix_millis("at_ts") - F.unix_millis("seen_at") >= ms
    legal = (
        F.when(F.col("action") == "transfer", filled & (F.col("from_owner") == F.col("seen_owner")))
        .when(F.col("action") == "recover", filled & stale & F.coalesce("confirm_inactive", F.lit(False)))
        .otherwise(True))
    rows = rows.withColumn("legal", F.coalesce(legal, F.lit(False)))
    return fold_events(rows, "lock_key", order, LeaseMachine())


def lease_owners(decisions: DataFrame, order: list[str]) -> DataFrame:
    last = decisions.groupBy("lock_key").agg(
        F.max_by("state_after", F.struct(*order)).alias("s"), F.count(F.when(~F.col("accepted"), 1)).alias("n_rejected"))
    return last.select(
        "lock_key", F.nullif(F.substring_index("s", "|", 1), F.lit("")).alias("owner"),
        F.nullif(F.substring_index("s", "|", -1), F.lit("")).alias("nonce"), "n_rejected")


#: Names that an identity event binds to each other, in both directions.
BINDINGS = [("prospective", "lock_key"), ("lock_key", "prospective"), ("prospective", "real_book"), ("real_book", "prospective")]
#: A round that settles less than this share of what is left is followed by one over chains.
ROUND_SHARE = 0.25
#: Rows of one range in which pointers are followed by one task.
RANGE_ROWS = 1_000_000


def _earlier_clashes(left: DataFrame, a: str, b: str) -> DataFrame:
    """``(at, before)``: of the earlier rows with the same ``a`` and another ``b``, the first two.

    Per name the three earliest partners say it, with their first two places each, so a
    name may have any number of rows.
    """
    pairs = left.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).alias("a"), F.col(b).alias("b"), "at")
    at = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy("at"))
    two = pairs.withColumn("n", at("a", "b")).where("n <= 2").groupBy("a", "b").agg(F.min("at").alias("at"), F.max("at").alias("next"))
    three = two.withColumn("n", at("a")).where("n <= 3")
    heads = three.groupBy("a").agg(F.sort_array(F.collect_list(F.struct("at", "next", "b"))).alias("heads")).where(F.size("heads") > 1)
    rows = pairs.join(heads, "a")
    others = F.filter("heads", lambda h: h["b"] != F.col("b"))
    places = F.flatten(F.transform(others, lambda h: F.array(h["at"], h["next"])))
    return rows.select("at", F.slice(F.array_sort(F.array_distinct(F.filter(places, lambda p: p < F.col("at")))), 1, 2).alias("before"))


def _settle_chains(left: DataFrame) -> DataFrame:
    """``(at, keep)`` of all rows that follow from one first row through chains of single clashes.

    A row with no earlier clash is kept; a row with exactly one is kept iff that one is
    not.  Pointers to the earlier row are doubled until they reach the head of the chain,
    so a chain of n rows takes log n steps; heads with several clashes stay open.
    """
    clashes = reduce(DataFrame.union, [_earlier_clashes(left, a, b) for a, b in BINDINGS])
    clashes = clashes.select("at", F.explode("before").alias("before")).groupBy("at").agg(F.min("before").alias("low"), F.max("before").alias("high"))
    rows = left.select("at").join(clashes, "at", "left")
    steps = checkpointed(rows.select(
        "at", F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(F.col("at")).alias("to"), (F.col("low") == F.col("high")).alias("odd"),
        F.col("low").isNull().alias("free")).withColumn("odd", F.coalesce("odd", F.lit(False))))
    # Within a range of places pointers are followed at once; between ranges only rows that others point to go on.
    short = checkpointed(_short_cuts(steps))
    gates = short.where("to <> at").select(F.col("to").alias("at")).distinct()
    doubled = _doubled(short.join(gates, "at", "left_semi"))
    there = doubled.select(F.col("at").alias("to"), F.col("to").alias("to2"), F.col("odd").alias("odd2"), F.col("free").alias("free2"))
    ends = short.join(there, "to", "left").select(
        "at", (F.col("odd") != F.coalesce("odd2", F.lit(False))).alias("odd"), F.coalesce("free2", "free").alias("free"))
    return ends.where("free").select("at", (~F.col("odd")).alias("keep"))


def _doubled(steps: DataFrame) -> DataFrame:
    """Pointers ``at, to, odd, free`` of rows that point to each other, followed to the heads of their chains."""
    while True:
        there = steps.select(F.col("at").alias("to"), F.col("to").alias("to2"), F.col("odd").alias("odd2"), F.col("free").alias("free2"))
        jumped = steps.join(there, "to").select(
            "at", F.col("to2").alias("to"), (F.col("odd") != F.col("odd2")).alias("odd"), F.col("free2").alias("free"), (F.col("to") != F.col("to2")).alias("moved"))
        jumped = checkpointed(jumped)
        steps = jumped.drop("moved")
        if jumped.where("moved").isEmpty():
            return steps


def _short_cuts(steps: DataFrame) -> DataFrame:
    """The same pointers, each followed as far as rows of its own range of ``at`` lead.

    A task holds a few numbers for each row of its range.  Places other than whole numbers
    are left as they are.
    """
    if not isinstance(steps.schema["at"].dataType, IntegralType):
        return steps

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)
        if not parts:
            return
        table = pa.Table.from_batches(parts)
        at, to, odd, free = (table.column(c).to_numpy() for c in ("at", "to", "odd", "free"))
        order = np.argsort(at, kind="stable")
        at, to, odd, free = at[order], to[order], odd[order], free[order]
        place = np.minimum(np.searchsorted(at, to), len(at) - 1)
        # a row that points out of the range stands still
        hop = np.where(at[place] == to, place, np.arange(len(at)))
        turn = odd & (hop != np.arange(len(at)))
        while True:
            further = hop[hop]
            if np.array_equal(further, hop):
                break
            turn, hop = turn ^ turn[hop], further
        out = pa.table({"at": at, "to": to[hop], "odd": turn ^ odd[hop], "free": free[hop]})
        yield from out.to_batches(max_chunksize=100_000)

    n = max(1, -(-steps.count() // RANGE_ROWS))
    return steps.repartitionByRange(n, "at").mapInArrow(run, steps.schema)


def identity_bindings(events: DataFrame, order: str = "seq") -> tuple[DataFrame, DataFrame]:
    """Bindings prospective ↔ lock ↔ real book, one to one, first come first kept.

    Each round keeps every pair that is first in all its directions and drops pairs
    that clash with a kept one; what is left goes into the next round.  Where rounds
    settle little, rows wait for each other in chains, and a round settles whole chains
    by doubling pointers.  No group of names is gathered in one task.  The result equals
    taking the events one by one.
    """
    legal = F.coalesce(F.col("state").isin("pending", "planned"), F.lit(False))
    late = events.where(~legal)
    columns = ["prospective", "lock_key", "real_book"]
    left = checkpointed(events.where(legal).groupBy(*columns).agg(F.min(order).alias("at")))
    def owners(rows: DataFrame, i: int) -> DataFrame:
        a, b = BINDINGS[i]
        return rows.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(F.col(a).alias(f"_a{i}")).agg(F.min_by(b, "at").alias(f"_b{i}"))

    kept, chains = None, False
    n_left = left.count()
    while n_left:
        if chains:
            settled = _settle_chains(left)
            fresh = left.join(settled.where("keep"), "at", "left_semi")
            left = left.join(settled.where("NOT keep"), "at", "left_anti")
        else:
            fresh, first = left, F.lit(True)
            for i, (a, b) in enumerate(BINDINGS):
                fresh = fresh.join(owners(left, i), F.col(a) == F.col(f"_a{i}"), "left")
                first = first & (F.col(b).isNull() | F.col(a).isNull() | (F.col(b) == F.col(f"_b{i}")))
            fresh = fresh.where(first)
        fresh = checkpointed(fresh.select(*columns, "at"))
        rest = left.join(fresh.select("at"), "at", "left_anti")
        for i, (a, b) in enumerate(BINDINGS):
            clash = F.col(f"_b{i}").isNull() | F.col(b).isNull() | (F.col(f"_b{i}") == F.col(b))
            rest = rest.join(owners(fresh, i), F.col(a) == F.col(f"_a{i}"), "left").where(clash)
        kept = fresh if kept is None else kept.unionByName(fresh)
        left = checkpointed(rest.select(*columns, "at"))
        before, n_left = n_left, left.count()
        chains = n_left > (1 - ROUND_SHARE) * before
    if kept is None:
        kept = left
    accepted = kept.select(*[F.col(c).alias(f"_{c}") for c in columns])
    on = F.lit(True)
    for c in columns:
        on = on & F.col(c).eqNullSafe(F.col(f"_{c}"))
    refused = events.where(legal).join(accepted, on, "left_anti")
    found = explode_rules(refused.withColumn("entity_id", F.col(order)), [("identity_conflict", "error", F.lit(True))]).unionByName(
        explode_rules(late.withColumn("entity_id", F.col(order)), [("identity_state", "error", F.lit(True))]))
    return kept.withColumnRenamed("at", order), found


def token_violations(authorized: DataFrame, applied: DataFrame) -> DataFrame:
    """Apply events whose token was not issued for the same work, lock and nonce, or was spent."""
    issued = authorized.select(
        "item_id", "attempt", F.col("token").alias("i_token"), F.col("idempotency_key").alias("i_key"),
        F.col("lock_owner").alias("i_owner"), F.col("lock_nonce").alias("i_nonce"))
    latest = ranges.pick_last(authorized.select("item_id", "attempt", "seq"), ["item_id", "attempt"], [F.col("seq")])
    issued = issued.join(authorized.join(latest, ["item_id", "attempt", "seq"]).select(
        "item_id", "attempt", F.col("token").alias("i_token")), ["item_id", "attempt", "i_token"], "left_semi")
    used = applied.groupBy("item_id", "token").agg(F.min("seq").alias("first_use"))
    rows = applied.join(issued, ["item_id", "attempt"], "left").join(used, ["item_id", "token"], "left")
    have = F.col("i_token").isNotNull()
    return explode_rules(rows.withColumn("entity_id", F.col("seq")), [
        ("token_not_issued", "error", ~have),
        ("token_mismatch", "error", have & ~F.col("token").eqNullSafe(F.col("i_token"))),
        ("token_key_mismatch", "error", have & ~F.col("idempotency_key").eqNullSafe(F.col("i_key"))),
        ("token_lock_mismatch", "error", have & ~(F.col("lock_owner").eqNullSafe(F.col("i_owner")) & F.col("lock_nonce").eqNullSafe(F.col("i_nonce")))),
        ("token_spent", "error", F.col("seq") > F.col("first_use"))])


def resume_plan(planned: DataFrame, done: DataFrame, unknown: DataFrame, key: str) -> DataFrame:
    """Remaining work; unknown outcomes wait for a readback; the first open one is next."""
    rest = planned.join(done.select(key).distinct(), key, "left_anti").join(
        unknown.select(key).distinct().withColumn("_u", F.lit(True)), key, "left")
    rest = rest.withColumn("action", F.when(F.col("_u"), "read_back").otherwise("apply")).drop("_u")
    nxt = rest.where("action = 'apply'").agg(F.min(key).alias("_next"))
    # One row.
    return rest.crossJoin(F.broadcast(nxt)).withColumn("is_next", F.col(key) == F.col("_next")).drop("_next")
