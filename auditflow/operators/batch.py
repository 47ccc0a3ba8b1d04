"""A batch of ledger items replayed together with the registry of claims they share.

Two keyed machines answer each other.  The item machine steps through the events of an
item and asks the registry: may I claim this key, is this key still mine?  The key
machine steps through everything asked of a key, in the order of the batch, and gives a
verdict on each.  What an event decides depends on earlier events only, and only on
those of items that share a key with its own, directly or through others.  So items and
keys are first parted into families that share nothing; a family is taken in order in one
pass, with its items and records side by side.  A family too large for one task, or one
whose links are too long to be found in a few steps, goes another way: items and keys are
replayed in turn until no verdict changes.  Every round settles at least the earliest
open event for good, and the result is that of taking all events one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditflow.operators.ledger import OWNED, TRANSITIONS
from auditflow.operators.report import EXCEPTION_STATES
from auditflow.session import checkpointed

# Why an item left the usual course.
DRIFT, DUPLICATE = "pre_apply_fingerprint_drift", "logical_work_already_verified"
CHANGED, ELSEWHERE = "verified_identity_target_drift", "logical_work_claimed_elsewhere"

EVENT = ["seq", "item_id", "op", "evidence_ok", "recovery", "reason", "idempotency_key", "identity", "target_before", "token", "holder", "result_hash"]
EVENT_TYPES = {"seq": "long", "evidence_ok": "boolean", "recovery": "boolean"}
ITEM = ["first_state", "first_reason", "first_key", "first_identity", "first_target"]
ASKED = pa.schema([
    ("seq", pa.int64()), ("item_id", pa.string()), ("ask", pa.string()), ("key", pa.string()), ("status", pa.string()), ("target", pa.string()),
    ("result", pa.string()), ("verdict", pa.string()), ("state_before", pa.string()), ("state", pa.string()), ("reason", pa.string()),
    ("attempt", pa.int64()), ("accepted", pa.bool_())])
ASKED_DDL = "seq long, item_id string, ask string, key string, status string, target string, result string, verdict string, state_before string, state string, reason string, attempt long, accepted boolean"
CLAIMED = ("claimed", "owned", "claimed_superseded")
# Operations that read a column; the others read neither it nor what it is made from.
READ_BY = {"idempotency_key": ["preflighted"], "identity": ["preflighted", "authorize"], "target_before": ["preflighted", "authorize"],
           "token": ["authorize", "applied"], "holder": ["authorize", "applied"], "result_hash": ["verified"], "reason": list(EXCEPTION_STATES)}
# Kinds of rows of a family, in the order they are taken, and the columns of events that hold what is known of records and items.
RECORD, FIRST, TAKEN = 0, 1, 2
AS_RECORD = {"known_status": "op", "known_owner": "holder", "known_hash": "result_hash"}
AS_FIRST = dict(zip(ITEM, ["op", "reason", "idempotency_key", "identity", "target_before"], strict=True))
# A family of more events is replayed in rounds; so is one whose links take more steps to find.
TOGETHER, STEPS = 200_000, 4


class Item:
    """One item: its state and what it remembers of fingerprint and authorization."""

    def __init__(self, row: dict):
        self.state, self.reason, self.attempt = row["first_state"] or "pending", row["first_reason"], 0
        self.key, self.identity, self.target = row["first_key"], row["first_identity"], row["first_target"]
        self.token = self.holder = self.token_key = None
        self.mine = False  # the last verdict on the own key, for guesses

    def _wish(self, e: dict) -> tuple[str | None, str | None]:
        """What the event asks of the registry, ``(ask, status)``; ``("", None)`` if nothing; ``(None, None)`` if it is illegal anyway."""
        op = e["op"]
        if op == "authorize":
            if self.state != "preflighted":
                return None, None
            if e["identity"] != self.identity:
                return "drift", "superseded"
            if e["target_before"] != self.target:
                return "drift", "planned"
            return "authorize", "apply_authorized"
        if op not in TRANSITIONS.get(self.state, ()) or op == "verified_skip" or not e["evidence_ok"]:
            return None, None
        if self.state == "outcome_unknown" and not e["recovery"]:
            return None, None
        if op == "preflighted":
            return ("claim", op) if e["idempotency_key"] is not None else (None, None)
        if op == "applied" and self.state != "outcome_unknown":
            given = (e["token"], self.key, e["holder"])
            if self.token is None or given != (self.token, self.token_key, self.holder):
                return None, None
        if self.key is None:
            return "", None
        return ("plan" if op == "planned" else "status"), op

    def step(self, e: dict) -> tuple:
        """Take one event with the verdict known so far and tell what was asked and what came of it."""
        before = self.state
        ask, status = self._wish(e)
        asked = (ask or None, None, None, None, None, None)
        accepted = ask is not None
        if ask:
            key = e["idempotency_key"] if ask == "claim" else self.key
            verdict = e["verdict"] or (e["first_verdict"] if ask == "claim" else "mine" if self.mine else "foreign")
            asked = (ask, key, status, e["target_before"] if ask == "claim" else None, e["result_hash"] if status == "verified" else None, verdict)
            self.mine = verdict == "mine" or verdict in CLAIMED
            accepted = self.mine or ask in ("claim", "plan")
        if accepted:
            self._apply(e, ask, asked[5])
        return (e["seq"], e["item_id"], *asked, before, self.state, self.reason, self.attempt, accepted)

    def _apply(self, e: dict, ask: str, verdict: str | None) -> None:
        op = e["op"]
        if ask == "drift":
            self.state, self.reason, self.token = "planned", DRIFT, None
            self.attempt += 1
        elif ask == "authorize":
            self.token, self.token_key, self.holder, self.reason = e["token"], self.key, e["holder"], None
        elif ask == "claim":
            self.key, self.identity, self.target, self.token = e["idempotency_key"], e["identity"], e["target_before"], None
            self.state, self.reason = {
                "verified_skip": ("verified_skip", None), "verified_target_drift": ("conflict", CHANGED), "conflict": ("conflict", ELSEWHERE),
            }.get(verdict, ("preflighted", None))
        else:
            if op == "applied" or self.state == "outcome_unknown":
                self.token = None
            self.state, self.reason = op, e["reason"] if op in EXCEPTION_STATES else None
            self.attempt += op == "planned"


class Record:
    """The registry's record of one key."""

    def __init__(self, row: dict):
        self.status, self.owner, self.hash = row["known_status"], row["known_owner"], row["known_hash"]

    def step(self, e: dict) -> str:
        item, mine = e["item_id"], self.status is not None and self.owner == e["item_id"]
        if e["ask"] != "claim":
            if mine and (e["ask"] != "authorize" or self.status in OWNED):
                self.status = e["status"]
                if e["status"] == "verified":
                    self.hash = e["result"]
                return "mine"
            return "foreign"
        if self.status is None or (self.status == "superseded" and not mine):
            verdict = "claimed" if self.status is None else "claimed_superseded"
            self.status, self.owner, self.hash = "preflighted", item, None
            return verdict
        if self.status == "verified":
            return "verified_skip" if self.hash is not None and self.hash == e["target"] else "verified_target_drift"
        if mine and self.status in OWNED:
            self.status = "preflighted"
            return "owned"
        return "conflict"


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch; only texts and booleans may be null."""
    names = batch.schema.names
    for row in zip(*[c.to_numpy(zero_copy_only=False).tolist() for c in batch.columns], strict=True):
        yield dict(zip(names, row, strict=True))


def _replay_family(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Families one after the other, each with its records, its items and then its events in order: every question is answered at once."""
    family, items, records = None, {}, {}
    for batch in batches:
        out = []
        for e in _rows(batch):
            if e["family"] != family:
                family, items, records = e["family"], {}, {}
            if e["kind"] == RECORD:
                records[e["idempotency_key"]] = Record({k: e[c] for k, c in AS_RECORD.items()})
                continue
            if e["kind"] == FIRST:
                items[e["item_id"]] = Item({k: e[c] for k, c in AS_FIRST.items()})
                continue
            item = items[e["item_id"]]
            ask, status = item._wish(e)
            if ask:
                key = e["idempotency_key"] if ask == "claim" else item.key
                if key not in records:
                    records[key] = Record(dict.fromkeys(AS_RECORD))
                e["verdict"] = records[key].step({"ask": ask, "item_id": e["item_id"], "status": status, "target": e["target_before"], "result": e["result_hash"]})
            out.append(item.step(e))
        if out:
            yield _batch(out, ASKED)


def _replay_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    name, item = None, None
    for batch in batches:
        out = []
        for e in _rows(batch):
            if item is None or e["item_id"] != name:
                name, item = e["item_id"], Item(e)
            out.append(item.step(e))
        if out:
            yield _batch(out, ASKED)


VERDICTS = pa.schema([("seq", pa.int64()), ("key", pa.string()), ("verdict", pa.string())])


def _replay_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    name, record = None, None
    for batch in batches:
        out = []
        for e in _rows(batch):
            if record is None or e["key"] != name:
                name, record = e["key"], Record(e)
            out.append((e["seq"], name, record.step(e)))
        if out:
            yield _batch(out, VERDICTS)


def _ask(events: DataFrame, verdicts: DataFrame | None) -> DataFrame:
    """Replay items, each with the verdicts known so far."""
    rows = events.join(verdicts.select("seq", "verdict"), "seq", "left") if verdicts is not None else events.withColumn("verdict", F.lit(None).cast("string"))
    dealt = rows.repartition("item_id").sortWithinPartitions("item_id", "seq")
    return checkpointed(dealt.mapInArrow(_replay_items, ASKED_DDL))


def _judge(asked: DataFrame, known: DataFrame) -> DataFrame:
    rows = asked.where("key IS NOT NULL").select("seq", "item_id", "ask", "key", "status", "target", "result").join(known, "key", "left")
    return rows.repartition("key").sortWithinPartitions("key", "seq").mapInArrow(_replay_keys, "seq long, key string, verdict string")


def _families(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(item, family, whole)`` per item and ``(key, family)`` per key of ``links (item, key)``, told by 64-bit hashes: equal hashes only join families.

    The least key of a family goes from keys to items and back.  A family is whole if no
    item of it also has keys of another; after ``STEPS`` steps the rest may not be.
    """
    links = checkpointed(links.distinct().withColumn("family", F.col("key")))

    def lowest(side: str) -> DataFrame:
        return links.join(links.groupBy(side).agg(F.min("family").alias("low")), side)

    for _ in range(STEPS):
        met = checkpointed(lowest("item"))
        if met.where("family <> low").isEmpty():
            break
        links = met.select("item", "key", F.col("low").alias("family"))
        links = checkpointed(lowest("key").select("item", "key", F.col("low").alias("family")))
    per = links.groupBy("item").agg(F.min("family").alias("family"), F.max("family").alias("other"))
    torn = per.where("family <> other").select(F.explode(F.array("family", "other")).alias("family"))
    # an item may have keys of more than two families
    torn = torn.union(links.join(per.where("family <> other").select("item"), "item", "left_semi").select("family")).distinct()
    items = per.select("item", "family").join(torn.withColumn("torn", F.lit(True)), "family", "left").select("item", "family", F.col("torn").isNull().alias("whole"))
    return items, links.select("key", "family").distinct()


def replay_batch(items: DataFrame, events: DataFrame, registry: DataFrame) -> DataFrame:
    """Every event with the state, reason and attempt of its item after it and whether it was accepted.

    ``items (item_id, first_state, first_reason, first_key, first_identity,
    first_target)``; ``events`` has the columns of ``EVENT`` with ``seq`` unique over the
    whole batch, ``op`` a target state or ``authorize``, and the fingerprint that a
    preflight or an authorization shows as ``idempotency_key``, ``identity`` (print of all
    its fields but the target's) and ``target_before``; ``registry (idempotency_key,
    status, owner, verified_hash)`` is what was claimed before.  Items that can ask for
    the same keys, directly or through others, are a family; a family of up to
    ``TOGETHER`` events is taken in order by one task, which streams the events and holds
    its items and records.  All others are replayed in rounds, where events stream through
    sorted partitions, an item and a key each in order, and no group is held in memory.
    Events are read twice, once for the families, and not written down; records and items
    go to their family as rows of their own, so no event carries them.
    """
    text = {c: F.col(c).cast("string") for c in ("op", "reason", "idempotency_key", "identity", "target_before", "token", "holder", "result_hash")}
    known = checkpointed(registry.select(
        F.col("idempotency_key").alias("key"), F.col("status").alias("known_status"), F.col("owner").cast("string").alias("known_owner"),
        F.col("verified_hash").alias("known_hash")))
    # items keep the type of their ids if both sides have it, since then what is dealt out by item stays where it is
    same = events.schema["item_id"].dataType == items.schema["item_id"].dataType
    name = F.col("item_id") if same else F.col("item_id").cast("string").alias("item_id")
    rows = events.select(*EVENT).withColumns(text | {"seq": F.col("seq").cast("long")}).withColumn("item_id", name)
    # an event keeps only what its operation asks for
    rows = rows.withColumns({c: F.when(F.col("op").isin(ops), F.col(c)) for c, ops in READ_BY.items()})
    firsts = items.select(name, *ITEM)
    key = F.when(F.col("idempotency_key").isNotNull(), F.xxhash64("idempotency_key")).alias("key")
    counted = checkpointed(rows.select("item_id", key).groupBy("item_id", "key").agg(F.count("*").alias("n")))
    item = F.xxhash64("item_id").alias("item")
    first_keys = firsts.where("first_key IS NOT NULL").join(counted.select("item_id"), "item_id", "left_semi").select(item, F.xxhash64("first_key").alias("key"))
    found, keys = _families(counted.where("key IS NOT NULL").select(item, "key").union(first_keys))
    sizes = counted.groupBy("item_id").agg(F.sum("n").alias("count")).join(firsts.select("item_id"), "item_id", "left_semi").withColumn("item", item).join(found, "item", "left")
    # an item that asks for nothing is a family of its own
    sizes = sizes.select("item_id", "count", F.coalesce("family", "item").alias("family"), F.coalesce("whole", F.lit(True)).alias("whole"))
    large = sizes.groupBy("family").agg(F.sum("count").alias("n"), F.min("whole").alias("whole")).select("family", (F.col("whole") & (F.col("n") <= TOGETHER)).alias("together"))
    sizes = checkpointed(sizes.join(large, "family").select("item_id", "family", "together"))
    whole = sizes.where("together").select("item_id", "family")

    def of_kind(df: DataFrame, kind: int, columns: dict[str, Column]) -> DataFrame:
        given = {c: columns.get(c, F.lit(None)) for c in EVENT} | {"seq": columns.get("seq", F.lit(0))}
        return df.select("family", F.lit(kind).alias("kind"), *[given[c].cast(EVENT_TYPES.get(c, "string")).alias(c) for c in EVENT])

    own = {c: F.col(k) for k, c in AS_FIRST.items()} | {"item_id": F.col("item_id")}
    records = known.withColumn("hash", F.xxhash64("key")).join(keys.withColumnRenamed("key", "hash"), "hash")
    taken = of_kind(rows.join(whole, "item_id"), TAKEN, {c: F.col(c) for c in EVENT}).union(of_kind(firsts.join(whole, "item_id"), FIRST, own)).union(
        of_kind(records, RECORD, {c: F.col(k) for k, c in AS_RECORD.items()} | {"idempotency_key": F.col("key")}))
    done = taken.repartition("family").sortWithinPartitions("family", "kind", "seq").mapInArrow(_replay_family, ASKED_DDL)
    rest = sizes.where("NOT together").select("item_id")
    if rest.isEmpty():
        return done
    apart = rows.join(rest, "item_id").join(firsts, "item_id").withColumn("item_id", F.col("item_id").cast("string"))
    return done.union(_replay_rounds(apart.join(known.withColumnRenamed("key", "idempotency_key"), "idempotency_key", "left"), known))


def _replay_rounds(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Items and keys in turn: after the first round only items with a changed verdict are replayed, and only the keys they ask for."""
    # before anything was judged, a claim goes by the record that the registry began with
    first_verdict = (F.when(F.col("known_status").isNull(), "claimed").when(F.col("known_status") == "superseded", "claimed_superseded")
                     .when((F.col("known_status") == "verified") & F.col("known_hash").eqNullSafe(F.col("target_before")), "verified_skip")
                     .when(F.col("known_status") == "verified", "verified_target_drift").otherwise("conflict"))
    rows = checkpointed(rows.withColumn("first_verdict", first_verdict).select(*EVENT, *ITEM, "first_verdict"))
    asked = _ask(rows, None)
    verdicts = checkpointed(_judge(asked, known))
    while True:
        wrong = asked.where("key IS NOT NULL").select("seq", "item_id", F.col("verdict").alias("used")).join(verdicts, "seq")
        active = checkpointed(wrong.where(~F.col("used").eqNullSafe(F.col("verdict"))).select("item_id").distinct())
        if active.isEmpty():
            return asked
        again = _ask(rows.join(active, "item_id", "left_semi"), verdicts)
        # keys that an active item asked for before or asks for now
        touched = asked.join(active, "item_id", "left_semi").select("key").union(again.select("key")).where("key IS NOT NULL").distinct()
        touched = checkpointed(touched)
        asked = checkpointed(asked.join(active, "item_id", "left_anti").select(ASKED.names).union(again))
        fresh = _judge(asked.join(touched, "key", "left_semi").select(ASKED.names), known)
        verdicts = checkpointed(verdicts.join(touched, "key", "left_anti").select(VERDICTS.names).union(fresh))


def final_states(items: DataFrame, replayed: DataFrame) -> DataFrame:
    """Every item with its state, reason, attempt and number of rejected events; items without events keep their first state."""
    last = replayed.groupBy("item_id").agg(
        F.max_by(F.struct("state", "reason", "attempt"), "seq").alias("last"), F.count(F.when(~F.col("accepted"), 1)).alias("n_rejected"))
    rows = items.withColumn("item_id", F.col("item_id").cast("string")).join(last, "item_id", "left")
    had = F.col("last").isNotNull()
    return rows.select(
        "item_id", F.when(had, F.col("last.state")).otherwise(F.col("first_state")).alias("state"),
        F.when(had, F.col("last.reason")).otherwise(F.col("first_reason")).alias("reason"),
        F.coalesce("last.attempt", F.lit(0).cast("long")).alias("attempt"), F.coalesce("n_rejected", F.lit(0).cast("long")).alias("n_rejected"))
