"""State machines and leases over event tables."""

from pyspark.sql import functions as F

from auditflow.fixtures import VIEWS, one_file_each
from auditflow.operators import ledger as L
from auditflow.queries import query
from auditflow.session import work_folder
from auditflow.streaming import events as S

HEX = "'sha256:' || repeat('a', 64)"
LEDGER = f"""
SELECT item_id, at_ts, seq, CASE WHEN seq % 6 = 0 THEN 'outcome_unknown' WHEN seq % 31 = 0 THEN 'verified' ELSE to_state END AS to_state,
 CASE WHEN seq % 13 = 0 THEN '{{}}' ELSE '{{"fingerprint":{{}},"target_after_hash":"' || {HEX} || '","save_readback_hash":"' || {HEX} || '","result_hash":"' || {HEX} || '","provenance_hash":"' || {HEX} || '","receipt":"r","reason":"why","readback_recovery":' || CASE WHEN seq % 4 = 0 THEN 'true' ELSE 'false' END || '}}' END AS evidence
FROM fx_ledger_event"""
# State, and the states that may follow it.
ALLOWED = """('pending','planned'),('pending','needs_review'),('pending','failed'),
 ('planned','preflighted'),('planned','needs_review'),('planned','conflict'),('planned','failed'),('planned','outcome_unknown'),
 ('preflighted','applied'),('preflighted','needs_review'),('preflighted','conflict'),('preflighted','failed'),('preflighted','outcome_unknown'),
 ('applied','saved'),('applied','needs_review'),('applied','conflict'),('applied','failed'),('applied','outcome_unknown'),
 ('saved','verified'),('saved','needs_review'),('saved','conflict'),('saved','failed'),('saved','outcome_unknown'),
 ('needs_review','planned'),('conflict','planned'),('failed','planned'),
 ('outcome_unknown','applied'),('outcome_unknown','saved'),('outcome_unknown','verified'),('outcome_unknown','needs_review'),('outcome_unknown','failed')"""
FOLD = f"""
e AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY at_ts, seq) AS n, NOT (evidence = '{{}}' AND to_state NOT IN ('planned', 'pending')) AS ok FROM ({LEDGER})),
a(f, g) AS (VALUES {ALLOWED}),
r(item_id, n, seq, state, attempt, accepted) AS (SELECT DISTINCT item_id, CAST(0 AS BIGINT), CAST(-1 AS BIGINT), 'pending', CAST(0 AS BIGINT), true FROM e
  UNION ALL SELECT e.item_id, e.n, e.seq, CASE WHEN x.ok THEN e.to_state ELSE r.state END, r.attempt + CASE WHEN x.ok AND e.to_state = 'planned' THEN 1 ELSE 0 END, x.ok
  FROM r JOIN e ON e.item_id = r.item_id AND e.n = r.n + 1, LATERAL (SELECT e.ok AND EXISTS (SELECT 1 FROM a WHERE a.f = r.state AND a.g = e.to_state) AND (r.state <> 'outcome_unknown' OR (e.evidence <> '{{}}' AND e.seq % 4 = 0)) AS ok) x)"""
FOLD_SQL = FOLD.replace(", LATERAL (SELECT e.ok AND EXISTS (SELECT 1 FROM a WHERE a.f = r.state AND a.g = e.to_state) AND (r.state <> 'outcome_unknown' OR (e.evidence <> '{}' AND e.seq % 4 = 0)) AS ok) x)",
    " LEFT JOIN a ON a.f = r.state AND a.g = e.to_state)").replace(
    "CASE WHEN x.ok THEN", "CASE WHEN {OK} THEN").replace("x.ok AND e.to_state", "{OK} AND e.to_state").replace(", x.ok\n", ", {OK}\n").replace(
    "{OK}", "(e.ok AND a.f IS NOT NULL AND (r.state <> 'outcome_unknown' OR (e.evidence <> '{}' AND e.seq % 4 = 0)))")


def decisions(t):
    return L.ledger_decisions(t.sql(LEDGER), ["at_ts", "seq"])


@query("J1_ledger_state_machine", f"""
WITH RECURSIVE {FOLD_SQL.strip()}
SELECT item_id, arg_max(state, n) AS state, max(attempt) AS attempt, count(*) FILTER (WHERE NOT accepted) AS n_rejected FROM r GROUP BY 1""")
def _(t):
    return L.ledger_states(decisions(t), ["at_ts", "seq"])


@query("J1_ledger_rejections", f"WITH RECURSIVE {FOLD_SQL.strip()} SELECT item_id, seq, state FROM r WHERE NOT accepted")
def _(t):
    return decisions(t).where("NOT accepted").select("item_id", "seq", F.col("state_after").alias("state"))


CLAIMS = """
SELECT 'key' || CAST(user_id % 40 AS STRING) AS idempotency_key, event_id AS seq, CAST(user_id AS STRING) AS item_id, CASE event_type WHEN 'view' THEN 'claim' WHEN 'click' THEN 'claim' ELSE 'status' END AS action,
  CASE WHEN event_type = 'signup' THEN 'superseded' WHEN event_type = 'purchase' THEN CASE WHEN event_id % 20 = 0 THEN 'verified' ELSE 'planned' END WHEN event_type = 'error' THEN 'applied' END AS status,
  CAST(event_id % 3 AS STRING) AS result_hash, CAST(event_id % 3 AS STRING) AS target_before_hash FROM events"""


@query("J2_claim_registry", f"""
WITH RECURSIVE e AS (SELECT *, row_number() OVER (PARTITION BY idempotency_key ORDER BY seq) AS n FROM ({CLAIMS})),
r(k, n, seq, item_id, action, status, owner, hash, b_status, b_owner, b_hash, tb) AS (
 SELECT DISTINCT idempotency_key, CAST(0 AS BIGINT), CAST(-1 AS BIGINT), '', '', 'none', '', '', '', '', '', '' FROM e
 UNION ALL SELECT r.k, e.n, e.seq, e.item_id, e.action,
  CASE WHEN e.action = 'claim' THEN CASE WHEN r.status = 'none' OR (r.status = 'superseded' AND r.owner <> e.item_id) THEN 'preflighted' ELSE r.status END
       WHEN r.owner = e.item_id AND r.status NOT IN ('none', 'verified', 'superseded') THEN e.status ELSE r.status END,
  CASE WHEN e.action = 'claim' AND (r.status = 'none' OR (r.status = 'superseded' AND r.owner <> e.item_id)) THEN e.item_id ELSE r.owner END,
  CASE WHEN e.action = 'status' AND e.status = 'verified' AND r.owner = e.item_id AND r.status NOT IN ('none', 'verified', 'superseded') THEN e.result_hash ELSE r.hash END,
  r.status, r.owner, r.hash, e.target_before_hash
 FROM r JOIN e ON e.idempotency_key = r.k AND e.n = r.n + 1)
SELECT k AS idempotency_key, item_id, seq, CASE WHEN b_status = 'none' THEN 'claimed' WHEN b_status = 'verified' THEN CASE WHEN b_hash = tb THEN 'verified_skip' ELSE 'verified_target_drift' END
  WHEN b_owner = item_id AND b_status IN ('planned', 'preflighted', 'apply_authorized') THEN 'owned' WHEN b_owner = item_id THEN 'conflict' WHEN b_status = 'superseded' THEN 'claimed_superseded' ELSE 'conflict' END AS disposition,
  CASE WHEN b_status <> 'none' THEN b_owner END AS held_by FROM r WHERE action = 'claim'""")
def _(t):
    return L.claim_outcomes(t.sql(CLAIMS), ["seq"])


FIELDS = ["source_snapshot_hash", "template_snapshot_hash", "rule_pack_hash", "target_before_hash", "resolved_template_id"]
PREFLIGHT = "SELECT o_orderkey AS item_id, 's' || CAST(o_custkey AS STRING) AS source_snapshot_hash, 't' AS template_snapshot_hash, 'r' AS rule_pack_hash, o_orderstatus AS target_before_hash, o_orderpriority AS resolved_template_id FROM orders"
CURRENT = "SELECT o_orderkey AS item_id, 's' || CAST(CASE WHEN o_orderkey % 9 = 0 THEN 0 ELSE o_custkey END AS STRING) AS source_snapshot_hash, 't' AS template_snapshot_hash, 'r' AS rule_pack_hash, CASE WHEN o_orderkey % 4 = 0 THEN 'F' ELSE o_orderstatus END AS target_before_hash, o_orderpriority AS resolved_template_id FROM orders WHERE o_orderkey % 23 <> 0"


@query("J3_drift_gate", f"""
WITH d AS (SELECT p.item_id, array_to_string(list_filter([CASE WHEN p.source_snapshot_hash <> c.source_snapshot_hash THEN 'source_snapshot_hash' END, CASE WHEN p.target_before_hash <> c.target_before_hash THEN 'target_before_hash' END], lambda x: x IS NOT NULL), ',') AS fields
 FROM ({PREFLIGHT}) p JOIN ({CURRENT}) c USING (item_id))
SELECT item_id, fields, CASE WHEN fields <> '' THEN 'planned' ELSE 'apply_authorized' END AS next_state, CASE WHEN contains(fields, 'source') THEN 'superseded' WHEN fields <> '' THEN 'planned' END AS claim_status, NULL AS violation FROM d
UNION ALL SELECT item_id, NULL, NULL, NULL, 'current_fingerprint_missing' FROM ({PREFLIGHT}) WHERE item_id % 23 = 0""")
def _(t):
    return L.drift(t.sql(PREFLIGHT), t.sql(CURRENT)).select(
        "item_id", F.array_join("differences.field", ",").alias("fields"), "next_state", "claim_status", "violation")


NOW = "TIMESTAMP '2024-01-30 23:30:00'"


@query("J4_lease_monitor", f"""
WITH h AS (SELECT user_id AS lock_key, max(ts) FILTER (WHERE event_type <> 'signup') AS hb, max(ts) FILTER (WHERE event_type = 'signup') AS acq FROM events GROUP BY 1)
SELECT lock_key, greatest(0, epoch_us({NOW}) // 1000 - epoch_us(coalesce(hb, acq)) // 1000) AS age_ms, greatest(0, epoch_us({NOW}) // 1000 - epoch_us(coalesce(hb, acq)) // 1000) >= 1800000 AS stale FROM h""")
def _(t):
    beats = t.events.select(
        F.col("user_id").alias("lock_key"), F.when(F.col("event_type") != "signup", F.col("ts").cast("timestamp")).alias("heartbeat_at"),
        F.when(F.col("event_type") == "signup", F.col("ts").cast("timestamp")).alias("acquired_at"))
    return L.stale_leases(beats, F.expr(NOW).cast("timestamp"))


LEASES = """
SELECT user_id % 60 AS lock_key, event_id AS seq, ts AS at_ts, CASE event_type WHEN 'signup' THEN 'acquire' WHEN 'view' THEN 'heartbeat' WHEN 'click' THEN 'transfer' WHEN 'purchase' THEN CASE WHEN event_id % 3 = 0 THEN 'release' ELSE 'heartbeat' END ELSE 'recover' END AS action,
  'o' || CAST(event_id % 3 AS STRING) AS owner, 'o' || CAST(prev % 3 AS STRING) AS from_owner, 'n' || CAST(event_id AS STRING) AS nonce, 'n' || CAST(prev AS STRING) AS observed_nonce,
  CASE WHEN event_id % 10 <> 0 THEN 'because' END AS reason, 'boss' AS authorized_by, event_id % 2 = 0 AS confirm_inactive
FROM (SELECT *, max(CASE WHEN event_type IN ('signup', 'click', 'error') THEN event_id END) OVER (PARTITION BY user_id % 60 ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM events)"""


@query("J5_lease_handover", f"""
WITH RECURSIVE e AS (SELECT *, row_number() OVER (PARTITION BY lock_key ORDER BY seq) AS n FROM ({LEASES})),
r(k, n, owner, nonce, beat, rejected) AS (SELECT DISTINCT lock_key, CAST(0 AS BIGINT), CAST(NULL AS STRING), CAST(NULL AS STRING), CAST(NULL AS TIMESTAMP), CAST(0 AS BIGINT) FROM e
 UNION ALL SELECT k, n, CASE WHEN ok THEN CASE WHEN action = 'release' THEN NULL WHEN action = 'heartbeat' THEN owner ELSE new_owner END ELSE owner END,
  CASE WHEN ok THEN CASE WHEN action = 'release' THEN NULL WHEN action = 'heartbeat' THEN nonce ELSE new_nonce END ELSE nonce END,
  CASE WHEN ok THEN at_ts ELSE beat END, rejected + CASE WHEN ok THEN 0 ELSE 1 END
 FROM (SELECT r.k, e.n, r.owner, r.nonce, r.beat, r.rejected, e.action, e.owner AS new_owner, e.nonce AS new_nonce, e.at_ts, coalesce(CASE e.action
   WHEN 'acquire' THEN r.nonce IS NULL WHEN 'release' THEN r.owner = e.owner WHEN 'heartbeat' THEN r.owner = e.owner AND r.nonce = e.observed_nonce
   WHEN 'transfer' THEN r.nonce = e.observed_nonce AND r.owner = e.from_owner AND e.reason IS NOT NULL
   ELSE r.nonce = e.observed_nonce AND e.reason IS NOT NULL AND e.confirm_inactive AND epoch_us(e.at_ts) // 1000 - epoch_us(r.beat) // 1000 >= 1800000 END, false) AS ok
  FROM r JOIN e ON e.lock_key = r.k AND e.n = r.n + 1))
SELECT k AS lock_key, owner, nonce, rejected AS n_rejected FROM r JOIN (SELECT lock_key, max(n) AS m FROM e GROUP BY 1) x ON x.lock_key = r.k AND x.m = r.n""")
def _(t):
    events = t.sql(LEASES).withColumn("at_ts", F.col("at_ts").cast("timestamp"))
    return L.lease_owners(L.lease_decisions(events, ["seq"]), ["seq"])


IDENTITIES = """
SELECT o_orderkey AS seq, 'p' || CAST(o_custkey AS STRING) AS prospective, 'l' || CAST(CASE WHEN o_orderkey % 8 = 0 THEN o_custkey + 1 ELSE o_custkey END AS STRING) AS lock_key,
  CASE WHEN o_orderkey % 3 = 0 THEN 'b' || CAST(CASE WHEN o_orderkey % 15 = 0 THEN o_custkey + 2 ELSE o_custkey END AS STRING) END AS real_book,
  CASE WHEN o_orderstatus = 'P' AND o_orderkey % 20 = 0 THEN 'applied' WHEN o_orderstatus = 'F' THEN 'planned' ELSE 'pending' END AS state FROM orders"""


def _owner(a: str, b: str, status: int) -> str:
    return f"arg_min(CASE WHEN {a} IS NOT NULL AND status = {status} THEN {b} END, CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL AND status = {status} THEN place END) OVER (PARTITION BY {a})"


_LINKS = [("p", "l"), ("l", "p"), ("p", "b"), ("b", "p")]
_CLASH = " OR ".join(f"({a} IS NOT NULL AND {b} IS NOT NULL AND {_owner(a, b, 1)} <> {b})" for a, b in _LINKS)
_FIRST = " AND ".join(f"({a} IS NULL OR {b} IS NULL OR {_owner(a, b, 0)} = {b})" for a, b in _LINKS)


@query("J6_identity_registry", f"""
WITH RECURSIVE i AS ({IDENTITIES}), legal AS (SELECT prospective AS p, lock_key AS l, real_book AS b, min(seq) AS place FROM i WHERE state IN ('pending', 'planned') GROUP BY 1, 2, 3),
r AS (SELECT 0 AS round, p, l, b, place, 0 AS status FROM legal
  UNION ALL SELECT round + 1, p, l, b, place, CASE WHEN status <> 0 THEN status WHEN clash THEN 2 WHEN is_first THEN 1 ELSE 0 END
    FROM (SELECT *, coalesce({_CLASH}, false) AS clash, coalesce({_FIRST}, false) AS is_first, min(status) OVER () AS least FROM r) WHERE least = 0),
f AS (SELECT * FROM r WHERE round = (SELECT max(round) FROM r))
SELECT place AS seq, 'kept' AS outcome FROM f WHERE status = 1
UNION ALL SELECT seq, 'identity_state' FROM i WHERE state NOT IN ('pending', 'planned')
UNION ALL SELECT seq, 'identity_conflict' FROM i JOIN f ON f.status = 2 AND i.prospective IS NOT DISTINCT FROM f.p AND i.lock_key IS NOT DISTINCT FROM f.l AND i.real_book IS NOT DISTINCT FROM f.b
  WHERE state IN ('pending', 'planned')""")
def _(t):
    kept, found = L.identity_bindings(t.sql(IDENTITIES))
    return kept.select(F.col("seq"), F.lit("kept").alias("outcome")).unionByName(
        found.select(F.col("entity_id").cast("bigint").alias("seq"), F.col("rule_code").alias("outcome")))


# Each event shares one name with the one before and one with the next: a single chain through all of them.
CHAIN = """SELECT event_id AS seq, 'p' || CAST(CAST(floor((event_id + 1) / 2) AS BIGINT) AS STRING) AS prospective, 'l' || CAST(CAST(floor(event_id / 2) AS BIGINT) AS STRING) AS lock_key,
  CAST(NULL AS STRING) AS real_book, 'planned' AS state FROM events"""


@query("J6_identity_chain", """
SELECT event_id AS seq, CASE WHEN (event_id - first) % 2 = 0 THEN 'kept' ELSE 'identity_conflict' END AS outcome
FROM (SELECT event_id, max(CASE WHEN before IS DISTINCT FROM event_id - 1 THEN event_id END) OVER (ORDER BY event_id) AS first FROM (SELECT event_id, lag(event_id) OVER (ORDER BY event_id) AS before FROM events))""")
def _(t):
    kept, found = L.identity_bindings(t.sql(CHAIN))
    return kept.select(F.col("seq"), F.lit("kept").alias("outcome")).unionByName(
        found.select(F.col("entity_id").cast("bigint").alias("seq"), F.col("rule_code").alias("outcome")))


AUTH = "SELECT o_orderkey AS item_id, o_orderkey AS seq, o_custkey % 3 AS attempt, 'tok' || CAST(o_orderkey AS STRING) AS token, 'key' || CAST(o_custkey AS STRING) AS idempotency_key, 'own' || o_orderstatus AS lock_owner, 'n1' AS lock_nonce FROM orders"
APPLY = """SELECT o_orderkey AS item_id, l_orderkey*1000000 + l_suppkey*10 + l_linenumber AS seq, o_custkey % 3 + CASE WHEN l_suppkey % 17 = 0 THEN 1 ELSE 0 END AS attempt,
 CASE WHEN l_suppkey % 13 = 0 THEN 'tokx' ELSE 'tok' || CAST(o_orderkey AS STRING) END AS token, 'key' || CAST(CASE WHEN l_suppkey % 11 = 0 THEN 0 ELSE o_custkey END AS STRING) AS idempotency_key,
 'own' || CASE WHEN l_suppkey % 7 = 0 THEN 'F' ELSE o_orderstatus END AS lock_owner, 'n1' AS lock_nonce FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


@query("J7_apply_token_check", f"""
WITH a AS ({AUTH}), p AS ({APPLY}), u AS (SELECT item_id, token, min(seq) AS first_use FROM p GROUP BY 1, 2),
 j AS (SELECT p.*, a.token AS it, a.idempotency_key AS ik, a.lock_owner AS io, first_use FROM p LEFT JOIN a ON a.item_id = p.item_id AND a.attempt = p.attempt JOIN u ON u.item_id = p.item_id AND u.token = p.token)
SELECT * FROM (SELECT CAST(seq AS STRING) AS entity_id, unnest([CASE WHEN it IS NULL THEN 'token_not_issued' END, CASE WHEN token <> it THEN 'token_mismatch' END, CASE WHEN idempotency_key <> ik THEN 'token_key_mismatch' END,
  CASE WHEN lock_owner <> io THEN 'token_lock_mismatch' END, CASE WHEN seq > first_use THEN 'token_spent' END]) AS rule_code FROM j) WHERE rule_code IS NOT NULL""")
def _(t):
    return L.token_violations(t.sql(AUTH), t.sql(APPLY)).select("entity_id", "rule_code")


@query("J8_resume_plan", """
WITH r AS (SELECT o_orderkey, CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'N' AND l_linenumber = 1) THEN 'read_back' ELSE 'apply' END AS action FROM orders
  WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A' AND l_linenumber < 3))
SELECT o_orderkey, action, o_orderkey = (SELECT min(o_orderkey) FROM r WHERE action = 'apply') AS is_next FROM r""")
def _(t):
    line = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    return L.resume_plan(
        t.orders.select("o_orderkey"), line.where("l_returnflag = 'A' AND l_linenumber < 3"),
        line.where("l_returnflag = 'N' AND l_linenumber = 1"), "o_orderkey")


@query("J1_ledger_stream", f"""
WITH RECURSIVE {FOLD_SQL.strip()}
SELECT item_id, arg_max(state, n) AS state, max(attempt) AS attempt, count(*) FILTER (WHERE NOT accepted) AS n_rejected FROM r GROUP BY 1""")
def _(t):
    """The same fold as a stream that runs over what is there and stops."""
    folder = work_folder(t.spark)
    raw = t.spark.readStream.schema(t.events.schema).option("pathGlobFilter", "events.parquet").parquet(t.folder)
    raw.createOrReplaceTempView("stream_events")
    view = VIEWS["fx_ledger_event"].replace("FROM events", "FROM stream_events")
    events = t.spark.sql(LEDGER.replace("FROM fx_ledger_event", f"FROM ({view})"))
    done = S.ledger_stream(events).writeStream.format("parquet").option("path", f"{folder}/out").option(
        "checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    done.awaitTermination()
    rows = t.spark.read.parquet(f"{folder}/out").join(t.events.select(F.col("event_id").alias("seq"), "ts"), "seq")
    return rows.groupBy("item_id").agg(
        F.max_by("state", F.struct("ts", "seq")).alias("state"), F.max("attempt").alias("attempt"),
        F.count(F.when(~F.col("accepted"), 1)).alias("n_rejected"))


@query("J9_envelope_stream", """
WITH e AS (SELECT source, min(doc_id) AS last FROM documents WHERE doc_id % 97 = 96 GROUP BY source)
SELECT 'out/' || CAST(doc_id AS STRING) || '.json' AS out_path, CASE WHEN doc_id % 13 = 5 THEN NULL ELSE sha256(text) END AS text_hash, CASE WHEN doc_id % 13 = 5 THEN 'invalid_json' END AS error
FROM documents LEFT JOIN e USING (source) WHERE last IS NULL OR doc_id < last""")
def _(t):
    folder = work_folder(t.spark)
    flat = lambda x: f"translate(base64(encode({x}, 'UTF-8')), '\\r\\n', '')"
    doc = """CASE WHEN doc_id % 13 = 5 THEN '{"text":' ELSE to_json(named_struct('text', text)) END"""
    path = "concat('out/', doc_id, '.json')"
    # One file per source; what a file holds after its end marker does not count.
    lines = t.sql(f"SELECT source, doc_id, CASE WHEN doc_id % 97 = 96 THEN '__END__' ELSE concat({flat(path)}, '\\t', {flat(doc)}) END AS value FROM documents")
    one_file_each(lines).write.partitionBy("source").text(f"{folder}/in")
    S.envelope_stream(t.spark, f"{folder}/in", f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    rows = t.spark.read.parquet(f"{folder}/out")
    return rows.select("out_path", F.sha2(F.get_json_object("doc", "$.text"), 256).alias("text_hash"), "error")
