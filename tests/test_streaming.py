"""Streams against the batch operators."""

from pyspark.sql import functions as F

from auditflow.operators import ledger
from auditflow.streaming import events as S

EVENTS = [
    ("a", "2024-01-01 00:00:01", 1, "planned"), ("b", "2024-01-01 00:00:02", 2, "preflighted"), ("a", "2024-01-01 00:00:03", 3, "preflighted"),
    ("b", "2024-01-01 00:00:04", 4, "planned"), ("a", "2024-01-01 00:00:05", 5, "saved"), ("a", "2024-01-01 00:00:06", 6, "failed"),
    ("a", "2024-01-01 00:00:07", 7, "planned"), ("b", "2024-01-01 00:00:08", 8, "conflict"), ("b", "2024-01-01 00:00:09", 9, "planned"),
]


def frame(spark, part):
    df = spark.createDataFrame(part, "item_id string, at string, seq bigint, to_state string")
    return df.select("item_id", F.col("at").cast("timestamp").alias("at_ts"), "seq", "to_state")


def test_ledger_over_several_batches_equals_batch(spark, tmp_path):
    source = str(tmp_path / "in")
    for i in range(0, len(EVENTS), 3):
        frame(spark, EVENTS[i:i + 3]).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(frame(spark, EVENTS).schema).option("maxFilesPerTrigger", 1).parquet(source)
    query = S.ledger_stream(stream).writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination()
    got = {(r.item_id, r.seq): (r.state, r.accepted) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = ledger.ledger_decisions(frame(spark, EVENTS), ["at_ts", "seq"]).collect()
    assert got == {(r.item_id, r.seq): (r.state_after, r.accepted) for r in want}


def test_stale_lease_fires_once_per_silence(spark, tmp_path):
    source = str(tmp_path / "in")
    beats = [[("x", "2024-01-01 00:00:00"), ("y", "2024-01-01 00:00:00")], [("y", "2024-01-01 00:20:00")], [("z", "2024-01-01 00:45:00")], [("z", "2024-01-01 00:46:00")]]
    for part in beats:
        spark.createDataFrame(part, "lock_key string, at string").select(
            "lock_key", F.col("at").cast("timestamp").alias("heartbeat_at")).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema("lock_key string, heartbeat_at timestamp").option("maxFilesPerTrigger", 1).parquet(source)
    query = S.stale_lease_stream(stream).writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination()
    fired = [r.lock_key for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert fired == ["x"]


def test_envelope_stream_decodes_and_flags(spark, tmp_path):
    import base64

    enc = lambda s: base64.b64encode(s.encode()).decode()
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text(f"{enc('out/1.json')}\t{enc('{}')}\n\nbroken\n\t{enc('{}')}\n__END__\n")
    S.envelope_stream(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = sorted((r.out_path or "", r.error or "") for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [("", "malformed_line"), ("", "malformed_line"), ("out/1.json", "")]
