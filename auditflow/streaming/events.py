"""Structured Streaming jobs over ledger events, leases and envelope lines."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from auditflow.operators.ledger import STALE_AFTER_MS, LedgerMachine, with_ledger_columns
from auditflow.sources.scans import ingest_envelope_lines

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


class LedgerProcessor(StatefulProcessor):
    """State and attempts of one item; events of a trigger are taken in order.

    The step is the one of the batch fold, so both agree on the same events.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.machine = LedgerMachine()
        self.state = handle.getValueState("ledger", "state string, attempt bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        state, attempt = self.state.get() if self.state.exists() else (self.machine.start, 0)
        pdf = pd.concat(rows).sort_values(["at_ts", "seq"])
        out = []
        for seq, *event in zip(pdf["seq"].tolist(), *[pdf[c].tolist() for c in self.machine.columns]):
            target = self.machine.step(state, tuple(event))
            if target is not None:
                state = target
                attempt += target == "planned"
            out.append((key[0], seq, state, attempt, target is not None))
        self.state.update((state, attempt))
        yield pd.DataFrame(out, columns=["item_id", "seq", "state", "attempt", "accepted"])

    def close(self) -> None:
        pass


def ledger_stream(events: DataFrame) -> DataFrame:
    """Decisions on a stream of ledger events (item_id, at_ts, seq, to_state, evidence …).

    A verified item accepts nothing more, so late events cannot reopen it.  The
    size of a trigger bounds the rows of one item that are in memory.
    """
    events.sparkSession.conf.set(PROVIDER, ROCKSDB)
    ready = with_ledger_columns(events)
    key = events.schema["item_id"].dataType.simpleString()
    return ready.groupBy("item_id").transformWithStateInPandas(
        statefulProcessor=LedgerProcessor(), outputStructType=f"item_id {key}, seq bigint, state string, attempt bigint, accepted boolean",
        outputMode="Append", timeMode="None")


class LeaseProcessor(StatefulProcessor):
    """Newest heartbeat of a lock and a timer that fires when it goes stale."""

    def __init__(self, ms: int):
        self.ms = ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.beat = handle.getValueState("beat", "at_ms bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        newest = max(int(pdf["at_ms"].max()) for pdf in rows)
        if self.beat.exists():
            old = self.beat.get()[0]
            newest = max(newest, old)
            self.handle.deleteTimer(old + self.ms)
        self.beat.update((newest,))
        self.handle.registerTimer(newest + self.ms)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        beat = self.beat.get()[0]
        yield pd.DataFrame({"lock_key": [key[0]], "beat_ms": [beat], "stale_at_ms": [beat + self.ms]})

    def close(self) -> None:
        pass


def stale_lease_stream(heartbeats: DataFrame, ms: int = STALE_AFTER_MS, delay: str = "0 seconds") -> DataFrame:
    """One row per lease that passes ``ms`` of event time without a heartbeat."""
    heartbeats.sparkSession.conf.set(PROVIDER, ROCKSDB)
    rows = heartbeats.withWatermark("heartbeat_at", delay).select(
        F.col("lock_key").cast("string").alias("lock_key"), "heartbeat_at", F.unix_millis("heartbeat_at").alias("at_ms"))
    return rows.groupBy("lock_key").transformWithStateInPandas(
        statefulProcessor=LeaseProcessor(ms), outputStructType="lock_key string, beat_ms bigint, stale_at_ms bigint",
        outputMode="Append", timeMode="EventTime")


def envelope_stream(spark: SparkSession, path: str, sink: str, checkpoint: str) -> StreamingQuery:
    """Decode envelope lines as files arrive and append them to ``sink``.

    Each batch is written under its own id, so a repeated batch overwrites itself.  A
    file ends at its end marker, by the same rule as a batch of files: its lines are in
    order of the blocks they were read from and of their place in them.
    """
    lines = spark.readStream.option("recursiveFileLookup", "true").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))

    def write(batch: DataFrame, batch_id: int) -> None:
        placed = batch.withColumn("place", F.struct("block", F.monotonically_increasing_id().alias("row")))
        rows = ingest_envelope_lines(placed, "file", "place").withColumn("doc", F.to_json("doc"))
        rows.select("out_path", "doc", "error").write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    return lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
