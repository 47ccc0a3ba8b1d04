"""Exact duplicates through a sharded cuckoo filter over text digests.

The index is a table of shards.  A shard holds a cuckoo filter of 16-bit
fingerprints and, slot by slot, the 64-bit keys they stand for, so it can be resized
from its own keys and a deletion removes exactly the key that was meant.  The filter
only proposes: a hit is verified against the content bucketed by the full SHA-256 and
the length of the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditflow.llm.common import ascii_lower, checkpointed, row_key, text_of

SLOTS = 4
KICKS = 200
#: Keys a shard holds on average; the number of shards follows the input.
SHARD_KEYS = 200_000
MIN_SHARDS = 64
INDEX = "shard int, buckets long, live long, keys binary"
_MIX = 0x9E3779B97F4A7C15
_ALL = (1 << 64) - 1


class CuckooFilter:
    """Fingerprints of live keys in two candidate buckets of four slots each."""

    def __init__(self, buckets: int = 64):
        self.buckets = buckets
        self.marks = [0] * (buckets * SLOTS)
        self.keys = [0] * (buckets * SLOTS)
        self.live = 0

    @staticmethod
    def mark(key: int) -> int:
        """The fingerprint: 16 bits, never zero, since zero marks a free slot."""
        return (key & 0xFFFF) or 1

    def places(self, key: int) -> tuple[int, int]:
        mixed = (key ^ key >> 33) * _MIX & _ALL
        first = (mixed ^ mixed >> 29) % self.buckets
        return first, self.other(first, self.mark(key))

    def other(self, bucket: int, mark: int) -> int:
        """The second bucket; an involution for a power of two of buckets."""
        return bucket ^ ((mark * 0x5BD1E995 >> 3) % self.buckets)

    def hit(self, key: int) -> bool:
        """Whether the filter may hold the key: fingerprints only."""
        mark = self.mark(key)
        return any(mark in self.marks[b * SLOTS:b * SLOTS + SLOTS] for b in self.places(key))

    def insert(self, key: int) -> None:
        if self.live >= 0.9 * self.buckets * SLOTS or not self._put(key):
            self._resize([key])

    def delete(self, key: int) -> bool:
        """Free the slot of this very key; another key of equal fingerprint stays."""
        mark = self.mark(key)
        for bucket in self.places(key):
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if self.marks[slot] == mark and self.keys[slot] == key:
                    self.marks[slot] = self.keys[slot] = 0
                    self.live -= 1
                    return True
        return False

    def stored(self) -> list[int]:
        return [k for k, m in zip(self.keys, self.marks, strict=True) if m]

    def _put(self, key: int) -> bool:
        mark = self.mark(key)
        trail = []
        places = self.places(key)
        for bucket in places:
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not self.marks[slot]:
                    self.marks[slot], self.keys[slot] = mark, key
                    self.live += 1
                    return True
        bucket = places[0]
        for kick in range(KICKS):
            slot = bucket * SLOTS + (key + kick) % SLOTS
            trail.append((slot, self.marks[slot], self.keys[slot]))
            mark, self.marks[slot] = self.marks[slot], mark
            key, self.keys[slot] = self.keys[slot], key
            bucket = self.other(bucket, mark)
            for free in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not self.marks[free]:
                    self.marks[free], self.keys[free] = mark, key
                    self.live += 1
                    return True
        for slot, old_mark, old_key in reversed(trail):
            self.marks[slot], self.keys[slot] = old_mark, old_key
        return False

    def _resize(self, extra: list[int]) -> None:
        """Twice the buckets, filled again from the stored keys.

        Equal keys share both buckets at any size, so a key is stored once only.
        """
        keys = list(dict.fromkeys(self.stored() + extra))
        buckets = self.buckets
        while True:
            buckets *= 2
            self.__init__(buckets)
            if all(self._put(key) for key in keys):
                return

    def row(self, shard: int) -> dict:
        return {"shard": shard, "buckets": self.buckets, "live": self.live, "keys": np.array(self.keys, dtype="<u8").tobytes()}

    @classmethod
    def read(cls, row) -> CuckooFilter:
        out = cls(int(row["buckets"]))
        out.keys = np.frombuffer(row["keys"], dtype="<u8").tolist()
        out.marks = [cls.mark(k) if k else 0 for k in out.keys]
        out.live = int(row["live"])
        return out


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Narrow rows ``uid, doc_id, row_key, sha, size, key``; null text counts as empty."""
    lowered = docs.select(F.col(doc_id).alias("doc_id"), row_key(doc_id, text).alias("row_key"), ascii_lower(text_of(text)).alias("t"))
    hashed = lowered.select("doc_id", "row_key", F.unhex(F.sha2("t", 256)).alias("sha"), F.octet_length("t").cast("long").alias("size"))
    # The leading 64 bits are the key of the index; zero is kept free to mark empty slots.
    lead = F.conv(F.hex(F.substring("sha", 1, 8)), 16, -10).cast("long")
    return hashed.select(F.monotonically_increasing_id().alias("uid"), "*", F.when(lead == 0, F.lit(1)).otherwise(lead).alias("key"))


def shard_of(key: str, shards: int):
    return F.pmod(F.xxhash64(F.col(key)), F.lit(shards)).cast("int").alias("shard")


def shard_count(rows: int) -> int:
    return max(MIN_SHARDS, -(-rows // SHARD_KEYS))


def _combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per key and batch, so that a hot text does not reach its shard row by row."""
    for rows in batches:
        yield rows.groupby(["shard", "key"], as_index=False, sort=False).agg(n=("n", "sum"), first=("first", "min"))


def update_index(index: DataFrame | None, keys: DataFrame, shards: int, delete: bool = False) -> DataFrame:
    """Insert into (or delete from) the shards the distinct ``key`` values of a table."""
    spark = keys.sparkSession
    dealt = keys.where(F.col("key").isNotNull()).select("key").distinct().select("key", shard_of("key", shards))
    old = spark.createDataFrame([], INDEX) if index is None else index

    def step(state: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        shard = int((state if len(state) else rows)["shard"].iloc[0])
        live = CuckooFilter.read(state.iloc[0]) if len(state) else CuckooFilter()
        known = set(live.stored())
        for key in rows["key"].to_numpy().astype("<i8").view("<u8").tolist() if len(rows) else []:
            if delete:
                live.delete(key)
            elif key not in known:
                live.insert(key)
        return pd.DataFrame([live.row(shard)])

    return old.groupBy("shard").cogroup(dealt.groupBy("shard")).applyInPandas(step, INDEX)


def probe_index(index: DataFrame, keys: DataFrame, shards: int) -> DataFrame:
    """The distinct ``key`` values that the filters may hold; to be verified by the caller."""
    dealt = keys.where(F.col("key").isNotNull()).select("key").distinct().select("key", shard_of("key", shards))

    def step(state: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(state) or not len(rows):
            return pd.DataFrame({"key": pd.Series([], dtype="int64")})
        live = CuckooFilter.read(state.iloc[0])
        return rows.loc[[live.hit(k) for k in rows["key"].to_numpy().astype("<i8").view("<u8").tolist()], ["key"]]

    return index.groupBy("shard").cogroup(dealt.groupBy("shard")).applyInPandas(step, "key long")


def _suspects(rows: pd.DataFrame) -> pd.DataFrame:
    """Keys of a shard that met their own fingerprint while being inserted one after another."""
    live, met = CuckooFilter(), set()
    rows = rows.sort_values(["first", "key"])
    for key, n in zip(rows["key"].to_numpy().astype("<i8").view("<u8").tolist(), rows["n"].tolist(), strict=True):
        if live.hit(key):
            met.add(key)
            live.delete(key)  # the later copy takes the place of the live one
        elif n > 1:
            met.add(key)
        live.insert(key)
    return pd.DataFrame({"key": np.array(sorted(met), dtype="<u8").view("<i8")})


def duplicate_groups(found: DataFrame) -> DataFrame:
    """``sha, size, keep_uid, keep_id, group_size`` of texts that occur more than once.

    Each shard streams its digests through a cuckoo filter; only keys that were hit are
    verified, by grouping their rows on full digest and length.
    """
    shards = shard_count(found.count())
    dealt = found.select(shard_of("key", shards), "key", F.lit(1).cast("long").alias("n"), F.col("uid").alias("first"))
    dealt = dealt.mapInPandas(_combine, "shard int, key long, n long, first long")
    hit = dealt.groupBy("shard").applyInPandas(_suspects, "key long").distinct()
    newest = F.max(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "uid"))
    groups = found.join(hit, "key", "left_semi").groupBy("sha", "size").agg(newest.alias("keep"), F.count("*").alias("group_size"))
    return groups.where("group_size > 1").select(
        "sha", "size", F.col("keep.uid").alias("keep_uid"), F.col("keep.doc_id").alias("keep_id"), "group_size"
    )


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``uid, doc_id, row_key, sha, size, keep_id, group_size, kept``.

    Of texts that are equal after lower-casing A-Z the row with the largest id stays; a
    null id is smaller than any other, and of repeated rows exactly one stays.  Null
    and empty texts are equal.  Other columns of the input are not read.
    """
    found = checkpointed(digests(docs, doc_id, text))
    groups = checkpointed(duplicate_groups(found))
    return found.join(groups, ["sha", "size"], "left").select(
        "uid", "doc_id", "row_key", "sha", "size",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("uid") == F.col("keep_uid"), F.lit(True)).alias("kept"),
    )
