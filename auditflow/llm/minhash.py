"""Near duplicates by five-word Jaccard similarity: anchor points of SimHash fingerprints and MinHash bands for candidates, exact confirmation of each."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from auditflow.llm.common import checkpointed, keyed, row_key, split_by_keys
from auditflow.llm.kneser_ney import _mix, _Words
from auditflow.llm.components import connected_components
from auditflow.llm.simhash import anchor_links, majority

SHINGLE = 5
#: Least Jaccard similarity of a link, as a fraction.
SIMILAR = (4, 5)
#: A pair at 0.8 agrees in none of the bands with a chance of 2 in 10,000, a closer one with less.
BANDS, ROWS = 28, 6
#: Differing bits of two fingerprints that the anchors link; pairs farther apart are left to the bands.
WIDE = 8
#: Texts on one side of a cell.
STAR_BLOCK, BLOCK = 256, 64

_RNG = np.random.default_rng(42)
_FACTORS = _RNG.integers(0, 1 << 31, (BANDS * ROWS, 1), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_TERMS = _RNG.integers(0, 1 << 32, (BANDS * ROWS, 1), dtype=np.uint32)


def shingles(text: str | None, words: _Words) -> np.ndarray:
    """Sorted distinct 64-bit keys of the runs of five words, lower-cased; a shorter text is one run, one without words has none."""
    found = (text or "").encode().lower().split()
    first = np.fromiter(map(words.__getitem__, found), dtype=np.uint64, count=len(found))
    keys = first
    for n in range(1, min(SHINGLE, len(found))):
        keys = _mix(keys[:-1], first[n:] + np.uint64(n))
    return np.unique(keys)


def band_keys(found: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of the MinHash signature."""
    low = np.full(BANDS * ROWS, np.iinfo(np.uint32).max, dtype=np.uint32)
    short = (found >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), 2048):
        mixed = short[None, at:at + 2048] * _FACTORS
        mixed += _TERMS
        low = np.minimum(low, mixed.min(axis=1))
    rows = low.reshape(BANDS, ROWS).astype(np.uint64)
    keys = np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        keys = _mix(keys, rows[:, k])
    return keys


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = _Words()
    for batch in batches:
        nodes, bands, prints = batch.column(2).to_numpy().copy(), [], np.zeros(batch.num_rows, dtype=np.uint64)
        for i, text in enumerate(batch.column(3).to_pylist()):
            found = shingles(text, words)
            if not len(found):
                nodes[i] = 0  # texts without words are all alike
            prints[i] = majority(found)
            bands.append(band_keys(found).view(np.int64) if len(found) else np.empty(0, dtype=np.int64))
        offsets = np.cumsum([0, *map(len, bands)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(bands) if bands else np.empty(0, dtype=np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(nodes), lists, pa.array(prints.view(np.int64))], ["doc_id", "row_key", "node", "bands", "fp"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = _Words()
    for batch in batches:
        sets = [shingles(t, words).tobytes() for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, type=pa.binary())], ["node", "shingles"])


def cell_links(nodes: np.ndarray, home: np.ndarray, sets: list[np.ndarray]) -> tuple[list[int], list[int]]:
    """Links that connect the home texts of a cell with its visitors as all similar pairs would; each link is a similar pair."""
    guests = np.flatnonzero(~home)
    owner = np.repeat(np.arange(len(guests)), [len(sets[g]) for g in guests])
    values = np.concatenate([sets[g] for g in guests]) if len(guests) else np.empty(0, dtype=np.uint64)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    sizes = np.array([len(sets[g]) for g in guests], dtype=np.int64)
    names, label = np.unique(nodes, return_inverse=True)
    label_of = np.arange(len(names))
    a, b = [], []
    for h in np.flatnonzero(home):
        left, right = np.searchsorted(values, sets[h], "left"), np.searchsorted(values, sets[h], "right")
        counts = right - left
        at = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(left, counts)
        both = np.bincount(owner[at], minlength=len(guests))
        close = both * SIMILAR[1] >= SIMILAR[0] * (len(sets[h]) + sizes - both)
        for g in guests[close]:
            mine, other = label_of[label[h]], label_of[label[g]]
            if mine != other:
                label_of[label_of == other] = mine
                a.append(int(nodes[h]))
                b.append(int(nodes[g]))
    return a, b


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of one cell after another; rows come sorted by cell, and one cell is held at a time."""
    def made(held):
        nodes, home, sets = zip(*held, strict=True)
        a, b = cell_links(np.array(nodes, dtype=np.int64), np.array(home, dtype=bool), [np.frombuffer(s, dtype=np.uint64) for s in sets])
        return pa.RecordBatch.from_arrays([pa.array(a, type=pa.int64()), pa.array(b, type=pa.int64())], ["a", "b"])

    held, last = [], None
    for batch in batches:
        for cell, *row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if held and cell != last:
                yield made(held)
                held = []
            last = cell
            held.append(row)
    if held:
        yield made(held)


def _confirmed(cells: DataFrame, sets: DataFrame) -> DataFrame:
    """Links among the rows ``cell, node, home`` of each cell."""
    met = cells.join(sets, "node").select("cell", "node", "home", "shingles").repartition("cell").sortWithinPartitions("cell")
    return checkpointed(met.mapInArrow(_links, "a long, b long").distinct())


def _stars(pairs: DataFrame) -> DataFrame:
    """Cells of each hub with its partners, block by block."""
    blocks = F.ceil(F.count("*").over(Window.partitionBy("hub")) / STAR_BLOCK)
    dealt = pairs.withColumn("cell", F.xxhash64("hub", F.pmod(F.xxhash64("node"), blocks)))
    hubs = dealt.select("cell", F.col("hub").alias("node"), F.lit(True).alias("home")).distinct()
    return dealt.select("cell", "node", F.lit(False).alias("home")).union(hubs)


def _squares(members: DataFrame) -> DataFrame:
    """Cells in which all members ``bucket, node`` of a bucket meet, block by block."""
    blocks = F.ceil(F.count("*").over(Window.partitionBy("bucket")) / BLOCK)
    dealt = members.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("node", F.lit(1)), "blocks"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    homes = dealt.where("other >= own").select(F.xxhash64("bucket", "own", "other").alias("cell"), "node", F.lit(True).alias("home"))
    guests = dealt.where("other <= own").select(F.xxhash64("bucket", "other", "own").alias("cell"), "node", F.lit(False).alias("home"))
    return homes.union(guests)


def anchor_pairs(nodes: DataFrame) -> DataFrame:
    """Pairs ``hub, node`` of the rows ``node, fp`` that connect all whose fingerprints are linked at anchors, equal ones included."""
    nodes = checkpointed(nodes)
    least = checkpointed(nodes.groupBy("fp").agg(F.min("node").alias("hub")))
    same = nodes.join(least, "fp").where("node <> hub").select("hub", "node")
    links = anchor_links(least.select("fp"), WIDE)
    ends = links.join(least.select(F.col("fp").alias("a"), "hub"), "a").join(least.select(F.col("fp").alias("b"), F.col("hub").alias("node")), "b")
    return same.union(ends.select("hub", "node"))


def similar_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, row_key, component``, equal for documents that links connect.

    Texts whose sets of five-word runs have a Jaccard similarity of at least 0.8 are
    linked; texts without words, null included, are linked with each other.  Candidates
    are linked at anchor points, where the fingerprints of their sets differ by up to
    ``WIDE`` bits, or share a band of their MinHash signatures.  In each bucket all are compared with its
    least text; where that leaves a bucket in several components, all its pairs are
    compared.  Every link is confirmed on the whole sets.
    """
    name = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), row_key(doc_id, text).alias("row_key"), name.alias("node"), F.col(text).alias("text"))
    found = checkpointed(rows.mapInArrow(_signatures, "doc_id long, row_key long, node long, bands array<long>, fp long"))
    nodes = found.where("node <> 0").groupBy("node").agg(F.first("bands").alias("bands"), F.first("fp").alias("fp"))
    banded = nodes.select("node", F.explode("bands").alias("bucket"))
    stars = checkpointed(banded.withColumn("hub", F.min("node").over(Window.partitionBy("bucket"))).where("node <> hub"))
    pairs = checkpointed(stars.select("hub", "node").union(anchor_pairs(nodes.select("node", "fp"))).distinct())
    wanted = checkpointed(pairs.select("node").union(pairs.select("hub")).distinct())
    texts, key = keyed(rows.select("node", "text"), "node", "text")
    texts = texts.withColumn(key, F.col("node"))
    _, likely = split_by_keys(texts, key, wanted.select(F.col("node").alias("row_key")))
    likely = likely.join(wanted, "node", "left_semi").select("node", "text").dropDuplicates(["node"])
    sets = checkpointed(likely.mapInArrow(_sets, "node long, shingles binary"))
    links = _confirmed(_stars(pairs), sets)

    linked = checkpointed(connected_components(links, "a", "b"))
    reached = stars.join(linked, "node", "left").join(linked.select(F.col("node").alias("hub"), F.col("component").alias("hub_component")), "hub", "left")
    apart = F.coalesce("component", "node") != F.coalesce("hub_component", "hub")
    mark = [F.count("*").alias("n"), F.bit_xor(F.xxhash64("node", F.lit(2))).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(3))).alias("y")]
    open_buckets = reached.groupBy("bucket", "hub").agg(*mark, F.bool_or(apart).alias("apart")).where("apart AND n > 1")
    # Buckets of the same members are compared once.
    open_buckets = checkpointed(open_buckets.groupBy("hub", "n", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket", "hub"))
    members = stars.select("bucket", "node").join(open_buckets.select("bucket"), "bucket", "left_semi")
    members = members.union(open_buckets.select("bucket", F.col("hub").alias("node")))
    links = links.union(_confirmed(_squares(members), sets))
    linked = connected_components(links, "a", "b")
    return found.join(linked, "node", "left").select("doc_id", "row_key", F.coalesce("component", "node").alias("component"))
