"""Near duplicates by SimHash fingerprints and anchor points of a covering code."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditflow.llm.common import checkpointed, row_key
from auditflow.llm.components import connected_components

SHINGLE = 4
THRESHOLD = 4
SEED = 42
BITS = 64
#: Points of one anchor that a task compares at a time; a larger anchor is split into blocks.
BLOCK = 8192
#: Fixed value: generator polynomial of the perfect binary Golay code, length 23, radius 3.
GOLAY = 0b110001110101
#: The fingerprint is cut into these widths, each covered by the Golay code without one or two check bits.
WIDTHS = (21, 21, 22)


def fingerprint(words: list[bytes], shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Bit i is set if it is set in over half of the shingle hashes; no words give zero."""
    from xxhash import xxh64_intdigest

    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    if len(words) <= shingle:
        hashes = [xxh64_intdigest(joined, seed)]
    else:
        starts = np.concatenate(([0], ends[:-shingle])).tolist()
        stops = (ends[shingle - 1:] - 1).tolist()
        hashes = [xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts, stops, strict=True)]
    return majority(hashes)


def majority(hashes: Sequence[int] | np.ndarray) -> int:
    """Bit i is set if it is set in over half of the hashes."""
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at:at + (1 << 16)], dtype=">u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = [fingerprint((t or "").encode().lower().split()) for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(np.array(prints, dtype=np.uint64).view(np.int64))], ["doc_id", "row_key", "fp"])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, row_key, fp`` of whole texts; null counts as empty."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), row_key(doc_id, text).alias("row_key"), F.col(text).alias("text"))
    return rows.mapInArrow(_fingerprints, "doc_id long, row_key long, fp long")


class CoveringCode:
    """The Golay code with check bits left out: 4096 anchors, every point within 3 of one.

    A point is twelve message bits and ``width - 12`` check bits.  Its syndrome names
    the error patterns that lead to an anchor, lightest first.
    """

    radius = 3

    def __init__(self, width: int, reach: int):
        self.width, checks = width, width - 12
        self.mask = (1 << checks) - 1
        code = np.zeros(4096, dtype=np.int64)
        for message in range(4096):
            rest = message << 11
            for bit in range(22, 10, -1):
                if rest >> bit & 1:
                    rest ^= GOLAY << (bit - 11)
            code[message] = rest & self.mask
        self.code = code
        errors = [0] + [sum(1 << i for i in bits) for n in range(1, max(reach, self.radius) + 1) for bits in combinations(range(width), n)]
        errors = np.array(errors, dtype=np.int64)
        weight = np.bitwise_count(errors)
        syndrome = self.syndrome(errors)
        order = np.lexsort((errors, weight, syndrome))
        self.errors, self.weight = errors[order], weight[order]
        self.first = np.searchsorted(syndrome[order], np.arange(self.mask + 2))

    def syndrome(self, points: np.ndarray) -> np.ndarray:
        return (points >> 12) ^ self.code[points & 4095]

    def home(self, points: np.ndarray) -> np.ndarray:
        """The nearest anchor of each point, by its message bits."""
        return (points ^ self.errors[self.first[self.syndrome(points)]]) & 4095

    def ball(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of a point and anchor, for every anchor within reach."""
        s = self.syndrome(points)
        counts = self.first[s + 1] - self.first[s]
        row = np.repeat(np.arange(len(points)), counts)
        at = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(self.first[s], counts)
        return row, (points[row] ^ self.errors[at]) & 4095


def codes(threshold: int = THRESHOLD) -> list[CoveringCode]:
    """One code per part; two fingerprints within the threshold differ by at most a third of it in some part."""
    return [CoveringCode(w, CoveringCode.radius + threshold // len(WIDTHS)) for w in WIDTHS]


def parts_of(prints: np.ndarray) -> list[np.ndarray]:
    prints = prints.view(np.uint64)
    out, at = [], 0
    for width in WIDTHS:
        out.append((prints >> np.uint64(at) & np.uint64((1 << width) - 1)).astype(np.int64))
        at += width
    return out


def _load(threshold: int):
    """Points per anchor, as home and in its ball, of one batch after another."""
    def count(batches):
        table = codes(threshold)
        for rows in batches:
            out = []
            for k, points in enumerate(parts_of(rows["fp"].to_numpy())):
                home = np.bincount(table[k].home(points), minlength=4096)
                ball = np.bincount(table[k].ball(points)[1], minlength=4096)
                out.append(pd.DataFrame({"anchor": k * 4096 + np.arange(4096), "home": home, "ball": ball}))
            yield pd.concat(out).query("home > 0 or ball > 0")

    return count


def _deal(threshold: int, homes: np.ndarray, balls: np.ndarray):
    """Send each point to its home anchor and to all within reach, block by block."""
    def deal(batches):
        table = codes(threshold)
        for rows in batches:
            prints = rows["fp"].to_numpy()
            salt = (prints.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)
            for k, points in enumerate(parts_of(prints)):
                for side in (True, False):
                    if side:
                        row, anchor = np.arange(len(points)), table[k].home(points)
                    else:
                        row, anchor = table[k].ball(points)
                    anchor = anchor + k * 4096
                    own, other = (homes, balls) if side else (balls, homes)
                    mine = salt[row] % own[anchor]
                    copies = other[anchor]
                    at = np.repeat(np.arange(len(row)), copies)
                    theirs = np.arange(len(at)) - np.repeat(np.cumsum(copies) - copies, copies)
                    h, b = (mine[at], theirs) if side else (theirs, mine[at])
                    yield pd.DataFrame({"cell": (anchor[at] << 40) | (h << 20) | b, "fp": prints[row[at]], "home": side})

    return deal


def block_links(mine: np.ndarray, visitors: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect the home points of a block with its visitors as all close pairs would.

    Labels spread over the boolean matrix of close pairs, so a block of close points
    gives a star and not its pairs.
    """
    edges = []
    label = np.arange(len(visitors))
    step = max(1, (1 << 21) // max(1, len(visitors)))
    for at in range(0, len(mine), step):
        part = mine[at:at + step]
        apart = part[:, None] ^ visitors[None, :]
        near = (np.bitwise_count(apart) <= threshold) & (apart != 0)
        rows = near.any(axis=1)
        if not rows.any():
            continue
        columns = np.flatnonzero(near.any(axis=0))
        near, part = near[np.ix_(rows, columns)], part[rows]
        start = old = label[columns]
        while True:
            low = np.where(near, old[None, :], len(visitors)).min(axis=1)
            new = np.minimum(old, np.where(near, low[:, None], len(visitors)).min(axis=0))
            if (new == old).all():
                break
            old = new
        moved = old != start
        edges += [(part, visitors[low]), (visitors[columns[moved]], visitors[old[moved]]),
                  (visitors[start[moved]], visitors[old[moved]])]
        label[columns] = old
    if not edges:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.uint64)
    a, b = (np.concatenate([e[i] for e in edges]) for i in (0, 1))
    return a[a != b], b[a != b]


def _links(threshold: int):
    """Links of one cell after another; rows come sorted by cell, and one cell is held at a time."""
    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        last = None
        for batch in batches:
            cell = batch.column("cell").to_numpy()
            prints = batch.column("fp").to_numpy().view(np.uint64)
            home = batch.column("home").to_numpy(zero_copy_only=False)
            cuts = np.concatenate(([0], np.flatnonzero(cell[1:] != cell[:-1]) + 1, [len(cell)]))
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if last is not None and cell[a] != last:
                    yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
                    held = []
                last = cell[a]
                held.append((prints[a:b], home[a:b]))
        if held:
            yield tuple(np.concatenate(x) for x in zip(*held, strict=True))

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for prints, home in cells(batches):
            a, b = block_links(prints[home], prints[~home], threshold)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return link


def anchor_links(prints: DataFrame, threshold: int = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """Edges ``a, b`` that connect the distinct ``fp`` values within ``threshold`` bits.

    Each of the three parts of a fingerprint has 4096 anchors.  A fingerprint is at home
    at the nearest anchor, at most the covering radius away, and is sent to all anchors
    within radius plus a third of the threshold, so every close pair meets at the home
    of either.  The counts per anchor, bounded by the code, split a crowded anchor into
    blocks of homes by visitors.
    """
    load = prints.mapInPandas(_load(threshold), "anchor long, home long, ball long")
    load = load.groupBy("anchor").agg(F.sum("home").alias("home"), F.sum("ball").alias("ball")).toPandas()
    homes, balls = (np.ones(3 * 4096, dtype=np.int64) for _ in range(2))
    if len(load):
        homes[load["anchor"]] = np.maximum(1, -(-load["home"].to_numpy() // block))
        balls[load["anchor"]] = np.maximum(1, -(-load["ball"].to_numpy() // block))
    dealt = prints.mapInPandas(_deal(threshold, homes, balls), "cell long, fp long, home boolean")
    met = dealt.repartition("cell").sortWithinPartitions("cell")
    return met.mapInArrow(_links(threshold), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id, row_key, fp, component, component_id``.

    Fingerprints within ``threshold`` bits are linked, equal ones included; the
    component id is the smallest document id that links reach, ``component`` its smallest
    fingerprint as a signed number.  Null and empty texts
    have fingerprint zero, linked like any other.  Null ids are passed over when the
    smallest is taken; a component of null ids only has a null id.
    """
    found = checkpointed(fingerprints(docs, doc_id, text))
    prints = checkpointed(found.groupBy("fp").agg(F.min("doc_id").alias("least")))
    linked = connected_components(anchor_links(prints.select("fp"), threshold), "a", "b")
    grouped = prints.join(linked, prints.fp == linked.node, "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component"))
    # One row per fingerprint; the smallest ids of a component are combined before the shuffle.
    least = checkpointed(grouped.groupBy("component").agg(F.min("least").alias("component_id")))
    named = checkpointed(grouped.join(least, "component").select("fp", "component", "component_id"))
    return found.join(named, "fp").select("doc_id", "row_key", "fp", "component", "component_id")
