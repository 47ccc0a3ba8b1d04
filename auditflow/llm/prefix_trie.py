"""Prefix trie of conversations by burst tries.

Distinct sequences of turns are records of one container under the root.  A container
with too many turns bursts: what its records begin with in common becomes nodes, and the
records move on to a container per next turn, keeping only their suffixes.  Containers
that are small enough are sorted and swept into nodes, each within one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditflow.llm.common import checkpointed
from auditflow.operators.digest import streamed_digest

#: Turns that a container may hold before it bursts; a single record is never too large.
CONTAINER_TURNS = 2048
#: Oversized containers of a round that are broadcast to their records; more are joined by shuffle.
BROADCAST_ROWS = 10_000

HEAD, PARENT, SID = ["head_hi", "head_lo"], ["parent_hi", "parent_lo"], ["sid_hi", "sid_lo"]


@dataclass(frozen=True)
class Trie:
    """``nodes``: one row per node, with the sequence ``sid_hi, sid_lo`` that ends there; ``ends``: the sequence of each conversation."""

    nodes: DataFrame
    ends: DataFrame


def turn_sequences(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, seq, sizes``: per conversation the ids of its turns, two longs each, and the UTF-8 bytes of their texts.

    An id is 128 bits of the SHA-256 of role and text.  A null number comes first, equal
    numbers are ordered by id, a null role or text is empty, repeated rows are repeated
    turns.  Rows without a conversation id take no part.
    """
    role_, text_ = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    sha = F.sha2(F.concat(F.octet_length(role_).cast("string"), F.lit(":"), role_, text_), 256)
    rows = turns.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"), sha.alias("sha"), F.octet_length(text_).cast("long").alias("size"))
    half = [F.conv(F.substring("sha", at, 16), 16, -10).cast("long") for at in (1, 17)]
    said = F.sort_array(F.collect_list(F.struct("turn", half[0].alias("hi"), half[1].alias("lo"), "size"))).alias("said")
    return rows.groupBy("conv_id").agg(said).select(
        "conv_id", F.flatten(F.transform("said", lambda t: F.array(t["hi"], t["lo"]))).alias("seq"), F.transform("said", lambda t: t["size"]).alias("sizes"))


def _after(values: str, skip: Column) -> Column:
    """The array without its first ``skip`` elements."""
    return F.slice(values, skip + 1, F.size(values))


def rebuilt(sequences: DataFrame) -> DataFrame:
    """Conversation c as the first h turns of conversation c - c % 5, then its own after its first h; h = crc32(c) % 9."""
    h = (F.crc32(F.col("conv_id").cast("string")) % 9).cast("int")
    own = sequences.withColumn("base", F.col("conv_id") - F.col("conv_id") % 5).withColumn("h", h)
    first = sequences.where("conv_id % 5 = 0").select(
        F.col("conv_id").alias("base"), F.slice("seq", 1, 16).alias("base_seq"), F.slice("sizes", 1, 8).alias("base_sizes"))
    none = F.array().cast("array<bigint>")
    both = own.join(first, "base", "left").withColumns({c: F.coalesce(c, none) for c in ("base_seq", "base_sizes")})
    return both.select(
        "conv_id", F.concat(F.slice("base_seq", F.lit(1), 2 * F.col("h")), _after("seq", 2 * F.col("h"))).alias("seq"),
        F.concat(F.slice("base_sizes", F.lit(1), F.col("h")), _after("sizes", F.col("h"))).alias("sizes"))


NODES = pa.schema([(n, pa.int64()) for n in (
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "turn_hi", "turn_lo", *SID, *PARENT)] + [("top", pa.bool_())])
NODE_DDL = ", ".join(f"{f.name} {'boolean' if f.name == 'top' else 'long'}" for f in NODES)


def _chain(sizes: np.ndarray, seq: np.ndarray, row: dict, below: tuple[int, int, int]) -> pa.RecordBatch:
    """Nodes that follow each other without a branch; ``below``: children, leaves and saved tokens under the last one."""
    k, (children, leaves, saved) = len(sizes), below
    full = lambda value: pa.array(np.full(k, value)) if value is not None else pa.nulls(k, pa.int64())
    last = lambda value: pa.array([None] * (k - 1) + [value], type=pa.int64())
    head = lambda value: pa.array([value] + [None] * (k - 1), type=pa.int64())
    n = row["n"]
    parents = pa.concat_arrays([head(row["up"])[:1], full(row["first"])[1:]])
    n_children = np.full(k, 1)
    n_children[-1] = children
    top = np.zeros(k, bool)
    top[0] = True
    columns = [full(row["first"]), pa.array(row["depth"] + np.arange(k)), parents, full(n), pa.array(n_children), full(leaves),
               pa.array(saved + (n - 1) * np.cumsum(sizes[::-1])[::-1]), pa.array(seq[0::2]), pa.array(seq[1::2]),
               last(row["sid_hi"]), last(row["sid_lo"]), head(row["parent_hi"]), head(row["parent_lo"]), pa.array(top)]
    return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, NODES, strict=True)], schema=NODES)


def _chain_of(row: dict, below: tuple[int, int, int]) -> pa.RecordBatch:
    sizes = np.r_[row["edge"], np.asarray(row["sizes"], np.int64)].astype(np.int64)
    seq = np.r_[row["edge_hi"], row["edge_lo"], np.asarray(row["seq"], np.int64)].astype(np.int64)
    return _chain(sizes, seq, row, below)


def _swept(rows: list[dict]) -> pa.RecordBatch:
    """The nodes of a container from its sorted records; its head is the first node."""
    head = rows[0]
    # per node: parent, depth, size, turn, sequence that ends there, members, least member
    parent, depth, size, turn = [-1], [head["depth"]], [head["edge"]], [(head["edge_hi"], head["edge_lo"])]
    ends, members, first = [(None, None)], [0], [None]
    path, before = [0], []
    for row in rows:
        said = list(zip(row["seq"][0::2], row["seq"][1::2], strict=True))
        same = next((k for k, (a, b) in enumerate(zip(before, said)) if a != b), min(len(before), len(said)))
        del path[same + 1:]
        for k in range(same, len(said)):
            parent.append(path[-1])
            path.append(len(depth))
            depth.append(head["depth"] + k + 1)
            size.append(row["sizes"][k])
            turn.append(said[k])
            ends.append((None, None))
            members.append(0)
            first.append(None)
        at, before = path[-1], said
        ends[at], members[at], first[at] = (row["sid_hi"], row["sid_lo"]), row["n"], row["first"]
    count = len(depth)
    children, leaves, saved = [0] * count, [0] * count, [0] * count
    for at in range(count - 1, -1, -1):
        leaves[at] = leaves[at] or 1
        saved[at] += (members[at] - 1) * size[at]
        up = parent[at]
        if up >= 0:
            members[up] += members[at]
            first[up] = first[at] if first[up] is None else min(first[up], first[at])
            children[up] += 1
            leaves[up] += leaves[at]
            saved[up] += saved[at]
    above = [head["up"]] + [first[p] for p in parent[1:]]
    rest = [None] * (count - 1)
    columns = [first, depth, above, members, children, leaves, saved, *zip(*turn, strict=True), *zip(*ends, strict=True),
               [head["parent_hi"], *rest], [head["parent_lo"], *rest], [True] + [False] * (count - 1)]
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, NODES, strict=True)], schema=NODES)


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = (row for batch in batches for row in batch.to_pylist())
    for _, group in groupby(rows, key=lambda r: (r["head_hi"], r["head_lo"])):
        held = list(group)
        yield _chain_of(held[0], (0, 1, 0)) if len(held) == 1 else _swept(held)


def _unrolled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            yield _chain_of(row, (row["n_children"], row["n_leaves"], row["saved"]))


def _few(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _burst(records: DataFrame, limit: int) -> tuple[DataFrame, list[DataFrame]]:
    """Records in containers that are small enough, and the containers that burst, round by round.

    A round that finds an oversized container takes the nodes that all its records share
    in one step, so rounds follow the branchings and not the turns.
    """
    opened, closed, rounds = records, [], []
    while True:
        sums = opened.groupBy(*HEAD).agg(F.count("*").alias("rows"), F.sum(F.size("sizes")).alias("turns"))
        large = checkpointed(sums.where((F.col("turns") > limit) & (F.col("rows") > 1)).select(*HEAD))
        count = large.count()
        if not count:
            return reduce(DataFrame.union, [*closed, opened]), rounds
        closed.append(opened.join(_few(large, count), HEAD, "left_anti").select(records.columns))
        hit = opened.join(_few(large, count), HEAD).select(records.columns)
        same = [F.first(c).alias(c) for c in ("depth", "edge", "edge_hi", "edge_lo", "up", *PARENT)]
        met = hit.groupBy(*HEAD).agg(
            F.sum("n").alias("n"), F.min("first").alias("first"), F.min(F.struct("seq", "sizes")).alias("low"), F.max("seq").alias("high"), *same)
        differs = F.zip_with("low.seq", "high", lambda a, b: ~a.eqNullSafe(b))
        shared = F.floor((F.array_position(differs, True) - 1) / 2).cast("int")
        stats = checkpointed(met.withColumn("shared", shared).select(
            *HEAD, "n", "first", "shared", F.slice("low.seq", F.lit(1), 2 * F.col("shared")).alias("seq"),
            F.slice("low.sizes", F.lit(1), F.col("shared")).alias("sizes"), "depth", "edge", "edge_hi", "edge_lo", "up", *PARENT))
        step = _few(stats.select(*HEAD, "shared", F.col("first").alias("above")), count)
        moved = hit.join(step, HEAD)
        over = F.size("sizes") > F.col("shared")
        at = 2 * F.col("shared")
        hi, lo = F.get("seq", at), F.get("seq", at + 1)
        opened = checkpointed(moved.where(over).select(
            _after("seq", at + 2).alias("seq"), _after("sizes", F.col("shared") + 1).alias("sizes"), "n", "first", *SID,
            *[F.xxhash64(F.lit(salt), *HEAD, hi, lo).alias(name) for salt, name in enumerate(HEAD)],
            (F.col("depth") + F.col("shared") + 1).alias("depth"), F.get("sizes", "shared").alias("edge"), hi.alias("edge_hi"), lo.alias("edge_lo"),
            F.col("above").alias("up"), F.col("head_hi").alias("parent_hi"), F.col("head_lo").alias("parent_lo")))
        ended = moved.where(~over).select(*HEAD, *SID)
        rounds.append(checkpointed(stats.join(ended, HEAD, "left")))


def prefix_trie(sequences: DataFrame, container_turns: int = CONTAINER_TURNS) -> Trie:
    """The trie of ``sequences (conv_id, seq, sizes)``, as ``turn_sequences`` gives them; ids are unique.

    Nodes: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens``, ``turn_hi, turn_lo`` (last turn, null at
    the root) and ``sid_hi, sid_lo`` (the sequence that ends there, if any).  A
    conversation without turns is a member of the root; without conversations there are
    no nodes.  Conversations that agree in full are counted before anything is shuffled
    by head.  A task holds one container of at most ``container_turns`` turns, or one
    conversation.
    """
    sid = [F.xxhash64(F.lit(salt), "seq").alias(name) for salt, name in enumerate(SID)]
    rows = checkpointed(sequences.select("conv_id", "seq", "sizes", *sid))
    distinct = rows.groupBy("seq", "sizes", *SID).agg(F.count("*").alias("n"), F.min("conv_id").alias("first"))
    nothing = F.lit(None).cast("long")
    zero = F.lit(0).cast("long")
    records = checkpointed(distinct.select(
        "seq", "sizes", "n", "first", *SID, zero.alias("head_hi"), zero.alias("head_lo"), F.lit(0).alias("depth"), zero.alias("edge"),
        zero.alias("edge_hi"), zero.alias("edge_lo"), nothing.alias("up"), nothing.alias("parent_hi"), nothing.alias("parent_lo")))
    small, rounds = _burst(records, container_turns)
    nodes = checkpointed(small.repartition(*HEAD).sortWithinPartitions(*HEAD, "seq").mapInArrow(_sweep, NODE_DDL))
    made, tops = [nodes], nodes.where("top").select(*PARENT, "n_leaves", F.col("saved_tokens").alias("saved"))
    for burst in reversed(rounds):
        under = tops.groupBy(*PARENT).agg(F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))
        under = under.withColumnsRenamed(dict(zip(PARENT, HEAD, strict=True)))
        chains = checkpointed(burst.join(under, HEAD).mapInArrow(_unrolled, NODE_DDL))
        made.append(chains)
        tops = tops.union(chains.where("top").select(*PARENT, "n_leaves", F.col("saved_tokens").alias("saved")))
    every = reduce(DataFrame.union, made)
    turn = [F.when(F.col("depth") > 0, F.col(c)).alias(c) for c in ("turn_hi", "turn_lo")]
    return Trie(every.select(*NODES.names[:7], *turn, *SID), rows.select("conv_id", *SID))


def digests(trie: Trie) -> DataFrame:
    """Nodes with a print of the conversations that end there: ascending ids, joined by commas."""
    told = streamed_digest(trie.ends, SID, ["conv_id"], "conv_id", ",").select(*SID, F.col("sha256").alias("ends_sha256"))
    columns = [*NODES.names[:7], "ends_sha256"]
    inner = trie.nodes.where(F.col("sid_hi").isNull()).withColumn("ends_sha256", F.sha2(F.lit(""), 256)).select(columns)
    return inner.union(trie.nodes.where(F.col("sid_hi").isNotNull()).join(told, SID).select(columns))


ORACLE = """
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list(sha256(strlen(role) || ':' || role || text) ORDER BY turn NULLS FIRST) AS ids,
             list(CAST(strlen(text) AS BIGINT) ORDER BY turn NULLS FIRST) AS sizes FROM t GROUP BY conv_id),
crc AS (SELECT conv_id, CAST(h AS BIGINT) % 9 AS h FROM (SELECT conv_id, list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
          [CAST(ord(x) AS BIGINT) FOR x IN string_split(CAST(conv_id AS VARCHAR), '')]),
          lambda a, b: list_reduce(list_prepend(xor(a, b), [CAST(i AS BIGINT) FOR i IN range(8)]),
            lambda s, i: CASE WHEN s % 2 = 1 THEN xor(s // 2, 3988292384) ELSE s // 2 END)) AS s FROM c) r, LATERAL (SELECT xor(s, 4294967295) AS h)),
r AS (SELECT c.conv_id, coalesce(b.ids[:h], []) || c.ids[h + 1:] AS ids, coalesce(b.sizes[:h], []) || c.sizes[h + 1:] AS sizes
      FROM c JOIN crc USING (conv_id) LEFT JOIN c b ON b.conv_id = c.conv_id - c.conv_id % 5),
p AS (SELECT conv_id, ids[:d] AS path, ids[:d - 1] AS up, d, sizes[d] AS size, len(ids) = d AS is_end
      FROM (SELECT *, unnest(range(len(ids) + 1)) AS d FROM r)),
n AS (SELECT path, any_value(CASE WHEN d > 0 THEN up END) AS up, any_value(d) AS depth, coalesce(any_value(size), 0) AS size, count(*) AS n_convs, min(conv_id) AS conv_id,
             sha256(coalesce(string_agg(CASE WHEN is_end THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256 FROM p GROUP BY path),
k AS (SELECT up AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY up),
w AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (path)),
s AS (SELECT above AS path, CAST(sum(CAST(n_children = 0 AS BIGINT)) AS BIGINT) AS n_leaves, CAST(sum((n_convs - 1) * size) AS BIGINT) AS saved_tokens
      FROM (SELECT n_children, n_convs, size, unnest([path[:i] FOR i IN range(depth + 1)]) AS above FROM w) GROUP BY above)
SELECT w.conv_id, w.depth, u.conv_id AS parent_conv_id, w.n_convs, w.n_children, s.n_leaves, s.saved_tokens, w.ends_sha256
FROM w JOIN s USING (path) LEFT JOIN w u ON u.path = w.up"""
