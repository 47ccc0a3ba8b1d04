"""Exact top-k by inner product as a Voronoi join.

Data and queries fall into the cells of pivots.  Summaries of the cells bound what a
vector can score for the queries of a cell: for a vector ``x`` at distance ``r`` of
pivot ``p``, ``q.x`` lies within ``|q| r`` of ``q.p``.  A vector is sent to a group of
query cells only if its upper bound reaches the score that the summaries already
guarantee, and each group is solved locally, block by block.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditflow.llm.common import checkpointed

TOP = 20
SCALE = 64
PIVOTS = 48
#: Distinct vectors that pivots are chosen from, at most; the bound of what the driver holds.
PIVOT_SAMPLE = 2048
#: Queries of a local problem and vectors of a block, about.
GROUP_QUERIES = 1024
BLOCK_ROWS = 4096


def quantized(vectors: DataFrame, query: Column, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``uid, vec_id, vec, is_query``: components as ``floor(scale * x)``.

    Rows with a null id, a null vector, or a null or non-finite component are left out.
    """
    x = F.col(embedding)
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = vectors.where(F.col(vec_id).isNotNull() & x.isNotNull()).where(~odd)
    vec = F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("long"))
    return rows.select(F.monotonically_increasing_id().alias("uid"), F.col(vec_id).cast("long").alias("vec_id"), vec.alias("vec"), query.alias("is_query"))


def matrix(vectors, width: int) -> np.ndarray:
    """Rows of equal width; shorter vectors are as if filled with zeros."""
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def choose_pivots(rows: DataFrame, width: int, pivots: int = PIVOTS) -> np.ndarray:
    """Centres of a few rounds of k-means over a bounded sample of distinct vectors, the same on every run."""
    sample = rows.select("vec", F.xxhash64("vec").alias("h")).orderBy("h", "vec").limit(PIVOT_SAMPLE).toPandas()
    points = np.unique(matrix(sample["vec"], width), axis=0).astype(float)
    centres = points[np.random.default_rng(0).permutation(len(points))[:pivots]]
    for _ in range(5):
        near = distances(points, centres).argmin(axis=1)
        for c in range(len(centres)):
            if (near == c).any():
                centres[c] = points[near == c].mean(axis=0)
    return centres


def distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    squares = (points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)[None, :]
    return np.sqrt(np.maximum(squares, 0))


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products; in floating point only where no rounding can occur."""
    largest = a.shape[1] * float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0))
    if largest < 2**53:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    return a @ b.T


def best(scores: np.ndarray, ids: np.ndarray, top: int) -> np.ndarray:
    """Indices of the highest scores; columns come in order of id, so ties go to smaller ids."""
    if len(scores) > top:
        least = np.partition(scores, len(scores) - top)[len(scores) - top]
        above, level = np.flatnonzero(scores > least), np.flatnonzero(scores == least)
        found = np.concatenate((above, level[:top - len(above)]))
    else:
        found = np.arange(len(scores))
    return found[np.lexsort((ids[found], -scores[found]))]


def top_k(vectors: DataFrame, query: Column, top: int = TOP, vec_id: str = "vec_id", embedding: str = "embedding",
          pivots: int = PIVOTS, group_queries: int = GROUP_QUERIES, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row that ``query`` marks its best partners among all other rows.

    Scores are inner products of the quantized vectors, ties go to the smaller id.
    Vectors of different lengths are compared as if filled with zeros, an empty vector
    scores 0 with all.  A repeated row is a row: it is a partner of its copies.  A
    query has fewer rows if there are fewer partners; no vectors give no rows.
    """
    rows = checkpointed(quantized(vectors, query, vec_id, embedding))
    spark = rows.sparkSession
    found = rows.agg(F.max(F.size("vec")).alias("width"), F.count("*").alias("n"), F.sum(F.col("is_query").cast("long")).alias("queries")).first()
    if not found["queries"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    width, blocks = found["width"], -(-found["n"] // block_rows)
    centres = choose_pivots(rows, width, pivots)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            m = matrix(part["vec"], width)
            d = distances(m.astype(float), centres)
            cell = d.argmin(axis=1)
            yield pd.DataFrame({"uid": part["uid"], "vec_id": part["vec_id"], "is_query": part["is_query"], "cell": cell,
                                "r": d[np.arange(len(m)), cell], "vec": [v.tobytes() for v in m]})

    dealt = checkpointed(rows.mapInPandas(assign, "uid long, vec_id long, is_query boolean, cell int, r double, vec binary"))

    def query_bounds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Per query cell and pivot the range of q.p, and the longest query."""
        for part in batches:
            for cell, own in part.groupby("cell"):
                q = np.stack([np.frombuffer(v, dtype=np.int64) for v in own["vec"]]).astype(float)
                dots = q @ centres.T
                yield pd.DataFrame({"cell": cell, "pivot": np.arange(len(centres)), "low": dots.min(0), "high": dots.max(0),
                                    "length": np.sqrt((q**2).sum(1).max()), "n": len(own)})

    bounds = dealt.where("is_query").mapInPandas(query_bounds, "cell int, pivot int, low double, high double, length double, n long")
    bounds = bounds.groupBy("cell", "pivot").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.max("length").alias("length"), F.sum("n").alias("n")).toPandas()
    nearest = dealt.withColumn("k", F.row_number().over(Window.partitionBy("cell").orderBy("r"))).where(F.col("k") <= top + 1)
    nearest = nearest.select("cell", "r").toPandas()
    cells = np.sort(bounds["cell"].unique())
    groups, reach = _plan(bounds, nearest, cells, centres, top, group_queries)
    group_of = spark.createDataFrame([(int(c), int(g), int(s)) for c, (g, s) in groups.items()], "cell int, grp int, splits int")

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A vector goes to the groups where its radius lets it reach the guaranteed score."""
        splits = {g: s for g, s in groups.values()}
        for part in batches:
            cell, r = part["cell"].to_numpy(), part["r"].to_numpy()
            for g, needed in reach.items():
                keep = np.flatnonzero(r >= needed[cell])
                for s in range(splits[g]):
                    sent = part.iloc[keep]
                    yield pd.DataFrame({"grp": g, "split": s, "uid": sent["uid"], "vec_id": sent["vec_id"], "vec": sent["vec"]})

    sent = dealt.select("uid", "vec_id", "cell", "r", "vec").mapInPandas(send, "grp int, split int, uid long, vec_id long, vec binary")
    data = sent.withColumn("block", F.pmod(F.xxhash64("uid"), F.lit(blocks)))
    asks = dealt.where("is_query").join(group_of, "cell").select(
        "grp", F.pmod(F.xxhash64("uid"), F.col("splits")).cast("int").alias("split"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), "uid", "vec_id", "vec")
    out = "query_uid long, query_id long, uid long, vec_id long, score long"

    def solve(queries: pd.DataFrame, near: pd.DataFrame) -> pd.DataFrame:
        parts = []
        if len(queries) and len(near):
            near = near.sort_values(["vec_id", "uid"])
            x = np.stack([np.frombuffer(v, dtype=np.int64) for v in near["vec"]])
            ids, uids = near["vec_id"].to_numpy(), near["uid"].to_numpy()
            for at in range(0, len(queries), 256):
                asked = queries.iloc[at:at + 256]
                scores = inner_products(np.stack([np.frombuffer(v, dtype=np.int64) for v in asked["vec"]]), x)
                for i, (uid, query_id) in enumerate(zip(asked["uid"], asked["vec_id"], strict=True)):
                    others = uids != uid
                    own, own_ids, own_uids = (scores[i], ids, uids) if others.all() else (scores[i][others], ids[others], uids[others])
                    hit = best(own, own_ids, top)
                    parts.append(pd.DataFrame({"query_uid": uid, "query_id": query_id, "uid": own_uids[hit], "vec_id": own_ids[hit], "score": own[hit]}))
        return pd.concat(parts) if parts else pd.DataFrame({c.split()[0]: pd.Series([], dtype="int64") for c in out.split(", ")})

    key = ["grp", "split", "block"]
    local = asks.groupBy(*key).cogroup(data.groupBy(*key)).applyInPandas(solve, out)
    order = Window.partitionBy("query_uid").orderBy(F.desc("score"), "vec_id", "uid")
    ranked = local.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _plan(bounds: pd.DataFrame, nearest: pd.DataFrame, cells: np.ndarray, centres: np.ndarray, top: int, group_queries: int):
    """Groups of neighbouring query cells, and for each group the least radius a vector of a cell must have to matter.

    Everything here has at most as many entries as pairs of pivots.
    """
    low = bounds.pivot(index="cell", columns="pivot", values="low").loc[cells].to_numpy()
    high = bounds.pivot(index="cell", columns="pivot", values="high").loc[cells].to_numpy()
    length = bounds.groupby("cell")["length"].max().loc[cells].to_numpy()
    count = bounds.groupby("cell")["n"].max().loc[cells].to_numpy()
    at, r = nearest["cell"].to_numpy(), nearest["r"].to_numpy()
    needed = np.full((len(cells), len(centres)), -np.inf)
    for i in range(len(cells)):
        sure = low[i][at] - length[i] * r
        if len(sure) > top:  # one more than asked for, since a query is no partner of itself
            guaranteed = np.partition(sure, len(sure) - top - 1)[len(sure) - top - 1]
            slack = 1e-6 * (1 + abs(guaranteed) + np.abs(high[i]) + length[i])
            with np.errstate(divide="ignore", invalid="ignore"):
                radius = np.where(high[i] + slack >= guaranteed, -np.inf, (guaranteed - high[i] - slack) / length[i])
            needed[i] = np.where(np.isnan(radius), -np.inf, radius)
    chain, left = [0], set(range(1, len(cells)))
    while left:
        following = min(left, key=lambda c: (((centres[cells[c]] - centres[cells[chain[-1]]]) ** 2).sum(), c))
        chain.append(following)
        left.discard(following)
    members: list[list[int]] = [[]]
    for c in chain:
        if members[-1] and count[members[-1]].sum() + count[c] > group_queries:
            members.append([])
        members[-1].append(c)
    groups, reach = {}, {}
    for g, own in enumerate(members):
        splits = max(1, -(-int(count[own].sum()) // group_queries))
        groups |= {int(cells[c]): (g, splits) for c in own}
        reach[g] = reduce(np.minimum, [needed[c] for c in own])
    return groups, reach


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 64)) AS vec FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.vec_id AS query_id, d.vec_id, CAST(list_dot_product(q.vec, d.vec) AS BIGINT) AS score
      FROM v q JOIN v d ON q.vec_id % 20 = 0 AND q.vec_id <> d.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20"""
