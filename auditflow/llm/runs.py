"""Periodic runs of words: candidates on harmonic grids, exact extensions from a recompressed grammar.

A block of texts is one sequence of word numbers with a separator of its own before,
between and after the texts.  Recompression turns it, level by level, into a run-length
grammar: blocks of one symbol become a symbol, then pairs across a split of the symbols
become one.  Equal symbols of a level spell equal words, so the longest common extension
of two places climbs and descends the levels instead of comparing words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditflow.llm.common import WORD, text_of

#: Words that are judged together; a longer text is a block of its own.
BLOCK_WORDS = 250_000
MIN_LENGTH = 12


def _split(symbols: np.ndarray, seed: int) -> np.ndarray:
    """A fixed half of all symbols, by a hash."""
    mixed = (symbols.astype(np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    return ((mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(40)) & np.uint64(1) == 0


def _pairs(symbols: np.ndarray, level: int) -> np.ndarray:
    """Places of pairs to merge: left symbols before right ones, under the better of several splits."""
    best = np.empty(0, np.int64)
    for turn in range(64):
        left = _split(symbols, 64 * level + turn)
        for first, second in ((left, ~left), (~left, left)):
            at = np.flatnonzero(first[:-1] & second[1:])
            best = at if len(at) > len(best) else best
        if 5 * len(best) >= len(symbols) or (best.size and turn > 3):
            break
    return best


class Grammar:
    """Recompression of a sequence whose first and last symbols occur nowhere else.

    Nodes are numbered over all levels, words first, and neighbours of a level are
    neighbours in number.  A node has its symbol, the first and last node of the stretch
    of equal symbols around it, the parent whose first or last child it is, and its own
    first and last child; -1 stands for none.
    """

    def __init__(self, words: np.ndarray):
        symbols = np.unique(words, return_inverse=True)[1].astype(np.int64)
        fresh, base = int(symbols.max()) + 1, 0
        parts: list[list[np.ndarray]] = [[] for _ in range(7)]
        first = last = np.full(len(symbols), -1)
        for level in range(10_000):
            n = len(symbols)
            heads = np.flatnonzero(np.r_[True, symbols[1:] != symbols[:-1]])
            tails = np.r_[heads[1:], n] - 1
            sizes = tails - heads + 1
            up_first, up_last = np.full(n, -1), np.full(n, -1)
            for part, values in zip(parts, (symbols, np.repeat(heads, sizes) + base, np.repeat(tails, sizes) + base,
                                            up_first, up_last, first, last), strict=True):
                part.append(values)
            if n <= 3:
                break
            blocks = symbols[heads]
            many = np.flatnonzero(sizes > 1)
            if many.size:
                blocks[many] = fresh + np.unique(blocks[many] * (n + 1) + sizes[many], return_inverse=True)[1]
                fresh = int(blocks[many].max()) + 1
            at = _pairs(blocks, level)
            made = fresh + np.unique(blocks[at] * fresh + blocks[at + 1], return_inverse=True)[1]
            stays = np.ones(len(blocks), bool)
            stays[at + 1] = False
            blocks[at] = made
            parents = np.flatnonzero(stays)
            left, right = heads[parents], tails[np.r_[parents[1:], len(blocks)] - 1]
            up_first[left] = up_last[right] = base + n + np.arange(len(parents))
            first, last = left + base, right + base
            symbols, fresh, base = blocks[parents], max(fresh, int(made.max()) + 1 if made.size else 0), base + n
        self.words = len(words)
        self.symbol, self.begin, self.end, *links = (np.concatenate(p).astype(np.int32) for p in parts)
        self.up_first, self.up_last, self.down_first, self.down_last = links

    def _extend(self, i: np.ndarray, j: np.ndarray, up: np.ndarray, down: np.ndarray, stretch: np.ndarray, sign: int) -> np.ndarray:
        """Places where words from ``i`` on first differ from those from ``j`` on, in one direction."""
        out = np.empty(len(i), np.int64)
        who, u, v = np.arange(len(i)), i.astype(np.int64), j.astype(np.int64)
        while who.size:
            pu, pv = up[u], up[v]
            climb = (pu >= 0) & (pv >= 0) & (self.symbol[pu] == self.symbol[pv])
            same = self.symbol[u] == self.symbol[v]
            steps = np.minimum(sign * (stretch[u] - u), sign * (stretch[v] - v)) + 1
            nu = np.where(climb, pu, np.where(same, u + sign * steps, down[u]))
            nv = np.where(climb, pv, np.where(same, v + sign * steps, down[v]))
            done = ~climb & ~same & (u < self.words)
            out[who[done]] = u[done]
            who, u, v = who[~done], nu[~done], nv[~done]
        return out

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal words from ``i`` and ``j`` on, ``i`` itself included; ``i != j``."""
        return self._extend(i, j, self.up_first, self.down_first, self.end, 1) - i

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal words from ``i`` and ``j`` back, ``i`` itself included; ``i != j``."""
        return i - self._extend(i, j, self.up_last, self.down_last, self.begin, -1)


def _grid(x: np.ndarray, sizes: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray]:
    """Candidates ``(period, place)``, by period and place.

    A run of period p and at least 2p words has a multiple of p among its first p places,
    and its word comes again p places on.  Texts come longest first, so the texts that
    can hold a period are a prefix.  At least ``max(p, need - p)`` places in a row agree
    with the places p on, which drops almost all chance pairs.
    """
    ends = 1 + np.cumsum(sizes + 1)
    periods, places = [], []
    texts = len(sizes)
    for p in range(1, int(sizes[0]) // 2 + 1):
        while sizes[texts - 1] < 2 * p:
            texts -= 1
        stop = int(ends[texts - 1])
        hits = np.flatnonzero(x[p:stop - p:p] == x[2 * p:stop:p])
        if hits.size:
            at = (hits + 1) * p
            if max(p, need - p) > 1:
                at = at[(x[at - 1] == x[at + p - 1]) | (x[at + 1] == x[at + p + 1])]
            if at.size:
                places.append(at)
                periods.append(np.full(len(at), p))
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    p, i = np.concatenate(periods), np.concatenate(places)
    # the stretch of agreeing places around i holds at least max(p, need - p) of them
    least = np.minimum(np.maximum(p, need - p), 6)
    row = np.zeros(len(p), np.int64)
    for sign in (1, -1):
        going = np.ones(len(p), bool)
        for step in range(0 if sign == 1 else 1, 6):
            a = np.clip(i + sign * step, 0, len(x) - 1)
            b = np.clip(a + p, 0, len(x) - 1)
            going &= (x[a] == x[b]) & (a != b)
            row += going
    fine = row >= least
    return p[fine], i[fine]


def _found(grammar: Grammar, p: np.ndarray, i: np.ndarray, need: int) -> np.ndarray:
    """Maximal repetitions ``(start, length, period)`` at the candidates, each with its smallest period.

    A candidate inside a repetition that another one of its period gave is passed over,
    as is one inside a repetition whose period divides its own.
    """
    made = np.empty((0, 3), np.int64)
    covered = np.zeros((2, grammar.words), np.int64)  # end and period of the repetition that reaches furthest
    low = 1
    while low <= (p[-1] if p.size else 0):
        now = slice(*np.searchsorted(p, (low, 2 * low)))
        low *= 2
        ps, at = p[now], i[now]
        end, period = covered[0][at], covered[1][at]
        fine = ~((end > at + ps) & (ps % np.maximum(period, 1) == 0))
        ps, at = ps[fine], at[fine]
        if not ps.size:
            continue
        # candidates of one period that follow each other on the grid form a chain
        heads = np.flatnonzero(np.r_[True, (ps[1:] != ps[:-1]) | (at[1:] != at[:-1] + ps[1:])])
        tails = np.r_[heads[1:], len(ps)]
        cur, stop, new = heads, tails, []
        while cur.size:
            a, q = at[cur], ps[cur]
            ahead = grammar.forward(a, a + q)
            back = grammar.backward(a - 1, a + q - 1)
            length = ahead + back + q
            good = length >= np.maximum(2 * q, need)
            new.append(np.stack([(a - back)[good], length[good], q[good]], axis=1))
            cur = cur + np.maximum(1, -(-ahead // q))
            cur, stop = cur[cur < stop], stop[cur < stop]
        new = np.unique(np.concatenate(new), axis=0)
        made = np.concatenate([made, new])
        for start, length, q in new[np.argsort(new[:, 0] + new[:, 1], kind="stable")]:
            span = slice(start, start + length)
            later = covered[0][span] <= start + length
            covered[0][span][later] = start + length
            covered[1][span][later] = q
    made = made[np.lexsort((made[:, 2], made[:, 1], made[:, 0]))]
    keep = np.r_[True, (made[1:, 0] != made[:-1, 0]) | (made[1:, 1] != made[:-1, 1])][:len(made)]
    return made[keep]


def _layout(texts: list[np.ndarray]) -> np.ndarray:
    """Word numbers of the texts with separators that occur once."""
    size = sum(map(len, texts)) + len(texts) + 1
    x = np.empty(size, np.int64)
    x[0], at = -1, 1
    for k, words in enumerate(texts):
        x[at:at + len(words)] = words
        at += len(words) + 1
        x[at - 1] = -2 - k
    return x


def find_runs(texts: list[np.ndarray], need: int = MIN_LENGTH) -> list[np.ndarray]:
    """Runs ``(start, length, period)`` of every text of word numbers, by start, then period."""
    none = np.empty((0, 3), np.int64)
    out = [none] * len(texts)
    order = sorted((k for k, t in enumerate(texts) if len(t) >= need), key=lambda k: -len(texts[k]))
    if not order:
        return out

    def starts(chosen: list[int]) -> np.ndarray:
        return np.r_[1, 1 + np.cumsum([len(texts[k]) + 1 for k in chosen])]

    x = _layout([texts[k] for k in order])
    p, i = _grid(x, np.array([len(texts[k]) for k in order]), need)
    if not p.size:
        return out
    # the grammar holds the texts that have candidates
    old = starts(order)
    home = np.searchsorted(old, i, side="right") - 1
    used = np.unique(home)
    chosen = [order[k] for k in used]
    new = starts(chosen)
    i = i - old[home] + new[np.searchsorted(used, home)]
    found = _found(Grammar(_layout([texts[k] for k in chosen])), p, i, need)
    place = np.searchsorted(new, found[:, 0], side="right") - 1
    found[:, 0] -= new[place]
    found = found[np.lexsort((found[:, 2], found[:, 0], place))]
    cuts = np.searchsorted(np.sort(place), np.arange(len(chosen) + 1))
    for k, text in enumerate(chosen):
        out[text] = found[cuts[k]:cuts[k + 1]]
    return out


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Places of the words that stay when every run keeps its first period alone."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.flatnonzero(np.cumsum(change[:-1]) == 0)


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
RUNS = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", SPANS), ("collapsed", pa.string())])


class _Numbers(dict):
    """Words numbered as they are first seen."""

    def __missing__(self, word: bytes) -> int:
        self[word] = out = len(self)
        return out


def _finder(need: int, block_words: int):
    def judged(held: list[tuple[int | None, list[bytes], np.ndarray]]) -> pa.RecordBatch:
        found = find_runs([ids for _, _, ids in held], need)
        texts = []
        for (_, words, _), runs in zip(held, found, strict=True):
            texts.append(b" ".join([words[k] for k in kept_words(len(words), runs)] if len(runs) else words).decode())
        flat = np.concatenate(found)
        cuts = pa.array(np.r_[0, np.cumsum([len(r) for r in found])], type=pa.int32())
        spans = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(SPANS.value_type))
        columns = [pa.array([h[0] for h in held], type=pa.int64()), pa.array([len(h[1]) for h in held], type=pa.int64()),
                   pa.ListArray.from_arrays(cuts, spans), pa.array(texts, type=pa.string())]
        return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, RUNS, strict=True)], schema=RUNS)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, numbers = [], 0, _Numbers()
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                words = text.as_py().encode().split()  # splits at the six ASCII blanks
                ids = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
                held.append((doc_id.as_py(), words, ids))
                size += len(words)
                if size >= block_words:
                    yield judged(held)
                    held, size, numbers = [], 0, _Numbers()
        if held:
            yield judged(held)

    return find


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH,
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: ``doc_id, n_words, runs, collapsed``.

    ``runs`` are the maximal stretches ``(start, length, period)`` of words that repeat
    with a smallest period, at least twice and over at least ``min_length`` words, by
    start, then period; ``collapsed`` is the text with each run reduced to its first
    period, its words joined by single spaces.  A null or blank text has no words, no
    runs and an empty ``collapsed``; a null id stays null; repeated rows are judged once
    each; an empty table gives no rows.  Other columns are not read.  Nothing is
    shuffled; a task holds one block of texts, about 300 bytes a word.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    schema = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return rows.mapInArrow(_finder(min_length, block_words), schema)


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``doc_id, text``, where a tenth of the documents, by a hash of the id, repeats with a period from some word on."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all(F.col("text"), F.lit(WORD), F.lit(0))

    def repeated(w: Column, g: Column) -> Column:
        n = F.size(w).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        times = F.ceil((n - a) / p).cast("int")
        tail = F.flatten(F.array_repeat(F.slice(w, a.cast("int") + 1, p.cast("int")), times))
        return F.array_join(F.concat(F.slice(w, F.lit(1), a.cast("int")), F.slice(tail, F.lit(1), (n - a).cast("int"))), " ")

    def once(make: Column, use: Callable[[Column], Column]) -> Column:
        """``use(make)`` with the value made once."""
        return F.transform(F.array(make), use)[0]

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"), h.alias("h"))
    chosen = (F.col("h") % 10 == 0) & F.col("text").rlike(WORD)
    return rows.select("doc_id", F.when(chosen, once(words, lambda w: repeated(w, F.floor(F.col("h") / 10)))).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """Number of runs, the longest one, and prints of all runs and of the collapsed text."""
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    top = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return found.select("doc_id", "runs", "collapsed", top.alias("top"), lines.alias("lines")).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.start")).alias("start"), F.col("top.length").alias("length"),
        (-F.col("top.period")).alias("period"), F.floor(-1000 * F.col("top.length") / F.col("top.period")).cast("long").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
