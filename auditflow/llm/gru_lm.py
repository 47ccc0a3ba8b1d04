"""Documents scored by a gated recurrent language model with a class-factored softmax.

A word is predicted in two steps, its class and the word within the class.  The most
frequent words share classes of equal size, and their words are told apart by the
network; every other word is in a class by its ending, and there the share of a word
follows from its count in the training text, so any text has a probability.  Counts
cover all training documents and are joined to the documents by a shuffle; the
network's gradient steps take each of them once, in rounds over disjoint slices.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditflow.llm.common import checkpointed

ALPHA = 0.1
FOLDS = 10
HIDDEN = 24
#: Classes of frequent words and words in each; classes of the other words by their ending.
HEAD_CLASSES, HEAD_WORDS, TAIL_CLASSES = 32, 32, 64
HEAD = HEAD_CLASSES * HEAD_WORDS
#: Counts that every task holds, at most; the rest is joined by a shuffle.
HOT_WORDS = 1 << 18
_SLOTS = 20
#: Rounds of averaging; together they take every training document once.
ROUNDS = 3
LANES, WINDOW = 64, 32
_STEP = np.uint64(0x9E3779B97F4A7C15)
END = np.uint64(0x2545F4914F6CDD1D)
_PARTS = 64


class _Index(dict):
    """Numbers of the distinct words of a batch, in order of appearance; 0 is the end mark."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self) + 1
        return n


class Tokens:
    """The tokens of a batch of texts as numbers of distinct words, and what is known of those."""

    def __init__(self, texts: list[str | None]):
        from xxhash import xxh64_intdigest

        index = _Index()
        parts, lengths = [], np.empty(len(texts), dtype=np.int64)
        for i, text in enumerate(texts):
            words = (text or "").encode().lower().split()
            row = np.zeros(len(words) + 1, dtype=np.int32)
            row[:-1] = np.fromiter(map(index.__getitem__, words), dtype=np.int32, count=len(words))
            parts.append(row)
            lengths[i] = len(row)
        self.tokens = np.concatenate(parts) if parts else np.empty(0, dtype=np.int32)
        self.lengths = lengths
        self.starts = np.cumsum(lengths) - lengths
        self.keys = np.empty(len(index) + 1, dtype=np.uint64)
        self.keys[0] = END
        self.keys[1:] = np.fromiter((xxh64_intdigest(w, 11) for w in index), dtype=np.uint64, count=len(index))
        self.tails = np.zeros(len(index) + 1, dtype=np.int64)
        self.tails[1:] = np.fromiter((xxh64_intdigest(w[-3:], 5) & (TAIL_CLASSES - 1) for w in index), dtype=np.int64, count=len(index))


def held_out(doc_id: Column, folds: int = FOLDS) -> Column:
    """Whether the CRC-32 of the id as text leaves no remainder; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 0


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        t = Tokens(batch.column("text").to_pylist())
        n = np.bincount(t.tokens, minlength=len(t.keys))
        seen = n > 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(t.keys[seen].view(np.int64)), pa.array(t.tails[seen].astype(np.int32)), pa.array(n[seen])], ["key", "tail", "n"])


def word_counts(training: DataFrame) -> DataFrame:
    """``key, tail, n`` of every distinct token of a column ``text``, counted in each batch before the shuffle."""
    counted = training.select("text").mapInArrow(_count, "key long, tail int, n long")
    return counted.groupBy("key").agg(F.min("tail").alias("tail"), F.sum("n").alias("n"))


class Lexicon:
    """Totals of the training text, its frequent words in a direct-mapped table, and the classes."""

    def __init__(self, counts: DataFrame, hot: int = HOT_WORDS):
        # Steps of a 64th of an octave find the least count of a hot word without sorting the words.
        grade = F.floor(F.log2("n") * 64).cast("int")
        grades = counts.groupBy(grade.alias("grade")).agg(F.count("*").alias("words")).toPandas().sort_values("grade", ascending=False)
        fits = grades[grades["words"].cumsum() <= hot]
        floor = int(fits["grade"].min()) if len(fits) else 1 << 30
        top = counts.where(grade >= floor).select("key", "n").toPandas().sort_values(["n", "key"], ascending=[False, True])
        keys, n = top["key"].to_numpy().view(np.uint64), top["n"].to_numpy()
        frequent = np.concatenate(([END], keys[keys != END]))[:HEAD]
        self.keys = np.zeros(1 << _SLOTS, dtype=np.uint64)
        self.n = np.zeros(1 << _SLOTS, dtype=np.int64)
        slots = self.slot(keys)[::-1]
        self.keys[slots], self.n[slots] = keys[::-1], n[::-1]
        # The frequent words are held exactly, in order of key.
        self.order = np.argsort(frequent)
        self.frequent = frequent[self.order]
        is_head = F.col("key").isin([int(k) for k in self.frequent.view(np.int64)])
        by_tail = counts.groupBy(F.when(is_head, F.lit(-1)).otherwise(F.col("tail")).alias("tail")).agg(
            F.sum("n").alias("n"), F.count("*").alias("v")).toPandas()
        self.total, self.distinct = int(by_tail["n"].sum()), int(by_tail["v"].sum())
        self.tail_n, self.tail_v = np.zeros(TAIL_CLASSES), np.zeros(TAIL_CLASSES)
        rest = by_tail[by_tail["tail"] >= 0]
        self.tail_n[rest["tail"]], self.tail_v[rest["tail"]] = rest["n"], rest["v"]
        counted = dict(zip(keys.tolist(), n.tolist(), strict=True))
        self.head_n = np.array([counted.get(int(k), 0) for k in frequent] + [0] * (HEAD - len(frequent)), dtype=float)

    @staticmethod
    def slot(keys: np.ndarray) -> np.ndarray:
        return (keys * _STEP >> np.uint64(64 - _SLOTS)).astype(np.int64)

    def head(self, keys: np.ndarray) -> np.ndarray:
        """Rank of frequent words, -1 for others."""
        at = np.minimum(np.searchsorted(self.frequent, keys), len(self.frequent) - 1)
        return np.where(self.frequent[at] == keys, self.order[at], -1)

    def inputs(self, t: Tokens) -> np.ndarray:
        """Number of each distinct word for the network: its rank, or after all ranks its class by ending."""
        rank = self.head(t.keys)
        return np.where(rank >= 0, rank, HEAD + t.tails)

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts of the words at hand, else 0."""
        slots = self.slot(keys)
        return np.where(self.keys[slots] == keys, self.n[slots], 0)


SHAPES = {"W": (HEAD + TAIL_CLASSES, 3 * HIDDEN), "U": (HIDDEN, 3 * HIDDEN), "C": (HIDDEN, HEAD_CLASSES + TAIL_CLASSES), "c": (HEAD_CLASSES + TAIL_CLASSES,),
          "D": (HEAD_CLASSES, HIDDEN, HEAD_WORDS), "d": (HEAD_CLASSES, HEAD_WORDS)}
SIZE = sum(int(np.prod(s)) for s in SHAPES.values())


def views(flat: np.ndarray) -> dict[str, np.ndarray]:
    """The parameters as parts of one array."""
    out, at = {}, 0
    for name, shape in SHAPES.items():
        size = int(np.prod(shape))
        out[name] = flat[at:at + size].reshape(shape)
        at += size
    return out


def first_parameters(lexicon: Lexicon) -> np.ndarray:
    """Small random weights, and biases that give every word its frequency in the training text."""
    flat = np.random.default_rng(1).normal(0, 0.1, SIZE).astype(np.float32)
    p = views(flat)
    words = lexicon.head_n.reshape(HEAD_CLASSES, HEAD_WORDS) + ALPHA
    classes = np.concatenate((words.sum(1), lexicon.tail_n + ALPHA))
    p["c"][:] = np.log(classes / classes.sum())
    p["d"][:] = np.log(words / words.sum(1, keepdims=True))
    return flat


def _step(p: dict, gx: np.ndarray, h: np.ndarray):
    a = h @ p["U"]
    zr = 0.5 * np.tanh(0.5 * (gx[:, :2 * HIDDEN] + a[:, :2 * HIDDEN])) + 0.5
    z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
    n = np.tanh(gx[:, 2 * HIDDEN:] + r * a[:, 2 * HIDDEN:])
    return n + z * (h - n), (z, r, n, a[:, 2 * HIDDEN:])


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def _outputs(p: dict, hs: np.ndarray, target: np.ndarray, grad: dict):
    """Log probability of each target, natural, and the gradient of the mean loss by the state."""
    cls = np.where(target < HEAD, target // HEAD_WORDS, target - HEAD + HEAD_CLASSES)
    logp = _log_softmax(hs @ p["C"] + p["c"])
    rows = np.arange(len(cls))
    out = logp[rows, cls]
    delta = np.exp(logp)
    delta[rows, cls] -= 1
    delta /= len(cls)
    grad["C"] += hs.T @ delta
    grad["c"] += delta.sum(0)
    dh = delta @ p["C"].T
    order = np.argsort(cls, kind="stable")
    edges = np.searchsorted(cls[order], np.arange(HEAD_CLASSES + 1))
    for k in range(HEAD_CLASSES):
        own = order[edges[k]:edges[k + 1]]
        if len(own):
            within = _log_softmax(hs[own] @ p["D"][k] + p["d"][k])
            word = target[own] % HEAD_WORDS
            out[own] += within[np.arange(len(own)), word]
            delta = np.exp(within)
            delta[np.arange(len(own)), word] -= 1
            delta /= len(cls)
            grad["D"][k] += hs[own].T @ delta
            grad["d"][k] += delta.sum(0)
            dh[own] += delta @ p["D"][k].T
    return out, dh


def _log_total(x: np.ndarray) -> np.ndarray:
    """Logarithm of the sum of exponentials of each row; ``x`` is used up."""
    top = np.float32(0) if abs(x).max(initial=0) < 80 else x.max(axis=1, keepdims=True)
    x -= top
    np.exp(x, out=x)
    return np.log(x @ np.ones(x.shape[1], dtype=x.dtype)) + np.ravel(top)


def _log_probs(p: dict, hs: np.ndarray, target: np.ndarray) -> np.ndarray:
    """As ``_outputs`` without a gradient."""
    cls = np.where(target < HEAD, target // HEAD_WORDS, target - HEAD + HEAD_CLASSES)
    logits = hs @ p["C"]
    logits += p["c"]
    out = logits[np.arange(len(cls)), cls]
    out -= _log_total(logits)
    order = np.argsort(cls.astype(np.uint8), kind="stable")
    edges = np.searchsorted(cls[order], np.arange(HEAD_CLASSES + 1))
    for k in range(HEAD_CLASSES):
        own = order[edges[k]:edges[k + 1]]
        if len(own):
            within = hs[own] @ p["D"][k]
            within += p["d"][k]
            chosen = within[np.arange(len(own)), target[own] % HEAD_WORDS]
            out[own] += chosen - _log_total(within)
    return out


def _halved(p: dict) -> dict:
    """Parameters for ``_next``: gates by half arguments, so that a logistic function is a hyperbolic tangent."""
    w, u = p["W"].copy(), p["U"] * np.float32(0.5)
    w[:, :2 * HIDDEN] *= np.float32(0.5)
    return p | {"W": w, "U": u}


def _next(u: np.ndarray, gx: np.ndarray, h: np.ndarray) -> np.ndarray:
    """One step as ``_step``, on halved parameters and without what only the gradient needs."""
    a = h @ u
    gates = a[:, :2 * HIDDEN]
    gates += gx[:, :2 * HIDDEN]
    np.tanh(gates, out=gates)
    n = gates[:, HIDDEN:] + np.float32(1)
    n *= a[:, 2 * HIDDEN:]
    n += gx[:, 2 * HIDDEN:]
    np.tanh(n, out=n)
    apart = h - n
    apart *= gates[:, :HIDDEN] + np.float32(1)
    apart *= np.float32(0.5)
    apart += n
    return apart


def _train_window(p: dict, grad: dict, x: np.ndarray, target: np.ndarray, keep: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Back-propagation through one window; the state comes in and goes on, its gradient does not."""
    steps, lanes = x.shape
    gx = p["W"][x]
    hs, before, saved = np.empty((steps, lanes, HIDDEN), dtype=np.float32), [], []
    for t in range(steps):
        h = h * keep[t][:, None]
        before.append(h)
        h, kept = _step(p, gx[t], h)
        saved.append(kept)
        hs[t] = h
    logp, dh_out = _outputs(p, hs.reshape(-1, HIDDEN), target.reshape(-1), grad)
    dh_out = dh_out.reshape(steps, lanes, HIDDEN)
    dgx = np.empty_like(gx)
    dh = np.zeros((lanes, HIDDEN), dtype=np.float32)
    for t in range(steps - 1, -1, -1):
        z, r, n, m = saved[t]
        dh = dh + dh_out[t]
        dn = dh * (1 - z) * (1 - n * n)
        dz = dh * (before[t] - n) * z * (1 - z)
        dr = dn * m * r * (1 - r)
        dgx[t] = np.concatenate((dz, dr, dn), axis=1)
        da = np.concatenate((dz, dr, dn * r), axis=1)
        grad["U"] += before[t].T @ da
        dh = (dh * z + da @ p["U"].T) * keep[t][:, None]
    flat, g = x.reshape(-1), dgx.reshape(-1, 3 * HIDDEN)
    order = np.argsort(flat, kind="stable")
    cuts = np.flatnonzero(np.concatenate(([True], np.diff(flat[order]) > 0)))
    grad["W"][flat[order][cuts]] += np.add.reduceat(g[order], cuts, axis=0)
    return float(logp.sum()), h


def fit(flat: np.ndarray, words: np.ndarray, starts: np.ndarray, rate: float, lanes: int = LANES, window: int = WINDOW) -> tuple[np.ndarray, int]:
    """Adam over the documents laid out in parallel lanes; returns the parameters and the words taken.

    ``words`` are network inputs of whole documents one after the other, ``starts`` marks
    their first words.  Lanes are cut anywhere; the state of a lane starts empty.
    """
    length = len(words) // lanes
    if length < 2:
        lanes, length = 1, len(words)
    if not length:
        return flat, 0
    flat = flat.copy()
    use = words[:lanes * length].reshape(lanes, length).T
    first = starts[:lanes * length].reshape(lanes, length).T
    ended = np.vstack((np.zeros((1, lanes), dtype=use.dtype), use[:-1]))  # the word before; the end mark has number 0
    p, gradient = views(flat), np.zeros_like(flat)
    grad, m, v = views(gradient), np.zeros_like(flat), np.zeros_like(flat)
    h = np.zeros((lanes, HIDDEN), dtype=np.float32)
    steps = 0
    for at in range(0, length, window):
        gradient[:] = 0
        keep = (~first[at:at + window]).astype(np.float32)
        x = np.where(first[at:at + window], 0, ended[at:at + window])
        _, h = _train_window(p, grad, x, use[at:at + window], keep, h)
        norm = np.sqrt(float((gradient**2).sum()))
        if norm > 1:
            gradient /= norm
        steps += 1
        m += 0.1 * (gradient - m)
        v += 0.01 * (gradient**2 - v)
        flat -= rate * (m / (1 - 0.9**steps)) / (np.sqrt(v / (1 - 0.99**steps)) + 1e-6)
    return flat, lanes * length


def document_scores(flat: np.ndarray, words: np.ndarray, lengths: np.ndarray, window: int = 64) -> np.ndarray:
    """Natural log probability of each document's classes and frequent words.

    Documents are dealt to lanes, longest first; the state is carried from window to
    window and emptied at the start of a document.
    """
    if not len(lengths):
        return np.zeros(0)
    p = _halved(views(flat))
    lanes = int(np.clip(lengths.sum() // max(int(lengths.max()), 1024), 8, 512))
    heap = [(0, k) for k in range(lanes)]
    lane, offset = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    for i in np.argsort(-lengths, kind="stable"):
        filled, k = heapq.heappop(heap)
        lane[i], offset[i] = k, filled
        heapq.heappush(heap, (filled + int(lengths[i]), k))
    height = max(filled for filled, _ in heap)
    target = np.zeros((lanes, height), dtype=np.int32)
    first = np.zeros((lanes, height), dtype=bool)
    begin = np.cumsum(lengths) - lengths
    place = np.repeat(lane * height + offset - begin, lengths) + np.arange(int(lengths.sum()))
    target.reshape(-1)[place] = words
    first[lane, offset] = True
    target, first = np.ascontiguousarray(target.T), np.ascontiguousarray(first.T)
    logp = np.empty((height, lanes), dtype=np.float32)
    h = np.zeros((lanes, HIDDEN), dtype=np.float32)
    last = np.zeros((1, lanes), dtype=np.int32)
    for at in range(0, height, window):
        now, begins = target[at:at + window], first[at:at + window]
        before = np.where(begins, 0, np.vstack((last, now[:-1])))
        gx, keep = p["W"][before], (~begins).astype(np.float32)[:, :, None]
        hs = np.empty((len(now), lanes, HIDDEN), dtype=np.float32)
        for t in range(len(now)):
            h = _next(p["U"], gx[t], h * keep[t])
            hs[t] = h
        logp[at:at + window] = _log_probs(p, hs.reshape(-1, HIDDEN), now.reshape(-1)).reshape(now.shape)
        last = now[-1:]
    ordered = np.ascontiguousarray(logp.T).reshape(-1)[place].astype(float)
    return np.add.reduceat(ordered, begin)


def _replica(model, rate: float):
    """One replica per task: it takes its documents batch by batch and gives its parameters in parts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        lexicon, flat = model.value
        taken, rest, rest_starts = 0, np.empty(0, dtype=np.int64), np.empty(0, dtype=bool)
        for batch in batches:
            t = Tokens(batch.column("text").to_pylist())
            starts = np.zeros(len(t.tokens), dtype=bool)
            starts[t.starts] = True
            inputs, starts = np.concatenate((rest, lexicon.inputs(t)[t.tokens])), np.concatenate((rest_starts, starts))
            flat, words = fit(flat, inputs, starts, rate)
            rest, rest_starts = inputs[words:], starts[words:]  # what does not fill the lanes goes on to the next batch
            taken += words
        flat, words = fit(flat, rest, rest_starts, rate)
        taken += words
        if taken:
            cuts = np.linspace(0, SIZE, _PARTS + 1).astype(int)
            parts = [(flat[a:b].astype(float) * taken).tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([
                pa.array(range(_PARTS), type=pa.int32()), pa.array([TaskContext.get().partitionId()] * _PARTS, type=pa.int32()),
                pa.array([taken] * _PARTS, type=pa.int64()), pa.array(parts, type=pa.binary())], ["part", "replica", "words", "sums"])

    return run


def _sum_parts(rows: pd.DataFrame) -> pd.DataFrame:
    total = np.sum([np.frombuffer(v) for v in rows["sums"]], axis=0)
    return pd.DataFrame({"part": [rows["part"].iloc[0]], "words": [rows["words"].sum()], "sums": [total.tobytes()]})


def slice_of(doc_id: Column, rounds: int) -> Column:
    """The round that takes a document, by a hash of its id; slices are disjoint and cover all."""
    return F.pmod(F.xxhash64(doc_id), F.lit(rounds))


def train(training: DataFrame, lexicon: Lexicon, rounds: int = ROUNDS) -> np.ndarray:
    """Rounds of gradient steps on replicas, one per task, whose parameters are averaged by words.

    A round takes the documents of its own slice of a hash, so every training document
    is taken once.  Averages are added up in two levels; the driver gets one set of
    parameters.
    """
    spark = training.sparkSession
    flat = first_parameters(lexicon)
    for turn in range(rounds):
        chosen = training.where(slice_of(F.col("doc_id"), rounds) == turn).select("text")
        model = spark.sparkContext.broadcast((lexicon, flat))
        parts = chosen.mapInArrow(_replica(model, 0.01 / (1 + turn)), "part int, replica int, words long, sums binary")
        some = parts.groupBy("part", F.pmod("replica", F.lit(64)).alias("some")).applyInPandas(_sum_parts, "part int, words long, sums binary")
        whole = some.groupBy("part").applyInPandas(_sum_parts, "part int, words long, sums binary").toPandas().sort_values("part")
        if len(whole):
            flat = np.concatenate([np.frombuffer(v) for v in whole["sums"]]).astype(np.float32) / np.float32(whole["words"].iloc[0])
    return flat


def _score(model):
    """One row per document and one per document and word whose count is not at hand."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, flat = model.value
        for batch in batches:
            if not batch.num_rows:
                continue
            t = Tokens(batch.column("text").to_pylist())
            uids = batch.column("uid").to_numpy()
            inputs, n = lexicon.inputs(t), lexicon.counts(t.keys)
            base = np.log10((n + ALPHA) / (lexicon.total + ALPHA * (lexicon.distinct + 1)))
            tail = inputs >= HEAD
            share = np.zeros(len(n))
            share[tail] = np.log10((n[tail] + ALPHA) / (lexicon.tail_n[t.tails[tail]] + ALPHA * (lexicon.tail_v[t.tails[tail]] + 1)))
            cold = n == 0

            def per_document(values, t=t):
                return np.add.reduceat(values[t.tokens], t.starts)

            network = document_scores(flat, inputs[t.tokens], t.lengths) / np.log(10)
            owner = np.repeat(np.arange(len(uids)), t.lengths)[cold[t.tokens]]
            pairs, times = np.unique(owner * len(t.keys) + t.tokens[cold[t.tokens]], return_counts=True)
            nulls = len(pairs)
            own = np.arange(len(uids) + nulls) < len(uids)

            def once(values, kind, own=own, nulls=nulls):
                return pa.array(np.concatenate((values, np.zeros(nulls, dtype=values.dtype))), type=kind, mask=~own)

            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate((uids, uids[pairs // len(t.keys)]))),
                # A document's own row is spread by its number; it asks for no count.
                pa.array(np.concatenate((uids.view(np.uint64) * _STEP, t.keys[pairs % len(t.keys)])).view(np.int64)),
                pa.array(np.concatenate((np.zeros(len(uids), dtype=np.int64), times)).astype(np.int32)),
                pa.concat_arrays([batch.column("doc_id"), pa.nulls(nulls, pa.int64())]),
                once(t.lengths, pa.int64()), once(per_document((~cold).astype(np.int64)), pa.int64()),
                once(per_document(base), pa.float64()), once(network + per_document(share), pa.float64()),
            ], ["uid", "key", "times", "doc_id", "n_tokens", "known", "base", "network"])

    return run


def score_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", hot: int = HOT_WORDS, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Whole texts are scored with A-Z lower-cased; a null text is empty and has the end
    mark alone.  A null id counts as the id of empty text.  Repeated rows get equal
    rows; without training documents every word is unknown; an empty table gives no
    rows.  Other columns of the input are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    training = rows.where(~held_out(F.col("doc_id")))
    counts = checkpointed(word_counts(training))
    lexicon = Lexicon(counts, hot)
    flat = train(training, lexicon, rounds)
    model = spark.sparkContext.broadcast((lexicon, flat))
    asked = rows.withColumn("uid", F.monotonically_increasing_id()).mapInArrow(
        _score(model), "uid long, key long, times int, doc_id long, n_tokens long, known long, base double, network double")
    found = asked.join(counts.select("key", "n"), "key", "left")
    hit = (F.col("times") > 0) & F.col("n").isNotNull()
    gain = F.when(hit, F.col("times") * (F.log10(F.col("n") + ALPHA) - F.log10(F.lit(ALPHA)))).otherwise(0.0)
    known = F.when(hit, F.col("times").cast("long")).otherwise(F.coalesce("known", F.lit(0)))
    summed = found.groupBy("uid").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_tokens").alias("n_tokens"), F.sum(known).alias("n_known"),
        F.sum(F.coalesce("base", F.lit(0.0)) + gain).alias("base_score"), F.sum(F.coalesce("network", F.lit(0.0)) + gain).alias("score"))
    return summed.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known",
                         F.lit(lexicon.total).cast("long").alias("train_tokens"), "base_score", "score")
