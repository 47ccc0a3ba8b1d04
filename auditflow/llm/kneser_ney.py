"""Interpolated modified Kneser-Ney model over words, and documents judged by their perplexity.

Probabilities are kept as additive weights.  For a seen n-gram the weight is the
logarithm of its interpolated probability over the one that backing off would give,
plus the logarithm of its own back-off mass if it is a context.  The log probability
of a document is then the sum, over all its n-grams of all orders, of the weights that
exist, so scoring is a join of n-gram counts with a sharded weight table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from auditflow.llm.common import Shelf, checkpointed, row_key

ORDER = 3
#: Trusted documents that the counts are taken from, at most; the bound of the model.
MAX_TRAIN_DOCS = 3000
#: Two-word and longer n-grams must occur this often to be kept where ``train`` is not told otherwise.
MIN_COUNT = 2
#: The quality scores keep n-grams that occur once.
KEEP_FROM = 1
#: Share of trusted documents outside of training that must lie below the threshold of their language.
QUANTILE = 0.999
#: Every document is scored as if this many words of typical perplexity were added, which steadies short ones.
PRIOR_WORDS = 20
#: Weights that every task holds, at most; the rest is joined by a shuffle.
HOT = 1 << 17
#: One in so many trusted documents, by a hash of the id, is held out of training at every size.
HOLD_OUT = 5
_SLOTS = 19
#: 64-bit words of the membership filter, and how many bits of its word a key sets: about twelve bits a key at the bound of training.
_WORD_BITS = 19
BITMAP = 1 << _WORD_BITS
_BITS = 4
#: Thresholds are found on a grid of so many decimal digits of log10 perplexity, which bounds what is sorted.
GRID = 3

_STEP = np.uint64(0x9E3779B97F4A7C15)
_START = np.uint64(0x5851F42D4C957F2D)
_END = np.uint64(0x14057B7EF767814F)


class _Words(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        if len(self) > 500_000:
            self.clear()
        value = self[word] = xxh64_intdigest(word, 7)
        return value


def _mix(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    out = (left * _STEP) ^ (right + (left >> np.uint64(31)))
    out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def gram_keys(text: str | None, words: _Words) -> list[np.ndarray]:
    """64-bit keys of the n-grams of a text, by order; entry ``i`` of order ``n`` ends at token ``i + n - 1``.

    The text is its words between a start and an end mark.
    """
    found = (text or "").encode().split()
    first = np.empty(len(found) + 2, dtype=np.uint64)
    first[0], first[-1] = _START, _END
    if found:
        first[1:-1] = np.fromiter(map(words.__getitem__, found), dtype=np.uint64, count=len(found))
    keys = [first]
    for n in range(1, ORDER):
        keys.append(_mix(keys[-1][:-1], first[n:] + np.uint64(n)))
    return keys


def _grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    words = _Words()
    for rows in batches:
        for text in rows["text"]:
            keys = gram_keys(text, words)
            for n in range(1, ORDER):
                if len(keys[n]):
                    starts = np.zeros(len(keys[n]), dtype=bool)
                    starts[0] = True
                    yield pd.DataFrame({
                        "n": n + 1, "key": keys[n].view(np.int64), "ctx": keys[n - 1][:-1].view(np.int64),
                        "low": keys[n - 1][1:].view(np.int64), "starts": starts})


def count_grams(texts: DataFrame) -> DataFrame:
    """``n, key, ctx, low, starts, count`` of the two- and three-word n-grams of a column ``text``."""
    rows = texts.select("text").mapInPandas(_grams, "n int, key long, ctx long, low long, starts boolean")
    return rows.groupBy("n", "key", "ctx", "low", "starts").agg(F.count("*").alias("count"))


def _discounts(grams: DataFrame) -> list[float]:
    """The three discounts of one order, from how many n-grams occur once to four times."""
    ones = grams.agg(*[F.sum((F.col("a") == i).cast("long")).alias(f"n{i}") for i in range(1, 5)]).first()
    n = [float(x or 0) for x in ones]
    if min(n) == 0:
        return [0.5, 1.0, 1.5]  # too little text for an estimate
    y = n[0] / (n[0] + 2 * n[1])
    return [min(max(i + 1 - (i + 2) * y * n[i + 1] / n[i], 0.05), i + 0.95) for i in range(3)]


def _discounted(d: list[float]):
    a = F.col("a")
    return a - F.when(a == 1, d[0]).when(a == 2, d[1]).otherwise(d[2])


def train(grams: DataFrame, min_count: int = MIN_COUNT, shelf: Shelf | None = None) -> tuple[DataFrame, float]:
    """Weights ``key, weight, freq`` and the log10 probability of an unknown word.

    Highest-order counts are plain, lower ones count distinct words before; n-grams at
    the start of a text keep plain counts.  What discounting and rare n-grams leave of
    a context goes to its back-off mass, so every distribution sums to one.  Totals and
    back-off masses of a level come from one shuffle by context.
    """
    shelf = shelf or Shelf(grams.sparkSession)
    tri = grams.where("n = 3").select("key", "ctx", "low", "count", F.col("count").alias("a"))
    left = tri.groupBy("low").agg(F.count("*").alias("before")).select(F.col("low").alias("key"), "before")
    two = grams.where("n = 2").join(left, "key", "left")
    two = shelf.put("two", two.select("key", "ctx", "low", "count", F.when(F.col("starts"), F.col("count")).otherwise(F.coalesce("before", "count")).alias("a")))
    one = shelf.put("one", two.groupBy(F.col("low").alias("key")).agg(F.count("*").alias("a"), F.sum("count").alias("count")))

    d1, d2, d3 = _discounts(one), _discounts(two), _discounts(tri)
    total = one.agg(F.sum("a").alias("a"), F.sum(_discounted(d1)).alias("kept"), F.count("*").alias("v")).first()
    if not total["a"]:
        return one.select("key", F.lit(0.0).alias("weight"), F.lit(0).cast("long").alias("freq")), 0.0
    rest = 1 - total["kept"] / total["a"]
    unknown = rest / (total["v"] + 1)
    one = one.select("key", "count", (_discounted(d1) / total["a"] + unknown).alias("p"))

    def level(rows: DataFrame, d: list[float], lower: DataFrame) -> DataFrame:
        """Probability and gain of each n-gram and the back-off mass of its context, named by one row of the context."""
        context = Window.partitionBy("ctx")
        seen = F.col("count") >= min_count
        kept = F.sum(F.when(seen, _discounted(d)).otherwise(0.0)).over(context)
        massed = rows.select("*", F.sum("a").over(context).alias("all"), kept.alias("kept"), (F.col("key") == F.min("key").over(context)).alias("names_it"))
        massed = massed.withColumn("rest", 1 - F.col("kept") / F.col("all"))
        backed = F.col("rest") * F.col("p_low")
        p = F.when(seen, _discounted(d) / F.col("all")).otherwise(0.0) + backed
        return massed.join(lower.select(F.col("key").alias("low"), F.col("p").alias("p_low")), "low").select(
            "key", "ctx", "count", "names_it", "rest", p.alias("p"), F.when(seen, F.log10(p) - F.log10(backed)).alias("gain"))

    none = F.lit(0).cast("long")

    def weighed(rows: DataFrame) -> DataFrame:
        own = F.when(F.col("gain").isNotNull(), F.struct("key", F.col("gain").alias("weight"), F.col("count").alias("freq")))
        above = F.when(F.col("names_it") & (F.col("rest") < 1), F.struct(F.col("ctx").alias("key"), F.log10("rest").alias("weight"), none.alias("freq")))
        return rows.select(F.explode(F.array_compact(F.array(own, above))).alias("w")).select("w.*")

    two = shelf.put("level2", level(two, d2, one))
    shelf.drop("two")
    single = one.select("key", (F.log10("p") - float(np.log10(unknown))).alias("weight"), F.col("count").alias("freq"))
    every = single.union(weighed(two)).union(weighed(level(tri, d3, two)))
    weights = shelf.put("weights", every.groupBy("key").agg(F.sum("weight").alias("weight"), F.max("freq").alias("freq")))
    del two, tri, left, every
    shelf.drop("one", "level2")
    return weights, float(np.log10(unknown))


class HotWeights:
    """The most frequent weights in a direct-mapped table, and a blocked Bloom filter that knows all keys.

    Of keys that share a slot the more frequent one stays; the others are found by the
    join, as are all that did not fit.  The filter has no false negatives, so n-grams it
    does not know need no join.
    """

    def __init__(self, weights: DataFrame, hot: int = HOT):
        # all keys down to a frequency, and of the next one as many as still have room, by a hash
        freq = F.least("freq", F.lit(1000).cast("long"))
        steps = weights.groupBy(freq.alias("freq")).agg(F.count("*").alias("n")).orderBy(F.desc("freq")).collect()
        least, cut, share, room = 1001, -1, 0.0, hot
        for step in steps:
            if step["n"] > room:
                cut, share = step["freq"], room / step["n"]
                break
            least, room = step["freq"], room - step["n"]
        drawn = F.shiftrightunsigned(F.xxhash64("key"), 32) < int(share * 2**32)
        top = weights.where((freq >= least) | ((freq == cut) & drawn))
        top = top.select("freq", "key", "weight").toPandas().sort_values(["freq", "key"], ascending=[False, True])
        keys = top["key"].to_numpy().view(np.uint64)
        self.keys = np.zeros(1 << _SLOTS, dtype=np.uint64)
        self.weights = np.zeros(1 << _SLOTS)
        slots = self._slot(keys)[::-1]
        self.keys[slots] = keys[::-1]
        self.weights[slots] = top["weight"].to_numpy()[::-1]
        word = F.shiftrightunsigned("key", 64 - _WORD_BITS).cast("int")
        bit = F.expr(" | ".join(f"shiftleft(1L, cast(shiftright(key, {6 * i}) & 63 AS int))" for i in range(_BITS)))
        bits = weights.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits")).toPandas()
        self.bitmap = np.zeros(BITMAP, dtype=np.uint64)
        if len(bits):
            self.bitmap[bits["word"]] = bits["bits"].to_numpy().view(np.uint64)

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (keys * _STEP >> np.uint64(64 - _SLOTS)).astype(np.int64)

    def look_up(self, keys: np.ndarray) -> tuple[float, np.ndarray]:
        """The sum of the weights at hand and the keys that may have one elsewhere."""
        mask = np.uint64(1) << (keys & np.uint64(63))
        for i in range(1, _BITS):
            mask |= np.uint64(1) << (keys >> np.uint64(6 * i) & np.uint64(63))
        keys = keys[self.bitmap[(keys >> np.uint64(64 - _WORD_BITS)).astype(np.int64)] & mask == mask]
        slots = self._slot(keys)
        here = self.keys[slots] == keys
        return float(self.weights[slots[here]].sum()), keys[~here]


def _score(model):
    """One row per document and one per document and n-gram that needs the join."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, words = model.value, _Words()
        for batch in batches:
            uids, texts = batch.column("uid").to_numpy(), batch.column("text").to_pylist()
            sums, lengths, cold, owner = np.zeros(len(uids)), np.zeros(len(uids), dtype=np.int64), [], []
            for i, text in enumerate(texts):
                keys = gram_keys(text, words)
                lengths[i] = len(keys[0]) - 1
                sums[i], rest = hot.look_up(np.concatenate(keys))
                if len(rest):
                    rest, times = np.unique(rest, return_counts=True)
                    cold.append((rest, times))
                    owner.append(np.full(len(rest), i))
            owner = np.concatenate([np.arange(len(uids)), *owner]).astype(np.int64)
            # A document's own row is spread by its number; it asks for no weight.
            keys = np.concatenate([uids.view(np.uint64) * _STEP, *[k for k, _ in cold]]).view(np.int64)
            times = np.concatenate([np.zeros(len(uids), dtype=np.int64), *[t for _, t in cold]]).astype(np.int32)
            own = np.arange(len(keys)) < len(uids)
            null = ~own

            def once(values, kind, own=own, null=null):
                padded = np.zeros(len(own), dtype=values.dtype)
                padded[:len(values)] = values
                return pa.array(padded, type=kind, mask=null)

            nulls = len(keys) - len(uids)
            yield pa.RecordBatch.from_arrays([
                pa.array(uids[owner]), pa.array(keys), pa.array(times), once(lengths, pa.int64()), once(sums, pa.float64()),
                pa.concat_arrays([batch.column("doc_id"), pa.nulls(nulls, pa.int64())]),
                pa.concat_arrays([batch.column("row_key"), pa.nulls(nulls, pa.int64())]),
                pa.concat_arrays([batch.column("lang").cast(pa.string()), pa.nulls(nulls, pa.string())]),
            ], ["uid", "key", "times", "n_tokens", "at_hand", "doc_id", "row_key", "lang"])

    return score


SCORED = "uid long, key long, times int, n_tokens long, at_hand double, doc_id long, row_key long, lang string"


def score(docs: DataFrame, weights: DataFrame, unknown: float, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
          hot: int = HOT, model: Broadcast | None = None) -> DataFrame:
    """``doc_id, row_key, lang, n_tokens, log10_prob`` of every document; the end mark counts as a token."""
    model = model or docs.sparkSession.sparkContext.broadcast(HotWeights(weights, hot))
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(doc_id).cast("long").alias("doc_id"),
                       row_key(doc_id, text).alias("row_key"), F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    asked = rows.mapInArrow(_score(model), SCORED)
    found = asked.join(weights.select("key", "weight"), "key", "left")
    return found.groupBy("uid").agg(
        F.max("doc_id").alias("doc_id"), F.max("row_key").alias("row_key"), F.max("lang").alias("lang"), F.max("n_tokens").alias("n_tokens"),
        F.sum(F.coalesce("at_hand", F.lit(0.0)) + F.when(F.col("times") > 0, F.coalesce(F.col("weight") * F.col("times"), F.lit(0.0))).otherwise(0.0))
        .alias("sum"),
    ).select("doc_id", "row_key", "lang", "n_tokens", (F.col("sum") + F.col("n_tokens") * unknown).alias("log10_prob"))


def thresholds(trusted: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """``lang, threshold``: the quantile of ``level`` per language, exact on a grid; a row with ``every`` over all."""
    steps = trusted.select("lang", F.ceil(F.col("level") * 10**GRID).alias("step")).groupBy("lang", "step").agg(F.count("*").alias("rows"))
    whole = steps.groupBy("step").agg(F.sum("rows").alias("rows")).select(F.lit(None).cast("string").alias("lang"), "step", "rows", F.lit(True).alias("every"))
    both = steps.withColumn("every", F.lit(False)).select("lang", "step", "rows", "every").union(whole)
    group = Window.partitionBy("every", "lang")
    upto = F.sum("rows").over(group.orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    marked = both.withColumns({"upto": upto, "all": F.sum("rows").over(group)})
    return marked.where(F.col("upto") >= quantile * F.col("all")).groupBy("every", "lang").agg((F.min("step") / 10**GRID).alias("threshold"))


def draw_per_language(trusted: DataFrame, most: int) -> DataFrame:
    """``t_id`` of at most ``most`` rows ``t_id, lang``, in equal shares of the languages; what a small language leaves goes to the others.

    A first cut by the hash leaves little more than the share of each language to be ranked.
    """
    sizes = checkpointed(trusted.groupBy("lang").agg(F.count("*").alias("n")))
    left, share, languages = most, 0, sizes.groupBy("n").agg(F.count("*").alias("languages")).orderBy("n").collect()
    open_languages = sum(r["languages"] for r in languages)
    for r in languages:
        share = left // open_languages
        if r["n"] > share:
            break
        share, left, open_languages = r["n"], left - r["n"] * r["languages"], open_languages - r["languages"]
    cut = F.lit(float(share + 8 * share**0.5 + 16)) / F.col("n")
    unit = F.pmod(F.xxhash64("t_id"), F.lit(1 << 40)) / float(1 << 40)
    sized = trusted.join(sizes.select(F.col("lang").alias("s_lang"), "n"), F.col("lang").eqNullSafe(F.col("s_lang"))).where(unit < cut)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(unit, "t_id"))
    return sized.withColumn("rank", rank).where(F.col("rank") <= share).select("t_id")


def quality_scores(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
                   max_train_docs: int = MAX_TRAIN_DOCS, quantile: float = QUANTILE, hot: int = HOT) -> DataFrame:
    """One row per document: ``doc_id, row_key, lang, n_tokens, log10_prob, perplexity, level, threshold, kept``.

    Trusted text is that of documents labelled ``quality = 1``.  A fifth of them by a
    hash of the id is held out; the model is trained on at most ``max_train_docs`` of the
    others, in equal shares of the languages, chosen by another hash.  ``level`` is log10 perplexity with a few typical
    words added; a document is kept unless it exceeds the quantile of the trusted
    documents of its language that were not trained on.  A language without such
    documents takes the quantile over all languages; without any trusted document
    outside of training nothing is rejected.  A null text is empty, a null language is a
    language, a null id is never trusted; repeated rows get equal scores.
    """
    trusted = labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("t_id")).distinct()
    open_to_training = trusted.where(F.pmod(F.xxhash64("t_id", F.lit(1)), F.lit(HOLD_OUT)) > 0)
    spoken = docs.select(F.col(doc_id).cast("long").alias("t_id"), F.col(lang).cast("string").alias("lang")).join(open_to_training, "t_id", "left_semi")
    spoken = checkpointed(spoken.groupBy("t_id").agg(F.min("lang").alias("lang")))
    chosen = checkpointed(draw_per_language(spoken, max_train_docs))
    sample = docs.select(F.col(doc_id).cast("long").alias("t_id"), F.col(text).alias("text")).join(F.broadcast(chosen), "t_id", "left_semi")
    shelf = Shelf(docs.sparkSession)
    grams = shelf.put("grams", count_grams(sample.select("text")))
    weights, unknown = train(grams, KEEP_FROM, shelf)
    shelf.drop("grams")
    model = docs.sparkSession.sparkContext.broadcast(HotWeights(weights, hot))
    scored = shelf.put("scored", score(docs, weights, unknown, doc_id, text, lang, hot, model))
    model.destroy()
    shelf.drop("weights")
    marks = trusted.join(chosen.withColumn("trained", F.lit(True)), "t_id", "left")
    known = scored.join(marks, scored.doc_id == marks.t_id, "left")
    typical = known.where("t_id IS NOT NULL").agg((-F.sum("log10_prob") / F.sum("n_tokens")).alias("typical"))
    level = (-F.col("log10_prob") + PRIOR_WORDS * F.coalesce("typical", F.lit(0.0))) / (F.col("n_tokens") + PRIOR_WORDS)
    known = known.crossJoin(F.broadcast(typical)).withColumn("level", level)
    fresh = known.where("t_id IS NOT NULL AND trained IS NULL").select("lang", "level")
    bounds = checkpointed(thresholds(fresh, quantile))
    own, overall = bounds.where("NOT every"), bounds.where("every").agg(F.max("threshold").alias("overall"))
    judged = known.join(own.select(F.col("lang").alias("b_lang"), "threshold"), F.col("lang").eqNullSafe(F.col("b_lang")), "left")
    judged = judged.crossJoin(F.broadcast(overall)).withColumn("threshold", F.coalesce("threshold", "overall"))
    return judged.select(
        "doc_id", "row_key", "lang", "n_tokens", "log10_prob", F.pow(F.lit(10.0), -F.col("log10_prob") / F.col("n_tokens")).alias("perplexity"),
        "level", "threshold", (F.col("threshold").isNull() | (F.col("level") <= F.col("threshold"))).alias("kept"))
