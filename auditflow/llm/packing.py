"""Documents tokenized, cut and packed into sequences by bounded-space online best-fit."""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditflow.llm.common import checkpointed

LENGTH = 1024
END = 2
#: Bins that a packer keeps open at a time.
OPEN_BINS = 1024
#: Packers whose open bins meet in one task of the next level.
FAN_IN = 64

#: Texts of these characters go through the ranks of the same vocabulary, all others through the tokenizer itself.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa1-\xff]*\Z")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Token ids of whole texts, as little-endian 32-bit bytes.

    The ranks of the vocabulary give the same ids as the tokenizer several times
    faster; they are used where both are known to split a text alike, on texts of
    plain Latin letters that hold no name of an added token.  Such a name inside a text
    is that token, as the tokenizer has it by default.
    """

    def __init__(self, path: str | None = None, ranks: str | None = None):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or vocabulary())
        names = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.names = re.compile("|".join(names) or r"(?!)")
        with open(ranks or vocabulary("byte_bpe_50k.tiktoken"), "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    def encode(self, text: str) -> bytes:
        if _PLAIN.match(text) and not self.names.search(text):
            ids = self.fast.encode_ordinary(text)
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return array("I", ids).tobytes()


def pieces_of(ids: bytes, length: int = LENGTH) -> Iterator[tuple[int, int]]:
    """``(start, length)`` of the pieces; only a longer document is cut, and its first piece may be shorter."""
    n = len(ids) // 4
    at = 0
    while at < n:
        size = (n - at) % length or length
        yield at, size
        at += size


class BestFit:
    """At most ``open_bins`` open bins; bit ``f`` of the set says that some bin has ``f`` free places."""

    def __init__(self, length: int = LENGTH, open_bins: int = OPEN_BINS):
        self.length, self.limit = length, open_bins
        self.free: list[list[int]] = [[] for _ in range(length + 1)]
        self.bits = 0
        self.open = 0
        self.made = 0

    def _take(self, free: int) -> int:
        found = self.free[free].pop()
        if not self.free[free]:
            self.bits &= ~(1 << free)
        self.open -= 1
        return found

    def _give(self, free: int, bin_no: int) -> None:
        if free:
            self.free[free].append(bin_no)
            self.bits |= 1 << free
            self.open += 1

    def add(self, size: int) -> tuple[int, int]:
        """``(bin, offset)`` for an item: the open bin that it fills best, or else a new one."""
        fits = self.bits >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            bin_no = self._take(free)
        else:
            if self.open >= self.limit:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            free, bin_no = self.length, self.made
            self.made += 1
        self._give(free - size, bin_no)
        return bin_no, self.length - free

    def still_open(self) -> dict[int, int]:
        """Free places of each open bin."""
        return {b: f for f, bins in enumerate(self.free) for b in bins}


def add_all(fit: BestFit, sizes: list[int]) -> list[tuple[int, int]]:
    """``(bin, offset)`` of every item, in the order given.

    The packer looks at as many items together as it has open bins and takes those
    largest first, which wastes least.
    """
    out: list[tuple[int, int]] = [(0, 0)] * len(sizes)
    for at in range(0, len(sizes), fit.limit):
        for i in sorted(range(at, min(at + fit.limit, len(sizes))), key=lambda i: -sizes[i]):
            out[i] = fit.add(sizes[i])
    return out


PIECES = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("bin", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary()),
])


def _packer(length: int, open_bins: int, carry_ids: bool, end: int, path: str | None, ranks: str | None):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = Encoder(path, ranks)
        tail = array("I", [end]).tobytes()
        fit, base = BestFit(length, open_bins), TaskContext.get().partitionId() << 40
        for batch in batches:
            cut = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encoder.encode(text) + tail
                for piece, (start, size) in enumerate(pieces_of(ids, length)):
                    part = ids[4 * start:4 * (start + size)]
                    cut.append((doc_id, piece, start, size, zlib.crc32(part), part if carry_ids else None))
            places = add_all(fit, [c[3] for c in cut])
            rows = [(*c[:5], base | bin_no, offset, c[5]) for c, (bin_no, offset) in zip(cut, places, strict=True)]
            out = list(zip(*rows, strict=True)) if rows else [[] for _ in PIECES]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(out, PIECES, strict=True)], schema=PIECES)

    return pack


def _repack(length: int, open_bins: int):
    """Bins of several packers as items of their filled size."""
    def pack(rows):
        rows = rows.sort_values("bin")
        heads, to, at = {}, [], []
        for bin_no, (made, offset) in zip(rows["bin"].tolist(), add_all(BestFit(length, open_bins), rows["size"].tolist()), strict=True):
            to.append(heads.setdefault(made, bin_no))
            at.append(offset)
        return rows.assign(into=to, at=at)[["bin", "into", "at"]]

    return pack


def _partial(placed: DataFrame, length: int) -> DataFrame:
    """Bins that are not full, with their filled size."""
    return placed.groupBy("bin").agg(F.sum("length").alias("size")).where(F.col("size") < length)


def best_fit_pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, end: int = END,
                  open_bins: int = OPEN_BINS, carry_ids: bool = False, tokenizer: str | None = None,
                  ranks: str | None = None) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset, ids``.

    Every task packs the pieces of its documents as they come.  Bins that it leaves
    partly filled are items of the next level, where a group of packers meets, until a
    level has one group; a full or merged bin only gets a base offset.  A null text is
    empty and gives the end id alone; a null id stays null; repeated rows are packed
    once each; an empty table gives no rows.  ``ids`` is null unless ``carry_ids``.
    Other columns of the input are not read.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, bin long, offset long, ids binary"
    placed = checkpointed(rows.mapInArrow(_packer(length, open_bins, carry_ids, end, tokenizer, ranks), schema))
    # moves: bin of a packer -> bin it ends in and its offset there
    items = checkpointed(_partial(placed, length).select("bin", "size", F.shiftright("bin", 40).alias("packer")))
    moves = None
    while True:
        groups = items.select(F.floor(F.col("packer") / FAN_IN).alias("part"), "bin", "size")
        step = groups.groupBy("part").applyInPandas(_repack(length, open_bins), "bin long, into long, at long")
        step = checkpointed(step)
        if moves is None:
            moves = step
        else:
            later = step.select(F.col("bin").alias("into"), F.col("into").alias("next"), F.col("at").alias("more"))
            moves = checkpointed(moves.join(later, "into", "left").select(
                "bin", F.coalesce("next", "into").alias("into"), (F.col("at") + F.coalesce("more", F.lit(0))).alias("at")))
        last = items.select(F.max("packer")).first()[0]
        if last is None or last < FAN_IN:
            break
        filled = step.join(items, "bin").groupBy("into").agg(F.sum("size").alias("size"))
        heads = items.select(F.col("bin").alias("into"), F.floor(F.col("packer") / FAN_IN).alias("packer"))
        items = checkpointed(filled.where(F.col("size") < length).join(heads, "into").select(F.col("into").alias("bin"), "size", "packer"))
    return placed.join(moves, "bin", "left").select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.coalesce("into", "bin").alias("sequence_id"),
        (F.col("offset") + F.coalesce("at", F.lit(0))).alias("offset"), "ids",
    )
