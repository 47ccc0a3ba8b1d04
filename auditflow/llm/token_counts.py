"""Token counts of whole texts by a whole-token shortcut.

Offline, every string of the vocabulary is put through the merges on its own: those that
come out as one token are whole tokens.  Pre-tokens are encoded each on its own, so a
pre-token among them counts one without being merged, and only the rest is merged.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditflow.llm.common import text_of
from auditflow.llm.packing import vocabulary

#: Characters of a long text that are split into pre-tokens at a time.
BLOCK_CHARS = 1 << 18
#: Distinct pre-tokens whose merged counts a task remembers.
REMEMBERED = 1 << 18
#: Longer pre-tokens are merged anew each time, which keeps the memory bounded.
REMEMBERED_CHARS = 64

#: Texts of these characters are split by the pattern below, all others by the tokenizer itself.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa1-\xff]*\Z")
_LETTER, _NUMBER = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe"
#: Fixed value: how the byte-level pre-tokenizer splits a text, with its classes written out for plain characters.
_PRE_TOKEN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^\t\n\r {_LETTER}{_NUMBER}]+|[\t\n\r ]+(?![^\t\n\r ])|[\t\n\r ]+")
#: A pre-token never goes on over these places.
_SEAM = regex.compile(r"(?<=\S)(?=\s)|(?<=\p{L})(?=\p{N})|(?<=\p{N})(?=\p{L})")


def _bytes_as_text() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves, the rest from 256 on."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or (0xA1 <= b <= 0xFF and b != 0xAD)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


@dataclass(frozen=True)
class Proof:
    """What is known of a vocabulary before any text is read; at most one string per entry of the vocabulary."""

    path: str
    whole: frozenset[str]
    names: tuple[str, ...]


def prove(path: str | None = None) -> Proof:
    """Whole tokens of a byte-level BPE vocabulary, and the names of its added tokens.

    A string counts as whole if its bytes are UTF-8, the pre-tokenizer leaves it in one
    piece and the merges turn it into one token.
    """
    from tokenizers import Tokenizer

    path = path or vocabulary()
    with open(path, encoding="utf-8") as file:
        said = json.load(file)
    splitter, model = said.get("pre_tokenizer") or {}, said["model"]
    if (model["type"], splitter.get("type"), splitter.get("use_regex"), said.get("normalizer")) != ("BPE", "ByteLevel", True, None):
        raise ValueError("whole tokens are proven for byte-level BPE vocabularies only")
    if splitter.get("add_prefix_space") or model.get("dropout") or said.get("truncation"):
        raise ValueError("prefix spaces, dropout and truncation have no fixed count per pre-token")
    made = [model["vocab"]["".join(pair)] for pair in model["merges"]]
    if made != sorted(made):
        raise ValueError("ids must follow the order of the merges")
    if any(t[flag] for t in said["added_tokens"] for flag in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError("added tokens must stand for their plain names")
    tokenizer, byte_of = Tokenizer.from_file(path), _bytes_as_text()
    names = tuple(sorted((t["content"] for t in said["added_tokens"]), key=len, reverse=True))
    whole = set()
    for entry in model["vocab"]:
        try:
            text = bytes(byte_of[c] for c in entry).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        if len(tokenizer.pre_tokenizer.pre_tokenize_str(text)) == 1 and len(tokenizer.model.tokenize(entry)) == 1:
            whole.add(text)
    return Proof(path, frozenset(whole), names)


class Counter:
    """Counts the tokens of texts under a proof."""

    def __init__(self, proof: Proof):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(proof.path)
        self.whole = proof.whole
        self.names = re.compile("|".join(map(re.escape, proof.names))) if proof.names else None
        self.known: dict[str, int] = {}
        with open(proof.path, encoding="utf-8") as file:
            entries = json.load(file)["model"]["vocab"].items()
        byte_of = _bytes_as_text()
        ranks = {bytes([byte_of[c] for c in entry]): rank for entry, rank in entries if byte_of.keys() >= set(entry)}
        # the merges of the vocabulary on a pre-token as one piece
        self.merges = tiktoken.Encoding("merges", pat_str="(?s).+", mergeable_ranks=ranks, special_tokens={})

    def _merged(self, word: str) -> int:
        """Tokens of a pre-token that is not whole."""
        found = self.known.get(word)
        if found is None:
            found = len(self.merges.encode_ordinary(word))
            if len(word) <= REMEMBERED_CHARS:
                if len(self.known) >= REMEMBERED:
                    self.known.clear()
                self.known[word] = found
        return found

    def _pre_tokens(self, text: str) -> list[str]:
        if _PLAIN.match(text):
            return _PRE_TOKEN.findall(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def _plain(self, text: str) -> int:
        """Tokens of a text without names of added tokens, block by block."""
        count, at = 0, 0
        while at < len(text):
            seam = _SEAM.search(text, at + BLOCK_CHARS) if at + BLOCK_CHARS < len(text) else None
            stop = seam.start() if seam else len(text)
            words = self._pre_tokens(text if stop - at == len(text) else text[at:stop])
            rest = [w for w in words if w not in self.whole]
            count += len(words) - len(rest) + sum(map(self._merged, rest))
            at = stop
        return count

    def count(self, text: str) -> int:
        if self.names is None or not self.names.search(text):
            return self._plain(text)
        count, at = 0, 0
        for name in self.names.finditer(text):
            count += self._plain(text[at:name.start()]) + 1
            at = name.end()
        return count + self._plain(text[at:])


COUNTS = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


def _counting(proof):
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(proof.value)
        for batch in batches:
            tokens = [counter.count(text.as_py()) for text in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(tokens, type=pa.int64())], schema=COUNTS)

    return counted


def token_counts(docs: DataFrame, limit: int, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_tokens, over_limit``.

    ``n_tokens`` is what the tokenizers library gives for the whole text with its
    defaults and without added begin or end; the name of an added token inside a text is
    that one token.  A null or empty text has no bytes and no tokens; a null id stays
    null; repeated rows are counted once each; an empty table gives no rows; other
    columns are not read.  Long texts are split block by block at places that no
    pre-token goes over.  Only the proof is broadcast, whose size is the vocabulary's.
    Nothing is shuffled.
    """
    proof = docs.sparkSession.sparkContext.broadcast(prove(tokenizer))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.octet_length(text_of(text)).cast("long").alias("n_bytes"), text_of(text).alias("text"))
    counted = rows.mapInArrow(_counting(proof), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
