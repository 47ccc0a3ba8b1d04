"""SHA-256 over texts that are spread over many rows, in their order."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes that a task joins before it hands them on.
CHUNK_BYTES = 1 << 20


def _runs(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[bool, tuple]]:
    """Rows of sorted batches, each with whether its key is a new one."""
    last = None
    for batch in batches:
        for row in zip(*[column.to_pylist() for column in batch.columns], strict=True):
            yield row[:n_keys] != last, row
            last = row[:n_keys]


def _as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _chunks(keys: int, order: int, separator: bytes, limit: int):
    """Neighbouring texts of a key joined into chunks; a chunk is named by the place of its first text."""
    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, made, parts, first, size, number = None, [], [], None, 0, 0

        def close() -> None:
            nonlocal parts, size, number
            if parts:
                made.append((*first, number, len(parts), separator.join(parts)))
                number += 1
            parts, size = [], 0

        for batch in batches:
            if schema is None:
                schema = pa.schema([*list(batch.schema)[:keys + order], ("number", pa.int64()), ("texts", pa.int64()), ("chunk", pa.binary())])
            for new, row in _runs(iter([batch]), keys):
                if parts and (size >= limit or (new and row[:keys] != first[:keys])):
                    close()
                if not parts:
                    first = row[:keys + order]
                parts.append(row[-1].encode())
                size += len(parts[-1]) + len(separator)
            if made:
                yield _as_batch(made, schema)
                made = []
        close()
        if made:
            yield _as_batch(made, schema)

    return joined


def _hashes(keys: int, separator: bytes):
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, texts, out, schema = None, None, 0, [], None
        for batch in batches:
            if schema is None:
                schema = pa.schema([*list(batch.schema)[:keys], ("n_texts", pa.int64()), ("sha256", pa.string())])
            for row in zip(*[column.to_pylist() for column in batch.columns], strict=True):
                if state is None or row[:keys] != key:
                    if state is not None:
                        out.append((*key, texts, state.hexdigest()))
                    key, state, texts = row[:keys], hashlib.sha256(), 0
                elif texts:
                    state.update(separator)
                state.update(row[-1])
                texts += row[-2]
            if out:
                yield _as_batch(out, schema)
                out = []
        if state is not None:
            yield _as_batch([(*key, texts, state.hexdigest())], schema)

    return hashed


def streamed_digest(rows: DataFrame, keys: Sequence[str], order: Sequence[str], text: str, separator: str = "",
                    chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Per key: ``keys, n_texts, sha256`` of its texts joined by ``separator``, in the given order.

    Rows are dealt by ranges of key and order, so a key of any size is joined by many
    tasks into chunks of about ``chunk_bytes``; the hash itself, which has to be taken
    in order, reads a key's chunks one after the other and holds one of them.  A null
    text is empty; null keys are keys; rows that tie in the order must have equal texts.
    Dealing by ranges reads ``rows`` twice.
    """
    keyed = [F.col(k).alias(f"k{n}") for n, k in enumerate(keys)]
    placed = [F.col(o).alias(f"o{n}") for n, o in enumerate(order)]
    flat = rows.select(*keyed, *placed, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    names = flat.columns[:-1]
    dealt = flat.repartitionByRange(*names).sortWithinPartitions(*names)
    kinds = {f.name: f.dataType.simpleString() for f in flat.schema}
    schema = ", ".join([f"{n} {kinds[n]}" for n in names] + ["number long", "texts long", "chunk binary"])
    chunks = dealt.mapInArrow(_chunks(len(keys), len(order), separator.encode(), chunk_bytes), schema)
    own = names[:len(keys)]
    ready = chunks.repartition(*own).sortWithinPartitions(*names, "number").select(*own, "texts", "chunk")
    schema = ", ".join([f"{n} {kinds[n]}" for n in own] + ["n_texts long", "sha256 string"])
    found = ready.mapInArrow(_hashes(len(keys), separator.encode()), schema)
    return found.select(*[F.col(n).alias(k) for n, k in zip(own, keys, strict=True)], "n_texts", "sha256")
