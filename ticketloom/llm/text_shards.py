"""Texts of a task in shards of bounded size, and their words as codes of a dictionary."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Counted for every row beside its text, so that rows without text fill a shard too.
ROW_BYTES = 64


def in_shards(batches: Iterable[pa.RecordBatch], text: str, max_bytes: int) -> Iterator[pa.Table]:
    """Rows in their order, cut where their texts exceed `max_bytes`; a longer text alone."""
    held: list[pa.RecordBatch] = []
    size = 0
    # What an earlier task of this worker used is not kept beside the shards of this one.
    pa.default_memory_pool().release_unused()
    for batch in batches:
        lengths = pc.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths.astype(np.int64) + ROW_BYTES)
        start = 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            stop = int(np.searchsorted(ends, before + max_bytes - size, side="right"))
            if stop <= start and held:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
                continue
            stop = max(stop, start + 1)
            held.append(batch.slice(start, stop - start))
            size += int(ends[stop - 1]) - before
            start = stop
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def one_array(column: pa.ChunkedArray) -> pa.Array:
    column = column.combine_chunks()
    return pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column


def coded_words(texts: pa.Array, table: bytes | None = None) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(row of every word, its code, the words by code): words lie between the six ASCII
    white-space characters. `table` changes single bytes beforehand, as bytes.translate."""
    if table is not None and texts.buffers()[2] is not None:
        changed = pa.py_buffer(texts.buffers()[2].to_pybytes().translate(table))
        texts = pa.Array.from_buffers(
            texts.type, len(texts), [texts.buffers()[0], texts.buffers()[1], changed], offset=texts.offset
        )
    lists = pc.ascii_split_whitespace(texts.fill_null(""))
    rows = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
    words = lists.flatten()
    real = pc.greater(pc.binary_length(words), 0)
    coded = words.filter(real).dictionary_encode()
    return rows[real.to_numpy(zero_copy_only=False)], coded.indices.to_numpy(), coded.dictionary


def binary_column(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """One binary value per list: the bytes of `values` up to each end (in items)."""
    offsets = np.concatenate([[0], ends]).astype(np.int64) * values.itemsize
    return pa.Array.from_buffers(
        pa.binary(), len(ends), [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(values.tobytes())]
    )


def totals(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of the lists that stand end to end in `values`; an empty list sums to zero."""
    starts = np.concatenate([[0], ends])[:-1]
    full = ends > starts
    sums = np.zeros(len(ends), np.int64)
    if full.any():
        sums[full] = np.add.reduceat(values, starts[full], dtype=np.int64)
    return sums
