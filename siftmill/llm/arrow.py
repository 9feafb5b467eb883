"""Texts of Arrow batches as numpy views."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and where each text begins and the last ends; a null is an empty text."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows that hold ``most`` bytes of text, or one row."""
    if not batch.num_rows:
        return
    _, at = utf8(batch.column(column))
    i = 0
    while i < batch.num_rows:
        j = max(i + 1, int(np.searchsorted(at, at[i] + most, side="right")) - 1)
        yield batch.slice(i, j - i)
        i = j
    pa.default_memory_pool().release_unused()


def gathered(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Rows of all ``batches`` in runs of up to ``most`` bytes of text, or one row, whatever the batches' sizes."""
    held: list[pa.RecordBatch] = []
    size = 0
    for whole in batches:
        for b in slices(whole, column, most):
            n = int(utf8(b.column(column))[1][-1])
            if held and size + n > most:
                yield _joined(held)
                held, size = [], 0
            held.append(b)
            size += n
    if held:
        yield _joined(held)


def _joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    return held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]
