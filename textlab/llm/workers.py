"""What the Python tasks of this folder share: shipping the package and reading batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from textlab.session import ship  # noqa: F401

SLICE_BYTES = 4 << 20


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of one piece stay below `limit` bytes; one longer text is a piece of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row and the offsets of each; a null text is empty."""
    whole = pc.fill_null(column, "").cast(pa.large_binary())
    if not len(whole):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    buffers = whole.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[whole.offset : whole.offset + len(whole) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]

