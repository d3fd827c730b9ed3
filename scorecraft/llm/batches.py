"""Arrow helpers of the operators that run numpy inside Spark tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Text bytes that one step inside a task works on.  Batches are cut between
# rows, so a longer single text is a step of its own; results do not depend on it.
STEP_BYTES = 4 << 20


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column without nulls and its row offsets
    (int64, first 0), without copying the bytes."""
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def steps(batches: Iterator[pa.RecordBatch], text: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows, in batches of about ``limit`` bytes of the text column."""
    for batch in batches:
        _, off = text_buffer(batch.column(batch.schema.get_field_index(text)))
        lo = 0
        while lo < batch.num_rows:
            hi = int(np.searchsorted(off, off[lo] + limit, side="right")) - 1
            hi = min(max(hi, lo + 1), batch.num_rows)
            yield batch.slice(lo, hi - lo)
            lo = hi


def binary_array(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    """Binary values ``data[offsets[i]:offsets[i + 1]]``."""
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1,
                                 [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)),
                                  pa.py_buffer(np.ascontiguousarray(data))])


def expand(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices ``starts[i] .. starts[i] + lengths[i] - 1`` for every i, in order."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)
