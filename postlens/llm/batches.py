"""Arrow batches in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def text_slices(batch: pa.RecordBatch, most_bytes: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Rows of a batch, so many bytes of text at a time; a longer text is a piece of its own. The column holds no nulls."""
    ends = np.cumsum(pc.binary_length(batch[column]).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        done = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + most_bytes, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
