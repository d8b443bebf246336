"""Arrow batches cut into parts of a bounded size.

A batch holds up to 10,000 rows by Spark's default, whatever their length; what
a Python helper builds from it (objects, index arrays) is many times its size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def parts(batch: pa.RecordBatch, sizes: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` (no copies) whose rows' ``sizes`` sum to ``most`` at
    most, or a single row; all rows in order."""
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < len(batch):
        base = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
