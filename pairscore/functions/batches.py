"""Batches in parts. Spark hands a Python function ten thousand rows at a time, however long their texts are; what a function
makes of them is handed back part by part, so that its memory does not grow with a batch."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

PART_ROWS, PART_BYTES = 256, 1 << 20


def in_parts(frames: Iterable[pd.DataFrame], rows: int = PART_ROWS) -> Iterator[pd.DataFrame]:
    """The same rows, at most ``rows`` at a time; an empty frame stays."""
    for frame in frames:
        for at in range(0, max(1, len(frame)), rows):
            yield frame[at : at + rows]


def by_bytes(batches: Iterable[pa.RecordBatch], column: int, most: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows, as slices in which the texts of a column begin within ``most`` bytes: at most that and one text."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        before = np.cumsum(sizes + 1) - (sizes + 1)
        begins = np.flatnonzero(np.diff(before // most, prepend=-1)).tolist()
        for at, end in zip(begins, [*begins[1:], batch.num_rows]):
            yield batch.slice(at, end - at)


def record(columns: Iterable[Iterable], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(values, field.type) for values, field in zip(columns, schema, strict=True)], schema=schema)
