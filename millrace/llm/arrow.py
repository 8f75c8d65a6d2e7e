"""Small helpers between Arrow batches and numpy, used inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

# Bytes of text that numpy works on at once; bounds the temporary arrays of a task.
SLICE_BYTES = 1_000_000


def text_slices(batch: pa.RecordBatch, column: str = "text",
                limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """The UTF-8 bytes of a text column, a bounded piece at a time.

    Yields (first row, end row, bytes, offsets); NULL counts as empty. A single text above
    ``limit`` is one piece.
    """
    texts = batch.column(column)
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    rows = len(texts)
    if not rows:
        return
    _, offsets_buffer, data = texts.buffers()
    offsets = np.frombuffer(offsets_buffer, dtype=np.int64)[texts.offset:texts.offset + rows + 1]
    size = int(offsets[-1])
    whole = np.frombuffer(data, dtype=np.uint8)[:size] if size else np.zeros(0, np.uint8)
    first = 0
    while first < rows:
        end = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        end = min(rows, max(end, first + 1))
        yield (first, end, whole[offsets[first]:offsets[end]],
               offsets[first:end + 1] - offsets[first])
        first = end


def only(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns alone, so that others, whatever their names, do not reach a task."""
    return df.select(*columns)


def schema_of(text: str) -> T.StructType:
    return T.StructType.fromDDL(text)


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions ``start .. start + length - 1``, one run after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
