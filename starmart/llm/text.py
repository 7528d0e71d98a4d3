"""Word arrays of texts in Arrow batches; shared by the operators of this package.

A word is a run of characters other than space and U+0009 to U+000D. Lower-casing touches A to Z only.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19


class Words(NamedTuple):
    """Words of some texts, end to end, and how many each text has."""

    values: pa.Array
    counts: np.ndarray

    @property
    def ends(self) -> np.ndarray:
        return np.cumsum(self.counts)


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of at most `most` bytes of text (one row at least), so memory stays bounded."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    block = (np.cumsum(sizes) - sizes) // most
    starts = np.flatnonzero(np.diff(block, prepend=-1))
    for first, last in zip(starts, [*starts[1:], batch.num_rows], strict=True):
        yield batch.slice(first, last - first)


def words_of(texts: pa.Array, lower: bool = True) -> Words:
    """Split texts at ASCII white space; null counts as empty."""
    # Taking copies the rows: Arrow's string kernels misread a large_string array that begins within its buffers.
    texts = pc.fill_null(texts.take(pa.array(np.arange(len(texts)))).cast(pa.large_string()), "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    offsets = lists.offsets.to_numpy()
    values = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
    filled = pc.greater(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
    running = np.concatenate([[0], np.cumsum(filled)])
    return Words(values.filter(pa.array(filled)), np.diff(running[offsets - offsets[0]]))


def within(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... within each of the runs of the given lengths."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)
