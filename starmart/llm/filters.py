"""Bloom filters over ids, of a fixed size, that spare a join's long side most of its shuffle."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 8 MB, whatever the data. Beyond some ten million ids more and more rows pass, and the join drops them.
FILTER_BITS, FILTER_HASHES = 1 << 26, 4


def positions(ids: np.ndarray) -> np.ndarray:
    """Where the filter keeps each id, one row per hash."""
    factors = np.random.default_rng(7).integers(0, 1 << 63, FILTER_HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return (ids.view(np.uint64)[None, :] * factors[:, None]) >> np.uint64(64 - FILTER_BITS.bit_length() + 1)


def id_filter(ids: DataFrame) -> np.ndarray:
    """A Bloom filter of a fixed size over one column of ids, built by Spark. It may let other ids through, too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = positions(batch.column(0).to_numpy()).reshape(-1)
            bit = np.uint64(1) << (at & np.uint64(63))
            yield pa.RecordBatch.from_arrays(
                [pa.array((at >> np.uint64(6)).astype(np.int32)), pa.array(bit.view(np.int64))], ["word", "bit"]
            )

    found = ids.mapInArrow(run, "word int, bit long").groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS // 64, np.uint64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return out


def let_through(held: np.ndarray, ids: pa.Array) -> pa.Array:
    """Which ids, without nulls, the filter lets through."""
    at = positions(ids.to_numpy().astype(np.int64))
    there = (held[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)
    return pa.array(there.all(axis=0))


def that_may_be_in(rows: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """The rows whose `column` is in `ids`, and some others; so that a join after it moves little of a long side."""
    held = rows.sparkSession.sparkContext.broadcast(id_filter(ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(let_through(held.value, batch.column(column)))

    return rows.mapInArrow(run, rows.schema)
