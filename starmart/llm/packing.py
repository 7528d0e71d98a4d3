"""Packing token sequences: repeat counts of length combinations by non-negative least squares, the rest greedily."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.text import slices
from starmart.llm.tokens import WORD_PIECES, definition_of, encoder, with_end
from starmart.sources.lake import scratch_folder

WINDOW = 2048
END_ID = 1
#: Triples tried per length.
THIRDS = 8
SWEEPS = 60

PIECES = "doc_id long, start long, length int, doc_tokens long, ids binary, part int, rank long"
PACKED = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def combinations(lengths: list[int], window: int, thirds: int = THIRDS) -> list[tuple[int, ...]]:
    """Combinations of one, two or three of the lengths that fill a window exactly; a few triples a length."""
    there = set(lengths)
    found = {(window,)} if window in there else set()
    for a in lengths:
        if 2 * a >= window and window - a in there:
            found.add((a, window - a))
        rest = window - a
        if rest > 1:
            for k in range(1, thirds + 1):
                b = rest * k // (2 * thirds)
                c = rest - b
                if b in there and c in there:
                    found.add(tuple(sorted((a, b, c), reverse=True)))
    return sorted(found)


def non_negative_least_squares(columns: list[dict[int, int]], wanted: dict[int, int], sweeps: int = SWEEPS) -> list[float]:
    """x >= 0 that lessens |A x - wanted|**2 by cyclic coordinate descent; columns are sparse: {row: entry}."""
    left = {k: float(v) for k, v in wanted.items()}
    x = [0.0] * len(columns)
    norms = [sum(e * e for e in c.values()) for c in columns]
    for _ in range(sweeps):
        moved = 0.0
        for j, column in enumerate(columns):
            step = max(-x[j], sum(e * left[r] for r, e in column.items()) / norms[j])
            if step:
                x[j] += step
                for r, e in column.items():
                    left[r] -= e * step
                moved = max(moved, abs(step))
        if moved < 0.25:
            break
    return x


class Plan:
    """Where the piece of each length and rank goes.

    A class is a set of like pieces: first those of one length, later the tails of cut ones. `given[c]` lists, in
    order of rank, ranges of a class: (first rank, sequence of that rank, offset, length used, class of the
    tail or -1). It depends on the histogram only, so its size is bounded by the window, not by the data.
    """

    def __init__(self, histogram: dict[int, int], window: int = WINDOW):
        self.window, self.sequences = window, 0
        self.length, self.left, self.taken = [], [], []
        self.given: list[list[tuple[int, int, int, int, int]]] = []
        self.at = np.zeros(window + 1, np.int64)
        self.classes: dict[int, list[int]] = {}
        self.of_length = {n: self._add(n, count) for n, count in sorted(histogram.items()) if count}
        for combination, times in self._solved(histogram):
            self._lay([(self.of_length[n], n) for n in combination], times)
        while self.at.any():
            self._greedy()

    def _add(self, length: int, count: int) -> int:
        c = len(self.length)
        self.length.append(length)
        self.left.append(count)
        self.taken.append(0)
        self.given.append([])
        self.classes.setdefault(length, []).append(c)
        self.at[length] += count
        return c

    def _solved(self, histogram: dict[int, int]) -> Iterator[tuple[tuple[int, ...], int]]:
        there = {n: c for n, c in histogram.items() if c}
        columns = combinations(sorted(there), self.window)
        repeats = non_negative_least_squares([dict(Counter(c)) for c in columns], there)
        for column, x in sorted(zip(columns, repeats, strict=True), key=lambda cx: -cx[1]):
            uses = Counter(column)
            times = min(math.floor(x + 1e-6), *(self.left[self.of_length[n]] // k for n, k in uses.items()))
            if times > 0:
                yield column, times

    def _lay(self, slots: list[tuple[int, int]], times: int) -> None:
        """`times` sequences that hold `length` tokens of a piece of each class, end to end; a longer piece is cut."""
        offset = 0
        for c, used in slots:
            tail = -1
            if used < self.length[c]:
                tail = self._add(self.length[c] - used, times)
            self.given[c].append((self.taken[c], self.sequences, offset, used, tail))
            self.taken[c] += times
            self.left[c] -= times
            self.at[self.length[c]] -= times
            offset += used
        self.sequences += times

    def _pick(self, length: int, used: Counter) -> int | None:
        return next((c for c in self.classes.get(length, ()) if self.left[c] > used[c]), None)

    def _greedy(self) -> None:
        """Fill one sequence, longest first, cutting a piece for the rest; repeat it as often as there are pieces."""
        slots, used, gap = [], Counter(), self.window
        free = self.at.copy()
        while gap:
            fits = np.flatnonzero(free[: gap + 1])
            cut = not len(fits)
            longer = np.flatnonzero(free) if cut else fits
            if not len(longer):
                break
            length = int(longer[-1])
            c = self._pick(length, used)
            slots.append((c, gap if cut else length))
            used[c] += 1
            free[length] -= 1
            gap -= gap if cut else length
        self._lay(slots, min(self.left[c] // n for c, n in used.items()) if gap == 0 else 1)

    def place(self, length: int, rank: int) -> Iterator[tuple[int, int, int, int]]:
        """(start within the piece, length, sequence, offset) of each part of a piece."""
        c, start = self.of_length[length], 0
        while c >= 0:
            ranges = self.given[c]
            low, high = 0, len(ranges)
            while high - low > 1:
                middle = (low + high) // 2
                low, high = (middle, high) if ranges[middle][0] <= rank else (low, middle)
            first, sequence, offset, used, tail = ranges[low]
            rank -= first
            yield start, used, sequence + rank, offset
            start += used
            c = tail


def pieces(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end: int = END_ID, window: int = WINDOW) -> DataFrame:
    """Each text's ids, its end id included, cut at multiples of the window.

    `part` and `rank` number the pieces of one length within a task's input, so that a global rank needs no
    shuffle of the ids.
    """
    definition = docs.sparkSession.sparkContext.broadcast(definition_of(tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen = np.zeros(window + 1, np.int64)
        with encoder(definition.value, WORD_PIECES, lower=True) as own_encoder:
            for batch in batches:
                for own in slices(batch, "text"):
                    ids, counts = with_end(*own_encoder.encode(own.column("text")), end)
                    raw = ids.astype("<u4").tobytes()
                    rows = []
                    before = 0
                    for name, n in zip(own.column("doc_id").to_pylist(), counts.tolist(), strict=True):
                        for start in range(0, n, window):
                            length = min(window, n - start)
                            held = raw[4 * (before + start) : 4 * (before + start + length)]
                            rows.append((name, start, length, n, held, part, int(seen[length])))
                            seen[length] += 1
                        before += n
                    yield _batch(rows, PIECES)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, PIECES)


ARROW = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split(" ") for f in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, ARROW[kind]) for c, (_, kind) in zip(columns, fields, strict=True)], [name for name, _ in fields]
    )


def pack(
    docs: DataFrame,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    end: int = END_ID,
    window: int = WINDOW,
    keep_ids: bool = False,
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) per piece; with `ids` if asked for.

    All rows are packed, repeated ones once each; a null or empty text has its end id only; a null doc_id stays null.
    Sequences are full but for the very last. An empty table gives an empty result.

    Texts are tokenized once. The plan is made from the histogram of piece lengths (at most `window` numbers)
    and tells by length and rank where a piece goes, so pieces are placed without meeting each other. A
    piece's rank is its rank within its task plus the number of like pieces in earlier tasks.
    """
    spark = docs.sparkSession
    folder = scratch_folder(spark, "packing")
    pieces(docs, tokenizer, doc_id, text, end, window).write.option("compression", "zstd").parquet(folder)
    held = spark.read.schema(PIECES).parquet(folder)
    counts = held.groupBy("part", "length").agg(F.count("*").alias("n"))
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = Plan(histogram, window)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    schema = PACKED + (", ids binary" if keep_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                for start, length, sequence, offset in plan.place(r["length"], r["rank"] + r["before"]):
                    own = r["ids"][4 * start : 4 * (start + length)]
                    row = (r["doc_id"], r["start"] + start, length, zlib.crc32(own), r["doc_tokens"], sequence, offset)
                    rows.append((*row, own) if keep_ids else row)
            yield _batch(rows, schema)

    return held.join(before, ["part", "length"]).mapInArrow(run, schema)
