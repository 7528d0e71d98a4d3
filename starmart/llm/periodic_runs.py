"""Periodic runs of words, located by block convolutions over number-theoretic transforms."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.text import slices, within, words_of

#: Primes k * 2^n + 1 with a primitive root each. Products of two residues fit 64 bits.
PRIMES = ((2013265921, 31), (469762049, 3), (167772161, 5))
#: Numbers that one transform batch holds.
BATCH = 1 << 19


class Runs(NamedTuple):
    """Runs of some texts: which text, first word within it, words, period."""

    text: np.ndarray
    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def _mod(x: np.ndarray, prime: np.uint64) -> np.ndarray:
    return x - x // prime * prime


class Transform:
    """Number-theoretic transforms of a power-of-two length along the first axis, in bit-reversed order in between."""

    def __init__(self, n: int, prime: int, root: int):
        self.prime = np.uint64(prime)
        self.scale = np.uint64(pow(n, -1, prime))
        step = pow(root, (prime - 1) // n, prime)
        self.down = self._powers(step, n // 2)
        self.up = self._powers(pow(step, -1, prime), n // 2)
        self.n = n

    def _powers(self, step: int, n: int) -> np.ndarray:
        out = np.ones(1, np.uint64)
        while len(out) < n:
            out = np.concatenate([out, _mod(out * np.uint64(pow(step, len(out), int(self.prime))), self.prime)])
        return out[: max(n, 1)]

    def forward(self, x: np.ndarray) -> np.ndarray:
        half = self.n // 2
        while half:
            pairs = x.reshape(-1, 2, half, x.shape[1])
            a, b = pairs[:, 0].copy(), pairs[:, 1]
            total = a + b
            twiddles = self.down[:: self.n // (2 * half)][:half, None]
            pairs[:, 1] = _mod((a + self.prime - b) * twiddles, self.prime)
            pairs[:, 0] = np.minimum(total, total - self.prime)
            half //= 2
        return x

    def back(self, x: np.ndarray) -> np.ndarray:
        half = 1
        while half < self.n:
            pairs = x.reshape(-1, 2, half, x.shape[1])
            a, b = pairs[:, 0].copy(), _mod(pairs[:, 1] * self.up[:: self.n // (2 * half)][:half, None], self.prime)
            total, rest = a + b, a + self.prime - b
            pairs[:, 0] = np.minimum(total, total - self.prime)
            pairs[:, 1] = np.minimum(rest, rest - self.prime)
            half *= 2
        return _mod(x * self.scale, self.prime)


def occurrences(codes: np.ndarray, at: np.ndarray, room: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, distance) of every occurrence of the blocks `codes[at : at + size]` at distances 2*size - 1 to 4*size - 2.

    `room` is the largest distance that leaves the occurrence within the text. A block occurs where the sum of its
    squared differences from the window is zero. The sum is that of both squares less twice the correlation, which
    is a product of transforms; it is below size * max(codes)**2, and as many primes are taken as their product needs
    to exceed that, so that zero modulo all of them is zero.
    """
    n, shift = 4 * size, 2 * size - 1
    found_block, found_distance = [], []
    step = max(1, BATCH // n)
    offsets = np.arange(3 * size - 1)[:, None] + shift
    for k in range(0, len(at), step):
        own = np.arange(k, min(k + step, len(at)))
        block = codes[at[own][None, :] + np.arange(size)[:, None]]
        places = at[own][None, :] + offsets
        inside = offsets < (room[own] + size)[None, :]
        window = np.where(inside, codes[np.minimum(places, len(codes) - 1)], 0)
        most, product, zero = size * int(max(block.max(), window.max())) ** 2, 1, None
        sums = np.concatenate([np.zeros((1, len(own)), np.int64), np.cumsum(window**2, axis=0)])
        squares = (block**2).sum(axis=0)[None, :] + sums[size : size + 2 * size] - sums[: 2 * size]
        fits = np.arange(2 * size)[:, None] + shift <= room[own][None, :]
        for prime, root in PRIMES:
            ntt = Transform(n, prime, root)
            left, right = np.zeros((n, len(own)), np.uint64), np.zeros((n, len(own)), np.uint64)
            left[-np.arange(size) % n] = block % prime
            right[: 3 * size - 1] = window % prime
            both = _mod(ntt.forward(left) * ntt.forward(right), ntt.prime)
            correlation = ntt.back(both)[: 2 * size].astype(np.int64)
            same = (squares - 2 * correlation) % prime == 0
            zero = same & fits if zero is None else zero & same
            product *= prime
            if product > most or not zero.any():
                break
        else:
            raise ValueError("a text has too many different words for the primes")
        distance, which = np.nonzero(zero)
        found_block.append(own[which])
        found_distance.append(distance + shift)
    if not found_block:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_block), np.concatenate(found_distance)


def _agreeing(codes: np.ndarray, at: np.ndarray, room: np.ndarray, period: np.ndarray, sign: int) -> np.ndarray:
    """How many words from `at` on, in steps of `sign`, equal those one period later, `room` at most."""
    done = np.zeros(len(at), np.int64)
    active, width = np.flatnonzero(room > 0), 4
    while len(active):
        take = np.minimum(width, room[active] - done[active])
        steps = within(take)
        places = np.repeat(at[active] + sign * done[active], take) + sign * steps
        differ = np.where(codes[places] == codes[places + np.repeat(period[active], take)], np.iinfo(np.int64).max, steps)
        got = np.minimum(np.minimum.reduceat(differ, np.cumsum(take) - take), take)
        done[active] += got
        active = active[(got == take) & (done[active] < room[active])]
        width *= 2
    return done


def find_runs(codes: np.ndarray, counts: np.ndarray, least: int = 12) -> Runs:
    """All runs of at least `least` words in texts given as word numbers, end to end.

    A run is a stretch that has period q, q the smallest, is 2 * q words or longer, and cannot be made longer with that
    period. For a period p of 2B - 1 to 4B - 2, a stretch of 2p words holds an aligned block of B words that occurs
    again p words on within the stretch. So at each scale B = 1, 2, 4, ... every aligned block is sought in the window
    that follows it, and distances that are found are extended on both sides. Blocks whose rarest word does not return
    at such a distance cannot occur and are not convolved. A stretch found with a multiple of its smallest
    period is the same stretch, so of equal stretches the smallest period stays. Work is n log^2 n at most.
    """
    total = int(counts.sum())
    first = np.cumsum(counts) - counts
    text = np.repeat(np.arange(len(counts)), counts)
    end = np.repeat(first + counts, counts)
    none = np.zeros(0, np.int64)
    if not total:
        return Runs(none, none, none, none)
    order = np.argsort(text * (int(codes.max()) + 1) + codes, kind="stable")
    new = np.ones(total, bool)
    new[1:] = (codes[order][1:] != codes[order][:-1]) | (text[order][1:] != text[order][:-1])
    word = np.empty(total, np.int64)
    word[order] = np.cumsum(new) - 1
    often = np.bincount(word)[word]
    listed = word[order] * total + order
    least_word = np.full(len(counts), total)
    np.minimum.at(least_word, text, word)
    dense = word - least_word[text] + 1

    size, blocks, rarest = 1, counts, np.arange(total)
    found = [none.reshape(0, 3)]
    while (blocks > 0).any() and 3 * size - 1 <= counts.max():
        offset = np.cumsum(blocks) - blocks
        owner = np.repeat(np.arange(len(counts)), blocks)
        at = first[owner] + within(blocks) * size
        room = end[at] - size - at
        low, high = rarest + 2 * size - 1, rarest + np.minimum(4 * size - 2, room)
        near = listed[np.minimum(np.searchsorted(listed, word[rarest] * total + low), total - 1)]
        live = np.flatnonzero((often[rarest] > 1) & (room >= 2 * size - 1) & (near >= word[rarest] * total + low) & (near <= word[rarest] * total + high))
        if len(live):
            block, distance = occurrences(dense, at[live], room[live], size)
            found.append(_stretches(dense, at[live][block], distance, size, first[text], end, found))
        halves = blocks // 2
        pair = np.repeat(offset, halves) + 2 * within(halves)
        one, other = rarest[pair], rarest[np.minimum(pair + 1, len(rarest) - 1)]
        rarest = np.where(often[one] <= often[other], one, other)
        size, blocks = 2 * size, halves
    rows = np.concatenate(found)
    rows = rows[rows[:, 1] - rows[:, 0] >= least]
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    if len(rows):
        rows = rows[np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)])]
    rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    own = text[rows[:, 0]]
    return Runs(own, rows[:, 0] - first[own], rows[:, 1] - rows[:, 0], rows[:, 2])


def _stretches(
    codes: np.ndarray, at: np.ndarray, period: np.ndarray, size: int, begin: np.ndarray, end: np.ndarray, found: list[np.ndarray]
) -> np.ndarray:
    """(start, end, period) of the longest stretches around blocks that occur again, those of two periods or more."""
    if not len(at):
        return np.zeros((0, 3), np.int64)
    order = np.lexsort((at, period))
    at, period = at[order], period[order]
    heads = np.flatnonzero(np.concatenate([[True], (period[1:] != period[:-1]) | (at[1:] != at[:-1] + size)]))
    tails = np.concatenate([heads[1:], [len(at)]]) - 1
    left, right, period = at[heads], at[tails] + size, period[heads]
    keep = np.ones(len(left), bool)
    known = np.concatenate(found)
    step = max(1, (1 << 20) // max(1, len(known)))
    for k in range(0, len(left) if len(known) else 0, step):
        # Within a run of period q, of p + q words or more, a multiple p of q gives the same stretch again.
        own = slice(k, k + step)
        lies = (known[:, 0] <= left[own, None]) & (right[own, None] + period[own, None] <= known[:, 1])
        lies &= (period[own, None] % known[:, 2] == 0) & (known[:, 1] - known[:, 0] >= period[own, None] + known[:, 2])
        keep[own] = ~lies.any(axis=1)
    left, right, period = left[keep], right[keep], period[keep]
    out = []
    for k in range(0, len(left), 4096):
        own = slice(k, k + 4096)
        start, stop, p = left[own], right[own], period[own]
        start = start - _agreeing(codes, start - 1, start - begin[start], p, -1)
        stop = stop + _agreeing(codes, stop, end[start] - stop - p, p, 1) + p
        long = stop - start >= 2 * p
        out.append(np.stack([start, stop, p], axis=1)[long])
    rows = np.concatenate(out) if out else np.zeros((0, 3), np.int64)
    return np.unique(rows, axis=0)


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = 12) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for each row of `docs`.

    runs: (start, length, period) in words, by start, then period; see `find_runs`. collapsed: the text's words joined by
    a space, without those that some run holds after its first period. Words are compared as they stand. A null text
    has no words, no runs and an empty `collapsed`; a null doc_id stays null; repeated rows give repeated rows; an
    empty table gives an empty result. Other columns are not looked at. Rows are mapped where they are read, without a shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                split = words_of(part.column("text"), lower=False)
                n = len(split.values)
                codes = pc.dictionary_encode(split.values).indices.to_numpy().astype(np.int64)
                runs = find_runs(codes, split.counts, least)
                first = split.ends - split.counts
                change = np.zeros(n + 1, np.int64)
                np.add.at(change, first[runs.text] + runs.start + runs.period, 1)
                np.add.at(change, first[runs.text] + runs.start + runs.length, -1)
                kept = np.cumsum(change)[:n] == 0
                edges = np.concatenate([[0], np.cumsum(kept)])[np.concatenate([[0], split.ends])]
                lists = pa.LargeListArray.from_arrays(pa.array(edges), split.values.filter(pa.array(kept)))
                places = np.concatenate([[0], np.cumsum(np.bincount(runs.text, minlength=len(split.counts)))])
                triples = pa.StructArray.from_arrays([pa.array(x) for x in runs[1:]], ["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(split.counts.astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(places.astype(np.int32)), triples),
                        pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string()),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    triple = "array<struct<start: bigint, length: bigint, period: bigint>>"
    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, runs {triple}, collapsed string")
