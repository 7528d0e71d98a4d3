"""Benchmark passages in documents: pieces found exactly by the pigeonhole rule, matches confirmed by edit distance."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Edits allowed per character of an item.
ERROR_RATE = 0.05
#: Benchmark text searched in one pass, so that what is sent to executors is bounded.
BLOCK_CHARS = 4_000_000

MATCHES = "doc_id long, item_id long, distance int, allowed int, start long, end long"


class Item(NamedTuple):
    item_id: int | None
    text: str
    allowed: int
    cuts: list[int]


def normal(text: str | None) -> str:
    """Lower-cased, white space collapsed to single spaces."""
    return " ".join((text or "").lower().split())


def item_of(item_id: int | None, text: str | None, rate: float = ERROR_RATE) -> Item:
    """An item in `allowed` + 1 pieces of nearly equal length: with so many errors at most, one piece is unharmed."""
    own = normal(text)
    allowed = int(rate * len(own))
    return Item(item_id, own, allowed, [len(own) * k // (allowed + 1) for k in range(allowed + 2)])


def automaton_of(items: list[Item]) -> ahocorasick.Automaton | None:
    """All pieces, each with the items and places it stands for."""
    found = ahocorasick.Automaton()
    for k, item in enumerate(items):
        for first, last in zip(item.cuts, item.cuts[1:], strict=False):
            piece = item.text[first:last]
            if piece:
                held = found.get(piece, None)
                if held is None:
                    found.add_word(piece, [(k, last)])
                else:
                    held.append((k, last))
    if not len(found):
        return None
    found.make_automaton()
    return found


def masks_of(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for k, char in enumerate(pattern):
        masks[char] = masks.get(char, 0) | 1 << k
    return masks


def least_distance(masks: dict[str, int], length: int, text: str) -> tuple[int, int]:
    """(least edit distance of the pattern to any substring of `text`, where the first such one ends), by Myers.

    The vertical differences of a column are two bit sets, here Python integers of the pattern's length.
    """
    full, top = (1 << length) - 1, 1 << length - 1
    plus, minus, score = full, 0, length
    best, at = length, 0
    for k, char in enumerate(text):
        same = masks.get(char, 0)
        vertical = same | minus
        horizontal = (((same & plus) + plus) ^ plus) | same
        up = minus | ~(horizontal | plus) & full
        down = plus & horizontal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = up << 1 & full
        down = down << 1 & full
        plus = down | ~(vertical | up) & full
        minus = up & vertical
        if score < best:
            best, at = score, k + 1
    return best, at


def matches_in(text: str, items: list[Item], found: ahocorasick.Automaton, masks: dict[int, dict[str, int]]) -> list[tuple]:
    """(item, distance, start, end) of the best match of each item that a text holds, by place in the normalized text.

    Every piece hit asks for the stretch that a match around it can cover; overlapping stretches of one item are
    joined, so that a repeated passage is read once.
    """
    asked: dict[int, list[list[int]]] = {}
    for end, places in found.iter(text):
        for k, last in places:
            item = items[k]
            first = end + 1 - last - item.allowed
            stretch = [max(0, first), min(len(text), first + len(item.text) + 2 * item.allowed)]
            asked.setdefault(k, []).append(stretch)
    out = []
    for k, stretches in asked.items():
        item = items[k]
        if k not in masks:
            masks[k] = masks_of(item.text)
        stretches.sort()
        best = (item.allowed + 1, 0)
        first, last = stretches[0]
        for a, b in [*stretches[1:], [len(text) + 1, 0]]:
            if a <= last:
                last = max(last, b)
                continue
            distance, at = least_distance(masks[k], len(item.text), text[first:last])
            best = min(best, (distance, first + at))
            first, last = a, b
        if best[0] <= item.allowed:
            out.append((item, best[0], max(0, best[1] - len(item.text)), best[1]))
    return out


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    rate: float = ERROR_RATE,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """(doc_id, item_id, distance, allowed, start, end) for each item found in each document.

    An item is found if a substring of the document lies within `rate` edits a character of it, both lower-cased and
    with white space collapsed; start (about) and end count characters of that text. One row an item and
    document row, for the nearest substring. Items without characters are never found; null texts are empty; repeated
    rows give repeated rows; null ids stay null.

    The benchmark is the query set: it is read in blocks of bounded size, each a pass over the documents, which are
    never shuffled. Whole texts are searched.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    wanted = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text"))
    blocks = 1 + (wanted.agg(F.sum(F.length("text")).alias("n")).first().n or 0) // block_chars
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    out = spark.createDataFrame([], MATCHES)
    for b in range(blocks):
        items = [item_of(r.item_id, r.text, rate) for r in wanted.where(block == b).collect()]
        out = out.unionAll(rows.mapInArrow(_search([tuple(i) for i in items]), MATCHES))
    return out


def _search(items: list[tuple]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [Item(*i) for i in items]
        found, masks = automaton_of(own), {}
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
        names = [f.split(" ")[0] for f in MATCHES.split(", ")]
        for batch in batches:
            rows = []
            texts = batch.column("text")
            for k, name in enumerate(batch.column("doc_id").to_pylist() if found else ()):
                for item, distance, start, end in matches_in(normal(texts[k].as_py()), own, found, masks):
                    rows.append((name, item.item_id, distance, item.allowed, start, end))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return run
