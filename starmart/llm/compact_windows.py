"""Near-duplicate passages by compact windows.

All subsequences of a text, SHORTEST shingles long or more, that have their least hash at one place form one compact
window; a Cartesian tree over the hashes lists these windows, some 2 / SHORTEST of them a shingle. Two similar
passages share their least shingle under most hash functions, so they meet at the places where windows share it.

A passage of that length with a similarity of SIMILARITY has one word in fifty changed at most, so an unchanged run of
RUN_WORDS words stands on at least one side of a shared place. Places therefore meet by the run to their
right and the run to their left, and not by the shingle alone: a frequent phrase in unlike texts then meets nothing.
Places that give no passage with the first text of their run meet again by longer windows around it.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart.llm.components import components
from starmart.llm.filters import that_may_be_in
from starmart.llm.text import slices, words_of
from starmart.sources.lake import scratch_folder

SHINGLE = 5
SIMILARITY = 0.8
#: Shingles in the shortest passage: fifty words.
SHORTEST = 46
HASHES = 3
#: Hash functions that must have found a stretch before it is verified.
ENOUGH = 1
RUN_WORDS = 15
#: Words looked at on either side of the places that two texts share.
MARGIN = 64
#: Words at either end of a window that must agree besides the run, where texts are tied a second time.
END_WORDS = 8
SEED = 42
#: Keys of longer windows that a task holds at once; those of one text may be more.
KEYS_HELD = 1 << 18

WORDS = "doc_id long, words binary"
ANCHORS = "key long, doc_id long, place int, found byte, leader long, leader_place int"
MET = "doc_id long, place int, source_id long, source_place int, found byte"
STRETCHES = "doc_id long, start int, source_id long, source_start int, span int"
PASSAGES = "doc_id long, start int, n_words int, source_id long, source_start int, source_words int, similarity double"

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """A fixed scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def run_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each run of `n` words."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        out = out * _ODD + words[k : k + len(out)].astype(np.uint64) + np.uint64(1)
    return _mix(out)


def compact_windows(hashes: np.ndarray, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """(first, place of the least hash, last) of each compact window, by walking the Cartesian tree from its root."""
    out, todo = [], [(0, len(hashes))]
    while todo:
        first, end = todo.pop()
        if end - first >= shortest:
            place = first + int(hashes[first:end].argmin())
            out.append((first, place, end - 1))
            todo.append((first, place))
            todo.append((place + 1, end))
    return out


def word_hashes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, words): the lower-cased words of each text, 32 bits of hash a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                split = words_of(part.column("text"))
                coded = split.values.dictionary_encode()
                known = np.array([xxhash.xxh32_intdigest(w, SEED) for w in coded.dictionary.to_pylist()], "<u4")
                raw = memoryview(known[coded.indices.to_numpy()].tobytes() if len(known) else b"")
                ends = 4 * split.ends
                cut = [bytes(raw[e - 4 * n : e]) for e, n in zip(ends.tolist(), split.counts.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(cut, pa.binary())], ["doc_id", "words"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, WORDS)


def places_of(words: np.ndarray, shortest: int, hashes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, hash of the run there, bits of the hash functions that chose it) of a text's meeting places."""
    shingles, runs = run_hashes(words, SHINGLE), run_hashes(words, RUN_WORDS)
    chosen = np.zeros(len(runs), np.int8)
    back = RUN_WORDS - SHINGLE
    for k in range(hashes if len(runs) else 0):
        hashed = _mix(shingles ^ np.uint64(xxhash.xxh64_intdigest(bytes([k]), SEED)))
        least = np.array([c for _, c, _ in compact_windows(hashed, shortest)], np.int64)
        for at in (least, least - back):
            chosen[at[(at >= 0) & (at < len(runs))]] |= 1 << k
    at = np.flatnonzero(chosen)
    keys = runs[at]
    # Of one run that returns every few words, as in repeated words, a place a margin is enough.
    order = np.lexsort((at, keys))
    same = np.zeros(len(at), bool)
    same[order[1:]] = (keys[order[1:]] == keys[order[:-1]]) & (at[order[1:]] - at[order[:-1]] < shortest // 2)
    keep = ~same | (at % (shortest // 2) == 0)
    return at[keep], keys[keep], chosen[at[keep]]


def led(key: np.ndarray, doc: np.ndarray, place: np.ndarray, bits: np.ndarray) -> pa.RecordBatch:
    """ANCHORS rows of these places, each tied to the first of its key; the first has no leader."""
    order = np.lexsort((place, doc, key))
    doc, place, key, bits = doc[order], place[order].astype(np.int32), key[order], bits[order]
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    lead = np.flatnonzero(first)[np.cumsum(first) - 1] if len(key) else np.zeros(0, np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(key.view(np.int64)), pa.array(doc), pa.array(place), pa.array(bits),
            pa.array(doc[lead], mask=first), pa.array(place[lead], mask=first),
        ],
        ["key", "doc_id", "place", "found", "leader", "leader_place"],
    )


def anchors(words: DataFrame, shortest: int = SHORTEST, hashes: int = HASHES) -> DataFrame:
    """Meeting places of all texts, those of a run that a task met before already tied to the first such place.

    A row without a leader is the first of its run in its batch of texts; a run thus leaves a batch once, however
    many texts share it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, places, keys, found = [], [], [], []
            raw = batch.column("words")
            for k, doc in enumerate(batch.column("doc_id").to_pylist()):
                at, key, bits = places_of(np.frombuffer(raw[k].as_buffer(), "<u4"), shortest, hashes)
                docs.append(np.full(len(at), doc, np.int64))
                places.append(at)
                keys.append(key)
                found.append(bits)
            if not docs:
                continue
            yield led(*(np.concatenate(x) for x in (keys, docs, places, found)))

    return words.mapInArrow(run, ANCHORS)


def meetings(found: DataFrame) -> DataFrame:
    """(doc_id, place, source_id, source_place, found): each place tied to the first place of its run.

    Texts' first places meet across batches in one shuffle, sorted by run, and are read in a stream: a task holds one
    row of the run it is in.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (None, 0, 0)
        for batch in batches:
            key, doc, place = (batch.column(c).to_numpy() for c in ("key", "doc_id", "place"))
            if not len(key):
                continue
            first = np.ones(len(key), bool)
            first[1:] = key[1:] != key[:-1]
            goes_on = held[0] == key[0]
            first[0] = not goes_on
            lead = np.cumsum(first) - 1
            heads = np.flatnonzero(first)
            source = np.append(doc[heads], held[1])[lead]
            source_place = np.append(place[heads], held[2])[lead]
            tied = ~first
            held = (key[-1], int(source[-1]), int(source_place[-1]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc[tied]), pa.array(place[tied]), pa.array(source[tied]), pa.array(source_place[tied].astype(np.int32)),
                    batch.column("found").filter(pa.array(tied)),
                ],
                ["doc_id", "place", "source_id", "source_place", "found"],
            )

    heads = found.where("leader IS NULL").select("key", "doc_id", "place", "found")
    across = heads.repartition("key").sortWithinPartitions("key", "doc_id", "place").mapInArrow(run, MET)
    inside = found.where("leader IS NOT NULL").select(
        "doc_id", "place", F.col("leader").alias("source_id"), F.col("leader_place").alias("source_place"), "found"
    )
    return across.unionByName(inside).where("doc_id <> source_id")


def window_keys(words: np.ndarray, places: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, key) of windows of `shortest` words around the runs at `places`, two keys a window.

    One key is that of all its words: texts that share it share enough to be verified. The other is that of the run
    and of the window's ends, so that a word changed between them does not part two texts.
    """
    whole, ends, runs = run_hashes(words, shortest), run_hashes(words, END_WORDS), run_hashes(words, RUN_WORDS)
    last = shortest - RUN_WORDS
    at, keys = [], []
    # A passage is SHINGLE - 1 words longer than a window, so one of so many neighbouring windows lies within it.
    for back in sorted({*range(0, last + 1, SHINGLE), last}):
        first = places - back
        inside = (first >= 0) & (first < len(whole))
        own = first[inside]
        loose = (runs[places[inside]] * _ODD + ends[own]) * _ODD + ends[own + shortest - END_WORDS] + np.uint64(back)
        for key in (_mix(whole[own] + np.uint64(back)), _mix(loose)):
            at.append(places[inside])
            keys.append(key)
    return np.concatenate(at), np.concatenate(keys)


def tied_again(met: DataFrame, passages: DataFrame, words: DataFrame, shortest: int) -> DataFrame:
    """ANCHORS rows of the places whose tie gave no passage around them, and of their leaders, by longer keys.

    The leader of a run may hold no more of a passage than the run, as a text does that quotes a part. The others are
    then tied among themselves by windows of `shortest` words around the run, in which it has no part. A place
    gives a fixed number of rows, however many texts share its run.
    """
    done = passages.select("doc_id", "source_id", "start", (F.col("start") + F.col("n_words") - RUN_WORDS).alias("until"))
    m, d = met.alias("m"), done.alias("d")
    around = (
        (F.col("m.doc_id") == F.col("d.doc_id")) & (F.col("m.source_id") == F.col("d.source_id"))
        & F.col("m.place").between(F.col("d.start"), F.col("d.until"))
    )
    failed = m.join(d, around, "left_anti")
    side = F.explode(
        F.array(F.struct("doc_id", "place"), F.struct(F.col("source_id").alias("doc_id"), F.col("source_place").alias("place")))
    )
    folder = scratch_folder(words.sparkSession, "places")
    failed.select(side.alias("s")).select("s.*").groupBy("doc_id").agg(F.collect_set("place").alias("places")).write.parquet(folder)
    own = words.sparkSession.read.schema("doc_id long, places array<int>").parquet(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, places, keys, filled = [], [], [], 0

            def tied() -> pa.RecordBatch:
                doc = np.concatenate(docs)
                # Every hash function counts as having found these.
                return led(np.concatenate(keys), doc, np.concatenate(places), np.full(len(doc), 127, np.int8))

            raw, asked = batch.column("words"), batch.column("places")
            for k, doc in enumerate(batch.column("doc_id").to_pylist()):
                at, key = window_keys(np.frombuffer(raw[k].as_buffer(), "<u4"), np.asarray(asked[k].values, np.int64), shortest)
                docs.append(np.full(len(at), doc, np.int64))
                places.append(at)
                keys.append(key)
                filled += len(at)
                if filled >= KEYS_HELD:
                    yield tied()
                    docs, places, keys, filled = [], [], [], 0
            if docs:
                yield tied()

    asked = that_may_be_in(words, "doc_id", own.select("doc_id"))
    return asked.join(own, "doc_id").select("doc_id", "words", "places").mapInArrow(run, ANCHORS)


def stretches(met: DataFrame, enough: int = ENOUGH) -> DataFrame:
    """(doc_id, start, source_id, source_start, span): shared places of two texts that follow each other alike.

    Places of one pair on one diagonal, a margin apart at most, are one stretch, whichever hash function found
    them; those found by fewer than `enough` are dropped. Positions are words, margins not included.
    """
    ordered = met.repartition("doc_id").sortWithinPartitions("doc_id", "source_id", F.col("place") - F.col("source_place"), "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, place, source, source_place = (batch.column(c).to_numpy().astype(np.int64) for c in ("doc_id", "place", "source_id", "source_place"))
            if not len(doc):
                continue
            shift = place - source_place
            new = np.ones(len(doc), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (source[1:] != source[:-1]) | (shift[1:] != shift[:-1]) | (place[1:] - place[:-1] > MARGIN)
            at = np.flatnonzero(new)
            last = np.append(at[1:], len(doc)) - 1
            bits = np.bitwise_or.reduceat(batch.column("found").to_numpy(), at)
            keep = np.bitwise_count(bits) >= enough
            at, last = at[keep], last[keep]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc[at]), pa.array(place[at].astype(np.int32)), pa.array(source[at]), pa.array(source_place[at].astype(np.int32)),
                    pa.array((place[last] - place[at] + RUN_WORDS).astype(np.int32)),
                ],
                ["doc_id", "start", "source_id", "source_start", "span"],
            )

    return ordered.mapInArrow(run, STRETCHES)


def covered(inside: np.ndarray, shortest: int, similarity: float) -> list[tuple[int, int]]:
    """[first, end) of shingles in stretches, each `shortest` of which are similar enough, trimmed to shared ones."""
    if len(inside) < shortest:
        return []
    running = np.concatenate([[0], np.cumsum(inside)])
    shared = running[shortest:] - running[:-shortest]
    good = np.flatnonzero(shared >= 2 * similarity / (1 + similarity) * shortest - 1e-9)
    out: list[tuple[int, int]] = []
    for k in good.tolist():
        if out and k <= out[-1][1]:
            out[-1] = (out[-1][0], k + shortest)
        else:
            out.append((k, k + shortest))
    trimmed = []
    for first, end in out:
        at = np.flatnonzero(inside[first:end])
        trimmed.append((first + int(at[0]), first + int(at[-1]) + 1))
    return trimmed


def matched(own: np.ndarray, other: np.ndarray) -> np.ndarray:
    """For each shingle of `own` its place in `other`, -1 without one.

    Of several places the one that goes on from the shingle before is taken, or else the nearest to where that leads.
    """
    order = np.argsort(other, kind="stable")
    held = other[order]
    low, high = np.searchsorted(held, own, "left").tolist(), np.searchsorted(held, own, "right").tolist()
    places, out, shift = order.tolist(), np.full(len(own), -1, np.int64), 0
    for k, (first, end) in enumerate(zip(low, high, strict=True)):
        if first < end:
            at = bisect_left(places, k + shift, first, end)
            near = places[max(at - 1, first) : min(at + 1, end)]
            out[k] = min(near, key=lambda p: abs(p - k - shift))
            shift = int(out[k]) - k
    return out


def alike(own: np.ndarray, other: np.ndarray) -> tuple[int, float]:
    """(shingles that both have, similarity) as sets."""
    mine, theirs = np.unique(own), np.unique(other)
    both = len(np.intersect1d(mine, theirs, assume_unique=True))
    return both, both / (len(mine) + len(theirs) - both)


def similar_parts(a: np.ndarray, b: np.ndarray, shortest: int, similarity: float) -> list[tuple[int, int, int, int, float]]:
    """(start, words, start, words, similarity) of passages of `a` and `b` that are similar enough as sets of shingles.

    A stretch of `a` whose shingles stand in `b` is one passage if the densest stretch of `b` that holds them is similar
    enough. Otherwise it is split where the place in `b` jumps, and the longest runs of parts that are similar
    enough by themselves are passages.
    """
    own, other = run_hashes(a, SHINGLE), run_hashes(b, SHINGLE)
    least = 2 * similarity / (1 + similarity) * shortest - 1e-9
    out = []
    for first, end in covered(np.isin(own, other), shortest, similarity):
        there = np.flatnonzero(np.isin(other, own[first:end]))
        # The densest stretch of the other text that holds them.
        splits = np.flatnonzero(np.diff(there) > shortest)
        best = max(np.split(there, splits + 1), key=len)
        start, stop = int(best[0]), int(best[-1]) + 1
        value = alike(own[first:end], other[start:stop])[1]
        if value >= similarity:
            out.append((first, end - first + SHINGLE - 1, start, stop - start + SHINGLE - 1, value))
            continue
        place = matched(own[first:end], other)
        at = np.flatnonzero(place >= 0)
        jumps = np.flatnonzero(np.diff(place[at] - at)) + 1
        heads, tails = np.append(0, jumps), np.append(jumps, len(at)) - 1
        reached = -1
        for p in range(len(heads)):
            low, high = np.minimum.accumulate(place[at[heads[p:]]]), np.maximum.accumulate(place[at[tails[p:]]])
            for q in range(len(heads) - 1, max(p, reached + 1) - 1, -1):
                # No part of fewer shared places can be similar enough.
                if tails[q] - heads[p] + 1 < similarity * shortest:
                    break
                start, stop = int(low[q - p]), int(high[q - p]) + 1
                mine = own[first + at[heads[p]] : first + at[tails[q]] + 1]
                both, value = alike(mine, other[start:stop])
                if value >= similarity and (len(mine) >= shortest or both >= least):
                    out.append((first + int(at[heads[p]]), len(mine) + SHINGLE - 1, start, stop - start + SHINGLE - 1, value))
                    reached = q
                    break
    return out


def verified(asked: DataFrame, words: DataFrame, shortest: int, similarity: float) -> DataFrame:
    """The passages in the stretches: PASSAGES rows.

    The words of both sides are cut from the texts in one join, by text, whose long side adaptive execution can
    split where one text is the source of very many; then the two sides of a stretch meet by its number.
    """
    spark = asked.sparkSession
    folder = scratch_folder(spark, "passages")
    numbered = asked.distinct().withColumn("n", F.monotonically_increasing_id())
    kind = f"{STRETCHES}, n long"
    numbered.write.parquet(f"{folder}/asked")
    held = spark.read.schema(kind).parquet(f"{folder}/asked")
    sides = held.select(
        "n",
        "span",
        F.explode(
            F.array(
                F.struct(F.col("doc_id"), F.col("start"), F.lit(True).alias("own")),
                F.struct(F.col("source_id").alias("doc_id"), F.col("source_start").alias("start"), F.lit(False).alias("own")),
            )
        ).alias("side"),
    ).select("n", "span", "side.*")
    first = F.greatest(F.col("start") - MARGIN, F.lit(0))
    size = F.col("start") + F.col("span") + MARGIN - first
    asked = that_may_be_in(words, "doc_id", sides.select("doc_id"))
    cut = sides.join(asked, "doc_id").select(
        "n", "own", "doc_id", first.alias("first"), F.substring("words", 4 * first + 1, 4 * size).alias("cut")
    )
    paired = cut.repartition("n").sortWithinPartitions("n", "own")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split(" ")[0] for f in PASSAGES.split(", ")]
        kinds = [{"long": pa.int64(), "int": pa.int32(), "double": pa.float64()}[f.split(" ")[1]] for f in PASSAGES.split(", ")]
        source = None
        for batch in batches:
            rows = []
            for n, own, doc, at, raw in zip(*(batch.column(c).to_pylist() for c in ("n", "own", "doc_id", "first", "cut")), strict=True):
                side = (n, doc, at, np.frombuffer(raw, "<u4"))
                if not own:
                    source = side
                elif source and source[0] == n:
                    for start, size, other, theirs, value in similar_parts(side[3], source[3], shortest, similarity):
                        rows.append((doc, at + start, size, source[1], source[2] + other, theirs, value))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return paired.mapInArrow(run, PASSAGES)


def repeated_passages(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shortest: int = SHORTEST,
    similarity: float = SIMILARITY,
    hashes: int = HASHES,
    enough: int = ENOUGH,
) -> DataFrame:
    """PASSAGES rows: a passage of `doc_id` that is similar to one of a smaller `source_id`.

    Each place where texts meet is tied to its first text, not to all others, so a passage in n texts gives n - 1
    rows about; places that give no passage with that text are tied once more by longer windows. Every text that shares a passage has a row or is the source of one. Positions and lengths count words
    (runs of other than ASCII white space). Similarity is that of the sets of five-word shingles. Null texts are
    empty; rows without an id are not searched; rows that share an id are one text, the one of the least digest, and
    others are not searched; an empty table gives an empty result.
    """
    spark: SparkSession = docs.sparkSession
    folder = scratch_folder(spark, "compact-windows")
    word_hashes(searched(docs, doc_id, text), doc_id, text).write.option("compression", "zstd").parquet(f"{folder}/words")
    words = spark.read.schema(WORDS).parquet(f"{folder}/words")
    anchors(words, shortest, hashes).write.option("compression", "zstd").parquet(f"{folder}/anchors")
    meetings(spark.read.schema(ANCHORS).parquet(f"{folder}/anchors")).write.option("compression", "zstd").parquet(f"{folder}/met")
    met = spark.read.schema(MET).parquet(f"{folder}/met")
    stretches(met, enough).distinct().write.parquet(f"{folder}/stretches")
    asked = spark.read.schema(STRETCHES).parquet(f"{folder}/stretches")
    verified(asked, words, shortest, similarity).write.parquet(f"{folder}/passages")
    passages = spark.read.schema(PASSAGES).parquet(f"{folder}/passages")
    tied_again(met, passages, words, shortest).write.option("compression", "zstd").parquet(f"{folder}/anchors-again")
    again = stretches(meetings(spark.read.schema(ANCHORS).parquet(f"{folder}/anchors-again")), enough).distinct()
    again.join(asked, again.columns, "left_anti").write.parquet(f"{folder}/stretches-again")
    asked = spark.read.schema(STRETCHES).parquet(f"{folder}/stretches-again")
    verified(asked, words, shortest, similarity).write.parquet(f"{folder}/passages-again")
    return passages.unionByName(spark.read.schema(PASSAGES).parquet(f"{folder}/passages-again")).distinct()


def searched(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows with an id; of those that share one, a row of the least digest."""
    rows = docs.where(F.col(doc_id).isNotNull())
    least = F.min(F.xxhash64(text)).alias("__least")
    twice = rows.groupBy(doc_id).agg(F.count("*").alias("__n"), least).where("__n > 1").select(doc_id, "__least")
    if twice.isEmpty():
        return rows
    again = rows.join(twice, doc_id).where(F.xxhash64(text) == F.col("__least")).drop("__least").dropDuplicates([doc_id])
    return rows.join(twice, doc_id, "left_anti").unionByName(again)


def spans(passages: DataFrame) -> DataFrame:
    """(doc_id, spans array<struct<start, n_words>>): the passages of each text that a smaller id has, overlaps merged.

    Equal starts combine before the shuffle, so a text sends at most a row a word.
    """
    ends = passages.groupBy("doc_id", "start").agg(F.max(F.col("start") + F.col("n_words")).alias("end"))
    order = Window.partitionBy("doc_id").orderBy("start")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = ends.withColumn("new", F.when(F.col("start") <= reached, 0).otherwise(1))
    numbered = marked.withColumn("k", F.sum("new").over(order))
    merged = numbered.groupBy("doc_id", "k").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    row = F.struct("start", (F.col("end") - F.col("start")).alias("n_words"))
    return merged.groupBy("doc_id").agg(F.array_sort(F.collect_list(row)).alias("spans"))


def classes(passages: DataFrame, docs: DataFrame | None = None, doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, component_id, n_links, spans) per text that shares a passage, or per row of `docs`.

    component_id is the smallest id that a chain of shared passages reaches, the text's own included. n_links is the
    number of texts that a row of `passages` ties this one to: the first text that has a passage is tied to all that have it,
    these to the first. spans are its passages that a smaller id has too, by word. Of `docs`, rows without a
    passage have their own id, no link and no spans; rows that share an id have the same result; those without one
    have no component.
    """
    spark, folder = passages.sparkSession, scratch_folder(passages.sparkSession, "passage-links")
    passages.select(F.col("doc_id").alias("a"), F.col("source_id").alias("b")).distinct().write.parquet(folder)
    held = spark.read.schema("a long, b long").parquet(folder)
    both = held.unionAll(held.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counted = both.groupBy(F.col("a").alias("doc_id")).agg(F.count("*").alias("n_links"))
    found = components(held).withColumnRenamed("node", "doc_id").join(counted, "doc_id").join(spans(passages), "doc_id", "left")
    empty = F.expr("CAST(array() AS array<struct<start: int, n_words: int>>)")
    if docs is not None:
        found = docs.select(F.col(doc_id).cast("long").alias("doc_id")).join(found, "doc_id", "left")
    return found.select(
        "doc_id",
        F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("spans", empty).alias("spans"),
    )


def without_spans(docs: DataFrame, found: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with the spans (doc_id, spans) cut from their texts; a text that is all spans goes with its row.

    Texts without a span stay as they are, and so do rows that are not searched for sharing an id.
    """
    own = searched(docs.select(doc_id, text), doc_id, text).select(doc_id, F.xxhash64(text).alias("__digest"))
    cuts = found.select(doc_id, F.col("spans").alias("__spans")).join(own, doc_id)
    rows = docs.withColumn("__digest", F.xxhash64(text)).join(cuts, [doc_id, "__digest"], "left")
    # A word with the white space before it; the k-th such piece is the k-th word.
    pieces = F.regexp_extract_all(F.concat(F.lit(" "), F.col(text)), F.lit("[ \\t-\\r]+[^ \\t-\\r]+"), F.lit(0))
    kept = F.array_join(
        F.filter(pieces, lambda p, k: ~F.exists("__spans", lambda s: (k >= s["start"]) & (k < s["start"] + s["n_words"]))), ""
    )
    cut = F.coalesce(F.size("__spans") > 0, F.lit(False))
    out = rows.withColumn(text, F.when(cut, F.regexp_replace(kept, "^[ \\t-\\r]+", "")).otherwise(F.col(text)))
    return out.where(~cut | (F.length(text) > 0)).select(*docs.columns)
