"""SimHash near-duplicates, linked exactly by vantage-point trees over fingerprint halves."""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.components import components, forest
from starmart.llm.text import slices, within, words_of
from starmart.sources.lake import scratch_folder

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
#: Fingerprints a shard is meant to hold. Larger ones are compared block by block.
SHARD_ROWS = 8192
#: Distinct fingerprint halves that the top of a tree is fitted on; the tree's shape touches cost only.
SAMPLE_ROWS = 65536
LEAF = 128
HELD_LINKS = 1 << 20


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp): the 64-bit SimHash of each whole text, as a signed long.

    Shingles are runs of `words` lower-cased words, repeats included, joined by a space; a text with
    fewer words is one shingle; one without words, empty or null, has fingerprint 0. A bit is set if it is
    set in over half of the shingles' XXH64 (seed 42). Repeated rows give repeated rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                fp = _fingerprint(part.column("text"), words)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def _fingerprint(texts: pa.Array, words: int) -> np.ndarray:
    split = words_of(texts)
    empty, space = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
    spaced = pc.binary_join_element_wise(split.values, empty, space)
    _, offsets, data = spaced.buffers()
    at = np.frombuffer(offsets, np.int64)[spaced.offset : spaced.offset + len(spaced) + 1] if len(spaced) else np.zeros(1, np.int64)
    blob = data.to_pybytes() if data else b""
    shingles = np.where(split.counts >= words, split.counts - words + 1, np.minimum(split.counts, 1))
    first = np.repeat(split.ends - split.counts, shingles) + within(shingles)
    last = np.minimum(first + words, np.repeat(split.ends, shingles))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(blob[a:b], SEED) for a, b in zip(at[first].tolist(), (at[last] - 1).tolist(), strict=True)),
        np.uint64,
        len(first),
    )
    out = np.zeros(len(texts), np.uint64)
    some = np.flatnonzero(shingles)
    if len(some):
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        starts = (np.cumsum(shingles) - shingles)[some]
        ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        set_bits = 2 * ones > shingles[some][:, None]
        out[some] = np.packbits(set_bits, axis=1).reshape(-1).view(">u8").astype(np.uint64)
    return out


class Node(NamedTuple):
    """Inside: points at distance `near` or less of `point` are on the left. A leaf has a shard number only."""

    point: int = 0
    near: int = 0
    left: Node | None = None
    right: Node | None = None
    shard: int = -1


def fit(values: np.ndarray, depth: int) -> tuple[Node, int]:
    """A vantage-point tree of at most 2**depth leaves over 32-bit values; returns it and its number of leaves."""
    leaves = 0
    draw = np.random.default_rng(SEED)

    def grow(own: np.ndarray, levels: int) -> Node:
        nonlocal leaves
        if levels and len(own) >= 16:
            cut = _best_cut(own, draw)
            if cut is not None:
                point, near, inside = cut
                return Node(point, near, grow(own[inside], levels - 1), grow(own[~inside], levels - 1))
        leaves += 1
        return Node(shard=leaves - 1)

    return grow(values, depth), leaves


def _best_cut(own: np.ndarray, draw: np.random.Generator, tries: int = 5) -> tuple[int, int, np.ndarray] | None:
    """Of a few vantage points and distances near the median, the one with fewest points at the boundary."""
    best, found = math.inf, None
    for point in draw.choice(own, tries):
        d = np.bitwise_count(own ^ point).astype(np.int64)
        rings = np.bincount(d, minlength=34)
        middle = int(np.median(d))
        for near in range(max(0, middle - 2), min(32, middle + 2)):
            inner = int(rings[: near + 1].sum())
            if 0 < inner < len(own):
                unequal = abs(2 * inner - len(own)) / len(own)
                cost = (rings[near] + rings[near + 1]) / len(own) + unequal / 2
                if cost < best:
                    best, found = cost, (int(point), near, d <= near)
    return found


def _reached(tree: Node, values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shard, is home) for each shard that the ball of `radius` around a value can reach."""
    rows, shards, homes = [], [], []

    def down(node: Node, at: np.ndarray, home: np.ndarray) -> None:
        if not len(at):
            return
        if node.left is None:
            rows.append(at)
            shards.append(np.full(len(at), node.shard))
            homes.append(home)
            return
        d = np.bitwise_count(values[at] ^ np.uint32(node.point)).astype(np.int64)
        inside = d <= node.near
        goes = d - radius <= node.near
        down(node.left, at[goes], (home & inside)[goes])
        goes = d + radius > node.near
        down(node.right, at[goes], (home & ~inside)[goes])

    down(tree, np.arange(len(values)), np.ones(len(values), bool))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    return np.concatenate(rows), np.concatenate(shards), np.concatenate(homes)


def near_links(homes: np.ndarray, asked: np.ndarray, shift: int, radius: int, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of 64-bit values within `bits`, found by descending a vantage-point tree of `homes`.

    Both sides go down together: the tree of a half (`shift` says which) is cut until few homes are left, and a
    queried value follows each side that its ball reaches.
    """
    draw = np.random.default_rng(SEED)
    h, q = [(x >> np.uint64(shift)).astype(np.uint32) for x in (homes, asked)]
    todo = [(np.arange(len(homes)), np.arange(len(asked)))]
    while todo:
        hi, qi = todo.pop()
        if not len(hi) or not len(qi):
            continue
        cut = _best_cut(h[hi], draw, 3) if len(hi) > LEAF else None
        if cut is not None:
            point, near, inside = cut
            d = np.bitwise_count(q[qi] ^ np.uint32(point)).astype(np.int64)
            todo.append((hi[inside], qi[d - radius <= near]))
            todo.append((hi[~inside], qi[d + radius > near]))
            continue
        step = max(1, (1 << 20) // len(qi))
        for k in range(0, len(hi), step):
            own = hi[k : k + step]
            a, b = np.nonzero(np.bitwise_count(homes[own][:, None] ^ asked[qi][None, :]) <= bits)
            if len(a):
                yield own[a], qi[b]


def links(nodes: DataFrame, bits: int = MAX_BITS, shard_rows: int = SHARD_ROWS, sample: int = SAMPLE_ROWS) -> DataFrame:
    """(a, b): enough links between nodes (fp, rep) of distinct fingerprints to connect all within `bits`.

    Two fingerprints that differ in `bits` bits differ in at most half as many in one 32-bit half. So each half has
    a vantage-point tree, searched with that smaller radius, which its triangle bounds prune well; what they leave
    is compared over all 64 bits. Each fingerprint lives in one shard of a tree and visits the shards that its
    ball overlaps. A shard of more rows than meant (a dense group) is cut into blocks, each pair of which is a task
    of its own, so no task grows with a group. A task returns a spanning forest of its links, not the pairs.
    """
    spark, radius = nodes.sparkSession, bits // 2
    n = nodes.count()
    depth = max(0, math.ceil(math.log2(max(1, n / shard_rows))))
    trees = []
    for shift in (32, 0):
        half = F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit(0xFFFFFFFF))
        seen = nodes.select(half.alias("half")).distinct().orderBy(F.xxhash64("half")).limit(sample).toArrow() if depth else None
        values = seen["half"].to_numpy().astype(np.uint32) if depth else np.zeros(0, np.uint32)
        trees.append((shift, *fit(values, depth)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy().view(np.uint64)
            for k, (shift, tree, _) in enumerate(trees):
                row, shard, home = _reached(tree, (fp >> np.uint64(shift)).astype(np.uint32), radius)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(row), k, np.int32)),
                        pa.array(shard.astype(np.int32)),
                        pa.array(home),
                        batch.column("fp").take(pa.array(row)),
                        batch.column("rep").take(pa.array(row)),
                    ],
                    ["tree", "shard", "home", "fp", "rep"],
                )

    kind = "tree int, shard int, home boolean, fp long, rep long"
    folder = scratch_folder(spark, "simhash-shards")
    nodes.select("fp", "rep").mapInArrow(place, kind).write.parquet(folder)
    placed = spark.read.schema(kind).parquet(folder)
    # One row per shard: as many as the trees have leaves, at most twice the sample.
    sizes = placed.groupBy("tree", "shard").agg(F.count_if("home").alias("homes"), F.count("*").alias("asked")).collect()
    cuts = {(r.tree, r.shard): (-(-r.homes // (2 * shard_rows)) or 1, -(-r.asked // (16 * shard_rows)) or 1) for r in sizes}
    hot = {k: v for k, v in cuts.items() if v != (1, 1)}
    spread = placed.withColumns({"i": F.lit(0), "j": F.lit(0), "as_home": F.col("home"), "as_asked": F.lit(True)})
    if hot:
        blocks = spark.createDataFrame([(*k, *v) for k, v in hot.items()], "tree int, shard int, m int, k int")
        dense = placed.join(F.broadcast(blocks), ["tree", "shard"])
        own_i, own_j = F.pmod(F.xxhash64("fp"), "m").cast("int"), F.pmod(F.xxhash64("fp", F.lit(1)), "k").cast("int")
        as_home = dense.where("home").withColumns({"i": own_i, "j": F.explode(F.sequence(F.lit(0), F.col("k") - 1))})
        as_asked = dense.withColumns({"j": own_j, "i": F.explode(F.sequence(F.lit(0), F.col("m") - 1))})
        spread = (
            spread.join(F.broadcast(blocks), ["tree", "shard"], "left_anti")
            .unionByName(as_home.drop("m", "k").withColumns({"as_home": F.lit(True), "as_asked": F.lit(False)}))
            .unionByName(as_asked.drop("m", "k").withColumns({"as_home": F.lit(False), "as_asked": F.lit(True)}))
        )
    shifts = [t[0] for t in trees]

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        fp, rep = rows["fp"].to_numpy().view(np.uint64), rows["rep"].to_numpy()
        values, back = np.unique(fp, return_inverse=True)
        reps = np.zeros(len(values), np.int64)
        reps[back] = rep
        home, asked = [np.unique(back[rows[c].to_numpy(dtype=bool)]) for c in ("as_home", "as_asked")]
        held_a, held_b, held = [], [], 0
        label = np.arange(len(values))
        for a, b in near_links(values[home], values[asked], shifts[key[0]], radius, bits):
            a, b = home[a], asked[b]
            keep = a != b
            held_a.append(a[keep])
            held_b.append(b[keep])
            held += int(keep.sum())
            if held > HELD_LINKS:
                label = forest(*_with(label, held_a, held_b), len(values))
                held_a, held_b, held = [], [], 0
        label = forest(*_with(label, held_a, held_b), len(values))
        child = np.flatnonzero(label != np.arange(len(values)))
        return pd.DataFrame({"a": reps[child], "b": reps[label[child]]})

    return spread.groupBy("tree", "shard", "i", "j").applyInPandas(compare, "a long, b long")


def _with(label: np.ndarray, a: list[np.ndarray], b: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate([np.arange(len(label)), *a]), np.concatenate([label, *b])


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = SHINGLE_WORDS,
    bits: int = MAX_BITS,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of `docs`.

    Texts are linked if their fingerprints differ in at most `bits` bits; component_id is the smallest doc_id that a
    chain of links reaches, the document's own included. Equal fingerprints are one node, so copies cost nothing.
    Repeated rows give repeated rows; a null doc_id takes part in no link but shares the component of its
    fingerprint; an empty table gives an empty result.
    """
    spark: SparkSession = docs.sparkSession
    folder = scratch_folder(spark, "simhash")
    fingerprints(docs, doc_id, text, words).write.parquet(f"{folder}/docs")
    own = spark.read.schema("doc_id long, fp long").parquet(f"{folder}/docs")
    own.groupBy("fp").agg(F.min("doc_id").alias("rep")).write.parquet(f"{folder}/nodes")
    nodes = spark.read.schema("fp long, rep long").parquet(f"{folder}/nodes")
    linked = components(links(nodes.where("rep IS NOT NULL"), bits, shard_rows))
    classes = nodes.join(linked, nodes["rep"] == linked["node"], "left").select(
        "fp", F.coalesce("component", "rep").alias("component_id")
    )
    return own.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
