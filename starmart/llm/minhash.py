"""MinHash near-duplicates: universal hash minima, banding, signatures, and full sets of shingles."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.components import forest
from starmart.llm.filters import id_filter, let_through, that_may_be_in
from starmart.llm.stars import components
from starmart.llm.text import slices, within, words_of
from starmart.sources.lake import scratch_folder

SHINGLE_WORDS = 2
PERCENT = 80
#: Two sets with similarity 0.8 share no band with probability (1 - 0.8**ROWS)**BANDS, 1.3e-5.
BANDS, ROWS = 48, 7
#: Standard deviations by which a signature may fall short of the similarity asked for.
DEVIATIONS = 5
SEED = 42
#: Rows and bytes of a side that one task compares.
BLOCK = 4096
BLOCK_BYTES = 1 << 25


class Hashes(NamedTuple):
    """h -> factor * h + offset modulo 2**64, one for each row of a signature, and what folds a band into a key."""

    factor: np.ndarray
    offset: np.ndarray
    fold: np.ndarray


def hashes(bands: int = BANDS, rows: int = ROWS) -> Hashes:
    draw = np.random.default_rng(SEED)
    odd = lambda n: draw.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return Hashes(odd(bands * rows), odd(bands * rows), odd(bands * rows).reshape(bands, rows))


def shingle_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, how many per text): the XXH64 of each text's different shingles, ascending, end to end.

    A shingle is a run of `words` lower-cased words, joined by a space; a text with fewer is one shingle, one without
    words has none.
    """
    split = words_of(texts)
    empty, space = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
    spaced = pc.binary_join_element_wise(split.values, empty, space)
    _, offsets, data = spaced.buffers()
    at = np.frombuffer(offsets, np.int64)[spaced.offset : spaced.offset + len(spaced) + 1] if len(spaced) else np.zeros(1, np.int64)
    blob = data.to_pybytes() if data else b""
    n = np.where(split.counts >= words, split.counts - words + 1, np.minimum(split.counts, 1))
    first = np.repeat(split.ends - split.counts, n) + within(n)
    last = np.minimum(first + words, np.repeat(split.ends, n))
    digest = xxhash.xxh64_intdigest
    spans = zip(at[first].tolist(), (at[last] - 1).tolist(), strict=True)
    values = np.fromiter((digest(blob[a:b], SEED) for a, b in spans), np.uint64, len(first))
    owner = np.repeat(np.arange(len(texts)), n)
    order = np.lexsort((values, owner))
    values = values[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[new], np.bincount(owner[new], minlength=len(texts))


def _digests(values: np.ndarray, counts: np.ndarray) -> list[bytes | None]:
    ends = np.cumsum(counts)
    return [xxhash.xxh128_digest(values[e - n : e].tobytes()) if n else None for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]


def signatures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n, digest, bands, signature) of each whole text.

    n: different shingles. digest: of the set, null where it is empty. bands: a key for each band of `rows` minima.
    signature: the low byte of each minimum.
    """
    taken = hashes(bands, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                values, counts = shingle_sets(part.column("text"), words)
                some = np.flatnonzero(counts)
                minima = np.zeros((len(counts), bands * rows), np.uint64)
                starts = (np.cumsum(counts) - counts)[some]
                for k in range(bands * rows if len(some) else 0):
                    minima[some, k] = np.minimum.reduceat(values * taken.factor[k] + taken.offset[k], starts)
                keys = (minima.reshape(-1, bands, rows) * taken.fold).sum(axis=2, dtype=np.uint64)
                keys ^= keys >> np.uint64(32)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(counts) + 1, dtype=np.int32) * bands), pa.array(keys.reshape(-1).view(np.int64))
                )
                low = minima.astype(np.uint8)
                columns = [
                    part.column("doc_id"),
                    pa.array(counts.astype(np.int64)),
                    pa.array(_digests(values, counts), pa.binary()),
                    lists,
                    pa.array([r.tobytes() for r in low], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "digest", "bands", "signature"])

    kept = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return kept.mapInArrow(run, "doc_id long, n long, digest binary, bands array<long>, signature binary")


# --- links between rows that one task holds ---

Alike = Callable[[int, np.ndarray], np.ndarray]


def join_rows(label: np.ndarray, here: np.ndarray, there: np.ndarray, alike: Alike) -> tuple[list[int], list[int]]:
    """Enough links between rows `here` and rows `there` that those alike have one label.

    `alike(row, others)` says which of others the row is linked with. Rows of the largest label wait: each pair
    of rows with different labels has one outside it, which is compared with all of the other side.
    """
    label = np.unique(label, return_inverse=True)[1]
    waiting, a, b = here | there, [], []
    while True:
        largest = np.bincount(label).argmax()
        todo = np.flatnonzero(waiting & (label != largest))
        if not len(todo):
            return a, b
        row = int(todo[0])
        waiting[row] = False
        others = np.zeros(len(label), bool)
        if here[row]:
            others |= there
        if there[row]:
            others |= here
        others = np.flatnonzero(others & (label != label[row]))
        if not len(others):
            continue
        met = others[alike(row, others)]
        if not len(met):
            continue
        joined, first = np.unique(label[met], return_index=True)
        a += [row] * len(first)
        b += met[first].tolist()
        label[np.isin(label, joined)] = label[row]


def by_signature(least: float) -> Callable[[list[bytes]], Alike]:
    """Rows are alike if at least this part of their signatures agrees."""

    def prepare(payload: list[bytes]) -> Alike:
        held = np.frombuffer(b"".join(payload), np.uint8).reshape(len(payload), -1)
        enough = least * held.shape[1]
        return lambda row, others: (held[others] == held[row]).sum(axis=1) >= enough

    return prepare


def by_set(percent: int) -> Callable[[list[bytes]], Alike]:
    """Rows are alike if the intersection of their sets is at least this percentage of the union."""

    def prepare(payload: list[bytes]) -> Alike:
        sizes = np.array([len(p) // 8 for p in payload])
        ends = np.cumsum(sizes)
        _, code = np.unique(np.frombuffer(b"".join(payload), np.uint64), return_inverse=True)
        owner = np.repeat(np.arange(len(payload)), sizes)
        order = np.argsort(code, kind="stable")
        holders = owner[order]
        count = np.bincount(code)
        begin = np.cumsum(count) - count

        def alike(row: int, others: np.ndarray) -> np.ndarray:
            own = code[ends[row] - sizes[row] : ends[row]]
            # All rows' shared shingles at once; a slice of the row's shingles at a time.
            common = np.zeros(len(payload), np.int64)
            step = max(1, (1 << 22) // len(payload))
            for k in range(0, len(own), step):
                part = own[k : k + step]
                places = np.repeat(begin[part], count[part]) + within(count[part])
                common += np.bincount(holders[places], minlength=len(payload))
            shared = common[others]
            return 100 * shared >= percent * (sizes[row] + sizes[others] - shared)

        return alike

    return prepare


def _linked(rows: DataFrame, prepare: Callable[[list[bytes]], Alike]) -> DataFrame:
    """(a, b) links between components in each (grp, x, y), where block x is compared with block y: stars, at most
    as many as there are components."""

    def compare(key: tuple, held: pd.DataFrame) -> pd.DataFrame:
        block, (comp, label) = held["block"].to_numpy(), np.unique(held["comp"].to_numpy(), return_inverse=True)
        a, b = join_rows(label, block == key[1], block == key[2], prepare(held["payload"].tolist()))
        low = forest(label[a], label[b], len(comp))
        moved = np.flatnonzero(low != np.arange(len(comp)))
        return pd.DataFrame({"a": comp[moved], "b": comp[low[moved]]}, dtype="int64")

    return rows.groupBy("grp", "x", "y").applyInPandas(compare, "a long, b long")


def _blocks(block: int) -> Column:
    """How many blocks the rows of a group are cut into."""
    return F.greatest(F.ceil(F.count("*") / block), F.ceil(F.sum(F.octet_length("payload")) / BLOCK_BYTES)).cast("int")


def _within_blocks(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Rows (grp, node, comp, payload) dealt to the blocks of `sizes` (grp, blocks), each compared with itself."""
    at = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    return rows.join(sizes, "grp").withColumn("block", at).withColumns({"x": F.col("block"), "y": F.col("block")})


def _with_first_block(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """The same blocks, the first of a group compared with each other one."""
    held = _within_blocks(rows, sizes.where("blocks > 1")).drop("x", "y")
    first = held.where("block = 0").withColumns({"x": F.lit(0), "y": F.explode(F.sequence(F.lit(1), F.col("blocks") - 1))})
    return first.unionByName(held.where("block > 0").withColumns({"x": F.lit(0), "y": F.col("block")}))


def _across_components(rows: DataFrame, block: int) -> DataFrame:
    """Groups that hold more than one component, dealt so that all pairs of rows of different ones meet.

    Rows outside a group's largest component are cut into `few` blocks, those of it into `many`; each of the few is
    compared with itself, with the later ones and with the many. So a large component with some strays costs
    its rows once for each block of strays.
    """
    parts = rows.groupBy("grp", "comp").agg(F.count("*").alias("n"), F.sum(F.octet_length("payload")).alias("bytes"))
    total = [F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.count("*").alias("parts")]
    groups = parts.groupBy("grp").agg(F.max(F.struct("n", "bytes", "comp")).alias("main"), *total)
    cut = lambda n, size: F.greatest(F.ceil(n / block), F.ceil(size / BLOCK_BYTES)).cast("int")
    groups = groups.where("parts > 1").select(
        "grp",
        F.col("main.comp").alias("main"),
        cut(F.col("n") - F.col("main.n"), F.col("bytes") - F.col("main.bytes")).alias("few"),
        cut(F.col("main.n"), F.col("main.bytes")).alias("many"),
    )
    spread = F.xxhash64("node")
    at = F.when(F.col("comp") == F.col("main"), F.col("few") + F.pmod(spread, F.col("many"))).otherwise(F.pmod(spread, F.col("few")))
    pairs = F.expr(
        """concat(transform(sequence(0, least(block, few - 1)), i -> struct(i AS x, block AS y)),
           CASE WHEN block < few THEN transform(sequence(block + 1, few + many - 1), i -> struct(block AS x, i AS y))
           ELSE array() END)"""
    )
    dealt = rows.join(groups, "grp").withColumn("block", at.cast("int")).withColumn("pair", F.explode(pairs))
    return dealt.select("grp", "node", "comp", "payload", "block", "pair.x", "pair.y")


# --- documents ---


def full_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(node, payload): the sets of the wanted nodes (node, rep, digest), from the texts. Only sets that are asked for move."""
    held = docs.sparkSession.sparkContext.broadcast(id_filter(wanted.select("rep")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pc.is_valid(batch.column("doc_id")))
            batch = batch.filter(let_through(held.value, batch.column("doc_id")))
            for part in slices(batch, "text"):
                values, counts = shingle_sets(part.column("text"), words)
                ends = np.cumsum(counts)
                sets = [values[e - n : e].tobytes() for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]
                columns = [part.column("doc_id"), pa.array(_digests(values, counts), pa.binary()), pa.array(sets, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["rep", "digest", "payload"])

    texts = docs.mapInArrow(run, "rep long, digest binary, payload binary")
    return texts.join(wanted, ["rep", "digest"]).select("node", "payload").dropDuplicates(["node"])


def _agree(edges: DataFrame, signature: DataFrame, least: float) -> DataFrame:
    """Edges (a, b) whose signatures agree in at least this part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) if batch.num_rows else np.zeros((0, 1))
                for c in ("of_a", "of_b")
            )
            keep = (left == right).mean(axis=1) >= least if batch.num_rows else np.zeros(0, bool)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    of = lambda c: signature.select(F.col("node").alias(c), F.col("signature").alias(f"of_{c}"))
    return edges.join(of("b"), "b").join(of("a"), "a").select("a", "b", "of_a", "of_b").mapInArrow(run, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = SHINGLE_WORDS,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
    block: int = BLOCK,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of `docs`.

    Two texts are linked if the intersection of their sets of shingles is at least `percent` of the union;
    component_id is the smallest doc_id that a chain of links reaches, the document's own included; kept says
    that it is the document's own. A text without words has an empty set and is linked with nothing.

    Equal sets are one node. Nodes that share a band are tied to the band's smallest node if their signatures agree
    (within DEVIATIONS of chance), and bands that then still hold more than one component are searched pair by
    pair, block by block, in tasks that return links, not pairs. What hangs together by signatures is
    compared by full sets in the same manner. Nothing is capped; the only loss is that of banding.

    Rows without a doc_id are not linked, have no component and are kept. Rows that share a doc_id are texts of their own;
    repeated rows give repeated rows; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    folder = scratch_folder(spark, "minhash")

    def kept(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{folder}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{folder}/{name}")

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    own = kept(signatures(source, "doc_id", "text", words, bands, rows), "signatures")
    groups = own.where("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest")
    nodes = groups.agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.first("signature").alias("signature"))
    nodes = kept(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")

    shared = nodes.select("node", F.posexplode("bands").alias("band", "hash"))
    shared = shared.select("node", F.xxhash64("band", "hash").alias("grp"))
    ends = [F.min("node").alias("a"), F.max("node").alias("b"), F.count("*").alias("n")]
    buckets = kept(shared.groupBy("grp").agg(*ends).where("n > 1"), "buckets")
    many = buckets.where("n > 2").select("grp", "a")
    members = kept(that_may_be_in(shared, "grp", many.select("grp")).join(many, "grp"), "members")
    tied = members.where("a <> node").select("a", F.col("node").alias("b")).unionAll(buckets.where("n = 2").select("a", "b"))
    tied = kept(tied.distinct(), "tied")
    least = percent / 100
    least -= DEVIATIONS * (least * (1 - least) / (bands * rows)) ** 0.5
    met = tied.select(F.col("a").alias("node")).unionAll(tied.select(F.col("b").alias("node")))
    marks = kept(that_may_be_in(nodes.select("node", "signature"), "node", met), "marks")
    loose = kept(_agree(tied, marks, least), "loose-0")

    def labelled(frame: DataFrame, classes: DataFrame) -> DataFrame:
        return frame.join(classes, "node", "left").withColumn("comp", F.coalesce("component", "node")).drop("component")

    def stars(classes: DataFrame) -> DataFrame:
        return classes.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))

    hanging = components(loose)
    open_bands = labelled(members.select("grp", "node"), hanging)
    unclear = open_bands.groupBy("grp").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select("grp")
    asked = kept(open_bands.join(unclear, "grp"), "open").join(marks.select("node", F.col("signature").alias("payload")), "node")
    more = kept(_linked(_across_components(asked, block), by_signature(least)), "loose-1")
    if not more.isEmpty():
        hanging = components(stars(hanging).unionAll(more))
    hanging = kept(hanging, "hanging")
    wanted = kept(nodes.join(hanging, "node").select("node", "rep", "digest"), "wanted")
    sets = full_sets(source, wanted, words).join(hanging, "node")
    sets = kept(sets.select("node", F.col("component").alias("grp"), "payload"), "sets")

    sizes = kept(sets.groupBy("grp").agg(_blocks(block).alias("blocks")), "sizes")
    alone = sets.withColumn("comp", F.col("node"))
    classes = components(kept(_linked(_within_blocks(alone, sizes), by_set(percent)), "links-0"))
    large = sizes.where("blocks > 1").select("grp")
    if not large.isEmpty():
        rest = kept(sets.join(large, "grp"), "large")
        links = kept(_linked(_with_first_block(labelled(rest, classes), sizes), by_set(percent)), "links-1")
        classes = components(stars(classes).unionAll(links))
        links = kept(_linked(_across_components(labelled(rest, classes), block), by_set(percent)), "links-2")
        classes = components(stars(classes).unionAll(links))

    found = kept(labelled(nodes.select("node", "rep", "digest"), classes), "found")
    smallest = found.groupBy("comp").agg(F.min("rep").alias("component_id"))
    lowest = found.join(smallest, "comp").select("digest", "component_id")
    least_id = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return (
        own.select("doc_id", "n", "digest")
        .join(lowest, "digest", "left")
        .select("doc_id", F.col("n").alias("n_shingles"), least_id.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
