"""Token-id files: static range asymmetric numeral systems over independent, interleaved blocks.

The file format is a Parquet table, so that Spark commits it whole, with a row per segment: some million
tokens of consecutive documents that share one frequency table. A segment's tokens are dealt to blocks; a block has
LANES interleaved coder states, a payload of 16-bit words, a checksum, and checkpoints (states and place in the
payload every STRIDE steps), from each of which it can be decoded independently of the rest.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart.llm.text import slices
from starmart.llm.tokens import BYTE_PIECES, definition_of, encoder, with_end
from starmart.sources.lake import scratch_folder

END_ID = 0
SCALE_BITS = 16
LOW = 1 << 16
LANES = 16
BLOCK_STEPS = 1024
STRIDE = 512
SEGMENT_TOKENS = 1 << 20
#: Text that is cut into pieces at once.
SLICE_BYTES = 2 << 20

FORMAT = (
    "part int, segment int, first long, n_tokens long, symbols binary, frequencies binary, steps int, "
    "blocks array<struct<payload: binary, crc32: long, states: binary, places: binary>>, "
    "doc_ids array<long>, doc_tokens array<long>"
)
ARROW_FORMAT = pa.schema(
    [
        ("part", pa.int32()), ("segment", pa.int32()), ("first", pa.int64()), ("n_tokens", pa.int64()),
        ("symbols", pa.binary()), ("frequencies", pa.binary()), ("steps", pa.int32()),
        ("blocks", pa.list_(pa.struct([("payload", pa.binary()), ("crc32", pa.int64()), ("states", pa.binary()), ("places", pa.binary())]))),
        ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())),
    ]
)


def frequencies(counts: np.ndarray, bits: int = SCALE_BITS) -> np.ndarray:
    """Counts scaled to a sum of 2**bits, each at least one."""
    whole = 1 << bits
    if len(counts) > whole:
        raise ValueError("more distinct symbols than the frequency scale can hold")
    scaled = np.maximum(1, counts.astype(np.int64) * whole // int(counts.sum()))
    order = np.argsort(-scaled, kind="stable")
    spare = whole - int(scaled.sum())
    if spare > 0:
        scaled[order[0]] += spare
    while spare < 0:
        give = np.minimum((scaled[order] + 1) // 2, scaled[order] - 1)
        taken = np.minimum(give, np.maximum(0, -spare - (np.cumsum(give) - give)))
        scaled[order] -= taken
        spare += int(taken.sum())
    return scaled


def encode(tokens: np.ndarray) -> dict:
    """A segment's table and blocks. All blocks and lanes advance together, a step at a time, from the end."""
    counts = np.bincount(tokens)
    symbols = np.flatnonzero(counts)
    code_of = np.zeros(len(counts), np.int64)
    code_of[symbols] = np.arange(len(symbols))
    codes, scaled = code_of[tokens], frequencies(counts[symbols])
    n = len(tokens)
    blocks = max(1, -(-n // (BLOCK_STEPS * LANES)))
    steps = -(-n // (blocks * LANES))
    padded = np.full(blocks * steps * LANES, int(np.argmax(scaled)), np.int64)
    padded[:n] = codes
    cube = np.ascontiguousarray(padded.reshape(blocks, steps, LANES).transpose(1, 0, 2)).reshape(steps, -1)
    freq = scaled.astype(np.uint64)
    start = (np.cumsum(scaled) - scaled).astype(np.uint64)
    x = np.full(blocks * LANES, LOW, np.uint64)
    words = np.zeros((steps, blocks * LANES), "<u2")
    sent = np.zeros((steps, blocks * LANES), bool)
    marks = range(0, steps, STRIDE)
    states = np.zeros((len(marks), blocks * LANES), "<u4")
    shift, sixteen = np.uint64(SCALE_BITS), np.uint64(16)
    for t in range(steps - 1, -1, -1):
        f = freq[cube[t]]
        over = x >= f << sixteen
        words[t] = x
        sent[t] = over
        x = np.where(over, x >> sixteen, x)
        quotient = x // f
        x = (quotient << shift) + (x - quotient * f) + start[cube[t]]
        if t % STRIDE == 0:
            states[t // STRIDE] = x
    out = []
    for b in range(blocks):
        own = slice(b * LANES, (b + 1) * LANES)
        payload = words[:, own][sent[:, own]].tobytes()
        per_step = sent[:, own].sum(axis=1)
        places = (np.cumsum(per_step) - per_step)[::STRIDE].astype("<u4")
        out.append(
            {"payload": payload, "crc32": zlib.crc32(payload), "states": states[:, own].tobytes(), "places": places.tobytes()}
        )
    return {
        "n_tokens": n,
        "symbols": symbols.astype("<u4").tobytes(),
        "frequencies": scaled.astype("<u4").tobytes(),
        "steps": steps,
        "blocks": out,
    }


def decode(segment: dict) -> np.ndarray:
    """A segment's tokens. Every stretch between checkpoints is decoded beside all others; bad checksums raise."""
    symbols = np.frombuffer(segment["symbols"], "<u4")
    scaled = np.frombuffer(segment["frequencies"], "<u4").astype(np.int64)
    freq = scaled.astype(np.uint64)
    start = (np.cumsum(scaled) - scaled).astype(np.uint64)
    code_at = np.repeat(np.arange(len(scaled)), scaled)
    steps, blocks = segment["steps"], segment["blocks"]
    for b, block in enumerate(blocks):
        if zlib.crc32(block["payload"]) != block["crc32"]:
            raise ValueError(f"checksum of block {b} differs")
    sizes = np.array([len(b["payload"]) // 2 for b in blocks])
    base = np.cumsum(sizes) - sizes
    words = np.frombuffer(b"".join([*(b["payload"] for b in blocks), b"\0\0"]), "<u2").astype(np.uint64)
    marks = len(range(0, steps, STRIDE))
    x = np.concatenate([np.frombuffer(b["states"], "<u4") for b in blocks]).astype(np.uint64).reshape(-1, LANES)
    at = np.concatenate([np.frombuffer(b["places"], "<u4") + o for b, o in zip(blocks, base, strict=True)]).astype(np.int64)
    out = np.zeros((len(blocks) * marks, STRIDE, LANES), np.int64)
    tail = steps - (marks - 1) * STRIDE
    runs = np.arange(len(blocks) * marks)
    mask, shift, sixteen = np.uint64((1 << SCALE_BITS) - 1), np.uint64(SCALE_BITS), np.uint64(16)
    for t in range(min(STRIDE, steps)):
        if t == tail:  # the last stretch of each block ends here
            keep = runs % marks != marks - 1
            runs, x, at = runs[keep], x[keep], at[keep]
        slot = x & mask
        code = code_at[slot.astype(np.int64)]
        out[runs, t] = code
        x = freq[code] * (x >> shift) + slot - start[code]
        low = x < LOW
        order = np.cumsum(low, axis=1)
        place = np.minimum(at[:, None] + order - 1, len(words) - 1)
        x = np.where(low, (x << sixteen) | words[place], x)
        at += order[:, -1]
    whole = out.reshape(len(blocks), marks * STRIDE, LANES)[:, :steps]
    return symbols[whole.reshape(-1)[: segment["n_tokens"]]]


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end: int = END_ID
) -> None:
    """Write the ids of all texts, an end id after each, in ascending order of doc_id.

    A null or empty text has its end id only; null ids come first; rows of one id lie in order of their texts. Texts
    are ranged by id in one shuffle and tokenized where they land; a task holds one segment at a time, which
    ends with the document that fills it. An empty table gives a file without segments.
    """
    definition = docs.sparkSession.sparkContext.broadcast(definition_of(tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, segment, first = TaskContext.get().partitionId(), 0, 0
        names: list[int | None] = []
        held: list[np.ndarray] = []
        sizes: list[int] = []
        filled = 0

        def close() -> pa.RecordBatch:
            row = {"part": part, "segment": segment, "first": first, "doc_ids": names, "doc_tokens": sizes}
            return pa.RecordBatch.from_pylist([row | encode(np.concatenate(held))], ARROW_FORMAT)

        with encoder(definition.value, BYTE_PIECES, lower=False) as own_encoder:
            for batch in batches:
                for own in slices(batch, "text", SLICE_BYTES):
                    ids, counts = with_end(*own_encoder.encode(own.column("text")), end)
                    names += own.column("doc_id").to_pylist()
                    sizes += counts.tolist()
                    held.append(ids)
                    filled += len(ids)
                    if filled >= SEGMENT_TOKENS:
                        yield close()
                        segment, first = segment + 1, first + filled
                        names, held, sizes, filled = [], [], [], 0
            if filled:
                yield close()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, FORMAT).write.option("compression", "none").parquet(path)


def read_tokens(spark: SparkSession, path: str, keep_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document of such a file; with its `ids` if asked for.

    Segments are decoded independently. start counts the ids of all documents before: those of earlier
    parts (one number a part), of earlier segments of the part, and of earlier documents of the segment.
    """
    kept = [("ids", pa.binary())] if keep_ids else []
    schema = "part int, doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if keep_ids else "")
    arrow = pa.schema(
        [("part", pa.int32()), ("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), *kept]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                segment = batch.slice(k, 1).to_pylist()[0]
                raw = decode(segment).astype("<u4").tobytes()
                rows, before = [], 0
                for name, n in zip(segment["doc_ids"], segment["doc_tokens"], strict=True):
                    own = raw[4 * before : 4 * (before + n)]
                    row = {"part": segment["part"], "doc_id": name, "start": segment["first"] + before, "n_tokens": n}
                    rows.append(row | {"ids_crc32": zlib.crc32(own)} | ({"ids": own} if keep_ids else {}))
                    before += n
                yield pa.RecordBatch.from_pylist(rows, arrow)

    stored = spark.read.schema(FORMAT).parquet(path)
    totals = stored.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    rows = stored.mapInArrow(run, schema).join(before, "part").withColumn("start", F.col("start") + F.col("before"))
    return rows.drop("part", "before")


def through_file(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the documents' ids to a file in the shared folder and read it back."""
    path = scratch_folder(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer)
    return read_tokens(docs.sparkSession, path)
