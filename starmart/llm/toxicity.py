"""Toxicity: a linear classifier over character n-grams whose presence is scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.filters import that_may_be_in
from starmart.llm.pitman_yor import packed, unpacked
from starmart.llm.text import slices
from starmart.sources.lake import scratch_folder

#: Orders of n-grams, in bytes of the normalized text, and the number of hashed features.
ORDERS = (4, 5, 6)
BITS = 18
SMOOTHING = 1.0
#: Features that the classifier weighs: all whose presence differs by so many standard deviations between the classes.
LEAST_DEVIATION = 4.0
#: Labelled rows that the weights are fitted on, half per class; the counts come from all of them.
SAMPLE_ROWS = 16384
RIDGE = 1e-4
ROUNDS = 400
#: Sampled rows that the fit spreads out at once.
PART_ROWS = 1024

_PRIME = np.uint32(0x01000193)
_MIX = np.uint32(0x9E3779B1)


def features(texts: pa.Array) -> Iterator[np.ndarray]:
    """For each text, the hashed n-grams that stand in it: at every place, repeats included.

    A to Z are lower-cased, runs of ASCII white space become one space, and a space is put before and after.
    """
    for text in texts.to_pylist():
        own = b" ".join((text or "").encode().lower().split())
        raw = np.frombuffer(b" " + own + b" ", np.uint8).astype(np.uint32)
        out, held = [], raw
        for n in range(2, max(ORDERS) + 1):
            if len(raw) < n:
                break
            held = held[: len(raw) - n + 1] * _PRIME + raw[n - 1 :]
            if n in ORDERS:
                out.append((held ^ np.uint32(n)) * _MIX >> np.uint32(32 - BITS))
        yield np.concatenate(out).astype(np.int64) if out else np.zeros(0, np.int64)


class Model(NamedTuple):
    """Weights of features in use, ratios already multiplied in."""

    used: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        place = np.full(1 << BITS, -1, np.int32)
        place[self.used] = np.arange(len(self.used))
        out = np.full(len(texts), self.bias)
        for k, own in enumerate(features(texts)):
            found = place[own]
            found = np.unique(found[found >= 0])
            out[k] += self.weights[found].sum()
        return 1 / (1 + np.exp(-np.clip(out, -500, 500)))


def presence_counts(labelled: DataFrame) -> DataFrame:
    """(feature, toxic, clean): in how many texts of each class of `labelled` (text, toxic) a feature stands.

    Each task counts into two fixed arrays, so what it sends is bounded by the number of features.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << BITS), np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                for label, own in zip(part.column("toxic").to_pylist(), features(part.column("text")), strict=True):
                    counts[label, np.unique(own)] += 1
        seen = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[1, seen]), pa.array(counts[0, seen])], ["feature", "toxic", "clean"])

    counted = labelled.select("text", "toxic").mapInArrow(run, "feature long, toxic long, clean long")
    return counted.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def fit(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on `labelled` (doc_id, text, toxic 0 or 1).

    Ratios and the choice of features come from the counts over all labelled rows. The weights are fitted by
    logistic regression on at most `sample_rows` rows, half of them per class, chosen by hash of doc_id, each class
    weighted back to its share of all rows. Without rows of both classes the score is the share of toxic ones.
    """
    spark, folder = labelled.sparkSession, scratch_folder(labelled.sparkSession, "toxicity")
    labelled.select("doc_id", "text", "toxic").write.option("compression", "zstd").parquet(f"{folder}/texts")
    labelled = spark.read.schema("doc_id long, text string, toxic int").parquet(f"{folder}/texts")
    n = {r.toxic: r.n for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    if not n1 or not n0:
        share = (n1 + 0.5) / (n1 + n0 + 1)
        return Model(np.zeros(0, np.int64), np.zeros(0), float(np.log(share / (1 - share))))
    presence_counts(labelled).write.parquet(f"{folder}/counts")
    held = spark.read.schema("feature long, toxic long, clean long").parquet(f"{folder}/counts")
    total = held.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).first()
    p1, p0 = F.col("toxic") / n1, F.col("clean") / n0
    both = (F.col("toxic") + F.col("clean")) / (n1 + n0)
    spread = F.sqrt(F.greatest(both * (1 - both), F.lit(1e-9)) * (1 / n1 + 1 / n0))
    chosen = (
        held.withColumn("z", F.abs(p1 - p0) / spread)
        .where(F.col("z") >= LEAST_DEVIATION)
        .select("feature", "toxic", "clean")
        .orderBy("feature")
        .toPandas()
    )
    used = chosen["feature"].to_numpy(np.int64)
    width = 1 << BITS
    ratio = np.log((chosen["toxic"].to_numpy() + SMOOTHING) / (total.toxic + SMOOTHING * width)) - np.log(
        (chosen["clean"].to_numpy() + SMOOTHING) / (total.clean + SMOOTHING * width)
    )

    def sampled(label: int) -> DataFrame:
        own = labelled.where(F.col("toxic") == label).select("doc_id", "text", "toxic")
        chosen = own.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows // 2)
        return own.join(F.broadcast(chosen.distinct()), "doc_id", "left_semi")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(width, -1, np.int32)
        place[used] = np.arange(len(used))
        for batch in batches:
            for part in slices(batch, "text"):
                rows = [np.unique(p[p >= 0]) for p in (place[own] for own in features(part.column("text")))]
                steps = pa.array([packed(np.diff(r, prepend=0)) for r in rows], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("toxic"), steps], ["toxic", "found"])

    rows = sampled(1).unionAll(sampled(0)).select("toxic", "text").mapInArrow(found, "toxic int, found binary").toArrow()
    labels = rows["toxic"].to_numpy().astype(float)
    share = np.where(labels == 1, n1 / max(1, labels.sum()), n0 / max(1, (1 - labels).sum()))
    weights, bias = logistic(parts_of(rows["found"]), ratio, labels, share / share.sum())
    return Model(used, weights * ratio, bias)


def parts_of(rows: pa.ChunkedArray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(features in each row, the features of all in turn) of PART_ROWS rows each, which come as packed steps between features."""
    parts = []
    for i in range(0, len(rows), PART_ROWS):
        own = [np.cumsum(unpacked(x)).astype(np.int32) for x in rows.slice(i, PART_ROWS).to_pylist()]
        parts.append((np.array([len(x) for x in own], np.int64), np.concatenate(own)))
    return parts


def logistic(parts: list[tuple[np.ndarray, np.ndarray]], scale: np.ndarray, labels: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights of the scaled features, by accelerated gradient descent with a ridge.

    The rows stay in their parts, one of which at a time is spread out: beside the features themselves, the driver holds
    a few arrays of a part's size.
    """

    def sums(values: np.ndarray) -> np.ndarray:
        """Per row, the sum of its features' values."""
        return np.concatenate([np.bincount(np.repeat(np.arange(len(n)), n), values[own], len(n)) for n, own in parts])

    starts = np.cumsum([0, *(len(n) for n, _ in parts)])
    mass = sums(scale * scale)
    step = 1 / (0.25 * (1 + float((share * mass).sum())) + RIDGE)
    weights, bias = np.zeros(len(scale)), 0.0
    ahead, ahead_bias, pace = weights, bias, 1.0
    for _ in range(ROUNDS):
        z = sums(scale * ahead) + ahead_bias
        off = share * (1 / (1 + np.exp(-np.clip(z, -500, 500))) - labels)
        slope = np.zeros(len(scale))
        for first, (n, own) in zip(starts, parts):
            slope += np.bincount(own, np.repeat(off[first : first + len(n)], n), len(scale))
        slope = scale * slope + RIDGE * ahead
        new, new_bias = ahead - step * slope, ahead_bias - step * off.sum()
        quicker = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        push = (pace - 1) / quicker
        ahead, ahead_bias = new + push * (new - weights), new_bias + push * (new_bias - bias)
        weights, bias, pace = new, new_bias, quicker
    return weights, float(bias)


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) for each row of `docs`: 0 to 1, higher is likelier toxic. Null texts are empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(model.scores(part.column("text")))], ["doc_id", "score"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")


def labelled_texts(docs: DataFrame, labels: DataFrame, held_out) -> DataFrame:
    """(doc_id, text, toxic) of labelled documents outside the held-out fold.

    Labels other than 0 and 1 and null ids are left out; an id labelled twice counts as toxic if either label says
    so. `held_out` is a condition on doc_id. Texts without a label are kept out of the join by a filter of a fixed size.
    """
    own = (
        labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    own = own.where(~held_out)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    asked = that_may_be_in(rows.where(F.col("doc_id").isNotNull() & ~held_out), "doc_id", own.select("doc_id"))
    return asked.join(own, "doc_id")
