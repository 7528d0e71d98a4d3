"""A corpus from raw documents to packed training sequences, one table a stage."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import compact_windows, decontamination, packing, quality_ledger, simhash
from starmart.sources.lake import scratch_folder

TOKENIZER = "word_bpe_49k.json"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy keeps, as they were. A null text has no words and goes."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), "text")
    judged = quality_ledger.verdict(quality_ledger.ledger(rows))
    return judged.where("kept").select("row.*")


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the document with the smallest doc_id.

    Rows that share a doc_id stay or go together; rows without one stay.
    """
    found = simhash.near_duplicates(docs)
    gone = found.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that one of a smaller doc_id has; n_chars counts what is left."""
    found = compact_windows.spans(compact_windows.repeated_passages(docs))
    cut = compact_windows.without_spans(docs, found)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cut = cut.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return cut


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Rows without a doc_id stay."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    gone = decontamination.contaminated(docs, benchmark).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", pack_sequences),
]

#: SQL has no fingerprints, passages, edit distances or tokenizers; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again by the next."""
    folder = scratch_folder(spark, "corpus")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
