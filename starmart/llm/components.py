"""Connected components of an edge list, as Spark joins over tables in the shared folder."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.sources.lake import scratch_folder


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For nodes 0..n-1 and edges (a, b): the smallest node of each node's component. For edges held by one task."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while (label[label] != label).any():
            label = label[label]
        differ = label[a] != label[b]
        a, b = a[differ], b[differ]
    return label


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge; component is the smallest node reachable.

    Rounds of contraction: each node moves to the neighbour (or itself) of the lowest hash, and
    edges between the places they moved to go into the next round. Hash order makes the
    expected number of rounds logarithmic, also along chains. Every round is a table in the
    shared folder, so a lost executor costs one round's tasks at most; nothing but counts is
    collected. A hub is only met by grouped minima, which combine before the shuffle, and by
    joins with one row per node, whose long side adaptive execution splits.

    Loops and edges with a null end are left out; no edges give an empty result.
    """
    spark = edges.sparkSession
    folder = scratch_folder(spark, "components")
    kind = edges.schema[a].dataType
    left = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct()
    moves = []
    while True:
        at = f"{folder}/{len(moves)}"
        left.write.parquet(f"{at}/edges")
        held = spark.read.schema(left.schema).parquet(f"{at}/edges")
        if moves and held.isEmpty():
            break
        both = held.unionAll(held.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = F.least(
            F.min(F.struct(F.xxhash64("b").alias("h"), F.col("b").alias("to"))),
            F.struct(F.xxhash64("a").alias("h"), F.col("a").alias("to")),
        )
        both.groupBy("a").agg(lowest.alias("m")).select(F.col("a").alias("node"), F.col("m.to").alias("to")).write.parquet(
            f"{at}/moves"
        )
        move = spark.read.schema(f"node {kind.simpleString()}, to {kind.simpleString()}").parquet(f"{at}/moves")
        moves.append(move)
        first = move.select(F.col("node").alias("a"), F.col("to").alias("to_a"))
        second = move.select(F.col("node").alias("b"), F.col("to").alias("to_b"))
        left = (
            held.join(first, "a")
            .join(second, "b")
            .where("to_a <> to_b")
            .select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
            .distinct()
        )
    label = moves[0].select("node", F.col("to").alias("label"))
    for move in moves[1:]:
        label = label.join(move.select(F.col("node").alias("label"), "to"), "label", "left").select(
            "node", F.coalesce("to", "label").alias("label")
        )
    label.write.parquet(f"{folder}/labels")
    label = spark.read.schema(label.schema).parquet(f"{folder}/labels")
    lowest = label.groupBy("label").agg(F.min("node").alias("component"))
    return label.join(lowest, "label").select("node", "component")
