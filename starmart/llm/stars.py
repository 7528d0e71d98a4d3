"""Connected components by alternating large-star and small-star, as Spark joins over tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from starmart.sources.lake import scratch_folder

#: Edges that one task of a round writes; edges only become fewer.
TASK_EDGES = 1 << 20


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of the node and all its neighbours."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
    low = F.least("low", "node")
    return edges.join(least, edges["b"] == least["node"]).select("a", low.alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("low"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionAll(least.select("a", F.col("low").alias("b"))).where("a <> b").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge; component is the smallest node reachable.

    Large-star and small-star alternate until the edges stay as they are: stars around the smallest nodes. Every
    round is a table in the shared folder; only a count and a sum of hashes reach the driver. A hub is met by grouped
    minima, which combine before the shuffle, and by joins with one row per node, whose long side
    adaptive execution splits. Loops and edges with a null end are left out; no edges give an empty result.
    """
    spark = edges.sparkSession
    folder = scratch_folder(spark, "stars")
    left = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(f"{a} <> {b}").distinct()
    known, turn, n = None, 0, None
    while True:
        seen = Observation()
        total = F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))
        # Without a shuffle, so that small rounds are not cut into as many files as there are shuffle partitions.
        laid_out = left if n is None else left.coalesce(-(-n // TASK_EDGES))
        laid_out.observe(seen, F.count("*").alias("n"), total.alias("hashes")).write.parquet(f"{folder}/{turn}")
        held = spark.read.schema(left.schema).parquet(f"{folder}/{turn}")
        if seen.get == known or not seen.get["n"]:
            break
        known, turn, n = seen.get, turn + 1, seen.get["n"]
        left = _small_star(_large_star(held))
    stars = held.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionAll(stars.select(F.col("component").alias("node"), "component").distinct())
