"""Merkle manifest of a dataset: roots per group and over all, and a proof for each row, by butterfly exchange."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.sources.lake import scratch_folder

FANOUT = 3
#: Levels of a tree that lie within one partition, which thus holds FANOUT ** LEVELS leaves at most.
LEVELS = 7
#: monotonically_increasing_id keeps the partition above these bits.
ROW_BITS = 33


def leaf(columns: Sequence[Column]) -> Column:
    """Digest of a row: each value as its UTF-8 byte count, a colon and the value; a dash for null."""
    parts = [F.coalesce(F.concat(F.octet_length(c.cast("string")), F.lit(":"), c.cast("string")), F.lit("-")) for c in columns]
    return F.sha2(F.concat(*parts), 256)


def folded(from_leaf: Column, left: Column, right: Column) -> Column:
    """The root that a leaf and its siblings, level by level, give."""
    return F.aggregate(F.arrays_zip(left.alias("left"), right.alias("right")), from_leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def proof_text(left: Column, right: Column) -> Column:
    """All siblings of a proof, level by level, left to right."""
    return F.array_join(F.zip_with(left, right, lambda a, b: F.concat(a, b)), "")


def _digest(nodes: Sequence[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def subtree(leaves: Sequence[str], levels: int | None, fanout: int) -> list[list[str]]:
    """The nodes of each level, leaves first; as many levels above them as said, or up to a single node."""
    out = [list(leaves)]
    while len(out[-1]) > 1 if levels is None else len(out) <= levels:
        below = out[-1]
        out.append([_digest(below[k : k + fanout]) for k in range(0, len(below), fanout)])
    return out


def siblings(nodes: Sequence[str], fanout: int) -> tuple[list[str], list[str]]:
    """What stands left and what stands right of each node in its run."""
    left, right = [], []
    for k in range(0, len(nodes), fanout):
        run = nodes[k : k + fanout]
        for i in range(len(run)):
            left.append("".join(run[:i]))
            right.append("".join(run[i + 1 :]))
    return left, right


def _local_paths(leaves: Sequence[str], levels: int | None, fanout: int) -> tuple[list[pa.Array], list[pa.Array]]:
    """Per level, the left and right siblings that each leaf's ancestor has."""
    lefts, rights, at = [], [], np.arange(len(leaves))
    for nodes in subtree(leaves, levels, fanout)[:-1]:
        left, right = siblings(nodes, fanout)
        lefts.append(pa.array(left, pa.string()).take(pa.array(at)))
        rights.append(pa.array(right, pa.string()).take(pa.array(at)))
        at = at // fanout
    return lefts, rights


def _lists(levels: Sequence[pa.Array], above: Sequence[str], rows: int) -> pa.Array:
    """For each row, its entries of the levels and then those above, which all rows share."""
    parts = [*levels, *(pa.array([a], pa.string()).take(pa.array(np.zeros(rows, np.int64))) for a in above)]
    offsets = pa.array(np.arange(rows + 1, dtype=np.int32) * len(parts))
    if not parts:
        return pa.ListArray.from_arrays(offsets, pa.array([], pa.string()))
    order = np.arange(rows * len(parts)).reshape(len(parts), rows).T.reshape(-1)
    return pa.ListArray.from_arrays(offsets, pa.concat_arrays(parts).take(pa.array(order)))


def _numbered(rows: DataFrame, folder: str, size: int) -> DataFrame:
    """`rows` (grp, key, leaf, ...) with the partition `chunk` of `size` leaves, `place` within it and `chunks` of the group.

    Rows are sorted by range, so a group of any size spreads over tasks; ranks come from the ranges' counts per
    group, of which a group has as many as there are ranges. Equal rows are told apart by `seq`.
    """
    spark = rows.sparkSession
    rows.withColumn("seq", F.monotonically_increasing_id()).write.parquet(f"{folder}/leaves")
    order = [F.col("grp"), F.col("key").asc_nulls_first(), F.col("leaf"), F.col("seq")]
    held = spark.read.parquet(f"{folder}/leaves").repartitionByRange(*order).sortWithinPartitions(*order)
    held.withColumn("at", F.monotonically_increasing_id()).write.parquet(f"{folder}/ordered")
    ordered = spark.read.parquet(f"{folder}/ordered").withColumn("part", F.shiftright("at", ROW_BITS))
    own = Window.partitionBy("grp")
    before = own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ordered.groupBy("grp", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    ranges = ranges.select(
        "grp", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"), F.sum("n").over(own).alias("total")
    )
    ranked = ordered.join(ranges, ["grp", "part"]).withColumn("rank", F.col("at") + F.col("shift"))
    placed = ranked.withColumns(
        {
            "chunk": F.floor(F.col("rank") / size).cast("long"),
            "place": (F.col("rank") % size).cast("int"),
            "chunks": F.ceil(F.col("total") / size).cast("long"),
        }
    )
    return placed.drop("seq", "at", "part", "shift", "total", "rank")


def _exchange(state: DataFrame, width: int, fanout: int) -> DataFrame:
    """One round: partitions of `fanout` neighbouring nodes swap the nodes' digests, and each hashes the parent.

    A node is held by the `width` partitions below it (the last by fewer). Partition number `low` of a node meets
    its counterparts in the sibling nodes; one of a short node also serves the numbers that its node lacks. So an exchange group
    has `fanout` rows at most, and every partition leaves with the parent and its own siblings.
    """
    node = F.floor(F.col("chunk") / width)
    sent = state.select(
        "*",
        (node % fanout).cast("int").alias("digit"),
        F.floor(F.col("chunk") / (width * fanout)).alias("parent"),
        (F.col("chunk") % width).alias("low"),
        F.least(F.lit(width), F.col("chunks") - node * width).cast("long").alias("holders"),
    )
    sent = sent.withColumn("slot", F.explode(F.sequence(F.col("low"), F.lit(width - 1).cast("long"), F.col("holders"))))
    rows = F.struct("digit", "digest", (F.col("slot") == F.col("low")).alias("own"), "chunk", "chunks", "left", "right")
    met = sent.groupBy("grp", "parent", "slot").agg(F.array_sort(F.collect_list(rows)).alias("met"))
    me = met.select("grp", "met", F.explode(F.filter("met", lambda x: x["own"])).alias("me"))
    digests = lambda keep: F.array_join(F.transform(F.filter("met", keep), lambda x: x["digest"]), "")
    active = F.col("me.chunks") > width
    beside = {
        "left": digests(lambda x: x["digit"] < F.col("me.digit")),
        "right": digests(lambda x: x["digit"] > F.col("me.digit")),
    }
    return me.select(
        "grp",
        "me.chunk",
        "me.chunks",
        F.when(active, F.sha2(digests(lambda x: F.lit(True)), 256)).otherwise(F.col("me.digest")).alias("digest"),
        *(F.when(active, F.array_append(f"me.{c}", v)).otherwise(F.col(f"me.{c}")).alias(c) for c, v in beside.items()),
    )


def _grown(rows: DataFrame, folder: str, levels: int, fanout: int) -> tuple[DataFrame, DataFrame]:
    """The numbered leaves, and per partition (grp, chunk) its group's root with the siblings above the partition."""
    spark, size = rows.sparkSession, fanout**levels
    _numbered(rows, folder, size).write.parquet(f"{folder}/placed")
    placed = spark.read.parquet(f"{folder}/placed")

    def top_of(key: tuple, held: pa.Table) -> pa.Table:
        held = held.sort_by("place")
        chunks = held.column("chunks")[0].as_py()
        node = subtree(held.column("leaf").to_pylist(), None if chunks == 1 else levels, fanout)[-1][0]
        return pa.Table.from_pylist([{"grp": key[0].as_py(), "chunk": key[1].as_py(), "chunks": chunks, "digest": node}])

    held = placed.select("grp", "chunk", "chunks", "place", "leaf")
    tops = held.groupBy("grp", "chunk").applyInArrow(top_of, "grp string, chunk long, chunks long, digest string")
    nothing = F.array().cast("array<string>")
    tops.withColumns({"left": nothing, "right": nothing}).write.parquet(f"{folder}/state-0")
    state, width, turn = spark.read.parquet(f"{folder}/state-0"), 1, 0
    most = state.agg(F.max("chunks")).head()[0] or 0
    while width < most:
        turn += 1
        _exchange(state, width, fanout).write.parquet(f"{folder}/state-{turn}")
        state, width = spark.read.parquet(f"{folder}/state-{turn}"), width * fanout
    return placed, state


def _proofs(placed: DataFrame, upper: DataFrame, levels: int, fanout: int) -> DataFrame:
    """`placed` with `left` and `right` from the leaf up, through those of `upper` (grp, chunk, left, right, ...)."""
    more = [c for c in upper.columns if c not in ("grp", "chunk", "left", "right")]
    own = [c for c in placed.columns if c not in ("grp", "chunk", "chunks", "place")]

    def join(held: pa.Table, above: pa.Table) -> pa.Table:
        held, above = held.sort_by("place"), above.to_pylist()[0]
        chunks = held.column("chunks")[0].as_py()
        left, right = _local_paths(held.column("leaf").to_pylist(), None if chunks == 1 else levels, fanout)
        n = held.num_rows
        columns = {c: held.column(c) for c in own}
        columns |= {c: pa.array([above[c]], pa.string()).take(pa.array(np.zeros(n, np.int64))) for c in more}
        return pa.table(columns | {"left": _lists(left, above["left"], n), "right": _lists(right, above["right"], n)})

    kinds = [*(f"`{c}` {placed.schema[c].dataType.simpleString()}" for c in own), *(f"{c} string" for c in more)]
    kind = ", ".join([*kinds, "left array<string>", "right array<string>"])
    return placed.groupBy("grp", "chunk").cogroup(upper.groupBy("grp", "chunk")).applyInArrow(join, kind)


def manifest(
    docs: DataFrame,
    columns: Sequence[str],
    group: str = "source",
    key: str = "doc_id",
    carry: Mapping[str, Column] | None = None,
    levels: int = LEVELS,
    fanout: int = FANOUT,
) -> DataFrame:
    """(key, leaf, carry..., subroot, root, left, right) for each row of `docs`.

    A leaf is the digest of the row's `columns`. Per `group`, leaves ascend by `key`, and `fanout` neighbours at a time
    become the digest of theirs until one is left, the subroot; subroots, ordered by group, become the root alike. left
    and right hold, per level from the leaf to the root, the digests beside the leaf's ancestor in its run, end to end:
    `folded` takes them back to the root. `carry` names further values of a row, given back with it.

    Each row is hashed where it is read and only digests move. Partitions of `fanout ** levels` neighbouring
    leaves hash their own subtrees; those above are hashed by butterfly exchange (see `_exchange`), so a hot group is as
    many partitions as it has leaves for, and nothing but the number of rounds reaches the driver.

    A null group is one group, the first; null keys come first in their group; rows with equal keys are ordered by
    leaf, so equal rows have the same leaf, each its own proof. An empty table gives an empty result.
    """
    folder = scratch_folder(docs.sparkSession, "merkle")
    name = F.col(group).cast("string")
    rows = docs.select(
        # Null before the empty string, the order of bytes otherwise.
        F.when(name.isNull(), "").otherwise(F.concat(F.lit("="), name)).alias("grp"),
        F.col(key).alias("key"),
        leaf([F.col(c) for c in columns]).alias("leaf"),
        *(value.alias(f"carry_{c}") for c, value in (carry or {}).items()),
    )
    placed, state = _grown(rows, f"{folder}/rows", levels, fanout)
    groups = state.where("chunk = 0").select(F.lit("").alias("grp"), F.col("grp").alias("key"), F.col("digest").alias("leaf"))
    placed_groups, top = _grown(groups, f"{folder}/groups", levels, fanout)
    over = _proofs(placed_groups, top.select("grp", "chunk", F.col("digest").alias("root"), "left", "right"), levels, fanout)
    over = over.select(F.col("key").alias("grp"), "root", F.col("left").alias("over_left"), F.col("right").alias("over_right"))
    upper = state.join(over, "grp").select(
        "grp",
        "chunk",
        F.col("digest").alias("subroot"),
        "root",
        F.concat("left", "over_left").alias("left"),
        F.concat("right", "over_right").alias("right"),
    )
    found = _proofs(placed, upper, levels, fanout)
    back = {f"carry_{c}": c for c in carry or {}} | {"key": key}
    return found.select(*(F.col(c).alias(back.get(c, c)) for c in found.columns))
