"""Merge by key: upsert and insert-if-absent, as pure frame operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _same_key(keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys])


def one_row_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows; fails when a key occurs twice.

    Keys are counted on their own, which combines before the shuffle, and only
    the counts above one are looked up by the rows.
    """
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows")).filter("__rows > 1")
    marked = df.alias("t").join(repeated.alias("s"), _same_key(keys), "left")
    text = F.concat(F.lit("key occurs twice: "), F.to_json(F.struct(*[F.col(f"t.{k}") for k in keys])))
    fails = F.raise_error(text).cast("boolean")
    checked = marked.filter(F.when(F.col("s.__rows").isNull(), F.lit(True)).otherwise(fails))
    return checked.select(*[F.col(f"t.{c}").alias(c) for c in df.columns])


def _found(target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Of the target's rows, those whose key the source has: a filter, which leaves the target where it lies."""
    wanted = source.select(*keys).alias("s")
    return target.select(*keys, *columns).alias("t").join(wanted, _same_key(keys), "left_semi")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] | None = None,
    checked: bool = False,
) -> DataFrame:
    """Target with source merged in: new keys inserted, known keys updated.

    `update` names the columns a known key takes from the source (default: all);
    the others keep the target's value. Null keys match each other. A key that
    occurs twice in the source is an error; `checked` says that none does. The
    target is only ever filtered by the source's keys, and what is left of it is no
    larger than the source. Where Spark knows that the source is small, as it does of
    one that was checked and stored (`starmart.sources.lake.stage_source`), it
    broadcasts the keys and the target does not move.
    """
    kept = [c for c in target.columns if update is not None and c not in update and c not in keys]
    s = source.select(*target.columns) if checked else one_row_per_key(source.select(*target.columns), keys)
    merged = s
    if kept:
        t = _found(target, s, keys, kept).withColumn("__known", F.lit(True)).alias("t")
        found = F.col("t.__known").isNotNull()
        columns = [
            F.when(found, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c) if c in kept else F.col(f"s.{c}").alias(c)
            for c in target.columns
        ]
        merged = s.alias("s").join(t, _same_key(keys), "left").select(*columns)
    others = target.alias("t").join(s.select(*keys).alias("s"), _same_key(keys), "left_anti")
    return others.select(*target.columns).unionByName(merged)


def insert_if_absent(target: DataFrame, source: DataFrame, keys: Sequence[str], checked: bool = False) -> DataFrame:
    """Target plus the source rows whose key it does not have; target rows never change. `checked` as in `upsert`."""
    s = source.select(*target.columns) if checked else one_row_per_key(source.select(*target.columns), keys)
    known = _found(target, s, keys, []).alias("t")
    return target.unionByName(s.alias("s").join(known, _same_key(keys), "left_anti"))
