"""Tables that are replaced whole: every load is a folder of its own, and the entry that names it is written last."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starmart.sources.scan import exists

ENTRY = "number long, folder string, rows long"


def _entries(path: str) -> str:
    return f"{path}/entries"


def _newest(spark: SparkSession, path: str, count: int = 1) -> list:
    """The latest entries, newest first. Of two loads that raced for one number, both read the same one."""
    if not exists(spark, _entries(path)):
        return []
    return spark.read.schema(ENTRY).parquet(_entries(path)).orderBy(F.desc("number"), F.desc("folder")).limit(count).collect()


def has_snapshot(spark: SparkSession, path: str) -> bool:
    """Whether a load of this table was ever finished."""
    return bool(_newest(spark, path))


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The table as the last finished load left it; a later load does not change what this frame reads."""
    newest = _newest(spark, path)
    if not newest:
        raise ValueError(f"no finished load of {path}")
    return spark.read.parquet(f"{path}/{newest[0].folder}")


def write_snapshot(df: DataFrame, path: str) -> int:
    """Replace a table by `df`, which may read that very table; returns its row count, taken during the write.

    Nothing is overwritten: rows go to a new folder, and only when they are all there is the entry added that makes
    readers find them. A load that fails before leaves the table as it was, and a folder no entry names.
    """
    spark, folder, seen = df.sparkSession, f"rows-{uuid4()}", Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("error").parquet(f"{path}/{folder}")
    newest = _newest(spark, path)
    entry = (newest[0].number + 1 if newest else 1, folder, seen.get["rows"])
    spark.createDataFrame([entry], ENTRY).coalesce(1).write.mode("append").parquet(_entries(path))
    return entry[2]


def read_snapshot_before(spark: SparkSession, path: str, back: int = 1) -> DataFrame:
    """The table as it was `back` finished loads ago."""
    newest = _newest(spark, path, back + 1)
    if len(newest) <= back:
        raise ValueError(f"{path} has no {back} loads before the last")
    return spark.read.parquet(f"{path}/{newest[back].folder}")
