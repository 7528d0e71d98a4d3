"""Lake tables: partition replacement, whole overwrite, date partitions, merge by key."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starmart.functions.keys import MAX_FILES_PER_MONTH
from starmart.operators.lineage import FILE, month_of_path, number_files, split_month
from starmart.operators.merge import insert_if_absent, one_row_per_key, upsert
from starmart.sources.jdbc import write_jdbc
from starmart.sources.scan import exists, read_months
from starmart.sources.snapshots import has_snapshot, read_snapshot, write_snapshot

MONTH = ("_year", "_month")
MODES = ("overwrite", "append", "error", "ignore")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as the session names it in spark.checkpoint.dir.

    A local session may go without and uses a folder of its warehouse; a cluster
    may not, since nothing says that its warehouse takes scratch files.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    own = f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    spark.sparkContext.setCheckpointDir(own)
    return own


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A folder of its own, for one use, under the shared one."""
    return f"{shared_folder(spark)}/{purpose}-{uuid4()}"


WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
#: Files that a task of a partitioned write has open at once; rows of further partitions are sorted, as all would be without.
OPEN_FILES = 16
SPLITS = "spark.sql.files.minPartitionNum"
#: Scans of a partitioned write aim at this many tasks a core: with one, a task or two are left for a second round.
TASKS_PER_CORE = 4
SHUFFLES = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
HASHED = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
#: Bytes of stored input that a shuffle partition begins with.
SHUFFLE_BYTES = 4 << 20
TIMES = "spark.sql.parquet.outputTimestampType"


@contextmanager
def settings(spark: SparkSession, wanted: Mapping[str, object]) -> Iterator[None]:
    """The settings hold within and are put back after."""
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


@contextmanager
def unsorted_writes(spark: SparkSession) -> Iterator[None]:
    """Partitioned writes within do not sort a task's rows first and load their tasks evenly; what the session names is kept.

    Times are stored as 64-bit numbers, which Spark writes and reads quicker than its default of 12 bytes.
    """
    wanted = {TIMES: "TIMESTAMP_MICROS"} if spark.conf.get(TIMES) == "INT96" else {}
    if not int(spark.conf.get(WRITERS)):
        wanted[WRITERS] = OPEN_FILES
    if spark.conf.get(SPLITS, None) is None:
        wanted[SPLITS] = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    with settings(spark, wanted):
        yield


@contextmanager
def sized_shuffles(spark: SparkSession, stored_bytes: int) -> Iterator[None]:
    """Shuffles of this much input begin in so many partitions that none is large, whatever the session's number.

    Adaptive execution then joins small ones up to its advisory size, so a task's memory does not grow with the input; a
    join whose smaller side has no partition above that size hashes it and sorts neither. What the session names is kept.
    """
    wanted = {}
    if spark.conf.get(SHUFFLES, None) is None:
        wanted[SHUFFLES] = max(int(spark.conf.get("spark.sql.shuffle.partitions")), stored_bytes // SHUFFLE_BYTES + 1)
    if spark.conf.get(HASHED) in ("0", "0b"):
        wanted[HASHED] = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    with settings(spark, wanted):
        yield


def write_partitions(
    df: DataFrame,
    path: str,
    by: Sequence[str],
    mode: str = "overwrite",
    rebalance: bool = False,
) -> None:
    """Write a partitioned Parquet table; overwrite replaces only the partitions present in `df`.

    Rows already lie with their partition when they come from month files or from
    a table partitioned alike, and are written where they are. `rebalance` is for
    rows that do not: it brings each partition's rows together in files of the
    advisory size and splits a partition that is larger, so a hot one is written
    by many tasks.
    """
    laid_out = df.hint("rebalance", *[F.col(c) for c in by]) if rebalance else df
    with unsorted_writes(df.sparkSession):
        (
            laid_out.write.mode(mode)
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*by)
            .parquet(path)
        )


def replace_months(
    df: DataFrame,
    path: str,
    months: Sequence[str],
    counts: Mapping[str, Column] | None = None,
    rebalance: bool = False,
) -> dict:
    """Replace exactly the listed months of a table partitioned by `_year`, `_month`.

    Returns rows written per month (key = yyyy-MM) and the extra `counts`, which
    are measured during the write. A listed month that now has no rows is emptied,
    so a re-run never leaves its old rows behind; a row of any other month is an
    error. What is evaluated per row does not grow with the months: one look into
    a set, and one set of the months met; rows per month come from the footers.
    `rebalance` is for rows whose months lie scattered (see `write_partitions`); it
    goes before the counting, which thus stays in the stage that writes.
    """
    numbers = {}
    for month in months:
        year, number = split_month(month)
        numbers[year * 12 + number] = month
    at = F.col("_year") * 12 + F.col("_month")
    laid_out = df.hint("rebalance", *[F.col(c) for c in MONTH]) if rebalance else df
    stray = F.raise_error(F.concat(F.lit("row outside the listed months: "), F.concat_ws("-", *MONTH))).cast("int")
    listed = F.coalesce(at.isin(list(numbers)), F.lit(False))
    guarded = laid_out.withColumns({"_year": F.when(listed, F.col("_year")).otherwise(stray), "__at": at})
    seen = Observation()
    extra = [value.alias(name) for name, value in (counts or {}).items()]
    write_partitions(guarded.observe(seen, F.collect_set("__at").alias("__met"), *extra).drop("__at"), path, MONTH)
    result = dict(seen.get)
    met = [numbers[n] for n in result.pop("__met")]
    result |= dict.fromkeys(months, 0)
    if met:
        table = read_months(df.sparkSession, path, met)
        for row in table.groupBy(*MONTH).agg(F.count(F.lit(1)).alias("rows")).collect():
            result[numbers[row["_year"] * 12 + row["_month"]]] = row["rows"]
    for month in set(months) - set(met):
        year, number = split_month(month)
        df.limit(0).drop(*MONTH).write.mode("overwrite").parquet(f"{path}/_year={year}/_month={number}")
    return result


def register_files(spark: SparkSession, path: str, files: Sequence[str]) -> list[tuple[str, str, int]]:
    """(month, path, number) of raw files, from a register in which each file keeps its number for good.

    New files are appended before any of their rows is written, so a run that
    fails leaves a gap and no number twice. Only the entries of these files' months
    are read.
    """
    months = sorted({month_of_path(f) or "" for f in files})
    known = {}
    if exists(spark, path):
        entries = spark.read.parquet(path).filter(F.col("month").isin(months))
        known = {(r["month"], r["path"]): r["number"] for r in entries.collect()}
    numbered = number_files(files, known)
    new = [entry for entry in numbered if entry[:2] not in known]
    if new:
        rows = spark.createDataFrame(new, "month string, path string, number long")
        rows.coalesce(1).write.mode("append").parquet(path)
    return numbered


def replace_files(df: DataFrame, path: str, numbered: Sequence[tuple[str, str, int]]) -> dict[str, int]:
    """Replace the rows of the given raw files in a table partitioned by `_year`, `_month`, `_file`.

    Rows of other files of a month stay as they are. A file that has no rows any
    more is emptied. Returns rows written per month, counted from the new
    partitions' footers.
    """
    by = (*MONTH, FILE)
    wanted = {(*split_month(month), number): month for month, _, number in numbered}
    seen = Observation()
    place = (F.col("_year").cast("long") * 12 + F.col("_month")) * MAX_FILES_PER_MONTH + F.col(FILE)
    watched = df.withColumn("__place", place).observe(seen, F.collect_set("__place").alias("met"))
    write_partitions(watched.drop("__place"), path, by)
    met = {place for place in seen.get["met"]}
    for year, month, number in wanted:
        if (year * 12 + month) * MAX_FILES_PER_MONTH + number not in met:
            empty = df.limit(0).drop(*by)
            empty.write.mode("overwrite").parquet(f"{path}/_year={year}/_month={month}/{FILE}={number}")
    written = dict.fromkeys(wanted.values(), 0)
    table = read_months(df.sparkSession, path, sorted(written))
    for row in table.groupBy(*by).agg(F.count(F.lit(1)).alias("rows")).collect():
        key = tuple(row[c] for c in by)
        if key in wanted:
            written[wanted[key]] += row["rows"]
    return written


def write_by_date(df: DataFrame, path: str, ts: str, date_column: str, mode: str = "overwrite") -> None:
    """Write partitioned by the date of a timestamp; overwrite replaces the dates present."""
    dated = df.withColumn(date_column, F.to_date(ts))
    write_partitions(dated, path, [date_column], mode, rebalance=True)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Write a whole table and return its row count, taken during the write."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode).parquet(path)
    return seen.get["rows"]


def stage_source(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows, checked for a key that occurs twice and stored, so that Spark plans by their size.

    The check's join hides how small a source is; its stored rows show it.
    """
    folder = scratch_folder(source.sparkSession, "merge")
    one_row_per_key(source, keys).write.parquet(folder)
    return source.sparkSession.read.schema(source.schema).parquet(folder)


def load_dimension(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    how: str = "upsert",
    update: Sequence[str] | None = None,
) -> int:
    """Load a dimension: upsert (default), insert (only absent keys) or overwrite; returns its row count.

    The table is one of snapshots (see `starmart.sources.snapshots`): a load that fails leaves the members that facts
    point to. The source is stored first, the target is read where it lies and written once.
    """
    spark = df.sparkSession
    if how not in ("upsert", "insert", "overwrite"):
        raise ValueError(f"unknown way to load a dimension: {how}")
    if how == "overwrite" or not has_snapshot(spark, path):
        return write_snapshot(df, path)
    target = read_snapshot(spark, path)
    source = stage_source(df.select(*target.columns), keys)
    if how == "upsert":
        return write_snapshot(upsert(target, source, keys, update, checked=True), path)
    return write_snapshot(insert_if_absent(target, source, keys, checked=True), path)


def without_surrogate(df: DataFrame, key: str = "trip_key") -> DataFrame:
    """For targets that generate the surrogate key themselves."""
    return df.drop(key)


def load(
    df: DataFrame,
    table: str,
    target: str = "auto",
    mode: str = "overwrite",
    lake: str | None = None,
    connection: Mapping[str, str] | None = None,
    partition_by: Sequence[str] = (),
    drop_key: str | None = None,
) -> None:
    """Write to the lake or to a database; auto takes the database when a connection is given."""
    if target == "auto":
        target = "jdbc" if connection else "lake"
    if mode not in MODES:
        raise ValueError(f"unknown mode: {mode}")
    rows = without_surrogate(df, drop_key) if drop_key else df
    if target == "jdbc":
        write_jdbc(rows, connection or {}, table, mode)
    elif target == "lake":
        if lake is None:
            raise ValueError("the lake target needs its folder")
        if partition_by:
            write_partitions(rows, f"{lake}/{table}", partition_by, mode, rebalance=True)
        else:
            rows.write.mode(mode).parquet(f"{lake}/{table}")
    else:
        raise ValueError(f"unknown target: {target}")
