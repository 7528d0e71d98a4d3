"""Scans: month files, lookups, partitioned lake tables, and what is there."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.contracts import align, loses, losses
from starmart.functions.keys import ROW_ID, position_key
from starmart.operators.lineage import FILE, add_lineage, month_of_path, number_files, plain_path, split_month

CORRUPT = "_corrupt_record"


def _one_schema(spark: SparkSession, paths: Sequence[str]) -> T.StructType | None:
    """The union of all files' columns, read from the footers in one job; None when types disagree."""
    try:
        return spark.read.option("mergeSchema", True).parquet(*paths).schema
    except Py4JJavaError as failure:
        if "CANNOT_MERGE_SCHEMAS" in str(failure.java_exception):
            return None
        raise


def read_raw(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType, *also: str | Column, lost: str | None = None
) -> DataFrame:
    """All raw files as one frame aligned to the contract, whatever each file's own types.

    Files that agree are one scan, with the columns of all of them. Where types
    disagree, on integer widths say, the files of all paths are grouped by schema,
    also within a folder: one scan per distinct schema (a handful), none of which
    reads a file under another's types. `also` may name hidden columns of the
    scan, as `_metadata.file_name`. `lost` names a column for the names of a row's columns whose value does not
    fit, with `_row` after it one for such a row as text, and with `_any` one that is true of such a row.
    """

    def aligned(df: DataFrame) -> DataFrame:
        if lost is None:
            return align(df, schema, *also)
        names = losses(df, schema)
        row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})
        some = loses(df, schema)
        return align(df, schema, *also, names.alias(lost), F.when(some, row).alias(f"{lost}_row"), some.alias(f"{lost}_any"))

    return reduce(DataFrame.unionByName, map(aligned, _scans(spark, paths)))


def _scans(spark: SparkSession, paths: Sequence[str]) -> list[DataFrame]:
    """One scan per distinct schema of the files, with their own types; a single one where all files agree."""
    common = _one_schema(spark, paths)
    if common is not None:
        return [spark.read.schema(common).parquet(*paths)]
    by_schema: dict[str, tuple[T.StructType, list[str]]] = {}
    for found, files in _agreeing(spark, raw_files(spark, paths)):
        by_schema.setdefault(found.json(), (found, []))[1].extend(files)
    return [spark.read.schema(found).parquet(*files) for found, files in by_schema.values()]


def as_text(df: DataFrame) -> DataFrame:
    """(file, row) of a scan: the path of a row's file, and the row as JSON with all its columns, nulls too."""
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})
    return df.select(F.col("_metadata.file_path").alias("file"), row.alias("row"))


def read_as_text(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file, row) of raw files of any schema, every column under the name and type it has in its file."""
    return reduce(DataFrame.unionByName, map(as_text, _scans(spark, paths)))


def _agreeing(spark: SparkSession, files: Sequence[str]) -> list[tuple[T.StructType, list[str]]]:
    """Runs of files whose footers merge, each read by one job; a run that does not merge is halved.

    Files come in name order, so a type that changed with some month costs a few
    jobs, as many as halving takes to find that month.
    """
    found = _one_schema(spark, files)
    if found is not None:
        return [(found, list(files))]
    middle = len(files) // 2
    return _agreeing(spark, files[:middle]) + _agreeing(spark, files[middle:])


def read_bronze_source(
    spark: SparkSession,
    paths: Sequence[str],
    raw_schema: T.StructType,
    loaded_at: Column,
    numbered: Sequence[tuple[str, str, int]] | None = None,
    lost: str | None = None,
) -> DataFrame:
    """Raw month files with lineage columns, and file number and row id from file positions.

    `numbered` is a lake's register of these files; without it, files are numbered
    by path among those given. `lost` is as in `read_raw`.
    """
    hidden = [
        F.col("_metadata.file_name").alias("__file"),
        F.col("_metadata.file_path").alias("__path"),
        F.col("_metadata.row_index").alias("__row"),
    ]
    raw = read_raw(spark, paths, raw_schema, *hidden, lost=lost)
    files = raw_files(spark, paths)
    located = _located(raw, files, number_files(files) if numbered is None else numbered)
    with_lineage = add_lineage(located, F.col("__file"), F.col("__month"), loaded_at)
    row_id = position_key(F.col("_year"), F.col("_month"), F.col("__number"), F.col("__row"))
    keyed = with_lineage.withColumns({FILE: F.col("__number").cast("int"), ROW_ID: row_id})
    return keyed.drop("__file", "__path", "__row", "__month", "__number")


def _located(raw: DataFrame, files: Sequence[str], numbered: Sequence[tuple[str, str, int]]) -> DataFrame:
    """`raw` with `__month` and `__number` of the file at `__path`, which are worked out once per file, not per row.

    The list of files, which the driver holds anyway, is broadcast under the names that Spark gives to the files (`file:///`
    in its listing is `file:/` with rows): planned by its unknown size it would bring all rows of a file to one task. A
    single file needs no list. A row of a file without a number fails where its key is made.
    """
    numbers = {path: number for _, path, number in numbered}
    listed = [(f, month_of_path(plain_path(f)), numbers.get(plain_path(f))) for f in files]
    if len(listed) == 1:
        ((_, month, number),) = listed
        return raw.withColumns({"__month": F.lit(month).cast("string"), "__number": F.lit(number).cast("long")})
    named = {name: entry for f, *entry in listed for name in row_names(f)}
    listing = raw.sparkSession.createDataFrame([(k, *v) for k, v in named.items()], "__at string, __month string, __number long")
    return raw.join(F.broadcast(listing), F.col("__path") == F.col("__at"), "left").drop("__at")


def row_names(file: str) -> set[str]:
    """How rows may name a listed file: `file:///` in Spark's listing is `file:/` with rows."""
    return {file, re.sub("^([^/:]+):///", r"\1:/", file)}


def raw_files(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """The files at the paths, in name order: Spark's own listing, which its driver holds anyway."""
    return sorted(spark.read.parquet(*paths).inputFiles())


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A headed CSV under a declared schema; lines that do not fit keep their text in `_corrupt_record`."""
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(with_corrupt)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )


def clean_rows(csv: DataFrame) -> DataFrame:
    """The rows of `read_csv` that fitted."""
    return csv.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def corrupt_rows(csv: DataFrame) -> DataFrame:
    """The lines of `read_csv` that did not fit."""
    return csv.filter(F.col(CORRUPT).isNotNull())


def file_bytes(spark: SparkSession, paths: Sequence[str]) -> int:
    """Bytes of the files at the paths, in partitions below them too, from their listing; no file is opened."""
    if not paths:
        return 0
    return spark.read.format("binaryFile").load(list(paths)).agg(F.sum("length").alias("bytes")).first().bytes or 0


def month_bytes(spark: SparkSession, path: str, months: Sequence[str]) -> int:
    """Bytes of the listed months of a lake table partitioned by `_year` and `_month`."""
    table = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return table.filter(in_months(months)).agg(F.sum("length").alias("bytes")).first().bytes or 0


def in_months(months: Sequence[str], year: str = "_year", month: str = "_month") -> Column:
    """True for rows of the listed yyyy-MM months; on partition columns it prunes directories."""
    by_year: dict[int, list[int]] = {}
    for y, m in map(split_month, months):
        by_year.setdefault(y, []).append(m)
    terms = [(F.col(year) == y) & F.col(month).isin(listed) for y, listed in by_year.items()]
    return reduce(Column.__or__, terms, F.lit(False))


def read_months(spark: SparkSession, path: str, months: Sequence[str] | None = None) -> DataFrame:
    """A lake table partitioned by `_year` and `_month`, restricted to months; None reads all."""
    table = spark.read.parquet(path)
    return table if months is None else table.filter(in_months(months))


def scan(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    where: Column | str | None = None,
) -> DataFrame:
    """Filter, then project; both reach the scan (Parquet or JDBC) through Catalyst."""
    kept = df if where is None else df.filter(where)
    return kept.select(*columns) if columns else kept


def exists(spark: SparkSession, name_or_path: str) -> bool:
    """Whether a catalog table, or a Parquet table at a path, is there."""
    if "/" not in name_or_path:
        return spark.catalog.tableExists(name_or_path)
    try:
        return bool(spark.read.parquet(name_or_path).schema.fields)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def row_counts(spark: SparkSession, tables: Mapping[str, DataFrame | str]) -> DataFrame:
    """(table_name, row_count) for each table, a frame or a path; a path where none is counts null.

    Parquet counts come from file footers.
    """
    found = {
        name: t if isinstance(t, DataFrame) else spark.read.parquet(t) if exists(spark, t) else None
        for name, t in tables.items()
    }
    parts = [
        spark.range(1).select(F.lit(name).alias("table_name"), F.lit(None).cast("long").alias("row_count"))
        if df is None
        else df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in found.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def layer_health(spark: SparkSession, layers: Mapping[str, str]) -> DataFrame:
    """(layer, path, present, files) per layer path, counting files in all partitions."""
    found = {name: exists(spark, path) for name, path in layers.items()}
    rows = [
        (name, path, found[name], len(spark.read.parquet(path).inputFiles()) if found[name] else 0)
        for name, path in layers.items()
    ]
    return spark.createDataFrame(rows, "layer string, path string, present boolean, files int")


def healthy(layers: DataFrame) -> DataFrame:
    """One row: whether every layer of `layer_health` is present, and which are missing."""
    missing = F.sort_array(F.collect_list(F.when(~F.col("present"), F.col("layer"))))
    return layers.agg(F.every("present").alias("healthy"), missing.alias("missing_layers"))
