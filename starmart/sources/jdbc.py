"""JDBC source and sink: options, parallel reads, bounded writes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from starmart.fixed_values import JDBC_BATCH_ROWS
from starmart.sources.scan import scan


def read_options(
    connection: Mapping[str, str],
    table: str,
    split_on: str | None = None,
    bounds: tuple[str, str] | None = None,
    tasks: int = 1,
) -> dict[str, str]:
    """Reader options; with `split_on` and its `bounds` the table is read by `tasks` parallel queries."""
    options = {**connection, "dbtable": table}
    if split_on is None:
        return options
    if bounds is None:
        raise ValueError("a split column needs its lower and upper bound")
    low, high = bounds
    return {
        **options,
        "partitionColumn": split_on,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(tasks),
    }


def read_jdbc(
    spark: SparkSession,
    connection: Mapping[str, str],
    table: str,
    columns: Sequence[str] | None = None,
    where: Column | str | None = None,
    **split,
) -> DataFrame:
    """A database table; the filter and the column list run in the database."""
    source = spark.read.format("jdbc").options(**read_options(connection, table, **split)).load()
    return scan(source, columns, where)


def write_options(connection: Mapping[str, str], table: str, connections: int) -> dict[str, str]:
    """Writer options: `connections` bounds how many tasks write at once.

    `truncate` makes overwrite keep the table's definition instead of dropping it.
    """
    return {
        **connection,
        "dbtable": table,
        "batchsize": str(JDBC_BATCH_ROWS),
        "numPartitions": str(connections),
        "truncate": "true",
    }


def write_jdbc(
    df: DataFrame,
    connection: Mapping[str, str],
    table: str,
    mode: str = "append",
    connections: int = 16,
) -> None:
    """Write to a database table: append, overwrite (truncate, then insert), error or ignore."""
    df.write.format("jdbc").options(**write_options(connection, table, connections)).mode(mode).save()
