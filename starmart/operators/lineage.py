"""Lineage columns: where a row came from, when it was loaded, which month it belongs to."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions.keys import MAX_FILES_PER_MONTH, ROW_ID, position_key

# The number of a raw file within its month, as the file register of a lake has it.
FILE = "_file"

# Fixed value: how a month is written in a path; standing alone, so not inside a number or a hash.
MONTH_PATTERN = r"(?<![0-9A-Za-z])([0-9]{4}-(?:0[1-9]|1[0-2]))(?![0-9A-Za-z])"
LAST_MONTH = ".*" + MONTH_PATTERN


def split_month(month: str) -> tuple[int, int]:
    """'2023-01' to (2023, 1); anything else is an error."""
    if re.fullmatch(MONTH_PATTERN, month) is None:
        raise ValueError(f"not a yyyy-MM month: {month!r}")
    return int(month[:4]), int(month[5:])


def month_of_path(path: str) -> str | None:
    """The last yyyy-MM in a path: of the file's name, else of the nearest folder."""
    found = re.match(LAST_MONTH, path, re.DOTALL)
    return found[1] if found else None


def month_in_path(path: Column) -> Column:
    """`month_of_path` as a column expression, null when there is none."""
    return F.nullif(F.regexp_extract(path, LAST_MONTH, 1), F.lit(""))


def add_lineage(df: DataFrame, source_file: Column, source_month: Column, loaded_at: Column) -> DataFrame:
    """Add `_source_file`, `_source_month`, `_ingestion_ts`, `_year`, `_month`.

    The month is the file's, not the row's: late rows stay with the file that
    brought them. The load time is one value per run, given by the caller.
    """
    return df.select(
        "*",
        source_file.alias("_source_file"),
        source_month.alias("_source_month"),
        loaded_at.alias("_ingestion_ts"),
        F.substring(source_month, 1, 4).cast("int").alias("_year"),
        F.substring(source_month, 6, 2).cast("int").alias("_month"),
    )


def plain_path(path: str) -> str:
    """A path as Spark lists it, without its URL escapes; `file:///` and `file:/` are one."""
    return re.sub(r"^([^/:]+):///", r"\1:/", unquote(path))


def plain_path_of(path: Column) -> Column:
    """`plain_path` as a column expression. A plus sign is no space here, as it is in a form."""
    return F.regexp_replace(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), "^([^/:]+):///", "$1:/")


def number_files(
    paths: Sequence[str], known: Mapping[tuple[str, str], int] | None = None
) -> list[tuple[str, str, int]]:
    """(month, path, number within the month) of each file.

    A file is its whole path, so files of one name in two folders are two. One in `known` (by month and path) keeps its
    number. New ones take the next free numbers of their month in path order, so no number is ever used again.
    """
    numbers = dict(known or {})
    free: dict[str, int] = {}
    for (month, _), number in numbers.items():
        free[month] = max(free.get(month, 0), number + 1)
    by_month: dict[str, list[str]] = {}
    for path in sorted(set(map(plain_path, paths))):
        by_month.setdefault(month_of_path(path) or "", []).append(path)
    for month, own in by_month.items():
        for path in own:
            if (month, path) not in numbers:
                numbers[month, path] = free.get(month, 0)
                free[month] = numbers[month, path] + 1
        if free[month] > MAX_FILES_PER_MONTH:
            raise ValueError(f"{free[month]} files in {month}, more than {MAX_FILES_PER_MONTH}")
    return [(month, path, numbers[month, path]) for month, own in by_month.items() for path in own]


def add_row_id(df: DataFrame, numbered: Sequence[tuple[str, str, int]], path: Column, row_index: Column) -> DataFrame:
    """Add `_file`, the file's number within the month, and `_row_id`: month, that number and the row's number.

    Where every month is a single file the number is zero and there is nothing to
    look up; else the list of files (at most MAX_FILES_PER_MONTH a month, as
    checked) is looked up; Spark broadcasts it by its bytes.
    """
    if all(number == 0 for _, _, number in numbered):
        located, file_number = df, F.lit(0).cast("long")
    else:
        listing = df.sparkSession.createDataFrame(numbered, "__month string, __at string, __number long")
        located, file_number = df.join(listing, plain_path_of(path) == F.col("__at"), "left").drop("__month", "__at"), F.col("__number")
    row_id = position_key(F.col("_year"), F.col("_month"), file_number, row_index)
    return located.withColumns({FILE: file_number.cast("int"), ROW_ID: row_id}).drop("__number")
