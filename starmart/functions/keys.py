"""Key expressions: calendar and clock keys, and surrogate keys that do not move."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROW_ID = "_row_id"

# Bit layout of a position key: month number, file number within the month, row number: 1365 years, half a
# million files a month, a billion rows a file.
MONTH_BITS, FILE_BITS, ROW_BITS = 14, 19, 30
FIRST_YEAR = 1000
MAX_FILES_PER_MONTH = 1 << FILE_BITS
MAX_ROWS_PER_FILE = 1 << ROW_BITS

# Copies of one row are written out in blocks of this many, so that no task emits them all.
COPIES_PER_BLOCK = 1 << 16


def date_key(ts: Column) -> Column:
    """yyyymmdd as int."""
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def time_key(ts: Column) -> Column:
    """hhmm as int."""
    return (F.hour(ts) * 100 + F.minute(ts)).cast("int")


def position_key(year: Column, month: Column, file_number: Column, row_index: Column) -> Column:
    """A unique long from where a raw row lies: month, file within the month, row within the file.

    Raw files never change, so the key is the same on every run and needs no
    shuffle and no uniqueness check. A file or row number out of range fails.
    """
    month_number = (year.cast("long") - FIRST_YEAR) * 12 + month - 1
    packed = F.shiftleft(F.shiftleft(month_number, FILE_BITS) + file_number, ROW_BITS) + row_index
    fits = (
        month_number.between(0, (1 << MONTH_BITS) - 1)
        & file_number.between(0, MAX_FILES_PER_MONTH - 1)
        & row_index.between(0, MAX_ROWS_PER_FILE - 1)
    )
    return F.when(fits, packed).otherwise(F.raise_error(F.lit("row position out of key range")).cast("long"))


def with_content_key(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Add `row_id` (text) and `trip_key` (long) derived from row content alone.

    For frames without a file position. Equal rows are interchangeable, so they
    are counted (a map-side combine) and written out again with a copy number:
    the largest group of copies costs one row in the shuffle, and is emitted in
    blocks spread over all tasks. `row_id` is the authoritative key: 64 bits of
    it (`trip_key`) start to collide at billions of rows.

    `columns` limits what is hashed and must tell different rows apart.
    """
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__copies"))
    # Hashed after the shuffle, so the hash does not travel and copies are hashed once.
    text = F.to_json(F.struct(*(columns or df.columns)), {"ignoreNullFields": "false"})
    counted = counted.withColumn("__content", F.sha2(text, 256))
    # Nearly every row has few copies and is written out where it lies. The rest
    # go through one more, tiny, shuffle that spreads their blocks over all tasks.
    few = counted.filter(F.col("__copies") <= COPIES_PER_BLOCK).withColumn("__block", F.lit(0).cast("long"))
    last_block = F.floor((F.col("__copies") - 1) / COPIES_PER_BLOCK)
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = (
        counted.filter(F.col("__copies") > COPIES_PER_BLOCK)
        .withColumn("__block", F.explode(F.sequence(F.lit(0).cast("long"), last_block)))
        .repartition(tasks, "__content", "__block")
    )
    return _number_copies(few, df.columns).unionByName(_number_copies(many, df.columns))


def _number_copies(blocks: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per copy; `__content` and `__block` say which copies of which row."""
    first = F.col("__block") * COPIES_PER_BLOCK
    last = F.least(first + COPIES_PER_BLOCK, F.col("__copies")) - 1
    numbered = blocks.withColumn("__copy", F.explode(F.sequence(first, last)))
    row_id = F.concat_ws("-", F.col("__content"), F.col("__copy"))
    return numbered.select(*columns, row_id.alias("row_id"), F.xxhash64(row_id).alias("trip_key"))
