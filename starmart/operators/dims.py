"""Dimension generators: calendar, minute of day, coded lists, lookups."""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart import contracts
from starmart import fixed_values as fixed
from starmart.functions.keys import date_key
from starmart.functions.measures import band_name, in_hours


def date_attributes(day: Column) -> list[Column]:
    """The calendar columns of a date, in contract order."""
    return [
        date_key(day).alias("date_key"),
        day.alias("full_date"),
        F.year(day).cast("short").alias("year"),
        F.month(day).cast("short").alias("month"),
        F.dayofmonth(day).cast("short").alias("day"),
        F.dayofweek(day).cast("short").alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.weekofyear(day).cast("short").alias("week_of_year"),
        F.dayofweek(day).isin(fixed.WEEKEND_DAYS).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
        F.quarter(day).cast("short").alias("quarter"),
    ]


def time_attributes(hour: Column) -> list[Column]:
    """The clock columns of an hour."""
    return [
        band_name(hour, fixed.TIME_OF_DAY).alias("time_of_day"),
        in_hours(hour, fixed.RUSH_HOURS).alias("is_rush_hour"),
        in_hours(hour, fixed.NIGHT_HOURS).alias("is_night"),
    ]


def date_range(df: DataFrame, ts: str) -> DataFrame:
    """One row: first and last date of a timestamp, both null when there is none."""
    day = F.to_date(ts)
    return df.agg(F.min(day).alias("min_date"), F.max(day).alias("max_date"))


def with_buffer_years(bounds: DataFrame) -> DataFrame:
    """Widen a date range to Jan 1 of the year before and Dec 31 of the year after."""
    return bounds.select(
        F.make_date(F.year("min_date") - 1, F.lit(1), F.lit(1)).alias("min_date"),
        F.make_date(F.year("max_date") + 1, F.lit(12), F.lit(31)).alias("max_date"),
    )


def calendar_over(bounds: DataFrame) -> DataFrame:
    """The calendar between the dates of a one-row frame, both included; null bounds give no rows.

    The range stays in the plan, so a calendar built from data needs no collect.
    Years are listed first and their days after, so that no row holds a long
    range, however far a stray date lies.
    """
    first, last = F.col("min_date"), F.col("max_date")
    years = bounds.select(first, last, F.explode(F.sequence(F.year(first), F.year(last))).alias("__year"))
    january, december = F.make_date("__year", F.lit(1), F.lit(1)), F.make_date("__year", F.lit(12), F.lit(31))
    days = F.sequence(F.greatest(january, first), F.least(december, last))
    return years.select(F.explode(days).alias("__day")).select(*date_attributes(F.col("__day")))


def calendar(spark: SparkSession, first: date, last: date) -> DataFrame:
    """The calendar between two dates, both included."""
    bounds = spark.range(0, 1, 1, 1).select(F.lit(first).alias("min_date"), F.lit(last).alias("max_date"))
    return calendar_over(bounds)


def minute_of_day(spark: SparkSession) -> DataFrame:
    """One row per minute of the day, every hour with every minute: 1440 rows."""
    clock = spark.range(0, 24 * 60, 1, 1).selectExpr(
        "CAST(id DIV 60 AS SMALLINT) AS hour", "CAST(id % 60 AS SMALLINT) AS minute"
    )
    key = (F.col("hour").cast("int") * 100 + F.col("minute")).alias("time_key")
    return clock.select(key, "hour", "minute", *time_attributes(F.col("hour")))


def coded(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A short list of codes as a frame of the declared types: one literal, folded into the plan."""
    entries = json.dumps([dict(zip(schema.fieldNames(), row, strict=True)) for row in rows])
    return spark.range(0, 1, 1, 1).select(F.inline(F.from_json(F.lit(entries), T.ArrayType(schema))))


def vendors(spark: SparkSession) -> DataFrame:
    return coded(spark, [(k, k, name) for k, name in fixed.VENDORS], contracts.DIM_VENDOR)


def rate_codes(spark: SparkSession) -> DataFrame:
    return coded(spark, [(k, k, name, text) for k, name, text in fixed.RATE_CODES], contracts.DIM_RATECODE)


def payment_types(spark: SparkSession) -> DataFrame:
    return coded(spark, [(k, k, name) for k, name in fixed.PAYMENT_TYPES], contracts.DIM_PAYMENT_TYPE)


def unknown_locations(spark: SparkSession) -> DataFrame:
    """Placeholders, to be inserted where the lookup has no such zone."""
    return coded(spark, fixed.UNKNOWN_LOCATIONS, contracts.DIM_LOCATION)


def locations(zones: DataFrame) -> DataFrame:
    """The location dimension from the zone lookup; the natural id is the key."""
    return zones.select(
        F.col("LocationID").alias("location_key"),
        F.col("LocationID").alias("location_id"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone_name"),
        F.col("service_zone").alias("service_zone"),
    )
