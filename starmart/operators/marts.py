"""Aggregate marts over the fact: trips, revenue and average duration per grouping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart import fixed_values as fixed
from starmart.functions.measures import exact_average, in_hours
from starmart.operators.star import look_up


def trip_measures(revenue: str = "total_amount", duration: str = "trip_duration_minutes") -> list[Column]:
    """Trips, revenue and average duration, exact on decimals."""
    return [
        F.count(F.lit(1)).alias("trips"),
        F.sum(revenue).alias("revenue"),
        exact_average(F.sum(duration), F.count(duration)).alias("avg_duration_minutes"),
    ]


def mart(fact: DataFrame, *by: str | Column, where: Column | None = None) -> DataFrame:
    """The trip measures per grouping; partial sums combine before the shuffle, so hot keys do not matter."""
    rows = fact if where is None else fact.filter(where)
    return rows.groupBy(*by).agg(*trip_measures())


def by_date_and(fact: DataFrame, key: str) -> DataFrame:
    """Per date and one more key: pickup location, dropoff location, vendor."""
    return mart(fact, "date_key", key)


def by_route(fact: DataFrame) -> DataFrame:
    return mart(fact, "pickup_location_key", "dropoff_location_key")


def high_value(fact: DataFrame, above: float = fixed.HIGH_VALUE_TOTAL) -> DataFrame:
    """Per date, trips whose total is above the limit."""
    return mart(fact, "date_key", where=F.col("total_amount") > above)


def airport(fact: DataFrame, airports: Sequence[int] = tuple(fixed.AIRPORT_LOCATIONS)) -> DataFrame:
    """Per date and direction, trips from or to an airport; a trip between airports counts in both."""
    directions = F.array_compact(
        F.array(
            F.when(F.col("pickup_location_key").isin(list(airports)), F.lit("pickup")),
            F.when(F.col("dropoff_location_key").isin(list(airports)), F.lit("dropoff")),
        )
    )
    return mart(fact.withColumn("direction", F.explode(directions)), "date_key", "direction")


def _sums(fact: DataFrame, *keys: str) -> DataFrame:
    """Additive measures per key."""
    return fact.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum("total_amount").alias("revenue"),
        F.sum("trip_duration_minutes").alias("__minutes"),
        F.count("trip_duration_minutes").alias("__timed"),
    )


def _from_sums(sums: DataFrame, *by: str | Column) -> DataFrame:
    return sums.groupBy(*by).agg(
        F.sum("trips").alias("trips"),
        F.sum("revenue").alias("revenue"),
        exact_average(F.sum("__minutes"), F.sum("__timed")).alias("avg_duration_minutes"),
    )


def by_name(fact: DataFrame, dim: DataFrame, column: str, key: str, names: Sequence[str]) -> DataFrame:
    """Per dimension attribute. Facts are summed per key first, so only sums meet the dimension."""
    return _from_sums(look_up(_sums(fact, column), dim, column, key, attributes=names), *names)


def by_time_of_day(fact: DataFrame, dim_time: DataFrame) -> DataFrame:
    names = ["time_of_day", "is_rush_hour", "is_night"]
    return by_name(fact, dim_time, "pickup_time_key", "time_key", names)


def by_month(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    return by_name(fact, dim_date, "date_key", "date_key", ["year", "month"])


def by_borough(fact: DataFrame, dim_location: DataFrame, column: str = "pickup_location_key") -> DataFrame:
    return by_name(fact, dim_location, column, "location_key", ["borough", "service_zone"])


def by_payment(fact: DataFrame, dim_payment_type: DataFrame) -> DataFrame:
    return by_name(fact, dim_payment_type, "payment_type_key", "payment_type_key", ["payment_type_name"])


def by_weekday_rush(fact: DataFrame, dim_date: DataFrame, dim_time: DataFrame) -> DataFrame:
    """Per weekday-only rush hour: in a rush hour and not on a weekend. Sums per date and minute meet the dimensions."""
    dated = look_up(_sums(fact, "date_key", "pickup_time_key"), dim_date, "date_key", "date_key", attributes=["is_weekend"])
    timed = look_up(dated, dim_time, "pickup_time_key", "time_key", attributes=["is_rush_hour"])
    return _from_sums(timed, (F.col("is_rush_hour") & ~F.col("is_weekend")).alias("is_weekday_rush"))


def count_by(df: DataFrame, *keys: str | Column) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("trip_count"))


def revenue_by(df: DataFrame, key: str, amount: str = "total_amount") -> DataFrame:
    """Sum, average and count of a decimal(10,2) amount per key."""
    return df.groupBy(key).agg(
        F.sum(amount).alias("total_revenue"),
        exact_average(F.sum(amount), F.count(amount)).alias("avg_revenue"),
        F.count(F.lit(1)).alias("trip_count"),
    )


def count_by_hour(df: DataFrame, ts: str) -> DataFrame:
    """Trips per hour of day, in hour order."""
    return count_by(df, F.hour(ts).alias("hour")).orderBy("hour")


def period_of_day(hour: Column) -> Column:
    return F.when(hour < 12, "AM").otherwise("PM")


def is_rush_hour(hour: Column) -> Column:
    return in_hours(hour, fixed.RUSH_HOURS)


def fact_date_range(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """First and last full date of the facts that have a calendar day.

    The distinct keys (days, not trips) are what is joined.
    """
    days = fact.select("date_key").distinct()
    dated = look_up(days, dim_date, "date_key", "date_key", attributes=["full_date"], how="inner")
    return dated.agg(F.min("full_date").alias("min_date"), F.max("full_date").alias("max_date"))


def fare_health(fact: DataFrame, *by: str | Column, fare: str = "fare_amount") -> DataFrame:
    """Rows, null fares, negative fares and the average of positive fares, in one aggregate."""
    value = F.col(fare)
    positive = F.when(value > 0, value)
    return fact.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_trips"),
        F.count_if(value.isNull()).alias("null_fares"),
        F.count_if(value < 0).alias("negative_fares"),
        F.round(F.try_divide(F.sum(positive), F.count(positive)), 2).alias("avg_fare"),
    )


def quality_score(health: DataFrame) -> DataFrame:
    """(1 - issues / total) x 100 and its grade, null when there is no row."""
    issues = F.col("null_fares") + F.col("negative_fares")
    score = F.when(F.col("total_trips") > 0, (1 - issues / F.col("total_trips")) * 100)
    scored = health.withColumn("quality_score", score)
    s = F.col("quality_score")
    grade = (
        F.when(s >= fixed.QUALITY_GOOD, "good")
        .when(s >= fixed.QUALITY_WARN, "warn")
        .when(s.isNotNull(), "bad")
    )
    return scored.withColumn("grade", grade)
