"""The quality gate: named row rules, and the split they make."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.fixed_values import MAX_TRIP_SECONDS
from starmart.functions.measures import percent, seconds_between


@dataclass(frozen=True)
class Rule:
    """A row passes when `keep` is true; false and null both fail."""

    name: str
    keep: Column

    @property
    def fails(self) -> Column:
        return ~F.coalesce(self.keep, F.lit(False))


def present(column: str) -> Rule:
    return Rule(f"{column}_present", F.col(column).isNotNull())


def at_least(column: str, low) -> Rule:
    return Rule(f"{column}_at_least_{low}", F.col(column) >= low)


def above(column: str, low) -> Rule:
    return Rule(f"{column}_above_{low}", F.col(column) > low)


def in_order(first: str, then: str) -> Rule:
    """Strictly: equal timestamps fail."""
    return Rule(f"{then}_after_{first}", F.col(then) > F.col(first))


def shorter_than(first: str, then: str, seconds: int) -> Rule:
    return Rule(f"shorter_than_{seconds}s", seconds_between(F.col(first), F.col(then)) < seconds)


def before(column: str, limit) -> Rule:
    """Optional upper bound on an event date, given as a date, a time or their text."""
    return Rule(f"{column}_in_bound", F.col(column) < F.lit(limit))


def finite(column: str) -> Rule:
    """Optional: NaN passes a >= rule, this one rejects it along with the infinities."""
    value = F.col(column)
    return Rule(f"{column}_finite", ~F.isnan(value) & (F.abs(value) < F.lit(float("inf"))))


def distance_when_paid(distance: str, fare: str) -> Rule:
    """Optional: a fare above zero needs a distance above zero."""
    return Rule("distance_when_paid", (F.col(fare) <= 0) | (F.col(distance) > 0))


def trip_rules(
    pickup: str = "tpep_pickup_datetime",
    dropoff: str = "tpep_dropoff_datetime",
    amounts: Sequence[str] = ("fare_amount", "total_amount", "trip_distance"),
    locations: Sequence[str] = ("PULocationID", "DOLocationID"),
    max_seconds: int = MAX_TRIP_SECONDS,
) -> list[Rule]:
    """The standard gate for trips."""
    return [
        present(pickup),
        present(dropoff),
        in_order(pickup, dropoff),
        *[at_least(amount, 0) for amount in amounts],
        shorter_than(pickup, dropoff, max_seconds),
        *[present(location) for location in locations],
        *[above(location, 0) for location in locations],
    ]


def _all(rules: Sequence[Rule]) -> Column:
    return reduce(Column.__and__, [r.keep for r in rules])


def passes(rules: Sequence[Rule]) -> Column:
    """True or false, never null."""
    return F.coalesce(_all(rules), F.lit(False))


def failed_rules(rules: Sequence[Rule]) -> Column:
    """Names of the rules a row fails, in rule order; empty for an accepted row."""
    none = F.array().cast("array<string>")
    return F.concat(none, *[F.when(r.fails, F.array(F.lit(r.name))).otherwise(none) for r in rules])


def accepted(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows passing every rule. The bare predicates are kept so the scan can use them."""
    return df.filter(_all(rules))


def rejected(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows failing any rule, with the names of the failed rules."""
    return df.filter(~passes(rules)).withColumn("failed_rules", failed_rules(rules))


def tagged(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """All rows with `failed_rules` and `_accepted`, for one write that holds both sides."""
    with_failures = df.withColumn("failed_rules", failed_rules(rules))
    return with_failures.withColumn("_accepted", F.size("failed_rules") == 0)


def rejection_rate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row: rows in, accepted, rejected and the percentage rejected (0 when empty)."""
    counted = df.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(passes(rules)).alias("rows_accepted"),
    )
    rows_rejected = F.col("rows_in") - F.col("rows_accepted")
    return counted.select(
        "rows_in",
        "rows_accepted",
        rows_rejected.alias("rows_rejected"),
        percent(rows_rejected, F.col("rows_in")).alias("rejected_percent"),
    )


def rejects_by_rule(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(rule, rejected_rows), one row per rule even when it rejects nothing; no row is shuffled."""
    counts = df.agg(*[F.count_if(r.fails).alias(r.name) for r in rules])
    pairs = [F.struct(F.lit(r.name).alias("rule"), F.col(f"`{r.name}`").alias("rejected_rows")) for r in rules]
    return counts.select(F.inline(F.array(*pairs)))


def not_allowed(column: str, values: Sequence) -> Column:
    """True for a value outside the list; null is neither in nor out."""
    return ~F.col(column).isin(list(values))


def out_of_order(first: str, then: str) -> Column:
    """True when `first` is strictly later than `then`; equal is in order."""
    return F.col(first) > F.col(then)
