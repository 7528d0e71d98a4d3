"""Measure expressions: exact money, durations, hour bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)


def fit_decimal(value: Column, want: T.DecimalType) -> Column:
    """A number as a decimal, half up; null where it does not fit (or is NaN)."""
    limit = 10 ** (want.precision - want.scale) - 0.5 * 10**-want.scale
    return F.when(F.abs(value) < limit, value.cast(want))


def decimal(value: Column) -> Column:
    """decimal(10,2), half up; null where it does not fit (or is NaN)."""
    return fit_decimal(value, MONEY)


def exact_average(total: Column, count: Column) -> Column:
    """A decimal(10,2) total over its count, as decimal(14,6); null where the count is zero.

    Spark's avg of such decimals adds doubles, which is neither exact nor the same
    in every order once the sums pass 2^53.
    """
    return F.try_divide(total.cast("decimal(20,2)"), count).cast("decimal(14,6)")


def seconds_between(start: Column, end: Column) -> Column:
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def minutes_between(start: Column, end: Column) -> Column:
    """Whole seconds over sixty, as decimal(10,2)."""
    return decimal(seconds_between(start, end) / 60)


def in_hours(hour: Column, bands: Sequence[tuple[int, int]]) -> Column:
    """True when the hour lies in any [first, last) band."""
    inside = F.lit(False)
    for first, last in bands:
        inside = inside | ((hour >= first) & (hour < last))
    return inside


def band_name(hour: Column, bands: Sequence[tuple[int, int, str]]) -> Column:
    """Name of the [first, last) band that holds the hour, null outside all."""
    first_band, *others = [(in_hours(hour, [(lo, hi)]), name) for lo, hi, name in bands]
    named = F.when(first_band[0], first_band[1])
    for inside, name in others:
        named = named.when(inside, name)
    return named


def percent(part: Column, whole: Column) -> Column:
    """part / whole x 100, zero when there is nothing to take a part of."""
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))


def rate(part: Column, whole: Column) -> Column:
    """part / whole, zero when there is nothing to take a part of."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))
