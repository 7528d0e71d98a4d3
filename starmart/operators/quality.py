"""Data-quality checks as rows: all row checks of a frame run in one aggregate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions.measures import rate
from starmart.operators.star import StarSpec

REPORT = ["dataset", "check", "column", "total_rows", "observed", "fraction", "threshold", "passed"]


@dataclass(frozen=True)
class RowCheck:
    """Counts rows where `violated` is true; passes while their share is within the threshold."""

    check: str
    column: str
    violated: Column
    threshold: float = 0.0


@dataclass
class Checks:
    """Checks to run on one frame. Methods chain; `report` gives one row per check."""

    df: DataFrame
    dataset: str
    row_checks: list[RowCheck] = field(default_factory=list)
    unique_checks: list[tuple[tuple[str, ...], bool]] = field(default_factory=list)

    def nulls(self, columns: Sequence[str], threshold: float = 0.0) -> Checks:
        """The share of nulls per column is at most the threshold."""
        for c in columns:
            self.row_checks.append(RowCheck("null_check", c, F.col(c).isNull(), threshold))
        return self

    def between(self, column: str, low=None, high=None) -> Checks:
        """No value below `low` or above `high`; nulls are not counted, no bound finds nothing."""
        violated = F.lit(False)
        if low is not None:
            violated = violated | (F.col(column) < low)
        if high is not None:
            violated = violated | (F.col(column) > high)
        self.row_checks.append(RowCheck("range_check", column, violated))
        return self

    def allowed(self, column: str, values: Sequence) -> Checks:
        """No value outside the list; nulls are not counted."""
        self.row_checks.append(RowCheck("domain_check", column, ~F.col(column).isin(list(values))))
        return self

    def unique(self, *columns: str, approximate: bool = False) -> Checks:
        """No two rows share the value (null counts as one value); approximate is for screening."""
        self.unique_checks.append((columns, approximate))
        return self

    def report(self) -> DataFrame:
        """(dataset, check, column, total_rows, observed, fraction, threshold, passed)."""
        parts = [_count_violations(self.df, self.row_checks)] if self.row_checks else []
        exact = [columns for columns, approximate in self.unique_checks if not approximate]
        parts += [_count_duplicates(self.df, exact)] if exact else []
        parts += [_estimate_duplicates(self.df, columns) for columns, approximate in self.unique_checks if approximate]
        counted = reduce(DataFrame.unionByName, parts)
        share = rate(F.col("observed"), F.col("total_rows"))
        return counted.select(
            F.lit(self.dataset).alias("dataset"),
            "check",
            "column",
            "total_rows",
            "observed",
            F.round(share, 4).alias("fraction"),
            "threshold",
            (share <= F.col("threshold")).alias("passed"),
        )


def _count_violations(df: DataFrame, checks: Sequence[RowCheck]) -> DataFrame:
    counts = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(c.violated).alias(f"violated_{i}") for i, c in enumerate(checks)],
    )
    entries = [
        F.struct(
            F.lit(c.check).alias("check"),
            F.lit(c.column).alias("column"),
            F.col("total_rows").alias("total_rows"),
            F.col(f"violated_{i}").alias("observed"),
            F.lit(float(c.threshold)).alias("threshold"),
        )
        for i, c in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*entries)))


def _count_duplicates(df: DataFrame, checks: Sequence[Sequence[str]]) -> DataFrame:
    """Rows minus distinct values, per check, in one scan and one shuffle of all checks' values together.

    Each check has columns of its own, null in the rows of the others, so that one grouping holds all. Equal values
    combine before the shuffle, so a hot value costs one row a task.
    """
    number = "__check"
    own = [[F.col(c).alias(f"__{k}_{i}") for i, c in enumerate(columns)] for k, columns in enumerate(checks)]
    names = [f"__{k}_{i}" for k, columns in enumerate(checks) for i in range(len(columns))]
    kinds = {f"__{k}_{i}": df.schema[c].dataType for k, columns in enumerate(checks) for i, c in enumerate(columns)}
    narrow = df.select(*[c for columns in own for c in columns])
    held = F.struct(*[
        F.when(F.col(number) == k, F.col(n)).otherwise(F.lit(None).cast(kinds[n])).alias(n)
        for k, columns in enumerate(checks)
        for n in (f"__{k}_{i}" for i in range(len(columns)))
    ])
    stacked = narrow.withColumn(number, F.explode(F.sequence(F.lit(0), F.lit(len(checks) - 1)))).select(number, held.alias("__value"))
    per_value = stacked.select(number, "__value.*").groupBy(number, *names).agg(F.count(F.lit(1)).alias("__rows"))
    counted = per_value.groupBy(number).agg(F.sum("__rows").alias("total_rows"), F.count(F.lit(1)).alias("__distinct"))
    labels = df.sparkSession.createDataFrame([(k, ",".join(c)) for k, c in enumerate(checks)], f"{number} int, column string")
    return _uniqueness(labels.join(counted, number, "left"))


def _estimate_duplicates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    value = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    counted = df.agg(F.count(F.lit(1)).alias("total_rows"), F.approx_count_distinct(value).alias("__distinct"))
    return _uniqueness(counted.withColumn("column", F.lit(",".join(columns))))


def _uniqueness(counted: DataFrame) -> DataFrame:
    """Check rows from (column, total_rows, __distinct); an empty table has no row of either."""
    total, distinct = (F.coalesce(c, F.lit(0)) for c in ("total_rows", "__distinct"))
    return counted.select(
        F.lit("uniqueness_check").alias("check"),
        "column",
        total.alias("total_rows"),
        F.greatest(total - distinct, F.lit(0)).alias("observed"),
        F.lit(0.0).alias("threshold"),
    )


def summary(report: DataFrame) -> DataFrame:
    """Checks in total, passed and failed, and whether all passed, per dataset."""
    return report.groupBy("dataset").agg(
        F.max("total_rows").alias("total_rows"),
        F.count(F.lit(1)).alias("checks_total"),
        F.count_if("passed").alias("checks_passed"),
        F.count_if(~F.col("passed")).alias("checks_failed"),
        F.every("passed").alias("all_passed"),
    )


# What the calendar and clock columns may hold.
CALENDAR_DOMAINS = {"month": (1, 12), "day": (1, 31), "day_of_week": (1, 7), "quarter": (1, 4)}
CLOCK_DOMAINS = {"hour": (0, 23), "minute": (0, 59)}
TIME_OF_DAY_NAMES = ["Morning", "Afternoon", "Evening", "Night"]


def calendar_constraints(df: DataFrame, dataset: str = "dim_date") -> Checks:
    checks = Checks(df, dataset)
    for column, (low, high) in CALENDAR_DOMAINS.items():
        checks.between(column, low, high)
    return checks


def clock_constraints(df: DataFrame, dataset: str = "dim_time") -> Checks:
    checks = Checks(df, dataset)
    for column, (low, high) in CLOCK_DOMAINS.items():
        checks.between(column, low, high)
    return checks.allowed("time_of_day", TIME_OF_DAY_NAMES)


def key_checks(tables: Mapping[str, DataFrame], spec: StarSpec, required: Mapping[str, Sequence[str]]) -> DataFrame:
    """Primary key, unique and not-null constraints of the star's tables, as one report."""
    reports = []
    for name, df in tables.items():
        checks = Checks(df, name).nulls(list(required.get(name, [])))
        for column in spec.unique.get(name, ()):
            checks.unique(column)
        if checks.row_checks or checks.unique_checks:
            reports.append(checks.report())
    return reduce(DataFrame.unionByName, reports)
