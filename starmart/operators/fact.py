"""The fact build: one projection from gated trips to keys and exact measures."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart import fixed_values as fixed
from starmart.contracts import narrow
from starmart.functions.keys import ROW_ID, date_key, time_key
from starmart.functions.measures import MONEY, decimal, minutes_between


@dataclass(frozen=True)
class FactSpec:
    """Which source columns make up a fact, and under which names.

    codes and measures map a fact column to (source column, default or None).
    """

    key: str
    pickup: str
    dropoff: str
    locations: Mapping[str, str]
    codes: Mapping[str, tuple[str, int | None]]
    measures: Mapping[str, tuple[str, int | None]]
    counts: Mapping[str, str] = field(default_factory=dict)
    duration: str = "trip_duration_minutes"
    carried: tuple[str, ...] = ()

    def source_columns(self) -> set[str]:
        coded = {source for source, _ in [*self.codes.values(), *self.measures.values()]}
        return {self.pickup, self.dropoff, *self.locations.values(), *coded, *self.counts.values(), *self.carried}


# The trip fact, source column and default per fact column.
TRIPS = FactSpec(
    key="trip_key",
    pickup="tpep_pickup_datetime",
    dropoff="tpep_dropoff_datetime",
    locations={
        "pickup_location_key": "PULocationID",
        "dropoff_location_key": "DOLocationID",
    },
    codes={
        "vendor_key": ("VendorID", fixed.DEFAULT_VENDOR),
        "ratecode_key": ("RatecodeID", fixed.DEFAULT_RATE_CODE),
        "payment_type_key": ("payment_type", fixed.DEFAULT_PAYMENT_TYPE),
    },
    counts={"passenger_count": "passenger_count"},
    measures={
        "trip_distance_miles": ("trip_distance", None),
        "fare_amount": ("fare_amount", None),
        "extra_amount": ("extra", None),
        "mta_tax": ("mta_tax", None),
        "tip_amount": ("tip_amount", None),
        "tolls_amount": ("tolls_amount", None),
        "improvement_surcharge": ("improvement_surcharge", None),
        "congestion_surcharge": ("congestion_surcharge", 0),
        "airport_fee": ("Airport_fee", 0),
        "total_amount": ("total_amount", None),
    },
    carried=("_source_file", "_ingestion_ts"),
)


def or_default(value: Column, default: int | None) -> Column:
    """The value, or the default where it is null."""
    return value if default is None else F.coalesce(value, F.lit(default))


def _whole(df: DataFrame, column: str, want: T.DataType) -> Column:
    return narrow(F.col(column), df.schema[column].dataType, want)


def code_columns(trips: DataFrame, spec: FactSpec = TRIPS) -> dict[str, Column]:
    """Code keys, with the default where the code is missing."""
    return {
        fk: or_default(_whole(trips, source, T.IntegerType()), default).alias(fk)
        for fk, (source, default) in spec.codes.items()
    }


def measure_columns(trips: DataFrame, spec: FactSpec = TRIPS) -> dict[str, Column]:
    """Counts as short and amounts as decimal(10,2), with the default where one is missing."""
    counts = {
        name: _whole(trips, source, T.ShortType()).alias(name) for name, source in spec.counts.items()
    }
    exact = {
        name: or_default(decimal(F.col(source)), default).cast(MONEY).alias(name)
        for name, (source, default) in spec.measures.items()
    }
    return {**counts, **exact}


def key_columns(trips: DataFrame, spec: FactSpec = TRIPS) -> dict[str, Column]:
    """Calendar, clock, location and code keys."""
    pickup, dropoff = F.col(spec.pickup), F.col(spec.dropoff)
    return {
        "date_key": date_key(pickup).alias("date_key"),
        "pickup_time_key": time_key(pickup).alias("pickup_time_key"),
        "dropoff_time_key": time_key(dropoff).alias("dropoff_time_key"),
        **{fk: _whole(trips, source, T.IntegerType()).alias(fk) for fk, source in spec.locations.items()},
        **code_columns(trips, spec),
    }


def build_fact(trips: DataFrame, spec: FactSpec = TRIPS, *also: str | Column) -> DataFrame:
    """The fact table: a single projection, so it runs inside the scan's stage.

    The surrogate key is the row id the bronze layer carries; a frame without one
    gives a fact without a surrogate key (see `with_content_key`). `also` carries
    further columns, such as the lake's partition columns.
    """
    key = [F.col(ROW_ID).alias(spec.key)] if ROW_ID in trips.columns else []
    measures = measure_columns(trips, spec)
    duration = minutes_between(F.col(spec.pickup), F.col(spec.dropoff)).alias(spec.duration)
    after_distance = list(measures)[: len(spec.counts) + 1]
    ordered = [
        *[measures[name] for name in after_distance],
        duration,
        *[measures[name] for name in measures if name not in after_distance],
    ]
    return trips.select(*key, *key_columns(trips, spec).values(), *ordered, *spec.carried, *also)
