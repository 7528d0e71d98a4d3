"""The star: which tables it has, joining them, and checking that every key resolves."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ForeignKey:
    """A fact column, the dimension it points to and the prefix its attributes get."""

    column: str
    dim: str
    key: str
    prefix: str = ""


@dataclass(frozen=True)
class StarSpec:
    fact: str
    fact_key: str
    foreign_keys: tuple[ForeignKey, ...]
    unique: Mapping[str, tuple[str, ...]]

    @property
    def dimensions(self) -> list[str]:
        return list(dict.fromkeys(fk.dim for fk in self.foreign_keys))

    @property
    def tables(self) -> list[str]:
        return [self.fact, *self.dimensions]


# The trip star.
TRIP_STAR = StarSpec(
    fact="fact_trips",
    fact_key="trip_key",
    foreign_keys=(
        ForeignKey("date_key", "dim_date", "date_key"),
        ForeignKey("pickup_time_key", "dim_time", "time_key", "pickup_"),
        ForeignKey("dropoff_time_key", "dim_time", "time_key", "dropoff_"),
        ForeignKey("pickup_location_key", "dim_location", "location_key", "pickup_"),
        ForeignKey("dropoff_location_key", "dim_location", "location_key", "dropoff_"),
        ForeignKey("vendor_key", "dim_vendor", "vendor_key"),
        ForeignKey("ratecode_key", "dim_ratecode", "ratecode_key"),
        ForeignKey("payment_type_key", "dim_payment_type", "payment_type_key"),
    ),
    unique={
        "dim_date": ("date_key", "full_date"),
        "dim_time": ("time_key",),
        "dim_location": ("location_key", "location_id"),
        "dim_vendor": ("vendor_key", "vendor_id"),
        "dim_ratecode": ("ratecode_key", "ratecode_id"),
        "dim_payment_type": ("payment_type_key", "payment_type_id"),
        "fact_trips": ("trip_key",),
    },
)


def look_up(
    facts: DataFrame,
    lookup: DataFrame,
    column: str,
    key: str,
    prefix: str = "",
    attributes: Sequence[str] | None = None,
    how: str = "left",
) -> DataFrame:
    """Join a lookup's attributes to facts; left keeps facts that find nothing, with nulls.

    Attributes take `prefix` (for a dimension in several roles). Spark picks the
    join by the lookup's bytes: below its broadcast threshold the facts do not
    move, and adaptive execution splits a hot key where they do.
    """
    kept = [c for c in (attributes or lookup.columns) if c != key]
    # Names take their prefix after the join: a dimension in two roles is then the
    # same side twice, read and broadcast once.
    side = lookup.select(F.col(key).alias("__key"), *[F.col(c).alias(f"__{c}") for c in kept])
    joined = facts.join(side, F.col(column) == F.col("__key"), how)
    return joined.select(*facts.columns, *[F.col(f"__{c}").alias(f"{prefix}{c}") for c in kept])


def star_join(
    fact: DataFrame,
    dims: Mapping[str, DataFrame],
    spec: StarSpec = TRIP_STAR,
    attributes: Mapping[str, Sequence[str]] | None = None,
    how: str = "left",
) -> DataFrame:
    """Facts with the attributes of every dimension, each role joined on its own.

    `attributes` narrows the columns per dimension. Planning reads nothing: Spark
    broadcasts the dimensions whose bytes allow it, in one stage over the fact.
    """
    joined = fact
    for fk in spec.foreign_keys:
        wanted = (attributes or {}).get(fk.dim)
        joined = look_up(joined, dims[fk.dim], fk.column, fk.key, fk.prefix, wanted, how)
    return joined


def fk_orphans(fact: DataFrame, dims: Mapping[str, DataFrame], spec: StarSpec = TRIP_STAR) -> DataFrame:
    """(fk, orphan_rows, orphan_keys) for every foreign key, in one pass over the fact.

    Facts are first counted per (foreign key, value), combined before the shuffle,
    so neither a hot value nor the fact's size reaches the join with the
    dimensions, and no dimension has to fit a broadcast. Null keys are a matter
    for the not-null checks.
    """
    values = [F.struct(F.lit(fk.column).alias("fk"), F.col(fk.column).cast("long").alias("value")) for fk in spec.foreign_keys]
    used = (
        fact.select(F.inline(F.array(*values)))
        .filter(F.col("value").isNotNull())
        .groupBy("fk", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    known = reduce(
        DataFrame.unionByName,
        [
            dims[fk.dim].select(F.lit(fk.column).alias("fk"), F.col(fk.key).cast("long").alias("value"))
            for fk in spec.foreign_keys
        ],
    ).withColumn("known", F.lit(True))
    missing = F.col("known").isNull()
    return (
        used.join(known, ["fk", "value"], "left")
        .groupBy("fk")
        .agg(
            F.coalesce(F.sum(F.when(missing, F.col("rows"))), F.lit(0)).alias("orphan_rows"),
            F.count_if(missing).alias("orphan_keys"),
        )
    )
