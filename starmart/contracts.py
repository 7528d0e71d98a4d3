"""Column contracts: align a frame to a declared schema, and report how it fits."""

from __future__ import annotations

from functools import cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart import fixed_values as fixed
from starmart.functions.measures import fit_decimal


TABLES = (
    "RAW_TRIPS",
    "ZONES",
    "BRONZE_TRIPS",
    "DIM_DATE",
    "DIM_TIME",
    "DIM_LOCATION",
    "DIM_VENDOR",
    "DIM_RATECODE",
    "DIM_PAYMENT_TYPE",
    "FACT_TRIPS",
)


@cache
def contract(ddl: str) -> T.StructType:
    """A declared schema from its DDL text (Spark reads it, so a session must be active)."""
    return T.StructType.fromDDL(ddl)


def __getattr__(name: str) -> T.StructType:
    """`contracts.ZONES` and the like, read when first asked for."""
    if name in TABLES:
        return contract(getattr(fixed, name))
    raise AttributeError(name)


def _by_lower_name(df: DataFrame) -> dict[str, T.StructField]:
    return {f.name.lower(): f for f in df.schema.fields}


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


# Whole-number types and the bits they have.
INTEGRAL_BITS = {T.ByteType(): 8, T.ShortType(): 16, T.IntegerType(): 32, T.LongType(): 64}


def narrow(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """The value as the wanted type, null where it does not fit.

    A number out of range is caught by comparison: try_cast raises and catches an
    exception for each, which a column full of them cannot afford.
    """
    if have == want:
        return value  # left bare, so filters on it still reach the scan
    if isinstance(have, (T.FloatType, T.DoubleType)) and isinstance(want, T.DecimalType):
        return fit_decimal(value, want)
    bits = INTEGRAL_BITS.get(want)
    if bits is None or bits == 64 or not isinstance(have, T.NumericType):
        return value.try_cast(want)
    if INTEGRAL_BITS.get(have, 64) < bits:
        return value.cast(want)
    limit = 1 << (bits - 1)
    return F.when((value > -limit - 1) & (value < limit), value.cast(want))


def _cast(field: T.StructField, found: T.StructField) -> Column:
    return narrow(_quoted(found.name), found.dataType, field.dataType)


def align(df: DataFrame, schema: T.StructType, *also: str | Column) -> DataFrame:
    """Exactly the declared columns, in order and type.

    Names match regardless of case. Values that do not fit become null (see
    `lost_values`), absent columns become typed nulls, unknown columns are left
    out unless named in `also`.
    """
    found = _by_lower_name(df)
    columns = []
    for field in schema.fields:
        have = found.get(field.name.lower())
        value = F.lit(None).cast(field.dataType) if have is None else _cast(field, have)
        columns.append(value.alias(field.name))
    return df.select(*columns, *also)


def in_order(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns in declared order; a missing one is an error."""
    return df.select(*schema.fieldNames())


def lost_value(df: DataFrame, field: T.StructField) -> Column:
    """True where a present value does not survive the cast to its declared type."""
    have = _by_lower_name(df).get(field.name.lower())
    if have is None or have.dataType == field.dataType:
        return F.lit(False)
    return _quoted(have.name).isNotNull() & _cast(field, have).isNull()


def losses(df: DataFrame, schema: T.StructType) -> Column:
    """The names of a row's declared columns whose present value does not survive the cast; types that agree cost nothing."""
    found = _by_lower_name(df)
    cast = [f for f in schema.fields if (have := found.get(f.name.lower())) is not None and have.dataType != f.dataType]
    names = [F.when(lost_value(df, f), F.lit(f.name)) for f in cast]
    return F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")


def loses(df: DataFrame, schema: T.StructType) -> Column:
    """True for a row of which `losses` names a column; unlike that, it makes no array."""
    return reduce(Column.__or__, [lost_value(df, f) for f in schema.fields], F.lit(False))


def lost_values(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One row: per declared column, how many present values the cast loses."""
    return df.agg(*[F.count_if(lost_value(df, f)).alias(f.name) for f in schema.fields])


def contract_report(df: DataFrame, schema: T.StructType) -> DataFrame:
    """How a frame fits a contract, one row per column, in one pass over the data.

    status is ok, cast (type differs), missing or unexpected.
    """
    found = _by_lower_name(df)
    declared = {f.name.lower() for f in schema.fields}
    entries, counts = [], []

    def add(name, expected, actual, status, present, lost):
        i = len(entries)
        counts.append(present.alias(f"present_{i}"))
        counts.append(lost.alias(f"lost_{i}"))
        entries.append(
            F.struct(
                F.lit(name).alias("column"),
                F.lit(expected).cast("string").alias("expected"),
                F.lit(actual).cast("string").alias("actual"),
                F.lit(status).alias("status"),
                F.col(f"present_{i}").alias("present_values"),
                F.col(f"lost_{i}").alias("lost_values"),
            )
        )

    for field in schema.fields:
        expected = field.dataType.simpleString()
        have = found.get(field.name.lower())
        if have is None:
            add(field.name, expected, None, "missing", F.count_if(F.lit(False)), F.count_if(F.lit(False)))
            continue
        status = "ok" if have.dataType == field.dataType else "cast"
        add(
            field.name,
            expected,
            have.dataType.simpleString(),
            status,
            F.count(_quoted(have.name)),
            F.count_if(lost_value(df, field)),
        )
    for have in df.schema.fields:
        if have.name.lower() not in declared:
            add(
                have.name,
                None,
                have.dataType.simpleString(),
                "unexpected",
                F.count(_quoted(have.name)),
                F.count_if(F.lit(False)),
            )
    return df.agg(*counts).select(F.inline(F.array(*entries)))
