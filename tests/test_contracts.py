"""Contracts: alignment, narrowing, lost values, the report."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart import contracts
from starmart.contracts import align, contract, contract_report, in_order, lost_values, narrow


def test_field_counts_and_types(spark):
    assert len(contracts.RAW_TRIPS) == 19
    assert len(contracts.BRONZE_TRIPS) == 24
    assert len(contracts.FACT_TRIPS) == 23
    assert contracts.RAW_TRIPS["tpep_pickup_datetime"].dataType == T.TimestampType()
    assert contracts.FACT_TRIPS["fare_amount"].dataType == T.DecimalType(10, 2)
    assert not contracts.ZONES["LocationID"].nullable


def test_unknown_contract_is_an_error():
    with pytest.raises(AttributeError):
        contracts.NO_SUCH_TABLE


def test_align_adds_missing_drops_unknown_and_ignores_case(spark):
    df = spark.createDataFrame([(1, 2.0, "x")], "vendorid long, AIRPORT_FEE double, other string")
    row = align(df, contracts.RAW_TRIPS)
    assert row.schema.simpleString() == contracts.RAW_TRIPS.simpleString()
    first = row.first()
    assert (first.VendorID, first.Airport_fee, first.fare_amount) == (1, 2.0, None)


def test_in_order_needs_every_column(trips, zones):
    assert in_order(zones.select("Zone", "Borough", "service_zone", "LocationID"), contracts.ZONES).columns == [
        "LocationID", "Borough", "Zone", "service_zone",
    ]
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        in_order(trips, contracts.ZONES)


NUMBERS = [0.0, -0.0, 1.9, -1.9, 127.0, 127.9, 128.0, -128.9, -129.0, 32767.5, 32768.0, 2147483647.9, 2147483648.0,
           -2147483648.9, -2147483649.0, 99999999.99, 99999999.994, 99999999.996, -99999999.995, 1e300,
           float("nan"), float("inf"), None]


@pytest.mark.parametrize("want", ["tinyint", "smallint", "int", "bigint", "decimal(10,2)", "decimal(4,2)"])
def test_narrow_agrees_with_try_cast(spark, want):
    df = spark.createDataFrame([(x,) for x in NUMBERS], "x double")
    kind = contract(f"x {want}")["x"].dataType
    both = df.select("x", narrow(F.col("x"), T.DoubleType(), kind).alias("a"), F.col("x").try_cast(kind).alias("b"))
    assert [r for r in both.collect() if r.a != r.b] == []


@pytest.mark.parametrize("want", ["tinyint", "smallint", "int"])
def test_narrow_longs(spark, want):
    edges = [x for bits in (8, 16, 32) for x in (-(1 << bits - 1) - 1, -(1 << bits - 1), (1 << bits - 1) - 1, 1 << bits - 1)]
    df = spark.createDataFrame([(x,) for x in [*edges, 1 << 62, None]], "x long")
    kind = contract(f"x {want}")["x"].dataType
    both = df.select(narrow(F.col("x"), T.LongType(), kind).alias("a"), F.col("x").try_cast(kind).alias("b"))
    assert all(r.a == r.b for r in both.collect())


def test_lost_values_are_counted(spark):
    df = spark.createDataFrame([(1, "7"), (1 << 40, "x"), (None, None)], "a long, b string")
    assert lost_values(df, contract("a int, b int, c int")).first().asDict() == {"a": 1, "b": 1, "c": 0}


def test_contract_report(spark):
    df = spark.createDataFrame([(1, "x"), (1 << 40, "y")], "a long, extra string")
    rows = {r.column: r for r in contract_report(df, contract("a int, gone date")).collect()}
    assert (rows["a"].status, rows["a"].lost_values, rows["a"].present_values) == ("cast", 1, 2)
    assert (rows["gone"].status, rows["gone"].expected) == ("missing", "date")
    assert (rows["extra"].status, rows["extra"].actual) == ("unexpected", "string")
