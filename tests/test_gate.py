"""The gate on the small fixtures and on edge values."""

from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from starmart import contracts
from starmart.operators import gate
from tests.conftest import TRIPS

FIELDS = ["VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "trip_distance", "PULocationID",
          "DOLocationID"]


def changed(spark, **values):
    """The first fixture trip with some values replaced."""
    names = contracts.RAW_TRIPS.fieldNames()
    row = {**dict(zip(names, TRIPS[0], strict=True)), **values}
    return spark.createDataFrame([tuple(row[n] for n in names)], contracts.RAW_TRIPS)


def test_ordinary_trips_pass(trips):
    assert gate.accepted(trips, gate.trip_rules()).count() == 5


def test_negative_fare_fails_two_rules_and_the_future_passes(trips, invalid_trips):
    rows, rules = trips.unionByName(invalid_trips), gate.trip_rules()
    assert gate.accepted(rows, rules).count() == 6
    (bad,) = gate.rejected(rows, rules).collect()
    assert bad.failed_rules == ["fare_amount_at_least_0", "total_amount_at_least_0"]
    bound = gate.before("tpep_pickup_datetime", datetime(2025, 1, 1))
    assert gate.accepted(rows, [*rules, bound]).count() == 5


START = datetime(2023, 1, 15, 10, 30)


@pytest.mark.parametrize(
    ("values", "passes"),
    [
        ({"fare_amount": None}, False),
        ({"total_amount": None}, False),
        ({"trip_distance": None}, False),
        ({"fare_amount": float("nan")}, True),
        ({"fare_amount": 0.0}, True),
        ({"trip_distance": 0.0}, True),
        ({"tpep_pickup_datetime": None}, False),
        ({"tpep_dropoff_datetime": None}, False),
        ({"tpep_dropoff_datetime": START}, False),
        ({"tpep_dropoff_datetime": START + timedelta(seconds=86399)}, True),
        ({"tpep_dropoff_datetime": START + timedelta(seconds=86400)}, False),
        ({"PULocationID": 0}, False),
        ({"PULocationID": None}, False),
        ({"DOLocationID": 0}, False),
        ({"DOLocationID": None}, False),
    ],
)
def test_edges(spark, values, passes):
    row, rules = changed(spark, **values), gate.trip_rules()
    assert gate.accepted(row, rules).count() == int(passes)
    assert gate.rejected(row, rules).count() == int(not passes)


def test_optional_rules(spark):
    nan = changed(spark, fare_amount=float("nan"))
    assert gate.accepted(nan, [gate.finite("fare_amount")]).count() == 0
    still = changed(spark, trip_distance=0.0)
    assert gate.accepted(still, [gate.distance_when_paid("trip_distance", "fare_amount")]).count() == 0


def test_rejection_rate_and_rejects_by_rule(trips, invalid_trips):
    rows, rules = trips.unionByName(invalid_trips), gate.trip_rules()
    rate = gate.rejection_rate(rows, rules).first()
    assert (rate.rows_in, rate.rows_accepted, rate.rows_rejected) == (7, 6, 1)
    assert rate.rejected_percent == pytest.approx(100 / 7)
    by_rule = {r.rule: r.rejected_rows for r in gate.rejects_by_rule(rows, rules).collect()}
    assert len(by_rule) == 11
    assert {k for k, n in by_rule.items() if n} == {"fare_amount_at_least_0", "total_amount_at_least_0"}


def test_empty_input(trips):
    rate = gate.rejection_rate(trips.limit(0), gate.trip_rules()).first()
    assert (rate.rows_in, rate.rejected_percent) == (0, 0.0)


def test_tagged_holds_both_sides(trips, invalid_trips):
    rows = gate.tagged(trips.unionByName(invalid_trips), gate.trip_rules())
    assert {(r["_accepted"], r["count"]) for r in rows.groupBy("_accepted").count().collect()} == {(True, 6), (False, 1)}


def test_violations(trips, invalid_trips):
    assert trips.filter(gate.not_allowed("VendorID", [1, 2])).count() == 0
    assert trips.filter(gate.not_allowed("VendorID", [1])).count() == 2
    assert trips.filter(gate.out_of_order("tpep_pickup_datetime", "tpep_dropoff_datetime")).count() == 0


money = st.one_of(st.none(), st.floats(-100, 100), st.just(float("nan")))
moment = st.one_of(st.none(), st.datetimes(datetime(2023, 1, 1), datetime(2023, 1, 4)))
place = st.one_of(st.none(), st.integers(-1, 3))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(moment, moment, money, money, money, place, place), max_size=30))
def test_the_split_loses_and_doubles_nothing(spark, rows):
    schema = """tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, fare_amount double,
        total_amount double, trip_distance double, PULocationID long, DOLocationID long"""
    df, rules = spark.createDataFrame(rows, schema), gate.trip_rules()
    kept, failed = gate.accepted(df, rules).count(), gate.rejected(df, rules)
    assert kept + failed.count() == len(rows)
    assert failed.filter("size(failed_rules) = 0").count() == 0


def test_names_of_failed_rules_are_made_in_generated_code(spark, trips, invalid_trips):
    df = gate.rejected(trips.union(invalid_trips), gate.trip_rules())
    assert "filter(" not in df._jdf.queryExecution().executedPlan().toString()
    assert [r.failed_rules for r in df.collect()] == [["fare_amount_at_least_0", "total_amount_at_least_0"]]
    assert gate.failed_rules([]) is not None and trips.select(gate.failed_rules([]).alias("f")).first().f == []
