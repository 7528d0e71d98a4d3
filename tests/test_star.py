"""Dimensions, the fact and the star on the small fixtures."""

from datetime import date
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from starmart import contracts
from starmart.contracts import align
from starmart.functions.measures import exact_average
from starmart.operators import dims, marts
from starmart.operators.fact import build_fact
from starmart.operators.lineage import add_lineage
from starmart.operators.star import TRIP_STAR, fk_orphans, look_up, star_join


@pytest.fixture
def fact(trips):
    bronze = add_lineage(trips, F.lit("f"), F.lit("2023-01"), F.lit(0).cast("timestamp"))
    numbered = bronze.withColumn("_row_id", F.monotonically_increasing_id())
    return build_fact(align(numbered, contracts.BRONZE_TRIPS, "_row_id"))


@pytest.fixture
def tables(spark, trips, zones):
    bounds = dims.with_buffer_years(dims.date_range(trips, "tpep_pickup_datetime"))
    return {
        "dim_date": dims.calendar_over(bounds),
        "dim_time": dims.minute_of_day(spark),
        "dim_location": dims.locations(zones),
        "dim_vendor": dims.vendors(spark),
        "dim_ratecode": dims.rate_codes(spark),
        "dim_payment_type": dims.payment_types(spark),
    }


def schema_types(df):
    return [(f.name, f.dataType) for f in df.schema.fields]


def test_generated_dimensions_meet_their_contracts(tables):
    for name, df in tables.items():
        declared = getattr(contracts, name.upper())
        assert schema_types(df) == [(f.name, f.dataType) for f in declared.fields], name


def test_calendar_spans_a_year_either_side(tables):
    days = tables["dim_date"].agg(F.min("full_date").alias("a"), F.max("full_date").alias("b"), F.count("*").alias("n")).first()
    assert (days.a, days.b, days.n) == (date(2022, 1, 1), date(2024, 12, 31), 365 + 365 + 366)


def test_calendar_attributes(spark):
    (day,) = dims.calendar(spark, date(2023, 1, 1), date(2023, 1, 1)).collect()
    assert day.asDict() == {
        "date_key": 20230101, "full_date": date(2023, 1, 1), "year": 2023, "month": 1, "day": 1, "day_of_week": 1,
        "day_name": "Sunday", "week_of_year": 52, "is_weekend": True, "is_holiday": False, "quarter": 1,
    }


def test_seeded_calendar_size(spark):
    assert dims.calendar(spark, date(2020, 1, 1), date(2025, 12, 31)).count() == 2192


def test_calendar_of_no_trips_is_empty(trips):
    bounds = dims.with_buffer_years(dims.date_range(trips.limit(0), "tpep_pickup_datetime"))
    assert dims.calendar_over(bounds).count() == 0


def test_a_stray_year_is_just_a_longer_calendar(spark):
    far = dims.calendar(spark, date(2022, 12, 30), date(2300, 1, 2))
    assert far.count() == far.select("date_key").distinct().count() == (date(2300, 1, 2) - date(2022, 12, 30)).days + 1
    assert far.agg(F.min("date_key"), F.max("date_key")).first() == (20221230, 23000102)


def test_minutes_of_the_day(tables):
    clock = tables["dim_time"]
    assert clock.count() == clock.select("time_key").distinct().count() == 1440
    rows = {r.time_key: (r.time_of_day, r.is_rush_hour, r.is_night) for r in clock.collect()}
    assert rows[0] == ("Night", False, True)
    assert rows[559] == ("Night", False, True)
    assert rows[600] == ("Morning", False, False)
    assert rows[700] == rows[959] == ("Morning", True, False)
    assert rows[1000] == ("Morning", False, False)
    assert rows[1200] == ("Afternoon", False, False)
    assert rows[1600] == ("Afternoon", True, False)
    assert rows[1859] == ("Evening", True, False)
    assert rows[1900] == ("Evening", False, False)
    assert rows[2100] == rows[2359] == ("Night", False, True)


def test_code_lists(tables):
    assert tables["dim_vendor"].count() == 2
    assert tables["dim_ratecode"].count() == 7
    assert tables["dim_payment_type"].filter("payment_type_key = 0").first().payment_type_name == "Unknown/Missing"


def test_fact_columns_and_durations(fact):
    assert schema_types(fact) == [(f.name, f.dataType) for f in contracts.FACT_TRIPS.fields]
    rows = fact.orderBy("date_key", "pickup_time_key").collect()
    assert [str(r.trip_duration_minutes) for r in rows] == ["15.00", "30.00", "30.00", "5.00", "90.00"]
    assert [r.date_key for r in rows] == [20230115, 20230115, 20230116, 20230116, 20230117]
    assert [r.pickup_time_key for r in rows] == [1030, 1400, 815, 900, 600]


def test_missing_codes_and_fees_take_their_defaults(spark):
    trips = spark.createDataFrame([(None, None, None)], "VendorID int, RatecodeID int, payment_type int")
    row = build_fact(align(trips, contracts.BRONZE_TRIPS)).first()
    assert (row.vendor_key, row.ratecode_key, row.payment_type_key) == (1, 1, 5)
    assert (row.congestion_surcharge, row.airport_fee, row.fare_amount) == (Decimal("0.00"), Decimal("0.00"), None)


def test_amounts_that_do_not_fit_are_null_not_errors(spark):
    trips = spark.createDataFrame(
        [(1e12, float("nan"), 1.005, 70000)], "fare_amount double, tip_amount double, extra double, passenger_count int"
    )
    row = build_fact(align(trips, contracts.BRONZE_TRIPS)).first()
    assert (row.fare_amount, row.tip_amount, row.extra_amount, row.passenger_count) == (None, None, Decimal("1.01"), None)


def test_star_join_keeps_every_trip(fact, tables):
    rows = star_join(fact, tables).orderBy("date_key", "pickup_time_key").collect()
    assert len(rows) == 5
    assert [r.pickup_time_of_day for r in rows] == ["Morning", "Afternoon", "Morning", "Morning", "Morning"]
    assert [r.pickup_is_rush_hour for r in rows] == [False, False, True, True, False]
    assert rows[0].pickup_zone_name == "Midtown Center"
    assert rows[0].dropoff_zone_name == "Upper East Side South"
    assert rows[4].ratecode_name == "JFK"


def test_zone_lookup(trips, zones):
    joined = look_up(trips, zones, "PULocationID", "LocationID", attributes=["Zone"])
    counts = {r.Zone: r["count"] for r in joined.groupBy("Zone").count().collect()}
    assert counts == {"Midtown Center": 2, "LaGuardia Airport": 1, "Upper East Side South": 1, "JFK Airport": 1}


def test_planning_a_star_join_runs_nothing_and_hints_nothing(spark, fact, tables):
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    joined = star_join(fact, tables)
    assert len(tracker.getJobIdsForGroup(None)) == before
    assert "broadcast" not in joined._jdf.queryExecution().logical().toString()


def test_orphans(fact, tables):
    clean = {r.fk: (r.orphan_rows, r.orphan_keys) for r in fk_orphans(fact, tables).collect()}
    assert clean == {fk.column: (0, 0) for fk in TRIP_STAR.foreign_keys}
    tables["dim_location"] = tables["dim_location"].filter("location_key <> 265")
    broken = {r.fk: (r.orphan_rows, r.orphan_keys) for r in fk_orphans(fact, tables).collect()}
    assert broken["dropoff_location_key"] == (2, 1)
    assert broken["pickup_location_key"] == (0, 0)


def test_counts_and_revenue(trips, fact):
    assert {(r.VendorID, r.trip_count) for r in marts.count_by(trips, "VendorID").collect()} == {(1, 3), (2, 2)}
    rows = {r.payment_type_key: r for r in marts.revenue_by(fact, "payment_type_key").collect()}
    assert (rows[1].total_revenue, rows[1].avg_revenue, rows[1].trip_count) == (Decimal("252.70"), Decimal("63.175"), 4)
    assert (rows[2].total_revenue, rows[2].trip_count) == (Decimal("35.35"), 1)
    hours = marts.count_by_hour(trips, "tpep_pickup_datetime").collect()
    assert [(r.hour, r.trip_count) for r in hours] == [(6, 1), (8, 1), (9, 1), (10, 1), (14, 1)]


def test_fact_date_range_and_health(fact, tables):
    span = marts.fact_date_range(fact, tables["dim_date"]).first()
    assert (span.min_date, span.max_date) == (date(2023, 1, 15), date(2023, 1, 17))
    score = marts.quality_score(marts.fare_health(fact)).first()
    assert (score.total_trips, score.quality_score, score.grade) == (5, 100.0, "good")
    assert score.avg_fare == Decimal("44.10")
    empty = marts.quality_score(marts.fare_health(fact.limit(0))).first()
    assert (empty.quality_score, empty.grade) == (None, None)


def test_airport_and_high_value(fact):
    airports = {(r.date_key, r.direction): r.trips for r in marts.airport(fact).collect()}
    assert airports == {(20230115, "pickup"): 1, (20230117, "pickup"): 1}
    assert [(r.date_key, r.trips) for r in marts.high_value(fact).collect()] == [(20230117, 1)]


def test_averages_of_nothing_are_null(fact, tables):
    untimed = fact.withColumn("trip_duration_minutes", F.lit(None).cast("decimal(10,2)"))
    assert {r.avg_duration_minutes for r in marts.by_route(untimed).collect()} == {None}
    assert {r.avg_duration_minutes for r in marts.by_month(untimed, tables["dim_date"]).collect()} == {None}
    free = fact.withColumn("fare_amount", F.lit(0).cast("decimal(10,2)"))
    assert marts.fare_health(free).first().avg_fare is None


def test_averages_are_exact_beyond_the_range_of_doubles(spark):
    total, count = Decimal("123456789012345678.91"), 9876543210
    sums = spark.range(1).select(F.lit(total).alias("total"), F.lit(count).alias("count"))
    (row,) = sums.select(exact_average(F.col("total"), F.col("count")).alias("a")).collect()
    assert row.a == (total / count).quantize(Decimal("0.000001"), ROUND_HALF_UP)
