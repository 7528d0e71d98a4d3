"""What the plans must look like at scale: pruning, pushdown, no stray shuffles."""

import pytest
from pyspark.sql import functions as F

from starmart import contracts
from starmart.contracts import align
from starmart.functions.keys import ROW_ID
from starmart.operators import dims, gate
from starmart.operators.fact import TRIPS, build_fact
from starmart.operators.merge import upsert
from starmart.operators.star import star_join
from starmart.plans.jobs import LOST, with_losses
from starmart.sources.lake import MONTH, write_partitions
from starmart.sources.scan import in_months, read_bronze_source, read_months, scan


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def bronze(spark, trips, folder):
    path = f"{folder}/bronze"
    lineage = trips.select(
        "*",
        F.lit("f").alias("_source_file"),
        F.lit("2023-01").alias("_source_month"),
        F.lit(0).cast("timestamp").alias("_ingestion_ts"),
        F.lit(2023).alias("_year"),
        F.lit(1).alias("_month"),
    )
    write_partitions(align(lineage, contracts.BRONZE_TRIPS), path, MONTH)
    return path


def test_months_prune_partitions(spark, bronze):
    text = plan(read_months(spark, bronze, ["2023-01", "2023-02"]))
    filters = text.split("PartitionFilters: ")[1].split("PushedFilters: ")
    assert "_year" in filters[0] and "_month" in filters[0]
    assert filters[1].startswith("[]")


def test_gate_and_fact_are_one_stage_with_pushed_filters(spark, bronze):
    months = read_months(spark, bronze, ["2023-01"])
    text = plan(build_fact(gate.accepted(months, gate.trip_rules()), TRIPS, *MONTH))
    assert "Exchange" not in text
    assert "GreaterThanOrEqual(fare_amount,0.0)" in text
    assert "GreaterThan(PULocationID,0)" in text


def test_ingestion_does_not_shuffle(spark, folder, trips):
    trips.coalesce(1).write.parquet(f"{folder}/trips_2023-01")
    df = read_bronze_source(spark, [f"{folder}/trips_2023-01"], contracts.RAW_TRIPS, F.lit(0).cast("timestamp"))
    assert "Exchange" not in plan(df)


def test_files_of_one_month_are_looked_up_without_a_shuffle(spark, folder, trips):
    """Their numbers are broadcast, their month is not sought in the path of every row, and rows that lose nothing make no array."""
    paths = [f"{folder}/{number}_2023-01" for number in range(2)]
    for path in paths:
        trips.write.parquet(path)
    raw = with_losses(read_bronze_source(spark, paths, contracts.RAW_TRIPS, F.lit(0).cast("timestamp"), lost=LOST))
    text = plan(align(raw.where(f"NOT {LOST}_any"), contracts.BRONZE_TRIPS, ROW_ID))
    assert [x for x in ("hashpartitioning", "SortMergeJoin", "regexp", "array_distinct") if x in text] == []
    assert raw.select("_source_month", "_file").distinct().count() == raw.select(F.input_file_name()).distinct().count()
    assert raw.select(ROW_ID).distinct().count() == 2 * trips.count()


def test_scan_reads_only_what_it_returns(spark, bronze):
    text = plan(scan(spark.read.parquet(bronze), ["fare_amount"], "PULocationID > 100"))
    schema = text.split("ReadSchema: ")[1]
    assert "fare_amount" in schema and "PULocationID" in schema and "total_amount" not in schema


def test_star_join_broadcasts_by_bytes(spark, bronze, zones, folder):
    fact = build_fact(read_months(spark, bronze))
    bounds = dims.with_buffer_years(dims.date_range(spark.read.parquet(bronze), "tpep_pickup_datetime"))
    made = {
        "dim_date": dims.calendar_over(bounds),
        "dim_time": dims.minute_of_day(spark),
        "dim_location": dims.locations(zones),
        "dim_vendor": dims.vendors(spark),
        "dim_ratecode": dims.rate_codes(spark),
        "dim_payment_type": dims.payment_types(spark),
    }
    for name, df in made.items():
        df.write.parquet(f"{folder}/{name}")
    tables = {name: spark.read.parquet(f"{folder}/{name}") for name in made}
    text = plan(star_join(fact, tables))
    assert text.count("BroadcastHashJoin") == 8
    assert "SortMergeJoin" not in text and "hashpartitioning" not in text
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 1)
    try:
        text = plan(star_join(fact, tables))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in text


def test_listing_more_months_adds_no_expressions(spark, bronze):
    def size(years):
        months = [f"{2000 + y}-{m:02}" for y in range(years) for m in range(1, 13)]
        return in_months(months)._jc.toString().count("_month")

    assert size(1) == 1 and size(25) == 25


def test_merging_needs_no_sorted_aggregate_and_no_full_join(spark):
    target = spark.range(100).selectExpr("id", "'a' AS name", "'b' AS note")
    text = plan(upsert(target, target.limit(3), ["id"], ["name"]))
    assert "SortAggregate" not in text and "FullOuter" not in text
