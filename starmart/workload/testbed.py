"""Trips and zones as views over the order, event and nation tables.

The given tables hold no trips, so two relations stand in for them: order lines
(day grain, every column, real rejects and orphans) and events (minute grain).
A view joins only the tables its columns come from: every order, customer and
supplier a line names exists, so leaving a join out changes no row.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart import contracts
from starmart.contracts import align
from starmart.operators import dims
from starmart.operators.fact import TRIPS, build_fact
from starmart.operators.gate import Rule, accepted, trip_rules

# Orders ship days to years after they are placed, so a "trip" may take three years.
MAX_SECONDS = 1095 * 86400
LOADED_AT = datetime(2024, 1, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Trip columns from an order line; a refunded line has a negative fare and total.
LINE_COLUMNS = {
    "VendorID": "CAST(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 END AS BIGINT)",
    "tpep_pickup_datetime": "CAST(o_orderdate AS TIMESTAMP)",
    "tpep_dropoff_datetime": "CASE WHEN l_tax <> 0.08D THEN CAST(l_shipdate AS TIMESTAMP) END",
    "passenger_count": "CAST(l_linenumber AS BIGINT)",
    "trip_distance": "nullif(l_quantity, 50D)",
    "PULocationID": "CAST(s_nationkey AS BIGINT)",
    "DOLocationID": "CAST(c_nationkey AS BIGINT)",
    "RatecodeID": "CAST(nullif(l_linenumber, 6) AS BIGINT)",
    "store_and_fwd_flag": "CASE l_linestatus WHEN 'F' THEN 'Y' ELSE 'N' END",
    "payment_type": "nullif(CAST(substr(o_orderpriority, 1, 1) AS BIGINT), 5L)",
    "fare_amount": "CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN -l_extendedprice ELSE l_extendedprice END",
    "extra": "l_discount",
    "mta_tax": "l_tax",
    "improvement_surcharge": "0.3D",
    "tip_amount": "l_quantity",
    "tolls_amount": "l_tax",
    "total_amount": "CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN -o_totalprice ELSE o_totalprice END",
    "congestion_surcharge": "CASE WHEN l_linestatus = 'O' THEN 2.5D END",
    "Airport_fee": "CASE WHEN l_returnflag = 'A' THEN 1.75D END",
    "_source_file": "'lineitem.parquet'",
    "_ingestion_ts": f"TIMESTAMP '{LOADED_AT}'",
    "_year": "year(o_orderdate)",
    "_month": "month(o_orderdate)",
}
ORDER_COLUMNS = {"tpep_pickup_datetime", "payment_type", "total_amount", "DOLocationID", "_year", "_month"}


def line_trips(spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Trips from order lines: the named columns, or all."""
    wanted = list(LINE_COLUMNS) if columns is None else list(columns)
    lines = table(spark, sf_dir, "lineitem")
    if "PULocationID" in wanted:
        # Before the orders: a supplier's nation is shuffled in place of its key.
        lines = lines.join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    if ORDER_COLUMNS & set(wanted):
        orders = table(spark, sf_dir, "orders")
        if "DOLocationID" in wanted:
            # Customers meet the orders, not the four times longer lines.
            orders = orders.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        lines = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.selectExpr(*[f"{LINE_COLUMNS[c]} AS {c}" for c in wanted])


def line_rules() -> list[Rule]:
    return trip_rules(max_seconds=MAX_SECONDS)


GATE_COLUMNS = [
    "tpep_pickup_datetime", "tpep_dropoff_datetime", "fare_amount", "total_amount",
    "trip_distance", "PULocationID", "DOLocationID",
]


def gate_trips(spark: SparkSession, sf_dir: str, *also: str) -> DataFrame:
    """Order-line trips with the columns the gate reads, and `also`."""
    return line_trips(spark, sf_dir, [*GATE_COLUMNS, *also])


def line_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact over the order-line trips that pass the gate."""
    return build_fact(accepted(line_trips(spark, sf_dir), line_rules()))


# A few fares are missing (very long trips) or negative (short ones, refunded).
EVENT_COLUMNS = {
    "event_id": "event_id",
    "VendorID": "CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 END AS BIGINT)",
    "tpep_pickup_datetime": "CAST(ts AS TIMESTAMP)",
    "tpep_dropoff_datetime": "timestampadd(SECOND, CAST(floor(value * 60) AS INT), CAST(ts AS TIMESTAMP))",
    "trip_distance": "value",
    "PULocationID": "user_id",
    "DOLocationID": "user_id + 1",
    "RatecodeID": "CAST(CASE event_type WHEN 'purchase' THEN 2 WHEN 'error' THEN 98 END AS BIGINT)",
    "payment_type": "CAST(CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3"
    " WHEN 'signup' THEN 4 END AS BIGINT)",
    "fare_amount": "CASE WHEN value > 300 THEN NULL WHEN event_type = 'error' AND value < 10 THEN -value ELSE value END",
    "total_amount": "value",
    "_source_file": "'events.parquet'",
    "_source_month": "'2024-01'",
    "_ingestion_ts": f"TIMESTAMP '{LOADED_AT}'",
}


def event_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips from events: `value` is the minutes a trip takes and its fare; the user is the zone."""
    return table(spark, sf_dir, "events").selectExpr(*[f"{sql} AS {c}" for c, sql in EVENT_COLUMNS.items()])


def event_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact over all events, gate left out so that fare health has something to find."""
    return build_fact(align(event_trips(spark, sf_dir), contracts.BRONZE_TRIPS), TRIPS)


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zone lookup from nations: region is the borough and the service zone."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    joined = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select(
        F.col("n_nationkey").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.lower("r_name").alias("service_zone"),
    )


def order_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar over all order dates and a year either side."""
    bounds = dims.date_range(table(spark, sf_dir, "orders"), "o_orderdate")
    return dims.calendar_over(dims.with_buffer_years(bounds))


def event_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounds = dims.date_range(table(spark, sf_dir, "events"), "ts")
    return dims.calendar_over(dims.with_buffer_years(bounds))


def dimensions(spark: SparkSession, sf_dir: str, calendar: DataFrame) -> dict[str, DataFrame]:
    return {
        "dim_date": calendar,
        "dim_time": dims.minute_of_day(spark),
        "dim_location": dims.locations(zones(spark, sf_dir)),
        "dim_vendor": dims.vendors(spark),
        "dim_ratecode": dims.rate_codes(spark),
        "dim_payment_type": dims.payment_types(spark),
    }
