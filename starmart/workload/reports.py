"""Queries over aggregates and marts."""

from pyspark.sql import functions as F

from starmart.functions.measures import decimal
from starmart.operators import dims, marts
from starmart.workload.registry import (
    CODES,
    DIM_TIME,
    EVENT_FACT,
    LINE_FACT,
    LINE_TRIPS,
    MART,
    ORDER_CALENDAR,
    ZONES,
    avg_of,
    query,
)
from starmart.workload.testbed import (
    event_fact,
    event_trips,
    line_fact,
    line_trips,
    order_calendar,
    table,
    zones,
)


@query("count_by_key", f"WITH {LINE_TRIPS} SELECT VendorID, count(*) AS trip_count FROM line_trips GROUP BY 1")
def count_by_key(spark, sf_dir):
    return marts.count_by(line_trips(spark, sf_dir, ["VendorID"]), "VendorID")


@query(
    "revenue_by_payment",
    f"""WITH {LINE_TRIPS}, t AS (SELECT payment_type, CAST(total_amount AS DECIMAL(10,2)) AS total FROM line_trips)
        SELECT payment_type, CAST(sum(total) AS DOUBLE) AS total_revenue,
          {avg_of("sum(total)", "count(*)")} AS avg_revenue, count(*) AS trip_count
        FROM t GROUP BY 1""",
)
def revenue_by_payment(spark, sf_dir):
    trips = line_trips(spark, sf_dir, ["payment_type", "total_amount"])
    return marts.revenue_by(trips.withColumn("total_amount", decimal(F.col("total_amount"))), "payment_type")


@query("trips_by_hour", "SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS trip_count FROM events GROUP BY 1 ORDER BY 1")
def trips_by_hour(spark, sf_dir):
    return marts.count_by_hour(event_trips(spark, sf_dir), "tpep_pickup_datetime")


@query(
    "date_range",
    """SELECT CAST(CAST(min(o_orderdate) AS DATE) AS VARCHAR) AS min_date,
         CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) AS max_date FROM orders""",
)
def date_range(spark, sf_dir):
    return dims.date_range(table(spark, sf_dir, "orders"), "o_orderdate")


HEALTH = f"""count(*) AS total_trips,
  count(*) FILTER (WHERE fare_amount IS NULL) AS null_fares,
  count(*) FILTER (WHERE fare_amount < 0) AS negative_fares,
  {avg_of("sum(fare_amount) FILTER (WHERE fare_amount > 0)", "count(*) FILTER (WHERE fare_amount > 0)", 2)} AS avg_fare"""


@query("fare_health", f"WITH {EVENT_FACT} SELECT {HEALTH} FROM fact")
def fare_health(spark, sf_dir):
    return marts.fare_health(event_fact(spark, sf_dir))


@query(
    "quality_score",
    f"""WITH {EVENT_FACT}, h AS (SELECT date_key, {HEALTH} FROM fact GROUP BY 1),
        s AS (SELECT *, (1 - (null_fares + negative_fares)::DOUBLE / total_trips::DOUBLE) * 100 AS quality_score FROM h)
        SELECT *, CASE WHEN quality_score >= 99 THEN 'good' WHEN quality_score >= 95 THEN 'warn' ELSE 'bad' END AS grade
        FROM s""",
)
def quality_score(spark, sf_dir):
    return marts.quality_score(marts.fare_health(event_fact(spark, sf_dir), "date_key"))


def mart_sql(fact: str, keys: str, where: str = "true") -> str:
    return f"WITH {fact} SELECT {keys}, {MART} FROM fact WHERE {where} GROUP BY ALL"


@query("mart_date_pickup", mart_sql(LINE_FACT, "date_key, pickup_location_key"))
def mart_date_pickup(spark, sf_dir):
    return marts.by_date_and(line_fact(spark, sf_dir), "pickup_location_key")


@query("mart_date_dropoff", mart_sql(LINE_FACT, "date_key, dropoff_location_key"))
def mart_date_dropoff(spark, sf_dir):
    return marts.by_date_and(line_fact(spark, sf_dir), "dropoff_location_key")


@query("mart_date_vendor", mart_sql(LINE_FACT, "date_key, vendor_key"))
def mart_date_vendor(spark, sf_dir):
    return marts.by_date_and(line_fact(spark, sf_dir), "vendor_key")


@query("mart_route", mart_sql(LINE_FACT, "pickup_location_key, dropoff_location_key"))
def mart_route(spark, sf_dir):
    return marts.by_route(line_fact(spark, sf_dir))


@query("mart_high_value", mart_sql(EVENT_FACT, "date_key", "total_amount > 50"))
def mart_high_value(spark, sf_dir):
    return marts.high_value(event_fact(spark, sf_dir))


@query(
    "mart_airport",
    f"""WITH {EVENT_FACT}, both_ways AS (
          SELECT *, 'pickup' AS direction FROM fact WHERE pickup_location_key IN (1, 132, 138)
          UNION ALL SELECT *, 'dropoff' FROM fact WHERE dropoff_location_key IN (1, 132, 138)
        )
        SELECT date_key, direction, {MART} FROM both_ways GROUP BY ALL""",
)
def mart_airport(spark, sf_dir):
    return marts.airport(event_fact(spark, sf_dir))


@query(
    "mart_payment",
    f"""WITH {LINE_FACT}, {CODES}
        SELECT payment_type_name, {MART} FROM fact LEFT JOIN dim_payment_type USING (payment_type_key) GROUP BY 1""",
)
def mart_payment(spark, sf_dir):
    return marts.by_payment(line_fact(spark, sf_dir), dims.payment_types(spark))


@query(
    "mart_vendor",
    f"WITH {LINE_FACT}, {CODES} SELECT vendor_name, {MART} FROM fact LEFT JOIN dim_vendor USING (vendor_key) GROUP BY 1",
)
def mart_vendor(spark, sf_dir):
    return marts.by_name(line_fact(spark, sf_dir), dims.vendors(spark), "vendor_key", "vendor_key", ["vendor_name"])


@query(
    "mart_time_of_day",
    f"""WITH {EVENT_FACT}, {DIM_TIME}
        SELECT time_of_day, is_rush_hour, is_night, {MART}
        FROM fact LEFT JOIN dim_time ON pickup_time_key = time_key GROUP BY ALL""",
)
def mart_time_of_day(spark, sf_dir):
    return marts.by_time_of_day(event_fact(spark, sf_dir), dims.minute_of_day(spark))


@query(
    "mart_month",
    f"""WITH {LINE_FACT}, {ORDER_CALENDAR}
        SELECT year, month, {MART} FROM fact LEFT JOIN dim_date USING (date_key) GROUP BY ALL""",
)
def mart_month(spark, sf_dir):
    return marts.by_month(line_fact(spark, sf_dir), order_calendar(spark, sf_dir))


@query(
    "mart_borough",
    f"""WITH {EVENT_FACT}, {ZONES}
        SELECT borough, service_zone, {MART}
        FROM fact LEFT JOIN dim_location ON pickup_location_key = location_key GROUP BY ALL""",
)
def mart_borough(spark, sf_dir):
    return marts.by_borough(event_fact(spark, sf_dir), dims.locations(zones(spark, sf_dir)))
