"""The registered queries: a Spark callable per name and, where SQL can say it, its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = lambda spark, sf_dir: plain(run(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def plain(df: DataFrame) -> DataFrame:
    """Results in types every client reads alike: decimals as double, dates and times as text."""
    shown = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.DecimalType):
            shown[field.name] = F.col(field.name).cast("double")
        elif isinstance(field.dataType, T.DateType):
            shown[field.name] = F.col(field.name).cast("string")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            shown[field.name] = F.date_format(field.name, "yyyy-MM-dd HH:mm:ss")
    return df.withColumns(shown) if shown else df


# Pieces of oracle SQL. They restate the views and operators on their own terms.

LINE_TRIPS = """
line_trips AS (
  SELECT
    CAST(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 END AS BIGINT) AS VendorID,
    CAST(o_orderdate AS TIMESTAMP) AS tpep_pickup_datetime,
    CASE WHEN l_tax <> 0.08 THEN CAST(l_shipdate AS TIMESTAMP) END AS tpep_dropoff_datetime,
    CAST(l_linenumber AS BIGINT) AS passenger_count,
    nullif(l_quantity, 50.0) AS trip_distance,
    CAST(s_nationkey AS BIGINT) AS PULocationID,
    CAST(c_nationkey AS BIGINT) AS DOLocationID,
    CAST(nullif(l_linenumber, 6) AS BIGINT) AS RatecodeID,
    CASE WHEN l_linestatus = 'F' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
    nullif(CAST(substr(o_orderpriority, 1, 1) AS BIGINT), 5) AS payment_type,
    CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN -l_extendedprice ELSE l_extendedprice END AS fare_amount,
    l_discount AS extra,
    l_tax AS mta_tax,
    CAST(0.3 AS DOUBLE) AS improvement_surcharge,
    l_quantity AS tip_amount,
    l_tax AS tolls_amount,
    CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN -o_totalprice ELSE o_totalprice END AS total_amount,
    CASE WHEN l_linestatus = 'O' THEN CAST(2.5 AS DOUBLE) END AS congestion_surcharge,
    CASE WHEN l_returnflag = 'A' THEN CAST(1.75 AS DOUBLE) END AS Airport_fee,
    CAST(year(o_orderdate) AS INTEGER) AS _year,
    CAST(month(o_orderdate) AS INTEGER) AS _month
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey
)"""

LINE_CHECKS = LINE_TRIPS + """,
checked AS (
  SELECT *,
    tpep_pickup_datetime IS NOT NULL AS r1,
    tpep_dropoff_datetime IS NOT NULL AS r2,
    coalesce(tpep_dropoff_datetime > tpep_pickup_datetime, false) AS r3,
    coalesce(fare_amount >= 0, false) AS r4,
    coalesce(total_amount >= 0, false) AS r5,
    coalesce(trip_distance >= 0, false) AS r6,
    coalesce(epoch(tpep_dropoff_datetime) - epoch(tpep_pickup_datetime) < 94608000, false) AS r7,
    PULocationID IS NOT NULL AS r8,
    DOLocationID IS NOT NULL AS r9,
    coalesce(PULocationID > 0, false) AS r10,
    coalesce(DOLocationID > 0, false) AS r11
  FROM line_trips
),
gated AS (
  SELECT *, r1 AND r2 AND r3 AND r4 AND r5 AND r6 AND r7 AND r8 AND r9 AND r10 AND r11 AS ok FROM checked
)"""

EVENT_TRIPS = """
event_trips AS (
  SELECT
    event_id,
    CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 END AS BIGINT) AS VendorID,
    CAST(ts AS TIMESTAMP) AS tpep_pickup_datetime,
    CAST(ts AS TIMESTAMP) + to_seconds(CAST(floor(value * 60) AS BIGINT)) AS tpep_dropoff_datetime,
    CAST(NULL AS BIGINT) AS passenger_count,
    value AS trip_distance,
    user_id AS PULocationID,
    user_id + 1 AS DOLocationID,
    CAST(CASE event_type WHEN 'purchase' THEN 2 WHEN 'error' THEN 98 END AS BIGINT) AS RatecodeID,
    CAST(CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 WHEN 'signup' THEN 4 END
      AS BIGINT) AS payment_type,
    CASE WHEN value > 300 THEN NULL WHEN event_type = 'error' AND value < 10 THEN -value ELSE value END AS fare_amount,
    CAST(NULL AS DOUBLE) AS extra,
    CAST(NULL AS DOUBLE) AS mta_tax,
    CAST(NULL AS DOUBLE) AS improvement_surcharge,
    CAST(NULL AS DOUBLE) AS tip_amount,
    CAST(NULL AS DOUBLE) AS tolls_amount,
    value AS total_amount,
    CAST(NULL AS DOUBLE) AS congestion_surcharge,
    CAST(NULL AS DOUBLE) AS Airport_fee
  FROM events
)"""


def fact_of(relation: str, name: str, source_file: str) -> str:
    """Oracle CTE of the fact over a trips relation."""

    def money(column: str) -> str:
        return f"CAST({column} AS DECIMAL(10,2))"

    return f"""
{name} AS (
  SELECT
    CAST(strftime(tpep_pickup_datetime, '%Y%m%d') AS INTEGER) AS date_key,
    CAST(hour(tpep_pickup_datetime) * 100 + minute(tpep_pickup_datetime) AS INTEGER) AS pickup_time_key,
    CAST(hour(tpep_dropoff_datetime) * 100 + minute(tpep_dropoff_datetime) AS INTEGER) AS dropoff_time_key,
    CAST(PULocationID AS INTEGER) AS pickup_location_key,
    CAST(DOLocationID AS INTEGER) AS dropoff_location_key,
    CAST(coalesce(VendorID, 1) AS INTEGER) AS vendor_key,
    CAST(coalesce(RatecodeID, 1) AS INTEGER) AS ratecode_key,
    CAST(coalesce(payment_type, 5) AS INTEGER) AS payment_type_key,
    CAST(passenger_count AS SMALLINT) AS passenger_count,
    {money("trip_distance")} AS trip_distance_miles,
    CAST(round((epoch_us(tpep_dropoff_datetime) // 1000000 - epoch_us(tpep_pickup_datetime) // 1000000) / 60.0, 2)
      AS DECIMAL(10,2)) AS trip_duration_minutes,
    {money("fare_amount")} AS fare_amount,
    {money("extra")} AS extra_amount,
    {money("mta_tax")} AS mta_tax,
    {money("tip_amount")} AS tip_amount,
    {money("tolls_amount")} AS tolls_amount,
    {money("improvement_surcharge")} AS improvement_surcharge,
    {money("coalesce(congestion_surcharge, 0)")} AS congestion_surcharge,
    {money("coalesce(Airport_fee, 0)")} AS airport_fee,
    {money("total_amount")} AS total_amount,
    '{source_file}' AS _source_file,
    TIMESTAMP '2024-01-01 00:00:00' AS _ingestion_ts
  FROM {relation}
)"""


LINE_FACT = LINE_CHECKS + "," + fact_of("(SELECT * FROM gated WHERE ok)", "fact", "lineitem.parquet")
EVENT_FACT = EVENT_TRIPS + "," + fact_of("event_trips", "fact", "events.parquet")

FACT_MONEY = [
    "trip_distance_miles", "trip_duration_minutes", "fare_amount", "extra_amount", "mta_tax", "tip_amount",
    "tolls_amount", "improvement_surcharge", "congestion_surcharge", "airport_fee", "total_amount",
]
FACT_KEYS = [
    "date_key", "pickup_time_key", "dropoff_time_key", "pickup_location_key", "dropoff_location_key",
    "vendor_key", "ratecode_key", "payment_type_key",
]
FACT_OUTPUT = ", ".join(
    [*FACT_KEYS, "passenger_count", *[f"CAST({m} AS DOUBLE) AS {m}" for m in FACT_MONEY], "_source_file",
     "strftime(_ingestion_ts, '%Y-%m-%d %H:%M:%S') AS _ingestion_ts"]
)

ZONES = """
zones AS (
  SELECT n_nationkey AS LocationID, r_name AS Borough, n_name AS Zone, lower(r_name) AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
dim_location AS (
  SELECT LocationID AS location_key, LocationID AS location_id, Borough AS borough, Zone AS zone_name, service_zone
  FROM zones
)"""

DIM_TIME = """
dim_time AS (
  SELECT
    CAST(h * 100 + m AS INTEGER) AS time_key,
    CAST(h AS SMALLINT) AS hour,
    CAST(m AS SMALLINT) AS minute,
    CASE WHEN h < 6 THEN 'Night' WHEN h < 12 THEN 'Morning' WHEN h < 17 THEN 'Afternoon'
         WHEN h < 21 THEN 'Evening' ELSE 'Night' END AS time_of_day,
    (h >= 7 AND h < 10) OR (h >= 16 AND h < 19) AS is_rush_hour,
    h < 6 OR h >= 21 AS is_night
  FROM range(0, 24) hours(h), range(0, 60) minutes(m)
)"""


def dim_date(first: str, last: str) -> str:
    """Oracle CTE of the calendar between two date expressions."""
    return f"""
dim_date AS (
  SELECT
    CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key,
    CAST(d AS DATE) AS full_date,
    CAST(year(d) AS SMALLINT) AS year,
    CAST(month(d) AS SMALLINT) AS month,
    CAST(day(d) AS SMALLINT) AS day,
    CAST(dayofweek(d) + 1 AS SMALLINT) AS day_of_week,
    dayname(d) AS day_name,
    CAST(week(d) AS SMALLINT) AS week_of_year,
    dayofweek(d) IN (0, 6) AS is_weekend,
    false AS is_holiday,
    CAST(quarter(d) AS SMALLINT) AS quarter
  FROM (SELECT unnest(generate_series({first}, {last}, INTERVAL 1 DAY)) AS d)
)"""


def buffered(table: str, ts: str) -> tuple[str, str]:
    first = f"(SELECT make_date(year(min({ts})) - 1, 1, 1)::TIMESTAMP FROM {table})"
    last = f"(SELECT make_date(year(max({ts})) + 1, 12, 31)::TIMESTAMP FROM {table})"
    return first, last


ORDER_CALENDAR = dim_date(*buffered("orders", "o_orderdate"))
EVENT_CALENDAR = dim_date(*buffered("events", "ts"))

CODES = """
dim_vendor(vendor_key, vendor_id, vendor_name) AS (
  VALUES (1, 1, 'Creative Mobile Technologies, LLC'), (2, 2, 'VeriFone Inc.')
),
dim_ratecode(ratecode_key, ratecode_id, ratecode_name, ratecode_description) AS (
  VALUES (1, 1, 'Standard rate', 'Standard metered fare'), (2, 2, 'JFK', 'JFK Airport flat fare'),
    (3, 3, 'Newark', 'Newark Airport negotiated fare'), (4, 4, 'Nassau/Westchester', 'Nassau or Westchester fare'),
    (5, 5, 'Negotiated fare', 'Negotiated flat fare'), (6, 6, 'Group ride', 'Group ride fare'),
    (99, 99, 'Unknown', 'Unknown or invalid rate code')
),
dim_payment_type(payment_type_key, payment_type_id, payment_type_name) AS (
  VALUES (0, 0, 'Unknown/Missing'), (1, 1, 'Credit card'), (2, 2, 'Cash'), (3, 3, 'No charge'), (4, 4, 'Dispute'),
    (5, 5, 'Unknown'), (6, 6, 'Voided trip')
)"""


def avg_of(total: str, n: str, digits: int = 6) -> str:
    """Oracle: a two-digit decimal total over n, rounded half up to digits, in whole-number arithmetic."""
    scaled = f"(CAST({total} * 100 AS HUGEINT) * {10 ** (digits - 2)})"
    rounded = f"sign({scaled}) * ((2 * abs({scaled}) + {n}) // (2 * {n}))"
    return f"CASE WHEN {n} > 0 THEN CAST({rounded} AS DOUBLE) / {10**digits}.0 END"


def share_of(part: str, whole: str) -> str:
    """Oracle: part over whole, rounded half up to four digits, zero for an empty whole."""
    return f"CASE WHEN {whole} > 0 THEN CAST((20000 * {part} + {whole}) // (2 * {whole}) AS DOUBLE) / 10000.0 ELSE 0.0 END"


MART = f"""CAST(count(*) AS BIGINT) AS trips, CAST(sum(total_amount) AS DOUBLE) AS revenue,
  {avg_of("sum(trip_duration_minutes)", "count(trip_duration_minutes)")} AS avg_duration_minutes"""
