"""Queries over dimension generators and merges."""

from pyspark.sql import functions as F

from starmart.functions.measures import in_hours
from starmart import fixed_values as fixed
from starmart.operators import dims
from starmart.operators.marts import count_by, is_rush_hour, period_of_day
from starmart.operators.merge import insert_if_absent, upsert
from starmart.workload.registry import CODES, DIM_TIME, EVENT_CALENDAR, EVENT_FACT, LINE_TRIPS, ZONES, dim_date, query
from starmart.workload.testbed import event_calendar, event_fact, line_trips, table, zones

DATE_OUTPUT = """date_key, CAST(full_date AS VARCHAR) AS full_date, year, month, day, day_of_week, day_name,
  week_of_year, is_weekend, is_holiday, quarter"""


@query(
    "dim_date",
    f"""WITH {dim_date("(SELECT min(o_orderdate)::TIMESTAMP FROM orders)", "(SELECT max(o_orderdate)::TIMESTAMP FROM orders)")}
        SELECT {DATE_OUTPUT} FROM dim_date""",
)
def order_days(spark, sf_dir):
    return dims.calendar_over(dims.date_range(table(spark, sf_dir, "orders"), "o_orderdate"))


@query("dim_date_from_data", f"WITH {EVENT_CALENDAR} SELECT {DATE_OUTPUT} FROM dim_date")
def dim_date_from_data(spark, sf_dir):
    return event_calendar(spark, sf_dir)


def with_use(dim, facts, key, column):
    """A dimension with how many facts point to each member; facts are counted before they are joined."""
    used = facts.groupBy(F.col(column).alias(key)).agg(F.count(F.lit(1)).alias("__n"))
    return dim.join(used, key, "left").select(*dim.columns, F.coalesce(F.col("__n"), F.lit(0)).alias("facts"))


def use_sql(dim: str, key: str, column: str, ctes: str) -> str:
    return f"""WITH {ctes}, used AS (SELECT {column} AS k, count(*) AS n FROM fact GROUP BY 1)
      SELECT d.*, CAST(coalesce(n, 0) AS BIGINT) AS facts FROM {dim} d LEFT JOIN used ON d.{key} = used.k"""


@query("dim_time", use_sql("dim_time", "time_key", "pickup_time_key", f"{EVENT_FACT}, {DIM_TIME}"))
def dim_time(spark, sf_dir):
    return with_use(dims.minute_of_day(spark), event_fact(spark, sf_dir), "time_key", "pickup_time_key")


LINE_CODES = f"""{LINE_TRIPS},
fact AS (
  SELECT coalesce(VendorID, 1) AS vendor_key, coalesce(RatecodeID, 1) AS ratecode_key,
    coalesce(payment_type, 5) AS payment_type_key
  FROM line_trips
), {CODES}"""


def line_codes(spark, sf_dir, source, default):
    return line_trips(spark, sf_dir, [source]).select(F.coalesce(source, F.lit(default)).alias("code"))


@query("dim_vendor", use_sql("dim_vendor", "vendor_key", "vendor_key", LINE_CODES))
def dim_vendor(spark, sf_dir):
    codes = line_codes(spark, sf_dir, "VendorID", fixed.DEFAULT_VENDOR)
    return with_use(dims.vendors(spark), codes, "vendor_key", "code")


@query("dim_ratecode", use_sql("dim_ratecode", "ratecode_key", "ratecode_key", LINE_CODES))
def dim_ratecode(spark, sf_dir):
    codes = line_codes(spark, sf_dir, "RatecodeID", fixed.DEFAULT_RATE_CODE)
    return with_use(dims.rate_codes(spark), codes, "ratecode_key", "code")


@query("dim_payment_type", use_sql("dim_payment_type", "payment_type_key", "payment_type_key", LINE_CODES))
def dim_payment_type(spark, sf_dir):
    codes = line_codes(spark, sf_dir, "payment_type", fixed.DEFAULT_PAYMENT_TYPE)
    return with_use(dims.payment_types(spark), codes, "payment_type_key", "code")


@query("dim_location", f"WITH {ZONES} SELECT * FROM dim_location")
def dim_location(spark, sf_dir):
    return dims.locations(zones(spark, sf_dir))


@query(
    "unknown_members",
    f"""WITH {ZONES} SELECT * FROM dim_location
        UNION ALL SELECT 264, 264, 'Unknown', 'Unknown', 'Unknown'
        UNION ALL SELECT 265, 265, 'Unknown', 'Unknown', 'Unknown'""",
)
def unknown_members(spark, sf_dir):
    return insert_if_absent(dims.locations(zones(spark, sf_dir)), dims.unknown_locations(spark), ["location_key"])


@query(
    "upsert_dimension",
    """WITH s AS (SELECT l_partkey + 500 AS k, max(l_extendedprice) AS price FROM lineitem GROUP BY 1)
       SELECT coalesce(p_partkey, k) AS p_partkey, CASE WHEN p_partkey IS NULL THEN 'new' ELSE p_name END AS p_name,
         CASE WHEN p_partkey IS NULL THEN 'none' ELSE p_brand END AS p_brand,
         coalesce(price, p_retailprice) AS p_retailprice
       FROM part FULL JOIN s ON p_partkey = k""",
)
def upsert_dimension(spark, sf_dir):
    """Parts get the highest price sold under a shifted key: some keys are known, some new."""
    target = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_retailprice")
    source = (
        table(spark, sf_dir, "lineitem")
        .groupBy((F.col("l_partkey") + 500).alias("p_partkey"))
        .agg(F.max("l_extendedprice").alias("p_retailprice"))
        .select("p_partkey", F.lit("new").alias("p_name"), F.lit("none").alias("p_brand"), "p_retailprice")
    )
    return upsert(target, source, ["p_partkey"], update=["p_retailprice"])


@query(
    "insert_if_absent",
    """SELECT s_suppkey AS party_key, s_name AS name, s_nationkey AS nation FROM supplier
       UNION ALL SELECT c_custkey, c_name, c_nationkey FROM customer
       WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)""",
)
def insert_absent(spark, sf_dir):
    def parties(kind, key, p):
        named = [F.col(key).alias("party_key"), F.col(f"{p}_name").alias("name"), F.col(f"{p}_nationkey").alias("nation")]
        return table(spark, sf_dir, kind).select(*named)

    target, source = parties("supplier", "s_suppkey", "s"), parties("customer", "c_custkey", "c")
    return insert_if_absent(target, source, ["party_key"])


@query(
    "time_attributes",
    """SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(minute(ts) AS INTEGER) AS minute,
         CASE WHEN hour(ts) < 12 THEN 'AM' ELSE 'PM' END AS period,
         hour(ts) IN (7, 8, 9, 16, 17, 18) AS is_rush_hour,
         hour(ts) < 6 OR hour(ts) >= 21 AS is_night
       FROM events""",
)
def time_attributes(spark, sf_dir):
    hour = F.hour("ts")
    return table(spark, sf_dir, "events").select(
        "event_id",
        hour.alias("hour"),
        F.minute("ts").alias("minute"),
        period_of_day(hour).alias("period"),
        is_rush_hour(hour).alias("is_rush_hour"),
        in_hours(hour, fixed.NIGHT_HOURS).alias("is_night"),
    )


@query(
    "date_attributes",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
         CAST(quarter(o_orderdate) AS INTEGER) AS quarter, CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS day_of_week,
         CAST(week(o_orderdate) AS INTEGER) AS week_of_year, count(*) AS trip_count
       FROM orders GROUP BY ALL""",
)
def date_attributes(spark, sf_dir):
    d = F.col("o_orderdate")
    return count_by(
        table(spark, sf_dir, "orders"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.quarter(d).alias("quarter"),
        F.dayofweek(d).alias("day_of_week"),
        F.weekofyear(d).alias("week_of_year"),
    )


@query(
    "dim_date_far",
    f"""WITH {dim_date("(SELECT min(o_orderdate)::TIMESTAMP FROM orders)", "TIMESTAMP '2300-12-31 00:00:00'")}
        SELECT {DATE_OUTPUT} FROM dim_date""",
)
def dim_date_far(spark, sf_dir):
    """The calendar of orders of which one lies centuries away."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    far = orders.unionAll(orders.limit(1).select(F.lit("2300-12-31").cast("date").alias("day")))
    return dims.calendar_over(dims.date_range(far, "day"))
