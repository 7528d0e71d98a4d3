"""Queries over keys, the fact build and the star."""

from pyspark.sql import functions as F

from starmart.contracts import align
from starmart import contracts
from starmart.functions.keys import date_key, position_key, time_key, with_content_key
from starmart.functions.measures import minutes_between
from starmart.operators import dims, marts
from starmart.operators.fact import build_fact
from starmart.operators.gate import accepted, trip_rules
from starmart.operators.star import fk_orphans, look_up, star_join
from starmart.sources.lake import without_surrogate
from starmart.workload.registry import (
    CODES,
    DIM_TIME,
    EVENT_CALENDAR,
    EVENT_FACT,
    EVENT_TRIPS,
    FACT_KEYS,
    FACT_OUTPUT,
    LINE_FACT,
    LINE_TRIPS,
    MART,
    ORDER_CALENDAR,
    ZONES,
    fact_of,
    query,
)
from starmart.workload.testbed import (
    dimensions,
    event_calendar,
    event_fact,
    event_trips,
    line_fact,
    line_trips,
    order_calendar,
    table,
    zones,
)

KEY_FACTS = "SELECT count(*) AS row_count, count(*) AS distinct_keys, CAST(0 AS BIGINT) AS null_keys FROM {}"


def key_facts(df, key):
    """Rows, distinct keys, null keys: all one can say of a generated key in another engine."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.sum("n").alias("row_count"),
        F.count(key).alias("distinct_keys"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).alias("null_keys"),
    )


@query("surrogate_key", KEY_FACTS.format("(SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem)"))
def surrogate_key(spark, sf_dir):
    """Every order line twice over: copies must get keys of their own."""
    lines = table(spark, sf_dir, "lineitem")
    return key_facts(with_content_key(lines.unionByName(lines)), "trip_key")


@query("surrogate_key_with_copies", KEY_FACTS.format("(SELECT c_mktsegment, c_nationkey FROM customer)"))
def surrogate_key_with_copies(spark, sf_dir):
    """Rows that are nearly all copies of each other."""
    copies = table(spark, sf_dir, "customer").select("c_mktsegment", "c_nationkey")
    return key_facts(with_content_key(copies), "row_id")


@query("surrogate_key_by_position", KEY_FACTS.format("orders"))
def surrogate_key_by_position(spark, sf_dir):
    d = F.col("o_orderdate")
    key = position_key(F.year(d), F.month(d), F.lit(0).cast("long"), F.col("_metadata.row_index"))
    return key_facts(table(spark, sf_dir, "orders").select(key.alias("trip_key")), "trip_key")


@query(
    "date_key",
    """SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key FROM orders""",
)
def date_keys(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", date_key(F.col("o_orderdate")).alias("date_key"))


@query(
    "time_keys",
    f"""WITH {EVENT_TRIPS}
        SELECT event_id,
          CAST(hour(tpep_pickup_datetime) * 100 + minute(tpep_pickup_datetime) AS INTEGER) AS pickup_time_key,
          CAST(hour(tpep_dropoff_datetime) * 100 + minute(tpep_dropoff_datetime) AS INTEGER) AS dropoff_time_key
        FROM event_trips""",
)
def time_keys(spark, sf_dir):
    return event_trips(spark, sf_dir).select(
        "event_id",
        time_key(F.col("tpep_pickup_datetime")).alias("pickup_time_key"),
        time_key(F.col("tpep_dropoff_datetime")).alias("dropoff_time_key"),
    )


@query(
    "trip_duration",
    f"""WITH {EVENT_TRIPS}
        SELECT event_id, round(
          (epoch_us(tpep_dropoff_datetime) // 1000000 - epoch_us(tpep_pickup_datetime) // 1000000) / 60.0, 2
        ) AS trip_duration_minutes FROM event_trips""",
)
def trip_duration(spark, sf_dir):
    minutes = minutes_between(F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime"))
    return event_trips(spark, sf_dir).select("event_id", minutes.alias("trip_duration_minutes"))


@query("fact_build", f"WITH {LINE_FACT} SELECT {FACT_OUTPUT} FROM fact")
def fact_build(spark, sf_dir):
    return line_fact(spark, sf_dir)


EVENT_GATED = f"""{EVENT_TRIPS},
kept AS (
  SELECT * FROM event_trips
  WHERE tpep_dropoff_datetime > tpep_pickup_datetime AND fare_amount >= 0 AND total_amount >= 0
    AND trip_distance >= 0 AND epoch(tpep_dropoff_datetime) - epoch(tpep_pickup_datetime) < 86400
    AND PULocationID > 0 AND DOLocationID > 0
), {fact_of("kept", "fact", "events.parquet")}"""


@query("fact_without_surrogate", f"WITH {EVENT_GATED} SELECT {FACT_OUTPUT} FROM fact")
def fact_without_surrogate(spark, sf_dir):
    """A fact with a content key, as a target that makes its own keys would be given it."""
    trips = align(event_trips(spark, sf_dir), contracts.BRONZE_TRIPS)
    fact = with_content_key(build_fact(accepted(trips, trip_rules()))).drop("row_id")
    return without_surrogate(fact)


@query(
    "zone_lookup_left",
    f"""WITH {EVENT_TRIPS}, {ZONES}
        SELECT event_id, PULocationID, Borough AS pickup_Borough, Zone AS pickup_Zone
        FROM event_trips LEFT JOIN zones ON PULocationID = LocationID""",
)
def zone_lookup_left(spark, sf_dir):
    trips = event_trips(spark, sf_dir).select("event_id", "PULocationID")
    lookup = zones(spark, sf_dir)
    return look_up(trips, lookup, "PULocationID", "LocationID", "pickup_", ["Borough", "Zone"])


@query(
    "role_playing_locations",
    f"""WITH {LINE_TRIPS}, {ZONES}
        SELECT PULocationID, DOLocationID, p.Borough AS pickup_Borough, p.Zone AS pickup_Zone,
          d.Borough AS dropoff_Borough, d.Zone AS dropoff_Zone
        FROM line_trips LEFT JOIN zones p ON PULocationID = p.LocationID
        LEFT JOIN zones d ON DOLocationID = d.LocationID""",
)
def role_playing_locations(spark, sf_dir):
    trips = line_trips(spark, sf_dir, ["PULocationID", "DOLocationID"])
    lookup, names = zones(spark, sf_dir), ["Borough", "Zone"]
    picked = look_up(trips, lookup, "PULocationID", "LocationID", "pickup_", names)
    return look_up(picked, lookup, "DOLocationID", "LocationID", "dropoff_", names)


@query(
    "fact_date_range",
    f"""WITH {EVENT_FACT}, {EVENT_CALENDAR}
        SELECT CAST(min(full_date) AS VARCHAR) AS min_date, CAST(max(full_date) AS VARCHAR) AS max_date
        FROM fact JOIN dim_date USING (date_key)""",
)
def fact_date_range(spark, sf_dir):
    return marts.fact_date_range(event_fact(spark, sf_dir), event_calendar(spark, sf_dir))


STAR_ATTRIBUTES = {
    "dim_date": ["full_date", "day_name", "is_weekend"],
    "dim_time": ["time_of_day", "is_rush_hour"],
    "dim_location": ["borough", "zone_name"],
    "dim_vendor": ["vendor_name"],
    "dim_ratecode": ["ratecode_name"],
    "dim_payment_type": ["payment_type_name"],
}
STAR_MEASURES = ["trip_duration_minutes", "total_amount"]


def star_sql(fact: str, calendar: str) -> str:
    return f"""WITH {fact}, {calendar}, {DIM_TIME}, {ZONES}, {CODES}
      SELECT {", ".join(f"fact.{k}" for k in FACT_KEYS)},
        {", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in STAR_MEASURES)},
        CAST(full_date AS VARCHAR) AS full_date, day_name, is_weekend,
        pt.time_of_day AS pickup_time_of_day, pt.is_rush_hour AS pickup_is_rush_hour,
        dt.time_of_day AS dropoff_time_of_day, dt.is_rush_hour AS dropoff_is_rush_hour,
        pl.borough AS pickup_borough, pl.zone_name AS pickup_zone_name,
        dl.borough AS dropoff_borough, dl.zone_name AS dropoff_zone_name,
        vendor_name, ratecode_name, payment_type_name
      FROM fact
      LEFT JOIN dim_date d ON fact.date_key = d.date_key
      LEFT JOIN dim_time pt ON fact.pickup_time_key = pt.time_key
      LEFT JOIN dim_time dt ON fact.dropoff_time_key = dt.time_key
      LEFT JOIN dim_location pl ON fact.pickup_location_key = pl.location_key
      LEFT JOIN dim_location dl ON fact.dropoff_location_key = dl.location_key
      LEFT JOIN dim_vendor v ON fact.vendor_key = v.vendor_key
      LEFT JOIN dim_ratecode r ON fact.ratecode_key = r.ratecode_key
      LEFT JOIN dim_payment_type p ON fact.payment_type_key = p.payment_type_key"""


@query("star_join_wide", star_sql(LINE_FACT, ORDER_CALENDAR))
def star_join_wide(spark, sf_dir):
    """The flagship: gated order lines as a fact, joined to all eight dimension roles."""
    fact = line_fact(spark, sf_dir).select(*FACT_KEYS, *STAR_MEASURES)
    tables = dimensions(spark, sf_dir, order_calendar(spark, sf_dir))
    return star_join(fact, tables, attributes=STAR_ATTRIBUTES)


@query("star_join_minutes", star_sql(EVENT_FACT, EVENT_CALENDAR))
def star_join_minutes(spark, sf_dir):
    """The same at minute grain, with times that differ and zones that do not resolve."""
    fact = event_fact(spark, sf_dir).select(*FACT_KEYS, *STAR_MEASURES)
    tables = dimensions(spark, sf_dir, event_calendar(spark, sf_dir))
    return star_join(fact, tables, attributes=STAR_ATTRIBUTES)


def orphan_sql(fk: str, dim: str, key: str) -> str:
    return f"""SELECT '{fk}' AS fk, count(*) FILTER (WHERE d.{key} IS NULL AND fact.{fk} IS NOT NULL) AS orphan_rows,
      count(DISTINCT CASE WHEN d.{key} IS NULL THEN fact.{fk} END) AS orphan_keys
      FROM fact LEFT JOIN {dim} d ON fact.{fk} = d.{key}"""


ORPHANS = " UNION ALL ".join(
    orphan_sql(fk, dim, key)
    for fk, dim, key in [
        ("date_key", "dim_date", "date_key"),
        ("pickup_time_key", "dim_time", "time_key"),
        ("dropoff_time_key", "dim_time", "time_key"),
        ("pickup_location_key", "dim_location", "location_key"),
        ("dropoff_location_key", "dim_location", "location_key"),
        ("vendor_key", "dim_vendor", "vendor_key"),
        ("ratecode_key", "dim_ratecode", "ratecode_key"),
        ("payment_type_key", "dim_payment_type", "payment_type_key"),
    ]
)


@query("fk_orphans", f"WITH {LINE_FACT}, {ORDER_CALENDAR}, {DIM_TIME}, {ZONES}, {CODES} {ORPHANS}")
def orphans(spark, sf_dir):
    return fk_orphans(line_fact(spark, sf_dir), dimensions(spark, sf_dir, order_calendar(spark, sf_dir)))


@query("fk_orphans_minutes", f"WITH {EVENT_FACT}, {EVENT_CALENDAR}, {DIM_TIME}, {ZONES}, {CODES} {ORPHANS}")
def orphans_minutes(spark, sf_dir):
    return fk_orphans(event_fact(spark, sf_dir), dimensions(spark, sf_dir, event_calendar(spark, sf_dir)))


@query(
    "weekday_rush",
    f"""WITH {EVENT_FACT}, {EVENT_CALENDAR}, {DIM_TIME}
        SELECT is_rush_hour AND NOT is_weekend AS is_weekday_rush, {MART}
        FROM fact JOIN dim_date USING (date_key) JOIN dim_time ON pickup_time_key = time_key GROUP BY 1""",
)
def weekday_rush(spark, sf_dir):
    return marts.by_weekday_rush(event_fact(spark, sf_dir), event_calendar(spark, sf_dir), dims.minute_of_day(spark))
