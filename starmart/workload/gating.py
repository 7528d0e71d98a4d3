"""Queries over the quality gate."""

from pyspark.sql import functions as F

from starmart.operators import gate
from starmart.workload.registry import LINE_CHECKS, LINE_TRIPS, query
from starmart.workload.testbed import gate_trips, line_rules, line_trips

RULES = [
    "tpep_pickup_datetime_present",
    "tpep_dropoff_datetime_present",
    "tpep_dropoff_datetime_after_tpep_pickup_datetime",
    "fare_amount_at_least_0",
    "total_amount_at_least_0",
    "trip_distance_at_least_0",
    "shorter_than_94608000s",
    "PULocationID_present",
    "DOLocationID_present",
    "PULocationID_above_0",
    "DOLocationID_above_0",
]
ROW = """strftime(tpep_pickup_datetime, '%Y-%m-%d %H:%M:%S') AS tpep_pickup_datetime,
  strftime(tpep_dropoff_datetime, '%Y-%m-%d %H:%M:%S') AS tpep_dropoff_datetime,
  fare_amount, total_amount, trip_distance, PULocationID, DOLocationID"""


@query("gate_accepted", f"WITH {LINE_CHECKS} SELECT {ROW} FROM gated WHERE ok")
def gate_accepted(spark, sf_dir):
    return gate.accepted(gate_trips(spark, sf_dir), line_rules())


FAILED = ", ".join(f"CASE WHEN NOT r{i} THEN '{name}' END" for i, name in enumerate(RULES, 1))


@query(
    "gate_rejected",
    f"WITH {LINE_CHECKS} SELECT {ROW}, concat_ws(',', {FAILED}) AS failed_rules FROM gated WHERE NOT ok",
)
def gate_rejected(spark, sf_dir):
    rows = gate.rejected(gate_trips(spark, sf_dir), line_rules())
    return rows.withColumn("failed_rules", F.concat_ws(",", "failed_rules"))


@query(
    "gate_rejection_rate",
    f"""WITH {LINE_CHECKS},
        n AS (SELECT count(*) AS rows_in, count(*) FILTER (WHERE ok) AS rows_accepted FROM gated)
        SELECT rows_in, rows_accepted, rows_in - rows_accepted AS rows_rejected,
          CASE WHEN rows_in > 0 THEN (rows_in - rows_accepted)::DOUBLE / rows_in::DOUBLE * 100 ELSE 0.0 END
            AS rejected_percent
        FROM n""",
)
def gate_rejection_rate(spark, sf_dir):
    return gate.rejection_rate(gate_trips(spark, sf_dir), line_rules())


@query(
    "rejects_by_rule",
    f"WITH {LINE_CHECKS}\n"
    + " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER (WHERE NOT r{i}) AS rejected_rows FROM gated"
        for i, name in enumerate(RULES, 1)
    ),
)
def rejects_by_rule(spark, sf_dir):
    return gate.rejects_by_rule(gate_trips(spark, sf_dir), line_rules())


@query(
    "filter_date_bound",
    f"WITH {LINE_CHECKS} SELECT {ROW} FROM gated WHERE ok AND tpep_pickup_datetime < TIMESTAMP '1998-01-01'",
)
def filter_date_bound(spark, sf_dir):
    bound = gate.before("tpep_pickup_datetime", "1998-01-01")
    return gate.accepted(gate_trips(spark, sf_dir), [*line_rules(), bound])


@query(
    "optional_rules",
    f"""WITH {LINE_TRIPS}
        SELECT 'fare_amount_finite' AS rule, count(*) FILTER (WHERE fare_amount IS NULL) AS rejected_rows
        FROM line_trips
        UNION ALL SELECT 'trip_distance_finite', count(*) FILTER (WHERE trip_distance IS NULL) FROM line_trips
        UNION ALL SELECT 'distance_when_paid',
          count(*) FILTER (WHERE NOT coalesce(fare_amount <= 0 OR trip_distance > 0, false)) FROM line_trips""",
)
def optional_rules(spark, sf_dir):
    trips = line_trips(spark, sf_dir, ["fare_amount", "trip_distance"])
    rules = [
        gate.finite("fare_amount"),
        gate.finite("trip_distance"),
        gate.distance_when_paid("trip_distance", "fare_amount"),
    ]
    return gate.rejects_by_rule(trips, rules)


@query(
    "allowed_values",
    f"""WITH {LINE_TRIPS}
        SELECT VendorID, payment_type, count(*) AS violations FROM line_trips
        WHERE VendorID NOT IN (1) OR payment_type NOT IN (1, 2, 3) GROUP BY 1, 2""",
)
def allowed_values(spark, sf_dir):
    trips = line_trips(spark, sf_dir, ["VendorID", "payment_type"])
    outside = gate.not_allowed("VendorID", [1]) | gate.not_allowed("payment_type", [1, 2, 3])
    return trips.filter(outside).groupBy("VendorID", "payment_type").agg(F.count(F.lit(1)).alias("violations"))


@query(
    "time_order_violations",
    f"""WITH {LINE_TRIPS}
        SELECT strftime(tpep_pickup_datetime, '%Y-%m-%d %H:%M:%S') AS tpep_pickup_datetime,
          strftime(tpep_dropoff_datetime, '%Y-%m-%d %H:%M:%S') AS tpep_dropoff_datetime
        FROM line_trips WHERE tpep_pickup_datetime > tpep_dropoff_datetime""",
)
def time_order_violations(spark, sf_dir):
    times = ["tpep_pickup_datetime", "tpep_dropoff_datetime"]
    return line_trips(spark, sf_dir, times).filter(gate.out_of_order(*times))
