"""Queries over data-quality checks, the run ledger, alerts and metrics."""

from pyspark.sql import functions as F

from starmart.operators import dims
from starmart.operators.gate import passes
from starmart.operators.quality import Checks, calendar_constraints, clock_constraints, key_checks, summary
from starmart.operators.star import TRIP_STAR
from starmart.plans.ledger import alerts_by_level, metric_rollup, run_summary, stage_alerts, stage_metrics
from starmart.workload.registry import (
    EVENT_CALENDAR,
    EVENT_FACT,
    LINE_CHECKS,
    LINE_TRIPS,
    ZONES,
    query,
    share_of,
)
from starmart.workload.testbed import (
    event_calendar,
    event_fact,
    gate_trips,
    line_rules,
    line_trips,
    table,
    zones,
)
from starmart.functions.keys import with_content_key


def check_sql(dataset: str, check: str, column: str, observed: str, relation: str, threshold: float = 0.0) -> str:
    """Oracle of one check: `observed` is an aggregate over the relation."""
    return f"""SELECT '{dataset}' AS dataset, '{check}' AS "check", '{column}' AS "column", total_rows, observed,
      {share_of("observed", "total_rows")} AS fraction, CAST({threshold} AS DOUBLE) AS threshold,
      coalesce(observed::DOUBLE / nullif(total_rows, 0)::DOUBLE, 0) <= {threshold} AS passed
      FROM (SELECT count(*) AS total_rows, CAST({observed} AS BIGINT) AS observed FROM {relation})"""


def nulls_sql(dataset, column, relation, threshold=0.0):
    violated = f"count(*) FILTER (WHERE {column} IS NULL)"
    return check_sql(dataset, "null_check", column, violated, relation, threshold)


def range_sql(dataset, column, relation, violation):
    return check_sql(dataset, "range_check", column, f"count(*) FILTER (WHERE {violation})", relation)


def unique_sql(dataset, columns, relation):
    distinct = f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT {columns} FROM {relation}))"
    return check_sql(dataset, "uniqueness_check", columns.replace(" ", ""), distinct, relation)


def all_of(*parts: str) -> str:
    return " UNION ALL ".join(parts)


NULL_COLUMNS = ["VendorID", "tpep_dropoff_datetime", "trip_distance", "payment_type"]


@query("dq_nulls", f"WITH {LINE_TRIPS} " + all_of(*[nulls_sql("trips", c, "line_trips", 0.15) for c in NULL_COLUMNS]))
def dq_nulls(spark, sf_dir):
    return Checks(line_trips(spark, sf_dir, NULL_COLUMNS), "trips").nulls(NULL_COLUMNS, threshold=0.15).report()


@query(
    "dq_range",
    f"WITH {LINE_TRIPS} "
    + all_of(
        range_sql("trips", "fare_amount", "line_trips", "fare_amount < 0 OR fare_amount > 50000"),
        range_sql("trips", "trip_distance", "line_trips", "trip_distance < 0"),
        range_sql("trips", "passenger_count", "line_trips", "passenger_count > 6"),
        range_sql("trips", "total_amount", "line_trips", "false"),
    ),
)
def dq_range(spark, sf_dir):
    trips = line_trips(spark, sf_dir, ["fare_amount", "trip_distance", "passenger_count", "total_amount"])
    return (
        Checks(trips, "trips")
        .between("fare_amount", 0, 50000)
        .between("trip_distance", low=0)
        .between("passenger_count", high=6)
        .between("total_amount")
        .report()
    )


UNIQUE = [("l_orderkey", "l_linenumber"), ("l_shipdate",), ("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice")]


@query("dq_uniqueness", all_of(*[unique_sql("lineitem", ", ".join(c), "lineitem") for c in UNIQUE]))
def dq_uniqueness(spark, sf_dir):
    checks = Checks(table(spark, sf_dir, "lineitem"), "lineitem")
    for columns in UNIQUE:
        checks.unique(*columns)
    return checks.report()


EVENT_REPORT = all_of(
    nulls_sql("events", "event_type", "events"),
    nulls_sql("events", "value", "events"),
    range_sql("events", "value", "events", "value < 0 OR value > 400"),
    check_sql(
        "events", "domain_check", "event_type",
        "count(*) FILTER (WHERE event_type NOT IN ('view', 'click', 'purchase'))", "events",
    ),
    unique_sql("events", "event_id", "events"),
    unique_sql("events", "user_id", "events"),
)


def event_checks(spark, sf_dir):
    return (
        Checks(table(spark, sf_dir, "events"), "events")
        .nulls(["event_type", "value"])
        .between("value", 0, 400)
        .allowed("event_type", ["view", "click", "purchase"])
        .unique("event_id")
        .unique("user_id")
        .report()
    )


@query("dq_report", EVENT_REPORT)
def dq_report(spark, sf_dir):
    return event_checks(spark, sf_dir)


@query(
    "dq_summary",
    f"""WITH report AS ({EVENT_REPORT})
        SELECT dataset, max(total_rows) AS total_rows, count(*) AS checks_total,
          count(*) FILTER (WHERE passed) AS checks_passed, count(*) FILTER (WHERE NOT passed) AS checks_failed,
          bool_and(passed) AS all_passed
        FROM report GROUP BY 1""",
)
def dq_summary(spark, sf_dir):
    return summary(event_checks(spark, sf_dir))


CLOCK = """
clock AS (
  SELECT hour(ts) AS hour, minute(ts) AS minute,
    CASE WHEN hour(ts) < 6 THEN 'Night' WHEN hour(ts) < 12 THEN 'Morning' WHEN hour(ts) < 17 THEN 'Afternoon'
         WHEN hour(ts) < 21 THEN 'Evening' ELSE 'Night' END AS time_of_day
  FROM events
)"""


@query(
    "dq_constraints",
    f"WITH {EVENT_CALENDAR}, {CLOCK} "
    + all_of(
        range_sql("calendar", "month", "dim_date", "month < 1 OR month > 12"),
        range_sql("calendar", "day", "dim_date", "day < 1 OR day > 31"),
        range_sql("calendar", "day_of_week", "dim_date", "day_of_week < 1 OR day_of_week > 7"),
        range_sql("calendar", "quarter", "dim_date", "quarter < 1 OR quarter > 4"),
        range_sql("clock", "hour", "clock", "hour < 0 OR hour > 23"),
        range_sql("clock", "minute", "clock", "minute < 0 OR minute > 59"),
        check_sql(
            "clock", "domain_check", "time_of_day",
            "count(*) FILTER (WHERE time_of_day NOT IN ('Morning', 'Afternoon', 'Evening', 'Night'))", "clock",
        ),
    ),
)
def dq_constraints(spark, sf_dir):
    hour = F.hour("ts")
    clock = table(spark, sf_dir, "events").select(
        hour.alias("hour"), F.minute("ts").alias("minute"), *dims.time_attributes(hour)
    )
    calendar = calendar_constraints(event_calendar(spark, sf_dir), "calendar").report()
    return calendar.unionByName(clock_constraints(clock, "clock").report())


REQUIRED = {
    "dim_date": ["full_date", "year"],
    "dim_location": ["location_id"],
    "fact_trips": ["date_key", "pickup_location_key", "fare_amount"],
}


@query(
    "dq_keys",
    f"WITH {EVENT_FACT}, {EVENT_CALENDAR}, {ZONES} "
    + all_of(
        nulls_sql("dim_date", "full_date", "dim_date"),
        nulls_sql("dim_date", "year", "dim_date"),
        unique_sql("dim_date", "date_key", "dim_date"),
        unique_sql("dim_date", "full_date", "dim_date"),
        nulls_sql("dim_location", "location_id", "dim_location"),
        unique_sql("dim_location", "location_key", "dim_location"),
        unique_sql("dim_location", "location_id", "dim_location"),
        nulls_sql("fact_trips", "date_key", "fact"),
        nulls_sql("fact_trips", "pickup_location_key", "fact"),
        nulls_sql("fact_trips", "fare_amount", "fact"),
        check_sql("fact_trips", "uniqueness_check", "trip_key", "0", "fact"),
    ),
)
def dq_keys(spark, sf_dir):
    tables = {
        "dim_date": event_calendar(spark, sf_dir),
        "dim_location": dims.locations(zones(spark, sf_dir)),
        "fact_trips": with_content_key(event_fact(spark, sf_dir)),
    }
    return key_checks(tables, TRIP_STAR, REQUIRED)


# The ledger of a pipeline that took one month a run and checked times, amounts and places in turn.
GROUPS = {"times": [1, 2, 3, 7], "amounts": [4, 5, 6], "places": [8, 9, 10, 11]}


def line_ledger(spark, sf_dir):
    rules = line_rules()
    trips = gate_trips(spark, sf_dir, "_year", "_month")
    fails = {stage: ~passes([rules[i - 1] for i in numbers]) for stage, numbers in GROUPS.items()}
    pickup = F.col("tpep_pickup_datetime")
    counted = trips.groupBy("_year", "_month").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(pickup).alias("started_at"),
        F.max(pickup).alias("ended_at"),
        *[F.count_if(failing).alias(stage) for stage, failing in fails.items()],
    )
    run_id = F.format_string("%04d-%02d", "_year", "_month")

    def entry(stage):
        out = F.col("n") - F.col(stage)
        return F.struct(
            F.lit(stage).alias("stage"),
            F.col("n").alias("records_in"),
            out.alias("records_out"),
            F.col(stage).alias("records_rejected"),
            F.when(F.col(stage) * 10 > F.col("n") * 7, "too many rejects").alias("error"),
        )

    entries = F.inline(F.array(*[entry(stage) for stage in GROUPS]))
    return counted.select(
        F.lit("order_lines").alias("pipeline"),
        run_id.alias("run_id"),
        "started_at",
        "ended_at",
        F.lit(0).cast("long").alias("bytes_processed"),
        entries,
    )


def _failing(numbers):
    return "NOT (" + " AND ".join(f"r{i}" for i in numbers) + ")"


LEDGER = f"""{LINE_CHECKS},
counted AS (
  SELECT printf('%04d-%02d', _year, _month) AS run_id, count(*) AS n,
    min(tpep_pickup_datetime) AS started_at, max(tpep_pickup_datetime) AS ended_at,
    {", ".join(f"count(*) FILTER (WHERE {_failing(numbers)}) AS {stage}" for stage, numbers in GROUPS.items())}
  FROM checked GROUP BY _year, _month
),
ledger AS (
  {" UNION ALL ".join(
    f'''SELECT 'order_lines' AS pipeline, run_id, '{stage}' AS stage, started_at, ended_at, n AS records_in,
    n - {stage} AS records_out, {stage} AS records_rejected,
    CASE WHEN {stage} * 10 > n * 7 THEN 'too many rejects' END AS error FROM counted''' for stage in GROUPS)}
),
shares AS (
  SELECT *, CASE WHEN records_in > 0 THEN records_rejected::DOUBLE / records_in::DOUBLE ELSE 0.0 END AS rejection_rate
  FROM ledger
),
alerts AS (
  SELECT pipeline, run_id, stage, 'critical' AS level, 'stage failed' AS reason, rejection_rate
  FROM shares WHERE error IS NOT NULL
  UNION ALL SELECT pipeline, run_id, stage, 'critical', 'high rejection rate', rejection_rate
  FROM shares WHERE error IS NULL AND rejection_rate >= 0.20
  UNION ALL SELECT pipeline, run_id, stage, 'warning', 'elevated rejection rate', rejection_rate
  FROM shares WHERE error IS NULL AND rejection_rate >= 0.05 AND rejection_rate < 0.20
  UNION ALL SELECT pipeline, run_id, stage, 'warning', 'no output records', rejection_rate
  FROM shares WHERE error IS NULL AND records_in > 0 AND records_out = 0
)"""


@query(
    "stage_rejection",
    f"""WITH {LEDGER}
        SELECT pipeline, run_id, stage, epoch(ended_at) - epoch(started_at) AS duration_seconds,
          records_in, records_out, records_rejected,
          {share_of("records_rejected", "records_in")} AS rejection_rate, CAST(0 AS BIGINT) AS bytes_processed,
          error IS NULL AS success, error
        FROM ledger""",
)
def stage_rejection(spark, sf_dir):
    return stage_metrics(line_ledger(spark, sf_dir))


@query("stage_alerts", f"WITH {LEDGER} SELECT * FROM alerts")
def alerts(spark, sf_dir):
    return stage_alerts(line_ledger(spark, sf_dir))


@query(
    "alerts_by_level",
    f"""WITH {LEDGER}
        SELECT level, count(a.run_id) AS alerts
        FROM (VALUES ('info'), ('warning'), ('critical')) l(level) LEFT JOIN alerts a USING (level) GROUP BY 1""",
)
def level_counts(spark, sf_dir):
    return alerts_by_level(stage_alerts(line_ledger(spark, sf_dir)))


@query(
    "run_summary",
    f"""WITH {LEDGER},
        totals AS (
          SELECT pipeline, run_id, count(*) AS stages_total, count(error) AS stages_failed,
            CAST(sum(records_in) AS BIGINT) AS total_records_in, CAST(sum(records_out) AS BIGINT) AS total_records_out,
            CAST(sum(records_rejected) AS BIGINT) AS total_records_rejected,
            epoch(max(ended_at)) - epoch(min(started_at)) AS duration_seconds
          FROM ledger GROUP BY 1, 2
        ),
        counts AS (
          SELECT run_id, count(*) AS alerts, count(*) FILTER (WHERE level = 'info') AS info,
            count(*) FILTER (WHERE level = 'warning') AS warning,
            count(*) FILTER (WHERE level = 'critical') AS critical
          FROM alerts GROUP BY 1
        )
        SELECT totals.*, stages_failed = 0 AS success, coalesce(alerts, 0) AS alerts, coalesce(info, 0) AS info,
          coalesce(warning, 0) AS warning, coalesce(critical, 0) AS critical
        FROM totals LEFT JOIN counts USING (run_id)""",
)
def summaries(spark, sf_dir):
    return run_summary(line_ledger(spark, sf_dir))


# Events as custom metrics: the type of event is the name, and decides the metric's type.
KIND = "CASE event_type WHEN 'view' THEN 'counter' WHEN 'signup' THEN 'gauge' WHEN 'error' THEN 'timer' ELSE 'histogram' END"


def event_metrics(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("name"),
        F.expr(KIND).alias("type"),
        "value",
        "ts",
        F.from_json("props", "map<string,string>").alias("tags"),
    )


def rollup_sql(tags: str) -> str:
    return f"""WITH m AS (
        SELECT event_type AS name, {KIND} AS type, value, ts, regexp_extract(props, '"k": ([0-9]+)', 1) AS k FROM events
      )
      SELECT name, type, {tags} count(*) AS measurements,
        CASE WHEN type = 'counter' THEN sum(CAST(value AS DECIMAL(28,9)))::DOUBLE END AS total,
        CASE WHEN type = 'gauge' THEN arg_max(value, ts) END AS latest,
        CASE WHEN type IN ('timer', 'histogram') THEN sum(CAST(value AS DECIMAL(28,9)))::DOUBLE / count(*)::DOUBLE END AS average,
        CASE WHEN type IN ('timer', 'histogram') THEN quantile_disc(value, 0.5) END AS p50,
        CASE WHEN type IN ('timer', 'histogram') THEN quantile_disc(value, 0.95) END AS p95
      FROM m GROUP BY {tags} name, type"""


@query("metric_rollup", rollup_sql(""))
def rollup(spark, sf_dir):
    return metric_rollup(event_metrics(spark, sf_dir))


@query("metric_rollup_by_tag", rollup_sql("k,"))
def rollup_by_tag(spark, sf_dir):
    return metric_rollup(event_metrics(spark, sf_dir), tags=["k"])
