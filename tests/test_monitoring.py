"""Data-quality checks, ledger, alerts, summaries, metrics."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from starmart.operators.quality import Checks, summary
from starmart.plans.ledger import (
    LEDGER,
    METRICS,
    RunLedger,
    alerts_by_level,
    exact_percentiles,
    metric_rollup,
    run_summary,
    stage_alerts,
    stage_metrics,
)


def by_column(report):
    return {(r.check, r.column): r for r in report.collect()}


def test_checks_on_the_fixture(trips):
    report = (
        Checks(trips, "trips")
        .nulls(["VendorID", "tpep_pickup_datetime", "fare_amount"])
        .between("fare_amount", 0, 500)
        .between("trip_distance", low=0)
        .allowed("VendorID", [1, 2])
        .unique("VendorID")
        .unique("tpep_pickup_datetime")
        .report()
    )
    rows = by_column(report)
    assert rows["uniqueness_check", "VendorID"].observed == 3
    assert not rows["uniqueness_check", "VendorID"].passed
    assert all(r.passed for k, r in rows.items() if k != ("uniqueness_check", "VendorID"))
    total = summary(report).first()
    assert (total.checks_total, total.checks_passed, total.checks_failed, total.all_passed) == (8, 7, 1, False)


def test_nulls_and_thresholds(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "a int")
    rows = by_column(Checks(df, "d").nulls(["a"], 0.5).report())
    row = rows["null_check", "a"]
    assert (row.observed, row.fraction, row.passed) == (1, 0.3333, True)
    assert not by_column(Checks(df, "d").nulls(["a"], 0.3).report())["null_check", "a"].passed
    assert by_column(Checks(df, "d").between("a").report())["range_check", "a"].observed == 0


def test_null_is_one_value_to_uniqueness(spark):
    df = spark.createDataFrame([(1,), (None,), (None,)], "a int")
    row = by_column(Checks(df, "d").unique("a").report())["uniqueness_check", "a"]
    assert (row.total_rows, row.observed) == (3, 1)
    near = by_column(Checks(df, "d").unique("a", approximate=True).report())["uniqueness_check", "a"]
    assert near.observed == 1


def test_checks_of_an_empty_frame_pass(trips):
    report = Checks(trips.limit(0), "t").nulls(["VendorID"]).between("fare_amount", 0).unique("VendorID").report()
    assert all(r.passed and r.total_rows == 0 and r.fraction == 0 for r in report.collect())


STAGES = [
    ("test_pipeline", "stage_1", 100, 95, 5, None),
    ("multi_stage_pipeline", "extract", 0, 1000, 0, None),
    ("multi_stage_pipeline", "transform", 1000, 950, 50, None),
    ("multi_stage_pipeline", "load", 950, 950, 0, None),
    ("alert_test", "bad_stage", 100, 70, 30, None),
    ("demo_pipeline", "transform", 3000000, 2950000, 50000, None),
    ("empty_output", "load", 10, 0, 10, None),
    ("failing", "load", 10, 0, 10, "boom"),
]


@pytest.fixture
def ledger(spark):
    t = datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 2)
    return spark.createDataFrame([(p, "r", s, *t, i, o, x, 0, e) for p, s, i, o, x, e in STAGES], LEDGER)


def test_alerts(ledger):
    raised = {(r.pipeline, r.stage, r.level, r.reason) for r in stage_alerts(ledger).collect()}
    assert raised == {
        ("test_pipeline", "stage_1", "warning", "elevated rejection rate"),
        ("multi_stage_pipeline", "transform", "warning", "elevated rejection rate"),
        ("alert_test", "bad_stage", "critical", "high rejection rate"),
        ("empty_output", "load", "critical", "high rejection rate"),
        ("empty_output", "load", "warning", "no output records"),
        ("failing", "load", "critical", "stage failed"),
    }


def test_alert_levels_are_zero_filled(ledger):
    levels = {r.level: r.alerts for r in alerts_by_level(stage_alerts(ledger)).collect()}
    assert levels == {"info": 0, "warning": 3, "critical": 3}
    none = alerts_by_level(stage_alerts(ledger.limit(0))).collect()
    assert {r.level: r.alerts for r in none} == {"info": 0, "warning": 0, "critical": 0}


def test_stage_metrics(ledger):
    rows = {(r.pipeline, r.stage): r for r in stage_metrics(ledger).collect()}
    assert rows["demo_pipeline", "transform"].rejection_rate == 0.0167
    assert rows["multi_stage_pipeline", "extract"].rejection_rate == 0.0
    assert rows["alert_test", "bad_stage"].duration_seconds == 2.0
    assert not rows["failing", "load"].success


def test_run_summary(ledger):
    rows = {r.pipeline: r for r in run_summary(ledger).collect()}
    multi = rows["multi_stage_pipeline"]
    assert (multi.stages_total, multi.stages_failed, multi.success) == (3, 0, True)
    assert (multi.total_records_in, multi.total_records_out, multi.total_records_rejected) == (1950, 2900, 50)
    assert (multi.alerts, multi.info, multi.warning, multi.critical) == (1, 0, 1, 0)
    assert not rows["failing"].success
    assert rows["demo_pipeline"].alerts == 0


def test_a_failed_stage_is_recorded_and_raised(spark, folder):
    runs = RunLedger(spark, folder, "p", "run1")
    with runs.stage("good") as stage:
        stage.records_in = stage.records_out = 3
    with pytest.raises(RuntimeError, match="boom"), runs.stage("bad"):
        raise RuntimeError("boom")
    assert {(r.stage, r.records_in, r.error) for r in runs.this_run().collect()} == {("good", 3, None), ("bad", 0, "boom")}


def test_metrics_roll_up_by_type(spark):
    def at(second):
        return datetime(2024, 1, 1, 0, 0, second)

    rows = [
        ("r", "rows", 2.0, "counter", at(1), {"t": "a"}), ("r", "rows", 3.0, "counter", at(2), {"t": "b"}),
        ("r", "heap", 9.0, "gauge", at(5), {}), ("r", "heap", 1.0, "gauge", at(2), {}),
        ("r", "took", 1.0, "timer", at(1), {}), ("r", "took", 3.0, "timer", at(1), {}),
    ]
    df = spark.createDataFrame(rows, METRICS)
    rolled = {r.name: r for r in metric_rollup(df).collect()}
    assert (rolled["rows"].total, rolled["rows"].latest, rolled["rows"].average) == (5.0, None, None)
    assert rolled["heap"].latest == 9.0
    assert (rolled["took"].average, rolled["took"].p50, rolled["took"].p95) == (2.0, 1.0, 3.0)
    assert {(r.t, r.total) for r in metric_rollup(df.filter("name = 'rows'"), tags=["t"]).collect()} == {("a", 2.0), ("b", 3.0)}


def test_metric_types_are_checked(spark, folder):
    runs = RunLedger(spark, folder, "p", "run1")
    runs.metric("rows", 5, "counter", {"t": "a"})
    assert runs.metrics().first().tags == {"t": "a"}
    with pytest.raises(ValueError):
        runs.metric("rows", 5, "dial")


def test_gauges_of_one_time_do_not_depend_on_the_order_of_rows(spark):
    at = datetime(2024, 1, 1)
    rows = [("g", "gauge", v, at, {}) for v in (0.0, 7.0, 3.0)] + [("h", "timer", v, at, {}) for v in (2.0, None, 4.0)]
    metrics = spark.createDataFrame(rows, "name string, type string, value double, ts timestamp, tags map<string, string>")
    for df in (metrics, metrics.repartition(5), metrics.orderBy("value")):
        found = {r.name: r for r in metric_rollup(df).collect()}
        assert found["g"].latest == 7.0 and found["h"].average == 3.0


def test_percentiles_are_exact_beyond_any_sketch(spark):
    """A million values a group, many of them repeated, ranks of a small sketch off by thousands."""
    n = 1_000_000
    rows = spark.range(n).select(
        (F.col("id") % 2).cast("string").alias("g"), (F.xxhash64("id") % 300_000).cast("double").alias("v")
    )
    rows = rows.unionAll(spark.createDataFrame([(None, 7.0), ("0", None), ("z", None)], "g string, v double"))
    got = {(r.g, r.share): r.percentile for r in exact_percentiles(rows, ["g"], "v", ["0.5", "0.95"], sketch=100).collect()}
    held = rows.where("v IS NOT NULL").toPandas()
    want = {}
    for g, own in held.groupby("g", dropna=False):
        ordered = sorted(own.v)
        for share in (50, 95):
            want[None if g != g or g is None else g, "0.5" if share == 50 else "0.95"] = ordered[-(-len(ordered) * share // 100) - 1]
    assert got == want


def test_all_unique_checks_are_one_scan(spark, folder):
    spark.range(100).selectExpr("id % 10 AS a", "id AS b", "if(id < 5, null, id) AS c").write.parquet(f"{folder}/t")
    df = spark.read.parquet(f"{folder}/t")
    report = Checks(df, "t").unique("a").unique("b").unique("c").unique("a", "b").report()
    assert report._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert {r.column: (r.total_rows, r.observed) for r in report.collect()} == {"a": (100, 90), "b": (100, 0), "c": (100, 4), "a,b": (100, 0)}
    empty = Checks(df.limit(0), "t").unique("a").report().first()
    assert (empty.total_rows, empty.observed, empty.passed) == (0, 0, True)
