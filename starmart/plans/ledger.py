"""Run ledger: stage counts as an append-only table, and alerts, summaries and metrics over it."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart import fixed_values as fixed
from starmart.functions.measures import rate

LEDGER = """
    pipeline STRING, run_id STRING, stage STRING, started_at TIMESTAMP, ended_at TIMESTAMP,
    records_in BIGINT, records_out BIGINT, records_rejected BIGINT, bytes_processed BIGINT, error STRING
"""
# Values are summed as decimals: sums of doubles change with the order in which tasks deliver them.
EXACT = "decimal(28,9)"
METRICS = "run_id STRING, name STRING, value DOUBLE, type STRING, ts TIMESTAMP, tags MAP<STRING, STRING>"


def _now() -> datetime:
    return datetime.now(timezone.utc)


@dataclass
class Stage:
    """Counts of one stage, set while it runs from what its writes observed."""

    name: str
    records_in: int = 0
    records_out: int = 0
    records_rejected: int = 0
    bytes_processed: int = 0


class RunLedger:
    """Appends one row per stage, and custom metrics, to tables under a folder."""

    def __init__(self, spark: SparkSession, folder: str, pipeline: str, run_id: str):
        self.spark, self.folder, self.pipeline, self.run_id = spark, folder, pipeline, run_id

    @contextmanager
    def stage(self, name: str) -> Iterator[Stage]:
        """Record a stage; a failing one is recorded with its error and the error raised again."""
        running, started, error = Stage(name), _now(), None
        try:
            yield running
        except Exception as failure:
            error = str(failure)
            raise
        finally:
            row = (
                self.pipeline,
                self.run_id,
                name,
                started,
                _now(),
                running.records_in,
                running.records_out,
                running.records_rejected,
                running.bytes_processed,
                error,
            )
            stages = self.spark.createDataFrame([row], LEDGER).coalesce(1)
            stages.write.mode("append").parquet(f"{self.folder}/stages")

    def metric(self, name: str, value: float, type: str = "gauge", tags: dict[str, str] | None = None) -> None:
        """Record one custom metric."""
        self.record([(name, value, type, tags or {})])

    def record(self, metrics: Sequence[tuple[str, float, str, dict[str, str]]]) -> None:
        """Record custom metrics (name, value, type, tags) in one write."""
        unknown = {kind for _, _, kind, _ in metrics} - set(fixed.METRIC_TYPES)
        if unknown:
            raise ValueError(f"unknown metric types: {sorted(unknown)}")
        now = _now()
        rows = [(self.run_id, name, float(value), kind, now, tags) for name, value, kind, tags in metrics]
        self.spark.createDataFrame(rows, METRICS).coalesce(1).write.mode("append").parquet(f"{self.folder}/metrics")

    def stages(self) -> DataFrame:
        """Every stage of every run recorded so far."""
        return self.spark.read.parquet(f"{self.folder}/stages")

    def this_run(self) -> DataFrame:
        return self.stages().filter(F.col("run_id") == self.run_id)

    def metrics(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/metrics")


def _seconds(ts: Column) -> Column:
    """Seconds since 1970 with microseconds, as decimal so that differences are exact."""
    return (F.unix_micros(ts) / F.lit(1000000).cast("decimal(7,0)")).cast("decimal(18,6)")


def rejection_rate() -> Column:
    return rate(F.col("records_rejected"), F.col("records_in"))


def stage_metrics(ledger: DataFrame) -> DataFrame:
    """The ledger with duration, success and rejection rate (4 decimals, 0 when nothing came in)."""
    return ledger.select(
        "pipeline",
        "run_id",
        "stage",
        (_seconds(F.col("ended_at")) - _seconds(F.col("started_at"))).alias("duration_seconds"),
        "records_in",
        "records_out",
        "records_rejected",
        F.round(rejection_rate(), 4).alias("rejection_rate"),
        "bytes_processed",
        F.col("error").isNull().alias("success"),
        "error",
    )


def stage_alerts(
    ledger: DataFrame,
    warning: float = fixed.REJECTION_WARNING,
    critical: float = fixed.REJECTION_CRITICAL,
) -> DataFrame:
    """One row per alert: (pipeline, run_id, stage, level, reason, rejection_rate).

    A stage can raise more than one: its rejection rate (limits included) and an
    empty output. A failed stage raises its failure only.
    """
    share, failed = rejection_rate(), F.col("error").isNotNull()

    def alert(level: str, reason: str) -> Column:
        return F.struct(F.lit(level).alias("level"), F.lit(reason).alias("reason"))

    by_rate = F.when(share >= critical, alert("critical", "high rejection rate")).when(
        share >= warning, alert("warning", "elevated rejection rate")
    )
    empty = F.when(
        (F.col("records_in") > 0) & (F.col("records_out") == 0), alert("warning", "no output records")
    )
    raised = F.array_compact(
        F.array(
            F.when(failed, alert("critical", "stage failed")),
            F.when(~failed, by_rate),
            F.when(~failed, empty),
        )
    )
    return ledger.select("pipeline", "run_id", "stage", F.inline(raised), share.alias("rejection_rate"))


def alerts_by_level(alerts: DataFrame, *by: str) -> DataFrame:
    """Alerts per level (and per `by`), with zeros for levels that raised none."""
    counts = [F.count_if(F.col("level") == level).alias(level) for level in fixed.ALERT_LEVELS]
    levels = [F.struct(F.lit(level).alias("level"), F.col(level).alias("alerts")) for level in fixed.ALERT_LEVELS]
    return alerts.groupBy(*by).agg(*counts).select(*by, F.inline(F.array(*levels)))


def run_summary(ledger: DataFrame) -> DataFrame:
    """One row per run: stages, failures, record totals, duration, alerts by level."""
    totals = ledger.groupBy("pipeline", "run_id").agg(
        F.count(F.lit(1)).alias("stages_total"),
        F.count_if(F.col("error").isNotNull()).alias("stages_failed"),
        F.sum("records_in").alias("total_records_in"),
        F.sum("records_out").alias("total_records_out"),
        F.sum("records_rejected").alias("total_records_rejected"),
        F.round(_seconds(F.max("ended_at")) - _seconds(F.min("started_at")), 2).alias("duration_seconds"),
    )
    alerts = stage_alerts(ledger).groupBy("pipeline", "run_id").agg(
        F.count(F.lit(1)).alias("alerts"),
        *[F.count_if(F.col("level") == level).alias(level) for level in fixed.ALERT_LEVELS],
    )
    filled = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ["alerts", *fixed.ALERT_LEVELS]]
    return totals.join(alerts, ["pipeline", "run_id"], "left").select(
        *totals.columns, (F.col("stages_failed") == 0).alias("success"), *filled
    )


#: Values that a percentile's sketch holds; it narrows the search and leaves the result exact.
SKETCH = 10_000


def exact_percentiles(values: DataFrame, by: Sequence[str], value: str, shares: Sequence[str], sketch: int = SKETCH) -> DataFrame:
    """(by..., share, percentile): of each group the smallest value that has at least this share of the ranks.

    Ranks are selected in two passes. A sketch of bounded size brackets each percentile between two values. Then values
    below the bracket are counted as one and those within it by value, which combines before the shuffle; only the
    different values of a bracket, some 4 / sketch of a group's, are sorted. Nulls do not count; shares are decimal text.
    """
    present = values.where(F.col(value).isNotNull()).select(*by, F.col(value).alias("__value"))
    margin = 2 / sketch
    edges = [max(0.0, float(q) - margin) for q in shares] + [min(1.0, float(q) + margin) for q in shares]
    found = present.groupBy(*by).agg(
        F.count(F.lit(1)).alias("__n"),
        F.percentile_approx("__value", edges, sketch).alias("__edges"),
        F.min("__value").alias("__min"),
        F.max("__value").alias("__max"),
    )

    def bracket(k: int, share: str) -> Column:
        rank = F.greatest(F.ceil(F.col("__n").cast("decimal(20,0)") * F.lit(share).cast("decimal(10,9)")).cast("long"), F.lit(1))
        low = F.col("__min") if float(share) <= margin else F.col("__edges")[k]
        high = F.col("__max") if float(share) + margin >= 1 else F.col("__edges")[k + len(shares)]
        return F.struct(F.lit(share).alias("share"), rank.alias("rank"), low.alias("low"), high.alias("high"))

    asked = found.select(
        *[F.col(c).alias(f"__by_{c}") for c in by], F.explode(F.array(*[bracket(k, q) for k, q in enumerate(shares)])).alias("b")
    )
    same = [F.col(c).eqNullSafe(F.col(f"__by_{c}")) for c in by]
    met = present.join(asked, reduce(Column.__and__, same, F.lit(True)) if same else None)
    inside = F.when(F.col("__value") >= F.col("b.low"), F.col("__value"))
    counted = met.where("__value <= b.high").groupBy(*by, "b.share", "b.rank", inside.alias("__at")).agg(F.count(F.lit(1)).alias("__n"))
    order = Window.partitionBy(*by, "share").orderBy(F.col("__at").asc_nulls_first())
    reached = counted.withColumn("__reached", F.sum("__n").over(order)).where("__at IS NOT NULL AND __reached >= rank")
    return reached.groupBy(*by, "share").agg(F.min("__at").alias("percentile"))


def metric_rollup(metrics: DataFrame, tags: Sequence[str] = (), latest_by: str = "ts", sketch: int = SKETCH) -> DataFrame:
    """Custom metrics per name and type (and per value of the named tags).

    A counter sums, a gauge keeps the value with the highest `latest_by`, timers
    and histograms give average and percentiles, exact however many values there are (see `exact_percentiles`).
    """
    tagged = metrics.select("name", "type", "value", F.col(latest_by).alias("__latest"), *[F.col("tags")[t].alias(t) for t in tags])
    by = ["name", "type", *tags]
    rolled = tagged.groupBy(*by).agg(
        F.count(F.lit(1)).alias("measurements"),
        F.sum(F.col("value").cast(EXACT)).cast("double").alias("__sum"),
        F.count("value").alias("__valued"),
        # Of gauges recorded at one time the largest counts, whatever the order of the rows.
        F.max_by("value", F.struct("__latest", "value")).alias("__last"),
    )
    kind = F.col("type")
    spread = kind.isin("timer", "histogram")
    shares = {"0.5": "__p50", "0.95": "__p95"}
    ranked = exact_percentiles(tagged.where(spread), by, "value", list(shares), sketch).groupBy(*[F.col(c).alias(f"__by_{c}") for c in by])
    ranked = ranked.agg(*[F.max(F.when(F.col("share") == q, F.col("percentile"))).alias(n) for q, n in shares.items()])
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"__by_{c}")) for c in by])
    return rolled.join(ranked, same, "left").select(
        "name",
        "type",
        *tags,
        "measurements",
        F.when(kind == "counter", F.col("__sum")).alias("total"),
        F.when(kind == "gauge", F.col("__last")).alias("latest"),
        F.when(spread, F.col("__sum") / F.nullif(F.col("__valued"), F.lit(0))).alias("average"),
        F.col("__p50").alias("p50"),
        F.col("__p95").alias("p95"),
    )


def job_stats(ledger: DataFrame) -> DataFrame:
    """(run_id, stage, records_in, records_out, records_rejected): what a job returns, as a table."""
    return ledger.select("run_id", "stage", "records_in", "records_out", "records_rejected")
