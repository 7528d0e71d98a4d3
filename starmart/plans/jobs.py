"""The jobs: raw files to bronze, bronze to the star, the star to marts and to a database."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce
from hashlib import sha1

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart import contracts
from starmart import fixed_values as fixed
from starmart.contracts import align, loses, losses
from starmart.functions.keys import ROW_ID
from starmart.functions.measures import exact_average
from starmart.operators import dims, gate
from starmart.operators.fact import TRIPS, build_fact
from starmart.operators.gate import Rule
from starmart.operators.lineage import FILE, month_of_path, plain_path, plain_path_of, split_month
from starmart.operators.star import TRIP_STAR, fk_orphans, look_up
from starmart.plans.ledger import RunLedger
from starmart.sources.lake import load, load_dimension, register_files, replace_files, replace_months, write_partitions
from starmart.sources.scan import (
    CORRUPT,
    as_text,
    clean_rows,
    corrupt_rows,
    exists,
    file_bytes,
    month_bytes,
    raw_files,
    read_as_text,
    read_bronze_source,
    read_csv,
    read_months,
    row_names,
)
from starmart.sources.snapshots import has_snapshot, read_snapshot


@dataclass(frozen=True)
class Lake:
    """Where each layer lies."""

    root: str

    @property
    def bronze_trips(self) -> str:
        return f"{self.root}/bronze/trips"

    @property
    def files(self) -> str:
        return f"{self.root}/bronze/files"

    @property
    def bronze_zones(self) -> str:
        return f"{self.root}/bronze/zones"

    @property
    def rejects(self) -> str:
        return f"{self.root}/silver/rejects"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold"

    @property
    def ledger(self) -> str:
        return f"{self.root}/ledger"

    def table(self, name: str) -> str:
        return f"{self.gold}/{name}"

    @property
    def marts(self) -> str:
        return f"{self.gold}/marts"

    def mart(self, name: str) -> str:
        return f"{self.marts}/mart={name}"

    @property
    def unfit(self) -> str:
        return f"{self.root}/bronze/unfit"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/bronze/quarantine"

    def layers(self) -> dict[str, str]:
        return {"trips": self.bronze_trips, "zones": self.bronze_zones}


def open_ledger(spark: SparkSession, lake: Lake, pipeline: str, run_id: str | None = None) -> RunLedger:
    return RunLedger(spark, lake.ledger, pipeline, run_id or datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S_%f"))


def ingest(
    spark: SparkSession,
    lake: Lake,
    trip_paths: Sequence[str],
    zones_csv: str | None,
    ledger: RunLedger,
    loaded_at: datetime | None = None,
) -> list[str]:
    """Land raw month files and the zone lookup in bronze; returns the months landed.

    Each file present is replaced; other files, of the same month too, stay with
    their rows and keys. All months are one job whose tasks write where they read:
    no shuffle. Rows of files without a month in their path, and zone lines that do not fit, are kept as text (see
    `quarantine`) and count as rejected. Rows with a value that does not fit its type are
    rejected, too, and kept as text (see `keep_unfit`).
    """
    now = F.lit(loaded_at or datetime.now(timezone.utc))
    if zones_csv is not None:
        with ledger.stage("bronze_zones") as stage:
            lines, seen = read_csv(spark, zones_csv, contracts.ZONES), Observation()
            told = lines.observe(seen, F.count(F.lit(1)).alias("lines"), F.count_if(F.col(CORRUPT).isNotNull()).alias("corrupt"))
            clean_rows(told).write.mode("overwrite").parquet(lake.bronze_zones)
            stage.records_in, corrupt = seen.get["lines"], seen.get["corrupt"]
            if corrupt or exists(spark, lake.quarantine):
                stage.records_rejected = quarantine(lake, as_text(corrupt_rows(lines)), lines.inputFiles(), UNFIT_LINE, now)
            stage.records_out = stage.records_in - corrupt
            stage.bytes_processed = file_bytes(spark, [zones_csv])
    dated = [p for p in trip_paths if month_of_path(p)]
    undated = [p for p in trip_paths if not month_of_path(p)]
    months = sorted({month_of_path(p) for p in dated})
    with ledger.stage("bronze_trips") as stage:
        if undated:
            rows = read_as_text(spark, undated)
            stage.records_rejected = quarantine(lake, rows, raw_files(spark, undated), UNDATED, now)
        if dated:
            numbered = register_files(spark, lake.files, raw_files(spark, dated))
            raw = with_losses(read_bronze_source(spark, dated, contracts.RAW_TRIPS, now, numbered, lost=LOST))
            seen, lost = Observation(), F.col(f"{LOST}_any")
            fitting = raw.observe(seen, F.count_if(lost).alias("lost")).where(~lost)
            written = replace_files(align(fitting, contracts.BRONZE_TRIPS, ROW_ID, FILE), lake.bronze_trips, numbered)
            stage.records_out = written_rows(written, months)
            stage.records_rejected += keep_unfit(spark, lake, raw, numbered, seen.get["lost"], ledger)
        stage.records_in = stage.records_out + stage.records_rejected
        stage.bytes_processed = file_bytes(spark, trip_paths)
    return months


# Why a row is in quarantine.
UNDATED, UNFIT_LINE = "no month in the file's path", "line does not fit"


def quarantine(lake: Lake, rows: DataFrame, files: Sequence[str], reason: str, loaded_at: Column) -> int:
    """Keep rows (file, row) that cannot be loaded, in place of those kept of these files; returns their number.

    Each file is a partition, named by a digest of its path. One that has no such rows any more is emptied, so of a
    file that was mended and loaded again nothing is left. `read_quarantine` reads them back.
    """
    spark, seen = rows.sparkSession, Observation()
    # Plain path and digest are worked out once per file; a row of a file that is not listed has its own worked out.
    named = {name: (plain_path(f), sha1(plain_path(f).encode()).hexdigest()) for f in files for name in row_names(f)}
    listing = spark.createDataFrame([(k, *v) for k, v in named.items()], "__at string, __plain string, __digest string")
    located = rows.join(F.broadcast(listing), F.col("file") == F.col("__at"), "left")
    path = plain_path_of(F.col("file"))
    kept = located.select(
        F.coalesce("__plain", path).alias("file"), "row", F.lit(reason).alias("reason"), loaded_at.alias("loaded_at"),
        F.coalesce("__digest", F.sha1(path)).alias("_input"),
    )
    watched = kept.observe(seen, F.collect_set("_input").alias("met"), F.count(F.lit(1)).alias("rows"))
    write_partitions(watched, lake.quarantine, ["_input"])
    result = seen.get
    for name in {sha1(plain_path(f).encode()).hexdigest() for f in files} - set(result["met"]):
        if exists(spark, f"{lake.quarantine}/_input={name}"):
            kept.limit(0).drop("_input").write.mode("overwrite").parquet(f"{lake.quarantine}/_input={name}")
    return result["rows"]


def read_quarantine(spark: SparkSession, lake: Lake, reason: str | None = None, schema: T.StructType | None = None) -> DataFrame:
    """Rows that could not be loaded: (file, row, reason, loaded_at), or, with a schema, the columns of `row` under it.

    Rows of undated files under the raw contract, written to a path that names their month, are ready to be ingested.
    """
    held = spark.read.parquet(lake.quarantine).drop("_input")
    chosen = held if reason is None else held.where(F.col("reason") == reason)
    return chosen if schema is None else chosen.select(F.from_json("row", schema).alias("row")).select("row.*")


LOST = "__lost"


def with_losses(raw: DataFrame) -> DataFrame:
    """`raw` with, in LOST, the columns whose present value fits neither the raw nor the bronze type, and such a row's text.

    Rows are told apart by the condition LOST_any: names and text are made where they are kept only.
    """
    text = F.to_json(F.struct(*contracts.RAW_TRIPS.fieldNames()), {"ignoreNullFields": "false"})
    every = F.array_distinct(F.concat(LOST, losses(raw, contracts.BRONZE_TRIPS)))
    some = F.col(f"{LOST}_any") | loses(raw, contracts.BRONZE_TRIPS)
    return raw.withColumns({f"{LOST}_row": F.coalesce(f"{LOST}_row", text), LOST: every, f"{LOST}_any": some})


def keep_unfit(spark: SparkSession, lake: Lake, raw: DataFrame, numbered: Sequence, lost: int, ledger: RunLedger) -> int:
    """Keep the rows that lost a value as text, with the columns that lost one, by month and file; returns their number.

    They are read a second time, only where the write saw any. Loading a file again replaces its rows here, too, so a
    mended file leaves none. Values lost are counted per column in the ledger's metrics.
    """
    if not lost and not exists(spark, lake.unfit):
        return 0
    kept = raw.where(f"{LOST}_any").select(
        F.col(LOST).alias("lost_columns"), F.col(f"{LOST}_row").alias("row"), "_source_file", "_source_month", "_ingestion_ts",
        ROW_ID, "_year", "_month", FILE,
    )
    replace_files(kept if lost else kept.limit(0), lake.unfit, numbered)
    if lost:
        own = read_months(spark, lake.unfit, sorted({month for month, _, _ in numbered}))
        # One row per column of the contract at most.
        counts = own.select(F.explode("lost_columns").alias("column")).groupBy("column").count().collect()
        ledger.record([("lost_values", r["count"], "gauge", {"column": r.column}) for r in counts])
    return lost


def write_rejects(bronze: DataFrame, lake: Lake, months: Sequence[str], rules: Sequence[Rule], ledger: RunLedger) -> dict:
    """Write the rejected rows of the months; returns what that one pass saw of all rows.

    Rows in and accepted, the date range of accepted rows and the rejects per rule
    are observed in the stage that scans and writes.
    """
    with ledger.stage("gate") as stage:
        stage.bytes_processed = month_bytes(bronze.sparkSession, lake.bronze_trips, months)
        seen, ok = Observation(), gate.passes(rules)
        day = F.when(ok, F.to_date(TRIPS.pickup))
        watched = bronze.observe(
            seen,
            F.count(F.lit(1)).alias("rows"),
            F.count_if(ok).alias("accepted"),
            F.min(day).alias("min_date"),
            F.max(day).alias("max_date"),
            *[F.count_if(r.fails).alias(f"rule {r.name}") for r in rules],
        )
        replace_months(gate.rejected(watched, rules), lake.rejects, months)
        result = seen.get
        stage.records_in, stage.records_out = result["rows"], result["accepted"]
        stage.records_rejected = stage.records_in - stage.records_out
    return result


def load_dimensions(spark: SparkSession, lake: Lake, seen: Mapping, ledger: RunLedger, how: str = "upsert") -> dict[str, int]:
    """Load every dimension; the calendar spans the accepted dates and a year either side.

    Upsert keeps members that earlier facts point to. Without accepted rows there
    is no calendar to add.
    """
    loaded = {}

    def load_one(name: str, df: DataFrame, key: str, way: str = how) -> None:
        loaded[name] = load_dimension(df, lake.table(name), [key], way)

    with ledger.stage("dimensions") as stage:
        load_one("dim_vendor", dims.vendors(spark), "vendor_key")
        load_one("dim_ratecode", dims.rate_codes(spark), "ratecode_key")
        load_one("dim_payment_type", dims.payment_types(spark), "payment_type_key")
        load_one("dim_time", dims.minute_of_day(spark), "time_key")
        load_one("dim_location", dims.locations(spark.read.parquet(lake.bronze_zones)), "location_key")
        load_one("dim_location", dims.unknown_locations(spark), "location_key", "insert")
        if seen["min_date"] is not None:
            bounds = spark.range(0, 1, 1, 1).select(
                F.lit(seen["min_date"]).alias("min_date"), F.lit(seen["max_date"]).alias("max_date")
            )
            load_one("dim_date", dims.calendar_over(dims.with_buffer_years(bounds)), "date_key")
        stage.records_out = sum(loaded.values())
    return loaded


def build_star(
    spark: SparkSession,
    lake: Lake,
    months: Sequence[str],
    ledger: RunLedger,
    rules: Sequence[Rule] | None = None,
    dimensions: str | None = "upsert",
) -> dict:
    """Gate the months, load dimensions, replace the months' facts, check foreign keys.

    Two passes over the months' trips: one writes rejects and takes all counts,
    one writes facts. Both are single stages without a shuffle. `dimensions` is
    upsert, overwrite, or None to leave them.
    """
    rules = rules or gate.trip_rules()
    bronze = read_months(spark, lake.bronze_trips, months).drop(FILE)
    seen = write_rejects(bronze, lake, months, rules, ledger)
    loaded = load_dimensions(spark, lake, seen, ledger, dimensions) if dimensions else {}
    with ledger.stage("fact") as stage:
        fact = build_fact(gate.accepted(bronze, rules), TRIPS, "_year", "_month")
        written = replace_months(fact, lake.table(TRIP_STAR.fact), months)
        stage.records_in = seen["accepted"]
        stage.bytes_processed = month_bytes(spark, lake.bronze_trips, months)
        stage.records_out = written_rows(written, months)
    orphans = {}
    if has_snapshot(spark, lake.table("dim_date")):
        with ledger.stage("foreign_keys") as stage:
            fact = read_months(spark, lake.table(TRIP_STAR.fact), months)
            tables = {name: read_snapshot(spark, lake.table(name)) for name in TRIP_STAR.dimensions}
            # One row per foreign key. A month without facts has none to report.
            orphans = {row.fk: row.orphan_rows for row in fk_orphans(fact, tables).collect()}
            ledger.record([("orphan_rows", rows, "gauge", {"fk": fk}) for fk, rows in orphans.items()])
            stage.records_in = stage.records_out = written_rows(written, months)
    return {
        "months_processed": len(months),
        "trips_read": seen["rows"],
        "trips_after_filter": seen["accepted"],
        "facts_written": written_rows(written, months),
        "dimensions_loaded": loaded,
        "orphan_rows": orphans,
    }


def written_rows(written: Mapping, months: Sequence[str]) -> int:
    return sum(written[m] for m in months)


# Marts kept up to date month by month: name and grouping.
MARTS = {
    "date_pickup": ["date_key", "pickup_location_key"],
    "date_dropoff": ["date_key", "dropoff_location_key"],
    "date_vendor": ["date_key", "vendor_key"],
    "route": ["pickup_location_key", "dropoff_location_key"],
    "payment": ["payment_type_key"],
    "pickup_time": ["pickup_time_key"],
    "high_value": ["date_key", "is_high_value"],
    "airport_pickup": ["date_key", "from_airport"],
    "airport_dropoff": ["date_key", "to_airport"],
}
# Marts over names of a dimension, summed when read: stored mart, its key, dimension, the dimension's key, names.
NAMED_MARTS = {
    "month": ("date_vendor", "date_key", "dim_date", "date_key", ["year", "month"]),
    "time_of_day": ("pickup_time", "pickup_time_key", "dim_time", "time_key", ["time_of_day", "is_rush_hour", "is_night"]),
    "borough": ("date_pickup", "pickup_location_key", "dim_location", "location_key", ["borough", "service_zone"]),
}
# Of a grouping by a flag, the trips that have it are read.
FLAGS = ["is_high_value", "from_airport", "to_airport"]


def mart_sums(fact: DataFrame) -> DataFrame:
    """Additive sums of every mart per file month, in one scan: (mart, _year, _month, all keys, sums).

    Each fact row is expanded to one per mart with that mart's keys only, and these combine before the one
    shuffle: it carries as many rows as the marts have, times tasks at most.
    """
    keys = list(dict.fromkeys(k for own in MARTS.values() for k in own))
    airports = list(fixed.AIRPORT_LOCATIONS)
    conditions = [F.col("total_amount") > fixed.HIGH_VALUE_TOTAL, *(F.col(f"{end}_location_key").isin(airports) for end in ("pickup", "dropoff"))]
    flagged = fact.withColumns({name: F.coalesce(c, F.lit(False)) for name, c in zip(FLAGS, conditions, strict=True)})
    months = ["_year", "_month"]
    sets = [[F.col(c) for c in (*months, *own)] for own in MARTS.values()]
    grouped = flagged.groupingSets(sets, *months, *keys).agg(
        F.grouping_id(*months, *keys).alias("__set"),
        F.count(F.lit(1)).alias("trips"),
        F.sum("total_amount").alias("revenue"),
        F.sum("trip_duration_minutes").alias("minutes"),
        F.count("trip_duration_minutes").alias("timed_trips"),
    )
    columns = [*months, *keys]
    numbers = {
        sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in (*months, *own)): name for name, own in MARTS.items()
    }
    name = F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair])[F.col("__set").cast("int")]
    return grouped.withColumn("mart", name).drop("__set")


def refresh_marts(spark: SparkSession, lake: Lake, months: Sequence[str], ledger: RunLedger) -> None:
    """Replace the months' share of every mart, in one scan of their facts and one write.

    A mart holds additive sums per file month, so a re-run touches its months only
    even where late trips give one date to two months. A mart that has no trips in a month is emptied there.
    """
    by = ("mart", "_year", "_month")
    with ledger.stage("marts") as stage:
        stage.bytes_processed = month_bytes(spark, lake.table(TRIP_STAR.fact), months)
        sums, seen = mart_sums(read_months(spark, lake.table(TRIP_STAR.fact), months)), Observation()
        rows = sums.hint("rebalance", *[F.col(c) for c in by])
        write_partitions(rows.observe(seen, F.collect_set(F.struct(*by)).alias("met"), F.count(F.lit(1)).alias("rows")), lake.marts, by)
        stage.records_out = seen.get["rows"]
        met = {tuple(r) for r in seen.get["met"]}
        empty = sums.limit(0).drop(*by)
        for name in MARTS:
            for year, month in map(split_month, months):
                if (name, year, month) not in met:
                    empty.write.mode("overwrite").parquet(f"{lake.mart(name)}/_year={year}/_month={month}")


def read_mart(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    """A mart over all months: trips, revenue and average duration per grouping."""
    if name in NAMED_MARTS:
        stored, column, table, key, by = NAMED_MARTS[name]
        held = spark.read.parquet(lake.mart(stored)).groupBy(column).agg(*[F.sum(c).alias(c) for c in SUMS])
        sums = look_up(held, read_snapshot(spark, lake.table(table)), column, key, attributes=by)
    else:
        by = [k for k in MARTS[name] if k not in FLAGS]
        sums = spark.read.parquet(lake.mart(name)).where(reduce(Column.__and__, [F.col(k) for k in MARTS[name] if k in FLAGS], F.lit(True)))
    return sums.groupBy(*by).agg(
        F.sum("trips").alias("trips"),
        F.sum("revenue").alias("revenue"),
        exact_average(F.sum("minutes"), F.sum("timed_trips")).alias("avg_duration_minutes"),
    )


SUMS = ["trips", "revenue", "minutes", "timed_trips"]


def publish(
    spark: SparkSession,
    lake: Lake,
    connection: Mapping[str, str],
    months: Sequence[str] | None = None,
    fact_mode: str = "overwrite",
) -> None:
    """Copy the star to a database: dimensions whole, facts whole or the given months appended.

    The database generates the fact's surrogate key. JDBC offers no replacement of
    a month, so a re-run of `append` would double it: prefer overwrite there.
    """
    for name in TRIP_STAR.dimensions:
        load(read_snapshot(spark, lake.table(name)), name, "jdbc", "overwrite", connection=connection)
    fact = read_months(spark, lake.table(TRIP_STAR.fact), months).drop("_year", "_month")
    load(fact, TRIP_STAR.fact, "jdbc", fact_mode, connection=connection, drop_key=TRIP_STAR.fact_key)


def run(
    spark: SparkSession,
    lake: Lake,
    trip_paths: Sequence[str],
    zones_csv: str | None,
    rules: Sequence[Rule] | None = None,
    run_id: str | None = None,
    loaded_at: datetime | None = None,
    dimensions: str | None = "upsert",
) -> dict:
    """Files to star to marts. Running it again for the same files leaves the same tables."""
    ledger = open_ledger(spark, lake, "full", run_id)
    months = ingest(spark, lake, trip_paths, zones_csv, ledger, loaded_at)
    if not months:
        return {"months_processed": 0, "run_id": ledger.run_id}
    result = build_star(spark, lake, months, ledger, rules, dimensions)
    refresh_marts(spark, lake, months, ledger)
    return {**result, "run_id": ledger.run_id}
