"""Queries that run the jobs themselves, on month files derived from the given tables."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart import contracts
from starmart import fixed_values as fixed
from starmart.plans.jobs import FLAGS, MARTS, UNDATED, UNFIT_LINE, Lake, read_mart, read_quarantine, run
from starmart.plans.ledger import job_stats
from starmart.sources.lake import load_dimension, scratch_folder, sized_shuffles, write_partitions
from starmart.sources.scan import file_bytes, layer_health
from starmart.sources.snapshots import read_snapshot, read_snapshot_before
from starmart.workload.registry import LINE_CHECKS, LINE_FACT, query
from starmart.workload.testbed import LOADED_AT, line_rules, line_trips, table, zones

# Files loaded a second time, which must change nothing.
AGAIN = ["1995-01", "1999-01"]


def even_shuffles(spark, sf_dir):
    """Order lines meet their orders in partitions whose number follows from the size of the lines."""
    return sized_shuffles(spark, file_bytes(spark, [f"{sf_dir}/lineitem.parquet"]))


def month_files(spark, sf_dir, folder):
    """Order-line trips as one folder of raw files a year, dated its January; returns folders by month.

    Most trips thus lie outside their file's month and must stay with their file. Each task writes the years it meets:
    the lines move once, to their orders.
    """
    columns = [*contracts.RAW_TRIPS.fieldNames(), "_year"]
    month = F.format_string("%04d-01", "_year")
    trips = line_trips(spark, sf_dir, columns).withColumn("trip_month", month).drop("_year")
    with even_shuffles(spark, sf_dir):
        write_partitions(trips, f"{folder}/raw", ["trip_month"])
    months = [r.trip_month for r in spark.read.parquet(f"{folder}/raw").select("trip_month").distinct().collect()]
    return {m: f"{folder}/raw/trip_month={m}" for m in sorted(months)}


def loaded_lake(spark, sf_dir):
    """A lake after a full run and a second run of two of the files."""
    folder = scratch_folder(spark, "run")
    paths = month_files(spark, sf_dir, folder)
    zones(spark, sf_dir).write.option("header", True).csv(f"{folder}/zones")
    lake = Lake(f"{folder}/lake")
    run(spark, lake, list(paths.values()), f"{folder}/zones", line_rules(), "first", LOADED_AT)
    again = [paths[m] for m in AGAIN if m in paths]
    run(spark, lake, again, None, line_rules(), "second", LOADED_AT, dimensions=None)
    return lake


@query(
    "full_run",
    f"""WITH {LINE_FACT},
        a AS (
          SELECT CAST(date_key // 10000 AS INTEGER) AS file_year, count(*) AS trips,
            CAST(sum(total_amount) AS DOUBLE) AS revenue
          FROM fact GROUP BY 1
        )
        SELECT 'facts' AS told_by, file_year, trips, trips AS distinct_keys, revenue FROM a
        UNION ALL SELECT 'mart', file_year, trips, trips, revenue FROM a""",
)
def full_run(spark, sf_dir):
    """Raw files to facts and marts: every accepted trip is there once, under a key of its own."""
    lake = loaded_lake(spark, sf_dir)
    year = F.col("_year").alias("file_year")
    facts = spark.read.parquet(lake.table("fact_trips")).groupBy(year).agg(
        F.count(F.lit(1)).alias("trips"),
        F.countDistinct("trip_key").alias("distinct_keys"),
        F.sum("total_amount").alias("revenue"),
    )
    shares = spark.read.parquet(lake.mart("date_vendor")).groupBy(year).agg(
        F.sum("trips").alias("trips"), F.sum("trips").alias("distinct_keys"), F.sum("revenue").alias("revenue")
    )
    told = [df.select(F.lit(name).alias("told_by"), "*") for name, df in (("facts", facts), ("mart", shares))]
    return told[0].unionByName(told[1])


@query(
    "layer_health",
    """SELECT * FROM (VALUES ('trips', true, true), ('zones', true, true), ('weather', false, false))
         AS t(layer, present, has_files)""",
)
def lake_health(spark, sf_dir):
    """The layers of a lake after a run, and one that no job writes."""
    lake = loaded_lake(spark, sf_dir)
    layers = layer_health(spark, {**lake.layers(), "weather": f"{lake.root}/bronze/weather"})
    return layers.select("layer", "present", (F.col("files") > 0).alias("has_files"))


@query(
    "job_stats",
    f"""WITH {LINE_CHECKS}
        SELECT 'gate' AS stage, CAST(count(*) AS BIGINT) AS records_in, CAST(count_if(ok) AS BIGINT) AS records_out,
          CAST(count_if(NOT ok) AS BIGINT) AS records_rejected
        FROM gated
        UNION ALL SELECT 'fact', CAST(count_if(ok) AS BIGINT), CAST(count_if(ok) AS BIGINT), 0 FROM gated""",
)
def first_run_stats(spark, sf_dir):
    """What the first full run's gate and fact stages took in, wrote and rejected."""
    lake = loaded_lake(spark, sf_dir)
    stats = job_stats(spark.read.parquet(f"{lake.ledger}/stages")).filter("run_id = 'first' AND stage IN ('gate', 'fact')")
    return stats.drop("run_id")


@query(
    "partial_month_reload",
    f"""WITH {LINE_FACT}
        SELECT CAST(count(*) AS BIGINT) AS facts, CAST(count(*) AS BIGINT) AS distinct_keys,
          CAST(count(*) AS BIGINT) AS kept_keys, CAST(sum(total_amount) AS DOUBLE) AS revenue
        FROM fact""",
)
def partial_month_reload(spark, sf_dir):
    """Two folders of files of one month, then one of them again: all facts stay, under the keys they had."""
    folder = scratch_folder(spark, "partial")
    lake, paths = Lake(f"{folder}/lake"), []
    trips = line_trips(spark, sf_dir, contracts.RAW_TRIPS.fieldNames())
    for number, part in enumerate((trips.filter("passenger_count <= 2"), trips.filter("passenger_count > 2"))):
        paths.append(f"{folder}/raw/{number}_2024-05")
        with even_shuffles(spark, sf_dir):
            part.write.parquet(paths[-1])
    zones(spark, sf_dir).write.option("header", True).csv(f"{folder}/zones")
    run(spark, lake, paths, f"{folder}/zones", line_rules(), "first", LOADED_AT)
    facts = lake.table("fact_trips")
    spark.read.parquet(facts).select(F.col("trip_key").alias("first_key")).write.parquet(f"{folder}/first")
    run(spark, lake, paths[1:], None, line_rules(), "second", LOADED_AT, dimensions=None)
    now, before = spark.read.parquet(facts), spark.read.parquet(f"{folder}/first")
    return now.join(before, F.col("trip_key") == F.col("first_key"), "left").agg(
        F.count(F.lit(1)).alias("facts"),
        F.countDistinct("trip_key").alias("distinct_keys"),
        F.count("first_key").alias("kept_keys"),
        F.sum("total_amount").alias("revenue"),
    )


AIRPORTS = ", ".join(map(str, fixed.AIRPORT_LOCATIONS))
# Fixed condition of a mart in the oracle, where it has one.
MART_CONDITIONS = {
    "high_value": f"total_amount > {fixed.HIGH_VALUE_TOTAL}",
    "airport_pickup": f"pickup_location_key IN ({AIRPORTS})",
    "airport_dropoff": f"dropoff_location_key IN ({AIRPORTS})",
}


def mart_sql(name: str) -> str:
    keys = [k for k in MARTS[name] if k not in FLAGS]
    first, second = [f"CAST({k} AS BIGINT)" for k in keys] + ["CAST(NULL AS BIGINT)"] * (2 - len(keys))
    return f"""SELECT '{name}' AS mart, {first} AS first_key, {second} AS second_key, count(*) AS trips,
      CAST(sum(total_amount) AS DOUBLE) AS revenue FROM fact WHERE {MART_CONDITIONS.get(name, "true")} GROUP BY ALL"""


MONTH_SQL = """SELECT 'month' AS mart, CAST(date_key // 10000 AS BIGINT) AS first_key, CAST(date_key // 100 % 100 AS BIGINT) AS second_key,
  count(*) AS trips, CAST(sum(total_amount) AS DOUBLE) AS revenue FROM fact GROUP BY ALL"""


@query("mart_refresh", f"WITH {LINE_FACT} " + " UNION ALL ".join([*map(mart_sql, MARTS), MONTH_SQL]))
def mart_refresh(spark, sf_dir):
    """Every stored mart, and the months summed from one, after two files were loaded a second time."""
    lake = loaded_lake(spark, sf_dir)

    def told(name, keys):
        first, second = [F.col(k).cast("long") for k in keys] + [F.lit(None).cast("long")] * (2 - len(keys))
        return read_mart(spark, lake, name).select(
            F.lit(name).alias("mart"), first.alias("first_key"), second.alias("second_key"), "trips", "revenue"
        )

    stored = [told(name, [k for k in keys if k not in FLAGS]) for name, keys in MARTS.items()]
    return reduce(DataFrame.unionAll, [*stored, told("month", ["year", "month"])])


@query(
    "lost_at_ingest",
    f"""WITH {LINE_FACT}, lines AS (SELECT l_linenumber FROM lineitem)
        SELECT 'facts' AS told_by, CAST(count(*) AS BIGINT) AS rows, CAST(count_if(vendor_key = 1) AS BIGINT) AS of_vendor_one
        FROM fact WHERE passenger_count < 6
        UNION ALL SELECT 'VendorID', CAST(count(*) AS BIGINT), 0 FROM lines WHERE l_linenumber = 7
        UNION ALL SELECT 'passenger_count', CAST(count(*) AS BIGINT), 0 FROM lines WHERE l_linenumber = 6""",
)
def lost_at_ingest(spark, sf_dir):
    """Vendors and passenger counts out of range: such lines are kept aside by column and give no fact."""
    folder = scratch_folder(spark, "lost")
    lake, path = Lake(f"{folder}/lake"), f"{folder}/raw/trips_2024-05"
    line = F.col("passenger_count")
    far = {"VendorID": F.when(line == 7, 3_000_000_000).otherwise(F.col("VendorID")), "passenger_count": F.when(line == 6, 1 << 40).otherwise(line)}
    with even_shuffles(spark, sf_dir):
        line_trips(spark, sf_dir, contracts.RAW_TRIPS.fieldNames()).withColumns(far).write.parquet(path)
    zones(spark, sf_dir).write.option("header", True).csv(f"{folder}/zones")
    run(spark, lake, [path], f"{folder}/zones", line_rules(), "first", LOADED_AT)
    count = F.count(F.lit(1)).alias("rows")
    facts = spark.read.parquet(lake.table("fact_trips")).agg(count, F.count_if(F.col("vendor_key") == 1).alias("of_vendor_one"))
    columns = spark.read.parquet(lake.unfit).select(F.explode("lost_columns").alias("told_by"))
    lost = columns.groupBy("told_by").agg(count, F.lit(0).cast("long").alias("of_vendor_one"))
    return facts.select(F.lit("facts").alias("told_by"), "*").unionByName(lost)


@query(
    "quarantined",
    f"""SELECT 'held' AS told_by, '{UNDATED.replace("'", "''")}' AS reason, CAST(count(*) AS BIGINT) AS rows,
          CAST(count(DISTINCT s_nationkey) AS BIGINT) AS places
        FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE l_linenumber > 4
        UNION ALL SELECT 'held', '{UNFIT_LINE}', CAST(count(*) AS BIGINT), 0 FROM nation WHERE n_regionkey = 1
        UNION ALL SELECT 'ledger', 'bronze_trips', CAST(count(*) AS BIGINT), 0 FROM lineitem WHERE l_linenumber > 4
        UNION ALL SELECT 'ledger', 'bronze_zones', CAST(count(*) AS BIGINT), 0 FROM nation WHERE n_regionkey = 1""",
)
def quarantined(spark, sf_dir):
    """Files without a month and zone lines that do not fit: every row is held as text, as many as the ledger says."""
    folder = scratch_folder(spark, "held")
    lake, paths = Lake(f"{folder}/lake"), [f"{folder}/raw/trips_2024-05", f"{folder}/raw/trips"]
    line = F.col("passenger_count")
    trips = line_trips(spark, sf_dir, contracts.RAW_TRIPS.fieldNames())
    with even_shuffles(spark, sf_dir):
        for path, part in zip(paths, (trips.where(line <= 4), trips.where(line > 4)), strict=True):
            part.write.parquet(path)
    america = F.when(F.col("Borough") == "AMERICA", F.concat(F.lit("zone "), "LocationID")).otherwise(F.col("LocationID").cast("string"))
    zones(spark, sf_dir).withColumn("LocationID", america).write.option("header", True).csv(f"{folder}/zones")
    run(spark, lake, paths, f"{folder}/zones", line_rules(), "first", LOADED_AT)
    none, count = F.lit(0).cast("long"), F.count(F.lit(1)).alias("rows")
    place = F.from_json("row", contracts.RAW_TRIPS)["PULocationID"]
    held = read_quarantine(spark, lake).groupBy("reason").agg(count, F.countDistinct(place).alias("places"))
    told = spark.read.parquet(f"{lake.ledger}/stages").where("stage IN ('bronze_trips', 'bronze_zones')")
    ledger = told.select(F.lit("ledger").alias("told_by"), F.col("stage").alias("reason"), F.col("records_rejected").alias("rows"), none.alias("places"))
    return held.select(F.lit("held").alias("told_by"), "*").unionByName(ledger)


@query(
    "bytes_read",
    """SELECT * FROM (VALUES ('bronze_trips', true), ('gate', true), ('fact', true), ('marts', true)) AS t(stage, as_scanned)""",
)
def bytes_read(spark, sf_dir):
    """The ledger's bytes of each stage against the sizes of the files that a scan of its input meets."""
    lake = loaded_lake(spark, sf_dir)
    raw = f"{lake.root}/../raw"
    inputs = {"bronze_trips": raw, "gate": lake.bronze_trips, "fact": lake.bronze_trips, "marts": lake.table("fact_trips")}

    def met(stage, path):
        files = spark.read.parquet(path).select("_metadata.file_path", "_metadata.file_size").distinct()
        return files.agg(F.sum("file_size").alias("bytes")).select(F.lit(stage).alias("stage"), "bytes")

    scanned = reduce(DataFrame.unionAll, [met(stage, path) for stage, path in inputs.items()])
    told = spark.read.parquet(f"{lake.ledger}/stages").where("run_id = 'first'").select("stage", "bytes_processed")
    return told.join(scanned, "stage").select("stage", (F.col("bytes") == F.col("bytes_processed")).alias("as_scanned"))


@query(
    "dimension_load",
    """WITH s AS (SELECT l_partkey + 500 AS k, max(l_extendedprice) AS price FROM lineitem GROUP BY 1)
       SELECT 'now' AS told_by, coalesce(p_partkey, k) AS part_key,
         CASE WHEN p_partkey IS NULL THEN 'new' ELSE p_name END AS name, coalesce(price, p_retailprice) AS price
       FROM part FULL JOIN s ON p_partkey = k
       UNION ALL SELECT 'before', p_partkey, p_name, p_retailprice FROM part""",
)
def dimension_load(spark, sf_dir):
    """Parts as a dimension, loaded and then merged with new prices: the table now, and as it was before."""
    path = f"{scratch_folder(spark, 'dimension')}/dim_part"
    parts = table(spark, sf_dir, "part").selectExpr("p_partkey AS part_key", "p_name AS name", "p_retailprice AS price")
    sold = table(spark, sf_dir, "lineitem").groupBy((F.col("l_partkey") + 500).alias("part_key")).agg(F.max("l_extendedprice").alias("price"))
    load_dimension(parts, path, ["part_key"])
    load_dimension(sold.withColumn("name", F.lit("new")), path, ["part_key"], update=["price"])
    now, before = read_snapshot(spark, path), read_snapshot_before(spark, path)
    return now.select(F.lit("now").alias("told_by"), "*").unionByName(before.select(F.lit("before").alias("told_by"), "*"))
