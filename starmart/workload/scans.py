"""Queries over scans, lineage, contracts and projections."""

from pyspark.sql import functions as F

from starmart import contracts
from starmart.contracts import align, contract, contract_report
from starmart.operators.fact import TRIPS, code_columns, measure_columns
from starmart.operators.lineage import add_lineage
from starmart.sources.lake import MONTH, scratch_folder, write_by_date, write_partitions
from starmart.sources.scan import in_months, read_months, read_raw, row_counts, scan
from starmart.workload.registry import LINE_TRIPS, query
from starmart.workload.testbed import LOADED_AT, line_trips, table

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
MONTHS = ["1995-03", "1996-12", "1999-07"]


def order_months(spark, sf_dir):
    """Orders with lineage columns; their month stands for a month file's."""
    orders = table(spark, sf_dir, "orders").withColumn("__file", F.col("_metadata.file_name"))
    month = F.date_format("o_orderdate", "yyyy-MM")
    return add_lineage(orders, F.col("__file"), month, F.expr(f"TIMESTAMP '{LOADED_AT}'")).drop("__file")


@query(
    "scan_project_filter",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice FROM lineitem
       WHERE l_quantity >= 45 AND l_returnflag = 'R'""",
)
def scan_project_filter(spark, sf_dir):
    columns = ["l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice"]
    return scan(table(spark, sf_dir, "lineitem"), columns, "l_quantity >= 45 AND l_returnflag = 'R'")


@query(
    "month_filter",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS _year, CAST(month(o_orderdate) AS INTEGER) AS _month
       FROM orders WHERE strftime(o_orderdate, '%Y-%m') IN ('1995-03', '1996-12', '1999-07')""",
)
def month_filter(spark, sf_dir):
    return scan(order_months(spark, sf_dir), ["o_orderkey", *MONTH], in_months(MONTHS))


@query(
    "bronze_metadata",
    """SELECT o_orderkey, 'orders.parquet' AS _source_file, strftime(o_orderdate, '%Y-%m') AS _source_month,
         '2024-01-01 00:00:00' AS _ingestion_ts, CAST(year(o_orderdate) AS INTEGER) AS _year,
         CAST(month(o_orderdate) AS INTEGER) AS _month
       FROM orders""",
)
def bronze_metadata(spark, sf_dir):
    lineage = ["_source_file", "_source_month", "_ingestion_ts", *MONTH]
    return order_months(spark, sf_dir).select("o_orderkey", *lineage)


CODES = ["VendorID", "passenger_count", "PULocationID", "DOLocationID", "RatecodeID", "payment_type"]


@query(
    "narrow_types",
    f"""WITH {LINE_TRIPS}
        SELECT {", ".join(f"CAST({c} AS INTEGER) AS {c}" for c in CODES)} FROM line_trips""",
)
def narrow_types(spark, sf_dir):
    declared = contract(", ".join(f"{c} INT" for c in CODES))
    return align(line_trips(spark, sf_dir, CODES), declared)


@query(
    "default_codes",
    f"""WITH {LINE_TRIPS}
        SELECT CAST(coalesce(VendorID, 1) AS INTEGER) AS vendor_key,
          CAST(coalesce(RatecodeID, 1) AS INTEGER) AS ratecode_key,
          CAST(coalesce(payment_type, 5) AS INTEGER) AS payment_type_key
        FROM line_trips""",
)
def default_codes(spark, sf_dir):
    trips = line_trips(spark, sf_dir, ["VendorID", "RatecodeID", "payment_type"])
    return trips.select(*code_columns(trips).values())


@query(
    "default_measures",
    f"""WITH {LINE_TRIPS}
        SELECT CAST(coalesce(congestion_surcharge, 0) AS DOUBLE) AS congestion_surcharge,
          CAST(0 AS DOUBLE) AS airport_fee
        FROM line_trips""",
)
def default_measures(spark, sf_dir):
    # An older file: it has no airport fee at all.
    older = align(line_trips(spark, sf_dir, ["congestion_surcharge"]), contracts.RAW_TRIPS)
    measures = measure_columns(older)
    return older.select(measures["congestion_surcharge"], measures["airport_fee"])


@query(
    "measure_casts",
    f"""WITH {LINE_TRIPS}
        SELECT CAST(passenger_count AS SMALLINT) AS passenger_count,
          CAST(CAST(trip_distance AS DECIMAL(10,2)) AS DOUBLE) AS trip_distance_miles,
          CAST(CAST(fare_amount AS DECIMAL(10,2)) AS DOUBLE) AS fare_amount,
          CAST(CAST(extra AS DECIMAL(10,2)) AS DOUBLE) AS extra_amount,
          CAST(CAST(mta_tax AS DECIMAL(10,2)) AS DOUBLE) AS mta_tax,
          CAST(CAST(tip_amount AS DECIMAL(10,2)) AS DOUBLE) AS tip_amount,
          CAST(CAST(tolls_amount AS DECIMAL(10,2)) AS DOUBLE) AS tolls_amount,
          CAST(CAST(improvement_surcharge AS DECIMAL(10,2)) AS DOUBLE) AS improvement_surcharge,
          CAST(coalesce(congestion_surcharge, 0) AS DOUBLE) AS congestion_surcharge,
          CAST(coalesce(Airport_fee, 0) AS DOUBLE) AS airport_fee,
          CAST(CAST(total_amount AS DECIMAL(10,2)) AS DOUBLE) AS total_amount
        FROM line_trips""",
)
def measure_casts(spark, sf_dir):
    sources = [source for source, _ in TRIPS.measures.values()]
    trips = line_trips(spark, sf_dir, [*TRIPS.counts.values(), *sources])
    return trips.select(*measure_columns(trips).values())


# A contract the order lines meet only in part: types that need a cast, two of them too
# narrow for some values, and a column they lack. Lines have columns it does not name.
LINE_CONTRACT = """
    l_orderkey BIGINT, l_partkey INT, l_suppkey TINYINT, l_linenumber INT, l_quantity DOUBLE,
    l_extendedprice SMALLINT, l_discount DECIMAL(4,2), l_comment STRING
"""


@query(
    "contract_report",
    """
    WITH c AS (
      SELECT count(l_orderkey) AS n1, count(l_partkey) AS n2, count(l_suppkey) AS n3, count(l_linenumber) AS n4,
        count(l_quantity) AS n5, count(l_extendedprice) AS n6, count(l_discount) AS n7, count(l_tax) AS n8,
        count(l_returnflag) AS n9, count(l_linestatus) AS n10, count(l_shipdate) AS n11,
        count(*) FILTER (WHERE l_partkey > 2147483647) AS x2,
        count(*) FILTER (WHERE l_suppkey > 127) AS x3,
        count(*) FILTER (WHERE floor(l_extendedprice) > 32767) AS x6
      FROM lineitem
    )
    SELECT 'l_orderkey' AS "column", 'bigint' AS expected, 'bigint' AS actual, 'ok' AS status,
      n1 AS present_values, CAST(0 AS BIGINT) AS lost_values FROM c
    UNION ALL SELECT 'l_partkey', 'int', 'bigint', 'cast', n2, x2 FROM c
    UNION ALL SELECT 'l_suppkey', 'tinyint', 'bigint', 'cast', n3, x3 FROM c
    UNION ALL SELECT 'l_linenumber', 'int', 'int', 'ok', n4, 0 FROM c
    UNION ALL SELECT 'l_quantity', 'double', 'double', 'ok', n5, 0 FROM c
    UNION ALL SELECT 'l_extendedprice', 'smallint', 'double', 'cast', n6, x6 FROM c
    UNION ALL SELECT 'l_discount', 'decimal(4,2)', 'double', 'cast', n7, 0 FROM c
    UNION ALL SELECT 'l_comment', 'string', NULL, 'missing', 0, 0 FROM c
    UNION ALL SELECT 'l_tax', NULL, 'double', 'unexpected', n8, 0 FROM c
    UNION ALL SELECT 'l_returnflag', NULL, 'string', 'unexpected', n9, 0 FROM c
    UNION ALL SELECT 'l_linestatus', NULL, 'string', 'unexpected', n10, 0 FROM c
    UNION ALL SELECT 'l_shipdate', NULL, 'timestamp_ntz', 'unexpected', n11, 0 FROM c
    """,
)
def line_contract(spark, sf_dir):
    return contract_report(table(spark, sf_dir, "lineitem"), contract(LINE_CONTRACT))


@query(
    "union_all",
    """SELECT 'customer' AS kind, c_custkey AS party_key, c_name AS name, c_nationkey AS nation, c_acctbal AS balance
       FROM customer
       UNION ALL SELECT 'supplier', s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier""",
)
def union_all(spark, sf_dir):
    def parties(kind, p, key):
        return table(spark, sf_dir, kind).select(
            F.lit(kind).alias("kind"),
            F.col(key).alias("party_key"),
            F.col(f"{p}_name").alias("name"),
            F.col(f"{p}_nationkey").alias("nation"),
            F.col(f"{p}_acctbal").alias("balance"),
        )

    return parties("customer", "c", "c_custkey").unionByName(parties("supplier", "s", "s_suppkey"))


@query(
    "sample_rows",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5""",
)
def sample_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(5)


@query(
    "distinct_partitions",
    """SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS _year, CAST(month(o_orderdate) AS INTEGER) AS _month
       FROM orders""",
)
def distinct_partitions(spark, sf_dir):
    return order_months(spark, sf_dir).select(*MONTH).distinct()


@query(
    "table_row_counts",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM {t}" for t in TABLES)
    + " UNION ALL SELECT 'no_such_table', NULL",
)
def table_row_counts(spark, sf_dir):
    return row_counts(spark, {**{t: table(spark, sf_dir, t) for t in TABLES}, "no_such_table": f"{sf_dir}/no_such_table.parquet"})


@query(
    "idempotent_reload",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS _year, CAST(month(o_orderdate) AS INTEGER) AS _month,
         CAST(count(*) AS BIGINT) AS orders, CAST(count(DISTINCT o_orderkey) AS BIGINT) AS distinct_orders
       FROM orders GROUP BY 1, 2""",
)
def idempotent_reload(spark, sf_dir):
    """Load every month, load some of them again: each row is there once."""
    folder = scratch_folder(spark, "reload")
    orders = order_months(spark, sf_dir).select("o_orderkey", *MONTH)
    write_partitions(orders, folder, MONTH, rebalance=True)
    write_partitions(orders.filter(in_months(MONTHS)), folder, MONTH, rebalance=True)
    loaded = read_months(spark, folder)
    return loaded.groupBy(*MONTH).agg(
        F.count(F.lit(1)).alias("orders"), F.countDistinct("o_orderkey").alias("distinct_orders")
    )


@query(
    "months_pruned",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS _year, CAST(month(o_orderdate) AS INTEGER) AS _month
       FROM orders WHERE strftime(o_orderdate, '%Y-%m') IN ('1995-03', '1996-12', '1999-07')""",
)
def months_pruned(spark, sf_dir):
    """The listed months of a lake table: other months' folders are not read."""
    folder = scratch_folder(spark, "months")
    write_partitions(order_months(spark, sf_dir).select("o_orderkey", *MONTH), folder, MONTH, rebalance=True)
    return read_months(spark, folder, MONTHS)


@query(
    "write_by_date",
    """SELECT strftime(CAST(ts AS TIMESTAMP), '%Y-%m-%d') AS event_date, CAST(count(*) AS BIGINT) AS events,
         CAST(count(DISTINCT event_id) AS BIGINT) AS distinct_events
       FROM events GROUP BY 1""",
)
def dated_events(spark, sf_dir):
    """Events written by date, one event type a second time: each date holds what was last written for it."""
    folder = scratch_folder(spark, "dates")
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    write_by_date(events, folder, "ts", "event_date")
    write_by_date(events, folder, "ts", "event_date")
    by_date = spark.read.parquet(folder).groupBy("event_date")
    return by_date.agg(F.count(F.lit(1)).alias("events"), F.countDistinct("event_id").alias("distinct_events"))


MIXED = """
  SELECT count(VendorID) AS vendors, count(RatecodeID) AS rate_codes, CAST(sum(VendorID) AS BIGINT) AS vendor_sum,
    count(CASE WHEN _month % 2 = 1 THEN Airport_fee END) AS airport_fees, CAST(count(*) AS BIGINT) AS trips
  FROM line_trips"""


@query("raw_mixed_schemas", f"WITH {LINE_TRIPS} SELECT 'wide first' AS told_by, * FROM ({MIXED}) UNION ALL SELECT 'narrow first', * FROM ({MIXED})")
def raw_mixed_schemas(spark, sf_dir):
    """One folder whose files differ in integer width and in having a column, in both orders: no value is lost."""
    trips = line_trips(spark, sf_dir, [*contracts.RAW_TRIPS.fieldNames(), "_month"])
    odd = F.col("_month") % 2 == 1
    codes = ["VendorID", "RatecodeID"]
    wide = trips.filter(odd).withColumns({c: F.col(c).cast("long") for c in codes}).drop("_month")
    narrow = trips.filter(~odd).withColumns({c: F.col(c).cast("int") for c in codes}).drop("_month", "Airport_fee")
    told = []
    for name, order in (("wide first", (wide, narrow)), ("narrow first", (narrow, wide))):
        folder = scratch_folder(spark, "mixed")
        for number, part in enumerate(order):
            part.write.parquet(f"{folder}/2024-01/part={number}")
        rows = read_raw(spark, [f"{folder}/2024-01"], contracts.RAW_TRIPS)
        told.append(
            rows.agg(
                F.count("VendorID").alias("vendors"),
                F.count("RatecodeID").alias("rate_codes"),
                F.sum("VendorID").alias("vendor_sum"),
                F.count("Airport_fee").alias("airport_fees"),
                F.count(F.lit(1)).alias("trips"),
            ).select(F.lit(name).alias("told_by"), "*")
        )
    return told[0].unionByName(told[1])
