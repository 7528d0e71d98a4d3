"""The jobs end to end on raw month files that disagree in their types."""

import json
import os
from datetime import datetime

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from starmart import contracts
from starmart.plans import jobs
from starmart.plans.jobs import Lake, open_ledger, read_mart, run
from starmart.sources import scan
from starmart.sources.scan import read_months
from starmart.workload import running
from tests.conftest import INVALID, TRIPS, ZONES


def month_file(folder, name, rows, drop=(), **types):
    names = contracts.RAW_TRIPS.fieldNames()
    frame = pd.DataFrame(rows, columns=names).drop(columns=list(drop))
    table = pa.Table.from_pandas(frame, preserve_index=False)
    for column, kind in types.items():
        i = table.schema.get_field_index(column)
        table = table.set_column(i, column, table[column].cast(kind))
    path = f"{folder}/{name}"
    pq.write_table(table, path, coerce_timestamps="us")
    return path


def shifted(rows, month):
    return [(r[0], r[1].replace(month=month), r[2].replace(month=month), *r[3:]) for r in rows]


@pytest.fixture
def raw(spark, folder):
    january = month_file(folder, "trips_2023-01.parquet", [*TRIPS, *INVALID])
    february = month_file(
        folder, "trips_2023-02.parquet", shifted(TRIPS, 2), drop=["Airport_fee"],
        VendorID=pa.int32(), passenger_count=pa.float64(), fare_amount=pa.float32(),
    )
    zones = f"{folder}/zones.csv"
    pd.DataFrame(ZONES, columns=contracts.ZONES.fieldNames()).to_csv(zones, index=False)
    return [january, february], zones


LOADED = datetime(2024, 5, 1)


def facts(spark, lake):
    table = spark.read.parquet(lake.table("fact_trips"))
    return sorted(tuple(r) for r in table.select("trip_key", "date_key", "total_amount", "_source_file", "_month").collect())


def test_files_to_star_and_back_again(spark, folder, raw):
    paths, zones = raw
    lake = Lake(f"{folder}/lake")
    result = run(spark, lake, paths, zones, run_id="one", loaded_at=LOADED)
    assert (result["months_processed"], result["trips_read"], result["trips_after_filter"], result["facts_written"]) == (2, 12, 11, 11)
    assert result["dimensions_loaded"]["dim_location"] == 7  # six zones and one placeholder: 265 is taken
    assert result["dimensions_loaded"]["dim_date"] == 3652  # 2022 to 2031: the future trip passes the gate
    assert all(rows == 0 for rows in result["orphan_rows"].values())
    first = facts(spark, lake)
    assert len({key for key, *_ in first}) == 11

    bronze = spark.read.parquet(lake.bronze_trips)
    assert set(bronze.columns) == {*contracts.BRONZE_TRIPS.fieldNames(), "_row_id", "_file"}
    assert bronze.filter("_month = 2 AND Airport_fee IS NULL").count() == 5

    (reject,) = spark.read.parquet(lake.rejects).collect()
    assert reject.failed_rules == ["fare_amount_at_least_0", "total_amount_at_least_0"]

    again = run(spark, lake, paths, zones, run_id="two", loaded_at=LOADED)
    assert {k: v for k, v in again.items() if k != "run_id"} == {k: v for k, v in result.items() if k != "run_id"}
    assert facts(spark, lake) == first


def test_reloading_one_month_leaves_the_other(spark, folder, raw):
    paths, zones = raw
    lake = Lake(f"{folder}/lake")
    run(spark, lake, paths, zones, loaded_at=LOADED)
    before = facts(spark, lake)
    other = Lake(f"{folder}/other")
    run(spark, other, paths[1:], zones, loaded_at=LOADED)
    run(spark, other, paths[:1], zones, loaded_at=LOADED)
    run(spark, other, paths[1:], zones, loaded_at=LOADED)
    assert facts(spark, other) == before  # the same keys in whatever order months come


def test_a_month_whose_rows_all_fail_ends_up_empty(spark, folder, raw):
    paths, zones = raw
    lake = Lake(f"{folder}/lake")
    run(spark, lake, paths, zones, loaded_at=LOADED)
    month_file(folder, "trips_2023-01.parquet", INVALID[:1])
    result = run(spark, lake, paths[:1], zones, loaded_at=LOADED)
    assert (result["trips_read"], result["facts_written"]) == (1, 0)
    assert read_months(spark, lake.table("fact_trips"), ["2023-01"]).count() == 0
    assert read_months(spark, lake.table("fact_trips"), ["2023-02"]).count() == 5
    assert read_months(spark, lake.mart("route"), ["2023-01"]).count() == 0


def test_marts_add_up_over_months(spark, folder, raw):
    paths, zones = raw
    lake = Lake(f"{folder}/lake")
    run(spark, lake, paths[:1], zones, loaded_at=LOADED)
    run(spark, lake, paths[1:], zones, loaded_at=LOADED)
    payment = {r.payment_type_key: (r.trips, str(r.revenue)) for r in read_mart(spark, lake, "payment").collect()}
    assert payment == {1: (9, "516.20"), 2: (2, "70.70")}
    assert sum(r.trips for r in read_mart(spark, lake, "date_pickup").collect()) == 11


def test_the_ledger_tells_the_run(spark, folder, raw):
    paths, zones = raw
    lake = Lake(f"{folder}/lake")
    undated = month_file(folder, "trips.parquet", TRIPS[:2])
    run(spark, lake, [*paths, undated], zones, run_id="r1", loaded_at=LOADED)
    stages = {r.stage: (r.records_in, r.records_out, r.records_rejected) for r in open_ledger(spark, lake, "full", "r1").this_run().collect()}
    assert stages["bronze_zones"] == (6, 6, 0)
    assert stages["bronze_trips"] == (14, 12, 2)
    assert stages["gate"] == (12, 11, 1)
    assert stages["fact"] == (11, 11, 0)


def test_several_files_in_a_month_get_keys_of_their_own(spark, folder, raw):
    _, zones = raw
    lake = Lake(f"{folder}/lake")
    parts = [month_file(folder, f"{n}_2023-03.parquet", shifted(TRIPS, 3)) for n in "ab"]
    result = run(spark, lake, parts, zones, loaded_at=LOADED)
    assert result["facts_written"] == 10
    assert len({key for key, *_ in facts(spark, lake)}) == 10


def test_reloading_one_file_of_a_month_keeps_the_others_and_all_keys(spark, folder, raw):
    _, zones = raw
    lake = Lake(f"{folder}/lake")
    a, b, c = [month_file(folder, f"{n}_2023-03.parquet", shifted(TRIPS, 3)) for n in "abc"]
    run(spark, lake, [b, c], zones, loaded_at=LOADED)
    first = facts(spark, lake)
    result = run(spark, lake, [c], zones, loaded_at=LOADED)
    assert result["facts_written"] == 10 and facts(spark, lake) == first
    run(spark, lake, [a], zones, loaded_at=LOADED)
    later = facts(spark, lake)
    assert set(first) < set(later) and len({key for key, *_ in later}) == 15


def test_a_trip_centuries_away_is_loaded(spark, folder, raw):
    _, zones = raw
    lake = Lake(f"{folder}/lake")
    far = [(r[0], r[1].replace(year=2300), r[2].replace(year=2300), *r[3:]) for r in TRIPS[:1]]
    result = run(spark, lake, [month_file(folder, "t_2023-04.parquet", [*TRIPS, *far])], zones, loaded_at=LOADED)
    assert result["facts_written"] == 6 and all(rows == 0 for rows in result["orphan_rows"].values())


def test_nothing_to_load(spark, folder, raw):
    _, zones = raw
    assert run(spark, Lake(f"{folder}/lake"), [], zones)["months_processed"] == 0


def test_publishing_drops_the_key_and_keeps_definitions(spark, folder, raw, monkeypatch):
    paths, zones = raw
    lake = Lake(f"{folder}/lake")
    run(spark, lake, paths, zones, loaded_at=LOADED)
    calls = []
    monkeypatch.setattr("starmart.sources.lake.write_jdbc", lambda df, _, table, mode: calls.append((table, mode, df.columns)))
    jobs.publish(spark, lake, {"url": "jdbc:x:y"})
    assert [c[0] for c in calls] == ["dim_date", "dim_time", "dim_location", "dim_vendor", "dim_ratecode", "dim_payment_type", "fact_trips"]
    assert {c[1] for c in calls} == {"overwrite"}
    assert calls[-1][2] == contracts.FACT_TRIPS.fieldNames()[1:]


def test_months_are_loaded_together(spark, folder, raw):
    """Spark jobs hardly grow with the months: they are not loaded one after another."""
    paths, zones = raw

    def jobs_of(name, files):
        spark.sparkContext.setJobGroup(name, name)
        run(spark, Lake(f"{folder}/{name}"), files, zones, loaded_at=LOADED)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))

    march = [month_file(folder, f"trips_2023-{m:02}.parquet", shifted(TRIPS, m)) for m in range(3, 7)]
    one, four = jobs_of("one", march[:1]), jobs_of("four", march)
    assert four - one < 2 * 3  # three months more: at most a footer or a listing each


def test_files_of_one_name_in_two_folders_keep_their_rows(spark, folder, raw):
    lake, zones, paths = Lake(f"{folder}/lake"), raw[1], []
    for side, rows in (("east side+1", TRIPS[:3]), ("west", TRIPS)):
        os.makedirs(f"{folder}/{side}")
        paths.append(month_file(f"{folder}/{side}", "trips_2023-01.parquet", rows))
    run(spark, lake, paths[:1], zones, loaded_at=LOADED)
    first = {r[0] for r in facts(spark, lake)}
    run(spark, lake, paths[1:], None, loaded_at=LOADED)
    both = facts(spark, lake)
    assert len(both) == 8 and first < {r[0] for r in both}
    for again in (paths[:1], paths, paths[1:]):
        run(spark, lake, again, None, loaded_at=LOADED)
        assert facts(spark, lake) == both


def test_values_that_do_not_fit_are_kept_aside(spark, folder, raw):
    """A vendor out of range is no vendor 1; its row is kept as text until the file is mended."""
    lake, zones = Lake(f"{folder}/lake"), raw[1]
    bad = [(3_000_000_000, *TRIPS[0][1:]), (*TRIPS[1][:3], 2**40, *TRIPS[1][4:]), *TRIPS[2:]]
    path = month_file(folder, "trips_2023-03.parquet", shifted(bad, 3))
    result = run(spark, lake, [path, raw[0][1]], zones, run_id="one", loaded_at=LOADED)
    assert result["facts_written"] == 8
    unfit = {tuple(r.lost_columns): r for r in spark.read.parquet(lake.unfit).collect()}
    assert set(unfit) == {("VendorID",), ("passenger_count",)}
    assert json.loads(unfit["VendorID",].row)["VendorID"] == 3_000_000_000 and unfit["VendorID",]._source_month == "2023-03"
    ledger = open_ledger(spark, lake, "full", "one")
    (stage,) = [r for r in ledger.this_run().collect() if r.stage == "bronze_trips"]
    assert (stage.records_in, stage.records_out, stage.records_rejected) == (10, 8, 2)
    told = {r.tags["column"]: r.value for r in ledger.metrics().where("name = 'lost_values'").collect()}
    assert told == {"VendorID": 1.0, "passenger_count": 1.0}
    month_file(folder, "trips_2023-03.parquet", shifted(TRIPS, 3))
    spark.catalog.clearCache()
    assert run(spark, lake, [path], None, loaded_at=LOADED)["facts_written"] == 5
    assert spark.read.parquet(lake.unfit).count() == 0


def test_marts_come_from_one_scan_of_the_facts(spark, folder, raw):
    paths, zones = raw
    lake = Lake(f"{folder}/lake")
    run(spark, lake, paths, zones, loaded_at=LOADED)
    fact = spark.read.parquet(lake.table("fact_trips"))
    plan = jobs.mart_sums(fact)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    for name in [*jobs.MARTS, *jobs.NAMED_MARTS]:
        rows = read_mart(spark, lake, name).collect()
        assert sum(r.trips for r in rows) <= 11 and all("is_high_value" not in r for r in rows)
    airports = list(jobs.fixed.AIRPORT_LOCATIONS)
    want = sorted((r.date_key, r["count"]) for r in fact.where(F.col("pickup_location_key").isin(airports)).groupBy("date_key").count().collect())
    assert sorted((r.date_key, r.trips) for r in read_mart(spark, lake, "airport_pickup").collect()) == want != []
    assert sum(r.trips for r in read_mart(spark, lake, "high_value").collect()) == fact.where(F.col("total_amount") > jobs.fixed.HIGH_VALUE_TOTAL).count() > 0
    for name in jobs.NAMED_MARTS:
        assert sum(r.trips for r in read_mart(spark, lake, name).collect()) == 11


def test_what_cannot_be_loaded_is_kept_and_can_be_loaded_later(spark, folder, raw):
    lake, zones = Lake(f"{folder}/lake"), raw[1]
    with open(zones, "a") as f:
        f.write("x,Bad,Line,Here\n")
    undated = month_file(folder, "trips.parquet", TRIPS[:2], VendorID=pa.int32())
    other = f"{folder}/more.parquet"
    pq.write_table(pa.table({"VendorID": ["one"], "file": [1.5], "row": [None]}), other)
    run(spark, lake, [raw[0][0], undated, other], zones, run_id="one", loaded_at=LOADED)
    held = jobs.read_quarantine(spark, lake)
    told = {r.stage: r.records_rejected for r in open_ledger(spark, lake, "full", "one").this_run().collect()}
    assert held.count() == told["bronze_zones"] + told["bronze_trips"] == 1 + 3
    (line,) = held.where(F.col("reason") == jobs.UNFIT_LINE).collect()
    assert json.loads(line.row)["_corrupt_record"] == "x,Bad,Line,Here" and line.file.endswith("zones.csv")
    assert json.loads(held.where("file LIKE '%more%'").first().row) == {"VendorID": "one", "file": 1.5, "row": None}

    pd.DataFrame(ZONES, columns=contracts.ZONES.fieldNames()).to_csv(zones, index=False)
    spark.catalog.clearCache()
    run(spark, lake, [undated], zones, loaded_at=LOADED)
    assert jobs.read_quarantine(spark, lake, jobs.UNFIT_LINE).count() == 0
    assert jobs.read_quarantine(spark, lake, jobs.UNDATED).count() == 3  # loaded again, not doubled
    rows = jobs.read_quarantine(spark, lake, jobs.UNDATED, contracts.RAW_TRIPS).where("fare_amount IS NOT NULL")
    assert sorted(tuple(r) for r in rows.collect()) == sorted(tuple(r) for r in spark.createDataFrame(TRIPS[:2], contracts.RAW_TRIPS).collect())
    rows.write.parquet(f"{folder}/mended_2023-01")
    assert run(spark, lake, [f"{folder}/mended_2023-01"], None, loaded_at=LOADED)["facts_written"] == 6 + 2


def test_bytes_are_those_of_the_files(spark, folder, raw):
    paths, zones = raw
    lake = Lake(f"{folder}/lake")
    run(spark, lake, paths, zones, run_id="one", loaded_at=LOADED)
    told = {r.stage: r.bytes_processed for r in open_ledger(spark, lake, "full", "one").this_run().collect()}
    on_disk = [p for p, _, names in os.walk(lake.bronze_trips) for p in [f"{p}/{n}" for n in names if n.endswith(".parquet")]]
    assert told["bronze_trips"] == sum(map(os.path.getsize, paths))
    assert told["bronze_zones"] == os.path.getsize(zones)
    assert told["gate"] == told["fact"] == sum(map(os.path.getsize, on_disk))
    assert told["marts"] > 0


def test_quarantine_names_a_file_once_and_not_in_every_row(spark, folder, monkeypatch):
    """Files whose names need escapes are held under their plain paths, which come from a broadcast list."""
    paths = [f"{folder}/{name}" for name in ("a b+c%20d.parquet", "plain.parquet")]
    for path in paths:
        pq.write_table(pa.table({"x": [1, 2]}), path)
    plans, write = [], jobs.write_partitions
    monkeypatch.setattr(jobs, "write_partitions", lambda df, *rest: (plans.append(df._jdf.queryExecution().executedPlan().toString()), write(df, *rest)))
    lake, now = Lake(f"{folder}/lake"), F.lit(LOADED)
    assert jobs.quarantine(lake, scan.read_as_text(spark, paths), scan.raw_files(spark, paths), jobs.UNDATED, now) == 4
    assert "BroadcastHashJoin" in plans[0]
    held = jobs.read_quarantine(spark, lake).groupBy("file").count().collect()
    assert sorted((r.file, r["count"]) for r in held) == [(f"file:{p}", 2) for p in paths]
    # A row of a file that is not listed keeps its own path.
    assert jobs.quarantine(Lake(f"{folder}/other"), scan.read_as_text(spark, paths), [], jobs.UNDATED, now) == 4
    held = jobs.read_quarantine(spark, Lake(f"{folder}/other")).groupBy("file").count().collect()
    assert sorted((r.file, r["count"]) for r in held) == [(f"file:{p}", 2) for p in paths]


def test_lines_move_once_to_make_month_files(spark, folder, monkeypatch):
    """The years are written by the tasks that join lines and orders."""
    day = "to_date(concat(1995 + k % 4, '-02-03'))"
    tables = {
        "customer": ["k AS c_custkey", "k % 3 AS c_nationkey"],
        "supplier": ["k AS s_suppkey", "k % 5 AS s_nationkey"],
        "orders": ["k AS o_orderkey", "k AS o_custkey", f"{day} AS o_orderdate", "10D * k AS o_totalprice", "'1-URGENT' AS o_orderpriority"],
        "lineitem": [
            "k AS l_orderkey", "k AS l_suppkey", "1 AS l_linenumber", "2D AS l_quantity", "3D AS l_extendedprice", "0.1D AS l_discount",
            "0.02D AS l_tax", "'N' AS l_returnflag", "'O' AS l_linestatus", f"date_add({day}, 5) AS l_shipdate",
        ],
    }
    for name, columns in tables.items():
        spark.range(40).withColumnRenamed("id", "k").selectExpr(*columns).write.parquet(f"{folder}/{name}.parquet")
    plans, write = [], running.write_partitions
    monkeypatch.setattr(
        running, "write_partitions",
        lambda df, *rest, **how: (plans.append((df._jdf.queryExecution().executedPlan().toString(), how)), write(df, *rest, **how)),
    )
    months = running.month_files(spark, folder, f"{folder}/made")
    ((text, how),) = plans
    assert not how.get("rebalance") and "REBALANCE" not in text
    assert sorted(months) == [f"{y}-01" for y in range(1995, 1999)]
    made = spark.read.parquet(*months.values())
    assert made.count() == 40 and {(r.PULocationID, r.DOLocationID) for r in made.collect()} == {(k % 5, k % 3) for k in range(40)}
