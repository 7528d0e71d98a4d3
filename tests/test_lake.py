"""Lake writes, merges by key, load routing and database options."""

from datetime import datetime
from unittest.mock import MagicMock

import pyarrow.parquet as pq
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.operators.lineage import month_of_path, number_files, split_month
from starmart.operators.merge import insert_if_absent, upsert
from starmart.sources import jdbc, lake, scan, snapshots
from starmart.sources.snapshots import read_snapshot, read_snapshot_before


def monthly(spark, rows):
    return spark.createDataFrame(rows, "v string, _year int, _month int")


def contents(spark, path):
    return sorted((r.v, r["_month"]) for r in spark.read.parquet(path).collect())


def test_rewriting_a_month_replaces_only_that_month(spark, folder):
    path = f"{folder}/t"
    lake.replace_months(monthly(spark, [("a", 2023, 1), ("b", 2023, 2)]), path, ["2023-01", "2023-02"])
    lake.replace_months(monthly(spark, [("c", 2023, 1), ("d", 2023, 1)]), path, ["2023-01"])
    assert contents(spark, path) == [("b", 2), ("c", 1), ("d", 1)]


def test_counts_come_from_the_write(spark, folder):
    rows = monthly(spark, [("a", 2023, 1), ("b", 2023, 2), ("c", 2023, 2)])
    written = lake.replace_months(rows, f"{folder}/t", ["2023-01", "2023-02"], {"top": F.max("v")})
    assert written == {"2023-01": 1, "2023-02": 2, "top": "c"}


def test_a_month_that_lost_its_rows_is_emptied(spark, folder):
    path = f"{folder}/t"
    lake.replace_months(monthly(spark, [("a", 2023, 1), ("b", 2023, 2)]), path, ["2023-01", "2023-02"])
    lake.replace_months(monthly(spark, []), path, ["2023-01"])
    assert contents(spark, path) == [("b", 2)]


def test_rows_of_other_months_are_an_error(spark, folder):
    with pytest.raises(Exception, match="row outside the listed months: 2023-2"):
        lake.replace_months(monthly(spark, [("b", 2023, 2)]), f"{folder}/t", ["2023-01"])


def test_rebalanced_write_keeps_every_row(spark, folder):
    df = spark.range(1000).select((F.col("id") % 3).alias("v"), F.lit(2023).alias("_year"), F.lit(1).alias("_month"))
    lake.write_partitions(df.repartition(5), f"{folder}/t", lake.MONTH, rebalance=True)
    assert spark.read.parquet(f"{folder}/t").count() == 1000


def test_partitioned_writes_do_not_sort(spark, folder):
    """More partitions than open files are written all the same, and the session keeps its setting."""
    before = spark.conf.get(lake.WRITERS)
    with lake.unsorted_writes(spark):
        assert spark.conf.get(lake.WRITERS) == str(lake.OPEN_FILES)
    parts = 2 * lake.OPEN_FILES + 1
    df = spark.range(1000).select("id", (F.col("id") % parts).alias("p")).coalesce(1)
    lake.write_partitions(df, f"{folder}/t", ["p"])
    assert spark.conf.get(lake.WRITERS) == before
    back = spark.read.parquet(f"{folder}/t")
    assert back.count() == 1000 and back.where(f"id % {parts} <> p").count() == 0


def test_partitioned_writes_load_their_tasks_evenly(spark, folder):
    """Scans of a write are split for more tasks than cores, times are 64-bit numbers, and the session keeps its settings."""
    before = {name: spark.conf.get(name, None) for name in (lake.SPLITS, lake.TIMES)}
    with lake.unsorted_writes(spark):
        assert int(spark.conf.get(lake.SPLITS)) == lake.TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    lake.write_partitions(spark.sql("SELECT TIMESTAMP'1850-03-04 05:06:07.89' AS ts, 1 AS p"), f"{folder}/t", ["p"])
    assert before == {name: spark.conf.get(name, None) for name in (lake.SPLITS, lake.TIMES)}
    (file,) = spark.read.parquet(f"{folder}/t").inputFiles()
    assert pq.ParquetFile(file.removeprefix("file://")).schema.column(0).physical_type == "INT64"
    assert spark.read.parquet(f"{folder}/t").first().ts == datetime(1850, 3, 4, 5, 6, 7, 890000)


def test_shuffles_are_sized_by_the_input(spark):
    """First partitions follow from the bytes, not from the session's number; a number that the session names is kept."""
    with lake.sized_shuffles(spark, 100 * lake.SHUFFLE_BYTES):
        assert int(spark.conf.get(lake.SHUFFLES)) == 101
        joined = spark.range(1000).join(spark.range(1000).hint("shuffle_hash"), "id")
        joined.collect()
        assert "hashpartitioning(id#" in (text := joined._jdf.queryExecution().executedPlan().toString()) and ", 101)" in text
    with lake.sized_shuffles(spark, 1):
        assert spark.conf.get(lake.SHUFFLES) == spark.conf.get("spark.sql.shuffle.partitions")
    assert spark.conf.get(lake.SHUFFLES, None) is None
    spark.conf.set(lake.SHUFFLES, 3)
    try:
        with lake.sized_shuffles(spark, 100 * lake.SHUFFLE_BYTES):
            assert spark.conf.get(lake.SHUFFLES) == "3"
    finally:
        spark.conf.unset(lake.SHUFFLES)


def test_write_by_date(spark, trips, folder):
    lake.write_by_date(trips, f"{folder}/t", "tpep_pickup_datetime", "pickup_date")
    back = spark.read.parquet(f"{folder}/t")
    assert back.count() == 5
    assert {str(r.pickup_date) for r in back.collect()} == {"2023-01-15", "2023-01-16", "2023-01-17"}


def test_round_trip_and_second_overwrite(spark, trips, folder):
    assert lake.write_table(trips, f"{folder}/t") == 5
    assert lake.write_table(trips, f"{folder}/t") == 5
    back = spark.read.parquet(f"{folder}/t")
    assert back.count() == 5
    assert set(back.columns) == set(trips.columns)


def table(spark, rows):
    return spark.createDataFrame(rows, "k int, name string, note string")


def values(df):
    return {(r.k, r.name, r.note) for r in df.collect()}


def test_upsert_updates_named_columns_and_inserts(spark):
    target, source = table(spark, [(1, "a", "x"), (2, "b", "y")]), table(spark, [(2, "B", "Y"), (3, "c", "z")])
    assert values(upsert(target, source, ["k"])) == {(1, "a", "x"), (2, "B", "Y"), (3, "c", "z")}
    assert values(upsert(target, source, ["k"], ["name"])) == {(1, "a", "x"), (2, "B", "y"), (3, "c", "z")}


def test_upsert_can_set_a_null(spark):
    target, source = table(spark, [(1, "a", "x")]), table(spark, [(1, None, "y")])
    assert values(upsert(target, source, ["k"])) == {(1, None, "y")}


def test_insert_if_absent_leaves_the_target_alone(spark):
    target, source = table(spark, [(1, "a", "x"), (None, "n", "n")]), table(spark, [(1, "B", "Y"), (3, "c", "z"), (None, "m", "m")])
    assert values(insert_if_absent(target, source, ["k"])) == {(1, "a", "x"), (None, "n", "n"), (3, "c", "z")}


@pytest.mark.parametrize("merge", [upsert, insert_if_absent])
def test_a_key_twice_in_the_source_is_an_error(spark, merge):
    source = table(spark, [(1, "a", "x"), (1, "b", "y")])
    with pytest.raises(Exception, match="key occurs twice"):
        merge(table(spark, []), source, ["k"]).collect()


keyed = st.dictionaries(st.one_of(st.none(), st.integers(0, 6)), st.tuples(st.text(max_size=2), st.none()), max_size=6)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keyed, keyed)
def test_upsert_is_a_dictionary_update_and_idempotent(spark, old, new):
    target, source = table(spark, [(k, *v) for k, v in old.items()]), table(spark, [(k, *v) for k, v in new.items()])
    once = upsert(target, source, ["k"])
    expected = {(k, *v) for k, v in {**old, **new}.items()}
    assert values(once) == expected
    assert values(upsert(once, source, ["k"])) == expected
    assert values(insert_if_absent(target, source, ["k"])) == {(k, *v) for k, v in {**new, **old}.items()}


def test_load_dimension(spark, folder):
    path = f"{folder}/dim"
    assert lake.load_dimension(table(spark, [(1, "a", "x"), (2, "b", "y")]), path, ["k"]) == 2
    assert lake.load_dimension(table(spark, [(2, "B", "Y"), (3, "c", "z")]), path, ["k"]) == 3
    assert values(read_snapshot(spark, path)) == {(1, "a", "x"), (2, "B", "Y"), (3, "c", "z")}
    assert lake.load_dimension(table(spark, [(3, "C", "Z"), (4, "d", "w")]), path, ["k"], "insert") == 4
    assert values(read_snapshot(spark, path)) == {(1, "a", "x"), (2, "B", "Y"), (3, "c", "z"), (4, "d", "w")}
    assert lake.load_dimension(table(spark, [(9, "i", "i")]), path, ["k"], "overwrite") == 1
    with pytest.raises(ValueError, match="unknown way"):
        lake.load_dimension(table(spark, []), path, ["k"], "merge")
    assert values(read_snapshot(spark, path)) == {(9, "i", "i")}
    assert values(read_snapshot_before(spark, path)) == {(1, "a", "x"), (2, "B", "Y"), (3, "c", "z"), (4, "d", "w")}
    with pytest.raises(Exception, match="key occurs twice"):
        lake.load_dimension(table(spark, [(1, "a", "x"), (1, "b", "y")]), path, ["k"])
    assert values(read_snapshot(spark, path)) == {(9, "i", "i")}


def test_a_load_that_fails_leaves_the_table_as_it_was(spark, folder, monkeypatch):
    """Whether it fails while rows are written, or between these and the entry that names them."""
    path = f"{folder}/dim"
    with pytest.raises(ValueError, match="no finished load"):
        read_snapshot(spark, path)
    lake.load_dimension(table(spark, [(1, "a", "x")]), path, ["k"])
    reader = read_snapshot(spark, path)
    bad = table(spark, [(2, "b", "y")]).withColumn("note", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        snapshots.write_snapshot(reader.unionByName(bad), path)
    monkeypatch.setattr(snapshots, "_newest", MagicMock(side_effect=RuntimeError("driver gone")))
    with pytest.raises(RuntimeError, match="driver gone"):
        snapshots.write_snapshot(table(spark, [(3, "c", "z")]), path)
    monkeypatch.undo()
    assert values(read_snapshot(spark, path)) == {(1, "a", "x")}
    assert lake.load_dimension(table(spark, [(2, "b", "y")]), path, ["k"]) == 2
    assert values(reader) == {(1, "a", "x")}  # a reader keeps what it began with
    assert lake.load_dimension(table(spark, []), path, ["k"], "overwrite") == 0
    assert values(read_snapshot(spark, path)) == set()


@pytest.mark.parametrize("update", [None, ["name"]])
def test_a_small_source_does_not_move_the_target(spark, folder, update):
    spark.range(200_000).selectExpr("CAST(id AS INT) AS k", "sha1(string(id)) AS name", "sha1(string(-id)) AS note").write.parquet(f"{folder}/target")
    target, source = spark.read.parquet(f"{folder}/target"), table(spark, [(7, "seven", "s"), (-1, "new", "n")])
    staged = lake.stage_source(source, ["k"])
    for merged, rows in ((upsert(target, staged, ["k"], update, checked=True), 200_001), (insert_if_absent(target, staged, ["k"], checked=True), 200_001)):
        assert merged.count() == rows
        collected = merged.where("k in (7, -1)").orderBy("k")
        assert [r.k for r in collected.collect()] == [-1, 7]
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in moved_from(plan, f"{folder}/target")


def moved_from(plan, path):
    """The lines between each scan of the path and the join that reads it: where an exchange would move it whole."""
    lines, between = plan.splitlines(), []
    for at, line in enumerate(lines):
        if "FileScan" in line and path in line:
            above = at - 1
            while above >= 0 and "Join" not in lines[above]:
                between.append(lines[above])
                above -= 1
    assert any("FileScan" in line and path in line for line in lines)
    return "\n".join(between)


def test_load_routing(spark, folder, trips):
    lake.load(trips, "t", lake=folder)
    assert spark.read.parquet(f"{folder}/t").count() == 5
    lake.load(trips, "t", "lake", "append", lake=folder, drop_key="extra")
    assert spark.read.parquet(f"{folder}/t").count() == 10
    for wrong in ({"target": "ftp"}, {"mode": "upsert", "lake": folder}, {"target": "lake"}):
        with pytest.raises(ValueError):
            lake.load(trips, "t", **wrong)


def test_partitioned_load_replaces_the_partitions_it_brings(spark, folder):
    first = spark.createDataFrame([("a", "2023-01-01"), ("b", "2023-01-02")], "v string, d string")
    lake.load(first, "t", lake=folder, partition_by=["d"])
    lake.load(first.filter("d = '2023-01-02'").withColumn("v", F.lit("c")), "t", lake=folder, partition_by=["d"])
    assert {(r.v, str(r.d)) for r in spark.read.parquet(f"{folder}/t").collect()} == {("a", "2023-01-01"), ("c", "2023-01-02")}


# No database runs here: what is checked is what Spark is asked to do.

CONNECTION = {"url": "jdbc:x:y", "user": "u"}


def test_jdbc_write_options():
    df = MagicMock()
    lake.load(df, "dim_time", connection=CONNECTION, mode="overwrite", drop_key="trip_key")
    df.drop.assert_called_once_with("trip_key")
    write = df.drop.return_value.write
    write.format.assert_called_once_with("jdbc")
    options = write.format.return_value.options.call_args.kwargs
    assert options == {**CONNECTION, "dbtable": "dim_time", "batchsize": "10000", "numPartitions": "16", "truncate": "true"}
    write.format.return_value.options.return_value.mode.assert_called_once_with("overwrite")


def test_jdbc_read_options():
    assert jdbc.read_options(CONNECTION, "t") == {**CONNECTION, "dbtable": "t"}
    split = jdbc.read_options(CONNECTION, "t", "id", (0, 100), 8)
    assert split["numPartitions"] == "8" and (split["lowerBound"], split["upperBound"]) == ("0", "100")
    with pytest.raises(ValueError):
        jdbc.read_options(CONNECTION, "t", "id")


def test_jdbc_read_filters_before_it_projects():
    spark = MagicMock()
    jdbc.read_jdbc(spark, CONNECTION, "t", ["a"], "a > 1")
    loaded = spark.read.format.return_value.options.return_value.load.return_value
    loaded.filter.assert_called_once_with("a > 1")
    loaded.filter.return_value.select.assert_called_once_with("a")


def test_csv_lines_that_do_not_fit_are_kept_apart(spark, folder):
    from starmart import contracts

    with open(f"{folder}/zones.csv", "w") as f:
        f.write("LocationID,Borough,Zone,service_zone\n1,EWR,Newark,EWR\nx,Bad,Line,Here\n2,Queens,JFK,Airports\n")
    csv = scan.read_csv(spark, f"{folder}/zones.csv", contracts.ZONES)
    assert sorted(r.LocationID for r in scan.clean_rows(csv).collect()) == [1, 2]
    assert [r[scan.CORRUPT] for r in scan.corrupt_rows(csv).collect()] == ["x,Bad,Line,Here"]


def test_months_and_file_numbers():
    assert split_month("2023-01") == (2023, 1)
    for wrong in ("2023-13", "2023-1", "202301", "x2023-01"):
        with pytest.raises(ValueError):
            split_month(wrong)
    assert month_of_path("/raw/2020-05/trips_2023-01.parquet") == "2023-01"
    assert month_of_path("/raw/trips_2023-01/part-00000-9cf04ddb-d64d-4702-1012-a76f.parquet") == "2023-01"
    assert month_of_path("/raw/trips.parquet") is None
    assert number_files(["/x/b_2023-01.parquet", "/x/a_2023-01.parquet", "/x/c_2023-02.parquet"]) == [
        ("2023-01", "/x/a_2023-01.parquet", 0), ("2023-01", "/x/b_2023-01.parquet", 1), ("2023-02", "/x/c_2023-02.parquet", 0),
    ]
    known = {("2023-01", "/x/b_2023-01.parquet"): 0, ("2023-01", "/x/gone_2023-01.parquet"): 4}
    assert number_files(["/x/a_2023-01.parquet", "/x/b_2023-01.parquet"], known) == [
        ("2023-01", "/x/a_2023-01.parquet", 5), ("2023-01", "/x/b_2023-01.parquet", 0),
    ]
    assert number_files(["/x/2023-01/a.parquet", "/y/2023-01/a.parquet"]) == [
        ("2023-01", "/x/2023-01/a.parquet", 0), ("2023-01", "/y/2023-01/a.parquet", 1),
    ]


def test_existence_and_row_counts(spark, folder, trips):
    trips.write.parquet(f"{folder}/t")
    assert scan.exists(spark, f"{folder}/t")
    assert not scan.exists(spark, f"{folder}/none")
    assert not scan.exists(spark, "no_such_table")
    counts = scan.row_counts(spark, {"t": spark.read.parquet(f"{folder}/t"), "none": f"{folder}/none"}).collect()
    assert {(r.table_name, r.row_count) for r in counts} == {("t", 5), ("none", None)}
    layers = scan.layer_health(spark, {"a": f"{folder}/t", "b": f"{folder}/u"})
    assert scan.healthy(layers).first() == (False, ["b"])
    health = {r.layer: (r.present, r.files > 0) for r in layers.collect()}
    assert health == {"a": (True, True), "b": (False, False)}


def test_shared_folder(spark, monkeypatch):
    named = lake.shared_folder(spark)
    assert named == (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir())
    assert lake.scratch_folder(spark, "x").startswith(f"{named}/x-")

    class Unset:
        conf = {}

        class sparkContext:  # noqa: N801
            master = "yarn"

            @staticmethod
            def getCheckpointDir():  # noqa: N802
                return None

    with pytest.raises(ValueError, match="shared by all executors"):
        lake.shared_folder(Unset())


def test_files_of_one_folder_keep_their_own_types(spark, folder):
    wide = spark.createDataFrame([(1, 5.0), (2, None)], "VendorID long, Airport_fee double")
    narrow = spark.createDataFrame([(3,), (4,)], "VendorID int")
    contract = T.StructType([T.StructField("VendorID", T.LongType()), T.StructField("Airport_fee", T.DoubleType())])
    for name, parts in (("wide", (wide, narrow)), ("narrow", (narrow, wide))):
        for number, part in enumerate(parts):
            part.coalesce(1).write.mode("append").parquet(f"{folder}/{name}/{number}")
        rows = scan.read_raw(spark, [f"{folder}/{name}/0", f"{folder}/{name}/1"], contract).collect()
        assert sorted((r.VendorID, r.Airport_fee) for r in rows) == [(1, 5.0), (2, None), (3, None), (4, None)]


def test_three_hundred_months_are_counted_and_emptied(spark, folder):
    months = [f"{2000 + y}-{m:02}" for y in range(25) for m in range(1, 13)]
    rows = spark.range(600).select(
        F.col("id").cast("string").alias("v"),
        (2000 + F.floor(F.col("id") % 300 / 12)).cast("int").alias("_year"),
        (F.col("id") % 300 % 12 + 1).cast("int").alias("_month"),
    )
    assert lake.replace_months(rows, f"{folder}/t", months, rebalance=True) == dict.fromkeys(months, 2)
    left = lake.replace_months(rows.where("_year > 2000"), f"{folder}/t", months, rebalance=True)
    assert sum(left.values()) == spark.read.parquet(f"{folder}/t").count() == 576
