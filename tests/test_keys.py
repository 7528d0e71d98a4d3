"""Keys: calendar and clock keys, content keys, position keys."""

import pytest
from pyspark.sql import functions as F

from starmart.functions import keys
from starmart.functions.keys import date_key, position_key, time_key, with_content_key


def test_date_and_time_keys(trips):
    rows = trips.orderBy("tpep_pickup_datetime").select(
        date_key(F.col("tpep_pickup_datetime")).alias("d"), time_key(F.col("tpep_pickup_datetime")).alias("t")
    )
    assert [(r.d, r.t) for r in rows.collect()] == [
        (20230115, 1030), (20230115, 1400), (20230116, 815), (20230116, 900), (20230117, 600),
    ]


def test_content_key_is_the_same_after_repartitioning(trips):
    def keyed(df):
        return {(r.row_id, r.trip_key, r.total_amount) for r in with_content_key(df).collect()}

    copies = trips.unionByName(trips).unionByName(trips.limit(2))
    first, second = keyed(copies), keyed(copies.repartition(7).sort("trip_distance"))
    assert first == second
    assert len(first) == 12


def test_content_key_tells_null_positions_apart(spark):
    df = spark.createDataFrame([(None, 1), (1, None)], "a int, b int")
    assert with_content_key(df).select("trip_key").distinct().count() == 2


@pytest.mark.parametrize("copies", [1, 4, 5, 8, 9, 23])
def test_copies_over_block_edges(spark, monkeypatch, copies):
    monkeypatch.setattr(keys, "COPIES_PER_BLOCK", 4)
    df = spark.range(copies).select(F.lit("hot").alias("v")).unionByName(spark.range(3).select(F.col("id").cast("string").alias("v")))
    keyed = with_content_key(df)
    assert keyed.count() == copies + 3
    assert keyed.select("row_id").distinct().count() == copies + 3
    hot = keyed.filter("v = 'hot'").select(F.split("row_id", "-")[1].cast("int").alias("n")).collect()
    assert sorted(r.n for r in hot) == list(range(copies))


def test_content_key_of_an_empty_frame(trips):
    assert with_content_key(trips.limit(0)).count() == 0


def key_of(spark, year, month, file_number, row):
    df = spark.range(1).select(*[F.lit(v).cast("long").alias(c) for c, v in zip("ymfr", (year, month, file_number, row), strict=True)])
    return df.select(position_key(*[F.col(c) for c in "ymfr"]).alias("k")).first().k


def test_position_keys_do_not_meet(spark):
    places = [
        (2023, 1, 0, 0), (2023, 1, 0, 1), (2023, 1, 1, 0), (2023, 2, 0, 0), (2022, 12, 0, 0),
        (2023, 1, 0, keys.MAX_ROWS_PER_FILE - 1), (2023, 1, keys.MAX_FILES_PER_MONTH - 1, 0), (2300, 12, 0, 0),
    ]
    found = {key_of(spark, *place) for place in places}
    assert len(found) == len(places)
    assert all(k >= 0 for k in found)


@pytest.mark.parametrize("place", [(2023, 1, keys.MAX_FILES_PER_MONTH, 0), (2023, 1, 0, keys.MAX_ROWS_PER_FILE)])
def test_position_out_of_range_fails(spark, place):
    with pytest.raises(Exception, match="out of key range"):
        key_of(spark, *place)
