import random

import pytest
from conftest import SF_DIR, rows
from pyspark.sql import functions as F

from tripweave import driver_tables as d
from tripweave.operators import (
    are_small, broadcast_if_small, cell_counts, clean_trips, dropped_trips, latest_zip, locate,
    nearest_zip, prepare_lookup, range_join, taxi_cells, zone_means,
)
from tripweave.operators import nearest
from tripweave.operators.nearest import ensure_checkpoint_dir


def taxi(distance, **more):
    return {"mode": "yellow", "pickup": "2018-08-01 05:00:00", "distance": distance, **more}


def test_only_the_text_dot_00_and_missing_distances_drop(make_trips):
    trips = make_trips(*[taxi(x) for x in (".00", "0", "0.0", "0.00", None, "1.5")])
    assert rows(clean_trips(trips), "distance") == [(0.0,), (0.0,), (0.0,), (1.5,)]
    assert rows(clean_trips(trips, min_distance=1.0), "distance") == [(1.5,)]


def test_bikes_need_no_distance_and_missing_times_drop(make_trips):
    trips = make_trips(
        {"mode": "bike", "pickup": "8/1/2016 0:01"}, {"mode": "bike"}, taxi("1", pickup=None)
    )
    assert rows(clean_trips(trips), "mode", "time_cell", "distance") == [("bike", "2016-08-01 0", None)]
    assert rows(clean_trips(trips, pad_hour=True), "time_cell") == [("2016-08-01 00",)]


def test_bad_numbers_fail_or_drop(make_trips):
    trips = make_trips(taxi("abc"), taxi("2"))
    with pytest.raises(Exception, match="not a number"):
        clean_trips(trips).collect()
    assert rows(clean_trips(trips, on_bad_number="drop"), "distance") == [(2.0,)]


def test_dropped_trips_are_counted(make_trips):
    trips = make_trips(taxi("abc"), taxi(".00"), taxi(None), taxi("1", pickup=None), {"mode": "bike"})
    assert rows(dropped_trips(trips)) == [("bike", 1, 1, 0, 0, 0), ("yellow", 4, 1, 1, 1, 1)]


def lookup_rows(spark):
    data = [("7", "10007", 1), ("7", "10070", 2), ("8", "", 1), ("9", "10009", 1)]
    return spark.createDataFrame(data, "id string, zip string, line int")


def located(trips, lookup):
    return rows(locate(trips, lookup), "start_id", "start_zip", "end_zip")


@pytest.mark.parametrize("limit", [1_000, 0])
def test_locations(spark, make_trips, limit):
    """Known, superseded, blank, unknown and missing ids; broadcast and shuffled alike."""
    trips = make_trips(
        taxi("1", start_id="7", end_id="9"), taxi("1", start_id="8", end_id="264"),
        taxi("1", start_id=None, end_id="7"),
    )
    lookup = prepare_lookup(lookup_rows(spark), max_rows=limit)
    assert located(trips, lookup) == [
        ("7", "10070", "10009"), ("8", "00000", "00000"), (None, "00000", "10070"),
    ]


def plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_only_measured_small_lookups_are_broadcast(spark, make_trips):
    trips = make_trips(taxi("1", start_id="7", end_id="9"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = plan(locate(trips, prepare_lookup(lookup_rows(spark))))
        large = plan(locate(trips, prepare_lookup(lookup_rows(spark), max_rows=3)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in small and "SortMergeJoin" not in small
    assert "SortMergeJoin" in large and "Broadcast" not in large


def test_a_hot_id_is_split_when_the_lookup_is_too_large(spark):
    """Half of the trips start at one place; its shuffle partition is read by several tasks."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "16",
    }
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        trips = spark.range(0, 40_000, 1, 8).select(
            F.when(F.col("id") % 2 == 0, "7").otherwise(F.col("id").cast("string")).alias("start_id"),
            (F.col("id") % 1_000).cast("string").alias("end_id"),
            F.sha2(F.col("id").cast("string"), 256).alias("text"),
        )
        ids = spark.range(0, 40_000).select(
            F.col("id").cast("string").alias("id"), F.lit("10001").alias("zip"), F.lit(1).alias("line")
        )
        df = locate(trips, prepare_lookup(ids, max_rows=0)).groupBy("text").agg(F.max("start_zip"))
        assert len(df.collect()) == 40_000
        assert "SortMergeJoin(skew=true)" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in small:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_sizes(spark):
    df = spark.range(10).select(F.col("id").cast("string").alias("x"))
    assert are_small(df, df.limit(2), max_rows=5) == [False, True]
    assert are_small(df, max_rows=10) == [True]
    assert are_small(df, max_bytes=89) == [False]  # 10 rows of 1 + 8 bytes
    assert are_small(df, max_bytes=90) == [True]
    assert are_small(df.limit(0)) == [True]
    assert "broadcast" in plan(broadcast_if_small(df).join(df, "x")).lower()


def test_a_hot_order_is_split_also_with_fewer_splits_than_cores(spark, tmp_path):
    for name in ("orders", "customer"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    items = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    hot = items.agg(F.min("l_orderkey")).first()[0]
    key = F.when(F.col("l_partkey") % 5 < 2, F.lit(hot)).otherwise(F.col("l_orderkey"))
    items.withColumn("l_orderkey", key).repartition(3).write.parquet(str(tmp_path / "lineitem.parquet"))
    small = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "8",
    }
    for conf, value in small.items():
        spark.conf.set(conf, value)
    try:
        df = d.trips(spark, str(tmp_path))
        assert len(df.collect()) == items.count()
        final = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in final and "REPARTITION_BY_NUM" not in final
    finally:
        for conf in small:
            spark.conf.unset(conf)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize("limit", [1_000, 0])
def test_an_id_that_repeats_does_not_repeat_trips(spark, make_trips, limit):
    lookup = spark.createDataFrame([("7", "10001"), ("7", "10002"), ("7", None)], "id string, zip string")
    found = locate(make_trips(taxi("1", start_id="7", end_id="7")), prepare_lookup(lookup, max_rows=limit))
    assert rows(found, "start_zip", "end_zip") == [("10002", "10002")]


def test_taxi_cells_count_each_mode_for_itself(spark, make_trips):
    trips = make_trips(
        taxi("1", payment_type="1"), taxi("3", payment_type="2"), taxi("2", payment_type="1", mode="green"),
        {"mode": "bike", "pickup": "2018-08-01 05:00:00"},
    )
    cells = taxi_cells(locate(clean_trips(trips), prepare_lookup(lookup_rows(spark))))
    assert rows(cells, "mode", "hour", "trips", "part", "mean") == [
        ("green", "05", 1, 1, 2.0), ("yellow", "05", 2, 1, 2.0),
    ]


def test_latest_zip_and_cell_counts(spark, make_trips):
    assert rows(latest_zip(lookup_rows(spark))) == [("7", "10070"), ("8", ""), ("9", "10009")]
    trips = make_trips(*[taxi("1", start_id="7", end_id="9")] * 3, taxi("2", start_id="7", end_id="9"))
    counted = cell_counts(locate(clean_trips(trips), prepare_lookup(lookup_rows(spark))))
    assert rows(counted, "mode", "date", "hour", "start_zip", "end_zip", "trip_count") == [
        ("yellow", "2018-08-01", "05", "10070", "10009", 4)
    ]


@pytest.mark.parametrize("bucket", [1, 4, 1024])
@pytest.mark.parametrize("limit", [1_000, 0])
def test_range_join_equals_brute_force(spark, bucket, limit):
    ranges = [(1, 0, 4), (2, 4, 5), (3, 5, 40), (4, 40, 40), (5, 45, 60), (6, -5, 0)]
    df = spark.createDataFrame(ranges, "zone int, lo long, hi long")
    ids = spark.range(-10, 70)
    found = rows(range_join(ids, df, bucket, max_rows=limit), "id", "zone")
    assert found == sorted(
        ((i, z) for i in range(-10, 70) for z, lo, hi in ranges if lo <= i < hi),
        key=lambda r: tuple(map(repr, r)),
    )


def test_zone_means_use_the_first_vertex_of_each_zone(spark):
    ranges = spark.createDataFrame([(1, 0, 2), (2, 2, 4)], "zone int, lo long, hi long")
    vertices = spark.createDataFrame(
        [(0, 1.0, 10.0), (1, 3.0, 20.0), (2, 8.0, 0.0), (3, 4.0, 1.0), (4, 99.0, 99.0)],
        "id long, lat double, lon double",
    )
    assert rows(zone_means(vertices, ranges)) == [(1, 2.0, 15.0, 2), (2, 6.0, 0.5, 2)]


def brute_nearest(points, known, scale):
    out = []
    for name, lat, lon in points:
        if lat is None or lon is None or not known or not (abs(lat) <= 90 and abs(lon) <= 180):
            out.append((name, None))
            continue
        best = min(
            ((lon * scale - klon * scale) ** 2 + (lat - klat) ** 2, z) for klat, klon, z in known
        )
        out.append((name, best[1]))
    return sorted(out)


def point_frames(spark, points, known):
    return (
        spark.createDataFrame(points, "id string, lat double, lon double"),
        spark.createDataFrame(known, "lat double, lon double, zip string"),
    )


@pytest.mark.parametrize("array_points", [2_000, 0])
def test_nearest_equals_brute_force(spark, array_points):
    """A dense spot that holds a third of everything, lone points far away, copies and ties."""
    rng = random.Random(7)
    spot = [(40.7 + rng.random() * 1e-4, -74.0 + rng.random() * 1e-4) for _ in range(60)]
    wide = [(40.0 + rng.random(), -74.5 + rng.random()) for _ in range(60)]
    grid = [(40.0 + i / 8, -74.0 + j / 8) for i in range(6) for j in range(6)]
    known = [(*p, f"{10000 + i:05d}") for i, p in enumerate(spot + wide + grid)]
    known += [(40.7, -74.0, "10999"), (40.7, -74.0, "10998"), (41.0, -74.0, "")]
    inf = float("inf")
    nowhere = [(float("nan"), -74.0, "10001"), (None, -74.0, "10001"), (40.0, inf, "10001"),
               (-inf, -74.0, "10001"), (90.5, -74.0, "10001"), (40.0, 1e10, "10001")]
    places = (
        spot[::3] + [(a + 1e-6, b - 1e-6) for a, b in spot[::4]]
        + [(40.0 + rng.random() * 1.5, -75.0 + rng.random() * 1.5) for _ in range(60)]
        + [(40.0 + i / 16, -74.0 + i / 16) for i in range(10)] + [(40.7, -74.0)] * 30 + [(60.0, 10.0)]
    )
    points = [(f"p{i}", *p) for i, p in enumerate(places)] + [("none", None, -74.0)]
    points += [("far", inf, -74.0), ("off", 40.0, 181.0), ("edge", -90.0, 180.0)]
    p, k = point_frames(spark, points, known + nowhere)
    found = nearest_zip(p, k, lon_scale=0.75, max_array_points=array_points)
    assert rows(found, "id", "zip") == brute_nearest(points, [x for x in known if x[2]], 0.75)


@pytest.mark.parametrize("sites", [1_999, 2_000, 2_001])
def test_nearest_does_not_depend_on_the_number_of_sites(spark, sites):
    rng = random.Random(sites)
    known = [(40 + rng.random(), -74 + rng.random(), f"{10000 + i}") for i in range(sites - 1)]
    known += [(40.5, float("inf"), "99999")]
    points = [(str(i), 40 + rng.random(), -74 + rng.random()) for i in range(100)]
    p, k = point_frames(spark, points, known)
    assert rows(nearest_zip(p, k, 0.75), "id", "zip") == brute_nearest(points, known[:-1], 0.75)


@pytest.mark.parametrize("array_points", [2_000, 0])
def test_nearest_with_one_or_no_known_point(spark, array_points):
    points = [("a", 1.0, 2.0), ("b", 1.0, 2.0)]
    for known in ([(1.0, 2.0, "10001")], []):
        p, k = point_frames(spark, points, known)
        found = nearest_zip(p, k, max_array_points=array_points)
        assert rows(found, "id", "zip") == brute_nearest(points, known, 1.0)


@pytest.mark.parametrize("leaf", [1, 16])
def test_sites_nearer_than_the_finest_cell(spark, monkeypatch, leaf):
    """With a leaf of one site the descent goes down to the finest cells."""
    monkeypatch.setattr(nearest, "_LEAF", leaf)
    points = [("a", 0.0, 0.0), ("b", 1e-13, 0.0), ("far", 1.0, 1.0)]
    known = [(2e-13, 0.0, "10002"), (0.0, 0.0, "10001"), (1.0, 0.0, "10003")]
    p, k = point_frames(spark, points, known)
    found = nearest_zip(p, k, lon_scale=1.0, max_array_points=0)
    assert rows(found, "id", "zip") == brute_nearest(points, known, 1.0)


def test_both_nearest_ways_agree_on_the_test_tables(spark):
    points, known = d.customer_points(spark, SF_DIR), d.known_stations(spark, SF_DIR)
    array = nearest_zip(points, known, d.LON_SCALE)
    tree = nearest_zip(points, known, d.LON_SCALE, max_array_points=0)
    assert rows(array, "id", "zip") == rows(tree, "id", "zip")


def test_checkpoint_folder_of_the_session_is_kept(spark):
    ensure_checkpoint_dir(spark)
    before = spark.sparkContext.getCheckpointDir()
    ensure_checkpoint_dir(spark)
    assert before and spark.sparkContext.getCheckpointDir() == before
