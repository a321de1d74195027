import sys

import pytest
from conftest import SF_DIR, rows
from pyspark.sql import functions as F

from tripweave import (
    audit_counts, bike_profile, destinations_from, golden_counts, join_profiles, mode_profile,
    mode_tables, multimodal_profile, multimodal_profile_of, refresh_lookup, taxi_profile,
    zone_lookup,
)
from tripweave import driver_tables as d
from tripweave.operators import cell_counts, prepare_lookup
from tripweave.plans.profiles import located_trips
from tripweave.registry import QUERIES
from tripweave.schemas import BIKE, CELL_KEYS, GREEN, MODES, YELLOW

COLUMNS = [
    "date", "hour", "start_zip", "end_zip", "bike_trip_count", "sub_percent", "bike_duration",
    "yellow_trip_count", "yellow_cc_count", "yellow_cc_percent", "yellow_trip_distance_avg",
    "green_trip_count", "green_cc_count", "green_cc_percent", "green_trip_distance_avg",
    "green_dispatch_percent",
]
TIME = "2018-08-01 05:00:00"


def bike(start, end, user="Subscriber", duration=60.0, pickup=TIME):
    return {"mode": BIKE, "pickup": pickup, "start_id": start, "end_id": end, "usertype": user,
            "duration": duration}


def taxi(mode, start, end, pay="1", distance="1.0", trip_type=None, pickup=TIME):
    return {"mode": mode, "pickup": pickup, "start_id": start, "end_id": end, "payment_type": pay,
            "distance": distance, "trip_type": trip_type}


def plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


@pytest.fixture()
def lookup(spark):
    data = [("1", "10001"), ("2", "10002"), ("3", "10003"), ("4", "")]
    return prepare_lookup(spark.createDataFrame(data, "id string, zip string"))


def test_bike_profile(make_trips, lookup):
    trips = make_trips(
        bike("1", "2", duration=61.0), bike("1", "2", "Customer", duration=62.0),
        bike("2", "1", "Customer"), bike("4", "9"), bike("1", "3", duration=None),
    )
    assert rows(bike_profile(trips, lookup)) == [
        ("2018-08-01", "05", "00000", "00000", 1, 1.0, 1.0),
        ("2018-08-01", "05", "10001", "10002", 2, 0.5, 1.02),
        ("2018-08-01", "05", "10001", "10003", 1, 1.0, None),
    ]
    everything = rows(bike_profile(trips, lookup, keep_zero_share=True))
    assert ("2018-08-01", "05", "10002", "10001", 1, 0.0, 1.0) in everything and len(everything) == 4


def test_green_profile_and_dispatch(make_trips, lookup):
    trips = make_trips(
        *[taxi(GREEN, "1", "2", trip_type=t) for t in "1221"],
        taxi(GREEN, "1", "3", distance="4.0", trip_type="1"), taxi(GREEN, "1", "3", pay="2"),
        taxi(GREEN, "2", "2", pay="2"), taxi(GREEN, "1", "2", distance=".00"),
    )
    first = ("2018-08-01", "05", "10001")
    assert rows(taxi_profile(trips, lookup, GREEN)) == [
        (*first, "10002", 4, 4, 1.0, 1.0, 0.5), (*first, "10003", 2, 1, 0.5, 2.5, 0.0),
    ]
    literal = taxi_profile(trips, lookup, GREEN, literal_dispatch=True)
    assert {r[0] for r in literal.select("green_dispatch_percent").collect()} == {1.0}


@pytest.fixture()
def three(make_trips):
    """Cells 1->1, 1->2 ... present in every combination of modes."""
    bikes = make_trips(*[bike("1", e) for e in ("1", "2", "3")], bike("2", "1"), bike("3", "3", "Customer"))
    yellow = make_trips(*[taxi(YELLOW, "1", e) for e in ("1", "2")], taxi(YELLOW, "2", "2"), taxi(YELLOW, "3", "2"))
    green = make_trips(taxi(GREEN, "1", "1"), taxi(GREEN, "1", "3"), taxi(GREEN, "3", "2"),
                       taxi(GREEN, "2", "3"), taxi(GREEN, "3", "3", pay="2"))
    return bikes, yellow, green


def test_multimodal_profile(three, lookup):
    table = multimodal_profile(*three, lookup, lookup)
    assert table.columns == COLUMNS
    present = {
        (r.start_zip[-1], r.end_zip[-1]): "".join(
            m[0] for m in MODES if r[f"{m}_trip_count"] is not None
        )
        for r in table.collect()
    }
    assert present == {
        ("1", "1"): "byg", ("1", "2"): "by", ("1", "3"): "bg", ("2", "1"): "b", ("2", "2"): "y",
        ("2", "3"): "g", ("3", "2"): "yg",
    }
    inner = multimodal_profile(*three, lookup, lookup, how="inner")
    assert rows(inner, "start_zip", "end_zip") == [("10001", "10001")]
    assert multimodal_profile(*three, lookup, lookup, keep_zero_share=True).count() == 8
    with pytest.raises(ValueError):
        multimodal_profile(*three, lookup, lookup, how="left")


@pytest.mark.parametrize("how", ["full", "inner"])
@pytest.mark.parametrize("keep", [False, True])
def test_one_aggregate_equals_joined_profiles(three, lookup, how, keep):
    bikes, yellow, green = three
    joined = join_profiles(
        bike_profile(bikes, lookup, keep_zero_share=keep),
        taxi_profile(yellow, lookup, YELLOW, keep_zero_share=keep),
        taxi_profile(green, lookup, GREEN, keep_zero_share=keep),
        how,
    )
    fused = multimodal_profile(*three, lookup, lookup, how=how, keep_zero_share=keep)
    assert joined.columns == fused.columns and joined.dtypes == fused.dtypes
    assert rows(joined) == rows(fused)


def test_one_aggregate_equals_separate_aggregates_joined(spark):
    """The count, part and mean of each cell, counted on their own and joined."""
    located = located_trips(d.trips(spark, SF_DIR), *d.lookups(spark, SF_DIR)).cache()
    cell = ["time_cell", "start_zip", "end_zip"]

    def counted(df, name):
        return df.groupBy(*cell).agg(F.count("*").alias(name))

    for mode, part, measure in (
        (BIKE, F.col("usertype") == "Subscriber", "duration"),
        (YELLOW, F.col("payment_type") == "1", "distance"),
        (GREEN, F.col("payment_type") == "1", "distance"),
    ):
        trips = located.where(F.col("mode") == mode)
        apart = (
            counted(trips, "trips").join(counted(trips.where(part), "part"), cell)
            .join(trips.groupBy(*cell).agg(F.avg(measure).alias("mean")), cell)
        )
        if mode == BIKE:
            mean = F.floor(F.col("mean") / 60 * 100 + 0.5) / 100
            expected = apart.select(*cell, "trips", F.col("part") / F.col("trips"), mean)
        else:
            expected = apart.select(*cell, "trips", "part", F.col("part") / F.col("trips"), "mean")
        profile = mode_profile(located, mode)
        if mode == GREEN:
            profile = profile.drop("green_dispatch_percent")
        hour = F.when(F.col("hour") != "-1", F.col("hour"))
        found = profile.select(F.concat_ws(" ", "date", hour), *profile.columns[2:])
        assert rows(found) == rows(expected)
    located.unpersist()


def test_grain_is_one_row_per_cell(spark):
    located = located_trips(d.trips(spark, SF_DIR), *d.lookups(spark, SF_DIR))
    table = multimodal_profile_of(located, keep_zero_share=True)
    assert table.groupBy(*CELL_KEYS).count().where("count > 1").isEmpty()
    totals = table.agg(*[F.sum(f"{m}_trip_count").alias(m) for m in MODES]).first().asDict()
    assert totals == {r["mode"]: r["count"] for r in located.groupBy("mode").count().collect()}
    assert cell_counts(located).agg(F.sum("trip_count")).first()[0] == sum(totals.values())


def test_profile_plan_shuffles_trips_once(spark):
    """Between the located trips and the result: one exchange, whole-stage code, no join."""
    located = located_trips(d.trips(spark, SF_DIR), *d.lookups(spark, SF_DIR))

    def exchanges(df):
        return plan(df).count("Exchange hashpartitioning(")

    assert exchanges(multimodal_profile_of(located)) == exchanges(located) + 1


def test_merged_modes_need_no_further_shuffle(three, lookup, spark):
    """One exchange per mode; none for putting the modes side by side."""
    text = plan(multimodal_profile(*three, lookup, lookup))
    assert text.count("Exchange hashpartitioning(time_cell") == 3
    assert "Join" not in text.replace("BroadcastHashJoin", "")


def test_mode_tables(make_trips, lookup):
    located = located_trips(
        make_trips(bike("1", "2"), taxi(YELLOW, "1", "2"), taxi(GREEN, "1", "2", trip_type="2")), lookup
    )
    tables = mode_tables(located)
    cell, zips = "2018-08-01 05", ("10001", "10002")
    assert tables[BIKE].columns == [
        "starttime", "start station id", "end station id", "count", "sub_count", "sub_percent",
        "hour", "date", "avg(tripduration)",
    ]
    assert rows(tables[BIKE]) == [(cell, *zips, 1, 1, 1.0, "05", "2018-08-01", 1.0)]
    assert tables[YELLOW].columns == [
        "tpep_pickup_datetime", "PULocationID", "DOLocationID", "yellow_count",
        "yellow_cc_percent", "hour", "date", "yellow_avg_dist",
    ]
    assert rows(tables[YELLOW]) == [(cell, *zips, 1, 1.0, "05", "2018-08-01", 1.0)]
    assert tables[GREEN].columns == [
        "lpep_pickup_datetime", "PULocationID", "DOLocationID", "green_count",
        "green_cc_percent", "hour", "date", "green_avg_dist", "dispatch_count", "dispatch_percent",
    ]
    assert rows(tables[GREEN]) == [(cell, *zips, 1, 1.0, "05", "2018-08-01", 1.0, 1, 1.0)]


def test_destinations(make_trips, lookup):
    bikes = make_trips(
        *[bike("1", "2", duration=60.0)] * 3, bike("1", "2", "Customer", 120.0, "2018-08-01 06:00:00"),
        bike("2", "2"),
    )
    yellow = make_trips(taxi(YELLOW, "1", "2", distance="2.0"), taxi(YELLOW, "1", "2", "2", "4.0"))
    green = make_trips(taxi(GREEN, "1", "3", trip_type="2"), taxi(GREEN, "1", "3", trip_type="1"))
    profile = multimodal_profile(bikes, yellow, green, lookup, lookup, keep_zero_share=True)
    found = {r.end_zip: r for r in destinations_from(profile, "10001").collect()}
    assert set(found) == {"10002", "10003"}
    r = found["10002"]
    assert (r.travellers, r.bike_share, r.green_share) == (6, 4 / 6, 0.0)
    assert (r.subscriber_share, r.bike_minutes) == (0.75, 1.25)
    assert (r.yellow_card_share, r.yellow_distance, r.dispatch_share) == (0.5, 3.0, None)
    assert found["10003"].dispatch_share == 0.5 and found["10003"].subscriber_share is None
    one = destinations_from(profile, "10001", "2018-08-01", "06").collect()
    assert [(x.end_zip, x.travellers) for x in one] == [("10002", 1)]
    assert destinations_from(profile, "10001", ("2018-08-02", "2018-08-09"), ["05"]).isEmpty()


def test_golden_counts(make_trips, lookup, spark):
    zero = prepare_lookup(spark.createDataFrame([("1", "10001"), ("2", "0")], "id string, zip string"))
    sample = make_trips(
        bike("1", "2"), bike("1", "9"), bike("8", "9"), bike("2", "1", pickup="8/1/2018 5:00"),
        bike("1", "1", pickup=None),
    )
    assert rows(golden_counts(sample, zero)) == [
        ("00000100012018-08-015", 1), ("10001000002018-08-0105", 2),
    ]


def test_keys_need_five_digit_zips(spark, make_trips):
    short = prepare_lookup(spark.createDataFrame([("1", "1000")], "id string, zip string"))
    sample = make_trips(bike("1", "1"))
    profile = bike_profile(sample, short, keep_zero_share=True)
    golden = golden_counts(sample, short)
    with pytest.raises(Exception, match="five characters"):
        audit_counts(profile, golden).collect()
    with pytest.raises(Exception, match="cannot slice"):
        audit_counts(profile.limit(0), golden, hour="05").collect()


@pytest.mark.parametrize("broken", ["time", "lookup"])
def test_the_recount_sees_faults_of_the_profile(make_trips, lookup, monkeypatch, broken):
    sample = make_trips(bike("1", "2"), bike("2", "1"), bike("1", "1", pickup="8/1/2018 5:00"))
    golden = golden_counts(sample, lookup)
    if broken == "time":
        clean = sys.modules["tripweave.operators.clean"]
        right = clean.with_time_cell
        monkeypatch.setattr(clean, "with_time_cell", lambda trips, pad_hour=False: right(
            trips.withColumn("pickup", F.replace("pickup", F.lit("05:"), F.lit("06:"))), pad_hour))
    else:
        locate = sys.modules["tripweave.operators.locate"]
        right_zip = locate.add_zip
        monkeypatch.setattr(locate, "add_zip", lambda trips, lookup, end: right_zip(
            trips.withColumn(f"{end}_id", F.lit("2")), lookup, end))
    profile = bike_profile(sample, lookup, keep_zero_share=True)
    assert not audit_counts(profile, golden, only_differences=True).isEmpty()


def test_two_modes_take_one_scan_and_an_audited_hour_one_month(spark):
    def pushed(name):
        df = QUERIES[name](spark, SF_DIR)
        explain = df._sc._jvm.PythonSQLUtils.explainString
        lines = explain(df._jdf.queryExecution(), "formatted").split("\n")
        return [x for x in lines if "PushedFilters" in x and "l_returnflag" in x]

    for name in ("card_share", "mean_trip_distance"):
        assert len(pushed(name)) == 1
    scans = pushed("audit_hour")
    assert scans and all("GreaterThanOrEqual(l_shipdate,1997-03-01" in x for x in scans)


def test_audit(spark, make_trips, lookup):
    sample = make_trips(
        *[bike("1", "2", "Customer")] * 2, bike("2", "1"), bike("8", "9"),
        bike("1", "3", pickup="2018-08-02 05:00:00"),
    )
    profile = bike_profile(sample, lookup, keep_zero_share=True)
    golden = golden_counts(sample, lookup)
    assert {r.delta for r in audit_counts(profile, golden).collect()} == {0}
    assert audit_counts(profile, golden).count() == 3
    assert audit_counts(profile, golden, "2018-08-01", "05").count() == 2
    assert audit_counts(profile, golden, hour="05").count() == 3
    assert audit_counts(profile, golden, date="2018-08-02").count() == 1
    assert audit_counts(profile, golden, only_differences=True).isEmpty()

    key = "10001100022018-08-0105"
    altered = golden.withColumn("count", F.when(F.col("key") == key, 5).otherwise(F.col("count")))
    lost = altered.where(F.col("key") != "10002100012018-08-0105")
    extra = lost.unionByName(
        spark.createDataFrame([("10003100032018-08-0105", 4), ("00000000002018-08-0105", 9)], golden.schema)
    )
    assert rows(audit_counts(profile, extra, "2018-08-01", "05", only_differences=True)) == [
        (key, -3), ("10002100012018-08-0105", 1), ("10003100032018-08-0105", -4),
    ]


def test_refresh_lookup(spark):
    columns = "id string, zip string, lat double, lon double"
    known = spark.createDataFrame(
        [("kept", "10001", 40.0, -74.0), ("blank", "", 40.5, -74.0), ("gone", "10002", 41.0, -74.0),
         ("lost", "", 41.0, -74.0)], columns,
    )
    feed = spark.createDataFrame(
        [("kept", "K", 99.0, 99.0), ("blank", "B", 40.9, -74.0), ("new", "N", 40.1, -74.0),
         ("new", "N", 40.1, -74.0)], "id string, name string, lat double, lon double",
    )
    assert rows(refresh_lookup(feed, known)) == [
        ("blank", "10002", 40.9, -74.0), ("gone", "10002", 41.0, -74.0),
        ("kept", "10001", 40.0, -74.0), ("new", "10001", 40.1, -74.0),
    ]
    places = spark.createDataFrame([(40.1, -74.0, "10077")], "lat double, lon double, zip string")
    assert ("new", "10077", 40.1, -74.0) in rows(refresh_lookup(feed, known, places))


def test_zone_lookup(spark):
    vertices = spark.createDataFrame([(0, 1.0, 1.0), (1, 3.0, 3.0), (2, 9.0, 9.0)], "id long, lat double, lon double")
    ranges = spark.createDataFrame([(1, 0, 2), (2, 2, 3)], "zone int, lo long, hi long")
    places = spark.createDataFrame([(2.0, 2.5, "10001"), (8.0, 9.0, "10002")], "lat double, lon double, zip string")
    assert rows(zone_lookup(vertices, ranges, places)) == [("1", "10001", 2.0, 2.0), ("2", "10002", 9.0, 9.0)]
