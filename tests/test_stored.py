"""Labelled lines, stored tables and their slices, states that merge, audits by digest."""

import math
import random
from functools import reduce

import pytest
from conftest import SF_DIR, rows
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave import driver_tables as d
from tripweave import sinks, sources
from tripweave.functions import exact_mean, exact_sum
from tripweave.operators import (
    cell_states, cells_from_states, merge_states, mode_rows, range_join,
)
from tripweave.operators.ranges import range_pieces
from tripweave.plans import audit_by_digest, audit_counts, mode_tables, multimodal_profile_of
from tripweave.plans.audit import digests
from tripweave.plans.profiles import located_trips
from tripweave.schemas import BIKE, GREEN, MODES

GREEN_COLUMNS = ["lpep_pickup_datetime", "PULocationID", "DOLocationID", "trip_distance", "payment_type", "trip_type"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def located(spark):
    return located_trips(d.trips(spark, SF_DIR), *d.lookups(spark, SF_DIR)).cache()


@pytest.fixture(scope="module")
def profile(located):
    return multimodal_profile_of(located, keep_zero_share=True)


def test_lines_are_labelled_in_one_scan(spark, tmp_path):
    path = tmp_path / "green.csv"
    path.write_text(
        ",".join(GREEN_COLUMNS) + "\n\n2018-08-01 05:00:00,1,2,0.5,1,2\n2018-08-01 05:00:00,1\n"
        "2018-08-01 06:00:00,1,2,0.5,1,2,more\n,,,,,\n"
    )
    lines = sources.read_labelled(spark, str(path), GREEN)
    assert rows(lines, "line_status", "wrong_line") == [
        ("kept", None), ("kept", None), ("wrong_width", "2018-08-01 05:00:00,1"),
        ("wrong_width", "2018-08-01 06:00:00,1,2,0.5,1,2,more"),
    ]
    assert rows(sources.malformed_lines(lines, GREEN)) == [("green", 4, 2, 0)]
    assert plan(sources.malformed_lines(lines, GREEN)).count("Scan csv") == 1
    assert rows(sources.kept_trips(lines, GREEN)) == rows(sources.read_taxi_trips(spark, str(path), GREEN))


def test_labelled_bikes(spark, tmp_path):
    from test_sources import bike_line

    (tmp_path / "a.csv").write_text("\n".join([
        bike_line(), bike_line(year="\\N"), bike_line(duration="x"), bike_line(year=""), bike_line() + ",", "60",
    ]))
    lines = sources.read_labelled(spark, str(tmp_path), BIKE)
    assert rows(sources.malformed_lines(lines, BIKE)) == [("bike", 6, 2, 2)]
    assert rows(sources.kept_trips(lines, BIKE)) == rows(sources.read_bike_trips(spark, str(tmp_path)))


def test_slices_read_only_their_folders(spark, profile, tmp_path):
    path = str(tmp_path / "profile")
    sinks.write_table(profile, path)
    found = profile.select("date", "hour").distinct().orderBy("date", "hour").collect()
    wanted = [found[0], found[len(found) // 2], found[-1]]
    for folder in (tmp_path / "profile").glob("date=*"):
        if folder.name.split("=")[1] not in {w.date for w in wanted}:
            for file in folder.glob("*.parquet"):
                file.write_bytes(b"not a table")
    slices = spark.createDataFrame([*wanted, wanted[0], ("2050-01-01", "00")], "date string, hour string")
    got = sources.read_slices(spark, path, slices)
    assert "dynamicpruning" in got._jdf.queryExecution().optimizedPlan().toString()
    expected = profile.join(spark.createDataFrame(wanted, "date string, hour string"), ["date", "hour"])
    assert rows(got, *profile.columns) == rows(expected, *profile.columns) != []
    with pytest.raises(ValueError):
        sources.read_slices(spark, path, slices.select("hour"))
    assert sources.read_slices(spark, path, slices.limit(0)).count() == 0


def test_a_late_day_replaces_its_dates_only(spark, tmp_path):
    path = tmp_path / "t"
    schema = "date string, hour string, start_zip string, n long"
    first = [("2018-08-01", "00", "1", 1), ("2018-08-02", "00", "1", 2), ("2018-08-03", "00", "1", 3)]
    sinks.write_table(spark.createDataFrame(first, schema), str(path))
    before = {f: f.stat().st_mtime_ns for f in path.glob("date=*/*.parquet")}
    late = [("2018-08-02", "00", "1", 20), ("2018-08-02", "01", "1", 21), ("2018-08-04", "00", "1", 4)]
    sinks.write_table(spark.createDataFrame(late, schema), str(path), replace="dates")
    kept = [f for f in before if "2018-08-02" not in str(f)]
    assert len(kept) == 2 and all(f.stat().st_mtime_ns == before[f] for f in kept)
    assert rows(sources.read_table(spark, str(path)), "date", "hour", "n") == [
        ("2018-08-01", "00", 1), ("2018-08-02", "00", 20), ("2018-08-02", "01", 21), ("2018-08-03", "00", 3),
        ("2018-08-04", "00", 4),
    ]
    for wrong in ({"replace": "days"}, {"replace": "dates", "partition_by": None}):
        with pytest.raises(ValueError):
            sinks.write_table(spark.createDataFrame(late, schema), str(path), **wrong)


def test_states_merge_to_the_profile_of_all_trips(located):
    parts = located.randomSplit([0.2, 0.5, 0.3], seed=4)
    for options in ({}, {"how": "inner"}, {"keep_zero_share": True}):
        want = multimodal_profile_of(located, **options)
        for states in (cell_states(located), merge_states(*map(cell_states, parts)),
                       reduce(DataFrame.unionByName, map(cell_states, parts)),
                       merge_states(merge_states(cell_states(parts[0]), cell_states(parts[2])), cell_states(parts[1]))):
            got = cells_from_states(states, **options)
            assert rows(got, *want.columns) == rows(want)


def test_sums_do_not_depend_on_the_order(spark):
    rng = random.Random(3)
    values = [rng.choice([rng.uniform(-5, 5), rng.random() * 10**rng.randrange(12), 0.1, 1 / 3]) for _ in range(4000)]
    got = set()
    for seed in range(4):
        rng.shuffle(values)
        df = spark.createDataFrame([(v,) for v in [*values, None]], "v double").repartition(seed + 1)
        got.add(tuple(df.agg(exact_sum(F.col("v")), exact_mean(F.col("v"))).first()))
    (total, mean), = got
    assert math.isclose(total, math.fsum(values), rel_tol=1e-13)
    assert mean == total / len(values)
    odd = spark.createDataFrame([(1, None), (2, 1e300), (2, 0.5), (3, math.nan), (3, 1.0), (4, -0.25)], "k int, v double")
    means = dict(map(tuple, odd.groupBy("k").agg(exact_mean(F.col("v"))).collect()))
    assert means[1] is None and means[2] == 5e299 and math.isnan(means[3]) and means[4] == -0.25


def test_mode_tables_in_one_pass(spark, located, tmp_path):
    rows_of_all = mode_rows(located)
    assert plan(rows_of_all).split("InMemory")[0].count("Exchange hash") == 1
    folder = str(tmp_path / "modes")
    sinks.write_mode_tables(rows_of_all, folder)
    for mode, want in mode_tables(located).items():
        got = sources.read_mode_table(spark, folder, mode)
        assert got.columns == want.columns
        assert rows(got) == rows(want) != []
        assert f"mode = {mode}" in plan(got) or f"mode#" in plan(got)
    assert set(MODES) == {p.name.split("=")[1] for p in (tmp_path / "modes").glob("mode=*")}


def altered(golden):
    return golden.where("key not like '10001%'").withColumn(
        "count", F.col("count") + F.when(F.col("key").like("10002%01"), 2).otherwise(0)
    )


def test_audit_by_digest(spark, profile):
    counted = profile.where("bike_trip_count > 0 and not (start_zip = '00000' and end_zip = '00000')")
    golden = counted.select(
        F.concat("start_zip", "end_zip", "date", "hour").alias("key"), F.col("bike_trip_count").alias("count")
    )
    clean = audit_by_digest(profile, golden)
    assert clean.collect() == []
    text = plan(clean)  # as it ran: no rows on either side, so no join of keys is left
    final = text[text.index("== Final Plan =="):text.index("== Initial Plan ==")] if "== Final Plan" in text else text
    assert "SortMergeJoin [key" not in final and "HashJoin [key" not in final
    want = audit_counts(profile, altered(golden), only_differences=True)
    assert rows(audit_by_digest(profile, altered(golden))) == rows(want) != []
    extra = golden.union(spark.createDataFrame([("99999" * 2 + "2018-08-0101", 3)], "key string, count long"))
    assert rows(audit_by_digest(profile, extra)) == [("99999" * 2 + "2018-08-0101", -3)]
    with pytest.raises(Exception, match="cannot slice"):
        audit_by_digest(profile, spark.createDataFrame([("short", 1)], "key string, count long")).collect()


def test_digests_see_every_change(spark):
    def of(*counts):
        df = spark.createDataFrame([("2018-08-01", "10001", k, n) for k, n in counts],
                                   "date string, start_zip string, key string, n long")
        return rows(digests(df.repartition(3)))

    base = of(("a", 1), ("b", 2))
    assert base == of(("b", 2), ("a", 1))
    for other in ([("a", 2), ("b", 1)], [("a", 1)], [("a", 1), ("b", 2), ("b", 2)], [("a", 1), ("c", 2)]):
        assert of(*other) != base


def test_long_ranges_make_few_pieces(spark):
    ranges = [(1, 5, 10**9 + 5), (2, -(2**62), 2**62), (3, 1023, 1025), (4, 7, 7), (5, 0, 1024), (6, -3, 2)]
    df = spark.createDataFrame(ranges, "zone int, lo long, hi long")
    number = dict(map(tuple, range_pieces(df).groupBy("zone").count().collect()))
    assert number[1] < 100 and number[2] < 110 and number[3] == 1 and 4 not in number and number[5] == 1
    ids = [-(2**62) - 1, -(2**62), -4, -3, -1, 0, 1, 2, 4, 5, 6, 1023, 1024, 1025, 10**9, 10**9 + 4, 10**9 + 5,
           2**62 - 1, 2**62]
    rows_ = spark.createDataFrame([(i,) for i in ids], "id long")
    for bucket in (1, 16, 1024):
        assert rows(range_join(rows_, df, bucket), "id", "zone") == sorted(
            ((i, z) for i in ids for z, lo, hi in ranges if lo <= i < hi), key=lambda r: tuple(map(repr, r))
        )
    with pytest.raises(ValueError):
        range_pieces(df, 1000)
    assert range_join(rows_, df.limit(0)).count() == 0
