import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tripweave import sinks, sources
from tripweave.operators import latest_zip, zone_ranges
from tripweave.schemas import (
    BIKE_COLUMNS, GREEN, GREEN_POINT_COLUMNS, TRIP_COLUMNS, YELLOW_POINT_COLUMNS, YELLOW_ZONE_COLUMNS,
)


def bike_line(duration="60", time="2018-08-01 00:00:07", start="72", end="79", user="Subscriber", year="1980"):
    return ",".join(
        [duration, time, time, start, "A st", "40.7", "-73.9", end, "B st", "40.7", "-73.9",
         "17", user, year, "1"]
    )


@pytest.fixture()
def bike_files(tmp_path):
    header = ",".join(BIKE_COLUMNS)
    (tmp_path / "a.csv").write_text(
        "\r\n".join([header, bike_line(), bike_line(year="\\N"), bike_line(year="")]) + "\r\n"
    )
    quoted = ",".join(f'"{x}"' for x in bike_line(duration="61.5").split(","))
    (tmp_path / "b.csv").write_text(
        "\n".join(
            [",".join(f'"{c}"' for c in BIKE_COLUMNS), quoted, "60,2018-08-01 00:00:07,short", bike_line() + ",extra"]
        )
    )
    return str(tmp_path)


def test_bike_files_drop_headers_and_malformed_rows(spark, bike_files):
    raw = sources.read_bike_csv(spark, bike_files)
    assert raw.columns == BIKE_COLUMNS
    assert dict(raw.dtypes)["tripduration"] == "double" and dict(raw.dtypes)["birth year"] == "int"
    assert rows(raw, "tripduration", "birth year") == [(60.0, 1980), (60.0, None), (61.5, 1980)]


@pytest.mark.parametrize("pruning", ["true", "false"])
def test_dropped_rows_do_not_depend_on_the_columns_read(spark, bike_files, pruning):
    spark.conf.set("spark.sql.csv.parser.columnPruning.enabled", pruning)
    try:
        raw = sources.read_bike_csv(spark, bike_files)
        assert raw.select("usertype").count() == raw.select("tripduration").count() == raw.count() == 3
        assert raw.groupBy("start station id").count().collect()[0]["count"] == 3
    finally:
        spark.conf.unset("spark.sql.csv.parser.columnPruning.enabled")


def test_bike_sample_with_header(spark, tmp_path):
    path = tmp_path / "sample.csv"
    path.write_text("\n".join([",".join(BIKE_COLUMNS), bike_line(), bike_line(start="72", end="")]))
    trips = sources.read_bike_trips(spark, str(path), header=True)
    assert trips.columns == TRIP_COLUMNS
    assert rows(trips, "mode", "start_id", "end_id", "duration") == [
        ("bike", "72", "79", 60.0), ("bike", "72", None, 60.0),
    ]


def taxi_file(path, columns, *records):
    lines = [",".join(columns)]
    lines += [",".join(r.get(c, "0") for c in columns) for r in records]
    path.write_text("\r\n".join(lines) + "\r\n")
    return str(path)


def test_taxi_layouts(spark, tmp_path):
    zones = taxi_file(
        tmp_path / "new.csv", YELLOW_ZONE_COLUMNS,
        {"tpep_pickup_datetime": "2018-08-01 05:00:00", "PULocationID": "7", "DOLocationID": "264",
         "trip_distance": ".00", "payment_type": "1"},
    )
    points = taxi_file(
        tmp_path / "old.csv", YELLOW_POINT_COLUMNS,
        {"tpep_pickup_datetime": "2015-08-01 05:00:00", "trip_distance": "1.2", "payment_type": "2"},
    )
    both = sources.all_trips(
        sources.read_taxi_trips(spark, zones, layout="yellow_zones"),
        sources.read_taxi_trips(spark, points, layout="yellow_points"),
    )
    assert rows(both, "mode", "start_id", "end_id", "distance", "payment_type") == [
        ("yellow", "7", "264", ".00", "1"), ("yellow", None, None, "1.2", "2"),
    ]
    by_header = sources.read_taxi_csv(spark, zones)
    assert by_header.columns == YELLOW_ZONE_COLUMNS
    assert {t for _, t in by_header.dtypes} == {"string"}


GREEN_LEAST = ["lpep_pickup_datetime", "PULocationID", "DOLocationID", "trip_distance", "payment_type", "trip_type"]


def test_taxi_names_in_any_letter_case(spark, tmp_path):
    names = ["LPEP_pickup_datetime", " PULocationID", "DOLocationID ", "Trip_distance", "Payment_type", "Trip_type "]
    (tmp_path / "a.csv").write_text(",".join(names) + "\n2018-08-01 05:00:00, 7 ,8,1.5,1,2\n")
    (tmp_path / "b.csv").write_text(",".join(n.upper() for n in names) + "\n2018-08-01 05:00:00,7,8,2.5,1,2\n")
    trips = sources.read_taxi_trips(spark, str(tmp_path), GREEN)
    assert rows(trips, "start_id", "end_id", "distance", "payment_type", "trip_type") == [
        ("7", "8", "1.5", "1", "2"), ("7", "8", "2.5", "1", "2"),
    ]


@pytest.mark.parametrize("lost", ["lpep_pickup_datetime", "trip_distance", "payment_type", "trip_type"])
def test_a_missing_column_stops_the_read(spark, tmp_path, lost):
    columns = [c for c in GREEN_LEAST if c != lost]
    path = taxi_file(tmp_path / "a.csv", columns, {})
    with pytest.raises(ValueError, match=lost):
        sources.read_taxi_trips(spark, path, GREEN)


@pytest.mark.parametrize("layout", ["header", "yellow_zones", "yellow_points"])
def test_a_folder_of_two_layouts_stops_the_read(spark, tmp_path, layout):
    for name, columns in (("a.csv", YELLOW_ZONE_COLUMNS), ("b.csv", YELLOW_POINT_COLUMNS)):
        taxi_file(tmp_path / name, columns, *[{"trip_distance": "1.5"}] * 10)
    with pytest.raises(Exception, match="(?i)header"):
        sources.read_taxi_trips(spark, str(tmp_path), layout=layout).collect()


def test_swapped_columns_stop_the_read(spark, tmp_path):
    swapped = list(YELLOW_ZONE_COLUMNS)
    i, j = swapped.index("trip_distance"), swapped.index("passenger_count")
    swapped[i], swapped[j] = swapped[j], swapped[i]
    path = taxi_file(tmp_path / "a.csv", swapped, {"trip_distance": "1.5"})
    with pytest.raises(Exception, match="(?i)header"):
        sources.read_taxi_trips(spark, path, layout="yellow_zones").collect()


def test_older_green_layout(spark, tmp_path):
    path = taxi_file(tmp_path / "a.csv", GREEN_POINT_COLUMNS, {
        "lpep_pickup_datetime": "2015-01-01 05:00:00", "Trip_distance": "1.5", "Payment_type": "1", "Trip_type": "2",
    })
    trips = sources.read_taxi_trips(spark, path, GREEN, layout="green_points")
    assert rows(trips, "start_id", "distance", "payment_type", "trip_type") == [(None, "1.5", "1", "2")]


def test_malformed_rows_are_counted(spark, bike_files, tmp_path):
    assert rows(sources.malformed_rows(spark, bike_files, "bike")) == [("bike", 8, 2, 3)]
    path = tmp_path / "green.csv"
    path.write_text(",".join(GREEN_LEAST) + "\n\n2018-08-01 05:00:00,1,2,0.5,1,2\n2018-08-01 05:00:00,1\n")
    assert rows(sources.malformed_rows(spark, str(path), GREEN)) == [("green", 2, 1, 0)]
    assert sources.read_bike_csv(spark, bike_files).count() == 8 - 2 - 3


def test_malformed_taxi_rows(spark, tmp_path):
    columns = ["lpep_pickup_datetime", "PULocationID", "DOLocationID", "trip_distance", "payment_type", "trip_type"]
    path = tmp_path / "green.csv"
    path.write_text(
        ",".join(columns) + "\n\n2018-08-01 05:00:00,1,2,0.5,1,2\n2018-08-01 05:00:00,1\n"
    )
    dropped = sources.read_taxi_trips(spark, str(path), GREEN, layout=columns)
    kept = sources.read_taxi_trips(spark, str(path), GREEN, layout=columns, drop_malformed=False)
    assert dropped.count() == dropped.select("start_id").count() == 1
    assert rows(kept, "start_id", "end_id", "trip_type") == [("1", "2", "2"), ("1", None, None)]


def test_lookup_of_two_files_keeps_the_last_line(spark, tmp_path):
    (tmp_path / "1.csv").write_text("stationId,zipcode,lat,long\r\n72,10019,40.7,-73.9\r\n79,,40.7,-74.0\r\n72,10020,40.7,-73.9\r\n")
    (tmp_path / "2.csv").write_text("stationId,zipcode,lat,long\r\n82,07302,40.7,-74.0\r\n")
    lookup = sources.read_zip_lookup(spark, str(tmp_path))
    assert rows(latest_zip(lookup)) == [("72", "10020"), ("79", None), ("82", "07302")]
    known = sources.read_known_points(spark, str(tmp_path))
    assert rows(known, "id", "zip", "lat") == [("72", "10020", 40.7), ("82", "07302", 40.7)]


def test_lookup_round_trip(spark, tmp_path):
    lookup = spark.createDataFrame([("7", "00501", 40.5, -74.25), ("8", "", 40.0, -74.0)], "id string, zip string, lat double, lon double")
    sinks.write_lookup(lookup, str(tmp_path / "z"), "zone")
    text = "".join(p.read_text() for p in (tmp_path / "z").glob("part-*"))
    assert text.startswith("zoneId,zipcode,lat,long\n")
    assert rows(sources.read_known_points(spark, str(tmp_path / "z"), "zone")) == [("7", "00501", 40.5, -74.25)]


def test_station_feed(spark, tmp_path):
    path = tmp_path / "feed.json"
    stations = [{"station_id": "72", "name": "A", "lat": 40.7, "lon": -73.9, "capacity": 39},
                {"station_id": "79", "name": "B", "lat": 40.8, "lon": -74.0}]
    path.write_text(json.dumps({"last_updated": 1, "data": {"stations": stations}}, indent=2))
    assert rows(sources.read_station_feed(spark, str(path))) == [
        ("72", "A", 40.7, -73.9), ("79", "B", 40.8, -74.0),
    ]


def test_zone_shapes(spark, tmp_path):
    rings = tmp_path / "rings.csv"
    rings.write_text("x,zone,y,ring\n0,1,a,0,1,2,3,NA,9\n1,2,a,4,5,6,NA\n2,2,a,7,8,9\n3,3,a,NA\n")
    assert rows(sources.read_zone_rings(spark, str(rings))) == [(1, 0, 3), (2, 4, 6), (2, 7, 9)]
    assert rows(zone_ranges(sources.read_zone_rings(spark, str(rings)))) == [(1, 0, 4), (2, 4, 10)]
    vertices = tmp_path / "vertices.csv"
    vertices.write_text("id,lat,long\n0,40.5,-74.0\n1,40.25,-73.5\n")
    assert rows(sources.read_zone_vertices(spark, str(vertices))) == [(0, 40.5, -74.0), (1, 40.25, -73.5)]


def test_golden_round_trip(spark, tmp_path):
    golden = spark.createDataFrame([("10001100022019-06-0100", 3)], "key string, count long")
    sinks.write_golden(golden, str(tmp_path / "g"))
    back = sources.read_golden(spark, str(tmp_path / "g"))
    assert back.dtypes == [("key", "string"), ("count", "bigint")]
    assert rows(back) == [("10001100022019-06-0100", 3)]
    (tmp_path / "bad.csv").write_text("key,count\nk,many\n")
    with pytest.raises(Exception):
        sources.read_golden(spark, str(tmp_path / "bad.csv")).collect()


def test_table_round_trip_prunes_dates_and_keeps_them_text(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame(
        [("2018-08-01", "00", 1), ("2018-08-01", "1", 2), ("2018-08-02", "00", 3)],
        "date string, hour string, bike_trip_count long",
    )
    sinks.write_table(df, path)
    sinks.write_table(df, path)  # overwrite
    back = sources.read_table(spark, path)
    assert dict(back.dtypes) == {"date": "string", "hour": "string", "bike_trip_count": "bigint"}
    day = back.where(F.col("date") == "2018-08-01")
    assert rows(day, "date", "hour", "bike_trip_count") == [("2018-08-01", "00", 1), ("2018-08-01", "1", 2)]
    assert len(day.inputFiles()) < len(back.inputFiles()) or "PartitionFilters: [isnotnull(date" in (
        day._sc._jvm.PythonSQLUtils.explainString(day._jdf.queryExecution(), "formatted")
    )


def test_written_files_are_sorted_by_start_and_hour(spark, tmp_path):
    df = spark.range(0, 2_000, 1, 4).select(
        F.concat(F.lit("2018-08-0"), F.col("id") % 3 + 1).alias("date"),
        (F.col("id") * 7 % 24).cast("string").alias("hour"),
        (F.lit(10_000) + F.col("id") * 37 % 101).cast("string").alias("start_zip"),
    )
    sinks.write_table(df, str(tmp_path / "t"))
    files = list((tmp_path / "t").glob("date=*/*.parquet"))
    assert len(files) >= 3
    for file in files:
        found = [(r.start_zip, r.hour) for r in spark.read.parquet(str(file)).collect()]
        assert found == sorted(found)


def test_audit_log(spark, tmp_path):
    deltas = spark.createDataFrame([("k1", 0), ("k2", -3)], "key string, delta long")
    sinks.write_audit_log(deltas, str(tmp_path / "log"), files=1)
    parts = list((tmp_path / "log").glob("part-*"))
    assert len(parts) == 1
    assert sorted(parts[0].read_text().split("\n")) == ["", "k1 0", "k2 -3"]


class FakeJdbc:
    """Stands in for a reader or a writer and notes the options it is given."""

    def __init__(self):
        self.given = {}
        self.read = self.write = self

    def format(self, name):
        self.given["format"] = name
        return self

    def mode(self, name):
        self.given["mode"] = name
        return self

    def option(self, key, value):
        self.given[key] = value
        return self

    def options(self, **more):
        self.given.update(more)
        return self

    def load(self):
        return self

    def save(self):
        return self


def test_jdbc_options():
    """No database is started here: only the options are checked."""
    fake = FakeJdbc()
    slice_ = "date = '2019-06-01' and hour = '00' and bike_trip_count > 0"
    sources.read_table_jdbc(fake, "jdbc:x", "profile", {"user": "u"}, where=slice_)
    assert fake.given == {
        "format": "jdbc", "url": "jdbc:x", "user": "u",
        "dbtable": f"(select * from profile where {slice_}) as slice",
    }
    fake = FakeJdbc()
    sinks.write_table_jdbc(fake, "jdbc:x", "profile", {"batchsize": "10000"})
    assert fake.given == {
        "format": "jdbc", "mode": "overwrite", "url": "jdbc:x", "dbtable": "profile",
        "batchsize": "10000",
    }
