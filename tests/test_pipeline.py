"""Raw files in, stored profile, destinations and audit out."""

import pytest
from conftest import SF_DIR, rows
from pyspark.sql import functions as F

from tripweave import (
    audit_counts, bike_profile, destinations_from, golden_counts, multimodal_profile,
    multimodal_profile_of, sinks, sources,
)
from tripweave import driver_tables as d
from tripweave.operators import prepare_lookup
from tripweave.plans.profiles import located_trips
from tripweave.schemas import (
    BIKE, BIKE_COLUMNS, GREEN, GREEN_ZONE_COLUMNS, YELLOW, YELLOW_ZONE_COLUMNS,
)

TAXI = {"PULocationID": "start_id", "DOLocationID": "end_id", "trip_distance": "distance",
        "payment_type": "payment_type", "trip_type": "trip_type"}
FIELDS = {
    BIKE: (BIKE_COLUMNS, {"tripduration": "duration", "starttime": "pickup", "start station id": "start_id",
                          "end station id": "end_id", "usertype": "usertype"}),
    YELLOW: (YELLOW_ZONE_COLUMNS, {"tpep_pickup_datetime": "pickup", **TAXI}),
    GREEN: (GREEN_ZONE_COLUMNS, {"lpep_pickup_datetime": "pickup", **TAXI}),
}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Trip files in their raw layouts, each with header lines and malformed rows."""
    base = tmp_path_factory.mktemp("raw")
    trips = d.trips(spark, SF_DIR)
    for mode, (columns, fields) in FIELDS.items():
        raw = trips.where(F.col("mode") == mode).select(
            *[F.col(fields[c]).alias(c) if c in fields else F.lit("1").alias(c) for c in columns]
        )
        raw.write.option("header", True).csv(str(base / mode))
        (base / mode / "broken.csv").write_text(",".join(columns) + "\n1,2\n" + ",".join(["x"] * 40) + "\n")
    start, end = d.start_lookup_rows(spark, SF_DIR), d.end_lookup_rows(spark, SF_DIR)
    for name, rows_ in (("start", start), ("end", end)):
        located = rows_.withColumns({"lat": F.lit(40.0), "lon": F.lit(-74.0)}).orderBy("line")
        sinks.write_lookup(located.coalesce(1), str(base / name))
    return base


@pytest.fixture(scope="module")
def raw(spark, folder):
    return (
        sources.read_bike_trips(spark, str(folder / BIKE)),
        sources.read_taxi_trips(spark, str(folder / YELLOW), YELLOW, layout="yellow_zones"),
        sources.read_taxi_trips(spark, str(folder / GREEN), GREEN, layout="green_zones"),
    )


@pytest.fixture(scope="module")
def lookups(spark, folder):
    return [prepare_lookup(sources.read_zip_lookup(spark, str(folder / n))) for n in ("start", "end")]


def test_files_give_the_same_profile_as_tables(spark, raw, lookups):
    start, _ = lookups
    from_files = multimodal_profile(*raw, start, start, keep_zero_share=True)
    located = located_trips(d.trips(spark, SF_DIR), start, start)
    from_tables = multimodal_profile_of(located, keep_zero_share=True)
    assert from_files.columns == from_tables.columns
    assert rows(from_files) == rows(from_tables)


def test_stored_profile_destinations_and_audit(spark, raw, lookups, tmp_path):
    start, _ = lookups
    path = str(tmp_path / "profile")
    sinks.write_table(multimodal_profile(*raw, start, start, keep_zero_share=True), path)
    profile = sources.read_table(spark, path)
    day = profile.groupBy("date").count().orderBy(F.desc("count")).first()["date"]
    found = destinations_from(profile, "10001", day)
    expected = profile.where((F.col("date") == day) & (F.col("start_zip") == "10001"))
    assert found.agg(F.sum("travellers")).first()[0] == sum(
        sum(r[f"{m}_trip_count"] or 0 for m in (BIKE, YELLOW, GREEN)) for r in expected.collect()
    )

    golden_path = str(tmp_path / "golden")
    sinks.write_golden(golden_counts(raw[0], start), golden_path)
    golden = sources.read_golden(spark, golden_path)
    deltas = audit_counts(profile, golden, day, "01")
    assert deltas.count() > 0 and {r.delta for r in deltas.collect()} == {0}
    sinks.write_audit_log(deltas, str(tmp_path / "log"), files=1)
    lines = spark.read.text(str(tmp_path / "log"))
    assert lines.count() == deltas.count() and lines.where(~F.col("value").endswith(" 0")).isEmpty()


def test_bike_profile_from_files(spark, raw, lookups):
    start, _ = lookups
    tables = bike_profile(d.trips(spark, SF_DIR, BIKE), start)
    assert rows(bike_profile(raw[0], start)) == rows(tables)
