"""The named queries: each takes (spark, folder of the test tables) and gives a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import driver_tables as d
from .functions import (
    bike_time_cell, cell_date, cell_hour, minutes, number, share, taxi_time_cell,
)
from .operators import (
    MODE_COLUMNS, cell_counts, cell_states, cells_from_states, dropped_trips, locate, locate_points,
    merge_states, mode_cells, mode_rows, nearest_zip, prepare_cover, range_join, ring_edges,
    taxi_cells, zone_means, zone_ranges,
)
from .operators.cells import merged_mode_cells
from .plans import (
    audit_by_digest, audit_counts, destinations_from, golden_counts, join_profiles, mode_profile, mode_tables,
    multimodal_profile_of, refresh_lookup, zone_lookup,
)
from .plans.profiles import located_trips
from .schemas import BIKE, BIKE_COLUMNS, CELL_KEYS, GREEN, MODES, TAXI_LAYOUTS, TRIP_COLUMNS, YELLOW
from .shared import new_folder
from .sinks import write_golden, write_mode_tables, write_table
from .sources import read_golden, read_mode_table, read_slices, read_table
from .sources.trips import (
    all_trips, bike_trips, kept_trips, malformed_rows, read_labelled, taxi_point_trips, taxi_trips,
    typed_bike,
)

Query = Callable[[SparkSession, str], DataFrame]


def _located(spark: SparkSession, sf_dir: str, *modes: str, **cleaning) -> DataFrame:
    return located_trips(d.trips(spark, sf_dir, *modes), *d.lookups(spark, sf_dir), **cleaning)


def bike_time_cells(spark, sf_dir):
    cell = bike_time_cell(F.col("pickup"))
    return (
        d.trips(spark, sf_dir, BIKE)
        .groupBy("pickup", cell.alias("time_cell")).agg(F.count(F.lit(1)).alias("trips"))
        .select("pickup", "time_cell", cell_date(F.col("time_cell")).alias("date"),
                cell_hour(F.col("time_cell")).alias("hour"), "trips")
    )


def taxi_time_cells(spark, sf_dir):
    cell = taxi_time_cell(F.col("pickup"))
    return (
        d.trips(spark, sf_dir, YELLOW, GREEN)
        .groupBy("pickup", cell.alias("time_cell")).agg(F.count(F.lit(1)).alias("trips"))
        .select("pickup", "time_cell", cell_date(F.col("time_cell")).alias("date"),
                cell_hour(F.col("time_cell")).alias("hour"), "trips")
    )


def raw_layout_trips(spark, sf_dir):
    """Trips read from raw columns of all file layouts, counted by all their fields."""
    raw = d.raw_trips(spark, sf_dir)
    parts = [bike_trips(typed_bike(raw.pop("bike")))]
    parts += [taxi_trips(df, layout.split("_")[0]) for layout, df in raw.items()]
    return all_trips(*parts).groupBy(*TRIP_COLUMNS).agg(F.count(F.lit(1)).alias("trips"))


def raw_files_trips(spark, sf_dir):
    """Trips read back from raw files with spoilt lines, counted by all their fields."""
    paths = d.write_raw_files(spark, sf_dir, new_folder(spark, "raw"))
    parts = [
        kept_trips(read_labelled(spark, path, mode := layout.split("_")[0],
                                 layout=TAXI_LAYOUTS.get(layout, BIKE_COLUMNS), header=True), mode)
        for layout, path in paths.items()
    ]
    return all_trips(*parts).groupBy(*TRIP_COLUMNS).agg(F.count(F.lit(1)).alias("trips"))


def malformed_file_lines(spark, sf_dir):
    """How many lines of the same files are left out, and why, per layout."""
    paths = d.write_raw_files(spark, sf_dir, new_folder(spark, "raw"))
    parts = [
        malformed_rows(spark, path, layout.split("_")[0], layout=TAXI_LAYOUTS.get(layout, "header"),
                       header=True).withColumn("layout", F.lit(layout))
        for layout, path in paths.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def point_trips_zip(spark, sf_dir, **limits):
    """Zips of taxi trips whose files have points and no location ids, by the zone a point lies in."""
    raw = d.raw_trips(spark, sf_dir)
    trips = [taxi_point_trips(raw[f"{mode}_points"], mode) for mode in (YELLOW, GREEN)]
    cover = prepare_cover(ring_edges(*d.zone_shapes(spark, sf_dir)), **limits)
    zoned = locate_points(reduce(DataFrame.unionByName, trips), cover)
    located = locate(zoned, d.lookups(spark, sf_dir)[0])
    return located.groupBy("mode", "start_id", "start_zip", "end_id", "end_zip").agg(
        F.count(F.lit(1)).alias("trips")
    )


def zip_lookup(spark, sf_dir, **limits):
    """Trips per location and the zip found for it, from a lookup with superseded rows."""
    located = locate(d.trips(spark, sf_dir), *d.lookups(spark, sf_dir, **limits))
    return located.groupBy("start_id", "start_zip", "end_id", "end_zip").agg(
        F.count(F.lit(1)).alias("trips")
    )


def taxi_distance_clean(spark, sf_dir):
    taxi = d.trips(spark, sf_dir, YELLOW, GREEN)
    return (
        taxi.where(F.col("distance") != ".00")
        .groupBy("mode", F.col("distance").alias("distance_text"))
        .agg(F.count(F.lit(1)).alias("trips"))
        .withColumn("trip_distance", number(F.col("distance_text")))
    )


def dropped(spark, sf_dir):
    return dropped_trips(d.trips(spark, sf_dir, bad_distances=True))


def without_bad_distances(spark, sf_dir):
    """The multimodal profile of trips of which some distances are no numbers."""
    trips = d.trips(spark, sf_dir, bad_distances=True)
    return multimodal_profile_of(
        located_trips(trips, *d.lookups(spark, sf_dir), on_bad_number="drop")
    )


def trips_per_cell(spark, sf_dir):
    return cell_counts(_located(spark, sf_dir))


def subscriber_share(spark, sf_dir):
    return mode_cells(_located(spark, sf_dir, BIKE), BIKE).select(
        *CELL_KEYS, F.col("trips").alias("trip_count"), F.col("part").alias("sub_count"),
        share(F.col("part"), F.col("trips")).alias("sub_percent"),
    )


def card_share(spark, sf_dir):
    return taxi_cells(_located(spark, sf_dir, YELLOW, GREEN)).select(
        "mode", *CELL_KEYS, F.col("trips").alias("trip_count"), F.col("part").alias("cc_count"),
        share(F.col("part"), F.col("trips")).alias("cc_percent"),
    )


def dispatch_share(spark, sf_dir, literal=False):
    cells = mode_cells(
        _located(spark, sf_dir, GREEN), GREEN, keep_zero_share=True, literal_dispatch=literal
    )
    return cells.select(
        *CELL_KEYS, F.col("trips").alias("trip_count"), F.col("dispatched").alias("dispatch_count"),
        share(F.col("dispatched"), F.col("trips")).alias("dispatch_percent"),
    )


def mean_duration_minutes(spark, sf_dir):
    cells = mode_cells(_located(spark, sf_dir, BIKE), BIKE, keep_zero_share=True)
    return cells.select(*CELL_KEYS, minutes(F.col("mean")).alias("bike_duration"))


def mean_trip_distance(spark, sf_dir):
    cells = taxi_cells(_located(spark, sf_dir, YELLOW, GREEN), keep_zero_share=True)
    return cells.select("mode", *CELL_KEYS, F.col("mean").alias("trip_distance_avg"))


def profile(spark, sf_dir, mode, **options):
    return mode_profile(_located(spark, sf_dir, mode), mode, **options)


def multimodal(spark, sf_dir, how="full", pad_hour=False, min_distance=None, **options):
    located = _located(spark, sf_dir, pad_hour=pad_hour, min_distance=min_distance)
    return multimodal_profile_of(located, how, **options)


def multimodal_joined(spark, sf_dir, how="full"):
    """The same table from three finished profiles and two joins."""
    start, end = d.lookups(spark, sf_dir)
    profiles = [
        mode_profile(located_trips(d.trips(spark, sf_dir, m), start, end), m) for m in MODES
    ]
    return join_profiles(*profiles, how=how)


def multimodal_merged(spark, sf_dir):
    """The same table from one trip table per mode, merged without a join."""
    start, end = d.lookups(spark, sf_dir)
    located = {m: located_trips(d.trips(spark, sf_dir, m), start, end) for m in MODES}
    return merged_mode_cells(located)


def stored_slices(spark, sf_dir):
    """Several dates and hours of a stored profile at once; only their folders are read."""
    path = new_folder(spark, "profile")
    write_table(multimodal(spark, sf_dir), path)
    profile = read_slices(spark, path, d.wanted_slices(spark, sf_dir))
    return profile.select(*CELL_KEYS, *[c for m in MODES for c in MODE_COLUMNS[m]])


def rewritten_dates(spark, sf_dir):
    """A stored bike profile that lacks late trips, after the dates of one year were written anew."""
    path = new_folder(spark, "profile")
    every = _located(spark, sf_dir, BIKE)
    write_table(mode_profile(every.where(F.col("duration") % 60 != 7), BIKE, keep_zero_share=True), path)
    year = every.where(cell_date(F.col("time_cell")).between("1997-01-01", "1997-12-31"))
    write_table(mode_profile(year, BIKE, keep_zero_share=True), path, replace="dates")
    return read_table(spark, path).select(*CELL_KEYS, *MODE_COLUMNS[BIKE])


def profile_from_states(spark, sf_dir):
    """The multimodal profile from the stored cell states of two batches of trips."""
    located = _located(spark, sf_dir)
    late = F.col("duration") % 60 >= 4
    stored = []
    for batch in (located.where(~late), located.where(late)):
        stored.append(new_folder(spark, "states"))
        write_table(cell_states(batch), stored[-1], sort_by=("start_zip", "time_cell"))
    return cells_from_states(merge_states(*[read_table(spark, path) for path in stored]))


def stored_mode_table(spark, sf_dir, mode):
    """One mode's table, of those that one pass over the trips of all modes has written."""
    folder = new_folder(spark, "modes")
    write_mode_tables(mode_rows(_located(spark, sf_dir)), folder)
    return read_mode_table(spark, folder, mode)


def table_of(spark, sf_dir, mode):
    return mode_tables(_located(spark, sf_dir, mode))[mode]


def destinations_from_zip(spark, sf_dir):
    trips = d.trips(spark, sf_dir, months=("1996-01", "1999-12"))
    profile = multimodal_profile_of(
        located_trips(trips, *d.lookups(spark, sf_dir)), keep_zero_share=True
    )
    return destinations_from(
        profile, "10001", ("1996-01-01", "1999-12-31"), ["1", "01", "2", "02", "3", "03", "4", "04"]
    )


def golden(spark, sf_dir, zeros=False, months=None):
    bikes = d.trips(spark, sf_dir, BIKE, months=months)
    return golden_counts(bikes, *d.lookups(spark, sf_dir, zeros))


def audit_clean(spark, sf_dir):
    """The whole bike profile against golden counts: every delta is 0."""
    return audit_counts(
        profile(spark, sf_dir, BIKE, keep_zero_share=True), golden(spark, sf_dir)
    )


def altered_golden(spark, sf_dir):
    """Golden counts with some keys lost and some counts changed."""
    start = F.substring("key", 1, 5)
    return golden(spark, sf_dir).where(start != "10002").withColumn(
        "count", F.col("count") + F.when(start == "10001", 1).otherwise(0)
    )


def audit_altered(spark, sf_dir):
    """Of altered golden counts just the altered keys show."""
    return audit_counts(
        profile(spark, sf_dir, BIKE, keep_zero_share=True), altered_golden(spark, sf_dir),
        only_differences=True,
    )


def audit_digests(spark, sf_dir):
    """The audit of altered golden counts by digests, over stored tables of both sides."""
    counted, expected = new_folder(spark, "profile"), new_folder(spark, "golden")
    write_table(profile(spark, sf_dir, BIKE, keep_zero_share=True), counted)
    write_golden(altered_golden(spark, sf_dir), expected)
    return audit_by_digest(read_table(spark, counted), read_golden(spark, expected))


def audit_hour(spark, sf_dir):
    """The audit of one date and hour; only that month's trips are read, on both sides."""
    month = ("1997-03", "1997-03")
    bikes = located_trips(d.trips(spark, sf_dir, BIKE, months=month), *d.lookups(spark, sf_dir))
    return audit_counts(
        mode_profile(bikes, BIKE, keep_zero_share=True), golden(spark, sf_dir, months=month),
        date="1997-03-01", hour="01",
    )


def refreshed(spark, sf_dir, **way):
    return refresh_lookup(
        d.station_feed(spark, sf_dir), d.known_stations(spark, sf_dir), lon_scale=d.LON_SCALE, **way
    )


def trips_of_key_ranges(spark, sf_dir):
    """Orders in ranges of their keys, of which the longest has about a billion keys."""
    key = F.col("n_nationkey").cast("long")
    ranges = d.table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("zone"), (key * key * 7).alias("lo"),
        F.when(key % 2 == 0, key * key * 7 + 300).otherwise(F.lit(1_000_000_007) - key).alias("hi"),
    )
    orders = d.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    return range_join(orders, ranges).groupBy("zone").agg(
        F.count(F.lit(1)).alias("orders"), F.min("id").alias("first"), F.max("id").alias("last")
    )


def _ranges(spark, sf_dir):
    return zone_ranges(d.zone_rings(spark, sf_dir))


def zone_centroids(spark, sf_dir):
    return zone_means(d.zone_vertices(spark, sf_dir), _ranges(spark, sf_dir))


def zone_zips(spark, sf_dir, **way):
    return zone_lookup(
        d.zone_vertices(spark, sf_dir), _ranges(spark, sf_dir), d.known_stations(spark, sf_dir),
        lon_scale=d.LON_SCALE, **way,
    )


def nearest(spark, sf_dir, **way):
    return nearest_zip(
        d.customer_points(spark, sf_dir), d.known_stations(spark, sf_dir), lon_scale=d.LON_SCALE,
        **way,
    )


QUERIES: dict[str, Query] = {
    "multimodal_profile": multimodal,
    "multimodal_profile_inner": partial(multimodal, how="inner"),
    "multimodal_profile_all_cells": partial(multimodal, keep_zero_share=True),
    "multimodal_profile_padded": partial(multimodal, pad_hour=True, min_distance=2.0),
    "multimodal_profile_merged": multimodal_merged,
    "multimodal_profile_joined": multimodal_joined,
    "bike_time_cells": bike_time_cells,
    "taxi_time_cells": taxi_time_cells,
    "multimodal_profile_bad_distances": without_bad_distances,
    "raw_layout_trips": raw_layout_trips,
    "raw_files_trips": raw_files_trips,
    "malformed_lines": malformed_file_lines,
    "point_trips_zip": point_trips_zip,
    "point_trips_zip_shuffled": partial(point_trips_zip, max_rows=0),
    "stored_slices": stored_slices,
    "rewritten_dates": rewritten_dates,
    "profile_from_states": profile_from_states,
    "stored_citi_table": partial(stored_mode_table, mode=BIKE),
    "stored_yellow_table": partial(stored_mode_table, mode=YELLOW),
    "stored_green_table": partial(stored_mode_table, mode=GREEN),
    "audit_by_digest": audit_digests,
    "key_ranges": trips_of_key_ranges,
    "zip_lookup": zip_lookup,
    "zip_lookup_shuffled": partial(zip_lookup, max_rows=0),
    "taxi_distance_clean": taxi_distance_clean,
    "dropped_trips": dropped,
    "trips_per_cell": trips_per_cell,
    "subscriber_share": subscriber_share,
    "card_share": card_share,
    "dispatch_share": dispatch_share,
    "dispatch_share_literal": partial(dispatch_share, literal=True),
    "mean_duration_minutes": mean_duration_minutes,
    "mean_trip_distance": mean_trip_distance,
    "bike_profile": partial(profile, mode=BIKE),
    "bike_profile_all_cells": partial(profile, mode=BIKE, keep_zero_share=True),
    "yellow_profile": partial(profile, mode=YELLOW),
    "green_profile": partial(profile, mode=GREEN),
    "citi_table": partial(table_of, mode=BIKE),
    "yellow_table": partial(table_of, mode=YELLOW),
    "green_table": partial(table_of, mode=GREEN),
    "destinations_from_zip": destinations_from_zip,
    "golden_counts": partial(golden, zeros=True),
    "audit_clean": audit_clean,
    "audit_altered": audit_altered,
    "audit_hour": audit_hour,
    "refresh_lookup": refreshed,
    "zone_centroids": zone_centroids,
    "zone_lookup": zone_zips,
    "nearest_zip": nearest,
    "refresh_lookup_descent": partial(refreshed, max_array_points=0),
    "zone_lookup_descent": partial(zone_zips, max_array_points=0),
    "nearest_zip_descent": partial(nearest, max_array_points=0),
}
