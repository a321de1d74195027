"""Readers for trip files, lookups, station feeds, zone shapes and result tables."""

from .lookups import (
    read_known_points, read_station_feed, read_zip_lookup, read_zone_rings, read_zone_vertices,
)
from .tables import read_golden, read_mode_table, read_slices, read_table, read_table_jdbc
from .trips import (
    all_trips, bike_trips, kept_trips, malformed_lines, malformed_rows, read_bike_csv,
    read_bike_trips, read_labelled, read_taxi_csv, read_taxi_trips, taxi_point_trips, taxi_trips,
    typed_bike,
)

__all__ = [
    "read_bike_csv", "read_bike_trips", "typed_bike", "bike_trips", "malformed_rows",
    "read_labelled", "kept_trips", "malformed_lines", "taxi_point_trips",
    "read_taxi_csv", "read_taxi_trips", "taxi_trips", "all_trips",
    "read_zip_lookup", "read_known_points", "read_station_feed",
    "read_zone_rings", "read_zone_vertices",
    "read_golden", "read_table", "read_slices", "read_mode_table", "read_table_jdbc",
]
