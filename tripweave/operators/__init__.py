"""DataFrame -> DataFrame building blocks."""

from .cells import (
    MODE_COLUMNS, cell_counts, cell_states, cells_from_states, merge_states, mode_cells, mode_rows,
    taxi_cells,
)
from .clean import clean_trips, dropped_trips
from .locate import latest_zip, locate, prepare_lookup, prepare_lookups
from .nearest import nearest_zip
from .polygons import add_zone, locate_points, prepare_cover, ring_edges, zone_cover
from .ranges import range_join, zone_means, zone_ranges
from .sizing import are_small, broadcast_if_small

__all__ = [
    "clean_trips", "dropped_trips",
    "are_small", "broadcast_if_small",
    "latest_zip", "prepare_lookup", "prepare_lookups", "locate",
    "cell_counts", "mode_cells", "taxi_cells", "mode_rows", "MODE_COLUMNS",
    "cell_states", "merge_states", "cells_from_states",
    "ring_edges", "zone_cover", "prepare_cover", "add_zone", "locate_points",
    "zone_ranges", "range_join", "zone_means", "nearest_zip",
]
