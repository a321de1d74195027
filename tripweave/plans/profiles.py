"""Origin/destination profiles: one row per date, hour, start zip and end zip."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cell_date, cell_hour, minutes, share
from ..operators.cells import all_mode_cells, merged_mode_cells, mode_cells, profile_columns
from ..operators.clean import clean_trips
from ..operators.locate import locate
from ..schemas import BIKE, CELL_KEYS, GREEN, MODES, YELLOW


def located_trips(
    trips: DataFrame, start_lookup: DataFrame, end_lookup: DataFrame | None = None, **cleaning
) -> DataFrame:
    """Trip table -> cleaned trips with zips.  ``cleaning``: see ``operators.clean_trips``."""
    return locate(clean_trips(trips, **cleaning), start_lookup, end_lookup)


def mode_profile(
    located: DataFrame, mode: str, keep_zero_share: bool = False, literal_dispatch: bool = False
) -> DataFrame:
    """Profile of one mode from located trips.

    ``keep_zero_share`` keeps cells without any subscriber (bike) or card payer (taxi).
    ``literal_dispatch`` counts every green trip as dispatched instead of those of trip type 2.
    """
    cells = mode_cells(located, mode, keep_zero_share, literal_dispatch)
    columns = [c.alias(n) for n, c in profile_columns(mode).items()]
    return cells.select(*CELL_KEYS, *columns)


def bike_profile(
    trips: DataFrame, stations: DataFrame, keep_zero_share: bool = False, **cleaning
) -> DataFrame:
    """Count, subscriber share and mean minutes per cell, from bike trips and a prepared lookup."""
    return mode_profile(located_trips(trips, stations, **cleaning), BIKE, keep_zero_share)


def taxi_profile(
    trips: DataFrame, zones: DataFrame, mode: str = YELLOW, keep_zero_share: bool = False,
    literal_dispatch: bool = False, **cleaning,
) -> DataFrame:
    """Count, card count, card share and mean distance per cell; green adds the dispatch share."""
    located = located_trips(trips, zones, **cleaning)
    return mode_profile(located, mode, keep_zero_share, literal_dispatch)


def multimodal_profile(
    bike: DataFrame, yellow: DataFrame, green: DataFrame, stations: DataFrame, zones: DataFrame,
    how: str = "full", keep_zero_share: bool = False, literal_dispatch: bool = False, **cleaning,
) -> DataFrame:
    """The three trip tables as one profile, without a join of cells."""
    located = {
        BIKE: located_trips(bike, stations, **cleaning),
        YELLOW: located_trips(yellow, zones, **cleaning),
        GREEN: located_trips(green, zones, **cleaning),
    }
    return merged_mode_cells(located, how, keep_zero_share, literal_dispatch)


def multimodal_profile_of(
    located: DataFrame, how: str = "full", keep_zero_share: bool = False,
    literal_dispatch: bool = False,
) -> DataFrame:
    """The multimodal profile of one table with the located trips of all modes: one pass."""
    return all_mode_cells(located, how, keep_zero_share, literal_dispatch)


def join_profiles(
    bike: DataFrame, yellow: DataFrame, green: DataFrame, how: str = "full"
) -> DataFrame:
    """Combine three finished mode profiles, e.g. stored ones, on the cell."""
    return bike.join(yellow, CELL_KEYS, how).join(green, CELL_KEYS, how)


def mode_tables(
    located: DataFrame, keep_zero_share: bool = False, literal_dispatch: bool = False
) -> dict[str, DataFrame]:
    """Stand-alone tables per mode under the column names of the older per-mode jobs."""

    def cells(mode: str) -> DataFrame:
        return mode_cells(located, mode, keep_zero_share, literal_dispatch, split_cell=False)

    return {mode: mode_table(cells(mode), mode) for mode in MODES}


def mode_table(cells: DataFrame, mode: str) -> DataFrame:
    """One mode's cells (``time_cell``, zips, ``trips, part, mean, dispatched``) as its stand-alone table."""

    def named(pickup: str, start: str, end: str) -> list:
        return [
            F.col("time_cell").alias(pickup),
            F.col("start_zip").alias(start),
            F.col("end_zip").alias(end),
        ]

    hour = cell_hour(F.col("time_cell")).alias("hour")
    date = cell_date(F.col("time_cell")).alias("date")
    ratio = share(F.col("part"), F.col("trips"))
    trips, part, mean, dispatched = (F.col(c) for c in ("trips", "part", "mean", "dispatched"))

    columns = {
        BIKE: [
            *named("starttime", "start station id", "end station id"),
            trips.alias("count"), part.alias("sub_count"), ratio.alias("sub_percent"),
            hour, date, minutes(mean).alias("avg(tripduration)"),
        ],
        YELLOW: [
            *named("tpep_pickup_datetime", "PULocationID", "DOLocationID"),
            trips.alias("yellow_count"), ratio.alias("yellow_cc_percent"),
            hour, date, mean.alias("yellow_avg_dist"),
        ],
        GREEN: [
            *named("lpep_pickup_datetime", "PULocationID", "DOLocationID"),
            trips.alias("green_count"), ratio.alias("green_cc_percent"),
            hour, date, mean.alias("green_avg_dist"),
            dispatched.alias("dispatch_count"),
            share(dispatched, trips).alias("dispatch_percent"),
        ],
    }
    return cells.select(*columns[mode])
