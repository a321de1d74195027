"""Trip table -> trips that can be counted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import number, pad_cell_hour, time_cell
from ..schemas import BIKE

ZERO_DISTANCE_TEXT = ".00"


def _is_bike() -> Column:
    return F.col("mode") == BIKE


def with_time_cell(trips: DataFrame, pad_hour: bool = False) -> DataFrame:
    """Add ``time_cell`` and drop trips without a pickup time.

    The one-element explode computes the cell once per row.  As a plain column it would be copied
    into every later filter on date or hour, and computed again in each.
    """
    cell = time_cell(F.col("pickup"), may_be_slashed=_is_bike())
    cell = pad_cell_hour(cell) if pad_hour else cell
    return trips.withColumn("time_cell", F.explode(F.array(cell))).where(
        F.col("time_cell").isNotNull()
    )


def clean_trips(
    trips: DataFrame,
    pad_hour: bool = False,
    min_distance: float | None = None,
    on_bad_number: str = "fail",
) -> DataFrame:
    """Add ``time_cell``, make the distance a number and drop the rows that do not count.

    Dropped: trips without a pickup time; taxi trips whose distance is missing or is the
    text ``.00`` (other zeros stay); with ``min_distance``, shorter taxi trips; with
    ``on_bad_number="drop"``, taxi trips whose distance is no number.
    """
    kept = trips.where(_is_bike() | (F.col("distance") != ZERO_DISTANCE_TEXT))
    kept = with_time_cell(kept, pad_hour).withColumn(
        "distance", F.when(~_is_bike(), number(F.col("distance"), on_bad_number))
    )
    if on_bad_number == "drop":
        kept = kept.where(_is_bike() | F.col("distance").isNotNull())
    if min_distance is not None:
        kept = kept.where(_is_bike() | (F.col("distance") >= min_distance))
    return kept


def dropped_trips(trips: DataFrame) -> DataFrame:
    """Per mode: how many trips there are and how many of them cleaning leaves out, and why."""
    distance = F.col("distance")
    taxi = ~_is_bike()
    number_missing = distance.try_cast("double").isNull() & distance.isNotNull()
    return trips.groupBy("mode").agg(
        F.count(F.lit(1)).alias("trips"),
        F.count_if(F.col("pickup").isNull()).alias("no_time"),
        F.count_if(taxi & distance.isNull()).alias("no_distance"),
        F.count_if(taxi & (distance == ZERO_DISTANCE_TEXT)).alias("zero_distance"),
        F.count_if(taxi & number_missing).alias("bad_distance"),
    )
