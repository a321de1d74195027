"""Where people go from a place at a time, and how."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exact_sum


def destinations_from(
    profile: DataFrame,
    start_zip: str,
    dates: str | tuple[str, str] | None = None,
    hours: str | list[str] | None = None,
) -> DataFrame:
    """Destinations of one start zip, from a multimodal profile.

    ``dates`` is one date or an inclusive (first, last) pair, ``hours`` one hour or a list.
    Shares and means are weighted with the trips of their mode, never averaged over cells; they
    are NULL where the mode has no trip, and do not depend on the order of rows.  Start from a profile with ``keep_zero_share=True`` to
    count every traveller.
    """
    wanted = F.col("start_zip") == start_zip
    if isinstance(dates, str):
        wanted &= F.col("date") == dates
    elif dates is not None:
        wanted &= F.col("date").between(*dates)
    if hours is not None:
        wanted &= F.col("hour").isin([hours] if isinstance(hours, str) else list(hours))

    bike, yellow, green = (
        F.coalesce(F.sum(f"{m}_trip_count"), F.lit(0)) for m in ("bike", "yellow", "green")
    )
    travellers = bike + yellow + green

    def weighted(value: str, mode: str) -> Column:
        trips = F.col(f"{mode}_trip_count")
        return F.try_divide(exact_sum(F.col(value) * trips), F.sum(trips))

    def counted(part: str, mode: str) -> Column:
        return F.try_divide(F.sum(part), F.sum(f"{mode}_trip_count"))

    return (
        profile.where(wanted)
        .groupBy("end_zip")
        .agg(
            travellers.alias("travellers"),
            F.try_divide(bike, travellers).alias("bike_share"),
            F.try_divide(yellow, travellers).alias("yellow_share"),
            F.try_divide(green, travellers).alias("green_share"),
            weighted("sub_percent", "bike").alias("subscriber_share"),
            counted("yellow_cc_count", "yellow").alias("yellow_card_share"),
            counted("green_cc_count", "green").alias("green_card_share"),
            weighted("yellow_trip_distance_avg", "yellow").alias("yellow_distance"),
            weighted("green_trip_distance_avg", "green").alias("green_distance"),
            weighted("bike_duration", "bike").alias("bike_minutes"),
            weighted("green_dispatch_percent", "green").alias("dispatch_share"),
        )
    )
