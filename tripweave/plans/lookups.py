"""Keeping the location lookups up to date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.nearest import CITY_LON_SCALE, nearest_zip
from ..operators.ranges import zone_means

_COLUMNS = ["id", "zip", "lat", "lon"]


def refresh_lookup(
    feed: DataFrame, known: DataFrame, places: DataFrame | None = None,
    lon_scale: float = CITY_LON_SCALE, **way: int,
) -> DataFrame:
    """New station lookup from a feed (``id, lat, lon``) and the previous lookup.

    Stations with a zip are kept, in the feed or not.  Feed stations without one are resolved
    through the nearest of ``places`` (``lat, lon, zip``; the known stations by default).  A
    blank zip whose station left the feed is lost.  ``way``: see ``nearest_zip``.
    """
    kept = known.where(F.col("zip") != "").select(*_COLUMNS)
    new = (
        feed.join(kept.select("id"), "id", "left_anti")
        .groupBy("id")
        .agg(F.min(F.struct("lat", "lon")).alias("at"))
        .select("id", "at.lat", "at.lon")
    )
    resolved = nearest_zip(new, kept if places is None else places, lon_scale, **way)
    return kept.unionByName(resolved.select(*_COLUMNS))


def zone_lookup(
    vertices: DataFrame, ranges: DataFrame, places: DataFrame, lon_scale: float = CITY_LON_SCALE,
    **way: int,
) -> DataFrame:
    """Zone lookup: mean vertex of each zone and the zip of the nearest of ``places``."""
    means = zone_means(vertices, ranges).withColumn("id", F.col("zone").cast("string"))
    return nearest_zip(means, places, lon_scale, **way).select(*_COLUMNS)
