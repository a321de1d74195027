"""Location ids -> zips."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import known_zip
from .sizing import are_small

_SIZE = "_id_length"


def latest_zip(rows: DataFrame, order: str = "line") -> DataFrame:
    """One row per id: the zip of the row with the greatest ``order``, or, in a lookup without
    that column, the greatest zip.  An id that repeats never makes two trips of one."""
    zipcode = F.max_by("zip", order) if order in rows.columns else F.max("zip")
    return rows.groupBy("id").agg(zipcode.alias("zip"))


def prepare_lookups(*lookups: DataFrame, order: str = "line", **limits: int) -> list[DataFrame]:
    """Lookup rows (``id, zip`` and, where known, ``order``) ready for :func:`locate`.

    Each keeps one zip per id (``latest_zip``), without blanks (no zip is the unknown zip either way), and
    is marked for broadcast if its rows are measured to be few.  Others get a second join key.
    """
    small = are_small(*lookups, **limits)
    ready = []
    for rows, fits in zip(lookups, small, strict=True):
        known = latest_zip(rows, order).where(F.col("id").isNotNull() & (F.col("zip") != ""))
        ready.append(F.broadcast(known) if fits else known.withColumn(_SIZE, F.length("id")))
    return ready


def prepare_lookup(lookup: DataFrame, order: str = "line", **limits: int) -> DataFrame:
    return prepare_lookups(lookup, order=order, **limits)[0]


def add_zip(trips: DataFrame, lookup: DataFrame, end: str) -> DataFrame:
    """Add ``<end>_zip`` (``start`` or ``end``); ids that the lookup does not know get NULL.

    A lookup too large to broadcast is joined on the id's length as well.  That says nothing new
    about the rows, but makes Spark shuffle both sides for this very join, and only then does
    adaptive execution split the partition of a hot id: without it the lookup would keep the
    partitioning of the aggregate that found its latest zips.
    """
    trip_id = F.col(f"{end}_id")
    side = lookup.select(
        F.col("id").alias("_id"), F.col("zip").alias(f"{end}_zip"),
        *[c for c in lookup.columns if c == _SIZE],
    )
    same = trip_id == F.col("_id")
    if _SIZE in lookup.columns:
        same &= F.length(trip_id) == F.col(_SIZE)
    return trips.join(side, same, "left").drop("_id", _SIZE)


def locate(trips: DataFrame, start_lookup: DataFrame, end_lookup: DataFrame | None = None) -> DataFrame:
    """Add ``start_zip`` and ``end_zip``; ids that no lookup knows get the unknown zip.

    Lookups come from :func:`prepare_lookups`.  Both ends use ``start_lookup`` unless
    ``end_lookup`` is given.
    """
    found = add_zip(add_zip(trips, start_lookup, "start"), end_lookup or start_lookup, "end")
    return found.withColumns({c: known_zip(F.col(c)) for c in ("start_zip", "end_zip")})
