"""Golden counts, and the check of a profile against them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cell_key
from ..schemas import UNKNOWN_HOUR, UNKNOWN_ZIP


def _recounted_time(trips: DataFrame) -> DataFrame:
    """Add ``date`` and ``hour``, read off the pickup text by patterns of their own."""
    pickup = F.col("pickup")
    slashed = pickup.contains("/")

    def us(part: int) -> Column:
        return F.regexp_extract(pickup, r"^(\d+)/(\d+)/(\d+)(?:\s+(\d+))?", part)

    date = F.when(
        slashed, F.concat_ws("-", us(3), F.lpad(us(1), 2, "0"), F.lpad(us(2), 2, "0"))
    ).otherwise(F.regexp_extract(pickup, r"^([^\s:]*)", 1))
    hour = F.when(slashed, us(4)).otherwise(F.regexp_extract(pickup, r"^[^\s:]+\s+([^\s:]+)", 1))
    return trips.where(pickup.isNotNull()).withColumns(
        {"date": date, "hour": F.when(hour == "", UNKNOWN_HOUR).otherwise(hour)}
    )


def _recounted_zip(trips: DataFrame, lookup: DataFrame, end: str) -> DataFrame:
    """Add the zip of one end; unknown, blank and ``0`` are the unknown zip."""
    names = lookup.select(F.col("id").alias("place"), F.col("zip").alias("place_zip"))
    named = trips.join(names, F.col(f"{end}_id") == F.col("place"), "left")
    known = F.col("place_zip").isNotNull() & ~F.col("place_zip").isin("", "0")
    return named.withColumn(
        f"{end}_zip", F.when(known, F.col("place_zip")).otherwise(UNKNOWN_ZIP)
    ).drop("place", "place_zip")


def golden_counts(sample: DataFrame, stations: DataFrame, end_stations: DataFrame | None = None) -> DataFrame:
    """Bike trips per key, counted from raw trips.

    Shares neither the reading of times nor the lookup join with the profile, so that a fault in
    either shows as a difference.  Trips with both ends unknown are left out; zip ``0`` counts as
    unknown.  The lookups hold one zip per id (``operators.prepare_lookup``).
    """
    trips = _recounted_time(sample.select("pickup", "start_id", "end_id"))
    trips = _recounted_zip(trips, stations, "start")
    trips = _recounted_zip(trips, end_stations or stations, "end")
    start, end = F.col("start_zip"), F.col("end_zip")
    return (
        trips.where((start != UNKNOWN_ZIP) | (end != UNKNOWN_ZIP))
        .groupBy(F.concat(start, end, "date", "hour").alias("key"))
        .agg(F.count(F.lit(1)).alias("count"))
    )


def _five_digits(zipcode: str) -> Column:
    """The zip; the job stops on one that has not five characters, as keys have no separator."""
    wrong = F.raise_error(F.concat(F.lit("a key needs zips of five characters, not "), zipcode))
    return F.when(F.length(zipcode) == 5, F.col(zipcode)).otherwise(wrong.cast("string"))


#: Two zips, date and hour: what a key must look like to be cut into a slice.
_KEY = r"^.{10}\d{4}-\d{2}-\d{2}(?:-1|\d{1,2})$"


def _counted(profile: DataFrame) -> DataFrame:
    """Date, start zip, key and trips of the bike cells of a profile that golden counts have too."""
    return profile.where(F.col("bike_trip_count") > 0).where(
        (F.col("start_zip") != UNKNOWN_ZIP) | (F.col("end_zip") != UNKNOWN_ZIP)
    ).select(
        "date", "start_zip",
        cell_key(
            _five_digits("start_zip"), _five_digits("end_zip"), F.col("date"), F.col("hour")
        ).alias("key"),
        F.col("bike_trip_count").cast("long").alias("n"),
    )


def _expected(golden: DataFrame) -> DataFrame:
    """The same of golden counts, read off their keys."""
    wrong = F.raise_error(F.concat(F.lit("cannot slice by the golden key "), "key"))
    key = F.when(F.col("key").rlike(_KEY), F.col("key")).otherwise(wrong.cast("string"))
    return golden.where(~F.startswith("key", F.lit(UNKNOWN_ZIP * 2))).select(
        F.substr(key, F.lit(11), F.lit(10)).alias("date"), F.substring(key, 1, 5).alias("start_zip"),
        "key", F.col("count").cast("long").alias("n"),
    )


def digests(counts: DataFrame) -> DataFrame:
    """Per date and start zip: number of keys, and sums over hashes of key and count, in any order.

    Two hashes are added, each as a number of 64 bits, so that two different groups agree in all
    with a probability of about 2**-128.
    """
    def added(*salt) -> Column:
        return F.sum(F.xxhash64("key", "n", *salt).cast("decimal(20,0)"))

    return counts.groupBy("date", "start_zip").agg(
        F.count(F.lit(1)).alias("keys"), added().alias("digest"), added(F.lit(1)).alias("digest2")
    )


def audit_by_digest(profile: DataFrame, golden: DataFrame) -> DataFrame:
    """The differences that ``audit_counts(..., only_differences=True)`` finds, in two steps.

    Both sides are reduced to one digest per date and start zip; only keys of groups whose digests
    differ are joined, so a clean audit joins no keys at all.  Give it stored tables: each side is
    read twice, the second time only for the groups that differ.
    """
    mine, other = _counted(profile), _expected(golden)
    group = ["date", "start_zip"]
    seen = [c for c in digests(mine).columns if c not in group]
    both = digests(mine).select(*group, F.struct(*seen).alias("mine")).join(
        digests(other).select(*group, F.struct(*seen).alias("other")), group, "full"
    )
    # A side that lacks a group has a NULL there, which differs from any digest.
    differ = both.where(~F.col("mine").eqNullSafe(F.col("other"))).select(*group)
    left = mine.join(differ, group, "left_semi").select("key", F.col("n").alias("counted"))
    right = other.join(differ, group, "left_semi").select("key", F.col("n").alias("expected"))
    delta = F.coalesce("counted", F.lit(0)) - F.coalesce("expected", F.lit(0))
    return left.join(right, "key", "full").select("key", delta.cast("long").alias("delta")).where("delta <> 0")


def audit_counts(
    profile: DataFrame, golden: DataFrame, date: str | None = None, hour: str | None = None,
    only_differences: bool = False,
) -> DataFrame:
    """Per key: bike trips in the profile minus trips in the golden counts (0 = agreement).

    A key that only one side has counts as 0 on the other, so losses show on both sides.  With
    ``date`` and ``hour`` just that slice is compared; the golden side is cut to the same slice.
    Keys have no separator, so a zip of other than five characters, or in a slice a golden key of
    another form, stops the job.
    Use a profile with ``keep_zero_share=True``: golden counts hold cells without subscribers.
    """
    out = profile.where(F.col("bike_trip_count") > 0).where(
        (F.col("start_zip") != UNKNOWN_ZIP) | (F.col("end_zip") != UNKNOWN_ZIP)
    )
    if date is not None:
        out = out.where(F.col("date") == date)
    if hour is not None:
        out = out.where(F.col("hour") == hour)
    out = out.select(
        cell_key(
            _five_digits("start_zip"), _five_digits("end_zip"), F.col("date"), F.col("hour")
        ).alias("key"),
        F.col("bike_trip_count").cast("long").alias("counted"),
    )

    expected = golden.where(~F.startswith("key", F.lit(UNKNOWN_ZIP * 2))).select(
        "key", F.col("count").cast("long").alias("expected")
    )
    if date is not None or hour is not None:
        wrong = F.raise_error(F.concat(F.lit("cannot slice by the golden key "), "key"))
        key = F.when(F.col("key").rlike(_KEY), F.col("key")).otherwise(wrong.cast("string"))
        if date is not None:
            expected = expected.where(F.substr(key, F.lit(11), F.lit(10)) == date)
        if hour is not None:
            expected = expected.where(F.substr(key, F.lit(21)) == hour)

    delta = F.coalesce("counted", F.lit(0)) - F.coalesce("expected", F.lit(0))
    deltas = out.join(expected, "key", "full").select("key", delta.cast("long").alias("delta"))
    return deltas.where(F.col("delta") != 0) if only_differences else deltas
