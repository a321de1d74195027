"""Lookup files, station feeds and zone shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import LOOKUP_FILE_COLUMNS, STATION_FEED_SCHEMA


def _lookup_file(spark: SparkSession, path: str | list[str], kind: str) -> DataFrame:
    """``id, zip, lat, lon`` plus ``line``, which sorts rows in file order."""
    id_column = LOOKUP_FILE_COLUMNS[kind]
    schema = f"{id_column} string, zipcode string, lat double, long double"
    line = F.struct(
        F.col("_metadata.file_path"),
        F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id(),
    )
    return (
        spark.read.schema(schema)
        .option("header", True)
        .csv(path)
        .select(
            F.trim(F.col(id_column)).alias("id"),
            F.trim("zipcode").alias("zip"),
            "lat",
            F.col("long").alias("lon"),
            line.alias("line"),
        )
    )


def read_zip_lookup(spark: SparkSession, path: str | list[str], kind: str = "station") -> DataFrame:
    """Station or zone lookup as ``id, zip, line``; feed it to ``operators.latest_zip``."""
    return _lookup_file(spark, path, kind).select("id", "zip", "line")


def read_known_points(spark: SparkSession, path: str | list[str], kind: str = "station") -> DataFrame:
    """Lookup rows that have a zip, as ``id, zip, lat, lon``; of equal ids the last row counts."""
    rows = _lookup_file(spark, path, kind).where(F.col("zip") != "")
    last = F.max_by(F.struct("zip", "lat", "lon"), F.col("line"))
    return rows.groupBy("id").agg(last.alias("p")).select("id", "p.zip", "p.lat", "p.lon")


def read_station_feed(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Saved station feed (nested JSON) as ``id, name, lat, lon``."""
    return (
        spark.read.schema(STATION_FEED_SCHEMA)
        .option("multiLine", True)
        .json(path)
        .select(F.explode("data.stations").alias("s"))
        .select(F.col("s.station_id").alias("id"), "s.name", "s.lat", "s.lon")
    )


def read_zone_rings(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Polygon rings as ``zone, first, last`` vertex ids.

    Lines are of different width: the zone is in the second field, the ring's vertex ids start
    at the fourth and end before the first field that is no number.  The header line has no
    numeric zone and drops out.
    """
    fields = F.split("value", ",")
    rest = F.col("rest")
    stop = F.array_position(F.transform(rest, lambda x: x.rlike("^[0-9]+$")), False)
    ids = F.slice(
        rest, F.lit(1), F.when(stop > 0, stop.cast("int") - 1).otherwise(F.size(rest))
    )
    return (
        spark.read.text(path)
        .where(F.size(fields) >= 4)
        .select(
            F.get(fields, F.lit(1)).try_cast("int").alias("zone"),
            F.transform(F.slice(fields, F.lit(4), F.size(fields)), lambda x: F.trim(x)).alias("rest"),
        )
        .where(F.col("zone").isNotNull())
        .select("zone", ids.alias("ids"))
        .where(F.size("ids") > 0)
        .select(
            "zone",
            F.get("ids", F.lit(0)).cast("long").alias("first"),
            F.element_at("ids", -1).cast("long").alias("last"),
        )
    )


def read_zone_vertices(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Vertex table as ``id, lat, lon``."""
    return spark.read.schema("id long, lat double, lon double").option("header", True).csv(path)
