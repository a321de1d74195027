"""Nearest known point: the zip of a place that no lookup holds yet.

Distances are straight lines in the plane ``(lon * lon_scale, lat)``; of equally near points the
least zip counts.  Two exact ways, picked by the measured number of known points:

Coordinates count if they are finite, latitudes within 90 and longitudes within 180 degrees;
points elsewhere have no nearest one, and known points elsewhere are not looked at.

* few (the stations or zones of a city): they travel to the tasks as arrays, and each batch of
  rows takes its minima there, with no join and no shuffle;
* many: a quadtree descent.  Each step keeps, per place, the cells that may still hold something
  nearer than the best found so far, splits them and looks the pieces up by an equi-join.  Work
  per place grows with the depth of the tree, however densely points crowd in one spot, and no
  task gathers a spot's points.
"""

from __future__ import annotations

import tempfile

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

# Cosine of New York's latitude: makes a degree of longitude as long as one of latitude there.
CITY_LON_SCALE = 0.758
MAX_ARRAY_POINTS = 2_000
_CHUNK = 1_000  # rows whose distances to all sites are held at once

_STEP = 2  # quadtree levels per step: every open cell splits into 4 x 4
_DEPTH = 30
_LEAF = 16  # open cells of so few sites are not split further
_BROADCAST_DEPTH = 8  # a level has at most 4**level cells: 65,536 here


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the checkpoint folder the session names; only a local run may do with a local one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    one_machine = context.master.split("[")[0] == "local"
    if named is None and not one_machine:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(named or tempfile.mkdtemp(prefix="tripweave-"))


def on_earth() -> Column:
    """Whether ``lat`` and ``lon`` are coordinates; NULL, NaN and infinite ones are not."""
    inside = (F.abs("lat") <= 90.0) & (F.abs("lon") <= 180.0)
    return F.coalesce(inside, F.lit(False))


def _square(a: Column) -> Column:
    return a * a


def _distance2(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return _square(x1 - x2) + _square(y1 - y2)


def nearest_zip(
    points: DataFrame, known: DataFrame, lon_scale: float = CITY_LON_SCALE,
    max_array_points: int = MAX_ARRAY_POINTS,
) -> DataFrame:
    """Add ``zip`` to ``points`` (``lat, lon, ...``) from ``known`` (``lat, lon, zip``).

    Points without valid coordinates, or with nothing known at all, get a NULL zip.  Beyond
    ``max_array_points`` known points the search runs while the result is being built, even for an
    ``explain``, as each step depends on the last; its checkpoints are files in the session's
    checkpoint folder, which Spark deletes only with
    ``spark.cleaner.referenceTracking.cleanCheckpoints``.
    """
    sites = known.where(on_earth() & (F.col("zip") != "")).select(
        (F.col("lon") * lon_scale).alias("x"), F.col("lat").alias("y"), "zip"
    )
    few = sites.limit(max_array_points + 1).collect()
    if len(few) <= max_array_points:
        return _from_arrays(points, few, lon_scale)
    return _by_descent(points, sites.groupBy("x", "y").agg(F.min("zip").alias("zip")), lon_scale)


def _from_arrays(points: DataFrame, few: list[Row], lon_scale: float) -> DataFrame:
    few = sorted(few, key=lambda site: site["zip"])  # argmin takes the first of equal minima
    x = np.array([site["x"] for site in few])
    y = np.array([site["y"] for site in few])
    zips = np.array([site["zip"] for site in few], dtype=object)

    @F.pandas_udf("string")
    def nearest(px: pd.Series, py: pd.Series) -> pd.Series:
        out = np.full(len(px), None, dtype=object)
        at = np.flatnonzero(px.notna()) if len(zips) else []
        px, py = px.to_numpy(), py.to_numpy()
        for i in range(0, len(at), _CHUNK):
            rows = at[i : i + _CHUNK]
            dx, dy = px[rows, None] - x, py[rows, None] - y
            out[rows] = zips[np.argmin(dx * dx + dy * dy, axis=1)]
        return pd.Series(out)

    return points.withColumn(
        "zip", nearest(F.when(on_earth(), F.col("lon") * lon_scale), F.col("lat"))
    )


def _by_descent(points: DataFrame, sites: DataFrame, lon_scale: float) -> DataFrame:
    spark = points.sparkSession
    ensure_checkpoint_dir(spark)

    # Cut off once: a point computed again could differ in its last bit (a mean of doubles depends
    # on their order) and would not find itself in the results.
    placed = points.withColumns(
        {"px": F.when(on_earth(), F.col("lon") * lon_scale), "py": F.when(on_earth(), F.col("lat"))}
    ).checkpoint()
    places = placed.select("px", "py").dropna().distinct()
    sites = sites.checkpoint()
    box = sites.agg(F.min("x"), F.min("y"), F.max("x"), F.max("y")).first()
    if box[0] is None:
        return placed.withColumn("zip", F.lit(None).cast("string")).drop("px", "py")
    x0, y0 = box[0], box[1]
    side = max(box[2] - x0, box[3] - y0, 1e-9) * (1 + 1e-9)

    finest = side / 2**_DEPTH
    sites = sites.withColumns(
        {
            "fx": F.floor((F.col("x") - x0) / finest).cast("long"),
            "fy": F.floor((F.col("y") - y0) / finest).cast("long"),
        }
    ).checkpoint()

    def in_cells(rows: DataFrame, level: int) -> DataFrame:
        """Join rows with the cells of a level that hold a site: how many, and one of them."""
        cells = sites.groupBy(
            F.shiftright("fx", _DEPTH - level).alias("cx"),
            F.shiftright("fy", _DEPTH - level).alias("cy"),
        ).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("x", "y", "zip")).alias("site"))
        if level <= _BROADCAST_DEPTH:
            return rows.join(F.broadcast(cells), ["cx", "cy"])
        # The third key makes Spark shuffle both sides for this join, so that adaptive execution
        # can split a cell in which many places lie (see locate.add_zip).
        diagonal = (F.col("cx") + F.col("cy")).alias("diagonal")
        keys = ["cx", "cy", "diagonal"]
        return rows.select("*", diagonal).join(cells.select("*", diagonal), keys).drop("diagonal")

    def candidate(site: Column) -> Column:
        d2 = _distance2(F.col("px"), F.col("py"), site["x"], site["y"])
        return F.struct(d2.alias("d2"), site["zip"].alias("zip"))

    def gap(place: str, cell: str, origin: float, width: float) -> Column:
        """Distance from a place to a cell along one axis, a little less to be safe."""
        low = F.col(cell) * F.lit(width) + F.lit(origin)
        slack = F.lit(width * 1e-3)
        return F.greatest(
            F.lit(0.0), low - F.col(place) - slack, F.col(place) - low - F.lit(width) - slack
        )

    def reaches(level: int) -> Column:
        """Whether a cell of the level may hold something as near as the best found so far."""
        width = side / 2**level
        gap2 = _square(gap("px", "cx", x0, width)) + _square(gap("py", "cy", y0, width))
        return gap2 <= F.col("found.d2")

    place = ["px", "py"]
    offset = F.explode(F.sequence(F.lit(0), F.lit(4**_STEP - 1))).alias("o")
    fan = 2**_STEP

    level = 0
    start = places.withColumns({"cx": F.lit(0).cast("long"), "cy": F.lit(0).cast("long")})
    looked = in_cells(start, level).select(
        *place, "cx", "cy", "n", candidate(F.col("site")).alias("found")
    ).checkpoint()
    best = looked.select(*place, "found")
    opened = looked.where("n > 1").drop("found")

    while level < _DEPTH and not opened.where(F.col("n") > _LEAF).isEmpty():
        level += _STEP
        near = (
            opened.join(best, place)
            .select(*place, "cx", "cy", "found", offset)
            .withColumns(
                {
                    "cx": F.col("cx") * fan + F.col("o") % fan,
                    "cy": F.col("cy") * fan + F.floor(F.col("o") / fan).cast("long"),
                }
            )
            .where(reaches(level))
        )
        looked = (
            in_cells(near.select(*place, "cx", "cy"), level)
            .select(*place, "cx", "cy", "n", candidate(F.col("site")).alias("found"))
            .checkpoint()
        )
        best = _least(best.unionByName(looked.select(*place, "found")), place).checkpoint()
        opened = looked.where("n > 1").drop("found")

    # The cells still open hold few sites, or sites closer together than the finest cell: look at
    # each of them.
    left = _DEPTH - level
    each = sites.select(
        F.shiftright("fx", left).alias("cx"), F.shiftright("fy", left).alias("cy"),
        F.struct("x", "y", "zip").alias("site"),
    )
    last = opened.join(best, place).where(reaches(level)).drop("found").join(each, ["cx", "cy"])
    best = _least(
        best.unionByName(last.select(*place, candidate(F.col("site")).alias("found"))), place
    )

    found = best.select(*place, F.col("found.zip").alias("zip"))
    return placed.join(found, place, "left").drop(*place)


def _least(candidates: DataFrame, place: list[str]) -> DataFrame:
    return candidates.groupBy(*place).agg(F.min("found").alias("found"))
