"""Points -> the zone whose rings they lie in, over a grid cover of the zones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from .nearest import ensure_checkpoint_dir
from .ranges import range_join
from .sizing import broadcast_if_small

#: Width of a grid cell in degrees: a power of two, so that cell borders are exact.
CELL = 2.0 ** -7
#: How near (degrees) a ring may pass by a cell without counting as in it.
_MARGIN = 1e-9

_EDGE = ("x1", "y1", "x2", "y2")


def ring_edges(rings: DataFrame, vertices: DataFrame) -> DataFrame:
    """Edges ``zone, x1, y1, x2, y2`` of rings (``zone, first, last`` vertex ids), each one closed.

    Vertices are numbered along the ring.  A vertex that is missing would leave the ring open, so
    the job stops on it.
    """
    ranges = rings.select("zone", F.col("first").alias("lo"), (F.col("last") + 1).alias("hi"))
    following = F.when(F.col("id") + 1 < F.col("hi"), F.col("id") + 1).otherwise(F.col("lo"))
    placed = range_join(vertices.select("id", "lat", "lon"), ranges).select(
        "zone", F.col("lon").alias("x1"), F.col("lat").alias("y1"), following.alias("next")
    )
    ends = vertices.select(F.col("id").alias("next"), F.col("lon").alias("x2"), F.col("lat").alias("y2"))
    lost = F.raise_error(F.concat(F.lit("a ring needs the vertex "), F.col("next").cast("string")))
    edges = placed.join(ends.hint("merge"), "next", "left").withColumn(
        "x2", F.coalesce("x2", lost.cast("double"))
    )
    return edges.select("zone", *_EDGE)


def _crosses(edge: Column, x: Column, y: Column) -> Column:
    """Whether a ray from the point to the east crosses the edge; a ring's lower end belongs to it."""
    spans = (edge["y1"] > y) != (edge["y2"] > y)
    at = (edge["x2"] - edge["x1"]) * (y - edge["y1"]) / (edge["y2"] - edge["y1"]) + edge["x1"]
    return F.when(spans, x < at).otherwise(False)  # no division by zero: y1 and y2 differ


def _inside(edges: Column, x: Column, y: Column) -> Column:
    """Parity of crossings."""
    return F.aggregate(edges, F.lit(False), lambda odd, e: odd != _crosses(e, x, y))


def _cell(degrees: Column, cell: float) -> Column:
    return F.floor(degrees / cell).cast("int")


def zone_cover(edges: DataFrame, cell: float = CELL) -> DataFrame:
    """Grid cells that zones reach into: ``gx, gy, zones`` (zone, whole, edges; by zone), one row a cell.

    A cell that no edge of a zone touches lies wholly in it or not at all; its centre decides.  A
    cell that edges touch carries those of the zone's edges in its strip of latitude that a ray
    from one of its points to the east can cross.  Where rings lie in each other, an odd number of
    them means inside, so a ring in a ring is a hole.  A point is in the least zone that holds it, so
    a cell goes without the zones beyond the least one that it lies wholly in.
    """
    y_low, y_high = F.least("y1", "y2"), F.greatest("y1", "y2")
    strips = edges.withColumn("gy", F.explode(
        F.sequence(_cell(y_low - _MARGIN, cell), _cell(y_high + _MARGIN, cell))
    ))

    def x_at(border: Column) -> Column:
        y = F.least(F.greatest(border, y_low), y_high)
        slope = F.when(F.col("y1") == F.col("y2"), 0.0).otherwise(
            (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
        )
        return F.col("x1") + slope * (y - F.col("y1"))

    flat = F.col("y1") == F.col("y2")
    xa, xb = x_at(F.col("gy") * F.lit(cell)), x_at((F.col("gy") + 1) * F.lit(cell))
    west = F.when(flat, F.least("x1", "x2")).otherwise(F.least(xa, xb))
    east = F.when(flat, F.greatest("x1", "x2")).otherwise(F.greatest(xa, xb))
    by_strip = strips.select(
        "zone", "gy", F.struct(*_EDGE).alias("edge"),
        _cell(west - _MARGIN, cell).alias("first"), _cell(east + _MARGIN, cell).alias("last"),
    ).groupBy("zone", "gy").agg(
        F.collect_list("edge").alias("edges"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.sequence("first", "last"))))).alias("touched"),
    )
    n = F.size("touched")
    gaps = F.filter(
        F.zip_with(
            F.slice("touched", 1, n - 1), F.slice("touched", 2, n - 1),
            lambda a, b: F.struct((a + 1).alias("first"), (b - 1).alias("last")),
        ),
        lambda g: g["first"] <= g["last"],
    )
    # No edge touches a gap between edge cells, so one centre decides on all its cells.
    centre_x, centre_y = ((g + 0.5) * F.lit(cell) for g in (F.col("gap.first"), F.col("gy")))
    whole = by_strip.select("zone", "gy", "edges", F.explode(gaps).alias("gap")).where(
        _inside(F.col("edges"), centre_x, centre_y)
    ).select("zone", "gy", F.explode(F.sequence("gap.first", "gap.last")).alias("gx"))
    least = whole.groupBy("gx", "gy").agg(F.min("zone").alias("least"))
    edge_cells = by_strip.select("zone", "gy", F.explode("touched").alias("gx")).join(
        least, ["gx", "gy"], "left"
    ).where(F.col("least").isNull() | (F.col("zone") < F.col("least"))).select("zone", "gy", "gx")
    border = F.col("gx") * F.lit(cell) - _MARGIN
    cut = edge_cells.join(by_strip.select("zone", "gy", "edges"), ["zone", "gy"]).withColumn(
        "edges", F.filter("edges", lambda e: F.greatest(e["x1"], e["x2"]) >= border)
    )
    held = cut.select("gx", "gy", "zone", "edges").unionByName(
        least.select("gx", "gy", F.col("least").alias("zone")), allowMissingColumns=True
    )
    return held.groupBy("gx", "gy").agg(F.array_sort(F.collect_list(
        F.struct("zone", F.col("edges").isNull().alias("whole"), "edges")
    )).alias("zones"))


def prepare_cover(edges: DataFrame, cell: float = CELL, **limits: int) -> DataFrame:
    """The cover ready for :func:`add_zone`: marked for broadcast if it is measured to be small.

    It is laid once, while the query is built, into the session's checkpoint folder.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    return broadcast_if_small(zone_cover(edges, cell).checkpoint(), **limits)


def _zone_type(cover: DataFrame) -> DataType:
    return cover.schema["zones"].dataType.elementType["zone"].dataType


def add_zone(points: DataFrame, cover: DataFrame, lat: str, lon: str, zone: str, cell: float = CELL) -> DataFrame:
    """Add the least zone that holds the point of a row, NULL if none does or it is no place on earth.

    An equi-join on the grid cell, then the parity of the few edges of that cell: no point meets
    another cell's zones, and rows stay as many as they were.
    """
    x, y = F.col(lon), F.col(lat)
    valid = (F.abs(y) <= 90.0) & (F.abs(x) <= 180.0)  # false for NaN too: it is greater than all
    side = cover.select(
        F.col("gx").alias("_gx"), F.col("gy").alias("_gy"), F.col("zones").alias("_zones"),
    )
    met = points.join(
        side,
        (F.when(valid, _cell(x, cell)) == F.col("_gx")) & (F.when(valid, _cell(y, cell)) == F.col("_gy")),
        "left",
    )
    # Zones come by size, so none is looked into after the first that holds the point.
    least = F.aggregate("_zones", F.lit(None).cast(_zone_type(cover)), lambda found, z: F.when(
        found.isNotNull(), found
    ).when(z["whole"] | _inside(z["edges"], x, y), z["zone"]))
    return met.withColumn(zone, least).drop("_gx", "_gy", "_zones")


def locate_points(trips: DataFrame, cover: DataFrame, cell: float = CELL) -> DataFrame:
    """Trips with points (``start_lat`` ...) -> trips whose missing ids are those of the zones they lie in.

    The points' columns go.  An id that a trip already has stays.
    """
    for end in ("start", "end"):
        trips = add_zone(trips, cover, f"{end}_lat", f"{end}_lon", "_zone", cell).withColumn(
            f"{end}_id", F.coalesce(f"{end}_id", F.col("_zone").cast("string"))
        ).drop("_zone", f"{end}_lat", f"{end}_lon")
    return trips
