"""Points in zones against a plain ray cast."""

import math
import random

import pytest
from conftest import SF_DIR, rows
from pyspark.sql import functions as F

from tripweave import sources
from tripweave.operators import add_zone, locate_points, prepare_cover, ring_edges, zone_cover
from tripweave.operators.ranges import range_pieces
from tripweave.registry import QUERIES
from tripweave.schemas import GREEN_POINT_COLUMNS, TRIP_COLUMNS, YELLOW, YELLOW_POINT_COLUMNS


def inside(edges, x, y):
    odd = False
    for x1, y1, x2, y2 in edges:
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            odd = not odd
    return odd


def star(rng, x, y, size, n, step):
    out = []
    for k in range(n):
        angle, far = 2 * math.pi * k / n, size * rng.uniform(0.3, 1)
        out.append((round((x + far * math.cos(angle)) / step) * step, round((y + far * math.sin(angle)) / step) * step))
    return out


def shapes(spark, zones):
    """Rings and vertices of {zone: list of rings}."""
    rings, vertices = [], []
    for zone, some in zones.items():
        for ring in some:
            rings.append((zone, len(vertices), len(vertices) + len(ring) - 1))
            vertices += [(len(vertices) + k, y, x) for k, (x, y) in enumerate(ring)]
    return (spark.createDataFrame(rings, "zone int, first long, last long"),
            spark.createDataFrame(vertices, "id long, lat double, lon double"))


def edges_of(rings):
    return [(*a, *b) for r in rings for a, b in zip(r, [*r[1:], r[0]], strict=True)]


@pytest.mark.parametrize("step,limit", [(2.0 ** -9, 10**6), (1e-4, 10**6), (2.0 ** -7, 0)])
def test_points_in_zones(spark, step, limit):
    """On a coarse grid points, corners, edges and cell borders coincide in all ways."""
    rng = random.Random(int(1 / step))
    zones = {
        z: [star(rng, rng.uniform(-0.05, 0.05), rng.uniform(-0.05, 0.05), 0.04, rng.randrange(3, 12), step)
            for _ in range(rng.choice([1, 1, 2]))] for z in range(8)
    }
    zones[9] = [[(-0.03125, -0.03125), (0.03125, -0.03125), (0.03125, 0.03125), (-0.03125, 0.03125)]]
    points = [(round(rng.uniform(-0.1, 0.1) / step) * step, round(rng.uniform(-0.1, 0.1) / step) * step)
              for _ in range(1500)]
    points += [p for some in zones.values() for r in some for p in r]
    df = spark.createDataFrame([(k, y, x) for k, (x, y) in enumerate(points)], "k int, lat double, lon double")
    cover = prepare_cover(ring_edges(*shapes(spark, zones)), max_rows=limit)
    got = {r.k: r.zone for r in add_zone(df, cover, "lat", "lon", "zone").collect()}
    want = {
        k: min((z for z, some in zones.items() if inside(edges_of(some), x, y)), default=None)
        for k, (x, y) in enumerate(points)
    }
    assert got == want
    assert len(set(want.values())) > 5


def test_cover_is_small_and_marks_whole_cells(spark):
    ring = [(0.0, 0.0), (0.5, 0.0), (0.5, 0.5), (0.0, 0.5)]
    cover = zone_cover(ring_edges(*shapes(spark, {1: [ring]}))).select("gx", "gy", F.explode("zones").alias("z"))
    whole = cover.where("z.whole").count()
    assert whole > 60 * 60
    assert cover.count() - whole < 4 * 70 * 2
    assert cover.where("not z.whole").agg(F.max(F.size("z.edges"))).first()[0] <= 3


def test_odd_points(spark):
    ring = [(-1.0, -1.0), (1.0, -1.0), (1.0, 1.0), (-1.0, 1.0)]
    cover = prepare_cover(ring_edges(*shapes(spark, {4: [ring]})))
    places = [(0.5, 0.5), (None, 0.5), (0.5, None), (math.nan, 0.5), (math.inf, 0.5), (0.5, 1e300), (91.0, 0.0)]
    df = spark.createDataFrame([(k, *p) for k, p in enumerate(places)], "k int, lat double, lon double")
    got = add_zone(df, cover, "lat", "lon", "zone")
    assert rows(got, "k", "zone") == [(0, 4)] + [(k, None) for k in range(1, len(places))]
    assert "CartesianProduct" not in got._jdf.queryExecution().executedPlan().toString()
    assert add_zone(df.limit(0), cover, "lat", "lon", "zone").count() == 0


def test_a_ring_that_lacks_a_vertex_stops_the_job(spark):
    rings, vertices = shapes(spark, {1: [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)]]})
    with pytest.raises(Exception, match="a ring needs the vertex 1"):
        ring_edges(rings, vertices.where("id <> 1")).collect()


def test_trips_of_both_point_layouts(spark, tmp_path):
    parts = []
    for mode, columns in (("yellow", YELLOW_POINT_COLUMNS), ("green", GREEN_POINT_COLUMNS)):
        values = {c: "1" for c in columns} | {
            c: v for c in columns for k, v in (("pickup_l", " 0.5"), ("dropoff_latitude", "n/a"),
                                               ("dropoff_longitude", "0.5")) if c.lower().startswith(k)
        }
        path = tmp_path / f"{mode}.csv"
        path.write_text(",".join(columns) + "\n" + ",".join(values.values()) + "\n")
        parts.append(sources.taxi_point_trips(sources.read_taxi_csv(spark, str(path), f"{mode}_points"), mode))
    ring = [(-1.0, -1.0), (1.0, -1.0), (1.0, 1.0), (-1.0, 1.0)]
    cover = prepare_cover(ring_edges(*shapes(spark, {7: [ring]})))
    found = locate_points(parts[0].unionByName(parts[1]), cover)
    assert found.columns == TRIP_COLUMNS
    assert rows(found, "mode", "start_id", "end_id") == [("green", "7", None), ("yellow", "7", None)]
    with pytest.raises(ValueError):
        sources.taxi_point_trips(spark.createDataFrame([("x",)], "tpep_pickup_datetime string"), YELLOW)


def test_the_test_tables_show_points_in_and_out_of_zones(spark):
    found = QUERIES["point_trips_zip"](spark, SF_DIR).agg(
        F.sum(F.when(F.col("start_id").isNull(), F.col("trips"))).alias("out"),
        F.sum(F.when(F.col("start_id").isNotNull(), F.col("trips"))).alias("in"),
        F.count_distinct("start_id").alias("zones"),
    ).first()
    assert found["out"] > 100 and found["in"] > 100 and found.zones > 3


def test_a_cell_goes_without_zones_beyond_one_it_lies_wholly_in(spark):
    """Many zones over each other: a cell carries those that can be the least one, no others."""
    rings = {z: [[(x, y), (x + 0.5, y), (x + 0.5, y + 0.5), (x, y + 0.5)]]
             for z in range(60) for x, y in [(z * 37 % 60 / 1000, z * 91 % 60 / 1000)]}
    cover = zone_cover(ring_edges(*shapes(spark, rings)))
    most = cover.where("gx between 16 and 56 and gy between 16 and 56").agg(F.max(F.size("zones"))).first()[0]
    assert most == 1
    points = [(k, k % 40 / 60, k // 40 / 60) for k in range(1600)]
    got = add_zone(spark.createDataFrame(points, "k int, lat double, lon double"), cover, "lat", "lon", "zone")
    want = {k: min((z for z, r in rings.items() if inside(edges_of(r), x, y)), default=None) for k, y, x in points}
    assert {r.k: r.zone for r in got.collect()} == want


def test_short_ranges_are_looked_for_at_few_levels(spark):
    """Levels beyond a range's length are not tried; long ranges keep all their pieces."""
    ranges = spark.createDataFrame([(16, 32), (0, 2**62), (1023, 3 * 1024 + 1)], "lo long, hi long")
    pieces = range_pieces(ranges)
    assert rows(pieces.where("lo = 16"), "_level", "_piece") == [(10, 0)]
    assert rows(pieces.where("lo = 0"), "_level", "_piece") == [(62, 0)]
    assert rows(pieces.where("lo = 1023"), "_level", "_piece") == [(12, 0)]
    assert "sequence(0, 52" not in pieces._jdf.queryExecution().analyzed().toString()
