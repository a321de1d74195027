"""Trips, lookups, feeds and shapes derived from the star-schema test tables.

The test data holds no trips, so line items play their part: the return flag is the mode, the
supplier the start, the customer's nation the end, and the ship date and line number the time.
Modulo rules below only give every case of the data model (unknown ids, blank zips, stations that
left the feed) a share of the rows; nothing is left out to make a query cheaper.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.locate import prepare_lookups
from .schemas import BIKE, BIKE_COLUMNS, GREEN, TAXI_LAYOUTS, TRIP_COLUMNS, YELLOW

# A power-of-two grid keeps sums, means and squared distances of coordinates exact in binary, so
# results do not depend on the order of rows.
LON_SCALE = 0.75

FLAGS = {BIKE: "A", YELLOW: "N", GREEN: "R"}


# Declared, so that building a query needs no job to look into the files.
SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string",
    "customer": "c_custkey bigint, c_nationkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "nation": "n_nationkey int, n_regionkey int",
    "region": "r_regionkey int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


# Orders whose trips show a case that cleaning and lookups have rules for.
def _odd(every: int) -> Column:
    return F.col("l_orderkey") % every == 0


def trips(
    spark: SparkSession, sf_dir: str, *modes: str, months: tuple[str, str] | None = None,
    bad_distances: bool = False,
) -> DataFrame:
    """Trips of the given modes and pickup months (all by default) as one trip table.

    Some have no pickup time, none with an hour, no distance or an unknown (NULL) end, and with
    ``bad_distances`` some distances are no numbers.

    Modes and months (``yyyy-MM``, first and last) are picked on stored columns, so the parquet
    reader can skip the others.
    Orders meet customers first (the smaller join), then line items once for all modes.  Line
    items and orders both grow with the data, so that join is a merge join at every scale:
    Spark's size guess for a joined side is far too high, and without the hint it would rather
    broadcast the line items of a small test.  Both sides are shuffled for this join alone, so AQE
    splits an order that holds too many.
    """
    lineitem = table(spark, sf_dir, "lineitem")
    if modes:
        lineitem = lineitem.where(F.col("l_returnflag").isin([FLAGS[m] for m in modes]))
    if months:
        first, last = (F.to_date(F.lit(f"{m}-01")) for m in months)
        after = F.add_months(last, 1)
        shipped = F.col("l_shipdate")
        lineitem = lineitem.where(
            (shipped >= first.cast("timestamp_ntz")) & (shipped < after.cast("timestamp_ntz"))
        )
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")

    placed = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", "c_nationkey"
    )
    joined = lineitem.join(placed.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))

    flag, line = F.col("l_returnflag"), F.col("l_linenumber")
    year, month = F.year("l_shipdate").cast("string"), F.month("l_shipdate").cast("string")
    us_hour = F.concat(F.lit(" "), line.cast("string"), F.lit(":05"))
    hour = F.concat(F.lit(" "), F.lpad(line.cast("string"), 2, "0"), F.lit(":05:09"))
    none = F.lit("")
    slashed = F.concat(month, F.lit("/1/"), year, F.when(_odd(89), none).otherwise(us_hour))
    iso = F.concat(
        year, F.lit("-"), F.lpad(month, 2, "0"), F.lit("-01"), F.when(_odd(89), none).otherwise(hour)
    )
    distance = F.when(F.col("l_tax") == 0, ".00").otherwise(
        F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(".5"))
    )
    if bad_distances:
        distance = F.when(_odd(71), "n/a").otherwise(distance)
    return joined.select(
        F.when(flag == FLAGS[BIKE], BIKE).when(flag == FLAGS[YELLOW], YELLOW).otherwise(GREEN)
        .alias("mode"),
        F.when(~_odd(97), F.when((flag == FLAGS[BIKE]) & (line % 2 == 0), slashed).otherwise(iso))
        .alias("pickup"),
        F.when(~_odd(83), F.col("l_suppkey").cast("string")).alias("start_id"),
        F.when(~_odd(79), F.col("c_nationkey").cast("string")).alias("end_id"),
        (F.col("l_quantity") * 60 + line).alias("duration"),
        F.when(~_odd(73), distance).alias("distance"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "Subscriber")
        .otherwise("Customer").alias("usertype"),
        F.when(F.col("o_orderstatus") == "F", "1").otherwise("2").alias("payment_type"),
        F.when(F.col("l_linestatus") == "O", "2").otherwise("1").alias("trip_type"),
    ).select(*TRIP_COLUMNS)


def _nation_zip() -> Column:
    return F.lpad((F.lit(10000) + F.col("n_regionkey")).cast("string"), 5, "0")


def start_lookup_rows(spark: SparkSession, sf_dir: str, zeros: bool = False) -> DataFrame:
    """Supplier lookup in two revisions per id; the later one holds the zip that counts.

    With ``zeros`` some zips are ``0``, another way to write the unknown zip.
    """
    supplier = table(spark, sf_dir, "supplier").join(
        F.broadcast(table(spark, sf_dir, "nation")),  # 25 rows at every scale
        F.col("s_nationkey") == F.col("n_nationkey"),
    )
    key = F.col("s_suppkey")
    newest = F.when(key % 19 == 0, "").otherwise(_nation_zip())
    newest = F.when(key % 5 == 0, "0").otherwise(newest) if zeros else newest
    return (
        supplier.where(key % 17 != 0)
        .select(
            key.cast("string").alias("id"),
            F.inline(
                F.array(
                    F.struct(F.lit(0).alias("line"), F.lit("99999").alias("zip")),
                    F.struct(F.lit(1).alias("line"), newest.alias("zip")),
                )
            ),
        )
    )


def end_lookup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    zipcode = F.when(F.col("n_nationkey") % 11 == 0, "").otherwise(_nation_zip())
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("id"), zipcode.alias("zip"), F.lit(0).alias("line")
    )


def lookups(spark: SparkSession, sf_dir: str, zeros: bool = False, **limits: int) -> list[DataFrame]:
    """Start and end lookup, ready for ``operators.locate``."""
    return prepare_lookups(
        start_lookup_rows(spark, sf_dir, zeros), end_lookup_rows(spark, sf_dir), **limits
    )


# A zone's outer ring, with dents, and the hole in it (1/1024 degrees east and north).
ZONE_RING = [(-48, -40), (0, -16), (52, -44), (28, 4), (48, 52), (4, 24), (-44, 48), (-20, 0)]
ZONE_HOLE = [(-8, -8), (8, -8), (8, 8), (-8, 8)]


def _points() -> dict[str, Column]:
    """Pickup and drop-off coordinates of the layouts that have some; a few are zero."""
    start, end = F.col("start_id").cast("long"), F.col("end_id").cast("long")
    line, minute = F.col("duration").cast("long") % 60, F.floor(F.col("duration") / 60)

    def at(base: int, steps: Column) -> Column:
        inside = (F.lit(float(base)) + F.pmod(steps, F.lit(1024)) / F.lit(1024.0)).cast("string")
        return F.when(minute == 13, "0").when(minute == 14, "unknown").otherwise(inside)

    return {
        "pickup_latitude": at(40, start * 37 + line * 6 - 20),
        "pickup_longitude": at(-74, start * 91 + line * 5 - 30),
        "dropoff_latitude": at(40, end * 173 + minute * 59),
        "dropoff_longitude": at(-74, end * 311 + minute * 101),
    }


def raw_trips(spark: SparkSession, sf_dir: str, keep_second: bool = False) -> dict[str, DataFrame]:
    """Trips as raw columns of text, one table per file layout, not all of them well-formed.

    Bikes have birth years that are no numbers and blank ones; the taxi layouts with points have no
    location ids, and their names other letter case.
    """
    every = trips(spark, sf_dir)
    second = F.col("duration").cast("int") % 60

    def raw(mode: str, columns: list[str], at: Column, **given: Column | str) -> DataFrame:
        values = {k.lower(): v for k, v in given.items()}
        return every.where((F.col("mode") == mode) & at).select(*[
            (F.col(v) if isinstance(v, str) else v).cast("string").alias(c)
            for c in columns
            for v in [values.get(c.replace(" ", "_").lower(), F.lit("0"))]
        ], *([second.alias("second")] if keep_second else []))

    taxi = {"trip_distance": "distance", "payment_type": "payment_type", "trip_type": "trip_type",
            **_points(),
            "PULocationID": F.concat(F.lit(" "), "start_id"), "DOLocationID": "end_id"}
    year = F.when(second == 1, "\\N").when(second != 2, "1980")
    yes = F.lit(True)
    return {
        "bike": raw(BIKE, BIKE_COLUMNS, yes, tripduration="duration", starttime="pickup",
                    start_station_id="start_id", end_station_id="end_id", usertype="usertype",
                    birth_year=year),
        "yellow_zones": raw(YELLOW, TAXI_LAYOUTS["yellow_zones"], second % 2 == 0,
                            tpep_pickup_datetime="pickup", **taxi),
        "yellow_points": raw(YELLOW, TAXI_LAYOUTS["yellow_points"], second % 2 == 1,
                             tpep_pickup_datetime="pickup", **taxi),
        "green_zones": raw(GREEN, TAXI_LAYOUTS["green_zones"], second % 2 == 0,
                           lpep_pickup_datetime="pickup", **taxi),
        "green_points": raw(GREEN, TAXI_LAYOUTS["green_points"], second % 2 == 1,
                            lpep_pickup_datetime="pickup", **taxi),
    }


def write_raw_files(spark: SparkSession, sf_dir: str, folder: str) -> dict[str, str]:
    """Raw trips as CSV files with header lines, one folder a layout; some lines are cut or too long.

    Lines are written as one column, named like the header line, with a separator no line has.
    """
    paths = {}
    for layout, raw in raw_trips(spark, sf_dir, keep_second=True).items():
        columns = [c for c in raw.columns if c != "second"]
        line = F.concat_ws(",", *[F.coalesce(f"`{c}`", F.lit("")) for c in columns])
        spoilt = F.when(F.col("second") == 3, F.concat(line, F.lit(",more"))).when(
            F.col("second") == 4, F.substring_index(line, ",", 3)
        ).otherwise(line)
        paths[layout] = f"{folder}/{layout}"
        raw.select(spoilt.alias(",".join(columns))).write.options(
            header=True, sep="\x01", quote="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        ).csv(paths[layout])
    return paths


def zone_shapes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Rings (outer one and hole) and vertices of zones around the suppliers' places."""
    key = F.col("s_suppkey")
    zones = table(spark, sf_dir, "supplier")
    first, outer = key * 16, len(ZONE_RING)
    rings = zones.select(key.cast("int").alias("zone"), F.inline(F.array(
        F.struct(first.alias("first"), (first + outer - 1).alias("last")),
        F.struct((first + outer).alias("first"), (first + outer + len(ZONE_HOLE) - 1).alias("last")),
    )))
    steps = F.array(*[
        F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ZONE_RING + ZONE_HOLE
    ])
    vertices = zones.select(key.alias("s"), *_grid(key, 37, 91), F.posexplode(steps).alias("n", "step")).select(
        (F.col("s") * 16 + F.col("n")).alias("id"), (F.col("lat") + F.col("step.y") / F.lit(1024.0)).alias("lat"),
        (F.col("lon") + F.col("step.x") / F.lit(1024.0)).alias("lon"),
    )
    return rings, vertices


def wanted_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One date and hour for each region but the last."""
    key = F.col("r_regionkey")
    return table(spark, sf_dir, "region").where(key < 4).select(
        F.concat((key + 1993).cast("string"), F.lit("-0"), (key + 2).cast("string"), F.lit("-01")).alias("date"),
        F.lpad((key + 1).cast("string"), 2, "0").alias("hour"),
    )


def _grid(key: Column, a: int, b: int) -> list[Column]:
    """Coordinates inside one city, spread by the key."""
    return [
        (F.lit(40.0) + (key * a) % 1024 / F.lit(1024.0)).alias("lat"),
        (F.lit(-74.0) + (key * b) % 1024 / F.lit(1024.0)).alias("lon"),
    ]


def station_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as stations; one in thirteen has left the feed."""
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").where(key % 13 != 0).select(
        key.cast("string").alias("id"), F.col("s_name").alias("name"), *_grid(key, 37, 91)
    )


def known_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The previous lookup: one supplier in seventeen is missing, some zips are blank."""
    key = F.col("s_suppkey")
    zipcode = F.when(key % 19 == 0, "").otherwise(
        F.lpad((F.lit(10000) + F.col("s_nationkey")).cast("string"), 5, "0")
    )
    return table(spark, sf_dir, "supplier").where(key % 17 != 0).select(
        key.cast("string").alias("id"), zipcode.alias("zip"), *_grid(key, 37, 91)
    )


def customer_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.cast("string").alias("id"), *_grid(key, 53, 29)
    )


def zone_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rings per zone (100 and 50 vertices); suppliers are the zones."""
    base = F.col("s_suppkey") * 150
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("int").alias("zone"),
        F.inline(
            F.array(
                F.struct(base.alias("first"), (base + 99).alias("last")),
                F.struct((base + 100).alias("first"), (base + 149).alias("last")),
            )
        ),
    )


def zone_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as vertices, numbered by order key."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), *_grid(F.col("o_custkey"), 37, 91)
    )
