"""Raw trip files -> the engine's trip table (one row per trip, see ``schemas.TRIP_SCHEMA``)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import (
    BIKE, BIKE_COLUMNS, BIKE_TYPED, GREEN, TAXI_LAYOUTS, TRIP_COLUMNS, TRIP_SCHEMA, YELLOW, all_text,
)

def _read_text_csv(
    spark: SparkSession, path: str | list[str], columns: list[str], header: bool, drop_malformed: bool
) -> DataFrame:
    """CSV with every column as text.

    With all columns text, malformed means of a wrong width.  ``columnPruning`` is off so that
    the parser looks at whole rows: otherwise the rows DROPMALFORMED leaves out depend on the
    columns a query happens to use.  With a header line, each file's own must name the columns in
    their order (letter case aside), else the job stops: without ``enforceSchema=False`` a file of
    another layout would be read by position, or left out whole for its width.
    """
    return (
        spark.read.schema(all_text(columns))
        .option("header", header)
        .option("enforceSchema", not header)
        .option("columnPruning", False)
        .option("mode", "DROPMALFORMED" if drop_malformed else "PERMISSIVE")
        .csv(path)
    )


#: What became of a line, and the text of one of a wrong width.
STATUS, WRONG_LINE = "line_status", "wrong_line"
KEPT, WRONG_WIDTH, WRONG_TYPE = "kept", "wrong_width", "wrong_type"


def _fits(name: str, type_name: str) -> Column:
    column = F.col(f"`{name}`")
    return column.isNull() | column.try_cast(type_name).isNotNull()


def _bike_types_fit() -> Column:
    return reduce(Column.__and__, [_fits(n, t) for n, t in BIKE_TYPED.items()])


def typed_bike(raw: DataFrame, drop_malformed: bool = True) -> DataFrame:
    """Raw bike columns as text -> the same with ``tripduration`` and ``birth year`` typed.

    A row that breaks a type is malformed and left out; else its broken value is NULL.
    """
    kept = raw.where(_bike_types_fit()) if drop_malformed else raw
    return kept.withColumns({n: F.col(f"`{n}`").try_cast(t) for n, t in BIKE_TYPED.items()})


def read_bike_csv(
    spark: SparkSession, path: str | list[str], header: bool = False, drop_malformed: bool = True
) -> DataFrame:
    """Bike files with their 15 raw columns, ``tripduration`` and ``birth year`` typed.

    Header lines need no option: their first field is no number, so they are malformed rows.
    ``header=True`` reads a sample with a header line the usual way.
    """
    return typed_bike(
        _read_text_csv(spark, path, BIKE_COLUMNS, header, drop_malformed), drop_malformed
    )


def _layout(spark: SparkSession, path: str | list[str], layout: str | list[str]) -> list[str]:
    if layout == "header":
        return spark.read.option("header", True).csv(path).columns
    return TAXI_LAYOUTS[layout] if isinstance(layout, str) else list(layout)


def read_taxi_csv(
    spark: SparkSession, path: str | list[str], layout: str | list[str] = "header",
    drop_malformed: bool = True,
) -> DataFrame:
    """Taxi files of ONE layout, every column as text.

    ``layout`` is a name from ``schemas.TAXI_LAYOUTS``, a list of column names, or ``"header"``
    to take the names from a file's own header line.  The header line of every file is held
    against it; a folder with files of another layout stops the job.  Read files of different
    layouts one by one and combine the results of :func:`taxi_trips`.
    """
    columns = _layout(spark, path, layout)
    return _read_text_csv(spark, path, columns, header=True, drop_malformed=drop_malformed)


def read_labelled(
    spark: SparkSession, path: str | list[str], mode: str, layout: str | list[str] = "header",
    header: bool = False,
) -> DataFrame:
    """All lines of raw files, as text, from one scan: the raw columns, ``line_status``, ``wrong_line``.

    A line is ``kept``, or of a ``wrong_width`` (its text is then in ``wrong_line``), or of a
    ``wrong_type``.  The readers that drop malformed rows drop just the lines that are not kept.
    Lines are all but blank ones and, where the reader knows of them, header lines (always for
    taxis, with ``header`` for bikes; else a bike header counts as of wrong type).
    """
    columns = BIKE_COLUMNS if mode == BIKE else _layout(spark, path, layout)
    header = header or mode != BIKE
    lines = (
        spark.read.schema(all_text(columns).add(WRONG_LINE, "string"))
        .option("header", header)
        .option("enforceSchema", not header)
        .option("columnPruning", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", WRONG_LINE)
        .csv(path)
    )
    fits = _bike_types_fit() if mode == BIKE else F.lit(True)
    never = F.length(f"`{columns[0]}`") < 0  # Spark wants a column of the file itself to be read
    status = F.when(F.col(WRONG_LINE).isNotNull() | never, WRONG_WIDTH).when(fits, KEPT).otherwise(WRONG_TYPE)
    return lines.withColumn(STATUS, status)


def kept_trips(labelled: DataFrame, mode: str) -> DataFrame:
    """The trip table of the lines that are kept."""
    raw = labelled.where(F.col(STATUS) == KEPT).drop(STATUS, WRONG_LINE)
    return bike_trips(typed_bike(raw, drop_malformed=False)) if mode == BIKE else taxi_trips(raw, mode)


def malformed_lines(labelled: DataFrame, mode: str) -> DataFrame:
    """How many lines are left out, and why: ``mode, lines, wrong_width, wrong_type``, one row."""
    status = F.col(STATUS)
    return labelled.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(status == WRONG_WIDTH).alias("wrong_width"),
        F.count_if(status == WRONG_TYPE).alias("wrong_type"),
    ).select(F.lit(mode).alias("mode"), "lines", "wrong_width", "wrong_type")


def malformed_rows(
    spark: SparkSession, path: str | list[str], mode: str, layout: str | list[str] = "header",
    header: bool = False,
) -> DataFrame:
    """What the readers leave out of raw files, see ``malformed_lines``; one scan."""
    return malformed_lines(read_labelled(spark, path, mode, layout, header), mode)


def _as_trips(
    raw: DataFrame, mode: str, fields: dict[str, str], may_lack: tuple[str, ...] = (),
    also: tuple[str, ...] = (),
) -> DataFrame:
    """Rename raw columns to trip fields; the columns ``also`` stay as they are.

    Names are found without regard to letter case and to blanks around them.  A raw layout that
    lacks a column for one of ``fields`` stops here, unless it is one of ``may_lack``, which are
    then NULL.  Location ids lose blanks around them, as they do in the lookups.
    """
    present = {c.strip().lower(): c for c in raw.columns}
    lacking = [
        c for f, c in fields.items() if c.lower() not in present and f not in may_lack
    ]
    if lacking:
        raise ValueError(f"{mode} files need the columns {lacking}; found {raw.columns}")
    out = []
    for field in TRIP_SCHEMA:
        source = present.get(fields.get(field.name, "").lower())
        if field.name == "mode":
            value = F.lit(mode)
        elif source is None:
            value = F.lit(None)
        else:
            value = F.col(f"`{source}`")
            value = F.trim(value) if field.name in ("start_id", "end_id") else value
        out.append(value.cast(field.dataType).alias(field.name))
    return raw.select(*out, *also)


#: Trip fields that a layout with points has no column for.
_LOCATIONS = ("start_id", "end_id")


def _taxi_fields(mode: str) -> dict[str, str]:
    fields = {
        "pickup": {YELLOW: "tpep_pickup_datetime", GREEN: "lpep_pickup_datetime"}[mode],
        "start_id": "PULocationID",
        "end_id": "DOLocationID",
        "distance": "trip_distance",
        "payment_type": "payment_type",
    }
    return fields | ({"trip_type": "trip_type"} if mode == GREEN else {})


def bike_trips(raw: DataFrame) -> DataFrame:
    """Raw bike columns -> trip table."""
    return _as_trips(
        raw,
        BIKE,
        {
            "pickup": "starttime",
            "start_id": "start station id",
            "end_id": "end station id",
            "duration": "tripduration",
            "usertype": "usertype",
        },
    )


def taxi_point_trips(raw: DataFrame, mode: str = YELLOW) -> DataFrame:
    """Raw taxi columns of a layout with points -> trip table with ``start_lat, start_lon, end_lat, end_lon``.

    Feed it to ``operators.locate_points``.  Coordinates that are no numbers are NULL.
    """
    names = {c.strip().lower(): c for c in raw.columns}
    points = {
        f"{end}_{part}": names.get(f"{word}_{name}")
        for end, word in (("start", "pickup"), ("end", "dropoff"))
        for part, name in (("lat", "latitude"), ("lon", "longitude"))
    }
    if None in points.values():
        raise ValueError(f"a layout with points is needed; found {raw.columns}")
    kept = raw.withColumns({f"_{p}": F.trim(F.col(f"`{c}`")).try_cast("double") for p, c in points.items()})
    return _as_trips(kept, mode, _taxi_fields(mode), _LOCATIONS, tuple(f"_{p}" for p in points)).select(
        *TRIP_COLUMNS, *[F.col(f"_{p}").alias(p) for p in points]
    )


def taxi_trips(raw: DataFrame, mode: str = YELLOW) -> DataFrame:
    """Raw taxi columns -> trip table.  A layout without location ids gives NULL ids."""
    return _as_trips(raw, mode, _taxi_fields(mode), _LOCATIONS)


def read_bike_trips(spark: SparkSession, path: str | list[str], header: bool = False) -> DataFrame:
    return bike_trips(read_bike_csv(spark, path, header))


def read_taxi_trips(
    spark: SparkSession, path: str | list[str], mode: str = YELLOW,
    layout: str | list[str] = "header", drop_malformed: bool = True,
) -> DataFrame:
    return taxi_trips(read_taxi_csv(spark, path, layout, drop_malformed), mode)


def all_trips(*parts: DataFrame) -> DataFrame:
    """Several trip tables as one."""
    return reduce(DataFrame.unionByName, [p.select(*TRIP_COLUMNS) for p in parts])
