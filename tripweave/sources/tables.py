"""Result tables and golden counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.sizing import broadcast_if_small
from ..plans.profiles import mode_table
from ..schemas import GOLDEN_SCHEMA


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table written by ``sinks.write_table``; a filter on ``date`` reads only its folders.

    Dates are text here.  Left alone, Spark would guess the folder names to be of date type.
    """
    found = spark.read.parquet(path).schema
    schema = T.StructType(
        [T.StructField(f.name, T.StringType() if f.name == "date" else f.dataType) for f in found]
    )
    return spark.read.schema(schema).parquet(path)


def read_mode_table(spark: SparkSession, folder: str, mode: str) -> DataFrame:
    """One mode's stand-alone table, of those written by ``sinks.write_mode_tables``; only its folders are read."""
    return mode_table(read_table(spark, folder).where(F.col("mode") == mode), mode)


def read_slices(spark: SparkSession, path: str, wanted: DataFrame, **limits: int) -> DataFrame:
    """The rows of a table written by ``sinks.write_table`` that agree with a row of ``wanted``.

    ``wanted`` has columns of the table, ``date`` among them, e.g. the dates and hours to audit.
    If it is measured to be small it is broadcast, and Spark takes its dates to prune the folders
    to read while the query runs: any number of slices takes one pass over their folders.
    """
    table = read_table(spark, path)
    strange = [c for c in wanted.columns if c not in table.columns]
    if strange or "date" not in wanted.columns:
        raise ValueError(f"slices need a date and columns of the table, not {wanted.columns}")
    once = wanted.groupBy(*wanted.columns).agg(F.count(F.lit(1)).alias("_times"))
    once = once.where("_times > 0").drop("_times")  # Spark tries to prune by a side with a filter only
    return table.join(broadcast_if_small(once, **limits), wanted.columns, "left_semi")


def read_table_jdbc(
    spark: SparkSession, url: str, table: str, options: dict[str, str] | None = None,
    where: str | None = None,
) -> DataFrame:
    """A database table; ``where`` is run by the database, as is any later simple filter.

    Give ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions`` in ``options``
    to read a large table with more than one task.  The driver class and the login belong in
    ``options`` too.
    """
    source = f"(select * from {table} where {where}) as slice" if where else table
    return (
        spark.read.format("jdbc").option("url", url).option("dbtable", source)
        .options(**(options or {})).load()
    )


def read_golden(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Golden counts as ``key, count``.  Read as text and cast, so a bad count fails the job."""
    return (
        spark.read.schema("key string, count string")
        .option("header", True)
        .csv(path)
        .select("key", F.col("count").cast("long").alias("count"))
        .to(GOLDEN_SCHEMA)
    )
