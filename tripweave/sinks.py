"""Writers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .schemas import LOOKUP_FILE_COLUMNS


def write_table(
    df: DataFrame, path: str, partition_by: str | tuple[str, ...] | None = "date",
    sort_by: tuple[str, ...] = ("start_zip", "hour"), replace: str = "table",
) -> None:
    """Overwrite a parquet table, split by date so that a date filter skips the other folders.

    With ``replace="dates"`` only the dates that ``df`` has are overwritten (dynamic partition
    overwrite): a day that arrives late, or again, replaces its own folder and no other file.
    Spark writes the new files aside and moves them when all are there.

    ``rebalance`` groups rows by folder before writing (few files per date) and, unlike
    ``repartition``, lets adaptive execution spread one large date over several tasks.  Files are
    sorted by those of ``sort_by`` that the table has, so that a filter on the start zip skips row
    groups.
    """
    if replace not in ("table", "dates"):
        raise ValueError(f"replace must be 'table' or 'dates', not {replace!r}")
    if partition_by is None and replace == "dates":
        raise ValueError("a table that is not split by date has no dates to replace")
    if partition_by is None:
        df.write.mode("overwrite").parquet(path)
        return
    folders = (partition_by,) if isinstance(partition_by, str) else partition_by
    (
        df.hint("rebalance", *[F.col(c) for c in folders])
        .sortWithinPartitions(*folders, *[c for c in sort_by if c in df.columns])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if replace == "dates" else "static")
        .partitionBy(*folders)
        .parquet(path)
    )


def write_table_jdbc(
    df: DataFrame, url: str, table: str, options: dict[str, str] | None = None
) -> None:
    """Overwrite a database table.  ``options`` carries driver class, login, ``batchsize`` and
    ``numPartitions`` (the limit on open connections)."""
    (
        df.write.format("jdbc").mode("overwrite").option("url", url).option("dbtable", table)
        .options(**(options or {})).save()
    )


def write_mode_tables(rows: DataFrame, folder: str, replace: str = "table") -> None:
    """The tables of all modes, from ``operators.mode_rows``: one pass, one folder per mode and date.

    Read one with ``sources.read_mode_table``.
    """
    write_table(rows, folder, ("mode", "date"), replace=replace)


def write_audit_log(deltas: DataFrame, path: str, files: int | None = None) -> None:
    """``key delta`` lines.  Pass ``files=1`` for the one-file log of a single hour; a log over
    all hours is better left to as many files as there are tasks."""
    lines = deltas.select(F.concat_ws(" ", "key", F.col("delta").cast("string")).alias("value"))
    if files is not None:
        lines = lines.repartition(files)
    lines.write.mode("overwrite").text(path)


def write_lookup(lookup: DataFrame, path: str, kind: str = "station") -> None:
    """``id, zip, lat, lon`` as a lookup CSV with its usual header."""
    (
        lookup.select(
            F.col("id").alias(LOOKUP_FILE_COLUMNS[kind]),
            F.col("zip").alias("zipcode"),
            "lat",
            F.col("lon").alias("long"),
        )
        .write.mode("overwrite").option("header", True).csv(path)
    )


def write_golden(golden: DataFrame, path: str) -> None:
    golden.select("key", "count").write.mode("overwrite").option("header", True).csv(path)
