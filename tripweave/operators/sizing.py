"""Measure before broadcasting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A city has some thousand stations and some hundred zones; these bounds leave ample room and
# still fit every executor many times over.
MAX_BROADCAST_ROWS = 500_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def are_small(
    *tables: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> list[bool]:
    """Count rows and text bytes of each table: one distributed aggregate each, run as one job;
    one row per table comes back."""
    measured = []
    for i, df in enumerate(tables):
        width = F.lit(0).cast("long")
        for field in df.schema:
            text = F.col(f"`{field.name}`").cast("string")
            width = width + F.coalesce(F.octet_length(text), F.lit(0)) + 8
        measured.append(
            df.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("bytes")).select(
                F.lit(i).alias("i"), "n", "bytes"
            )
        )
    found = {row["i"]: row for row in reduce(DataFrame.union, measured).collect()}
    return [
        found[i]["n"] <= max_rows and (found[i]["bytes"] or 0) <= max_bytes
        for i in range(len(tables))
    ]


def broadcast_if_small(df: DataFrame, **limits: int) -> DataFrame:
    """``df`` marked for broadcast if it is measured to be small, else unchanged.

    Unchanged means a shuffle join, where adaptive execution splits partitions that a hot key
    makes too large.
    """
    return F.broadcast(df) if are_small(df, **limits)[0] else df
