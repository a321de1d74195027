"""Pickup time texts -> hour cells ("date hour"), and the two halves of a cell.

A cell is the text before the first ``:``, cut to its first two blank-separated tokens.  Two
tokens at most means that a (date, hour) pair belongs to exactly one cell, so grouping on the
cell is the same as grouping on date and hour, with one key column less in the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import UNKNOWN_HOUR


def _before_colon(text: Column) -> Column:
    return F.substring_index(text, ":", 1)


def _two_tokens(text: Column) -> Column:
    return F.substring_index(F.rtrim(text), " ", 2)


def _iso_order(head: Column) -> Column:
    """Month/day/year [hour] -> year-month-day [hour], month and day with two digits."""
    month, day, year, hour = "([^/, ]*)", "([^/, ]*)", "([^/, ]+)", "([^/, ]*)"
    slashed = f"^{month}[/, ]{day}[/, ]{year}[/, ]?{hour}.*$"
    ordered = F.regexp_replace(head, slashed, "$3-$1-$2 $4")
    return F.regexp_replace(ordered, "-(.)(?=[- ])", "-0$1")


def time_cell(text: Column, may_be_slashed: Column) -> Column:
    """Hour cell of an ISO time or, where ``may_be_slashed``, of a month/day/year time.

    The hour stays as written.  A slashed text without an hour keeps just its date; one without
    a year, and any other form, is cut at the first ``:`` and kept.
    """
    head = _before_colon(text)
    slashed = may_be_slashed & F.contains(text, F.lit("/"))
    return _two_tokens(F.when(slashed, _iso_order(head)).otherwise(head))


def bike_time_cell(text: Column) -> Column:
    return time_cell(text, F.lit(True))


def taxi_time_cell(text: Column) -> Column:
    return time_cell(text, F.lit(False))


def cell_date(cell: Column) -> Column:
    return F.substring_index(cell, " ", 1)


def cell_hour(cell: Column) -> Column:
    """Second token of a cell, or the unknown-hour mark when there is none."""
    return F.when(F.contains(cell, F.lit(" ")), F.substring_index(cell, " ", -1)).otherwise(
        F.lit(UNKNOWN_HOUR)
    )


def pad_cell_hour(cell: Column) -> Column:
    """Give a one-digit hour its leading zero, so cells of all modes can meet."""
    hour = F.substring_index(cell, " ", -1)
    return F.when(
        F.contains(cell, F.lit(" ")) & (F.length(hour) == 1),
        F.concat(cell_date(cell), F.lit(" 0"), hour),
    ).otherwise(cell)
