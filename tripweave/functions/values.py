"""Numbers, shares, zips and keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import UNKNOWN_ZIP


def minutes(seconds: Column) -> Column:
    """Seconds -> minutes with two decimals, halves up on the binary value.

    ``F.round`` rounds the decimal text of a double instead and differs on some halves
    (61.5 s is 1.02 here, 1.03 there).
    """
    return F.floor(seconds / F.lit(60.0) * F.lit(100.0) + F.lit(0.5)) / F.lit(100.0)


def number(text: Column, on_bad: str = "fail") -> Column:
    """Text -> double.  ``on_bad="fail"`` stops the job on a non-number, with or without ANSI
    mode; ``"drop"`` gives NULL, for the caller to filter."""
    parsed = text.try_cast("double")
    if on_bad == "drop":
        return parsed
    if on_bad != "fail":
        raise ValueError(f"on_bad must be 'fail' or 'drop', not {on_bad!r}")
    failure = F.raise_error(F.concat(F.lit("not a number: "), text)).cast("double")
    return F.coalesce(parsed, F.when(text.isNotNull(), failure))


#: Fixed-point scales of the two parts of an exact sum: 16 bits after the point, and 32 more.
_COARSE, _FINE = 2.0 ** 16, 2.0 ** 32
#: Values from here on, and NaN, are added as they are.
_LARGE = 2.0 ** 46


def sum_parts(value: Column) -> dict[str, Column]:
    """Aggregates that add doubles without regard to their order: ``coarse``, ``fine``, ``rest``, ``n``.

    Each value is cut into two whole numbers, of 2**-16 and 2**-48, and those are added as longs,
    so any partitioning and any merge gives the same bits (digits beyond 2**-48 do not count).  A sum
    beyond 1.4e14 stops the job in ANSI mode.  Values from 2**46 on are added as doubles.
    """
    scaled = value * _COARSE
    whole = F.floor(scaled)
    fits = F.abs(value) < _LARGE
    return {
        "coarse": F.sum(F.when(fits, whole)),
        "fine": F.sum(F.when(fits, F.floor((scaled - whole) * _FINE))),
        "rest": F.sum(F.when(~fits, value)),
        "n": F.count(value),
    }


def sum_of(parts: dict[str, Column]) -> Column:
    """The sum as a double, from its parts (or the sums of parts of several batches); NULL of no value."""
    exact = parts["coarse"] / F.lit(_COARSE) + parts["fine"] / F.lit(_COARSE * _FINE)
    return F.when(parts["rest"].isNull(), exact).otherwise(F.coalesce(exact, F.lit(0.0)) + parts["rest"])


def mean_of(parts: dict[str, Column]) -> Column:
    return F.when(parts["n"] > 0, sum_of(parts) / parts["n"])


def exact_sum(value: Column) -> Column:
    """The sum of doubles, the same in every order of rows."""
    return sum_of(sum_parts(value))


def exact_mean(value: Column) -> Column:
    """The mean of doubles, the same in every order of rows."""
    return mean_of(sum_parts(value))


def share(part: Column, total: Column) -> Column:
    """part / total as a double between 0 and 1."""
    return part.cast("double") / total.cast("double")


def known_zip(zipcode: Column) -> Column:
    """A missing or blank zip becomes the unknown zip."""
    return F.coalesce(F.nullif(zipcode, F.lit("")), F.lit(UNKNOWN_ZIP))


def cell_key(start_zip: Column, end_zip: Column, date: Column, hour: Column) -> Column:
    """The audit key: both zips, date and hour, joined without a separator."""
    return F.concat(start_zip, end_zip, date, hour)
