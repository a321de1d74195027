"""Column expressions.  All are built-in Catalyst functions, so they stay in generated code."""

from .times import bike_time_cell, cell_date, cell_hour, pad_cell_hour, taxi_time_cell, time_cell
from .values import (
    cell_key, exact_mean, exact_sum, known_zip, mean_of, minutes, number, share, sum_of, sum_parts,
)

__all__ = [
    "bike_time_cell", "taxi_time_cell", "time_cell", "pad_cell_hour", "cell_date", "cell_hour",
    "minutes", "number", "share", "known_zip", "cell_key",
    "sum_parts", "sum_of", "mean_of", "exact_sum", "exact_mean",
]
