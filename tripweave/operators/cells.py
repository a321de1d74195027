"""Located trips -> counts, shares and means per cell.

One aggregate computes everything a mode needs.  For the multimodal table, trips of all modes in
one table take one aggregate as well; separate tables take one each and are merged.  Counts, sums
and means combine before the shuffle, so a cell that holds a third of all trips costs each task
one partial row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cell_date, cell_hour, exact_mean, mean_of, minutes, share, sum_parts
from ..schemas import BIKE, CELL_KEYS, GREEN, MODES, YELLOW

GROUP = ["time_cell", "start_zip", "end_zip"]

# --- Fixed values: what the raw files write ----------------------------------------------
SUBSCRIBER = "Subscriber"
CREDIT_CARD = "1"
DISPATCHED = "2"

# Profile columns of each mode, in table order.
MODE_COLUMNS = {
    BIKE: ["bike_trip_count", "sub_percent", "bike_duration"],
    YELLOW: [
        "yellow_trip_count", "yellow_cc_count", "yellow_cc_percent", "yellow_trip_distance_avg",
    ],
    GREEN: [
        "green_trip_count", "green_cc_count", "green_cc_percent", "green_trip_distance_avg",
        "green_dispatch_percent",
    ],
}


def _part(mode: str) -> Column:
    """The trips whose share is reported: subscribers on bikes, card payers in taxis."""
    if mode == BIKE:
        return F.col("usertype") == SUBSCRIBER
    return F.col("payment_type") == CREDIT_CARD


def _measures(mode: str, literal_dispatch: bool = False) -> dict[str, Column]:
    of_mode = F.col("mode") == mode
    measure = F.col("duration" if mode == BIKE else "distance")
    out = {
        "trips": F.count_if(of_mode),
        "part": F.count_if(of_mode & _part(mode)),
        "mean": exact_mean(F.when(of_mode, measure)),
    }
    if mode == GREEN:
        out["dispatched"] = (
            F.count_if(of_mode) if literal_dispatch
            else F.count_if(of_mode & (F.col("trip_type") == DISPATCHED))
        )
    return out


def _split_cell(cells: DataFrame) -> DataFrame:
    """Replace ``time_cell`` by ``date`` and ``hour``."""
    rest = [c for c in cells.columns if c not in GROUP and c != "mode"]
    lead = ["mode"] if "mode" in cells.columns else []
    cell = F.col("time_cell")
    return cells.select(
        *lead, cell_date(cell).alias("date"), cell_hour(cell).alias("hour"), "start_zip", "end_zip",
        *rest,
    )


def cell_counts(located: DataFrame) -> DataFrame:
    """Trips per mode and cell."""
    return _split_cell(
        located.groupBy("mode", *GROUP).agg(F.count(F.lit(1)).alias("trip_count"))
    )


def mode_cells(
    located: DataFrame, mode: str, keep_zero_share: bool = False, literal_dispatch: bool = False,
    split_cell: bool = True,
) -> DataFrame:
    """One mode's ``trips, part, mean`` (and ``dispatched``) per cell.

    Cells in which no trip belongs to the reported part (no subscriber, no card payer) are left
    out unless ``keep_zero_share``.
    """
    measures = _measures(mode, literal_dispatch)
    cells = (
        located.where(F.col("mode") == mode)
        .groupBy(*GROUP)
        .agg(*[c.alias(n) for n, c in measures.items()])
    )
    if not keep_zero_share:
        cells = cells.where(F.col("part") > 0)
    return _split_cell(cells) if split_cell else cells


def taxi_cells(located: DataFrame, keep_zero_share: bool = False) -> DataFrame:
    """``mode`` and cell of all taxi trips with their ``trips, part, mean``, from one aggregate."""
    cells = located.where(F.col("mode") != BIKE).groupBy("mode", *GROUP).agg(
        F.count(F.lit(1)).alias("trips"),
        F.count_if(_part(YELLOW)).alias("part"),
        exact_mean(F.col("distance")).alias("mean"),
    )
    return _split_cell(cells if keep_zero_share else cells.where(F.col("part") > 0))


def profile_columns(mode: str, prefix: str = "") -> dict[str, Column]:
    """Profile columns of one mode, from its measures (named with ``prefix``)."""
    trips, part, mean, dispatched = (
        F.col(prefix + n) for n in ("trips", "part", "mean", "dispatched")
    )
    names = MODE_COLUMNS[mode]
    if mode == BIKE:
        values = [trips, share(part, trips), minutes(mean)]
    else:
        values = [trips, part, share(part, trips), mean]
        if mode == GREEN:
            values.append(share(dispatched, trips))
    return dict(zip(names, values, strict=True))


def all_mode_cells(
    located: DataFrame, how: str = "full", keep_zero_share: bool = False,
    literal_dispatch: bool = False,
) -> DataFrame:
    """The columns of all three modes per cell, from one aggregate over one table of trips.

    Equals joining the three mode profiles on the cell (``how`` is ``"full"`` or ``"inner"``):
    a mode that has no profile row for a cell has NULLs there.
    """
    measures = {
        f"{mode}_{name}": column
        for mode in MODES
        for name, column in _measures(mode, literal_dispatch).items()
    }
    cells = located.groupBy(*GROUP).agg(*[c.alias(n) for n, c in measures.items()])
    return _profile_rows(cells, how, keep_zero_share)


def merged_mode_cells(
    located: dict[str, DataFrame], how: str = "full", keep_zero_share: bool = False,
    literal_dispatch: bool = False,
) -> DataFrame:
    """The same from one table of trips per mode.

    Each mode is aggregated with its own few measures; the cells are then put side by side by a
    union and a second aggregate.  All have the same partitioning, so Spark plans that aggregate
    without another shuffle, and without the sorts of a join.
    """
    parts, names = [], []
    for mode, trips in located.items():
        measures = _measures(mode, literal_dispatch)
        names += [f"{mode}_{n}" for n in measures]
        cells = trips.where(F.col("mode") == mode).groupBy(*GROUP)
        parts.append(cells.agg(*[c.alias(f"{mode}_{n}") for n, c in measures.items()]))
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    side_by_side = merged.groupBy(*GROUP).agg(*[F.max(n).alias(n) for n in names])
    return _profile_rows(side_by_side, how, keep_zero_share)


def _reported(literal_dispatch: bool = False) -> dict[str, Column]:
    """What one aggregate with the mode in its key counts: trips, the reported part, dispatched ones."""
    part = F.when(F.col("mode") == BIKE, _part(BIKE)).otherwise(_part(YELLOW))
    dispatched = F.lit(True) if literal_dispatch else F.col("trip_type") == DISPATCHED
    return {
        "trips": F.count(F.lit(1)),
        "part": F.count_if(part),
        "dispatched": F.count_if((F.col("mode") == GREEN) & dispatched),
    }


def _measure() -> Column:
    return F.when(F.col("mode") == BIKE, F.col("duration")).otherwise(F.col("distance"))


def mode_rows(
    located: DataFrame, keep_zero_share: bool = False, literal_dispatch: bool = False
) -> DataFrame:
    """``mode``, ``date``, ``hour``, cell, ``trips, part, dispatched, mean`` of all modes: one aggregate."""
    rows = located.groupBy("mode", *GROUP).agg(
        *[c.alias(n) for n, c in _reported(literal_dispatch).items()],
        exact_mean(_measure()).alias("mean"),
    )
    kept = rows if keep_zero_share else rows.where(F.col("part") > 0)
    cell = F.col("time_cell")
    return kept.withColumns({"date": cell_date(cell), "hour": cell_hour(cell)})


_COUNTS = ["trips", "part", "dispatched"]
_PARTS = ["coarse", "fine", "rest", "n"]
#: Columns of a table of cell states.
STATE_COLUMNS = ["mode", "date", *GROUP, *_COUNTS, *_PARTS]


def cell_states(located: DataFrame, literal_dispatch: bool = False) -> DataFrame:
    """What has to be kept of a batch of trips so that it can be merged with others.

    One row per mode and cell: counts, and the parts of an order-free sum of durations or distances.
    """
    rows = located.groupBy("mode", *GROUP).agg(
        *[c.alias(n) for n, c in _reported(literal_dispatch).items()],
        *[c.alias(n) for n, c in sum_parts(_measure()).items()],
    )
    return rows.withColumn("date", cell_date(F.col("time_cell"))).select(*STATE_COLUMNS)


def merge_states(*batches: DataFrame) -> DataFrame:
    """The states of all batches together, the same as of all their trips."""
    every = reduce(DataFrame.unionByName, [b.select(*STATE_COLUMNS) for b in batches])
    return every.groupBy("mode", "date", *GROUP).agg(
        *[F.sum(c).alias(c) for c in _COUNTS + _PARTS]
    ).select(*STATE_COLUMNS)


def cells_from_states(states: DataFrame, how: str = "full", keep_zero_share: bool = False) -> DataFrame:
    """The multimodal table from states, which may be those of several batches: one aggregate."""
    def of_mode(mode: str, column: str) -> Column:
        return F.sum(F.when(F.col("mode") == mode, F.col(column)))

    measures = {}
    for mode in MODES:
        measures |= {f"{mode}_{c}": F.coalesce(of_mode(mode, c), F.lit(0)) for c in _COUNTS}
        measures[f"{mode}_mean"] = mean_of({c: of_mode(mode, c) for c in _PARTS})
    cells = states.groupBy(*GROUP).agg(*[c.alias(n) for n, c in measures.items()])
    return _profile_rows(cells, how, keep_zero_share)


def _profile_rows(cells: DataFrame, how: str, keep_zero_share: bool) -> DataFrame:
    """Measures of all modes per cell -> profile columns, NULL where a mode has no profile row."""
    if how not in ("full", "inner"):
        raise ValueError(f"how must be 'full' or 'inner', not {how!r}")
    cells = _split_cell(cells)
    counts = {m: F.col(f"{m}_trips" if keep_zero_share else f"{m}_part") for m in MODES}
    present = {m: F.coalesce(n, F.lit(0)) > 0 for m, n in counts.items()}
    bike, yellow, green = (present[m] for m in MODES)
    wanted = (bike | yellow | green) if how == "full" else (bike & yellow & green)
    columns = [
        F.when(present[mode], value).alias(name)
        for mode in MODES
        for name, value in profile_columns(mode, f"{mode}_").items()
    ]
    return cells.where(wanted).select(*CELL_KEYS, *columns)
