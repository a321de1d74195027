"""Time the headline queries and print one JSON line.

BENCH_SF_DIR   folder of the test tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_RUNS     timed runs per query after one warm-up; the median counts (default 3)

"baseline" holds two slower ways to the multimodal profile, for comparison: separate aggregates
joined per mode and then across modes over cached trips, and one aggregate per mode joined across
modes.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave import build_session
from tripweave import driver_tables as d
from tripweave.functions import cell_date, cell_hour, minutes
from tripweave.plans.profiles import located_trips
from tripweave.registry import QUERIES
from tripweave.schemas import BIKE, GREEN, YELLOW

HEADLINE = [
    "multimodal_profile", "bike_profile", "yellow_profile", "green_profile", "citi_table",
    "trips_per_cell", "zip_lookup", "destinations_from_zip", "golden_counts", "audit_clean",
    "refresh_lookup", "zone_lookup", "nearest_zip", "card_share", "audit_hour", "nearest_zip_descent",
]


def separate_aggregates(spark, sf_dir: str) -> DataFrame:
    """Ten aggregates and ten joins: each count, share and mean on its own."""
    located = located_trips(d.trips(spark, sf_dir), *d.lookups(spark, sf_dir)).persist()
    cell = ["time_cell", "start_zip", "end_zip"]
    profiles = []
    for mode in (BIKE, YELLOW, GREEN):
        trips = located.where(F.col("mode") == mode)

        def counted(df, name):
            return df.groupBy(*cell).agg(F.count(F.lit(1)).alias(f"{mode}_{name}"))

        part = F.col("usertype") == "Subscriber" if mode == BIKE else F.col("payment_type") == "1"
        measure = "duration" if mode == BIKE else "distance"
        pieces = [
            counted(trips, "trips"),
            counted(trips.where(part), "part"),
            trips.groupBy(*cell).agg(F.avg(measure).alias(f"{mode}_mean")),
        ]
        joined = reduce(lambda a, b: a.join(b, cell), pieces)
        if mode == GREEN:
            dispatched = counted(trips, "all").join(
                counted(trips.where(F.col("trip_type") == "2"), "dispatched"), cell, "left"
            )
            joined = joined.join(dispatched, cell)
        if mode == BIKE:
            joined = joined.withColumn("bike_mean", minutes(F.col("bike_mean")))
        c = F.col("time_cell")
        profiles.append(
            joined.withColumn(f"{mode}_share", F.col(f"{mode}_part") / F.col(f"{mode}_trips"))
            .withColumns({"date": cell_date(c), "hour": cell_hour(c)}).drop("time_cell")
        )
    keys = ["date", "hour", "start_zip", "end_zip"]
    out = reduce(lambda a, b: a.join(b, keys, "full"), profiles)
    out._located = located
    return out


def run(build, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    df = build(spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    took = time.perf_counter() - start
    if hasattr(df, "_located"):
        df._located.unpersist(blocking=True)
    return took


def timed(build, spark, sf_dir: str, runs: int) -> float:
    run(build, spark, sf_dir)
    return round(statistics.median(run(build, spark, sf_dir) for _ in range(runs)), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {name: timed(QUERIES[name], spark, sf_dir, runs) for name in HEADLINE}
    baseline = {
        "multimodal_separate_aggregates": timed(separate_aggregates, spark, sf_dir, runs),
        "multimodal_joined_profiles": timed(QUERIES["multimodal_profile_joined"], spark, sf_dir, runs),
    }
    print(
        json.dumps(
            {
                "metric": "headline queries, summed median seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "baseline": baseline,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
