"""Full refreshes at $BENCH_SF_DIR on local[$BENCH_CPUS], every step timed.

The raw tables are derived and stored, the models are built in dependency order, and every
mart and report reads the stored facts, as in a scheduled run. Each step's figure is the median
of $BENCH_RUNS refreshes (3; no further one is begun after $BENCH_SECONDS). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import fixture_views as fx
import workload
from velomart.plans import intermediate, profiling, reports
from velomart.plans.models import Models
from velomart.sources import storage
from velomart.workspace import SESSION_SETTINGS, application_dir

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
SECONDS = float(os.environ.get("BENCH_SECONDS", "240"))

STEPS: dict[str, Callable[[Models], DataFrame]] = {
    "station_id_mapping": lambda m: m.station_id_mapping,
    "fct_trips": lambda m: m.fct_trips,
    "station_id_bridge": lambda m: m.station_id_bridge,
    "fct_station_status": lambda m: m.stored_fct_station_status,
    "latest_complete_snapshot": lambda m: m.latest_complete_snapshot,
    "status_changes": lambda m: m.stored_status_changes,
    "dim_date": lambda m: m.dim_date,
    "trip_summary_daily": lambda m: m.trip_summary_daily,
    "usage_pattern_hourly": lambda m: m.usage_pattern_hourly,
    "member_vs_casual": lambda m: m.member_vs_casual_behavior,
    "demand_vs_supply": lambda m: m.demand_vs_supply,
    "station_popularity": lambda m: m.station_popularity,
    "supply_demand": lambda m: m.station_supply_demand,
    "availability_realtime": lambda m: m.station_availability_realtime,
    "risk_monitoring": lambda m: m.station_risk_monitoring,
    "status_windows": lambda m: m.status_windows,
    "station_volatility": lambda m: m.station_volatility,
    "stg_trips_rejected": lambda m: m.stg_trips_rejected,
    "dq_summary": lambda m: m.trips_dq_summary,
    "dq_per_file": lambda m: intermediate.dq_per_file(m.trips_dq_summary, m.params),
    "quarantine_gate": lambda m: m.trip_gate.unionByName(m.status_gate),
    "heatmap_matrix": lambda m: reports.heatmap_matrix(m.usage_pattern_hourly),
    "net_flow_extremes": lambda m: reports.net_flow_extremes(m.station_popularity),
    "dwell_top10": lambda m: reports.longest_dwell(m.status_windows),
    "profile_trips": lambda m: profiling.trip_profile(m.raw_trips, m.params),
    "profile_station_ids": lambda m: profiling.station_id_profile(m.raw_trips),
}
ALONE = ("global_rank_distributed",)


def session() -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("velomart-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", CPUS)
    )
    for pair in os.environ.get("BENCH_CONF", "").split():
        builder = builder.config(*pair.split("=", 1))
    for key, value in SESSION_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def warm_up(spark: SparkSession) -> None:
    """Run every step once on the smallest tables, untimed, so class loading is not measured."""
    smallest = os.path.join(os.path.dirname(SF_DIR.rstrip("/")), "sf0.001")
    if os.environ.get("BENCH_WARM_UP", "1") == "1" and os.path.isdir(smallest):
        models = fx.models(spark, smallest, store_trips=True)
        for step in STEPS.values():
            run(step(models))


def refresh(spark: SparkSession) -> dict[str, float]:
    seconds: dict[str, float] = {}

    def timed(name: str, work: Callable[[], object]) -> object:
        start = time.perf_counter()
        result = work()
        seconds[name] = time.perf_counter() - start
        return result

    models = timed("raw_tables", lambda: fx.models(spark, SF_DIR, store_trips=True))
    for name, step in STEPS.items():
        timed(name, lambda step=step: run(step(models)))
    for name in ALONE:
        timed(name, lambda name=name: run(workload.QUERIES[name].run(spark, SF_DIR)))
    return seconds


def main() -> None:
    spark = session()
    warm_up(spark)
    began, refreshes = time.perf_counter(), []
    while len(refreshes) < RUNS and (not refreshes or time.perf_counter() - began < SECONDS):
        refreshes.append(refresh(spark))
    seconds = {name: round(statistics.median(r[name] for r in refreshes), 3) for name in refreshes[0]}
    print(
        json.dumps(
            {
                "metric": "full_refresh_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR).removeprefix("sf"),
                "refreshes": [round(sum(r.values()), 3) for r in refreshes],
            }
        )
    )
    storage.delete(spark, [application_dir(spark)])
    spark.stop()


if __name__ == "__main__":
    main()
