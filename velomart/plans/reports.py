"""Published dashboard and runbook queries. Top-k lists are sorted with a full tie-break."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velomart.functions import percentage, round_to_long
from velomart.params import Params

# Column names of the weekday matrix, Monday first.
WEEKDAYS = ("mon", "tue", "wed", "thu", "fri", "sat", "sun")


def daily_trend(daily: DataFrame) -> DataFrame:
    return daily.select(
        "date_day", "total_trips", "member_trips", "casual_trips", "avg_duration_minutes"
    ).orderBy("date_day")


def busiest_stations(popularity: DataFrame, k: int = 10) -> DataFrame:
    return (
        popularity.select(
            "activity_rank", "station_id", "station_name", "departure_count", "arrival_count",
            "total_activity", "net_flow",
        )
        .orderBy("activity_rank", "station_id")
        .limit(k)
    )


def stations_within_rank(popularity: DataFrame, k: int = 10) -> DataFrame:
    """All stations ranked k or better; ties at the edge stay in."""
    return popularity.where(F.col("activity_rank") <= k)


def net_flow_extremes(popularity: DataFrame, k: int = 5) -> DataFrame:
    """The k stations that lose most bikes and the k that gain most."""
    columns = ["station_id", "station_name", "total_activity", "net_flow", "activity_rank"]
    rows = popularity.select(*columns)
    losing = rows.orderBy(F.desc("net_flow"), "station_id").limit(k)
    gaining = rows.orderBy(F.asc("net_flow"), "station_id").limit(k)
    return losing.withColumn("direction", F.lit("out")).unionByName(
        gaining.withColumn("direction", F.lit("in"))
    )


def heatmap_cells(hourly: DataFrame) -> DataFrame:
    return hourly.select(
        "day_of_week", "day_name", "start_hour", "total_trips", "member_trips", "casual_trips",
        "share_of_total_pct",
    ).orderBy("day_of_week", "start_hour")


def heatmap_by_day_name(hourly: DataFrame) -> DataFrame:
    return (
        hourly.groupBy("day_name", "start_hour")
        .agg(F.sum("total_trips").alias("total_trips"))
        .orderBy("day_name", "start_hour")
    )


def heatmap_matrix(hourly: DataFrame) -> DataFrame:
    """Hour by weekday with a total column."""
    cells = hourly.groupBy("start_hour").pivot("day_of_week", list(range(1, 8)))
    named = cells.agg(F.sum("total_trips")).select(
        "start_hour",
        *[F.coalesce(F.col(str(i)), F.lit(0)).alias(d) for i, d in enumerate(WEEKDAYS, 1)],
    )
    total = sum((F.col(d) for d in WEEKDAYS[1:]), F.col(WEEKDAYS[0]))
    return named.withColumn("total_all_days", total).orderBy("start_hour")


def segment_comparison(segments: DataFrame) -> DataFrame:
    return segments.select(
        "member_casual", "description", "total_trips", "share_of_total_pct",
        "avg_duration_minutes", "median_duration_minutes", "avg_distance_km", "ebike_share_pct",
        "weekend_share_pct", "morning_peak_trips", "evening_peak_trips",
    ).orderBy(F.desc("total_trips"), "member_casual")


def map_pins(availability: DataFrame, only_at_risk: bool = False) -> DataFrame:
    pins = availability.dropna(subset=["lat", "lng"]).select(
        "gbfs_station_id", "station_name", "region_id", "lat", "lng", "capacity",
        "num_bikes_available", "num_ebikes_available", "num_docks_available",
        "occupancy_rate_pct", "risk_level", "risk_severity", "availability_label",
        "is_operational", "is_stale", "last_snapshot_at", "report_age_seconds",
    )
    if only_at_risk:
        pins = pins.where(F.col("risk_level").isin("empty", "low", "high", "full"))
    return pins.orderBy(F.desc("risk_severity"), "gbfs_station_id")


def risk_work_list(risks: DataFrame) -> DataFrame:
    return risks.select(
        "risk_rank", "station_name", "region_id", "capacity", "num_bikes_available",
        "num_docks_available", F.round("occupancy_rate_pct", 1).alias("occupancy_pct"),
        "risk_level", "recommended_action", "bikes_to_move", "last_reported",
        "report_age_seconds",
    ).orderBy("risk_rank")


def _priorities(stations: DataFrame, stock: str) -> DataFrame:
    return stations.select(
        "station_id", "station_name", "net_flow", "total_activity", "activity_rank", "capacity",
        stock, F.round("occupancy_rate_pct", 1).alias("occupancy_pct"), "risk_level",
        "imbalance_direction",
    )


def priority_supply(stations: DataFrame, k: int = 10) -> DataFrame:
    """Stations that lose bikes and are short now."""
    rows = _priorities(stations.where("is_priority_supply"), "num_bikes_available")
    return rows.orderBy(F.desc("net_flow"), "station_id").limit(k)


def priority_drain(stations: DataFrame, k: int = 10) -> DataFrame:
    """Stations that gain bikes and are full now."""
    rows = _priorities(stations.where("is_priority_drain"), "num_docks_available")
    return rows.orderBy(F.asc("net_flow"), "station_id").limit(k)


def most_volatile(volatility: DataFrame, k: int = 10) -> DataFrame:
    return (
        volatility.select(
            "gbfs_station_id", "station_name", "bikes_moved", "docks_moved", "total_moved",
            "change_count", "changes_per_hour", "volatility_label",
        )
        .orderBy(F.desc("total_moved"), "gbfs_station_id")
        .limit(k)
    )


def longest_dwell(windows: DataFrame, k: int = 10) -> DataFrame:
    """Longest closed empty or full windows that are not gaps in the data."""
    return (
        windows.where(F.col("duration_minutes").isNotNull() & ~F.col("is_possible_gap"))
        .where(F.col("risk_level").isin("empty", "full"))
        .select("gbfs_station_id", "station_name", "risk_level", "duration_minutes",
                F.col("valid_from").alias("started"))
        .orderBy(F.desc("duration_minutes"), "gbfs_station_id", "started")
        .limit(k)
    )


def movement_by_changes(changes: DataFrame, k: int = 10) -> DataFrame:
    return (
        changes.groupBy("gbfs_station_id")
        .agg(
            F.count(F.lit(1)).alias("changes"),
            F.sum(F.abs("delta_bikes")).alias("bikes_moved"),
        )
        .orderBy(F.desc("changes"), "gbfs_station_id")
        .limit(k)
    )


def quarantine_week(metrics: DataFrame, p: Params, days: int = 7) -> DataFrame:
    """Quarantine share of the last days from ``dq_metrics``."""
    since = p.as_of.date() - dt.timedelta(days=days)
    return (
        metrics.where(F.col("run_date") >= F.lit(since))
        .select("run_date", "layer", "total_rows", "rejected_rows",
                F.round("rejected_pct", 2).alias("rejected_pct"))
        .orderBy(F.desc("run_date"), "layer")
    )


def freshness_card(availability: DataFrame) -> DataFrame:
    """Stations of the current snapshot: total, fresh, stale, median age.

    The rows are one snapshot, one per station; ages are counted per value first, so the
    median comes from the distinct ages.
    """
    ages = availability.groupBy("report_age_seconds", "is_stale").agg(
        F.count(F.lit(1)).alias("n")
    )
    stale = F.sum(F.when(F.col("is_stale"), F.col("n")).otherwise(0))
    fresh = F.sum(F.when(F.col("report_age_seconds") <= 600, F.col("n")).otherwise(0))
    return ages.agg(
        F.sum("n").alias("total_stations"),
        fresh.alias("fresh_10_minutes"),
        stale.alias("stale"),
        round_to_long(F.percentile("report_age_seconds", F.lit(0.5), F.col("n"))).alias(
            "median_age_seconds"
        ),
        percentage(stale, F.sum("n")).alias("stale_pct"),
    )


def snapshot_buckets(facts: DataFrame, size: str = "1 day") -> DataFrame:
    """Average stock per tumbling time bucket; works on a batch and on a stream."""
    return (
        facts.groupBy(F.window("snapshot_timestamp", size).alias("w"))
        .agg(
            F.count(F.lit(1)).alias("observations"),
            F.sum("num_bikes_available").alias("bikes"),
            F.sum("num_docks_available").alias("docks"),
        )
        .select(F.col("w.start").alias("bucket_start"), F.col("w.end").alias("bucket_end"),
                "observations", "bikes", "docks")
    )
