"""The eight dashboard marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velomart.functions import elapsed, percentage, round_to_long, safe_divide
from velomart.operators import first_by, with_percent_rank, with_rank, with_row_number
from velomart.params import UNMAPPED_STATION_PREFIX, Params
from velomart.plans.intermediate import current_rows
from velomart.workspace import materialize


def _count_if(condition: Column, name: str) -> Column:
    return F.count_if(condition).alias(name)


def _metres() -> Column:
    """Distance as whole metres: sums of integers do not depend on the row order."""
    return round_to_long(F.col("distance_km") * 1000)


def _rounded_minutes(seconds: Column) -> Column:
    return F.round(seconds / 60, 2)


def daily_totals(trips: DataFrame, *by: str) -> DataFrame:
    return trips.groupBy(*by, "trip_date").agg(
        F.count(F.lit(1)).alias("total_trips"),
        _count_if(F.col("member_casual") == "member", "member_trips"),
        _count_if(F.col("member_casual") == "casual", "casual_trips"),
        _count_if(F.col("rideable_type") == "electric_bike", "ebike_trips"),
        _count_if(F.col("rideable_type") == "classic_bike", "classic_trips"),
        _rounded_minutes(F.avg("duration_seconds")).alias("avg_duration_minutes"),
        F.round(F.sum(_metres()) / 1000, 1).alias("total_distance_km"),
        F.countDistinct("start_station_id").alias("active_start_stations"),
    )


def trip_summary_daily(trips: DataFrame, dates: DataFrame) -> DataFrame:
    return summary_of_days(daily_totals(trips), dates)


def summary_of_days(daily: DataFrame, dates: DataFrame) -> DataFrame:
    days = dates.select("date_day", "date_key", "day_name", "is_weekend")
    return daily.join(days, F.col("trip_date") == F.col("date_day"), "left").select(
        F.col("trip_date").alias("date_day"),
        "date_key",
        "day_name",
        "is_weekend",
        "total_trips",
        "member_trips",
        "casual_trips",
        "ebike_trips",
        "classic_trips",
        "avg_duration_minutes",
        "total_distance_km",
        "active_start_stations",
        percentage(F.col("member_trips"), F.col("total_trips")).alias("member_share_pct"),
    )


def station_popularity(demand: DataFrame) -> DataFrame:
    return demand.select(
        "station_id", "station_name", "lat", "lng", "departure_count", "arrival_count",
        "total_activity", "net_flow", "activity_rank",
    )


def hourly_cells(trips: DataFrame, *by: str) -> DataFrame:
    """Counts and seconds per weekday and hour; cells of parts of the trips add up."""
    return trips.groupBy(*by, "day_of_week", "start_hour").agg(
        F.count(F.lit(1)).alias("total_trips"),
        _count_if(F.col("member_casual") == "member", "member_trips"),
        _count_if(F.col("member_casual") == "casual", "casual_trips"),
        F.sum("duration_seconds").alias("seconds"),
        F.count("duration_seconds").alias("timed"),
    )


def usage_pattern_hourly(trips: DataFrame, dates: DataFrame) -> DataFrame:
    return usage_of_cells(hourly_cells(trips), dates)


def usage_of_cells(cells: DataFrame, dates: DataFrame) -> DataFrame:
    """The hourly pattern from cells, several to a weekday and hour perhaps."""
    counted = ("total_trips", "member_trips", "casual_trips", "seconds", "timed")
    cells = cells.groupBy("day_of_week", "start_hour").agg(*[F.sum(c).alias(c) for c in counted])
    average = _rounded_minutes(safe_divide(F.col("seconds"), F.col("timed")))
    cells = cells.withColumn("avg_duration_minutes", average).drop("seconds", "timed")
    cells = materialize(cells, "hourly")  # 168 rows at most, read again for the total
    total = cells.agg(F.sum("total_trips")).scalar()
    names = dates.select("day_of_week", "day_name", "is_weekend").distinct()
    return cells.join(names, "day_of_week", "left").select(
        "day_of_week",
        "day_name",
        "is_weekend",
        "start_hour",
        "total_trips",
        "member_trips",
        "casual_trips",
        "avg_duration_minutes",
        percentage(F.col("total_trips"), total, 4).alias("share_of_total_pct"),
    )


def duration_histogram(trips: DataFrame, *by: str) -> DataFrame:
    """Trips per (segment, duration in seconds) and what is summed over them; parts add up."""
    return trips.groupBy(*by, "member_casual", "duration_seconds").agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum(_metres()).alias("metres"),
        F.count("distance_km").alias("measured"),
        _count_if(F.col("rideable_type") == "electric_bike", "ebikes"),
        _count_if(F.col("start_hour").between(7, 9), "morning"),
        _count_if(F.col("start_hour").between(17, 19), "evening"),
    )


def member_vs_casual_behavior(
    trips: DataFrame, dates: DataFrame, rider_types: DataFrame
) -> DataFrame:
    """Rider segments side by side.

    The trips are first hash-aggregated per (segment, duration in seconds). A valid duration
    has at most ``max_trip_duration_seconds`` values, so that histogram is small and gives
    the exact median (lower of two middle values) without a sketch or a sort of the trips.
    """
    weekend = F.coalesce("is_weekend", F.lit(False))
    days = dates.select(F.col("date_day").alias("trip_date"), "is_weekend")
    dated = trips.join(days, "trip_date", "left").withColumn("is_weekend", weekend)
    return behavior_of_histogram(duration_histogram(dated, "is_weekend"), rider_types)


def behavior_of_histogram(histogram: DataFrame, rider_types: DataFrame) -> DataFrame:
    """The segments from histograms with ``is_weekend``, several to a duration perhaps."""
    summed = ("trips", "metres", "measured", "ebikes", "morning", "evening")
    histogram = histogram.groupBy("member_casual", "duration_seconds").agg(
        *[F.sum(c).alias(c) for c in summed],
        F.sum(F.when(F.col("is_weekend"), F.col("trips")).otherwise(0)).alias("weekend"),
        F.sum(F.when(F.col("is_weekend"), 0).otherwise(F.col("trips"))).alias("weekday"),
    )
    segment = Window.partitionBy("member_casual")
    upto = segment.orderBy("duration_seconds").rowsBetween(Window.unboundedPreceding, 0)
    reached = F.sum("trips").over(upto) * 2 >= F.sum("trips").over(segment)
    seconds = F.col("duration_seconds")
    median = F.min(F.when(F.col("_reached"), seconds))
    segments = (
        histogram.withColumn("_reached", reached)
        .groupBy("member_casual")
        .agg(
            F.sum("trips").alias("total_trips"),
            _rounded_minutes(F.sum(seconds * F.col("trips")) / F.sum("trips")).alias(
                "avg_duration_minutes"
            ),
            _rounded_minutes(median).alias("median_duration_minutes"),
            F.round(safe_divide(F.sum("metres"), F.sum("measured")) / 1000, 3).alias(
                "avg_distance_km"
            ),
            F.sum("ebikes").alias("ebike_trips"),
            F.sum("weekend").alias("weekend_trips"),
            F.sum("weekday").alias("weekday_trips"),
            F.sum("morning").alias("morning_peak_trips"),
            F.sum("evening").alias("evening_peak_trips"),
        )
    )
    segments = materialize(segments, "segments")
    total = segments.agg(F.sum("total_trips")).scalar()
    trips_, c = F.col("total_trips"), F.col
    return segments.join(rider_types, "member_casual", "left").select(
        "rider_type_key",
        "member_casual",
        "description",
        "total_trips",
        percentage(trips_, total).alias("share_of_total_pct"),
        "avg_duration_minutes",
        "median_duration_minutes",
        "avg_distance_km",
        "ebike_trips",
        percentage(c("ebike_trips"), trips_).alias("ebike_share_pct"),
        "weekend_trips",
        "weekday_trips",
        percentage(c("weekend_trips"), trips_).alias("weekend_share_pct"),
        "morning_peak_trips",
        "evening_peak_trips",
    )


def station_availability_realtime(facts: DataFrame, latest: DataFrame, p: Params) -> DataFrame:
    labels = p.availability_labels
    label = F.when(~F.col("is_operational"), labels["not_operational"])
    for level in ("empty", "full", "low", "high", "unknown_capacity"):
        label = label.when(F.col("risk_level") == level, labels[level])
    return current_rows(facts, latest).select(
        "gbfs_station_id",
        "legacy_station_id",
        "station_key",
        "station_name",
        "region_id",
        "lat",
        "lng",
        "capacity",
        F.col("snapshot_timestamp").alias("last_snapshot_at"),
        "last_reported",
        "report_age_seconds",
        "num_bikes_available",
        "num_ebikes_available",
        "num_docks_available",
        "occupancy_rate_pct",
        "is_operational",
        "is_stale",
        "risk_level",
        "risk_severity",
        label.otherwise(labels["otherwise"]).alias("availability_label"),
    )


def station_risk_monitoring(facts: DataFrame, latest: DataFrame, p: Params) -> DataFrame:
    """Operational stations that need bikes or docks now, most urgent first."""
    c = F.col
    short, full = c("risk_level").isin("empty", "low"), c("risk_level").isin("full", "high")
    half = round_to_long(c("capacity") * 0.5)
    at_least_one = F.lit(1).cast("long")
    to_move = F.when(short, F.greatest(at_least_one, half - c("num_bikes_available"))).when(
        full, F.greatest(at_least_one, c("num_bikes_available") - half)
    )
    action = (
        F.when(short, p.action_labels["send"])
        .when(full, p.action_labels["collect"])
        .otherwise(p.action_labels["otherwise"])
    )
    at_risk = (
        current_rows(facts, latest)
        .where(c("is_operational") & ~c("is_stale") & (c("capacity") > 0) & (short | full))
        .select(
            "gbfs_station_id",
            "legacy_station_id",
            "station_key",
            "station_name",
            "region_id",
            "lat",
            "lng",
            "capacity",
            c("snapshot_timestamp").alias("last_snapshot_at"),
            "last_reported",
            "report_age_seconds",
            "num_bikes_available",
            "num_docks_available",
            "occupancy_rate_pct",
            "risk_level",
            "risk_severity",
            action.alias("recommended_action"),
            to_move.alias("bikes_to_move"),
        )
    )
    urgency = [
        c("risk_severity").desc_nulls_last(),
        c("occupancy_rate_pct").asc_nulls_first(),
        c("capacity").desc_nulls_last(),
        c("gbfs_station_id").asc_nulls_first(),
        c("last_reported").asc_nulls_first(),
    ]
    return with_row_number(at_risk, urgency, "risk_rank")


def station_supply_demand(demand: DataFrame, p: Params) -> DataFrame:
    flow, risk, labels = F.col("net_flow"), F.col("risk_level"), p.direction_labels
    direction = (
        F.when((flow > 0) & risk.isin("empty", "low"), labels["supply"])
        .when((flow < 0) & risk.isin("full", "high"), labels["drain"])
        .when(flow > 0, labels["demand"])
        .when(flow < 0, labels["surplus"])
        .otherwise(labels["otherwise"])
    )
    return demand.select(
        "station_id", "station_name", "region_id", "lat", "lng", "departure_count",
        "arrival_count", "total_activity", "net_flow", "activity_rank", "demand_pressure_rank",
        "activity_share", "capacity", "num_bikes_available", "num_docks_available",
        "occupancy_rate_pct", "risk_level", "imbalance_pct", "last_snapshot_at",
        "is_priority_supply", "is_priority_drain", direction.alias("imbalance_direction"),
    )


def station_movement(changes: DataFrame, *by: str) -> DataFrame:
    """Changes per station as it was named; those of parts of the archive add up."""
    c = F.col
    return changes.groupBy(*by, "gbfs_station_id", "station_name", "legacy_station_id").agg(
        F.count(F.lit(1)).alias("changes"),
        F.count_if(c("op") == "u").alias("updates"),
        F.sum(F.abs(F.coalesce("delta_bikes", F.lit(0)))).alias("bikes"),
        F.sum(F.abs(F.coalesce("delta_docks", F.lit(0)))).alias("docks"),
        F.min("valid_from").alias("first_at"),
        F.max("valid_from").alias("last_at"),
    )


def station_volatility(changes: DataFrame, p: Params) -> DataFrame:
    """How much each station moves, from the change archive."""
    return volatility_of_movement(station_movement(changes), p)


def volatility_of_movement(movement: DataFrame, p: Params) -> DataFrame:
    """The volatility of stations from movements, several to a station and name perhaps."""
    c = F.col
    named = movement.groupBy("gbfs_station_id", "station_name", "legacy_station_id").agg(
        *[F.sum(n).alias(n) for n in ("changes", "updates", "bikes", "docks")],
        F.min("first_at").alias("first_at"),
        F.max("last_at").alias("last_at"),
    )
    newest = -F.unix_micros("last_at")
    minutes = elapsed("MINUTE", F.max("last_at"), F.min("first_at"))
    stations = (
        named.groupBy("gbfs_station_id")
        .agg(
            first_by(c("station_name"), newest).alias("_name"),
            first_by(c("legacy_station_id"), newest).alias("legacy_station_id"),
            F.sum("changes").alias("change_count"),
            F.sum("updates").alias("update_count"),
            F.sum("bikes").alias("bikes_moved"),
            F.sum("docks").alias("docks_moved"),
            F.min("first_at").alias("first_change_at"),
            F.max("last_at").alias("last_change_at"),
            (minutes / F.lit(60.0)).alias("_span"),
        )
        .withColumn("total_moved", c("bikes_moved") + c("docks_moved"))
        .withColumn("_rate", safe_divide(c("change_count"), c("_span")))
        .withColumn("_rate_or_zero", F.coalesce("_rate", F.lit(0.0)))
    )
    stations = materialize(stations, "volatility")
    ranked = with_percent_rank(stations, "_rate_or_zero", "_position")
    ranked = with_rank(ranked, "total_moved", "movement_rank")
    labels = p.volatility_labels
    unmapped = F.concat(
        F.lit(UNMAPPED_STATION_PREFIX), F.substring("gbfs_station_id", 1, 8), F.lit(")")
    )
    label = (
        F.when(c("_position") >= p.volatility_top, labels["top"])
        .when(c("_position") >= p.volatility_high, labels["high"])
        .otherwise(labels["otherwise"])
    )
    return ranked.select(
        "gbfs_station_id",
        "legacy_station_id",
        F.coalesce("_name", unmapped).alias("station_name"),
        "change_count",
        "update_count",
        "bikes_moved",
        "docks_moved",
        "total_moved",
        "first_change_at",
        "last_change_at",
        F.round("_span", 2).alias("span_hours"),
        F.round("_rate", 2).alias("changes_per_hour"),
        label.alias("volatility_label"),
        "movement_rank",
    )
