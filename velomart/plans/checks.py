"""The declared data tests of every model."""

from __future__ import annotations

from velomart.operators.quality import (
    Check,
    accepted_values,
    expression_is_true,
    not_null,
    relationship,
    unique,
    unique_combination,
)
from velomart.params import Params

# Accepted categories.
RISK_LEVELS = ("empty", "low", "balanced", "high", "full", "not_operational", "unknown_capacity")
RIDEABLE_TYPES = ("classic_bike", "electric_bike")
RIDER_TYPES = ("member", "casual")


def _between(model: str, column: str, low: int, high: int) -> Check:
    return expression_is_true(model, f"{column}_range", f"{column} BETWEEN {low} AND {high}")


def _at_least(model: str, column: str, low: int) -> Check:
    return expression_is_true(model, f"{column}_at_least_{low}", f"{column} >= {low}")


def declared_checks(p: Params) -> list[Check]:
    longest = p.max_trip_duration_seconds
    return [
        # staging
        *not_null("stg_trips", "ride_id", "started_at", "ended_at", "duration_seconds", "trip_date"),
        *unique("stg_trips", "ride_id"),
        _at_least("stg_trips", "duration_seconds", 0),
        expression_is_true(
            "stg_trips", "duration_seconds_at_most", f"duration_seconds <= {longest}"
        ),
        accepted_values("stg_trips", "rideable_type", RIDEABLE_TYPES),
        accepted_values("stg_trips", "member_casual", RIDER_TYPES),
        *not_null("station_id_mapping", "station_id", "canonical_station_id"),
        *unique("station_id_mapping", "station_id"),
        *not_null("stg_trips_rejected", "rejection_reason", "quarantined_at"),
        unique_combination("stg_station_status", "station_id", "last_reported"),
        *not_null(
            "stg_station_status", "station_id", "num_bikes_available", "num_docks_available",
            "last_reported", "snapshot_timestamp",
        ),
        _at_least("stg_station_status", "num_bikes_available", 0),
        _at_least("stg_station_status", "num_docks_available", 0),
        *not_null("stg_station_status_rejected", "rejection_reason", "quarantined_at"),
        # intermediate
        *not_null("stations_deduplicated", "station_id"),
        *unique("stations_deduplicated", "station_id"),
        unique_combination("trips_dq_summary", "_source_file", "rejection_reason"),
        *not_null("trips_dq_summary", "_source_file", "row_count"),
        expression_is_true(
            "station_id_bridge", "has_capacity_info", "has_capacity_info = (capacity IS NOT NULL)"
        ),
        *not_null("station_id_bridge", "has_capacity_info"),
        unique_combination("station_risk", "gbfs_station_id", "last_reported"),
        *not_null("station_risk", "gbfs_station_id", "risk_level"),
        accepted_values("station_risk", "risk_level", RISK_LEVELS),
        *not_null("demand_vs_supply", "station_id"),
        *unique("demand_vs_supply", "station_id"),
        _between("demand_vs_supply", "activity_share", 0, 1),
        unique_combination("status_changes", "gbfs_station_id", "valid_from"),
        expression_is_true(
            "status_changes", "bikes_before", "op = 'u' OR bikes_before IS NULL"
        ),
        *not_null("status_changes", "gbfs_station_id", "valid_from"),
        accepted_values("status_changes", "op", ("c", "u")),
        *not_null("status_windows", "valid_from"),
        # star schema
        *not_null("dim_station", "station_key", "station_id"),
        *unique("dim_station", "station_key", "station_id", "gbfs_station_id"),
        *not_null("dim_date", "date_key", "date_day"),
        *unique("dim_date", "date_key", "date_day"),
        accepted_values("dim_date", "day_of_week", (1, 2, 3, 4, 5, 6, 7)),
        *not_null("dim_rider_type", "rider_type_key", "member_casual"),
        *unique("dim_rider_type", "rider_type_key", "member_casual"),
        accepted_values("dim_rider_type", "member_casual", RIDER_TYPES),
        *not_null("fct_trips", "trip_key", "ride_id", "trip_date", "duration_seconds"),
        *unique("fct_trips", "trip_key", "ride_id"),
        _at_least("fct_trips", "duration_seconds", 0),
        _between("fct_trips", "start_hour", 0, 23),
        relationship("fct_trips", "start_station_key", "dim_station", "station_key"),
        relationship("fct_trips", "end_station_key", "dim_station", "station_key"),
        relationship("fct_trips", "start_date_key", "dim_date", "date_key"),
        relationship("fct_trips", "rider_type_key", "dim_rider_type", "rider_type_key"),
        *not_null(
            "fct_station_status", "station_status_key", "gbfs_station_id", "snapshot_timestamp",
            "snapshot_date", "num_bikes_available", "num_docks_available", "risk_level",
        ),
        *unique("fct_station_status", "station_status_key"),
        _at_least("fct_station_status", "num_bikes_available", 0),
        _at_least("fct_station_status", "num_docks_available", 0),
        _between("fct_station_status", "occupancy_rate_pct", 0, 100),
        accepted_values("fct_station_status", "risk_level", RISK_LEVELS),
        relationship("fct_station_status", "station_key", "dim_station", "station_key"),
        relationship("fct_station_status", "snapshot_date_key", "dim_date", "date_key"),
        # marts
        *not_null("trip_summary_daily", "date_day", "total_trips"),
        *unique("trip_summary_daily", "date_day"),
        _between("trip_summary_daily", "member_share_pct", 0, 100),
        *not_null("station_popularity", "station_id", "total_activity"),
        *unique("station_popularity", "station_id"),
        _at_least("station_popularity", "departure_count", 0),
        _at_least("station_popularity", "arrival_count", 0),
        unique_combination("usage_pattern_hourly", "day_of_week", "start_hour"),
        _between("usage_pattern_hourly", "start_hour", 0, 23),
        _between("usage_pattern_hourly", "share_of_total_pct", 0, 100),
        *not_null("member_vs_casual_behavior", "member_casual"),
        *unique("member_vs_casual_behavior", "member_casual"),
        _between("member_vs_casual_behavior", "share_of_total_pct", 0, 100),
        *not_null(
            "station_availability_realtime", "gbfs_station_id", "last_snapshot_at",
            "availability_label",
        ),
        *unique("station_availability_realtime", "gbfs_station_id"),
        _between("station_availability_realtime", "occupancy_rate_pct", 0, 100),
        *not_null(
            "station_risk_monitoring", "gbfs_station_id", "risk_level", "recommended_action",
            "bikes_to_move", "risk_rank",
        ),
        *unique("station_risk_monitoring", "gbfs_station_id"),
        accepted_values("station_risk_monitoring", "risk_level", ("empty", "low", "high", "full")),
        _at_least("station_risk_monitoring", "bikes_to_move", 1),
        *not_null("station_supply_demand", "station_id", "imbalance_direction"),
        *unique("station_supply_demand", "station_id"),
        _between("station_supply_demand", "activity_share", 0, 1),
        *not_null("station_volatility", "gbfs_station_id", "change_count", "total_moved"),
        *unique("station_volatility", "gbfs_station_id"),
        _at_least("station_volatility", "change_count", 1),
        accepted_values(
            "station_volatility", "volatility_label", tuple(p.volatility_labels.values())
        ),
    ]
