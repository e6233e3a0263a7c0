"""Star schema: two facts and the shared dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from velomart.functions import date_key, haversine_km, iso_day_of_week, surrogate_key
from velomart.params import RIDER_TYPES, Params


def _key_or_null(name: str) -> Column:
    return F.when(F.col(name).isNotNull(), surrogate_key(F.col(name)))


def fct_trips(trips: DataFrame, p: Params, *keep: str) -> DataFrame:
    """One row per valid trip, with the ``keep`` columns."""
    distance = haversine_km(
        F.col("start_lat"), F.col("start_lng"), F.col("end_lat"), F.col("end_lng"),
        p.earth_radius_km,
    )
    return trips.select(
        surrogate_key(F.col("ride_id")).alias("trip_key"),
        _key_or_null("start_station_id").alias("start_station_key"),
        _key_or_null("end_station_id").alias("end_station_key"),
        _key_or_null("member_casual").alias("rider_type_key"),
        date_key(F.col("trip_date")).alias("start_date_key"),
        "ride_id",
        "rideable_type",
        "member_casual",
        "started_at",
        "ended_at",
        "trip_date",
        F.hour("started_at").cast("long").alias("start_hour"),
        iso_day_of_week(F.col("started_at")).alias("day_of_week"),
        "duration_seconds",
        "start_station_id",
        "end_station_id",
        "start_station_name",
        "end_station_name",
        "start_lat",
        "start_lng",
        "end_lat",
        "end_lng",
        F.round(distance, 3).alias("distance_km"),
        "_source_file",
        "_ingested_at",
        *keep,
    )


def fct_station_status(risk: DataFrame) -> DataFrame:
    """One row per kept station observation."""
    day = F.to_date("snapshot_timestamp")
    return risk.select(
        surrogate_key(F.col("gbfs_station_id"), F.col("snapshot_timestamp")).alias(
            "station_status_key"
        ),
        "station_key",
        "legacy_station_id",
        "gbfs_station_id",
        date_key(day).alias("snapshot_date_key"),
        "station_name",
        "region_id",
        "lat",
        "lng",
        "snapshot_timestamp",
        day.alias("snapshot_date"),
        F.hour("snapshot_timestamp").cast("long").alias("snapshot_hour"),
        iso_day_of_week(F.col("snapshot_timestamp")).alias("snapshot_day_of_week"),
        "last_reported",
        "report_age_seconds",
        "num_bikes_available",
        "num_ebikes_available",
        "num_scooters_available",
        "num_docks_available",
        "num_bikes_disabled",
        "num_docks_disabled",
        "capacity",
        "occupancy_rate_pct",
        "is_installed",
        "is_renting",
        "is_returning",
        "is_disabled",
        "is_operational",
        "is_unknown_station",
        "is_stale",
        "is_capacity_inconsistent",
        "risk_level",
        "risk_severity",
        "_ingested_at",
    )


def dim_date(
    trips: DataFrame,
    status: DataFrame,
    p: Params,
    trip_day: str = "trip_date",
    status_day: str = "_snapshot_date",
) -> DataFrame:
    """One row per day covering both facts and a look-ahead after ``as_of``.

    Each input is reduced to its first and last day; a stored partition column answers
    that from metadata.
    """

    def span(df: DataFrame, day: str) -> DataFrame:
        return df.agg(
            F.coalesce(F.min(day), F.lit(p.calendar_default_start)).alias("first_day"),
            F.coalesce(F.max(day), F.lit(p.calendar_default_end)).alias("last_day"),
        )

    ahead = p.as_of.date() + dt.timedelta(days=p.calendar_lookahead_days)
    spans = span(trips, trip_day).unionByName(span(status, status_day))
    bounds = spans.agg(F.min("first_day").alias("lo"), F.max("last_day").alias("hi"))
    day = F.col("date_day")
    dow = iso_day_of_week(day)

    def part(name: str) -> Column:
        return F.extract(F.lit(name), day).cast("long")

    return bounds.select(
        F.explode(F.sequence("lo", F.greatest(F.col("hi"), F.lit(ahead)))).alias("date_day")
    ).select(
        date_key(day).alias("date_key"),
        "date_day",
        part("YEAR").alias("year"),
        part("QUARTER").alias("quarter"),
        part("MONTH").alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        part("DAY").alias("day_of_month"),
        part("YEAROFWEEK").alias("iso_year"),
        part("WEEK").alias("iso_week"),
        dow.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        dow.isin(6, 7).alias("is_weekend"),
    )


def dim_rider_type(spark: SparkSession) -> DataFrame:
    types = [
        F.struct(F.lit(name).alias("member_casual"), F.lit(text).alias("description"))
        for name, text in RIDER_TYPES.items()
    ]
    rows = spark.range(0, 1, 1, 1).select(F.inline(F.array(*types)))
    return rows.select(
        surrogate_key(F.col("member_casual")).alias("rider_type_key"),
        "member_casual",
        "description",
    )


def dim_station(bridge: DataFrame) -> DataFrame:
    """The bridge already is the station dimension, one row per station."""
    return bridge
