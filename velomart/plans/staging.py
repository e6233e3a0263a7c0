"""Cleaned trips, cleaned station status, and the station-id mapping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velomart.functions import clean_text, elapsed, rounded_place, station_id_text
from velomart.operators import first_by, keep_latest
from velomart.operators.rules import raw_trip_rules, reason_text, split, status_rules, trip_rules
from velomart.params import Params

TRIP_COLUMNS = [
    "ride_id", "rideable_type", "started_at", "ended_at", "duration_seconds", "trip_date",
    "start_station_name", "start_station_id", "end_station_name", "end_station_id",
    "start_lat", "start_lng", "end_lat", "end_lng", "member_casual", "_source_file",
    "_ingested_at",
]


def _endpoint(side: str) -> Column:
    return F.struct(
        station_id_text(F.col(f"{side}_station_id"), stored=True).alias("station_id"),
        clean_text(F.col(f"{side}_station_name"), stored=True).alias("station_name"),
        rounded_place(F.col(f"{side}_lat")).alias("lat"),
        rounded_place(F.col(f"{side}_lng")).alias("lng"),
    )


def station_mentions(trips: DataFrame, *by: str) -> DataFrame:
    """How often each (station, name, place) stands at an end of a trip, per ``by``.

    Both ends of a trip come from one scan. Counts of parts of the trips add up.
    """
    keys = [*by, "station_id", "station_name", "lat", "lng"]
    return (
        trips.select(*by, F.inline(F.array(_endpoint("start"), _endpoint("end"))))
        .where(F.col("station_id").isNotNull())
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("mentions"))
    )


def station_id_mapping(trips: DataFrame, fold_name_case: bool = False) -> DataFrame:
    """Raw station id → canonical id; ids with the same usual name and place are merged.

    All heavy lifting is the first hash aggregation; what follows runs on distinct (id, name,
    place) combinations. ``fold_name_case`` compares names without case; the default compares
    them exactly.
    """
    return mapping_of(station_mentions(trips), fold_name_case)


def mapping_of(mentions: DataFrame, fold_name_case: bool = False) -> DataFrame:
    """The mapping from counted mentions, one row per combination."""
    most = -F.col("mentions")
    profile = mentions.groupBy("station_id").agg(
        first_by(F.col("station_name"), most).alias("station_name"),
        first_by(F.col("lat"), most).alias("lat"),
        first_by(F.col("lng"), most).alias("lng"),
        F.sum("mentions").alias("total_mentions"),
    )
    name = F.lower("station_name") if fold_name_case else F.col("station_name")
    place = {"_name": name, "_lat": F.col("lat"), "_lng": F.col("lng")}
    canonical = (
        profile.dropna(subset=["station_name", "lat", "lng"])
        .withColumns(place)
        .groupBy(*place)
        .agg(
            first_by(F.col("station_id"), -F.col("total_mentions")).alias("_canonical"),
            F.count(F.lit(1)).alias("_ids"),
        )
    )
    canonical_id = F.coalesce("_canonical", "station_id")
    return (
        profile.withColumns(place)
        .join(canonical, list(place), "left")
        .select(
            "station_id",
            canonical_id.alias("canonical_station_id"),
            "station_name",
            "lat",
            "lng",
            "total_mentions",
            (canonical_id != F.col("station_id")).alias("is_merged_duplicate"),
            F.coalesce("_ids", F.lit(1)).cast("long").alias("ids_in_group"),
        )
    )


def cleaned_trips(trips: DataFrame, mapping: DataFrame, *keep: str) -> DataFrame:
    """Trimmed trips with canonical station ids, duration and date, and the ``keep`` columns.

    ``_start`` and ``_end`` are the station ids as delivered.

    Only ids that were merged away change, so the joins see the few merged rows of
    ``mapping`` and not the whole of it. The stored mapping has an exact size: Catalyst
    broadcasts it while small and falls back to a skew-aware shuffle join beyond that.
    """
    merged = mapping.where("is_merged_duplicate")
    df = trips.select(
        clean_text(F.col("ride_id"), stored=True).alias("ride_id"),
        F.lower(clean_text(F.col("rideable_type"), stored=True)).alias("rideable_type"),
        "started_at",
        "ended_at",
        clean_text(F.col("start_station_name"), stored=True).alias("start_station_name"),
        clean_text(F.col("end_station_name"), stored=True).alias("end_station_name"),
        station_id_text(F.col("start_station_id"), stored=True).alias("_start"),
        station_id_text(F.col("end_station_id"), stored=True).alias("_end"),
        "start_lat",
        "start_lng",
        "end_lat",
        "end_lng",
        F.lower(clean_text(F.col("member_casual"), stored=True)).alias("member_casual"),
        "_source_file",
        "_ingested_at",
        *[c for c in keep if c in trips.columns],
    )
    for side in ("start", "end"):
        other = merged.select(
            F.col("station_id").alias(f"_{side}"),
            F.col("canonical_station_id").alias(f"_{side}_canonical"),
        )
        df = df.join(other, f"_{side}", "left").withColumn(
            f"{side}_station_id", F.coalesce(f"_{side}_canonical", f"_{side}")
        )
    seconds = elapsed("SECOND", F.col("ended_at"), F.col("started_at"))
    return (
        df.withColumn("duration_seconds", seconds)
        .withColumn("trip_date", F.to_date("started_at"))
        .select(*TRIP_COLUMNS, *keep)
    )


def tagged_trips(trips: DataFrame, mapping: DataFrame, p: Params, *keep: str) -> DataFrame:
    """Every cleaned trip with ``reason`` (shared rules) and ``raw_reason`` (the summary's own).

    A valid row has a NULL reason. The summary's rules see station ids as delivered.
    """
    ids = {"start_station_id": "_start", "end_station_id": "_end"}
    cleaned = cleaned_trips(trips, mapping, *keep, *ids.values())
    tagged = cleaned.withColumn("reason", F.nullif(reason_text(trip_rules(p)), F.lit("")))
    aside = tagged.withColumns({f"_{c}": F.col(c) for c in ids}).withColumns(
        {c: F.col(delivered) for c, delivered in ids.items()}
    )
    judged = aside.withColumn("raw_reason", F.nullif(reason_text(raw_trip_rules(p)), F.lit("")))
    return judged.select(
        *[F.col(f"_{c}").alias(c) if c in ids else F.col(c) for c in TRIP_COLUMNS],
        *keep,
        "reason",
        "raw_reason",
    )


def stg_trips(cleaned: DataFrame, p: Params) -> DataFrame:
    """Valid trips, one row per ride: the latest ingested, then the latest ended."""
    valid, _ = split(cleaned, trip_rules(p))
    return keep_latest(valid, ["ride_id"], ["_ingested_at", "ended_at"]).select(*TRIP_COLUMNS)


def stg_trips_through(cleaned: DataFrame, p: Params, last: str) -> DataFrame:
    """The columns of ``stg_trips`` up to ``last``, without carrying the others through the shuffle.

    Columns break ties in their order, so those behind ``last`` only choose between rows that
    agree on all that is returned here.
    """
    valid, _ = split(cleaned, trip_rules(p))
    names = TRIP_COLUMNS[: TRIP_COLUMNS.index(last) + 1]
    return keep_latest(valid.select(*names, "_ingested_at"), ["ride_id"], ["_ingested_at", "ended_at"]).select(*names)


def stg_trips_rejected(cleaned: DataFrame, p: Params) -> DataFrame:
    """Quarantined trips with their reasons; nothing is deduplicated."""
    _, rejected = split(cleaned, trip_rules(p))
    return quarantined(rejected, p)


def quarantined(rejected: DataFrame, p: Params, *keep: str) -> DataFrame:
    return rejected.select(
        *TRIP_COLUMNS[:-2],
        "rejection_reason",
        "_source_file",
        F.lit(p.as_of).cast("timestamp").alias("quarantined_at"),
        "_ingested_at",
        *keep,
    )


def cleaned_status(status: DataFrame) -> DataFrame:
    return status.withColumn("station_id", clean_text(F.col("station_id")))


def stg_station_status(cleaned: DataFrame, p: Params) -> DataFrame:
    """Valid status rows, one per ``status_dedup_key``: the latest poll wins."""
    valid, _ = split(cleaned, status_rules(p))
    latest_by = [c for c in ("_ingested_at", "snapshot_timestamp") if c not in p.status_dedup_key]
    latest = keep_latest(valid, p.status_dedup_key, latest_by)
    age = elapsed("SECOND", F.col("snapshot_timestamp"), F.col("last_reported"))
    names = [c for c in cleaned.columns if c not in ("_ingested_at", "_snapshot_date")]
    return latest.select(*names, age.alias("report_age_seconds"), "_ingested_at", "_snapshot_date")


def stg_station_status_rejected(cleaned: DataFrame, p: Params) -> DataFrame:
    _, rejected = split(cleaned, status_rules(p))
    return rejected.select(
        "station_id", "num_bikes_available", "num_docks_available", "is_installed", "is_renting",
        "is_returning", "is_disabled", "last_reported", "snapshot_timestamp", "rejection_reason",
        F.lit(p.as_of).cast("timestamp").alias("quarantined_at"), "_ingested_at",
    )
