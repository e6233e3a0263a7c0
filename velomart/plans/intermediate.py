"""Stations, risk, snapshots, demand versus supply, change archive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velomart.functions import (
    clean_text,
    elapsed,
    round_to_long,
    safe_divide,
    station_id_text,
    surrogate_key,
)
from velomart.operators import (
    first_by,
    keep_latest,
    signed_endpoints,
    with_neighbor,
    with_rank,
)
from velomart.operators.rules import is_valid, raw_trip_rules, reason_text, trip_rules
from velomart.params import Params
from velomart.plans.staging import stg_trips
from velomart.workspace import materialize


def station_sightings(trips: DataFrame, *by: str) -> DataFrame:
    """Mentions and first and last sighting of each (station, name, place), per ``by``."""

    def end(side: str, time: str) -> Column:
        return F.struct(
            F.col(f"{side}_station_id").alias("station_id"),
            F.col(f"{side}_station_name").alias("station_name"),
            F.col(f"{side}_lat").alias("lat"),
            F.col(f"{side}_lng").alias("lng"),
            F.col(time).alias("seen_at"),
        )

    ends = F.inline(F.array(end("start", "started_at"), end("end", "ended_at")))
    return (
        trips.select(*by, ends)
        .where(F.col("station_id").isNotNull())
        .groupBy(*by, "station_id", "station_name", "lat", "lng")
        .agg(
            F.count(F.lit(1)).alias("mentions"),
            F.min("seen_at").alias("first_seen_at"),
            F.max("seen_at").alias("last_seen_at"),
        )
    )


def stations_deduplicated(trips: DataFrame) -> DataFrame:
    """One row per station seen in the trips, with its latest non-null name and place.

    Distinct (station, name, place) combinations are hash-aggregated first; the arg-max
    then runs on those few rows instead of on two rows per trip.
    """
    return stations_of(station_sightings(trips))


def stations_of(seen: DataFrame) -> DataFrame:
    """The stations from sightings, which may be those of parts of the trips together."""
    seen = seen.groupBy("station_id", "station_name", "lat", "lng").agg(
        F.sum("mentions").alias("mentions"),
        F.min("first_seen_at").alias("first_seen_at"),
        F.max("last_seen_at").alias("last_seen_at"),
    )
    newest = -F.unix_micros(F.col("last_seen_at").cast("timestamp"))
    return seen.groupBy("station_id").agg(
        first_by(F.col("station_name"), newest).alias("station_name"),
        first_by(F.col("lat"), newest).alias("lat"),
        first_by(F.col("lng"), newest).alias("lng"),
        F.sum("mentions").alias("trip_mentions"),
        F.min("first_seen_at").alias("first_seen_at"),
        F.max("last_seen_at").alias("last_seen_at"),
    )


def station_id_bridge(stations: DataFrame, information: DataFrame) -> DataFrame:
    """Trip stations bridged to the feed through ``short_name``; also the station dimension."""
    info = keep_latest(
        information.where(F.col("short_name").isNotNull()).select(
            "short_name",
            F.col("station_id").alias("gbfs_station_id"),
            F.col("name").alias("_name"),
            F.when(F.col("capacity") > 0, F.col("capacity")).alias("capacity"),
            "region_id",
            F.col("lat").alias("_lat"),
            F.col("lon").alias("_lon"),
        ),
        ["short_name"],
        [],
        [F.col("gbfs_station_id").asc_nulls_first()],
    )
    return stations.join(info, F.col("station_id") == F.col("short_name"), "left").select(
        surrogate_key(F.col("station_id")).alias("station_key"),
        "station_id",
        "gbfs_station_id",
        F.coalesce("station_name", "_name").alias("station_name"),
        F.coalesce("lat", "_lat").alias("lat"),
        F.coalesce("lng", "_lon").alias("lng"),
        "capacity",
        "region_id",
        "trip_mentions",
        "first_seen_at",
        "last_seen_at",
        F.col("short_name").isNull().alias("is_missing_from_gbfs"),
        F.col("capacity").isNotNull().alias("has_capacity_info"),
    )


def trips_dq_summary(
    trips: DataFrame, mapping: DataFrame, p: Params, cleaned: DataFrame | None = None
) -> DataFrame:
    """Row counts per (file, reason): valid, rejected, duplicate.

    By default the summary applies its own raw rules (no coordinate box, ids as delivered).
    With ``cleaned`` it applies the shared staging rules instead. The first valid row of a
    ride, by the order of the staging deduplication, counts as valid and the others as
    duplicates. Per-file counts of the kept rows are joined to per-file counts of all rows,
    so no ride is ever gathered whole.
    """
    if cleaned is None:
        rules = raw_trip_rules(p)
        rows = trips.select(
            clean_text(F.col("ride_id")).alias("ride_id"),
            "started_at",
            "ended_at",
            station_id_text(F.col("start_station_id")).alias("start_station_id"),
            station_id_text(F.col("end_station_id")).alias("end_station_id"),
            "start_lat",
            "start_lng",
            "end_lat",
            "end_lng",
            "_source_file",
            "_ingested_at",
        )
        kept = keep_latest(
            rows.where(is_valid(rules)).select(
                "ride_id", "_ingested_at", "ended_at", "_source_file"
            ),
            ["ride_id"],
            ["_ingested_at", "ended_at"],
        )
    else:
        rules = trip_rules(p)
        rows = cleaned
        kept = stg_trips(cleaned, p)
    reason = F.nullif(reason_text(rules), F.lit(""))
    counts = rows.groupBy("_source_file", reason.alias("rejection_reason")).agg(
        F.count(F.lit(1)).alias("row_count")
    )
    return dq_summary_of(counts, kept.groupBy("_source_file").agg(F.count(F.lit(1)).alias("kept")), p)


def dq_summary_of(counts: DataFrame, kept: DataFrame, p: Params) -> DataFrame:
    """The summary from rows per (file, reason) and kept rows per file."""
    kept = kept.select(F.col("_source_file").alias("_file"), F.col("kept").alias("_kept"))
    ok = F.col("rejection_reason").isNull()
    valid = F.when(ok, F.coalesce("_kept", F.lit(0))).otherwise(0).cast("long")
    rejected = F.when(ok, 0).otherwise(F.col("row_count")).cast("long")
    return counts.join(kept, F.col("_source_file").eqNullSafe(F.col("_file")), "left").select(
        "_source_file",
        "rejection_reason",
        "row_count",
        valid.alias("valid_rows"),
        rejected.alias("rejected_rows"),
        F.when(ok, F.col("row_count") - valid).otherwise(0).cast("long").alias("duplicate_rows"),
        F.round(safe_divide(rejected, F.col("row_count")) * 100, 4).alias("rejected_pct"),
        F.lit(p.as_of).cast("timestamp").alias("measured_at"),
    )


def dq_per_file(summary: DataFrame, p: Params) -> DataFrame:
    """Share of rejected rows per file, flagged when it is above the alert threshold."""
    total, rejected = F.sum("row_count"), F.sum("rejected_rows")
    pct = F.round(safe_divide(rejected, total) * 100, 4)
    return summary.groupBy("_source_file").agg(
        total.alias("total_rows"),
        rejected.alias("rejected_rows"),
        F.sum("duplicate_rows").alias("duplicate_rows"),
        pct.alias("rejected_pct"),
        F.lit(p.quarantine_alert_pct).alias("threshold_pct"),
        (pct > p.quarantine_alert_pct).alias("is_violation"),
    )


def station_risk(status: DataFrame, bridge: DataFrame, p: Params) -> DataFrame:
    """Status rows with station attributes, occupancy and risk."""
    c = F.col
    stations = bridge.where(c("gbfs_station_id").isNotNull()).select(
        "gbfs_station_id",
        "station_key",
        c("station_id").alias("legacy_station_id"),
        "station_name",
        "lat",
        "lng",
        "capacity",
        "region_id",
        F.lit(False).alias("_unknown"),
    )
    off = F.lit(False)
    operational = (
        F.coalesce("is_installed", off)
        & F.coalesce("is_renting", off)
        & F.coalesce("is_returning", off)
        & ~F.coalesce("is_disabled", off)
    )
    inconsistent = F.coalesce(c("num_bikes_available") > c("capacity"), off)
    occupancy = F.when(
        (c("capacity") > 0) & ~c("is_capacity_inconsistent"),
        safe_divide(c("num_bikes_available"), c("capacity")) * 100,
    )
    enriched = (
        status.withColumnRenamed("station_id", "gbfs_station_id")
        .join(stations, "gbfs_station_id", "left")
        .withColumn("is_unknown_station", F.coalesce("_unknown", F.lit(True)))
        .drop("_unknown")
        .withColumn("is_operational", operational)
        .withColumn("is_stale", c("report_age_seconds") > p.freshness_minutes * 60)
        .withColumn("is_capacity_inconsistent", inconsistent)
        .withColumn("occupancy_rate_pct", occupancy)
    )
    levels = [
        (~c("is_operational"), "not_operational", 0),
        (c("occupancy_rate_pct").isNull(), "unknown_capacity", 1),
        (c("num_bikes_available") == 0, "empty", 5),
        (c("num_docks_available") == 0, "full", 5),
        (c("occupancy_rate_pct") < p.low_occupancy_pct, "low", 3),
        (c("occupancy_rate_pct") > p.high_occupancy_pct, "high", 3),
        (F.lit(True), "balanced", 1),
    ]
    level = F.coalesce(*[F.when(test, F.lit(name)) for test, name, _ in levels])
    severity = F.coalesce(*[F.when(test, F.lit(rank)) for test, _, rank in levels])
    return enriched.withColumns({"risk_level": level, "risk_severity": severity.cast("long")})


def latest_complete_snapshot(facts: DataFrame, p: Params) -> DataFrame:
    """One row: the newest snapshot holding nearly as many stations as the largest one."""
    return latest_of_sizes(snapshot_sizes(facts), p)


def snapshot_sizes(facts: DataFrame, *by: str) -> DataFrame:
    return facts.groupBy(*by, "snapshot_timestamp").agg(
        F.countDistinct("gbfs_station_id").alias("stations")
    )


def latest_of_sizes(sizes: DataFrame, p: Params) -> DataFrame:
    """The latest complete snapshot from the number of stations in each."""
    sizes = materialize(sizes, "snapshot_sizes")  # read twice; one row per snapshot
    needed = sizes.agg(round_to_long(F.max("stations") * p.complete_snapshot_share)).scalar()
    return (
        sizes.where(F.col("stations") >= needed)
        .agg(F.max("snapshot_timestamp").alias("snapshot_timestamp"))
        .withColumn("min_complete_stations", needed)
    )


def current_rows(facts: DataFrame, latest: DataFrame) -> DataFrame:
    """Rows of the latest complete snapshot; the date comparison prunes stored partitions."""
    moment = latest.select("snapshot_timestamp").scalar()
    rows = facts
    if "snapshot_date" in facts.columns:
        day = latest.select(F.to_date("snapshot_timestamp")).scalar()
        rows = rows.where(F.col("snapshot_date") == day)
    return rows.where(F.col("snapshot_timestamp") == moment)


def demand_vs_supply(
    trips: DataFrame, status: DataFrame, latest: DataFrame, bridge: DataFrame | None = None
) -> DataFrame:
    """Historic demand per station next to its current supply.

    ``status`` holds station-risk columns. With ``bridge`` the name and place of stations
    missing from the latest snapshot come from the dimension instead of being NULL.
    """
    supply = current_supply(status, latest)
    return demand_of(
        signed_endpoints(trips, "start_station_id", "end_station_id"), supply, bridge
    )


def current_supply(status: DataFrame, latest: DataFrame) -> DataFrame:
    return current_rows(status, latest).select(
        "legacy_station_id", "station_name", "region_id", "lat", "lng", "capacity",
        "num_bikes_available", "num_docks_available", "occupancy_rate_pct", "risk_level",
        "risk_severity", "is_operational", "is_stale",
        F.col("snapshot_timestamp").alias("last_snapshot_at"),
    )


def demand_of(demand: DataFrame, supply: DataFrame, bridge: DataFrame | None = None) -> DataFrame:
    """Demand per station, as of ``signed_endpoints``, next to its supply."""
    combined = demand.join(
        supply, F.col("station_id") == F.col("legacy_station_id"), "left"
    ).drop("legacy_station_id")
    if bridge is not None:
        known = bridge.select(
            "station_id", *[F.col(c).alias(f"_{c}") for c in ("station_name", "lat", "lng")]
        )
        combined = combined.join(known, "station_id", "left")
        filled = {c: F.coalesce(c, f"_{c}") for c in ("station_name", "lat", "lng")}
        combined = combined.withColumns(filled).drop("_station_name", "_lat", "_lng")

    stations = materialize(combined, "demand")
    total = stations.agg(F.sum("total_activity")).scalar()
    ranked = with_rank(stations, "total_activity", "activity_rank")
    ranked = with_rank(ranked, "net_flow", "demand_pressure_rank")
    flow, risk = F.col("net_flow"), F.col("risk_level")
    return ranked.withColumns(
        {
            "activity_share": F.round(safe_divide(F.col("total_activity"), total), 6),
            "imbalance_pct": F.round(F.abs(F.col("occupancy_rate_pct") - 50), 2),
            "is_priority_supply": (flow > 0) & risk.isin("empty", "low"),
            "is_priority_drain": (flow < 0) & risk.isin("full", "high"),
        }
    )


# --- change archive -------------------------------------------------------------------

COMPARED = [
    "num_bikes_available", "num_docks_available", "num_ebikes_available",
    "num_scooters_available", "is_installed", "is_renting", "is_returning", "is_disabled",
]
CARRIED = [
    "station_key", "legacy_station_id", "station_name", "risk_level", "is_operational",
    "is_unknown_station", "last_reported", "report_age_seconds",
]
ARCHIVE_COLUMNS = [
    "station_key", "gbfs_station_id", "legacy_station_id", "station_name", "valid_from",
    "snapshot_date", "op", "bikes_before", "bikes_after", "docks_before", "docks_after",
    "delta_bikes", "delta_docks", "num_ebikes_available", "num_scooters_available",
    "is_installed", "is_renting", "is_returning", "is_disabled", "risk_level",
    "is_operational", "is_unknown_station", "last_reported", "report_age_seconds",
]


def archive_seed(archive: DataFrame) -> DataFrame:
    """The last archived state per station, in the columns of the status fact."""
    last = keep_latest(archive, ["gbfs_station_id"], ["valid_from"])
    return last.withColumns(
        {
            "snapshot_timestamp": F.col("valid_from"),
            "num_bikes_available": F.col("bikes_after"),
            "num_docks_available": F.col("docks_after"),
        }
    ).select("gbfs_station_id", "snapshot_timestamp", *COMPARED, *CARRIED)


def compared_rows(facts: DataFrame, high_water: Column | None = None) -> DataFrame:
    """The columns a comparison needs; after a mark only its date and later ones are opened."""
    rows = facts
    if high_water is not None:
        if "snapshot_date" in facts.columns:
            rows = rows.where(F.col("snapshot_date") >= F.to_date(high_water))
        rows = rows.where(F.col("snapshot_timestamp") > high_water)
    return rows.select("gbfs_station_id", "snapshot_timestamp", *COMPARED, *CARRIED)


def status_changes(
    facts: DataFrame, seed: DataFrame | None = None, high_water: Column | None = None
) -> DataFrame:
    """One row per real change of a station.

    With ``seed`` (last archived state per station) and ``high_water`` (newest archived
    change) only later snapshots are read and compared, so a refresh costs the new
    snapshots plus one row per station. Rows at or before the high-water mark are ignored.
    """
    rows = compared_rows(facts, high_water).withColumn("_new", F.lit(True))
    if seed is not None:
        rows = seed.withColumn("_new", F.lit(False)).unionByName(rows)
    day = F.to_date("snapshot_timestamp")
    rows = with_neighbor(
        rows.withColumn("snapshot_date", day),
        ["gbfs_station_id"],
        ["snapshot_timestamp", "last_reported"],
        "snapshot_date",
        COMPARED,
        "_before",
    )
    before = F.col("_before")
    differs = before.isNull()
    for name in COMPARED:
        differs = differs | ~F.col(name).eqNullSafe(before[name])
    bikes, docks = before["num_bikes_available"], before["num_docks_available"]
    return (
        rows.where(F.col("_new") & differs)
        .withColumns(
            {
                "valid_from": F.col("snapshot_timestamp"),
                "op": F.when(before.isNull(), "c").otherwise("u"),
                "bikes_before": bikes,
                "bikes_after": F.col("num_bikes_available"),
                "docks_before": docks,
                "docks_after": F.col("num_docks_available"),
                "delta_bikes": F.col("num_bikes_available") - bikes,
                "delta_docks": F.col("num_docks_available") - docks,
            }
        )
        .select(*ARCHIVE_COLUMNS)
    )


def late_rows(facts: DataFrame, high_water: Column) -> DataFrame:
    """How many snapshot rows a refresh ignores because they are not after the mark."""
    return facts.where(F.col("snapshot_timestamp") <= high_water).agg(
        F.count(F.lit(1)).alias("late_rows")
    )


def status_windows(changes: DataFrame, p: Params) -> DataFrame:
    """Validity window of each change; long windows may hide missing data."""
    rows = with_neighbor(
        changes, ["gbfs_station_id"], ["valid_from"], "snapshot_date", ["valid_from"], "_next",
        following=True,
    )
    minutes = elapsed("MINUTE", F.col("valid_to"), F.col("valid_from"))
    return (
        rows.withColumn("valid_to", F.col("_next")["valid_from"])
        .withColumn("duration_minutes", minutes)
        .withColumn(
            "is_possible_gap",
            F.coalesce(F.col("duration_minutes") > p.gap_minutes, F.lit(False)),
        )
        .drop("_next")
    )
