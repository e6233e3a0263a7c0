"""The registered queries: Spark callable and DuckDB twin side by side."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import fixture_views as fx
import oracles as o
from velomart.operators import quality, with_percent_rank, with_rank, with_row_number
from velomart.operators.rules import (
    is_valid,
    reason_array,
    reason_text,
    status_rules,
    trip_rules,
)
from velomart.params import Params
from velomart.plans import core, intermediate, marts, profiling, reports
from velomart.plans.checks import declared_checks
from velomart.plans.models import Models
from velomart.schemas import STATION_STATUS
from velomart.sources import lake
from velomart.sources.station_feed import to_messages
from velomart.streaming.changes import detect_changes, stored_changes
from velomart.streaming.ingest import (
    append_status_stream,
    compact_status,
    dlq_windows,
    file_messages,
    write_status_stream,
)
from velomart.workspace import materialize, scratch_path

P = fx.PARAMS


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    oracle: str | None = None


QUERIES: dict[str, Query] = {}


def register(name: str, run: Callable[[SparkSession, str], DataFrame], oracle: str | None) -> None:
    QUERIES[name] = Query(run, oracle)


# queries over demand and supply read the trips twice, so they store the trip fact
STORED = (
    "demand_vs_supply", "station_popularity", "station_popularity_named", "supply_demand",
    "station_popularity_top10", "stations_within_rank", "net_flow_extremes", "priority_supply",
    "priority_drain", "assertions_report",
)


def model(name: str, pick: Callable[[Models], DataFrame], oracle: str | None) -> None:
    store = name in STORED
    register(name, lambda spark, sf_dir: pick(fx.models(spark, sf_dir, store)), oracle)


# --- staging ---
model("station_id_mapping", lambda m: m.station_id_mapping, o.relation("mapping"))
model("stg_trips", lambda m: m.stg_trips, o.relation("stg_trips"))
model("stg_trips_rejected", lambda m: m.stg_trips_rejected, o.relation("stg_trips_rejected"))
model("stg_station_status", lambda m: m.stg_station_status, o.relation("stg_station_status"))
model(
    "stg_station_status_rejected",
    lambda m: m.stg_station_status_rejected,
    o.relation("stg_station_status_rejected"),
)


def _trip_flags(m: Models) -> DataFrame:
    reason = reason_text(trip_rules(m.params))
    return m.cleaned_trips.groupBy(reason.alias("rejection_reason")).agg(
        F.count(F.lit(1)).alias("n")
    )


model(
    "trip_rejection_flags",
    _trip_flags,
    o.sql("SELECT rejection_reason, count(*) AS n FROM flagged_trips GROUP BY 1", "flagged_trips"),
)


def _status_flags(m: Models) -> DataFrame:
    """Rows per single reason: the reason array is exploded, so a row counts once per reason."""
    reasons = reason_array(status_rules(m.params))
    return (
        m.cleaned_status.select(F.explode(reasons).alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("n"))
    )


model(
    "status_rejection_flags",
    _status_flags,
    o.sql(
        "SELECT reason, count(*) AS n FROM (SELECT unnest(string_split(rejection_reason, ',')) "
        "AS reason FROM flagged_status WHERE rejection_reason <> '') r GROUP BY 1",
        "flagged_status",
    ),
)

# --- stations, risk, snapshots ---
model("stations_deduplicated", lambda m: m.stations_deduplicated, o.relation("stations"))
model("station_id_bridge", lambda m: m.station_id_bridge, o.relation("bridge"))
model("dim_station", lambda m: m.dim_station, o.relation("bridge"))
model("station_risk", lambda m: m.station_risk, o.relation("risk"))
model("latest_complete_snapshot", lambda m: m.latest_complete_snapshot, o.relation("latest"))
model("demand_vs_supply", lambda m: m.demand_vs_supply, o.relation("demand"))
model("status_changes", lambda m: m.status_changes, o.relation("changes"))
model("status_windows", lambda m: m.status_windows, o.relation("windows"))

# --- star schema ---
model("fct_trips", lambda m: m.fct_trips, o.relation("fct_trips"))
model("fct_station_status", lambda m: m.fct_station_status, o.relation("fct_station_status"))
model("dim_date", lambda m: m.dim_date, o.relation("dim_date"))


def _rider_types(m: Models) -> DataFrame:
    """The static dimension with the trips it describes."""
    trips = m.stg_trips.groupBy("member_casual").agg(F.count(F.lit(1)).alias("trips"))
    return m.dim_rider_type.join(trips, "member_casual", "left")


model(
    "dim_rider_type",
    _rider_types,
    o.sql(
        "SELECT r.*, t.n AS trips FROM dim_rider_type r LEFT JOIN (SELECT member_casual, "
        "count(*) AS n FROM stg_trips GROUP BY 1) t ON r.member_casual = t.member_casual",
        "dim_rider_type",
        "stg_trips",
    ),
)

# --- marts ---
model("trip_summary_daily", lambda m: m.trip_summary_daily, o.relation("daily"))
model(
    "station_popularity",
    lambda m: m.station_popularity,
    o.sql(
        "SELECT station_id, station_name, lat, lng, departure_count, arrival_count, "
        "total_activity, net_flow, activity_rank FROM demand",
        "demand",
    ),
)


def _popularity_named(m: Models) -> DataFrame:
    demand = intermediate.demand_vs_supply(
        m.fct_trips,
        m.stored_fct_station_status,
        m.latest_complete_snapshot,
        bridge=m.station_id_bridge,
    )
    return marts.station_popularity(demand)


model(
    "station_popularity_named",
    _popularity_named,
    o.sql(
        "SELECT d.station_id, coalesce(d.station_name, b.station_name) AS station_name, "
        "coalesce(d.lat, b.lat) AS lat, coalesce(d.lng, b.lng) AS lng, departure_count, "
        "arrival_count, total_activity, net_flow, activity_rank "
        "FROM demand d LEFT JOIN bridge b ON d.station_id = b.station_id",
        "demand",
        "bridge",
    ),
)
model("usage_pattern_hourly", lambda m: m.usage_pattern_hourly, o.relation("hourly"))
model("member_vs_casual", lambda m: m.member_vs_casual_behavior, o.relation("segments"))
model(
    "availability_realtime", lambda m: m.station_availability_realtime, o.relation("availability")
)
model("risk_monitoring", lambda m: m.station_risk_monitoring, o.relation("work_list"))
model("supply_demand", lambda m: m.station_supply_demand, o.relation("supply_demand"))
model("station_volatility", lambda m: m.station_volatility, o.relation("volatility"))

# --- published queries ---
model(
    "daily_trend",
    lambda m: reports.daily_trend(m.trip_summary_daily),
    o.sql(
        "SELECT date_day, total_trips, member_trips, casual_trips, avg_duration_minutes "
        "FROM daily ORDER BY date_day",
        "daily",
    ),
)
_POPULAR = (
    "SELECT activity_rank, station_id, station_name, departure_count, arrival_count, "
    "total_activity, net_flow FROM demand"
)
model(
    "station_popularity_top10",
    lambda m: reports.busiest_stations(m.station_popularity),
    o.sql(f"{_POPULAR} ORDER BY activity_rank, station_id LIMIT 10", "demand"),
)
model(
    "stations_within_rank",
    lambda m: reports.stations_within_rank(m.station_popularity),
    o.sql(
        "SELECT station_id, station_name, lat, lng, departure_count, arrival_count, "
        "total_activity, net_flow, activity_rank FROM demand WHERE activity_rank <= 10",
        "demand",
    ),
)
_FLOW = "SELECT station_id, station_name, total_activity, net_flow, activity_rank"
model(
    "net_flow_extremes",
    lambda m: reports.net_flow_extremes(m.station_popularity),
    o.sql(
        f"SELECT * FROM ({_FLOW}, 'out' AS direction FROM demand ORDER BY net_flow DESC, "
        f"station_id LIMIT 5) a UNION ALL SELECT * FROM ({_FLOW}, 'in' AS direction "
        "FROM demand ORDER BY net_flow, station_id LIMIT 5) b",
        "demand",
    ),
)
model(
    "heatmap_cells",
    lambda m: reports.heatmap_cells(m.usage_pattern_hourly),
    o.sql(
        "SELECT day_of_week, day_name, start_hour, total_trips, member_trips, casual_trips, "
        "share_of_total_pct FROM hourly",
        "hourly",
    ),
)
model(
    "heatmap_by_day_name",
    lambda m: reports.heatmap_by_day_name(m.usage_pattern_hourly),
    o.sql(
        "SELECT day_name, start_hour, CAST(sum(total_trips) AS BIGINT) AS total_trips "
        "FROM hourly GROUP BY 1, 2",
        "hourly",
    ),
)
model(
    "heatmap_matrix",
    lambda m: reports.heatmap_matrix(m.usage_pattern_hourly),
    o.sql(
        "SELECT start_hour, "
        + ", ".join(
            f"CAST(coalesce(sum(total_trips) FILTER (WHERE day_of_week = {i}), 0) AS BIGINT) AS {d}"
            for i, d in enumerate(reports.WEEKDAYS, 1)
        )
        + ", CAST(sum(total_trips) AS BIGINT) AS total_all_days FROM hourly GROUP BY start_hour",
        "hourly",
    ),
)
model(
    "segment_comparison",
    lambda m: reports.segment_comparison(m.member_vs_casual_behavior),
    o.sql(
        "SELECT member_casual, description, total_trips, share_of_total_pct, "
        "avg_duration_minutes, median_duration_minutes, avg_distance_km, ebike_share_pct, "
        "weekend_share_pct, morning_peak_trips, evening_peak_trips FROM segments",
        "segments",
    ),
)
_PINS = (
    "SELECT gbfs_station_id, station_name, region_id, lat, lng, capacity, num_bikes_available, "
    "num_ebikes_available, num_docks_available, occupancy_rate_pct, risk_level, risk_severity, "
    "availability_label, is_operational, is_stale, last_snapshot_at, report_age_seconds "
    "FROM availability WHERE lat IS NOT NULL AND lng IS NOT NULL"
)
model(
    "map_pins",
    lambda m: reports.map_pins(m.station_availability_realtime),
    o.sql(_PINS, "availability"),
)
model(
    "map_pins_at_risk",
    lambda m: reports.map_pins(m.station_availability_realtime, only_at_risk=True),
    o.sql(f"{_PINS} AND risk_level IN ('empty', 'low', 'high', 'full')", "availability"),
)
model(
    "risk_work_list",
    lambda m: reports.risk_work_list(m.station_risk_monitoring),
    o.sql(
        "SELECT risk_rank, station_name, region_id, capacity, num_bikes_available, "
        f"num_docks_available, {o.rnd('occupancy_rate_pct', 1)} AS occupancy_pct, risk_level, "
        "recommended_action, bikes_to_move, last_reported, report_age_seconds FROM work_list",
        "work_list",
    ),
)


def _priority_sql(flag: str, stock: str, direction: str) -> str:
    return o.sql(
        "SELECT station_id, station_name, net_flow, total_activity, activity_rank, capacity, "
        f"{stock}, {o.rnd('occupancy_rate_pct', 1)} AS occupancy_pct, risk_level, "
        f"imbalance_direction FROM supply_demand WHERE {flag} "
        f"ORDER BY net_flow {direction}, station_id LIMIT 10",
        "supply_demand",
    )


model(
    "priority_supply",
    lambda m: reports.priority_supply(m.station_supply_demand),
    _priority_sql("is_priority_supply", "num_bikes_available", "DESC"),
)
model(
    "priority_drain",
    lambda m: reports.priority_drain(m.station_supply_demand),
    _priority_sql("is_priority_drain", "num_docks_available", "ASC"),
)
model(
    "most_volatile",
    lambda m: reports.most_volatile(m.station_volatility),
    o.sql(
        "SELECT gbfs_station_id, station_name, bikes_moved, docks_moved, total_moved, "
        "change_count, changes_per_hour, volatility_label FROM volatility "
        "ORDER BY total_moved DESC, gbfs_station_id LIMIT 10",
        "volatility",
    ),
)
model(
    "dwell_top10",
    lambda m: reports.longest_dwell(m.status_windows),
    o.sql(
        "SELECT gbfs_station_id, station_name, risk_level, duration_minutes, valid_from AS started "
        "FROM windows WHERE duration_minutes IS NOT NULL AND NOT is_possible_gap "
        "AND risk_level IN ('empty', 'full') "
        "ORDER BY duration_minutes DESC, gbfs_station_id, valid_from LIMIT 10",
        "windows",
    ),
)
model(
    "movement_by_changes",
    lambda m: reports.movement_by_changes(m.status_changes),
    o.sql(
        "SELECT gbfs_station_id, count(*) AS changes, CAST(sum(abs(delta_bikes)) AS BIGINT) "
        "AS bikes_moved FROM changes GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
        "changes",
    ),
)
model(
    "freshness_card",
    lambda m: reports.freshness_card(m.station_availability_realtime),
    o.sql(
        "SELECT count(*) AS total_stations, "
        "count(*) FILTER (WHERE report_age_seconds <= 600) AS fresh_10_minutes, "
        "count(*) FILTER (WHERE is_stale) AS stale, "
        "CAST(round(quantile_cont(report_age_seconds, 0.5)) AS BIGINT) AS median_age_seconds, "
        f"{o.pct('count(*) FILTER (WHERE is_stale)', 'count(*)')} AS stale_pct FROM availability",
        "availability",
    ),
)
model(
    "snapshot_buckets",
    lambda m: reports.snapshot_buckets(m.fct_station_status, "7 days"),
    o.sql(
        "SELECT time_bucket(INTERVAL '7' DAY, snapshot_timestamp, TIMESTAMP '1970-01-01') AS bucket_start, "
        "time_bucket(INTERVAL '7' DAY, snapshot_timestamp, TIMESTAMP '1970-01-01') + INTERVAL '7' DAY AS bucket_end, "
        "count(*) AS observations, CAST(sum(num_bikes_available) AS BIGINT) AS bikes, "
        "CAST(sum(num_docks_available) AS BIGINT) AS docks FROM fct_station_status GROUP BY 1, 2",
        "fct_station_status",
    ),
)

# --- data quality ---
model("dq_summary", lambda m: m.trips_dq_summary, o.relation("dq_raw"))
model(
    "dq_summary_shared_rules",
    lambda m: intermediate.trips_dq_summary(
        m.raw_trips, m.station_id_mapping, P, cleaned=m.cleaned_trips
    ),
    o.relation("dq_shared"),
)
model(
    "dq_per_file",
    lambda m: intermediate.dq_per_file(m.trips_dq_summary, P),
    o.sql(
        "SELECT _source_file, CAST(sum(row_count) AS BIGINT) AS total_rows, "
        "CAST(sum(rejected_rows) AS BIGINT) AS rejected_rows, "
        "CAST(sum(duplicate_rows) AS BIGINT) AS duplicate_rows, "
        f"{o.pct('sum(rejected_rows)', 'sum(row_count)', 4)} AS rejected_pct, "
        f"CAST({P.quarantine_alert_pct} AS DOUBLE) AS threshold_pct, "
        f"{o.pct('sum(rejected_rows)', 'sum(row_count)', 4)} > {P.quarantine_alert_pct} AS is_violation "
        "FROM dq_raw GROUP BY 1",
        "dq_raw",
    ),
)
_STATUS_GATE = (
    "SELECT 'station_status' AS layer, 'station_status' AS source, valid_rows AS total_rows, "
    "rejected_rows, coalesce(rejected_pct, 0) AS rejected_pct, "
    f"coalesce(rejected_pct > {P.quarantine_alert_pct}, FALSE) AS is_violation FROM status_counts"
)
model(
    "quarantine_gate",
    lambda m: m.trip_gate.unionByName(m.status_gate),
    o.sql(f"SELECT * FROM gate_trips UNION ALL {_STATUS_GATE}", "gate_trips", "status_counts"),
)


def _changes_in_two_runs(m: Models) -> DataFrame:
    """First run up to a cut, second run seeded from the archive of the first, then merged."""
    facts = m.stored_fct_station_status
    middle = facts.agg(F.percentile_approx(F.unix_micros("snapshot_timestamp"), 0.5)).scalar()
    cut = F.timestamp_micros(middle)
    path = scratch_path(facts.sparkSession, "change_archive")
    keys = ["gbfs_station_id", "valid_from"]
    first = intermediate.status_changes(facts.where(F.col("snapshot_timestamp") <= cut))
    first = materialize(first, "first_changes")
    lake.merge_into(first, path, keys, ["last_reported"], "snapshot_date")
    seed = materialize(intermediate.archive_seed(first), "seed")
    mark = F.lit(seed.agg(F.max("snapshot_timestamp")).first()[0])
    second = intermediate.status_changes(facts, seed, mark)
    lake.merge_into(second, path, keys, ["last_reported"], "snapshot_date")
    stored = facts.sparkSession.read.parquet(path)
    return stored.select(*intermediate.ARCHIVE_COLUMNS)


model("status_changes_incremental", _changes_in_two_runs, o.relation("changes"))

# --- metrics, watchdog, maintenance ---


def _metrics(m: Models) -> DataFrame:
    layers = {
        "station_status": (m.stg_station_status, m.stg_station_status_rejected, m.raw_status),
        "trips": (m.stg_trips, m.stg_trips_rejected, m.raw_trips),
    }
    return quality.dq_metrics(layers, "run-1", P)


_METRIC = (
    f"SELECT CAST({o.AS_OF} AS DATE) AS run_date, '{{layer}}' AS layer, 'run-1' AS run_id, "
    "v.n + r.n AS total_rows, v.n AS valid_rows, r.n AS rejected_rows, "
    "w.n - v.n - r.n AS duplicate_rows, "
    f"{o.pct('r.n', '(v.n + r.n)', 4)} AS rejected_pct, {o.AS_OF} AS noted_at "
    "FROM (SELECT count(*) AS n FROM {valid}) v, (SELECT count(*) AS n FROM {valid}_rejected) r, "
    "(SELECT count(*) AS n FROM {layer}) w"
)
_METRICS = " UNION ALL ".join(
    _METRIC.format(layer=layer, valid=valid)
    for layer, valid in (("station_status", "stg_station_status"), ("trips", "stg_trips"))
)
_METRIC_INPUTS = (
    "stg_station_status", "stg_station_status_rejected", "stg_trips", "stg_trips_rejected",
    "station_status", "trips",
)
model("dq_metrics", _metrics, o.sql(_METRICS, *_METRIC_INPUTS))
model(
    "quarantine_week",
    lambda m: reports.quarantine_week(_metrics(m), P),
    o.sql(
        f"SELECT run_date, layer, total_rows, rejected_rows, {o.rnd('rejected_pct', 2)} AS "
        f"rejected_pct FROM ({_METRICS}) m WHERE run_date >= CAST({o.AS_OF} AS DATE) - 7",
        *_METRIC_INPUTS,
    ),
)
model(
    "reconcile_split",
    lambda m: quality.reconcile_split(
        m.raw_trips,
        m.cleaned_trips.where(is_valid(trip_rules(P))),
        m.stg_trips,
        m.stg_trips_rejected,
    ),
    o.sql(
        "SELECT raw.n AS raw_rows, kept.n AS valid_rows, valid.n - kept.n AS duplicate_rows, "
        "bad.n AS rejected_rows, raw.n = valid.n + bad.n AS is_balanced "
        "FROM (SELECT count(*) AS n FROM trips) raw, "
        "(SELECT count(*) AS n FROM flagged_trips WHERE rejection_reason = '') valid, "
        "(SELECT count(*) AS n FROM stg_trips) kept, "
        "(SELECT count(*) AS n FROM stg_trips_rejected) bad",
        "trips",
        "flagged_trips",
        "stg_trips",
        "stg_trips_rejected",
    ),
)


def _as_dlq(m: Models) -> DataFrame:
    """Rejected status rows in the shape of the dead-letter table."""
    return m.stg_station_status_rejected.select(
        F.col("rejection_reason").alias("error_reason"), F.col("_ingested_at").alias("failed_at")
    )


_SINCE = f"{o.AS_OF} - INTERVAL '2' DAY"
P_DLQ = Params(as_of=P.as_of, dlq_window_minutes=2 * 24 * 60, dlq_alert_rows=5)


def _checks(m: Models) -> list[DataFrame]:
    return [
        quality.check_freshness(m.raw_status, P),
        quality.check_dlq_growth(_as_dlq(m), P_DLQ),
        quality.check_staging_rejection(m.stg_station_status, m.stg_station_status_rejected, P),
    ]


def _watchdog(m: Models) -> DataFrame:
    freshness, dlq, rejection = _checks(m)
    return freshness.unionByName(dlq).unionByName(rejection)


_AGE = f"date_sub('second', max(snapshot_timestamp), {o.AS_OF})"
_WATCHDOG = (
    f"SELECT 'freshness' AS check_name, CASE WHEN {_AGE} > {P.freshness_minutes * 60} "
    f"THEN 'STALE' ELSE 'OK' END AS status, {o.rnd(f'CAST({_AGE} AS DOUBLE) / 60', 1)} AS observed "
    "FROM station_status UNION ALL "
    f"SELECT 'dlq_growth', CASE WHEN count(*) > {P_DLQ.dlq_alert_rows} THEN 'SURGE' ELSE 'OK' END, "
    f"CAST(count(*) AS DOUBLE) FROM stg_station_status_rejected WHERE _ingested_at >= {_SINCE} "
    "UNION ALL SELECT 'staging_rejection', CASE WHEN rejected_pct > "
    f"{P.quarantine_alert_pct} THEN 'SURGE' ELSE 'OK' END, rejected_pct FROM status_counts"
)
_WATCHDOG_INPUTS = ("station_status", "stg_station_status_rejected", "status_counts")
model("watchdog_checks", _watchdog, o.sql(_WATCHDOG, *_WATCHDOG_INPUTS))
model(
    "watchdog_summary",
    lambda m: quality.check_summary(_checks(m)),
    o.sql(
        "SELECT count(*) AS checks, count(*) FILTER (WHERE status NOT IN ('OK', 'SKIPPED')) AS "
        "issues, string_agg(check_name || '=' || status, ',' ORDER BY check_name) AS statuses "
        f"FROM ({_WATCHDOG}) w",
        *_WATCHDOG_INPUTS,
    ),
)
model(
    "dlq_windows",
    lambda m: dlq_windows(_as_dlq(m), P_DLQ, "1 day"),
    o.sql(
        "SELECT w AS window_start, w + INTERVAL '2' DAY AS window_end, count(*) AS rows_dlq, "
        f"CASE WHEN count(*) > {P_DLQ.dlq_alert_rows} THEN 'SURGE' ELSE 'OK' END AS status FROM ("
        "SELECT unnest([date_trunc('day', _ingested_at), date_trunc('day', _ingested_at) - "
        "INTERVAL '1' DAY]) AS w FROM stg_station_status_rejected) x GROUP BY w",
        "stg_station_status_rejected",
    ),
)


def _reconcile(m: Models) -> DataFrame:
    """Raw trips per day against the kept trips per day: the days that lost rows."""
    return lake.reconcile(m.raw_trips, m.stg_trips, "_ride_started_date", "trip_date")


model(
    "reconcile_partitions",
    _reconcile,
    o.sql(
        "SELECT coalesce(a.day, b.day) AS day, coalesce(a.n, 0) AS lake_rows, "
        "coalesce(b.n, 0) AS table_rows "
        "FROM (SELECT _ride_started_date AS day, count(*) AS n FROM trips GROUP BY 1) a "
        "FULL OUTER JOIN (SELECT trip_date AS day, count(*) AS n FROM stg_trips GROUP BY 1) b "
        "ON a.day = b.day WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)",
        "trips",
        "stg_trips",
    ),
)
_KEEP = P.retention_days["station_status"]
_CUTOFF = f"(CAST({o.AS_OF} AS DATE) - {_KEEP})"
model(
    "retention_report",
    lambda m: lake.retention_report(m.raw_status, "station_status", "_snapshot_date", _KEEP, P),
    o.sql(
        f"SELECT 'station_status' AS table_name, CAST({_KEEP} AS BIGINT) AS keep_days, "
        f"count(*) AS rows_before, count(*) FILTER (WHERE _snapshot_date >= {_CUTOFF}) AS rows_after, "
        f"min(_snapshot_date) AS oldest_before, "
        f"min(_snapshot_date) FILTER (WHERE _snapshot_date >= {_CUTOFF}) AS oldest_after "
        "FROM station_status",
        "station_status",
    ),
)
model(
    "retention_survivors",
    lambda m: lake.survivors(m.raw_status, "_snapshot_date", _KEEP, P)
    .groupBy("_snapshot_date")
    .agg(F.count(F.lit(1)).alias("n")),
    o.sql(
        "SELECT _snapshot_date, count(*) AS n FROM station_status "
        f"WHERE _snapshot_date >= {_CUTOFF} GROUP BY 1",
        "station_status",
    ),
)


def _partition_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lake write, idempotent load twice, then counts per loaded date."""
    folder, loaded = scratch_path(spark, "lake"), scratch_path(spark, "trips_table")
    # read once, by the lake write
    months = fx.raw_trips(spark, sf_dir).withColumn("_ride_started_date", F.trunc("_ride_started_date", "year"))
    lake.write_daily_lake(months, folder)
    for _ in range(2):
        lake.load_trips(spark.read.parquet(folder), loaded)
    return spark.read.parquet(loaded).groupBy("_ride_started_date").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("ride_id").alias("rides")
    )


register(
    "partition_load",
    _partition_round_trip,
    o.sql(
        "SELECT CAST(date_trunc('year', _ride_started_date) AS DATE) AS _ride_started_date, "
        "count(*) AS n, count(DISTINCT ride_id) AS rides FROM trips GROUP BY 1",
        "trips",
    ),
)

# --- assertions ---
_CHECK_RELATIONS = {
    "station_id_mapping": "mapping",
    "stations_deduplicated": "stations",
    "trips_dq_summary": "dq_raw",
    "station_id_bridge": "bridge",
    "dim_station": "bridge",
    "station_risk": "risk",
    "demand_vs_supply": "demand",
    "status_changes": "changes",
    "status_windows": "windows",
    "trip_summary_daily": "daily",
    "station_popularity": "demand",
    "usage_pattern_hourly": "hourly",
    "member_vs_casual_behavior": "segments",
    "station_availability_realtime": "availability",
    "station_risk_monitoring": "work_list",
    "station_supply_demand": "supply_demand",
    "station_volatility": "volatility",
}


def assertions_sql(models: tuple[str, ...] = (), more_trips: str | None = None) -> str:
    parts, needed = [], []
    for check in declared_checks(P):
        if models and check.model not in models:
            continue
        name = _CHECK_RELATIONS.get(check.model, check.model)
        needed.append(name)
        if check.bad:
            body = f"SELECT count(*) FILTER (WHERE {check.bad}) FROM {name}"
        elif check.unique:
            keys = ", ".join(check.unique)
            known = " AND ".join(f"{k} IS NOT NULL" for k in check.unique)
            where = f"WHERE {known}" if check.skip_null else ""
            body = (
                f"SELECT count(*) FROM (SELECT 1 FROM {name} {where} "
                f"GROUP BY {keys} HAVING count(*) > 1) g"
            )
        else:
            child, parent, column = check.parent
            other = _CHECK_RELATIONS.get(parent, parent)
            needed.append(other)
            body = (
                f"SELECT count(*) FROM {name} WHERE {child} IS NOT NULL AND {child} NOT IN "
                f"(SELECT {column} FROM {other} WHERE {column} IS NOT NULL)"
            )
        parts.append((check.model, check.name, body))
    whole = [
        (
            "dim_station", "no_phantom_station_ids", "bridge",
            "SELECT count(*) FROM (SELECT 1 FROM bridge WHERE station_name IS NOT NULL AND lat IS NOT "
            "NULL AND lng IS NOT NULL GROUP BY station_name, round(lat, 6), round(lng, 6) "
            "HAVING count(DISTINCT station_id) > 1) g",
        ),
        (
            "trips_dq_summary", "rejected_pct_below_threshold", "dq_raw",
            "SELECT count(*) FROM (SELECT 1 FROM dq_raw GROUP BY _source_file HAVING "
            f"sum(rejected_rows) * 100.0 / sum(row_count) > {P.quarantine_alert_pct}) g",
        ),
        (
            "status_changes", "single_create", "changes",
            "SELECT count(*) FROM (SELECT 1 FROM changes GROUP BY gbfs_station_id "
            "HAVING count(*) FILTER (WHERE op = 'c') > 1) g",
        ),
    ]
    for model_name, check_name, table, body in whole:
        if not models or model_name in models:
            parts.append((model_name, check_name, body))
            needed.append(table)
    union = " UNION ALL ".join(
        f"SELECT '{m}' AS model, '{n}' AS check_name, ({body}) AS violations"
        for m, n, body in parts
    )
    return o.sql(union, *dict.fromkeys(needed), more_trips=more_trips)


model("assertions_report", lambda m: m.assertions_report(), assertions_sql())
model(
    "phantom_stations",
    lambda m: quality.phantom_stations(m.dim_station),
    o.sql(
        "SELECT station_name, round(lat, 6) AS lat, round(lng, 6) AS lng, "
        "count(DISTINCT station_id) AS n_station_ids, "
        "string_agg(DISTINCT station_id, ' | ' ORDER BY station_id) AS station_ids FROM bridge "
        "WHERE station_name IS NOT NULL AND lat IS NOT NULL AND lng IS NOT NULL "
        "GROUP BY 1, 2, 3 HAVING count(DISTINCT station_id) > 1",
        "bridge",
    ),
)

# --- profiling ---
_SECONDS = "date_sub('second', started_at, ended_at)"
_BOX = " AND ".join(
    f"{s}_lat BETWEEN {P.lat_min} AND {P.lat_max} AND {s}_lng BETWEEN {P.lng_min} AND {P.lng_max}"
    for s in ("start", "end")
)
_PLACED = " AND ".join(f"{s}_{c} IS NOT NULL" for s in ("start", "end") for c in ("lat", "lng"))


def view(name: str, pick: Callable[[DataFrame], DataFrame], oracle: str) -> None:
    """A query that reads the trips once, straight from the lazy view."""
    register(name, lambda spark, sf_dir: pick(fx.raw_trips(spark, sf_dir)), oracle)


view(
    "profile_trips",
    lambda t: profiling.trip_profile(t, P),
    o.sql(
        "SELECT count(*) AS total_rows, count(DISTINCT ride_id) AS distinct_rides, "
        "min(started_at) AS first_started_at, max(ended_at) AS last_ended_at, "
        f"min({_SECONDS}) AS min_seconds, {o.rnd(f'avg({_SECONDS})', 2)} AS avg_seconds, "
        f"max({_SECONDS}) AS max_seconds, "
        f"count(*) FILTER (WHERE {_SECONDS} < 0) AS negative_durations, "
        f"count(*) FILTER (WHERE {_SECONDS} > {P.max_trip_duration_seconds}) AS extreme_durations, "
        "count(*) FILTER (WHERE start_lat IS NULL OR start_lng IS NULL) AS start_without_place, "
        "count(*) FILTER (WHERE end_lat IS NULL OR end_lng IS NULL) AS end_without_place, "
        "count(*) FILTER (WHERE start_lat IS NULL AND end_lat IS NULL) AS both_without_lat, "
        f"count(*) FILTER (WHERE {_PLACED} AND NOT ({_BOX})) AS outside_box, "
        "count(*) - count(DISTINCT ride_id) AS duplicate_rows FROM trips",
        "trips",
    ),
)
view(
    "profile_categories",
    profiling.category_counts,
    o.sql(
        "SELECT 'rideable_type' AS column_name, rideable_type AS category, count(*) AS n "
        "FROM trips GROUP BY 2 UNION ALL SELECT 'member_casual', member_casual, count(*) "
        "FROM trips GROUP BY 2",
        "trips",
    ),
)
_SEEN = (
    "WITH s AS (SELECT start_station_id AS station_id, start_station_name AS station_name FROM trips "
    "UNION ALL SELECT end_station_id, end_station_name FROM trips), "
    "k AS (SELECT * FROM s WHERE station_id <> ''), "
    "i AS (SELECT station_id, count(*) AS row_count, count(DISTINCT station_name) AS name_count, "
    f"CASE WHEN regexp_matches(station_id, '{profiling.NUMERIC_ID}') THEN 'numeric' "
    "WHEN station_id LIKE '%$_' ESCAPE '$' THEN 'suffixed' ELSE 'other' END AS id_format "
    "FROM k GROUP BY 1)"
)
view(
    "profile_station_ids",
    profiling.station_id_profile,
    o.sql(
        f"SELECT * FROM ({_SEEN} SELECT *, name_count > 1 AS has_several_names, CASE WHEN station_id "
        "LIKE '%$_' ESCAPE '$' THEN regexp_replace(station_id, '_$', '') IN (SELECT station_id "
        "FROM i WHERE id_format = 'numeric') END AS base_exists FROM i) p",
        "trips",
    ),
)
view(
    "profile_station_totals",
    profiling.station_profile_totals,
    o.sql(
        f"SELECT * FROM ({_SEEN} SELECT count(*) AS station_rows, count(DISTINCT station_id) AS distinct_ids, "
        "count(DISTINCT station_name) AS distinct_names, "
        "count(DISTINCT (station_id, station_name)) AS id_name_pairs, "
        f"count(*) FILTER (WHERE NOT regexp_matches(station_id, '{profiling.NUMERIC_ID}')) AS odd_id_rows, "
        "count(*) FILTER (WHERE station_name <> trim(station_name)) AS spaced_name_rows FROM k) p",
        "trips",
    ),
)
_DAYS = "SELECT CAST(started_at AS DATE) AS day, count(*) AS trips FROM trips GROUP BY 1"
view("profile_daily", profiling.trips_per_day, o.sql(_DAYS, "trips"))
view(
    "profile_monthly",
    profiling.trips_per_month,
    o.sql(
        "SELECT strftime(day, '%Y-%m') AS month, CAST(sum(trips) AS BIGINT) AS total_trips, "
        f"count(*) AS day_count, {o.rnd('avg(trips)', 0)} AS mean_trips_per_day "
        f"FROM ({_DAYS}) d GROUP BY 1",
        "trips",
    ),
)
view(
    "profile_file_boundaries",
    profiling.file_boundaries,
    o.sql(
        "SELECT _source_file, count(*) AS row_count, min(started_at) AS first_started_at, "
        "max(started_at) AS last_started_at, min(ended_at) AS first_ended_at, "
        "max(ended_at) AS last_ended_at FROM trips GROUP BY 1",
        "trips",
    ),
)
_UPTO, _BINS = 63_360_000, 60
view(
    "profile_duration_histogram",
    lambda t: profiling.duration_histogram(t, _UPTO, _BINS),
    o.sql(
        f"SELECT CAST(least(floor({_SECONDS} / {_UPTO / _BINS}), {_BINS - 1}) AS BIGINT) AS bin, "
        f"count(*) AS trips, CAST(least(floor({_SECONDS} / {_UPTO / _BINS}), {_BINS - 1}) AS DOUBLE) "
        f"* {_UPTO / _BINS} AS from_seconds FROM trips "
        f"WHERE {_SECONDS} BETWEEN 0 AND {_UPTO} GROUP BY 1, 3",
        "trips",
    ),
)

# --- ranking operators on a whole fact ---


def _ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row number, rank and percent rank of every status row, without a global window."""
    status = fx.raw_status(spark, sf_dir).select(
        "station_id", "_ingested_at", F.coalesce("num_bikes_available", F.lit(-2)).alias("bikes")
    )
    order = [F.desc("bikes"), F.asc("station_id"), F.asc("_ingested_at")]
    numbered = with_row_number(status, order, "position")
    ranked = with_rank(numbered, "bikes", "bikes_rank")
    return with_percent_rank(ranked, "bikes", "bikes_share")


register(
    "global_rank_distributed",
    _ranks,
    o.sql(
        "SELECT station_id, _ingested_at, bikes, "
        "row_number() OVER (ORDER BY bikes DESC, station_id, _ingested_at) AS position, "
        "rank() OVER (ORDER BY bikes DESC) AS bikes_rank, "
        "percent_rank() OVER (ORDER BY bikes) AS bikes_share FROM ("
        "SELECT station_id, _ingested_at, coalesce(num_bikes_available, -2) AS bikes "
        "FROM station_status) s",
        "station_status",
    ),
)


# --- streaming ---


def _messages(m: Models, root: str, number: int, *frames: DataFrame) -> None:
    """One delivery: a folder of message files that the stream has not seen."""
    texts = quality.union_all([f.select("value") for f in frames])
    texts.write.text(f"{root}/messages/{number}")


def _stream(m: Models) -> DataFrame:
    """Raw messages in three deliveries, decoded, deduplicated and change-detected.

    The first holds every raw row that is not kept, valid or not, with broken JSON and missing
    ids between them; the second the kept rows; the third repeats half of them. Every delivery
    is a batch of its own run.
    """
    spark = m.raw_status.sparkSession
    root = scratch_path(spark, "stream")
    kept = materialize(m.stg_station_status, "kept_status")
    raw = m.raw_status
    broken = kept.select(F.concat(F.lit('{"station_id": "'), "station_id").alias("value"))
    nameless = kept.select(F.to_json(F.struct(F.lit(1).alias("num_bikes_available"))).alias("value"))
    lost = raw.join(kept.select("station_id", "last_reported", "snapshot_timestamp", "_ingested_at"),
                    ["station_id", "last_reported", "snapshot_timestamp", "_ingested_at"], "left_anti")
    deliveries = [
        (to_messages(lost), broken, nameless),
        (to_messages(kept),),
        (to_messages(kept.where(F.crc32(F.col("station_id")) % 2 == 0)), broken),
    ]
    log, latest, mark = f"{root}/log", f"{root}/latest", -1
    for number, frames in enumerate(deliveries):
        _messages(m, root, number, *frames)
        now = F.lit(P.as_of).cast("timestamp") + F.make_dt_interval(mins=F.lit(number))
        source = file_messages(spark, f"{root}/messages/*", 1_000)
        write_status_stream(
            source, f"{root}/status", f"{root}/dlq", f"{root}/checkpoint_status", now
        ).awaitTermination()
        landed = spark.readStream.schema(STATION_STATUS).parquet(f"{root}/status")
        append_status_stream(landed, log, f"{root}/checkpoint_log", P).awaitTermination()
        mark = compact_status(spark, log, latest, P, mark)
    status = spark.read.parquet(latest).drop("_reported_date")
    facts = core.fct_station_status(
        intermediate.station_risk(status, m.station_id_bridge, P)
    )
    return intermediate.status_changes(facts).select(
        "gbfs_station_id", "valid_from", "op", "bikes_before", "bikes_after", "docks_before",
        "docks_after", "is_renting", "risk_level",
    )


model(
    "stream_dedup_cdc",
    _stream,
    o.sql(
        "SELECT gbfs_station_id, valid_from, op, bikes_before, bikes_after, docks_before, "
        "docks_after, is_renting, risk_level FROM changes",
        "changes",
    ),
)


def _stateful(m: Models) -> DataFrame:
    """Change detection over four micro-batches, each a restart, with late rows between them."""
    facts = m.stored_fct_station_status
    spark = facts.sparkSession
    root = scratch_path(spark, "stateful")
    narrow = materialize(intermediate.compared_rows(facts), "narrow_facts")
    days = sorted(r[0] for r in narrow.select(F.to_date("snapshot_timestamp")).distinct().collect())
    cuts = [days[len(days) * k // 3] for k in (1, 2)]
    day = F.to_date("snapshot_timestamp")
    first, second = narrow.where(day < F.lit(cuts[0])), narrow.where(day < F.lit(cuts[1]))
    late = first.withColumn("num_bikes_available", F.col("num_bikes_available") + 1000)
    deliveries = [
        first,
        second.where(day >= F.lit(cuts[0])),
        late,
        narrow.where(day >= F.lit(cuts[1])),
    ]
    for rows in deliveries:
        rows.write.mode("append").parquet(f"{root}/facts")
        stream = spark.readStream.schema(narrow.schema).parquet(f"{root}/facts")
        detect_changes(stream, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return stored_changes(spark, f"{root}/out")


model("stream_stateful_changes", _stateful, o.relation("changes"))
