"""Scheduled runs over a warehouse folder: ingest, batch and status refresh, watchdog, clean-up.

Tables live at ``<root>/<layer>/<table>``. Each run is a plain function that an outside
scheduler calls. A gate is decided on scratch copies, before any table of the warehouse is
written; a failed reconciliation or data test raises before metrics are recorded.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velomart import schemas
from velomart.operators import keep_latest, merge_states
from velomart.operators import quality as q
from velomart.params import Params
from velomart.plans import core, intermediate, staging
from velomart.plans import status_increments as status
from velomart.plans.models import Models, scratch
from velomart.plans.trip_increments import RAW_DAY, StoredTrips, refresh_trips
from velomart.sources import lake, station_feed, storage, trip_files
from velomart.sources.snapshots import SnapshotStore
from velomart.workspace import application_dir, materialize

# table: (layer, partition column, cluster columns)
LAYOUT = {
    "station_id_mapping": ("staging", None, ()),
    "station_id_bridge": ("intermediate", None, ()),
    "status_changes": ("intermediate", "snapshot_date", ("gbfs_station_id",)),
    "station_demand": ("intermediate", None, ()),
    "fct_station_status": ("marts", "snapshot_date", ("station_key",)),
    "dim_date": ("marts", None, ()),
    "dim_rider_type": ("marts", None, ()),
    "dim_station": ("marts", None, ()),
    "stg_station_status": ("staging", "_reported_date", ("station_id",)),
    "station_state": ("intermediate", None, ()),
}
BATCH_MARTS = ("trip_summary_daily", "usage_pattern_hourly", "member_vs_casual_behavior")
STATUS_MARTS = ("station_availability_realtime", "station_risk_monitoring")
DEMAND_MARTS = ("station_popularity", "station_supply_demand")
# the models whose data tests a run must pass
BATCH_TESTED = (
    "stg_trips", "station_id_mapping", "stg_trips_rejected", "stations_deduplicated",
    "trips_dq_summary", "station_id_bridge", "dim_station", "dim_date", "dim_rider_type",
    "fct_trips", *BATCH_MARTS,
)
STATUS_TESTED = (
    "stg_station_status", "stg_station_status_rejected", "fct_station_status", "status_changes",
    "status_windows", "demand_vs_supply", *STATUS_MARTS, *DEMAND_MARTS, "station_volatility",
)
# dates whose raw trips changed, and the loads that a batch refresh has dealt with
TRIP_LOADS = "load_id string, day date"
TRIP_REFRESHES = "load_id string, run_id string"
# dates that a status run is about to rewrite, by the newest batch it merges
STATUS_TOUCHED = "mark long, kind string, day date"
STATUS_LOG = T.StructType(
    [
        T.StructField("refreshed_at", T.TimestampType()),
        T.StructField("batch_mark", T.LongType()),
        T.StructField("bridge_hash", T.LongType()),
        T.StructField("changed_rows", T.LongType()),
        T.StructField("late_rows", T.LongType()),
        T.StructField("was_full", T.BooleanType()),
    ]
)


@dataclass(frozen=True)
class Warehouse:
    spark: SparkSession
    root: str

    def path(self, table: str, layer: str | None = None) -> str:
        default = LAYOUT.get(table, ("dashboard", None, ()))[0]
        return f"{self.root}/{layer or default}/{table}"

    def store(self, df: DataFrame, table: str) -> DataFrame:
        """Replace a table in its declared layout and return it as stored."""
        _, partition, cluster = LAYOUT.get(table, ("dashboard", None, ()))
        rows = df if partition is None else lake.clustered(df, partition, list(cluster))
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
        if partition is not None:
            writer = writer.partitionBy(partition)
        writer.parquet(self.path(table))
        return self.read(table, df.schema)

    def read(self, table: str, schema: T.StructType) -> DataFrame:
        stored = self.spark.read.schema(schema).parquet(self.path(table))
        return stored.select(*schema.names)

    def raw(self, table: str, schema: T.StructType) -> DataFrame:
        """A raw table, empty while nothing was loaded."""
        found = lake.read_or_none(self.spark, self.path(table, "raw"))
        if found is None:
            return self.spark.createDataFrame([], schema)
        return schemas.conform(found, schema)


def ingest_trips(
    wh: Warehouse,
    folder: str,
    ingested_at: dt.datetime,
    pattern: str = trip_files.TRIP_FILE_PATTERN,
    limit: int = 0,
) -> list[dt.date]:
    """CSV files → daily lake → raw table, reconciled per date. Returns the loaded dates."""
    paths = trip_files.discover_files(wh.spark, folder, pattern, limit)
    files = [os.path.basename(path) for path in paths]
    text = trip_files.read_trip_text(wh.spark, paths)
    placed, lost = trip_files.split_unplaceable(trip_files.typed_trips(text, ingested_at))
    lake_path, table_path = f"{wh.root}/lake/raw/trips", wh.path("trips", "raw")
    days = lake.write_daily_lake(placed, lake_path, files)
    lake.write_per_file(lost, wh.path("trips_unplaceable", "raw"), files)
    if not days:
        return days
    stored = wh.spark.read.parquet(lake_path).where(F.col("dt").isin(days))
    conformed = schemas.conform(stored, schemas.TRIPS).withColumn("dt", F.col("_ride_started_date"))
    # noted first: a load that dies half-way is derived again, one that is not noted never
    load = uuid.uuid4().hex
    wh.spark.createDataFrame([(load, day) for day in days], TRIP_LOADS).coalesce(1).write.mode("append").parquet(
        wh.path("trip_loads", "raw")
    )
    lake.load_files(conformed, table_path, files, days)
    day, mine = "_ride_started_date", F.col("_source_file").isin(files)
    loaded = wh.spark.read.parquet(table_path).where(F.col(day).isin(days) & mine)
    lake.enforce_reconciled(lake.reconcile(conformed.where(mine), loaded, day, day))
    return days


def ingest_station_information(
    wh: Warehouse, payload_path: str, ingested_at: dt.datetime, p: Params
) -> DataFrame:
    """One information payload → archive, gate, full replace, verification row."""
    payloads = station_feed.read_payloads(wh.spark, payload_path)
    station_feed.archive_payloads(payloads, f"{wh.root}/lake/reference/station_information")
    envelopes = station_feed.parse_envelope(payloads)
    broken = envelopes.where("problems > 0").limit(1).count()
    if broken:
        raise ValueError(f"the envelope of {payload_path} is not valid")
    rows, rejected = station_feed.parse_information(
        station_feed.stations_of(envelopes), ingested_at
    )
    station_feed.enforce_payload_quality(rows, rejected, p)
    path = wh.path("station_information", "raw")
    staged = lake.replace_table(rows, path)
    verdict = station_feed.verify_information(wh.spark.read.parquet(path), staged.count())
    if not verdict.first().is_ok:
        raise ValueError(f"station information was not loaded as staged: {verdict.first()}")
    return verdict


def ingest_status_payloads(
    wh: Warehouse, payload_path: str, ingested_at: dt.datetime
) -> tuple[int, int]:
    """Polled status payloads → archive, status rows and dead letters. Returns both counts.

    A payload whose envelope cannot be trusted goes to the dead letters whole; a bad station
    goes there alone. Rows of one call replace those of an earlier call for the same time.
    """
    payloads = station_feed.read_payloads(wh.spark, payload_path)
    station_feed.archive_payloads(payloads, f"{wh.root}/lake/raw/station_status")
    now = F.lit(ingested_at).cast("timestamp")
    rows, letters = station_feed.status_payloads(payloads, now)
    batch = F.lit(int(ingested_at.replace(tzinfo=dt.timezone.utc).timestamp())).cast("long")
    counts = []
    for frame, table, name, day in (
        (rows, "station_status", "_snapshot_date", F.col("_snapshot_date")),
        (letters, "station_status_dlq", "_failed_date", F.to_date("failed_at")),
    ):
        stored = materialize(frame.withColumns({name: day, "_batch_id": batch}), table)
        lake.write_batches(stored, wh.path(table, "raw"), name)
        counts.append(stored.count())
    return counts[0], counts[1]


def trip_store(wh: Warehouse) -> SnapshotStore:
    """The trip tables of a warehouse: facts, key index, partial aggregates."""
    return SnapshotStore(wh.spark, f"{wh.root}/trips")


def _models(
    wh: Warehouse, p: Params, store: Callable[[DataFrame, str], DataFrame] = scratch
) -> Models:
    raw = (
        wh.raw("trips", schemas.TRIPS),
        wh.raw("station_status", schemas.STATION_STATUS),
        wh.raw("station_information", schemas.STATION_INFORMATION),
    )
    trips = trip_store(wh)
    at = trips.snapshot()
    if at.number:
        return StoredTrips(trips, at, *raw, p, store)
    return Models(*raw, p, store_trips=True, store=store)


def _publish(wh: Warehouse, models: Models, *names: str) -> None:
    """Store models in the warehouse; later ones read what was stored."""
    for name in names:
        setattr(models, name, wh.store(getattr(models, name), name))


def _tested(models: Models, names: Sequence[str]) -> None:
    q.enforce_checks(models.assertions_report(names))


def _pending(wh: Warehouse, full: bool) -> tuple[list[str], list[dt.date]]:
    """Loads that no batch refresh has dealt with, and the dates they changed."""
    loads = lake.read_or_none(wh.spark, wh.path("trip_loads", "raw"))
    if loads is None:
        return [], []
    done = lake.read_or_none(wh.spark, wh.path("trip_refreshes", "raw"))
    if done is not None:
        loads = loads.join(done, "load_id", "left_anti")
    new = loads.select("load_id").distinct().collect()
    days = {r.day for r in loads.select("day").distinct().collect()}
    if full:
        days |= set(storage.partition_dates(wh.spark, wh.path("trips", "raw"), RAW_DAY))
        days |= set(trip_store(wh).snapshot().segments("clean"))
    return [r.load_id for r in new], sorted(days)


def refresh_batch(wh: Warehouse, p: Params, run_id: str, full: bool = False) -> Models:
    """Trips of the dates loaded since the last run, then stations, marts, data tests and metrics.

    The trip tables are published together once their gate has passed; marts are sums over
    partial aggregates. ``full`` derives every date again. Nothing but touched dates, and dates
    that hold another copy of a ride, is read from raw or clean trips and from facts.
    """
    trips = trip_store(wh)
    loads, days = _pending(wh, full or not trips.snapshot().number)
    if days or not trips.snapshot().number:
        refresh_trips(trips, wh.raw("trips", schemas.TRIPS), days, p)
        done = wh.spark.createDataFrame([(load, run_id) for load in loads], TRIP_REFRESHES)
        done.coalesce(1).write.mode("append").parquet(wh.path("trip_refreshes", "raw"))
        trips.expire()
    models = _models(wh, p, wh.store)
    kept, at = status_store(wh), status_store(wh).snapshot()
    if at.number:
        models.calendar = models.dim_date = _calendar(wh, p)
    _publish(wh, models, "station_id_mapping", "dim_date", "dim_rider_type")
    models.calendar = models.dim_date
    _ = models.station_id_bridge
    _publish(wh, models, "dim_station", "station_demand", *BATCH_MARTS)
    _tested(models, BATCH_TESTED)
    if at.number:
        metrics = q.dq_metrics_of_counts("station_status", status.counts(kept, at), run_id, p)
    else:
        sides = (models.stg_station_status, models.stg_station_status_rejected, models.raw_status)
        metrics = q.dq_metrics({"station_status": sides}, run_id, p)
    metrics = metrics.unionByName(q.dq_metrics_of_counts("trips", models.trip_counts, run_id, p))
    lake.append_metrics(metrics, wh.path("dq_metrics", "raw"))
    return models


def _last_status_run(wh: Warehouse) -> Row | None:
    found = lake.read_or_none(wh.spark, wh.path("status_refreshes", "raw"))
    return None if found is None else found.orderBy(F.desc("batch_mark"), F.desc("refreshed_at")).first()


def status_store(wh: Warehouse) -> SnapshotStore:
    """What is kept of the status tables: running counts, snapshot sizes, movement, data tests."""
    return SnapshotStore(wh.spark, f"{wh.root}/status")


def _newest_batch(wh: Warehouse) -> int | None:
    """The highest delivered batch, a value of the folders' names."""
    files = storage.listing(wh.spark, wh.path("station_status", "raw"))
    if files is None:
        return None
    return files.agg(F.max(storage.partition_value("_batch_id").try_cast("long"))).first()[0]


def refresh_status(wh: Warehouse, p: Params, full: bool = False) -> Models:
    """Status gate, then the status fact, the change archive and the operational marts.

    Demand and the bridge are read as the last batch refresh stored them. A run merges
    the rows delivered since the one before and reads and rewrites only the dates they touch:
    gates, data tests, the latest snapshot and volatility come from what is kept per date. The
    first run, one after a change of the bridge, and ``full`` build everything from the raw rows.
    """
    spark, store = wh.spark, status_store(wh)
    models = _models(wh, p, wh.store)
    models.station_demand = spark.read.parquet(wh.path("station_demand"))
    models.station_id_bridge = spark.read.parquet(wh.path("station_id_bridge"))
    bridge_hash = models.station_id_bridge.agg(
        F.bit_xor(F.xxhash64(*models.station_id_bridge.columns))
    ).first()[0]
    last = _last_status_run(wh)
    raw = lake.read_or_none(spark, wh.path("station_status", "raw"))
    mark = _newest_batch(wh)
    known = lake.read_or_none(spark, wh.path("stg_station_status"))
    full = full or last is None or known is None or raw is None or last.bridge_hash != bridge_hash
    full = full or not store.snapshot().number
    if full:
        q.enforce(models.status_gate)
        reported = F.to_date("last_reported")
        wh.store(models.stg_station_status.withColumn("_reported_date", reported), "stg_station_status")
        changed = models.stored_fct_station_status
        touched = status.Touched(None, None, None)
        batches = status.batch_counts(-1 if mark is None else mark, models.raw_status, models.stg_station_status_rejected)
    else:
        new_raw = raw.where(F.col("_batch_id") > last.batch_mark)
        changed, batches = _merge_status(wh, models, new_raw, mark, p)
        touched = _noted(wh, last.batch_mark)
    facts = spark.read.parquet(wh.path("fct_station_status"))
    models.fct_station_status = models.stored_fct_station_status = facts
    late, archived = _extend_archive(wh, models, facts if full else changed)
    if not full:
        touched.changes |= archived
    staged = spark.read.parquet(wh.path("stg_station_status"))
    models.stg_station_status = staged.drop("_reported_date")
    at = status.update(store, touched, staged, facts, models.status_changes, batches, p)

    models.latest_complete_snapshot = status.latest_complete_snapshot(store, at, p)
    models.station_volatility = status.station_volatility(store, at, p)
    models.calendar = models.dim_date = _calendar(wh, p)
    _publish(wh, models, *STATUS_MARTS)
    models.demand_vs_supply = wh.store(models.demand_vs_supply, "station_demand_vs_supply")
    _publish(wh, models, *DEMAND_MARTS, "station_volatility")
    kept = [name for _, names in status.TESTED.values() for name in names]
    kept.append("stg_station_status_rejected")
    parents = {"dim_station": models.dim_station, "dim_date": models.dim_date}
    report = models.assertions_report([name for name in STATUS_TESTED if name not in kept])
    q.enforce_checks(report.unionByName(status.assertions_report(store, at, parents, p, kept)))
    row = (p.as_of, mark, bridge_hash, changed.count(), late, full)
    spark.createDataFrame([row], STATUS_LOG).write.mode("append").parquet(
        wh.path("status_refreshes", "raw")
    )
    return models


def _calendar(wh: Warehouse, p: Params) -> DataFrame:
    """The date dimension from the dates that trips and snapshots are kept for."""
    trips, snapshots = trip_store(wh), status_store(wh)
    days = []
    for store, table in ((trips, "daily"), (snapshots, "sizes")):
        rows = [(day,) for day in store.snapshot().segments(table)]
        days.append(wh.spark.createDataFrame(rows, "day date"))
    return core.dim_date(*days, p, "day", "day")


def _note(wh: Warehouse, mark: int, kind: str, days: Iterable[dt.date]) -> None:
    """Note dates before they are rewritten; the run that finishes deals with them."""
    rows = wh.spark.createDataFrame([(mark, kind, day) for day in days], STATUS_TOUCHED)
    rows.coalesce(1).write.mode("append").parquet(wh.path("status_touched", "raw"))


def _noted(wh: Warehouse, after: int) -> status.Touched:
    """Dates noted since the last run that finished, by it or by one that did not."""
    found = lake.read_or_none(wh.spark, wh.path("status_touched", "raw"))
    touched = status.Touched()
    if found is not None:
        for r in found.where(F.col("mark") > after).select("kind", "day").distinct().collect():
            getattr(touched, r.kind).add(r.day)
    return touched


def _merge_status(
    wh: Warehouse, models: Models, new_raw: DataFrame, mark: int, p: Params
) -> tuple[DataFrame, DataFrame]:
    """Merge newly delivered rows into the staged status and the fact.

    Returns their fact rows and the counts of the delivery. Nothing is written before the gate.
    """
    spark, path, fact_path = wh.spark, wh.path("stg_station_status"), wh.path("fct_station_status")
    store = status_store(wh)
    keys, latest_by = list(p.status_dedup_key), ["_ingested_at", "snapshot_timestamp"]
    cleaned = staging.cleaned_status(schemas.conform(new_raw, schemas.STATION_STATUS))
    new = staging.stg_station_status(cleaned, p).withColumn("_reported_date", F.to_date("last_reported"))
    new = materialize(new, "new_status")
    rejected = staging.stg_station_status_rejected(cleaned, p)
    batches = materialize(status.batch_counts(mark, cleaned, rejected), "batch_counts")
    stored = spark.read.parquet(path).select(*new.columns)
    days = [r[0] for r in new.select("_reported_date").distinct().collect()]
    touched = stored.where(F.col("_reported_date").isin(days))
    merged = materialize(merge_states(touched, new, keys, latest_by), "merged_status")
    same = [*keys, *latest_by]
    changed = materialize(merged.join(touched, same, "left_anti"), "changed_status")
    replaced = materialize(touched.join(changed.select(*keys), keys, "left_semi"), "replaced_status")
    counts = status.counts(store, store.snapshot(), batches, merged, days)
    q.enforce(q.status_gate_of_counts(counts, p))

    rows = changed.drop("_reported_date")
    risk = intermediate.station_risk(rows, models.station_id_bridge, p)
    facts = materialize(core.fct_station_status(risk), "changed_facts")
    fact_days = F.to_date("snapshot_timestamp")
    dates = changed.select(fact_days.alias("d")).unionByName(replaced.select(fact_days.alias("d")))
    dates = [r.d for r in dates.distinct().collect()]
    _note(wh, mark, "staged", days)
    _note(wh, mark, "facts", dates)
    lake.write_partitions(merged, path, "_reported_date", ["station_id"])
    old = spark.read.parquet(fact_path).where(F.col("snapshot_date").isin(dates))
    gone = changed.select(F.col("station_id").alias("gbfs_station_id"), "last_reported")
    old = old.join(gone, ["gbfs_station_id", "last_reported"], "left_anti")
    lake.rewrite_dates(
        old.select(*facts.columns).unionByName(facts), fact_path, "snapshot_date", dates,
        ["station_key"],
    )
    return facts, batches


def _extend_archive(wh: Warehouse, models: Models, facts: DataFrame) -> tuple[int, set[dt.date]]:
    """Append the changes in ``facts`` to the archive; returns rows that came too late, and dates.

    The state table holds the last archived change of every station, so neither the archive
    nor older facts are read. Rows at or before its newest change are late.
    """
    path = wh.path("status_changes")
    seed = lake.read_or_none(wh.spark, wh.path("station_state"))
    late = 0
    if seed is None:
        changes = materialize(intermediate.status_changes(facts), "changes")
        state = intermediate.archive_seed(changes)
    else:
        seed = materialize(seed, "seed")
        mark = seed.agg(F.max("snapshot_timestamp")).first()[0]
        at = F.lit(mark).cast("timestamp")
        late = intermediate.late_rows(facts, at).first().late_rows if mark is not None else 0
        new = materialize(intermediate.compared_rows(facts, at if mark is not None else None), "compared")
        changes = materialize(intermediate.status_changes(new, seed), "changes")
        state = seed.unionByName(intermediate.archive_seed(changes))
        state = keep_latest(state, ["gbfs_station_id"], ["snapshot_timestamp"])
    keys = ["gbfs_station_id", "valid_from"]
    lake.merge_into(changes, path, keys, ["last_reported"], "snapshot_date")
    wh.store(state, "station_state")
    archive = lake.read_or_none(wh.spark, path)
    archive = changes if archive is None else archive.select(*changes.columns)
    models.status_changes = models.stored_status_changes = archive
    return late, {r[0] for r in changes.select("snapshot_date").distinct().collect()}


def finish(wh: Warehouse) -> int:
    """Delete the scratch tables of this application; call it when a run's results are not read on."""
    return storage.delete(wh.spark, [application_dir(wh.spark)])


def watchdog(wh: Warehouse, p: Params) -> DataFrame:
    """Freshness, writer liveness, dead-letter growth and staging rejection, one row each.

    The verdicts and their summary are appended to the warehouse.
    """
    models = _models(wh, p)
    letters = wh.raw("station_status_dlq", schemas.STATION_STATUS_DLQ)
    checks = [
        q.check_freshness(models.raw_status, p),
        q.check_liveness(lake.newest_write(wh.spark, wh.path("station_status", "raw")), p),
        q.check_dlq_growth(letters, p),
        q.check_staging_rejection(models.stg_station_status, models.stg_station_status_rejected, p),
    ]
    rows = materialize(q.union_all(checks), "watchdog")
    summary = q.check_summary([rows]).withColumn("checked_at", F.lit(p.as_of).cast("timestamp"))
    summary.write.mode("append").parquet(wh.path("watchdog_runs", "raw"))
    return rows


def clean_up(wh: Warehouse, p: Params) -> DataFrame:
    """Drop expired dates and lake objects; report both status tables before and after."""
    spark, keep = wh.spark, p.retention_days
    tables = {
        "station_status": ("_snapshot_date", wh.raw("station_status", schemas.STATION_STATUS)),
        "station_status_dlq": ("_failed_date", _dead_letter_days(wh)),
    }
    reports = [
        lake.retention_report(rows, name, day, keep[name], p) for name, (day, rows) in tables.items()
    ]
    report = materialize(q.union_all(reports), "retention")
    for name, (day, _) in tables.items():
        lake.drop_expired_partitions(spark, wh.path(name, "raw"), day, keep[name], p)
    lake.drop_expired_partitions(spark, wh.path("dq_metrics", "raw"), "run_date", keep["dq_metrics"], p)
    _expire_status(wh, p)
    lake.apply_lake_lifecycle(spark, f"{wh.root}/lake", p)
    return report


def _dead_letter_days(wh: Warehouse) -> DataFrame:
    letters = wh.raw("station_status_dlq", schemas.STATION_STATUS_DLQ)
    return letters.withColumn("_failed_date", F.to_date("failed_at"))


def _expire_status(wh: Warehouse, p: Params) -> None:
    """Staged rows and facts go with the raw rows they came from."""
    days = p.retention_days["station_status"]
    cutoff = p.as_of.date() - dt.timedelta(days=days)
    lake.drop_expired_partitions(wh.spark, wh.path("fct_station_status"), "snapshot_date", days, p)
    path = wh.path("stg_station_status")
    old = [d for d in storage.partition_dates(wh.spark, path, "_reported_date") if d < cutoff]
    if old:
        staged = wh.spark.read.parquet(path).where(F.col("_reported_date").isin(old))
        kept = staged.where(F.col("_snapshot_date") >= F.lit(cutoff))
        lake.rewrite_dates(kept, path, "_reported_date", old, ["station_id"])
