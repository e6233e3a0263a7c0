"""Registered queries over sources, sinks and runs: the given tables written out, broken on
purpose in places, and read back by the operators. Each has its DuckDB twin."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import fixture_views as fx
import oracles as o
from velomart.functions import clean_text
from velomart.operators import mergeable, quality
from velomart.params import Params
from velomart.plans import intermediate, profiling, refresh
from velomart.plans import trip_increments as ti
from velomart.plans.models import Models
from velomart.schemas import STATION_STATUS_DLQ, TRIP_CSV_COLUMNS
from velomart.sources import lake, station_feed, storage, trip_files
from velomart.sources.snapshots import SnapshotStore
from velomart.streaming.batch_log import BatchLog
from velomart.streaming.ingest import (
    append_status_stream,
    last_per_key,
    write_dlq_windows,
    write_status_stream,
)
from velomart.streaming.progress import ProgressLog, check_queries, progress_table
from velomart.workspace import materialize, scratch_path
from workload import P, assertions_sql, model, register


def _now() -> Column:
    return F.lit(P.as_of).cast("timestamp")


# --- trip files: S1-S3, E1, E2, A10 ----------------------------------------------------


def _order(ride: Column) -> Column:
    return F.split_part(ride, F.lit("-"), F.lit(1)).cast("long")


def _trip_text(trips: DataFrame) -> DataFrame:
    """The raw trips as text, some of it unusable, chosen by the order number."""
    k = _order(F.col("ride_id")) % 10
    text = trips.select(*[F.col(c).cast("string").alias(c) for c in TRIP_CSV_COLUMNS], "_source_file")
    lat = (
        F.when(k == 1, "NA").when(k == 2, "abc").when(k == 3, F.concat("start_lat", F.lit("d")))
        .when(k == 5, F.concat(F.lit(" "), "start_lat")).otherwise(F.col("start_lat"))
    )
    start = F.when(k == 4, "not a time").when(k == 6, "").otherwise(F.col("started_at"))
    return text.withColumns({"start_lat": lat, "started_at": start})


def _csv_folder(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "csv")
    trips = fx.raw_trips(spark, sf_dir)
    (
        _trip_text(trips).select(*TRIP_CSV_COLUMNS)
        .write.option("header", True).option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False).csv(path)
    )
    return path


def _csv_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = trip_files.discover_files(spark, _csv_folder(spark, sf_dir))
    return trip_files.read_trip_text(spark, files)


def _csv_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files found, read as text, typed, stamped, and split by their start time."""
    typed = trip_files.typed_trips(_csv_text(spark, sf_dir), dt.datetime(2024, 2, 1))
    placed, lost = trip_files.split_unplaceable(typed)
    rows = placed.withColumn("rejection_reason", F.lit(None).cast("string")).unionByName(lost)
    return rows.select(
        "ride_id", "started_at", "start_lat", "end_lat", "start_station_id", "_ride_started_date",
        F.col("_ingested_at").alias("ingested_at"), "rejection_reason",
        F.col("_source_file").endswith(".csv").alias("has_file_name"),
    )


_K = "(CAST(split_part(ride_id, '-', 1) AS BIGINT) % 10)"
_STARTED = f"CASE WHEN {_K} NOT IN (4, 6) THEN started_at END"
register(
    "csv_ingest",
    _csv_trips,
    o.sql(
        f"SELECT ride_id, {_STARTED} AS started_at, CASE WHEN {_K} NOT IN (1, 2, 3) THEN start_lat END "
        f"AS start_lat, end_lat, start_station_id, CAST({_STARTED} AS DATE) AS _ride_started_date, "
        "TIMESTAMP '2024-02-01 00:00:00' AS ingested_at, "
        f"CASE WHEN {_STARTED} IS NULL THEN 'missing_started_at' END AS rejection_reason, "
        "TRUE AS has_file_name FROM trips",
        "trips",
    ),
)


def _cast_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    casts = {"started_at": "timestamp_ntz", "start_lat": "double", "end_lat": "double"}
    return profiling.cast_failures(_csv_text(spark, sf_dir), casts)


# Spark casts the text 40.5d to a number; the CSV reader does not, so k = 3 is no cast failure
register(
    "profile_cast_failures",
    _cast_failures,
    o.sql(
        f"SELECT 'started_at' AS column_name, count(*) FILTER (WHERE {_K} = 4) AS cast_failures, "
        f"count(*) FILTER (WHERE {_K} = 6 OR ({_K} <> 4 AND started_at IS NULL)) AS blank_values FROM trips "
        f"UNION ALL SELECT 'start_lat', count(*) FILTER (WHERE {_K} = 2), "
        f"count(*) FILTER (WHERE {_K} = 1 OR ({_K} <> 2 AND start_lat IS NULL)) FROM trips "
        "UNION ALL SELECT 'end_lat', 0, count(*) FILTER (WHERE end_lat IS NULL) FROM trips",
        "trips",
    ),
)


def _headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header and data lines per yearly file; every third year lacks a column or has another."""
    trips = fx.raw_trips(spark, sf_dir)
    files = trips.select("_source_file").distinct()
    year = F.regexp_extract("_source_file", "([0-9]{4})", 1).cast("int")
    names = ",".join(TRIP_CSV_COLUMNS)
    header = (
        F.when(year % 3 == 0, names.replace(",end_lng", "")).when(year % 3 == 1, f'"{names},""extra"""')
        .otherwise(names)
    )
    lines = files.select("_source_file", header.alias("value")).unionByName(
        trips.select("_source_file", F.col("ride_id").alias("value"))
    )
    stored = materialize(lines, "lines")
    return profiling.header_consistency(stored)


_YEAR = "CAST(regexp_extract(_source_file, '([0-9]{4})', 1) AS INTEGER)"
register(
    "profile_headers",
    _headers,
    o.sql(
        # the most common header is the reference; of equally common ones the first by its columns
        "SELECT * FROM (WITH f AS (SELECT DISTINCT _source_file, " + _YEAR + " % 3 AS kind FROM trips), "
        "c AS (SELECT kind FROM f GROUP BY kind ORDER BY count(*) DESC, "
        "CASE kind WHEN 0 THEN 0 WHEN 2 THEN 1 ELSE 2 END LIMIT 1) "
        "SELECT _source_file, CAST(CASE f.kind WHEN 0 THEN 12 WHEN 1 THEN 14 ELSE 13 END AS BIGINT) AS n_cols, "
        "CASE WHEN f.kind = c.kind THEN '' WHEN f.kind = 1 AND c.kind = 0 THEN 'end_lng|extra' "
        "WHEN f.kind = 1 THEN 'extra' WHEN f.kind = 2 AND c.kind = 0 THEN 'end_lng' ELSE '' END AS extra_columns, "
        "CASE WHEN f.kind = c.kind THEN '' WHEN f.kind = 0 AND c.kind = 1 THEN 'end_lng|extra' "
        "WHEN f.kind = 0 THEN 'end_lng' WHEN f.kind = 2 AND c.kind = 1 THEN 'extra' ELSE '' END AS missing_columns "
        "FROM f, c) q",
        "trips",
    ),
)


def _phantoms(m: Models) -> DataFrame:
    """Every third station once more under another id, at the same place."""
    number = F.col("station_id").try_cast("double")
    twin = m.dim_station.where(F.floor(number) % 3 == 0)
    twin = twin.withColumn("station_id", F.concat(F.lit("X"), "station_id"))
    found = quality.phantom_stations(materialize(m.dim_station.unionByName(twin), "stations"))
    return found


model(
    "phantom_stations_found",
    _phantoms,
    o.sql(
        "SELECT * FROM (WITH s AS (SELECT station_id, station_name, lat, lng FROM bridge UNION ALL "
        "SELECT 'X' || station_id, station_name, lat, lng FROM bridge "
        "WHERE floor(TRY_CAST(station_id AS DOUBLE)) % 3 = 0) "
        "SELECT station_name, round(lat, 6) AS lat, round(lng, 6) AS lng, "
        "count(DISTINCT station_id) AS n_station_ids, "
        "string_agg(DISTINCT station_id, ' | ' ORDER BY station_id) AS station_ids FROM s "
        "WHERE station_name IS NOT NULL AND lat IS NOT NULL AND lng IS NOT NULL "
        "GROUP BY 1, 2, 3 HAVING count(DISTINCT station_id) > 1) q",
        "bridge",
    ),
)

# Code points of white space that is easily forgotten, spelled out for both sides.
_SPACES = (0x2003, 0x3000, 0x85, 0x1680, 0x200A, 0x2028, 0xA0, 0x0B)


def _spaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station ids between rare white space, trimmed, counted by id."""
    trips = fx.raw_trips(spark, sf_dir)
    space = F.element_at(F.array(*[F.lit(chr(c)) for c in _SPACES]), (_order(F.col("ride_id")) % 8 + 1).cast("int"))
    spaced = F.concat(space, F.lit(" "), "start_station_id", space)
    found = trips.select(clean_text(spaced).alias("station_id"), clean_text(space).alias("blank"))
    return found.groupBy("station_id", "blank").agg(F.count(F.lit(1)).alias("n"))


register(
    "white_space",
    _spaced,
    o.sql(
        "SELECT nullif(trim(start_station_id, chr(32)), '') AS station_id, CAST(NULL AS VARCHAR) AS blank, "
        "count(*) AS n FROM trips GROUP BY 1",
        "trips",
    ),
)

# --- lake: S20, S4 on a rerun, S18, S21, D13 -------------------------------------------


def _lake_rerun(m: Models) -> DataFrame:
    """A file comes again without some of its dates; the lake and the table follow it."""
    spark = m.raw_trips.sparkSession
    folder, table = scratch_path(spark, "lake"), scratch_path(spark, "trips_table")
    year = F.trunc("_ride_started_date", "quarter")
    trips = materialize(m.raw_trips.withColumn("_ride_started_date", year), "quarters")
    files = sorted(r[0] for r in trips.select("_source_file").distinct().collect())
    days = lake.write_daily_lake(trips, folder, files)
    stored = spark.read.parquet(folder)
    lake.load_files(stored, table, files, days)
    again = files[: len(files) // 2]
    corrected = trips.where(F.col("_source_file").isin(again) & (F.month("_ride_started_date") != 4))
    days = lake.write_daily_lake(corrected, folder, again)
    lake.load_files(spark.read.parquet(folder), table, again, days)
    loaded = spark.read.parquet(table)
    lake.enforce_reconciled(
        lake.reconcile(spark.read.parquet(folder), loaded, "dt", "_ride_started_date")
    )
    return loaded.groupBy("_source_file", "_ride_started_date").agg(F.count(F.lit(1)).alias("n"))


model(
    "lake_rerun",
    _lake_rerun,
    o.sql(
        "SELECT * FROM (WITH t AS (SELECT _source_file, CAST(date_trunc('quarter', _ride_started_date) AS DATE) AS d FROM trips), "
        "f AS (SELECT _source_file, row_number() OVER (ORDER BY _source_file) AS k, "
        "count(*) OVER () AS n FROM (SELECT DISTINCT _source_file FROM t) x) "
        "SELECT _source_file, d AS _ride_started_date, count(*) AS n FROM t JOIN f USING (_source_file) "
        "WHERE NOT (k <= f.n // 2 AND month(d) = 4) GROUP BY 1, 2) q",
        "trips",
    ),
)


def _layers(m: Models) -> DataFrame:
    """Tables stored in their layers: dates per table, rows, and rows out of cluster order."""
    spark = m.raw_status.sparkSession
    wh = refresh.Warehouse(spark, scratch_path(spark, "warehouse"))
    out = []
    for name, frame, cluster in (
        ("fct_station_status", m.stored_fct_station_status, "station_key"),
        ("status_changes", m.stored_status_changes, "gbfs_station_id"),
        ("dim_date", m.dim_date, None),
        ("station_state", intermediate.archive_seed(m.stored_status_changes), None),
    ):
        wh.store(frame, name)
        day = storage.partition_value("snapshot_date")
        layer = F.regexp_extract("path", f"/([^/]+)/{name}/", 1)
        stored = spark.read.parquet(wh.path(name))
        unsorted = F.lit(0).cast("long")
        if cluster is not None:
            rows = stored.select(F.col(cluster).alias("k"), "_metadata.file_path", "_metadata.row_index")
            before = F.lag("k").over(Window.partitionBy("file_path").orderBy("row_index"))
            unsorted = rows.withColumn("b", before).agg(F.count_if(F.col("k") < F.col("b"))).scalar()
        found = storage.listing(spark, wh.path(name)).groupBy(layer.alias("layer")).agg(
            F.countDistinct(F.nullif(day, F.lit(""))).alias("n_dates")
        )
        counts = {"n_rows": stored.agg(F.count(F.lit(1))).scalar(), "out_of_order": unsorted}
        out.append(materialize(found.withColumns({"table_name": F.lit(name), **counts}), "layer"))
    return quality.union_all(out)


model(
    "warehouse_layers",
    _layers,
    o.sql(
        "SELECT 'marts' AS layer, count(DISTINCT snapshot_date) AS n_dates, 'fct_station_status' AS table_name, "
        "count(*) AS n_rows, CAST(0 AS BIGINT) AS out_of_order FROM fct_station_status UNION ALL "
        "SELECT 'intermediate', count(DISTINCT snapshot_date), 'status_changes', count(*), 0 FROM changes UNION ALL "
        "SELECT 'marts', 0, 'dim_date', count(*), 0 FROM dim_date UNION ALL "
        "SELECT 'intermediate', 0, 'station_state', count(DISTINCT gbfs_station_id), 0 FROM changes",
        "fct_station_status",
        "changes",
        "dim_date",
    ),
)


def _lifecycle(m: Models) -> DataFrame:
    """Objects of all ride dates, seen by the age rule of today and of a year from now."""
    spark = m.raw_trips.sparkSession
    root = scratch_path(spark, "lifecycle")
    years = m.raw_trips.withColumn("_ride_started_date", F.trunc("_ride_started_date", "year"))
    lake.write_daily_lake(years, f"{root}/raw/trips")
    lake.write_json_lines(m.raw_information, f"{root}/reference/station_information")
    today = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    out = []
    for name, days in (("today", 0), ("in_200_days", 200), ("in_400_days", 400)):
        lake.apply_lake_lifecycle(spark, root, Params(as_of=today + dt.timedelta(days=days)))
        for prefix in ("raw/trips", "reference"):
            files = storage.listing(spark, f"{root}/{prefix}")
            gone = files is None or files.isEmpty()
            rows = None if gone or prefix == "reference" else spark.read.parquet(f"{root}/{prefix}")
            counted = m.raw_trips.limit(0) if rows is None else rows
            out.append(
                counted.agg(F.count(F.lit(1)).alias("n_rows")).select(
                    F.lit(name).alias("run"), F.lit(prefix).alias("prefix"), F.lit(not gone).alias("is_kept"), "n_rows"
                )
            )
            out[-1] = materialize(out[-1], "lifecycle_run")
    return quality.union_all(out)


model(
    "lifecycle_expiry",
    _lifecycle,
    o.sql(
        "SELECT run, prefix, is_kept, CASE WHEN prefix = 'raw/trips' AND is_kept "
        "THEN (SELECT count(*) FROM trips) ELSE 0 END AS n_rows FROM (VALUES "
        "('today', 'raw/trips', TRUE), ('today', 'reference', TRUE), ('in_200_days', 'raw/trips', FALSE), "
        "('in_200_days', 'reference', TRUE), ('in_400_days', 'raw/trips', FALSE), "
        "('in_400_days', 'reference', FALSE)) v(run, prefix, is_kept)",
        "trips",
    ),
)


def _liveness(m: Models) -> DataFrame:
    """The newest write of a stored table, judged now, an hour later, and where nothing is."""
    spark = m.raw_status.sparkSession
    path = scratch_path(spark, "alive")
    lake.append_metrics(
        m.raw_status.groupBy(F.col("_snapshot_date").alias("run_date")).agg(F.count(F.lit(1)).alias("n")), path
    )
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    checks = []
    for name, where, at in (
        ("now", path, now), ("later", path, now + dt.timedelta(hours=1)), ("nowhere", f"{path}-none", now)
    ):
        found = quality.check_liveness(lake.newest_write(spark, where), Params(as_of=at))
        checks.append(found.select(F.lit(name).alias("seen"), "check_name", "status"))
    stored = spark.read.parquet(path)
    days = stored.agg(F.count(F.lit(1))).scalar()
    n_rows = stored.agg(F.sum("n")).scalar()
    found = quality.union_all(checks).withColumns({"days": days, "n_rows": n_rows})
    return materialize(found, "liveness")


model(
    "writer_liveness",
    _liveness,
    o.sql(
        "SELECT seen, 'consumer_liveness' AS check_name, status, days, n_rows FROM "
        "(VALUES ('now', 'OK'), ('later', 'STALE'), ('nowhere', 'EMPTY')) v(seen, status), "
        "(SELECT count(DISTINCT _snapshot_date) AS days, count(*) AS n_rows FROM station_status) d",
        "station_status",
    ),
)

# --- station information: S8-S12, D6, D7, D9 -------------------------------------------


#: Stations and events in one payload, about; a region or user of any size is many payloads.
_PAYLOAD_ROWS = 200


def _information_payloads(m: Models, root: str) -> DataFrame:
    """Payloads of a bounded number of stations of a region, broken here and there, as whole texts."""
    n = F.substring("station_id", 3, 20).cast("long")
    parts = m.raw_information.agg((F.floor(F.count(F.lit(1)) / _PAYLOAD_ROWS) + 1).cast("long")).scalar()
    station = F.struct(
        "station_id", "name", "short_name", F.col("lat").cast("string").alias("lat"), "lon",
        F.when(n % 7 == 0, "many").otherwise(F.col("capacity").cast("string")).alias("capacity"),
        F.coalesce("region_id", F.lit("none")).alias("region_id"),
    )
    texts = F.collect_list(F.to_json(station))
    region = F.coalesce("region_id", F.lit("none")).alias("region")
    payload = m.raw_information.groupBy(region, (n % parts).alias("part")).agg(
        F.concat(F.lit('{"last_updated": 1, "data": {"stations": ['), F.array_join(texts, ","), F.lit("]}}")).alias("value")
    )
    broken = payload.select("region", "part", F.lit('{"last_updated": "soon", "data": {"stations": [1, {}]}}').alias("value"))
    named = payload.withColumn("kind", F.lit("good")).unionByName(broken.withColumn("kind", F.lit("bad")))
    for kind in ("good", "bad"):
        named.where(F.col("kind") == kind).select("value").write.option("lineSep", "\n").text(f"{root}/{kind}")
    return m.raw_information.sparkSession.read.text([f"{root}/good", f"{root}/bad"])


def _information(m: Models) -> DataFrame:
    """Payloads, envelopes, records, full replace, verification, and the lines read back."""
    spark = m.raw_information.sparkSession
    root = scratch_path(spark, "information")
    envelopes = station_feed.parse_envelope(_information_payloads(m, root))
    at = dt.datetime(2024, 2, 1)
    rows, rejected = station_feed.parse_information(station_feed.stations_of(envelopes), at)
    for _ in range(2):
        staged = lake.replace_table(rows, f"{root}/table")
    try:  # an empty replace is refused and the stored table stays
        lake.replace_table(rows.where("station_id IS NULL"), f"{root}/table")
    except lake.EmptyReplaceError:
        pass
    verdict = station_feed.verify_information(spark.read.parquet(f"{root}/table"), staged.count())
    lake.write_json_lines(staged, f"{root}/lines")
    back = station_feed.read_information(spark, f"{root}/lines")
    kept = back.select(
        "station_id", F.lit(None).cast("string").alias("problem"), "capacity", "lat", "region_id",
        F.lit(verdict.first().is_ok).alias("is_verified"),
    )
    none = F.lit(None)
    bad = rejected.select(
        "station_id", F.col("error").alias("problem"), none.cast("long").alias("capacity"),
        none.cast("double").alias("lat"), none.cast("string").alias("region_id"),
        none.cast("boolean").alias("is_verified"),
    )
    letters = station_feed.envelope_dead_letters(envelopes, _now()).select(
        none.cast("string").alias("station_id"), F.col("error_reason").alias("problem"),
        none.cast("long").alias("capacity"), none.cast("double").alias("lat"),
        none.cast("string").alias("region_id"), none.cast("boolean").alias("is_verified"),
    )
    return kept.unionByName(bad).unionByName(letters)


_N = "CAST(substr(station_id, 3) AS BIGINT)"
model(
    "information_load",
    _information,
    o.sql(
        f"SELECT station_id, CAST(NULL AS VARCHAR) AS problem, capacity, lat, coalesce(region_id, 'none') AS region_id, "
        f"TRUE AS is_verified FROM station_information WHERE {_N} % 7 <> 0 UNION ALL "
        f"SELECT station_id, 'capacity is not an integer', NULL, NULL, NULL, NULL FROM station_information WHERE {_N} % 7 = 0 "
        "UNION ALL SELECT NULL, 'invalid_envelope: 2 masalah', NULL, NULL, NULL, NULL FROM "
        f"(SELECT DISTINCT coalesce(region_id, 'none'), {_N} % (SELECT count(*) // {_PAYLOAD_ROWS} + 1 "
        "FROM station_information) FROM station_information) r",
        "station_information",
    ),
)


def _payload_gate(m: Models) -> DataFrame:
    """Does the payload gate stop at 5 %, and at 50 %?"""
    root = scratch_path(m.raw_information.sparkSession, "information_gate")
    envelopes = station_feed.parse_envelope(_information_payloads(m, root))
    rows, rejected = station_feed.parse_information(
        station_feed.stations_of(envelopes), dt.datetime(2024, 2, 1)
    )
    verdicts = []
    for limit in (5.0, 50.0):
        try:
            station_feed.enforce_payload_quality(rows, rejected, Params(quarantine_alert_pct=limit))
            stopped = False
        except quality.QualityGateError:
            stopped = True
        verdicts.append(rejected.agg(F.count(F.lit(1)).alias("rejected")).select(
            F.lit(limit).alias("limit_pct"), F.lit(stopped).alias("is_stopped"), "rejected"))
    return quality.union_all(verdicts)


model(
    "payload_gate",
    _payload_gate,
    o.sql(
        f"SELECT limit_pct, 100.0 * bad / n > limit_pct AS is_stopped, bad AS rejected FROM "
        "(VALUES (5.0::DOUBLE), (50.0::DOUBLE)) v(limit_pct), (SELECT count(*) AS n, "
        f"count(*) FILTER (WHERE {_N} % 7 = 0) AS bad FROM station_information) s",
        "station_information",
    ),
)

# --- incremental trips: M1, M2, M13, M18, M20, M21, A14, D4, S6, S7 ----------------------

_AGAIN = "CAST(split_part(ride_id, '-', 1) AS BIGINT) % 97 = 0"


def _deliveries(m: Models) -> tuple[SnapshotStore, DataFrame]:
    """Trips in two loads, published after each: files that come late, are corrected, are removed.

    The first load lacks the last file, has wrong stations in the first one, and a file of copies
    that win over older rides of other years; in the second these copies are gone, and some
    rides come again a year later, which settles them anew.
    """
    spark = m.raw_trips.sparkSession
    root = scratch_path(spark, "increments")
    store = SnapshotStore(spark, f"{root}/state")
    trips = m.raw_trips.withColumn(ti.RAW_DAY, F.trunc(ti.RAW_DAY, "year"))
    files = sorted(r[0] for r in trips.select("_source_file").distinct().collect())

    def shifted(rows: DataFrame, name: str, years: int) -> DataFrame:
        later = F.make_dt_interval(days=F.lit(366 * years))
        moved = {"started_at": F.col("started_at") + later, "ended_at": F.col("ended_at") + later}
        rows = rows.withColumns(moved).withColumn("_source_file", F.lit(name))
        rows = rows.withColumn("_ingested_at", F.lit(dt.datetime(2030, 1, 1)).cast("timestamp"))
        return rows.withColumn(ti.RAW_DAY, F.trunc(F.to_date("started_at"), "year")).select(*trips.columns)

    wrong = trips.where(F.col("_source_file") == files[0]).withColumn("end_station_id", F.lit("5007.01"))
    extra = shifted(trips.where(F.expr(_AGAIN.replace("97", "61"))), "extra.csv", 2)
    again = shifted(trips.where(F.expr(_AGAIN)), "again.csv", 1)
    first = trips.where(F.col("_source_file").isin(files[1:-1])).unionByName(wrong).unionByName(extra)
    loads = [
        (first, [*files[:-1], "extra.csv"]),
        (trips.where(F.col("_source_file").isin(files[0], files[-1])).unionByName(again),
         [files[0], files[-1], "extra.csv", "again.csv"]),
    ]
    for rows, names in loads:
        days = lake.write_daily_lake(rows, f"{root}/lake", names)
        lake.load_files(spark.read.parquet(f"{root}/lake"), f"{root}/raw", names, days)
        raw = spark.read.parquet(f"{root}/raw")
        ti.refresh_trips(store, raw, days, replace(P, quarantine_alert_pct=100.0))
    return store, spark.read.parquet(f"{root}/raw")


_DELIVERED: dict[tuple[str, str], tuple[SnapshotStore, ti.StoredTrips]] = {}


def _stored(spark: SparkSession, sf_dir: str) -> ti.StoredTrips:
    """The trips as delivered, once per application: several queries read the same tables."""
    key = (spark.sparkContext.applicationId, sf_dir)
    # the shared folder may have been cleaned since
    if key not in _DELIVERED or not _DELIVERED[key][0].snapshot().number:
        m = fx.models(spark, sf_dir)
        store, raw = _deliveries(m)
        stored = ti.StoredTrips(store, store.snapshot(), raw, m.raw_status, m.raw_information, P)
        _DELIVERED[key] = store, stored
    return _DELIVERED[key][1]


def _incremental_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir).fct_trips.select(
        "trip_key", "ride_id", "trip_date", "started_at", "start_station_id", "end_station_id",
        "member_casual", "duration_seconds", "distance_km", "_source_file",
    )


_LATER = (
    "SELECT * REPLACE (started_at + INTERVAL 366 DAY AS started_at, ended_at + INTERVAL 366 DAY AS ended_at, "
    "'again.csv' AS _source_file, TIMESTAMP '2030-01-01' AS _ingested_at) FROM trips "
    f"WHERE {_AGAIN}"
)
register(
    "trips_incremental",
    _incremental_facts,
    o.sql(
        "SELECT trip_key, ride_id, trip_date, started_at, start_station_id, end_station_id, member_casual, "
        "duration_seconds, distance_km, _source_file FROM fct_trips",
        "fct_trips",
        more_trips=_LATER,
    ),
)


def _incremental_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The marts that are sums over partial aggregates, one under another."""
    stored = _stored(spark, sf_dir)
    none = F.lit(None)

    def rows(frame: DataFrame, name: str, key: Column, *numbers: str) -> DataFrame:
        values = [F.col(c).cast("double") for c in numbers] + [none.cast("double")] * (6 - len(numbers))
        named = [v.alias(f"v{k}") for k, v in enumerate(values)]
        return frame.select(F.lit(name).alias("mart"), key.cast("string").alias("key"), *named)

    return quality.union_all(
        [
            rows(stored.trip_summary_daily, "daily", F.col("date_day"), "total_trips", "member_trips",
                 "ebike_trips", "avg_duration_minutes", "total_distance_km", "active_start_stations"),
            rows(stored.usage_pattern_hourly, "hourly", F.col("day_of_week") * 100 + F.col("start_hour"),
                 "total_trips", "member_trips", "avg_duration_minutes", "share_of_total_pct"),
            rows(stored.member_vs_casual_behavior, "behavior", F.col("member_casual"), "total_trips",
                 "median_duration_minutes", "avg_distance_km", "weekend_trips", "morning_peak_trips"),
            rows(stored.station_demand, "demand", F.col("station_id"), "departure_count", "arrival_count", "net_flow"),
            rows(stored.station_id_mapping, "mapping", F.concat_ws("=", "station_id", "canonical_station_id"),
                 "total_mentions", "ids_in_group"),
            rows(stored.trips_dq_summary, "dq", F.concat_ws("=", "_source_file", "rejection_reason"),
                 "row_count", "valid_rows", "rejected_rows", "duplicate_rows"),
            rows(stored.stations_deduplicated, "stations", F.concat_ws("=", "station_id", "station_name"),
                 "lat", "lng", "trip_mentions"),
        ]
    )


def _mart(name: str, key: str, table: str, *numbers: str) -> str:
    values = [f"CAST({c} AS DOUBLE)" for c in numbers] + ["CAST(NULL AS DOUBLE)"] * (6 - len(numbers))
    named = ", ".join(f"{v} AS v{k}" for k, v in enumerate(values))
    return f"SELECT '{name}' AS mart, CAST({key} AS VARCHAR) AS key, {named} FROM {table}"


register(
    "trips_incremental_marts",
    _incremental_marts,
    o.sql(
        " UNION ALL ".join(
            [
                _mart("daily", "date_day", "daily", "total_trips", "member_trips", "ebike_trips",
                      "avg_duration_minutes", "total_distance_km", "active_start_stations"),
                _mart("hourly", "day_of_week * 100 + start_hour", "hourly", "total_trips", "member_trips",
                      "avg_duration_minutes", "share_of_total_pct"),
                _mart("behavior", "member_casual", "segments", "total_trips", "median_duration_minutes",
                      "avg_distance_km", "weekend_trips", "morning_peak_trips"),
                _mart("demand", "station_id", "demand", "departure_count", "arrival_count", "net_flow"),
                _mart("mapping", "station_id || '=' || canonical_station_id", "mapping", "total_mentions", "ids_in_group"),
                _mart("dq", "concat_ws('=', _source_file, rejection_reason)", "dq_raw", "row_count", "valid_rows",
                      "rejected_rows", "duplicate_rows"),
                _mart("stations", "concat_ws('=', station_id, station_name)", "stations", "lat", "lng", "trip_mentions"),
            ]
        ),
        "daily", "hourly", "segments", "demand", "mapping", "dq_raw", "stations",
        more_trips=_LATER,
    ),
)

_TRIP_TESTED = (
    "stg_trips", "fct_trips", "stg_trips_rejected", "station_id_mapping", "stations_deduplicated",
    "trips_dq_summary", "dim_station", "dim_date", "trip_summary_daily", "usage_pattern_hourly",
)
register(
    "assertions_incremental",
    lambda spark, sf_dir: _stored(spark, sf_dir).assertions_report(_TRIP_TESTED),
    assertions_sql(_TRIP_TESTED, _LATER),
)

# --- messages and payloads of the status feed: D8, D10, S15, R2, R3, R10 ----------------

_MESSAGE_KINDS = """
CASE WHEN event_id % 7 = 0 THEN concat('{"station_id": "', repeat('x', 60000))
     WHEN event_id % 11 = 0 THEN '{"num_bikes_available": 1, "num_docks_available": 2}'
     WHEN event_id % 13 = 0 THEN concat('{"station_id": "g', user_id, '", "num_bikes_available": -1, "num_docks_available": 2}')
     WHEN event_id % 17 = 0 THEN concat('{"station_id": "g', user_id, '", "num_bikes_available": 1.5, "num_docks_available": 2}')
     WHEN event_id % 19 = 0 THEN concat('{"station_id": "g', user_id, '", "num_bikes_available": 1}')
     WHEN event_id % 23 = 0 THEN concat('{"station_id": "", "num_bikes_available": 1, "num_docks_available": 2}')
     ELSE concat('{"station_id": "g', user_id, '", "num_bikes_available": "', user_id % 30,
                 '", "num_docks_available": 2.0, "snapshot_timestamp": "2024-01-20T10:00:00+09:00"}') END
"""


#: Messages in one file, about: compressed sizes say little about texts, and readers share out bytes.
_MESSAGES_PER_FILE = 20_000


def spread(rows: DataFrame, per_part: int) -> DataFrame:
    """Rows dealt to parts of about ``per_part`` rows, and to as many parts as tasks run at once.

    The number of parts is given, so that adaptive execution does not merge parts of few bytes.
    """
    parts = -(-rows.count() // per_part)
    return rows.repartition(max(parts, rows.sparkSession.sparkContext.defaultParallelism))


def _dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of two topics, three deliveries, one of them twice after a lost checkpoint."""
    root = scratch_path(spark, "letters")
    # dealt before the long texts are made, so that neither writing nor parsing them is one task's work
    events = spread(fx.table(spark, sf_dir, "events").select("event_id", "user_id"), 3 * _MESSAGES_PER_FILE)
    messages = events.select(
        F.expr(_MESSAGE_KINDS).alias("value"),
        F.expr("CASE WHEN event_id % 29 = 0 THEN 'station_status_dlq' ELSE 'station_status' END").alias("kafka_topic"),
        F.lit(0).cast("long").alias("kafka_partition"),
        F.col("event_id").alias("kafka_offset"),
    )
    for part in range(3):
        messages.where(F.col("kafka_offset") % 3 == part).write.mode("append").parquet(f"{root}/messages")
        stream = spark.readStream.schema(messages.schema).parquet(f"{root}/messages")
        write_status_stream(stream, f"{root}/status", f"{root}/dlq", f"{root}/a", _now()).awaitTermination()
        if part == 0:
            write_status_stream(stream, f"{root}/status", f"{root}/dlq", f"{root}/b", _now()).awaitTermination()
    letters = spark.read.schema(STATION_STATUS_DLQ).parquet(f"{root}/dlq")
    rows = spark.read.parquet(f"{root}/status")
    by_reason = letters.groupBy("error_reason").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("raw_payload")).alias("chars"),
        F.sum("kafka_offset").alias("offsets"),
    )
    good = rows.agg(
        F.lit("(rows)").alias("error_reason"), F.count(F.lit(1)).alias("n"),
        F.sum("num_bikes_available").alias("chars"), F.count_if(F.hour("snapshot_timestamp") == 10).alias("offsets"),
    )
    return by_reason.unionByName(good)


_REASON = """
CASE WHEN event_id % 29 = 0 THEN 'producer_dlq' WHEN event_id % 7 = 0 THEN 'invalid_json'
     WHEN event_id % 11 = 0 THEN 'missing_station_id'
     WHEN event_id % 13 = 0 THEN 'invalid_station: num_bikes_available is negative'
     WHEN event_id % 17 = 0 THEN 'invalid_station: num_bikes_available is not an integer'
     WHEN event_id % 19 = 0 THEN 'invalid_station: num_docks_available is required'
     WHEN event_id % 23 = 0 THEN 'invalid_station: station_id is empty' END
"""
register(
    "stream_dead_letters",
    _dead_letters,
    f"WITH e AS (SELECT event_id, user_id, {_MESSAGE_KINDS} AS value, {_REASON} AS reason FROM events) "
    "SELECT reason AS error_reason, count(*) AS n, CAST(sum(length(value)) AS BIGINT) AS chars, "
    "CAST(sum(event_id) AS BIGINT) AS offsets FROM e WHERE reason IS NOT NULL GROUP BY 1 UNION ALL "
    "SELECT '(rows)', count(*), CAST(sum(user_id % 30) AS BIGINT), count(*) FROM e WHERE reason IS NULL",
)


def _payload_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polled payloads as files of a stream, bounded envelopes of a user, to rows and dead letters."""
    root = scratch_path(spark, "payloads")
    events = fx.table(spark, sf_dir, "events")
    station = F.expr(
        "concat('{\"station_id\": \"e', event_id, '\", \"num_bikes_available\": ', "
        "CASE WHEN event_id % 9 = 0 THEN 'null' WHEN event_id % 10 = 0 THEN '-3' ELSE '4' END, "
        "', \"num_docks_available\": 1, \"is_renting\": ', CASE WHEN event_id % 14 = 0 THEN '\"maybe\"' ELSE '1' END, "
        "', \"last_reported\": 1700000000}')"
    )
    parts = events.agg((F.floor(F.count(F.lit(1)) / _PAYLOAD_ROWS) + 1).cast("long")).scalar()
    payload = events.groupBy("user_id", (F.col("event_id") % parts).alias("part")).agg(F.array_join(F.collect_list(station), ",").alias("all"))
    text = F.when(F.col("user_id") % 8 == 0, F.concat(F.lit('{"data": ['), "all", F.lit("]}"))).otherwise(
        F.concat(F.lit('{"last_updated": 1700000600, "ttl": 60, "data": {"stations": ['), "all", F.lit("]}}"))
    )
    payload.select(text.alias("value")).write.text(f"{root}/polled")
    stream = spark.readStream.text(f"{root}/polled")

    def route(batch: DataFrame, batch_id: int) -> None:
        rows, letters = station_feed.status_payloads(batch, _now())
        number = F.lit(batch_id).cast("long")
        lake.write_batches(rows.withColumn("_batch_id", number), f"{root}/status", "_snapshot_date")
        dated = letters.withColumns({"_failed_date": F.to_date("failed_at"), "_batch_id": number})
        lake.write_batches(dated, f"{root}/dlq", "_failed_date")

    for checkpoint in ("a", "b"):  # the second run is the replay of a lost checkpoint
        (
            stream.writeStream.foreachBatch(route).option("checkpointLocation", f"{root}/{checkpoint}")
            .trigger(availableNow=True).start().awaitTermination()
        )
    rows = spark.read.parquet(f"{root}/status").agg(
        F.lit("(rows)").alias("error_reason"), F.count(F.lit(1)).alias("n"),
        F.sum(F.unix_seconds("snapshot_timestamp") - F.unix_seconds("last_reported")).alias("seconds"),
    )
    letters = spark.read.parquet(f"{root}/dlq").groupBy("error_reason").agg(
        F.count(F.lit(1)).alias("n"), F.lit(None).cast("long").alias("seconds")
    )
    return rows.unionByName(letters)


register(
    "payload_routing",
    _payload_routing,
    "WITH e AS (SELECT CASE WHEN event_id % 9 = 0 THEN 'invalid_station: num_bikes_available is required' "
    "WHEN event_id % 10 = 0 THEN 'invalid_station: num_bikes_available is negative' "
    "WHEN event_id % 14 = 0 THEN 'invalid_station: is_renting is not a flag' END AS reason "
    "FROM events WHERE user_id % 8 <> 0) "
    "SELECT coalesce(reason, '(rows)') AS error_reason, count(*) AS n, "
    "CASE WHEN reason IS NULL THEN CAST(600 * count(*) AS BIGINT) END AS seconds FROM e GROUP BY reason UNION ALL "
    "SELECT 'invalid_envelope: 1 masalah', count(*), NULL FROM (SELECT DISTINCT user_id, event_id % "
    f"(SELECT count(*) // {_PAYLOAD_ROWS} + 1 FROM events) FROM events WHERE user_id % 8 = 0) u",
)


def _redelivered(m: Models) -> DataFrame:
    """Appended batches with redeliveries, read as the last delivery of each key."""
    spark = m.raw_status.sparkSession
    root = scratch_path(spark, "redelivered")
    raw = materialize(m.raw_status, "raw_status")
    for half in range(2):
        raw.where(F.crc32("station_id") % 2 >= half).write.mode("append").parquet(f"{root}/landed")
        stream = spark.readStream.schema(raw.schema).parquet(f"{root}/landed")
        append_status_stream(stream, f"{root}/log", f"{root}/checkpoint", P).awaitTermination()
    latest = last_per_key(spark.read.parquet(f"{root}/log").drop("_batch_id", "_reported_date"))
    return latest.select(
        "station_id", "last_reported", "snapshot_timestamp", "_ingested_at", "num_bikes_available",
        "report_age_seconds",
    )


model(
    "stream_redelivery",
    _redelivered,
    o.sql(
        "SELECT station_id, last_reported, snapshot_timestamp, _ingested_at, num_bikes_available, "
        "report_age_seconds FROM stg_station_status",
        "stg_station_status",
    ),
)


def _late(m: Models) -> DataFrame:
    """Rows that a refresh ignores because they are not after the newest archived change."""
    facts = m.stored_fct_station_status
    # the exact median from one row per distinct time
    at = F.unix_micros("snapshot_timestamp")
    times = materialize(facts.groupBy(at.alias("at")).agg(F.count(F.lit(1)).alias("n")), "times")
    upto = F.sum("n").over(Window.orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
    total = times.agg(F.sum("n")).scalar()
    middle = times.withColumn("upto", upto).where(F.col("upto") * 2 >= total).agg(F.min("at")).scalar()
    return intermediate.late_rows(facts, F.timestamp_micros(middle))


model(
    "late_rows",
    _late,
    o.sql(
        "SELECT count(*) AS late_rows FROM fct_station_status WHERE snapshot_timestamp <= "
        "(SELECT quantile_disc(snapshot_timestamp, 0.5) FROM fct_station_status)",
        "fct_station_status",
    ),
)

# --- streams that run for long: R3, R4, R5, D13, D14 ----------------------------------------


def _compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in a hundred micro-batches, some of them again, compacted on the way."""
    root = scratch_path(spark, "batch_log")
    events = fx.table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.to_date("ts").alias("day"), (F.col("event_id") % 100).cast("int").alias("batch")
    )
    events = materialize(events, "numbered_events", "batch")
    log = BatchLog(spark, f"{root}/log", events.drop("batch").schema, fan=4)
    for batch in [*range(100), 99, 64, 3]:
        log.append(events.where(F.col("batch") == batch).drop("batch"), batch)
    folders = len(log.tiers())
    return log.read().groupBy("day").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("users"), F.sum("event_id").alias("events")
    ).withColumn("has_few_folders", F.lit(folders <= 3 * 4))


register(
    "stream_compaction",
    _compaction,
    "SELECT CAST(ts AS DATE) AS day, count(*) AS n, count(DISTINCT user_id) AS users, "
    "CAST(sum(event_id) AS BIGINT) AS events, TRUE AS has_few_folders FROM events GROUP BY 1",
)


def _dlq_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error events as a stream of dead letters: windows written once, late and repeated letters."""
    root = scratch_path(spark, "dlq_stream")
    letters = fx.table(spark, sf_dir, "events").where("event_type = 'error'").select(
        F.col("ts").cast("timestamp").alias("failed_at"), F.lit("t").alias("kafka_topic"),
        F.lit(0).cast("long").alias("kafka_partition"), F.col("event_id").alias("kafka_offset"),
    )
    letters = materialize(letters, "letters")
    cut = letters.agg(F.date_trunc("day", F.timestamp_micros(F.avg(F.unix_micros("failed_at")).cast("long")))).scalar()
    first = letters.where(F.col("failed_at") < cut)
    newest = letters.agg(F.max("failed_at")).scalar()
    late = letters.where(F.col("failed_at") < newest - F.make_dt_interval(days=F.lit(4)))
    late = late.withColumn("kafka_offset", -1 - F.col("kafka_offset"))
    log = ProgressLog(spark, f"{root}/progress")
    spark.streams.addListener(log)
    name = f"letters-{root[-12:]}"
    try:
        for rows in (first, letters.where(F.col("failed_at") >= cut), late):
            rows.write.mode("append").parquet(f"{root}/letters")
            stream = spark.readStream.schema(letters.schema).parquet(f"{root}/letters")
            query = write_dlq_windows(
                stream, f"{root}/windows", f"{root}/checkpoint", Params(dlq_window_minutes=2 * 24 * 60, dlq_alert_rows=5),
                "2 days", "1 day", name,
            )
            query.awaitTermination()
            log.catch_up(query)
    finally:
        spark.streams.removeListener(log)
    windows = spark.read.parquet(f"{root}/windows")
    progress = materialize(progress_table(spark, f"{root}/progress"), "progress")
    # a query of the same batches that stopped an hour ago, though its folder is written to
    stalled = progress.withColumns(
        {"query": F.lit("stalled"), "happened_at": F.col("happened_at") - F.make_dt_interval(hours=F.lit(1))}
    )
    now = Params(as_of=dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
    expected = spark.createDataFrame([(name,), ("stalled",)], "query string")
    seen = check_queries(progress.unionByName(stalled), expected, now)
    verdicts = seen.select(
        F.lit(None).cast("timestamp").alias("window_start"),
        F.when(F.col("query") == "stalled", 0).otherwise(F.col("late_rows")).cast("long").alias("rows_dlq"),
        F.concat(F.when(F.col("query") == "stalled", "stalled: ").otherwise("live: "), F.col("status")).alias("status"),
    )
    return windows.select("window_start", "rows_dlq", "status").unionByName(verdicts)


register(
    "dlq_windows_stream",
    _dlq_stream,
    "WITH l AS (SELECT ts FROM events WHERE event_type = 'error'), m AS (SELECT max(ts) AS newest FROM l), "
    "w AS (SELECT unnest([date_trunc('day', ts), date_trunc('day', ts) - INTERVAL 1 DAY]) AS w FROM l) "
    "SELECT w AS window_start, count(*) AS rows_dlq, CASE WHEN count(*) > 5 THEN 'SURGE' ELSE 'OK' END AS status "
    "FROM w, m WHERE w + INTERVAL 2 DAY <= newest - INTERVAL 2 DAY GROUP BY w UNION ALL "
    "SELECT NULL, (SELECT count(*) FROM l, m WHERE ts < newest - INTERVAL 4 DAY), 'live: OK' UNION ALL "
    "SELECT NULL, 0, 'stalled: STALE'",
)

# --- figures of months from the state of days: A3, A6 ---------------------------------------


def _monthly(m: Models) -> DataFrame:
    """Stations in use and median duration of each month, merged from days."""
    # columns of the fact that staging already has, without the ones behind them in the deduplication
    staged = m.trips_through("start_station_id")
    trips = materialize(staged.select("trip_date", "start_station_id", "duration_seconds"), "slim_trips")
    numbers = materialize(mergeable.extended_numbers(trips, "start_station_id"), "station_numbers")
    numbered = trips.join(numbers, "start_station_id", "left")
    month = F.trunc("trip_date", "month").alias("month")
    days = materialize(mergeable.distinct_state(numbered, ["trip_date"], F.col("number")), "station_days")
    stations = mergeable.merged_distinct(days.select("*", month), ["month"])
    sketches = materialize(mergeable.quantile_state(trips, ["trip_date"], F.col("duration_seconds")), "duration_days")
    medians = mergeable.merged_quantile(sketches.select("*", month), ["month"], 0.5)
    ranks = trips.select(month, "duration_seconds").join(medians, "month").groupBy("month", "n").agg(
        F.count_if(F.col("duration_seconds") < F.col("value")).alias("below"),
        F.count_if(F.col("duration_seconds") <= F.col("value")).alias("upto"),
    )
    slack = 3 * mergeable.rank_error(400) * F.col("n") + 1
    in_bound = (F.col("below") - slack <= F.col("n") / 2) & (F.col("upto") + slack >= F.col("n") / 2)
    ranks = ranks.select("month", F.col("n").alias("trips"), in_bound.alias("median_in_bound"))
    return ranks.join(stations.withColumnRenamed("n", "active_stations"), "month", "left")


model(
    "monthly_from_days",
    _monthly,
    o.sql(
        "SELECT CAST(date_trunc('month', trip_date) AS DATE) AS month, count(*) AS trips, TRUE AS median_in_bound, "
        "nullif(count(DISTINCT start_station_id), 0) AS active_stations FROM fct_trips GROUP BY 1",
        "fct_trips",
    ),
)


# --- archive, replay, retention: S9, S19 -----------------------------------------------------


def _archive_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily payloads archived, replayed twice into a table, and expired by date."""
    root = scratch_path(spark, "archive")
    events = fx.table(spark, sf_dir, "events")
    parts = events.agg((F.floor(F.count(F.lit(1)) / _PAYLOAD_ROWS) + 1).cast("long")).scalar()
    station = F.expr(
        "concat('  {\"station_id\": \"e', event_id, '\", \"num_bikes_available\": 4, "
        "\"num_docks_available\": 1, \"last_reported\": ', unix_seconds(timestamp(ts)), '}')"
    )
    day = F.to_date("ts").alias("day")
    envelopes = events.groupBy(day, (F.col("event_id") % parts).alias("part")).agg(
        F.array_join(F.collect_list(station), ",\n").alias("all")
    )
    payloads = envelopes.select(
        F.concat(F.lit('{"last_updated": '), F.unix_seconds(F.col("day").cast("timestamp")).cast("string"),
                 F.lit(',\n "data": {"stations": [\n'), "all", F.lit("\n ]}}\n")).alias("value")
    )
    payloads = materialize(payloads, "payloads")
    station_feed.archive_payloads(payloads, f"{root}/lake")
    replayed = station_feed.read_archive(spark, f"{root}/lake")
    exact = payloads.exceptAll(replayed).unionByName(replayed.exceptAll(payloads)).isEmpty()
    for _ in range(2):  # a replay replaces its own rows
        rows, letters = station_feed.status_payloads(replayed, _now())
        lake.write_batches(rows.withColumn("_batch_id", F.lit(0).cast("long")), f"{root}/status", "_snapshot_date")
    gone = lake.drop_expired_partitions(spark, f"{root}/status", "_snapshot_date", 14, P)
    return spark.read.parquet(f"{root}/status").groupBy("_snapshot_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.unix_seconds("last_reported")).alias("seconds")
    ).withColumns(
        {"is_exact": F.lit(exact), "dates_gone": F.lit(len(gone)).cast("long"),
         "letters": letters.agg(F.count(F.lit(1))).scalar()}
    )


register(
    "archive_replay",
    _archive_replay,
    "WITH e AS (SELECT CAST(ts AS DATE) AS d, ts FROM events), c AS (SELECT DATE '2024-02-01' - 14 AS cutoff) "
    "SELECT d AS _snapshot_date, count(*) AS n, CAST(sum(floor(epoch(ts))) AS BIGINT) AS seconds, TRUE AS is_exact, "
    "(SELECT count(DISTINCT d) FROM e, c WHERE d < cutoff) AS dates_gone, CAST(0 AS BIGINT) AS letters "
    "FROM e, c WHERE d >= cutoff GROUP BY d",
)
