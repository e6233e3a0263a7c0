"""The scheduled runs end to end on a small warehouse folder."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from velomart.operators.quality import DataTestError, QualityGateError
from velomart.params import Params
from velomart.plans import intermediate, refresh, reports
from velomart.schemas import DQ_METRICS, STATION_STATUS, STATION_STATUS_DLQ, TRIP_CSV_COLUMNS
from velomart.sources import lake, storage
from velomart.streaming.ingest import file_messages, write_status_stream
from velomart.workspace import materialize

NOW = dt.datetime(2026, 1, 8, 12, 0)
P = Params(as_of=NOW, freshness_minutes=60, retention_days={
    "station_status": 2, "station_status_dlq": 2, "dq_metrics": 90})
HEADER = ",".join(TRIP_CSV_COLUMNS)


def line(ride, day, start="1.1", end="2.2", kind="member"):
    return (f"{ride},classic_bike,2026-01-0{day} 08:00:00,2026-01-0{day} 08:10:00,S{start},{start},"
            f"S{end},{end},40.7,-74.0,40.8,-74.1,{kind}")  # fmt: skip


def status(station, bikes, minute, day=7):
    moment = dt.datetime(2026, 1, day, 9) + dt.timedelta(minutes=minute)
    return json.dumps({
        "station_id": station, "num_bikes_available": bikes, "num_docks_available": 10 - bikes,
        "is_installed": 1, "is_renting": 1, "is_returning": 1,
        "last_reported_iso": moment.isoformat(), "snapshot_timestamp": moment.isoformat(),
    })


@pytest.fixture
def wh(spark, tmp_path):
    files = tmp_path / "csv"
    files.mkdir()
    rows = [line(f"r{i}", 5 + i % 2, kind="casual" if i % 3 else "member") for i in range(30)]
    (files / "202601-tripdata_1.csv").write_text("\n".join([HEADER, *rows[:20], rows[0]]))
    (files / "202601-tripdata_2.csv").write_text("\n".join([HEADER, *rows[20:]]))
    info = [{"station_id": f"g{i}", "short_name": f"{i}.{i}", "name": f"I{i}", "capacity": 10}
            for i in (1, 2)]
    (tmp_path / "info.json").write_text(json.dumps({"data": {"stations": info}}))
    return refresh.Warehouse(spark, str(tmp_path / "warehouse"))


def deliver(spark, wh, tmp_path, *messages):
    folder = tmp_path / "messages"
    folder.mkdir(exist_ok=True)
    (folder / f"{len(list(folder.iterdir()))}.txt").write_text("\n".join(messages))
    write_status_stream(
        file_messages(spark, str(folder), 10), wh.path("station_status", "raw"),
        wh.path("station_status_dlq", "raw"), str(tmp_path / "checkpoint"),
        F.lit(NOW).cast("timestamp"),
    ).awaitTermination()


def test_runs(spark, wh, tmp_path):
    days = refresh.ingest_trips(wh, str(tmp_path / "csv"), NOW)
    assert days == [dt.date(2026, 1, 5), dt.date(2026, 1, 6)]
    # one file again: the other file's rows of the same dates stay
    refresh.ingest_trips(wh, str(tmp_path / "csv"), NOW, limit=1)
    assert spark.read.parquet(wh.path("trips", "raw")).count() == 31
    assert refresh.ingest_station_information(wh, str(tmp_path / "info.json"), NOW, P).first().is_ok

    refresh.refresh_batch(wh, P, "run-1")
    refresh.refresh_batch(wh, P, "run-2")
    daily = spark.read.parquet(wh.path("trip_summary_daily")).orderBy("date_day").collect()
    assert [(str(r.date_day), r.total_trips) for r in daily] == [("2026-01-05", 15), ("2026-01-06", 15)]
    metrics = wh.raw("dq_metrics", DQ_METRICS)
    assert metrics.where("layer = 'trips'").count() == 2
    assert reports.quarantine_week(metrics, P).count() == 4

    deliver(spark, wh, tmp_path, status("g1", 0, 0), status("g2", 9, 0))
    refresh.refresh_status(wh, P)
    deliver(spark, wh, tmp_path, status("g1", 4, 30), status("g2", 9, 30), status("g9", 1, 30, day=1))
    for _ in range(2):
        refresh.refresh_status(wh, P)
    archive = spark.read.parquet(wh.path("status_changes"))
    found = sorted((r.gbfs_station_id, r.op, r.bikes_after) for r in archive.collect())
    assert found == [("g1", "c", 0), ("g1", "u", 4), ("g2", "c", 9)]  # g9 came too late
    risks = spark.read.parquet(wh.path("station_risk_monitoring")).collect()
    assert [(r.gbfs_station_id, r.risk_level, r.bikes_to_move) for r in risks] == [("g2", "high", 4)]
    demand = spark.read.parquet(wh.path("station_supply_demand"))
    stations = {r.station_id: r for r in demand.collect()}
    assert stations["2.2"].is_priority_drain and stations["1.1"].net_flow == 30
    assert spark.read.parquet(wh.path("station_volatility")).count() == 2

    assert spark.read.parquet(wh.path("dim_station")).count() > 0
    report = refresh.clean_up(wh, P).where("table_name = 'station_status'").first()
    assert (report.rows_before, report.rows_after) == (5, 4)
    assert spark.read.parquet(wh.path("station_status", "raw")).count() == 4


def stored_files(wh):
    return sorted(r.path for r in storage.listing(wh.spark, wh.root).collect())


def test_a_failed_gate_leaves_every_table_as_it_was(spark, wh, tmp_path):
    refresh.ingest_trips(wh, str(tmp_path / "csv"), NOW)
    refresh.ingest_station_information(wh, str(tmp_path / "info.json"), NOW, P)
    refresh.refresh_batch(wh, P, "run-1")
    bad = [line(f"b{i}", 5, start="Shop Morgan") for i in range(5)]
    for n in range(3, 28):  # more failing files than a short list would show
        (tmp_path / "csv" / f"202601-tripdata_{n}.csv").write_text("\n".join([HEADER, *bad]))
    refresh.ingest_trips(wh, str(tmp_path / "csv"), NOW)
    before = stored_files(wh)
    with pytest.raises(QualityGateError) as raised:
        refresh.refresh_batch(wh, P, "run-2")
    assert str(raised.value).count("=100.0%") == 25
    assert stored_files(wh) == before


def raw_rides(wh):
    return sorted(r.ride_id for r in wh.spark.read.parquet(wh.path("trips", "raw")).collect())


def test_a_corrected_file_leaves_no_stale_rows(wh, tmp_path):
    folder = tmp_path / "csv"
    refresh.ingest_trips(wh, str(folder), NOW)
    one = folder / "202601-tripdata_1.csv"
    one.write_text("\n".join([HEADER, line("n1", 5), line("n2", 7), "lost,,,,,,,,,,,,"]))
    assert [d.day for d in refresh.ingest_trips(wh, str(folder), NOW)] == [5, 6, 7]
    two = [f"r{i}" for i in range(20, 30)]
    assert raw_rides(wh) == sorted(["n1", "n2", *two])
    assert wh.spark.read.parquet(wh.path("trips_unplaceable", "raw")).count() == 1
    one.write_text("\n".join([HEADER, line("n3", 6)]))
    refresh.ingest_trips(wh, str(folder), NOW, pattern="202601-tripdata_1.csv")
    assert raw_rides(wh) == sorted(["n3", *two])
    assert lake.read_or_none(wh.spark, wh.path("trips_unplaceable", "raw")) is None
    days = {r[0].day for r in wh.spark.read.parquet(wh.path("trips", "raw")).select("_ride_started_date").collect()}
    assert days == {5, 6}


def test_a_new_file_touches_its_own_dates_only(spark, wh, tmp_path):
    refresh.ingest_trips(wh, str(tmp_path / "csv"), NOW)
    before = stored_files(wh)
    (tmp_path / "csv" / "202601-tripdata_9.csv").write_text("\n".join([HEADER, line("x", 6)]))
    refresh.ingest_trips(wh, str(tmp_path / "csv"), NOW, pattern="*_9.csv")
    gone = set(before) - set(stored_files(wh))
    assert gone and all("_ride_started_date=2026-01-06" in path for path in gone)
    assert len(raw_rides(wh)) == 32


def test_old_trips_survive_clean_up_and_the_next_ingest(wh, tmp_path):
    """Lake objects expire by their own age, not by the dates of the trips in them."""
    late = Params(as_of=dt.datetime.now() + dt.timedelta(days=1))
    old = tmp_path / "csv" / "200001-tripdata_1.csv"
    old.write_text("\n".join([HEADER, line("old", 5).replace("2026-", "2000-")]))
    for _ in range(2):
        refresh.ingest_trips(wh, str(tmp_path / "csv"), NOW)
        before = stored_files(wh)
        refresh.clean_up(wh, late)
        assert stored_files(wh) == before
    far = Params(as_of=dt.datetime.now() + dt.timedelta(days=200))
    refresh.clean_up(wh, far)
    assert not [path for path in stored_files(wh) if "/lake/raw/trips/" in path]
    refresh.ingest_trips(wh, str(tmp_path / "csv"), NOW, pattern="*_2.csv")
    assert len(raw_rides(wh)) == 32  # rows of expired lake files stay in the table


def run_up(spark, wh, tmp_path):
    refresh.ingest_trips(wh, str(tmp_path / "csv"), NOW)
    refresh.ingest_station_information(wh, str(tmp_path / "info.json"), NOW, P)
    refresh.refresh_batch(wh, P, "run-1")
    deliver(spark, wh, tmp_path, *[status(f"g{s}", s, 60 * h, day=d) for s in (1, 2) for h in (0, 1) for d in (6, 7)])
    refresh.refresh_status(wh, P)


def rows(wh, table):
    return sorted(map(str, wh.spark.read.parquet(wh.path(table)).collect()))


def test_a_status_refresh_rewrites_touched_dates_and_equals_a_full_one(spark, wh, tmp_path):
    run_up(spark, wh, tmp_path)
    before = stored_files(wh)
    # a new row of the 7th, a redelivery of another one with a later poll, and a late row
    again = json.loads(status("g1", 5, 60))
    again["snapshot_timestamp"] = (NOW - dt.timedelta(hours=1)).isoformat()
    deliver(spark, wh, tmp_path, status("g2", 7, 300), json.dumps(again), status("g2", 1, 90, day=7))
    refresh.refresh_status(wh, P)
    gone = [path for path in set(before) - set(stored_files(wh)) if "fct_station_status" in path]
    assert gone and all("snapshot_date=2026-01-07" in path for path in gone)
    log = spark.read.parquet(wh.path("status_refreshes", "raw")).orderBy("batch_mark").collect()
    assert [(r.was_full, r.changed_rows) for r in log] == [(True, 8), (False, 3)]
    found = {name: rows(wh, name) for name in ("stg_station_status", "fct_station_status")}
    refresh.refresh_status(wh, P, full=True)
    assert {name: rows(wh, name) for name in found} == found


def test_late_rows_are_counted(spark, wh, tmp_path):
    run_up(spark, wh, tmp_path)
    deliver(spark, wh, tmp_path, status("g1", 9, -30, day=6))
    refresh.refresh_status(wh, P)
    log = spark.read.parquet(wh.path("status_refreshes", "raw")).orderBy(F.desc("batch_mark"))
    assert log.first().late_rows == 1


def test_the_refresh_reads_new_dates_and_no_archive(spark, wh, tmp_path):
    run_up(spark, wh, tmp_path)
    facts = spark.read.parquet(wh.path("fct_station_status"))
    mark = F.lit(dt.datetime(2026, 1, 7)).cast("timestamp")
    new = intermediate.compared_rows(facts, mark)
    latest = materialize(intermediate.latest_complete_snapshot(facts, P), "latest")
    for frame in (new, intermediate.current_rows(facts, latest)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        scans = [scan.split("], PushedFilters")[0] for scan in plan.split("PartitionFilters: [")[1:]]
        assert any("snapshot_date" in filters for filters in scans)
    storage.delete(spark, [wh.path("status_changes")])  # the seed needs the state table alone
    deliver(spark, wh, tmp_path, status("g1", 9, 600))
    refresh.refresh_status(wh, P)
    assert spark.read.parquet(wh.path("status_changes")).count() == 1


def test_payloads_become_rows_and_dead_letters(spark, wh, tmp_path):
    good = {"station_id": "g1", "num_bikes_available": 3, "num_docks_available": 4, "last_reported": 1_767_700_000}
    stations = [good, {**good, "station_id": "g2", "num_bikes_available": -1}]
    (tmp_path / "p1.json").write_text(json.dumps({"last_updated": 1_767_700_060, "ttl": 5, "data": {"stations": stations}}))
    long_text = "x" * 60_000
    (tmp_path / "p2.json").write_text(json.dumps({"data": {"nothing": long_text}}))
    for _ in range(2):  # a repeated call replaces its own rows
        assert refresh.ingest_status_payloads(wh, str(tmp_path / "p*.json"), NOW) == (1, 2)
    letters = wh.raw("station_status_dlq", STATION_STATUS_DLQ).collect()
    assert sorted(r.error_reason for r in letters) == [
        "invalid_envelope: 1 masalah", "invalid_station: num_bikes_available is negative",
    ]
    assert max(len(r.raw_payload) for r in letters) > 60_000  # whole, so that it can be replayed
    assert wh.raw("station_status", STATION_STATUS).count() == 1


def test_watchdog(spark, wh, tmp_path):
    deliver(spark, wh, tmp_path, status("g1", 1, 170, day=8), "{bad")
    found = {r.check_name: r.status for r in refresh.watchdog(wh, P).collect()}
    assert found == {"freshness": "OK", "consumer_liveness": "OK", "dlq_growth": "OK", "staging_rejection": "OK"}
    tomorrow = Params(as_of=dt.datetime.now() + dt.timedelta(days=1))
    found = {r.check_name: r.status for r in refresh.watchdog(wh, tomorrow).collect()}
    assert found["freshness"] == found["consumer_liveness"] == "STALE"
    runs = spark.read.parquet(wh.path("watchdog_runs", "raw")).collect()
    assert sorted(r.issues for r in runs) == [0, 2]


def test_a_failed_data_test_stops_the_metrics(spark, wh, tmp_path):
    twice = [line("s1", 5), line("s2", 5, kind="someone")]
    (tmp_path / "csv" / "202601-tripdata_4.csv").write_text("\n".join([HEADER, *twice]))
    refresh.ingest_trips(wh, str(tmp_path / "csv"), NOW)
    refresh.ingest_station_information(wh, str(tmp_path / "info.json"), NOW, P)
    with pytest.raises(DataTestError, match="member_casual"):
        refresh.refresh_batch(wh, P, "run-1")
    assert lake.read_or_none(spark, wh.path("dq_metrics", "raw")) is None


def spoil(path):
    """Overwrite the rows of a Parquet file; its footer, which a schema may be taken from, stays."""
    path = path.removeprefix("file:")
    folder, name = os.path.split(path)
    if os.path.exists(f"{folder}/.{name}.crc"):
        os.remove(f"{folder}/.{name}.crc")
    with open(path, "r+b") as file:
        content = file.read()
        end = len(content) - 8 - int.from_bytes(content[-8:-4], "little")
        file.seek(4)
        file.write(b"\xff" * (end - 4))


def test_a_status_refresh_opens_the_dates_it_touches(spark, wh, tmp_path):
    """Thirty dates, one new batch: files of all other dates could as well be unreadable."""
    p = Params(as_of=dt.datetime(2026, 1, 31, 12), freshness_minutes=10**6)
    refresh.ingest_trips(wh, str(tmp_path / "csv"), NOW)
    refresh.ingest_station_information(wh, str(tmp_path / "info.json"), NOW, p)
    refresh.refresh_batch(wh, p, "run-1")
    deliver(spark, wh, tmp_path, *[status(f"g{s}", (s + d) % 9, 60, day=d) for s in (1, 2) for d in range(1, 31)])
    refresh.refresh_status(wh, p)
    ahead = json.loads(status("g1", 4, 180, day=30)) | {"snapshot_timestamp": "2026-01-30T10:00:00"}  # is rejected
    deliver(spark, wh, tmp_path, status("g1", 8, 120, day=30), status("g2", 3, 120, day=30), json.dumps(ahead))
    for table in ("fct_station_status", "stg_station_status", "status_changes"):
        for path in [r.path for r in storage.listing(spark, wh.path(table)).collect()]:
            if "=2026-01-30" not in path:
                spoil(path)
    refresh.refresh_status(wh, p)
    log = spark.read.parquet(wh.path("status_refreshes", "raw")).orderBy("batch_mark").collect()
    assert [(r.was_full, r.changed_rows) for r in log] == [(True, 60), (False, 2)]
    volatility = rows(wh, "station_volatility")
    found = {name: rows(wh, name) for name in ("station_risk_monitoring", "station_availability_realtime", "station_supply_demand")}
    counts = refresh.status.counts(refresh.status_store(wh), refresh.status_store(wh).snapshot()).first()
    assert (counts.raw_rows, counts.valid_rows, counts.rejected_rows) == (63, 62, 1)
    for table in ("fct_station_status", "stg_station_status", "status_changes", "station_state"):
        storage.delete(spark, [wh.path(table)])
    models = refresh.refresh_status(wh, p, full=True)
    assert rows(wh, "station_volatility") == volatility
    assert {name: rows(wh, name) for name in found} == found
    kept = [name for _, names in refresh.status.TESTED.values() for name in names]
    parents = {"dim_station": models.dim_station, "dim_date": models.dim_date}
    store = refresh.status_store(wh)
    partial = refresh.status.assertions_report(store, store.snapshot(), parents, p, kept)
    assert sorted(map(tuple, partial.collect())) == sorted(map(tuple, models.assertions_report(kept).collect()))
