"""Files in, tables out: CSV, station feeds, partition loads, retention."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

import workload_runs
from velomart.operators.quality import QualityGateError
from velomart.params import Params
from velomart.plans import profiling
from velomart.schemas import TRIP_CSV_COLUMNS
from velomart.sources import lake, station_feed, storage, trip_files

NOW = dt.datetime(2026, 3, 31, 12, 0)
P = Params(as_of=NOW)
HEADER = ",".join(TRIP_CSV_COLUMNS)
GOOD = 'r1,classic_bike,2026-01-05 08:00:00.123,2026-01-05 08:10:00,"Main, St",5000.01,B,JC1,40.7,-74.0,40.8,-74.1,member'
BROKEN = "r2,NA,not a time,2026-01-06 08:10:00,null,5000.01,B,JC1,40.7x,1.5d,,-74.1,casual"
NEXT = "r3,classic_bike,2026-01-06 00:00:00,2026-01-06 00:10:00,A,1.1,B,2.2,40.7,-74.0,40.8,-74.1,member"


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "202601-tripdata_1.csv").write_text("\n".join([HEADER, GOOD, BROKEN]))
    (tmp_path / "202601-tripdata_2.csv").write_text("\n".join([HEADER, NEXT]))
    (tmp_path / "notes.txt").write_text("x")
    return str(tmp_path)


def test_csv_files(spark, folder):
    files = trip_files.discover_files(spark, folder)
    assert [f.rsplit("_", 1)[1] for f in files] == ["1.csv", "2.csv"]
    assert len(trip_files.discover_files(spark, folder, limit=1)) == 1
    with pytest.raises(FileNotFoundError):
        trip_files.discover_files(spark, folder, "20*.json")
    text = trip_files.read_trip_text(spark, files)
    kept, lost = trip_files.split_unplaceable(trip_files.typed_trips(text, NOW))
    found = {r.ride_id: r for r in kept.collect()}
    assert set(found) == {"r1", "r3"}
    assert found["r1"].started_at == dt.datetime(2026, 1, 5, 8, 0, 0, 123_000)
    assert found["r1"].start_station_name == "Main, St"
    assert found["r1"]._source_file == "202601-tripdata_1.csv"
    assert found["r3"]._ride_started_date == dt.date(2026, 1, 6)
    bad = lost.first()
    assert (bad.ride_id, bad.rejection_reason) == ("r2", "missing_started_at")
    assert (bad.rideable_type, bad.start_station_name) == (None, None)
    assert (bad.start_lat, bad.start_lng, bad.end_lat) == (None, None, None)
    casts = {"started_at": "timestamp_ntz", "start_lat": "double", "end_lat": "double"}
    profile = {r.column_name: r for r in profiling.cast_failures(text, casts).collect()}
    assert (profile["started_at"].cast_failures, profile["started_at"].blank_values) == (1, 0)
    assert (profile["end_lat"].cast_failures, profile["end_lat"].blank_values) == (0, 1)


def test_other_columns_fail_instead_of_shifting(spark, tmp_path):
    swapped = ",".join(["rideable_type", "ride_id", *TRIP_CSV_COLUMNS[2:]])
    (tmp_path / "x.csv").write_text("\n".join([swapped, GOOD]))
    with pytest.raises(Exception, match="(?i)header"):
        trip_files.read_trip_text(spark, str(tmp_path)).collect()


def test_header_consistency(spark, folder, tmp_path):
    (tmp_path / "202602-tripdata_1.csv").write_text(f'"{HEADER},"extra"\n' + GOOD)
    lines = spark.read.option("pathGlobFilter", "*.csv").text(folder)
    lines = lines.select("value", F.col("_metadata.file_name").alias("_source_file"))
    found = {r._source_file: r for r in profiling.header_consistency(lines).collect()}
    assert len(found) == 3
    assert found["202602-tripdata_1.csv"].extra_columns == "extra"
    assert found["202601-tripdata_1.csv"].n_cols == 13


def test_lake_load_reconcile_and_retention(spark, folder, tmp_path):
    text = trip_files.read_trip_text(spark, trip_files.discover_files(spark, folder))
    trips, _ = trip_files.split_unplaceable(trip_files.typed_trips(text, NOW))
    raw, table = str(tmp_path / "lake"), str(tmp_path / "table")
    lake.write_daily_lake(trips, raw)
    days = storage.partition_dates(spark, raw)
    assert days == [dt.date(2026, 1, 5), dt.date(2026, 1, 6)]
    stored = spark.read.parquet(raw)
    for _ in range(2):
        lake.load_trips(stored, table)
    assert spark.read.parquet(table).count() == 2
    same = lake.reconcile(stored, spark.read.parquet(table), "dt", "_ride_started_date")
    lake.enforce_reconciled(same)
    lake.load_trips(stored.where("ride_id = 'r1'").unionAll(stored.where("ride_id = 'r1'")), table)
    differs = lake.reconcile(stored, spark.read.parquet(table), "dt", "_ride_started_date")
    assert [tuple(r) for r in differs.collect()] == [(dt.date(2026, 1, 5), 1, 2)]
    with pytest.raises(ValueError, match="2026-01-05: 1 <> 2"):
        lake.enforce_reconciled(differs)
    later = Params(as_of=dt.datetime(2026, 1, 16))
    report = lake.retention_report(stored, "trips", "dt", 10, later).first()
    assert (report.rows_before, report.rows_after) == (2, 1)
    assert lake.drop_expired_partitions(spark, raw, "dt", 10, later) == [dt.date(2026, 1, 5)]
    assert storage.partition_dates(spark, raw) == [dt.date(2026, 1, 6)]
    assert lake.newest_write(spark, raw).first().newest is not None


@pytest.mark.parametrize("large", [1, lake.LARGE_FILE])
def test_large_files_of_a_date_are_loaded_where_they_lie(spark, tmp_path, monkeypatch, large):
    monkeypatch.setattr(lake, "LARGE_FILE", large)
    day, path = dt.date(2026, 1, 5), {n: str(tmp_path / n) for n in ("lake", "table")}

    def trips(name, *rides):
        rows = [(ride, f"{k}.1", "2.1", name, day) for k, ride in enumerate(rides)]
        return spark.createDataFrame(rows, "ride_id string, start_station_id string, end_station_id string, _source_file string, _ride_started_date date")

    def loaded(rows, *files):
        days = lake.write_daily_lake(rows, path["lake"], files)
        lake.load_files(spark.read.parquet(path["lake"]), path["table"], files, days)
        table = spark.read.parquet(path["table"])
        assert {r._ride_started_date for r in table.collect()} == {day}
        return sorted((r._source_file, r.ride_id) for r in table.collect()), len(table.inputFiles())

    first = loaded(trips("a.csv", "1", "2").unionByName(trips("b.csv", "3")), "a.csv", "b.csv")
    assert first == ([("a.csv", "1"), ("a.csv", "2"), ("b.csv", "3")], 2 if large == 1 else 1)
    again = loaded(trips("b.csv", "4", "4"), "b.csv")
    assert again == ([("a.csv", "1"), ("a.csv", "2"), ("b.csv", "4"), ("b.csv", "4")], 2 if large == 1 else 1)
    # rows that come from no file are gathered as before
    lake.load_files(spark.createDataFrame([("9", "1.1", "2.1", "b.csv", day, day)], "ride_id string, start_station_id string, end_station_id string, _source_file string, _ride_started_date date, dt date"), path["table"], ["b.csv"], [day])
    assert sorted(r.ride_id for r in spark.read.parquet(path["table"]).collect()) == ["1", "2", "9"]


def payload(stations, **envelope):
    body = {"last_updated": 1_767_600_000, "ttl": 60, "data": {"stations": stations}}
    return json.dumps({**body, **envelope})


STATION = {
    "station_id": 7, "num_bikes_available": 3, "num_docks_available": "4", "is_renting": 1,
    "is_returning": True, "is_installed": 0, "last_reported": 1_767_599_990, "unknown": {"a": 1},
}


def test_status_payload(spark, tmp_path):
    bad = [{**STATION, "num_bikes_available": 1.5}, {**STATION, "num_docks_available": -1},
           {k: v for k, v in STATION.items() if k != "station_id"}]
    texts = [payload([STATION, *bad]), payload("x"), payload([1, STATION], ttl="soon"), "{broken"]
    for i, text in enumerate(texts):
        (tmp_path / f"{i}.json").write_text(text)
    envelopes = station_feed.parse_envelope(station_feed.read_payloads(spark, str(tmp_path)))
    now = F.lit(NOW).cast("timestamp")
    letters = station_feed.envelope_dead_letters(envelopes, now).collect()
    assert sorted(r.error_reason for r in letters) == [
        "invalid_envelope: 1 masalah", "invalid_envelope: 1 masalah", "invalid_envelope: 2 masalah",
    ]
    rows, rejected = station_feed.status_from_payload(station_feed.stations_of(envelopes), now, now)
    row = rows.collect()
    assert len(row) == 1
    assert (row[0].station_id, row[0].num_docks_available, row[0].is_installed) == ("7", 4, False)
    assert row[0].is_disabled is None
    assert row[0].last_reported == dt.datetime.fromtimestamp(1_767_599_990, dt.UTC).replace(tzinfo=None)
    assert sorted(r.error_reason for r in rejected.collect()) == [
        "invalid_station: num_bikes_available is not an integer",
        "invalid_station: num_docks_available is negative",
        "invalid_station: station_id is empty",
    ]


def test_messages(spark):
    good = {**STATION, "num_bikes_available": "12", "snapshot_timestamp": "2026-01-05T08:00:00+07:00",
            "last_reported_iso": "2026-01-05T07:59:00"}
    values = [json.dumps(good), "{bad", "[1]", '{"a": 1}', json.dumps({**good, "num_bikes_available": 1.5}),
              json.dumps({**good, "num_bikes_available": -1}), json.dumps({**good, "snapshot_timestamp": "?"})]
    messages = spark.createDataFrame(
        [(v, "s", 0, i) for i, v in enumerate(values)] + [("{}", "station_status_dlq", 0, 9)],
        "value string, kafka_topic string, kafka_partition long, kafka_offset long",
    )
    decoded = station_feed.decode_messages(messages, F.lit(NOW).cast("timestamp"))
    rows = sorted(station_feed.status_rows(decoded).collect(), key=lambda r: r.snapshot_timestamp)
    assert [r.num_bikes_available for r in rows] == [12, 12]
    assert [r.snapshot_timestamp for r in rows] == [dt.datetime(2026, 1, 5, 8), NOW]
    letters = {r.kafka_offset: r.error_reason for r in station_feed.dead_letters(decoded).collect()}
    assert letters == {
        1: "invalid_json", 2: "missing_station_id", 3: "missing_station_id",
        4: "invalid_station: num_bikes_available is not an integer",
        5: "invalid_station: num_bikes_available is negative", 9: "producer_dlq",
    }


def test_a_text_that_is_no_json_is_not_read_for_fields(spark):
    cut_off = '{"station_id": "a", "num_bikes_available": 1, "num_docks_available": 2'
    messages = spark.createDataFrame([(cut_off,), (cut_off + "}",), (None,)], "value string")
    decoded = station_feed.decode_messages(messages, F.lit(NOW).cast("timestamp"))
    found = [(r.station_id, r.num_bikes_available, r.error_reason) for r in decoded.collect()]
    assert found == [(None, None, "invalid_json"), ("a", 1, None), (None, None, "invalid_json")]


def test_messages_are_dealt_to_all_tasks(spark):
    rows = spark.range(0, 1000, 1, 1).select(F.col("id").alias("event_id"))
    for per_part, parts in ((20, 50), (10_000, spark.sparkContext.defaultParallelism)):
        dealt = workload_runs.spread(rows, per_part)
        sizes = [r.n for r in dealt.groupBy(F.spark_partition_id().alias("part")).agg(F.count("*").alias("n")).collect()]
        assert sum(sizes) == 1000 and len(sizes) == parts
        assert max(sizes) <= 1000 / parts * 1.5


def test_station_information(spark, tmp_path):
    info = {"station_id": "g-1", "name": "A", "short_name": "1.1", "lat": 40.7, "lon": -74.0,
            "capacity": 10, "region_id": 71, "rental_methods": ["KEY", "CARD"],
            "eightd_has_key_dispenser": False}
    texts = [json.dumps(info), json.dumps({**info, "capacity": "many"})]
    stations = spark.createDataFrame([(t,) for t in texts], "value string")
    rows, rejected = station_feed.parse_information(stations, NOW)
    assert [r.error for r in rejected.collect()] == ["capacity is not an integer"]
    with pytest.raises(QualityGateError):
        station_feed.enforce_payload_quality(rows, rejected, P)
    station_feed.enforce_payload_quality(rows, rejected.where("false"), P)
    lake.write_json_lines(rows, str(tmp_path / "ndjson"))
    again = station_feed.read_information(spark, str(tmp_path / "ndjson"))
    assert again.first().rental_methods == ["KEY", "CARD"] and again.first().region_id == "71"
    table = str(tmp_path / "table")
    lake.replace_table(again, table)
    with pytest.raises(lake.EmptyReplaceError):
        lake.replace_table(again.where("false"), table)
    stored = spark.read.parquet(table)
    assert station_feed.verify_information(stored, 1).first().is_ok
    assert not station_feed.verify_information(stored, 2).first().is_ok


def test_no_filter_parses_a_payload_again(spark, tmp_path):
    good = '{"last_updated": 1, "data": {"stations": [{"station_id": "a", "num_bikes_available": 1, "num_docks_available": 2}]}}'
    spark.createDataFrame([(good,), ("{",)], "value string").write.text(str(tmp_path / "in"))
    rows, letters = station_feed.status_payloads(spark.read.text(str(tmp_path / "in")), F.lit(NOW).cast("timestamp"))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    # once for the envelope, once for the station
    assert plan.count("from_json(") == 2
    assert not [line for line in plan.splitlines() if "Filter" in line and "from_json(" in line]
    assert [r.station_id for r in rows.collect()] == ["a"]
    assert [r.error_reason for r in letters.collect()] == ["invalid_envelope: 1 masalah"]


def _written(spark, act):
    """Rows that the data-writing jobs of ``act`` put into the shared folder besides their table."""
    from velomart import workspace

    root = workspace.application_dir(spark)
    before = set(storage.child_names(spark, root))
    act()
    return sorted(n.rsplit("-", 1)[0] for n in set(storage.child_names(spark, root)) - before)


def test_dates_are_rewritten_from_themselves_in_one_write(spark, tmp_path):
    path, a, b = str(tmp_path / "t"), dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    rows = spark.createDataFrame([(1, "x", a), (2, "y", a), (3, "x", b)], "k long, f string, day date")
    lake.write_partitions(rows, path, "day")
    kept = spark.read.parquet(path).where("f <> 'x'").select("k", "f", "day")
    assert _written(spark, lambda: lake.rewrite_dates(kept, path, "day", [a, b])) == []
    assert [tuple(r) for r in spark.read.parquet(path).select("k", "f", "day").collect()] == [(2, "y", a)]
    more = spark.createDataFrame([(2, "z", a), (4, "z", b)], "k long, f string, day date")
    assert _written(spark, lambda: lake.merge_into(more, path, ["k"], ["f"], "day")) == ["incoming"]
    found = sorted(tuple(r) for r in spark.read.parquet(path).select("k", "f", "day").collect())
    assert found == [(2, "z", a), (4, "z", b)]
    none = spark.read.parquet(path).where("k < 0").select("k", "f", "day")
    lake.rewrite_dates(none, path, "day", [a])
    assert [r.k for r in spark.read.parquet(path).collect()] == [4]


def test_lake_files_are_in_the_order_of_loads(spark, tmp_path):
    rows = [(f"r{i}", f"{i * 7 % 10}.1", f"{i % 3}.1", f"{i % 2}.csv", dt.date(2026, 1, 5)) for i in range(60)]
    names = ["ride_id", "start_station_id", "end_station_id", "_source_file", "_ride_started_date"]
    lake.write_daily_lake(spark.createDataFrame(rows, names), str(tmp_path / "lake"))
    stored = spark.read.parquet(str(tmp_path / "lake"))
    found = stored.select("_metadata.file_path", "_metadata.row_index", "start_station_id", "end_station_id").collect()
    assert len(found) == 60
    for path in {r.file_path for r in found}:
        one = sorted((r for r in found if r.file_path == path), key=lambda r: r.row_index)
        stations = [(r.start_station_id, r.end_station_id) for r in one]
        assert stations == sorted(stations)
