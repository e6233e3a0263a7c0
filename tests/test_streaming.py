"""Stream jobs: replay, redelivery, restart, equality with the batch twin."""

import datetime as dt
import json
import os
import time

from pyspark.sql import functions as F
from test_changes import ROWS, T0, facts

from velomart.params import Params
from velomart.plans import intermediate, reports
from velomart.schemas import STATION_STATUS
from velomart.sources import storage
from velomart.streaming.batch_log import BatchLog
from velomart.streaming.changes import apply_batch, detect_changes, stored_changes
from velomart.streaming.ingest import (
    append_status_stream,
    compact_status,
    dlq_windows,
    file_messages,
    write_dlq_windows,
    write_status_stream,
)
from velomart.streaming.progress import ProgressLog, check_queries, progress_table
from velomart.workspace import materialize

NOW = dt.datetime(2026, 1, 6)
P = Params()


def message(bikes, minute, reported=0):
    moment = T0 + dt.timedelta(minutes=minute)
    return json.dumps({
        "station_id": "g-1", "num_bikes_available": bikes, "num_docks_available": 1,
        "last_reported_iso": (T0 + dt.timedelta(minutes=reported)).isoformat(),
        "snapshot_timestamp": moment.isoformat(),
    })


def test_ingest_twice_adds_nothing_and_a_new_file_is_added(spark, tmp_path):
    source = tmp_path / "messages"
    source.mkdir()
    (source / "1.txt").write_text("\n".join([message(1, 0), message(2, 5), "{bad"]))
    status, dlq = str(tmp_path / "status"), str(tmp_path / "dlq")
    now = F.lit(NOW).cast("timestamp")

    def ingest(checkpoint):
        write_status_stream(
            file_messages(spark, str(source), 10), status, dlq, str(tmp_path / checkpoint), now
        ).awaitTermination()

    ingest("a")
    ingest("a")
    assert spark.read.parquet(status).count() == 2
    ingest("b")  # a lost checkpoint replays batch 0 over its own folders
    assert spark.read.parquet(status).count() == 2
    assert [r.error_reason for r in spark.read.parquet(dlq).collect()] == ["invalid_json"]
    (source / "2.txt").write_text(message(3, 20))
    ingest("a")
    stored = spark.read.parquet(status)
    assert stored.count() == 3
    days = {str(r[0]) for r in stored.select("_snapshot_date").distinct().collect()}
    assert days == {"2026-01-05", "2026-01-06"}


def test_redelivery_keeps_the_last_copy(spark, tmp_path):
    landed, log, latest = (str(tmp_path / name) for name in ("landed", "log", "latest"))
    mark = -1

    def deliver(bikes, minute):
        moment = T0 + dt.timedelta(minutes=minute)
        row = spark.createDataFrame([("g-1", bikes, 1, T0, moment)],
                                    "station_id string, num_bikes_available long, num_docks_available long, "
                                    "last_reported timestamp_ntz, snapshot_timestamp timestamp_ntz")  # fmt: skip
        from velomart.schemas import conform

        row = row.withColumns({"_ingested_at": F.col("snapshot_timestamp"),
                               "_snapshot_date": F.to_date("snapshot_timestamp")})
        conform(row, STATION_STATUS).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(STATION_STATUS).parquet(landed)
        append_status_stream(stream, log, str(tmp_path / "c"), P).awaitTermination()
        nonlocal mark
        mark = compact_status(spark, log, latest, P, mark)
        assert compact_status(spark, log, latest, P, mark) == mark
        return [r.num_bikes_available for r in spark.read.parquet(latest).collect()]

    assert deliver(1, 5) == [1]
    assert deliver(2, 30) == [2]  # after midnight, same report
    assert deliver(3, 1) == [2]  # an older copy arrives late
    assert spark.read.parquet(log).count() == 3  # batches append, they rewrite nothing


def test_stateful_changes_equal_the_batch_and_survive_a_restart(spark, tmp_path):
    source, root = str(tmp_path / "facts"), str(tmp_path / "out")
    table = facts(spark, ROWS)

    def run(rows, checkpoint="c"):
        if rows is not None:
            rows.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(table.schema).parquet(source)
        detect_changes(stream, root, str(tmp_path / checkpoint)).awaitTermination()

    middle = F.lit(T0 + dt.timedelta(minutes=14)).cast("timestamp")
    run(table.where(F.col("snapshot_timestamp") <= middle))
    run(None, "lost")  # the first batch again: same state, same folders
    run(table.where(F.col("snapshot_timestamp") > middle))
    run(table.where(F.col("snapshot_timestamp") <= middle))  # late: ignored

    batch = intermediate.status_changes(table)
    assert sorted(map(str, stored_changes(spark, root).collect())) == sorted(map(str, batch.collect()))


def test_a_poll_of_many_stations_is_one_join(spark, tmp_path):
    root = str(tmp_path / "out")
    first = materialize(facts(spark, [(f"g{k}", 0, k % 9, 1, True) for k in range(24_500)]), "poll")
    later = F.col("snapshot_timestamp") + F.expr("INTERVAL 2 MINUTES")
    apply_batch(first, 0, root)
    start = time.perf_counter()
    apply_batch(first.withColumn("snapshot_timestamp", later), 1, root)
    assert time.perf_counter() - start < 20
    assert stored_changes(spark, root).count() == 24_500


def test_time_buckets_and_dlq_windows_run_on_streams(spark, tmp_path):
    source = str(tmp_path / "facts")
    table = facts(spark, ROWS).select(
        "snapshot_timestamp", "num_bikes_available", "num_docks_available"
    )
    table.write.parquet(source)
    stream = spark.readStream.schema(table.schema).parquet(source)
    watermarked = stream.withWatermark("snapshot_timestamp", "1 day")
    query = (
        reports.snapshot_buckets(watermarked, "10 minutes")
        .writeStream.format("memory").queryName("buckets").outputMode("complete")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    batch = reports.snapshot_buckets(table, "10 minutes")
    assert sorted(map(str, spark.table("buckets").collect())) == sorted(map(str, batch.collect()))
    dlq = table.select(F.col("snapshot_timestamp").alias("failed_at"))
    windows = dlq_windows(dlq, Params(dlq_alert_rows=3)).where("status = 'SURGE'")
    assert windows.count() > 0


def numbers(spark, *values):
    return spark.createDataFrame([(v, dt.date(2026, 1, 1 + v % 2)) for v in values], "v long, day date")


def test_batches_are_compacted_in_tiers(spark, tmp_path):
    root = str(tmp_path / "log")
    log = BatchLog(spark, root, numbers(spark, 1).schema, "day", fan=3)
    assert log.read().collect() == []
    for batch in range(30):
        log.append(numbers(spark, batch, 100 + batch), batch)
        tiers = log.tiers()
        assert [t.first for t in tiers[1:]] == [t.last + 1 for t in tiers[:-1]]
        assert all(sum(t.level == level for t in tiers) < 3 for level in range(5))
    wanted = sorted([*range(30), *range(100, 130)])
    assert sorted(r.v for r in log.read().collect()) == wanted
    assert len(log.tiers()) <= 2 * 4  # 30 batches: two folders on each of four levels at most
    assert len(storage.listing(spark, root).select("folder").distinct().collect()) <= 3 * 2 * 8
    for batch in (0, 13, 29):  # replays, of merged batches and of a folder of its own
        log.append(numbers(spark, batch, 100 + batch), batch)
    assert sorted(r.v for r in log.read().collect()) == wanted


def test_a_reader_of_a_log_survives_the_next_merge_and_a_half_written_batch(spark, tmp_path):
    root = str(tmp_path / "log")
    latest = lambda rows: rows.groupBy("day").agg(F.max("v").alias("v"))
    log = BatchLog(spark, root, numbers(spark, 1).schema, fan=2, merge=latest)
    for batch in range(5):
        log.append(numbers(spark, batch * 2, batch * 2 + 1), batch)
    before = log.read()
    log.append(numbers(spark, 10, 11), 5)
    assert sorted(r.v for r in latest(before).collect()) == [8, 9]
    assert sorted(r.v for r in latest(log.read()).collect()) == [10, 11]
    numbers(spark, 99).write.parquet(f"{root}/level-0/{6:012d}-{6:012d}")
    os.remove(f"{root}/level-0/{6:012d}-{6:012d}/_SUCCESS")
    assert 99 not in {r.v for r in log.read().collect()}


def test_a_log_forgets_merged_batches(spark, tmp_path):
    log, latest = str(tmp_path / "log"), str(tmp_path / "latest")
    rows = "'g-1' AS station_id, {v}L AS num_bikes_available, timestamp'2026-01-05' AS last_reported, timestamp'2026-01-05 0{v}:00' AS snapshot_timestamp, timestamp'2026-01-05 0{v}:00' AS _ingested_at, date'2026-01-05' AS _reported_date, {v}L AS _batch_id"
    for v in range(4):
        spark.sql("SELECT " + rows.format(v=v)).write.mode("append").partitionBy("_reported_date", "_batch_id").parquet(log)
        compact_status(spark, log, latest, P, v - 1, keep_batches=2)
    assert sorted(r._batch_id for r in spark.read.parquet(log).select("_batch_id").collect()) == [2, 3]
    assert [r.num_bikes_available for r in spark.read.parquet(latest).collect()] == [3]


def test_windows_are_appended_once_late_rows_counted_and_state_shrinks(spark, tmp_path):
    source, out, notes = (str(tmp_path / n) for n in ("letters", "out", "progress"))
    log = ProgressLog(spark, notes, every=2)
    spark.streams.addListener(log)

    def deliver(*minutes):
        rows = spark.createDataFrame([(m,) for m in minutes], "m long")
        rows = rows.selectExpr("timestamp_seconds(1767600000 + m * 60) AS failed_at", "'t' AS kafka_topic", "0L AS kafka_partition", "m AS kafka_offset")
        rows.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.schema).parquet(source)
        query = write_dlq_windows(stream, out, str(tmp_path / "c"), Params(dlq_alert_rows=3), "10 minutes", "30 minutes", "letters")
        query.awaitTermination()
        log.catch_up(query)
        return query.recentProgress

    try:
        deliver(*range(0, 120), *range(115, 120))  # some twice
        progress = deliver(*range(300, 303))  # the watermark passes all earlier windows
        assert sum(s.numRowsTotal for s in progress[-1].stateOperators) == 1 + 3
        deliver(1, 2, 3, 4, 5)  # long written
    finally:
        spark.streams.removeListener(log)
    windows = spark.read.parquet(out).orderBy("window_start").collect()
    assert [(r.rows_dlq, r.status) for r in windows] == [(30, "SURGE")] * 4
    seen = check_queries(progress_table(spark, notes), spark.createDataFrame([("letters",), ("gone",)], "query string"), Params(as_of=dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)))
    found = {r["query"]: r for r in seen.collect()}
    assert (found["letters"].status, found["letters"].input_rows, found["letters"].late_rows) == ("OK", 133, 5)
    assert found["gone"].status == "EMPTY"
    later = Params(as_of=dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) + dt.timedelta(hours=1))
    stale = check_queries(progress_table(spark, notes), spark.createDataFrame([("letters",)], "query string"), later).first()
    assert stale.status == "STALE" and 59 < stale.minutes < 62
