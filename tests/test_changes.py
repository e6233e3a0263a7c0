"""Change archive: comparison, refresh, validity windows, volatility, completeness."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from velomart.params import Params
from velomart.plans import intermediate, marts, reports
from velomart.sources import lake
from velomart.workspace import materialize, scratch_path

P = Params()
T0 = dt.datetime(2026, 1, 5, 23, 50)
SCHEMA = (
    "gbfs_station_id string, minute int, num_bikes_available long, num_docks_available long, "
    "is_renting boolean"
)


def facts(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    moment = F.lit(T0).cast("timestamp") + F.make_dt_interval(mins=F.col("minute"))
    none_long, none_text = F.lit(None).cast("long"), F.lit(None).cast("string")
    return df.select(
        "gbfs_station_id",
        moment.alias("snapshot_timestamp"),
        F.to_date(moment).alias("snapshot_date"),
        "num_bikes_available",
        "num_docks_available",
        none_long.alias("num_ebikes_available"),
        none_long.alias("num_scooters_available"),
        F.lit(True).alias("is_installed"),
        "is_renting",
        F.lit(True).alias("is_returning"),
        F.lit(None).cast("boolean").alias("is_disabled"),
        none_text.alias("station_key"),
        none_text.alias("legacy_station_id"),
        none_text.alias("station_name"),
        F.lit("empty").alias("risk_level"),
        F.lit(True).alias("is_operational"),
        F.lit(False).alias("is_unknown_station"),
        moment.alias("last_reported"),
        F.lit(0).cast("long").alias("report_age_seconds"),
    )


ROWS = [
    ("a", 0, 10, 0, True), ("a", 2, 10, 0, True), ("a", 13, 5, 5, True), ("a", 15, 10, 0, True),
    ("b", 0, 1, 1, None), ("b", 20, 1, 1, False), ("b", 40, 1, 1, False), ("c", 5, 3, 3, True),
]


def listed(changes):
    rows = changes.orderBy("gbfs_station_id", "valid_from").collect()
    return [
        (r.gbfs_station_id, int((r.valid_from - T0).total_seconds() // 60), r.op, r.delta_bikes)
        for r in rows
    ]


EXPECTED = [
    ("a", 0, "c", None), ("a", 13, "u", -5), ("a", 15, "u", 5),
    ("b", 0, "c", None), ("b", 20, "u", 0), ("c", 5, "c", None),
]


def test_changes_cross_midnight_and_see_null_flags(spark):
    assert listed(intermediate.status_changes(facts(spark, ROWS))) == EXPECTED


@pytest.mark.parametrize("cut", [0, 5, 14, 100])
def test_refresh_equals_full_build_and_is_repeatable(spark, cut):
    all_facts = facts(spark, ROWS)
    path = scratch_path(spark, "archive")
    mark = F.lit(T0 + dt.timedelta(minutes=cut)).cast("timestamp")
    keys = ["gbfs_station_id", "valid_from"]
    first = intermediate.status_changes(all_facts.where(F.col("snapshot_timestamp") <= mark))
    lake.merge_into(first, path, keys, ["last_reported"], "snapshot_date")
    for _ in range(2):
        seed = materialize(intermediate.archive_seed(spark.read.parquet(path)), "seed")
        newest = F.lit(seed.agg(F.max("snapshot_timestamp")).first()[0])
        lake.merge_into(
            intermediate.status_changes(all_facts, seed, newest), path, keys, ["last_reported"],
            "snapshot_date",
        )
        assert listed(spark.read.parquet(path)) == EXPECTED


def test_late_rows_are_ignored_and_counted(spark):
    first = intermediate.status_changes(facts(spark, ROWS))
    late = facts(spark, [("a", 14, 99, 0, True), ("a", 60, 7, 0, True)])
    mark = F.lit(T0 + dt.timedelta(minutes=20)).cast("timestamp")
    found = intermediate.status_changes(late, intermediate.archive_seed(first), mark)
    assert listed(found) == [("a", 60, "u", -3)]
    assert intermediate.late_rows(late, mark).first().late_rows == 1


def test_windows_and_gaps(spark):
    rows = [("a", 0, 1, 1, True), ("a", 10, 2, 1, True), ("a", 21, 3, 1, True)]
    changes = intermediate.status_changes(facts(spark, rows))
    found = intermediate.status_windows(changes, P).orderBy("valid_from").collect()
    assert [(r.duration_minutes, r.is_possible_gap) for r in found] == [
        (10, False), (11, True), (None, False),
    ]
    dwell = reports.longest_dwell(intermediate.status_windows(changes, P)).collect()
    assert [r.duration_minutes for r in dwell] == [10]


def test_volatility(spark):
    changes = intermediate.status_changes(facts(spark, ROWS))
    found = {r.gbfs_station_id: r for r in marts.station_volatility(changes, P).collect()}
    assert found["a"].bikes_moved == 10 and found["a"].docks_moved == 10
    assert found["a"].movement_rank == 1 and found["b"].movement_rank == 2
    assert found["a"].volatility_label == P.volatility_labels["top"]
    assert found["c"].changes_per_hour is None
    assert found["c"].volatility_label == P.volatility_labels["otherwise"]
    assert found["c"].station_name == "Stasiun tak terpetakan (c)"


@pytest.mark.parametrize(("stations", "chosen"), [(94, 0), (95, 1)])
def test_latest_complete_snapshot(spark, stations, chosen):
    sizes = [(f"s{i}", 0) for i in range(100)] + [(f"s{i}", 1) for i in range(stations)]
    df = facts(spark, [(s, m, 1, 1, True) for s, m in sizes])
    latest = intermediate.latest_complete_snapshot(df, P).first()
    assert latest.snapshot_timestamp == T0 + dt.timedelta(minutes=chosen)
    assert latest.min_complete_stations == 95
    current = intermediate.current_rows(df, intermediate.latest_complete_snapshot(df, P))
    assert current.count() == (100, stations)[chosen]
