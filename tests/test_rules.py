"""Hand-made rows for each rule, NULL case and edge."""

import datetime as dt
import itertools

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from velomart.functions import (
    clean_text,
    date_key,
    elapsed,
    haversine_km,
    iso_day_of_week,
    round_to_long,
    rounded_place,
    safe_divide,
    station_id_text,
    surrogate_key,
)
from velomart.functions.columns import WHITE_SPACE
from velomart.operators.rules import (
    is_valid,
    raw_trip_rules,
    reason_array,
    reason_text,
    split,
    status_rules,
    trip_rules,
)
from velomart.params import Params
from velomart.plans import core, intermediate, staging
from velomart.schemas import STATION_STATUS, TRIPS, conform

P = Params()
T0 = dt.datetime(2026, 1, 5, 8, 0)


def trip(**changes):
    row = {
        "ride_id": "r1", "rideable_type": "classic_bike", "started_at": T0,
        "ended_at": T0 + dt.timedelta(minutes=5), "start_station_name": "A",
        "start_station_id": "5000.01", "end_station_name": "B", "end_station_id": "JC100",
        "start_lat": 40.7, "start_lng": -74.0, "end_lat": 40.71, "end_lng": -74.0,
        "member_casual": "member", "_source_file": "f.csv", "_ingested_at": T0,
        "_ride_started_date": T0.date(),
    }
    return Row(**{**row, **changes})


def trips(spark, *rows):
    text = ", ".join(
        f"{f.name} {'timestamp_ntz' if f.name == '_ingested_at' else f.dataType.simpleString()}"
        for f in TRIPS.fields
    )
    return conform(spark.createDataFrame(list(rows), text), TRIPS)


def status(spark, *rows):
    base = {
        "station_id": "g-1", "num_bikes_available": 5, "num_ebikes_available": 0,
        "num_scooters_available": None, "num_docks_available": 5, "num_bikes_disabled": 0,
        "num_docks_disabled": 0, "is_installed": True, "is_renting": True,
        "is_returning": True, "is_disabled": None, "last_reported": T0,
        "snapshot_timestamp": T0, "_ingested_at": T0, "_snapshot_date": T0.date(),
    }
    text = ", ".join(
        f"{f.name} {f.dataType.simpleString().replace('timestamp', 'timestamp_ntz')}"
        for f in STATION_STATUS.fields
    )
    return conform(
        spark.createDataFrame([Row(**{**base, **r}) for r in rows], text), STATION_STATUS
    )


MINUTE = dt.timedelta(minutes=1)
SECOND = dt.timedelta(seconds=1)
TRIP_CASES = [
    ({}, ""),
    ({"ride_id": None}, "missing_ride_id"),
    ({"started_at": None}, "missing_started_at"),
    ({"ended_at": None}, "missing_ended_at"),
    ({"ended_at": T0 - SECOND}, "negative_duration"),
    ({"ended_at": T0 - SECOND / 2}, ""),
    ({"ended_at": T0 + 86_400 * SECOND}, ""),
    ({"ended_at": T0 + 86_401 * SECOND}, "duration_extreme"),
    ({"ride_id": None, "ended_at": T0 - SECOND}, "missing_ride_id"),
    ({"start_station_id": "Shop Morgan"}, "invalid_start_station_id"),
    ({"end_station_id": "5303.06_"}, "invalid_end_station_id"),
    ({"start_station_id": "SYS016"}, ""),
    ({"start_station_id": None, "start_lng": None}, "missing_start_location"),
    ({"end_station_id": None, "end_lat": None, "end_lng": None}, "missing_end_location"),
    ({"start_station_id": None}, ""),
    ({"start_lat": 41.5}, "start_coord_out_of_nyc"),
    ({"end_lng": -70.0}, "end_coord_out_of_nyc"),
    ({"start_lng": None}, ""),
    ({"start_lat": 41.5, "start_lng": None}, "start_coord_out_of_nyc"),
    (
        {"start_station_id": "x", "ended_at": T0 - SECOND},
        "negative_duration,invalid_start_station_id",
    ),
]


def test_trip_rules(spark):
    rules = trip_rules(P)
    rows = trips(spark, *[trip(**c, _source_file=str(i)) for i, (c, _) in enumerate(TRIP_CASES)])
    result = rows.select(
        F.col("_source_file").cast("int").alias("i"),
        reason_text(rules).alias("reason"),
        is_valid(rules).alias("valid"),
        F.array_join(reason_array(rules), ",").alias("listed"),
    ).collect()
    found = {r.i: r for r in result}
    for i, (_, expected) in enumerate(TRIP_CASES):
        assert (found[i].reason, found[i].valid) == (expected, expected == ""), TRIP_CASES[i]
        assert found[i].listed == expected
    valid, rejected = split(rows, rules)
    assert valid.count() + rejected.count() == len(TRIP_CASES)


def test_raw_rules_check_durations_without_a_ride_and_no_box(spark):
    rows = trips(spark, trip(ride_id=None, ended_at=T0 - SECOND, start_lat=41.5))
    reason = rows.select(reason_text(raw_trip_rules(P))).first()[0]
    assert reason == "missing_ride_id,negative_duration"


@pytest.mark.parametrize(
    ("changes", "expected"),
    [
        ({}, ""),
        ({"station_id": None}, "missing_station_id"),
        ({"num_bikes_available": None}, "missing_bikes_available"),
        ({"num_docks_available": -1}, "negative_availability"),
        ({"num_ebikes_available": -1}, "negative_auxiliary_count"),
        ({"num_ebikes_available": None}, ""),
        ({"last_reported": None}, "missing_last_reported"),
        ({"last_reported": dt.datetime(1970, 1, 2)}, "invalid_last_reported_sentinel"),
        ({"last_reported": T0 + 5 * MINUTE}, ""),
        ({"last_reported": T0 + 5 * MINUTE + SECOND}, "last_reported_in_future"),
        ({"snapshot_timestamp": None}, "missing_snapshot_timestamp"),
    ],
)
def test_status_rules(spark, changes, expected):
    rows = status(spark, {k: v for k, v in changes.items() if k != "station_id"})
    if "station_id" in changes:
        rows = rows.withColumn("station_id", F.lit(None).cast("string"))
    assert rows.select(reason_text(status_rules(P))).first()[0] == expected


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_text_expressions(spark):
    assert one(spark, clean_text(F.lit("\t A b \n"))) == "A b"
    assert one(spark, clean_text(F.lit("  "))) is None
    assert one(spark, station_id_text(F.lit(" 5303.06_ "))) == "5303.06"
    assert one(spark, station_id_text(F.lit("5303.06__"))) == "5303.06_"
    assert one(spark, station_id_text(F.lit("_"))) is None
    assert one(spark, station_id_text(F.lit(None).cast("string"))) is None
    assert one(spark, surrogate_key(F.lit("a"), F.lit(None).cast("string"))) != one(
        spark, surrogate_key(F.lit("a"), F.lit(""))
    )


def test_stored_text_is_cleaned_like_any_other(spark):
    parts = [*WHITE_SPACE, "", "a", "_", "~", "!", "x y", "\x1f", "\x7f", "é", "漢", "\u200b"]
    texts = ["".join(t) for t in itertools.product(parts, repeat=2)] + ["\t 5 _\xa0 ", " \t", None]
    v = F.col("v")
    rows = spark.createDataFrame([(t,) for t in texts], "v string").select(
        "v", clean_text(v, stored=True).alias("text"), station_id_text(v, stored=True).alias("id")
    )
    for r in rows.collect():
        text = None if r.v is None else r.v.strip(WHITE_SPACE)
        assert r.text == (text or None), repr(r.v)
        assert r.id == ((text or "").removesuffix("_") or None), repr(r.v)
    # the slow search for the whole set is left to text that needs it
    assert "else btrim" in str(clean_text(v, stored=True)).lower()


def test_rounded_places_are_the_rounded_ones(spark):
    values = [40.7, -73.9, 40.7000005, 40.7000015, -0.0000005, 1e-7, 0.0, 1e15, 123456.1234565, 1e300]
    values += [float("nan"), float("inf"), float("-inf"), None]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    assert rows.where(~rounded_place(F.col("v")).eqNullSafe(F.round("v", 6))).count() == 0
    assert "rint" in str(rounded_place(F.col("v"))).lower()


def test_duration_rules_at_their_bounds(spark):
    most, micro = dt.timedelta(seconds=P.max_trip_duration_seconds), dt.timedelta(microseconds=1)
    cases = {
        -SECOND: "negative_duration", micro - SECOND: "", dt.timedelta(): "", most: "",
        most + SECOND - micro: "", most + SECOND: "duration_extreme",
    }
    rows = trips(spark, *[trip(ended_at=T0 + length, _source_file=str(i)) for i, length in enumerate(cases)])
    for rules in (trip_rules(P), raw_trip_rules(P)):
        found = {int(r[0]): r[1] for r in rows.select("_source_file", reason_text(rules)).collect()}
        assert [found[i] for i in range(len(cases))] == list(cases.values())
    # a start so late that the longest trip would end beyond all times, and times that are missing
    odd = rows.limit(1).withColumn("started_at", F.timestamp_micros(F.lit(2**63 - 1)).cast(rows.schema["started_at"].dataType))
    assert odd.select(reason_text(trip_rules(P))).first()[0] == "negative_duration"
    gone = trips(spark, trip(started_at=None))
    assert gone.select(reason_text(raw_trip_rules(P))).first()[0] == "missing_started_at"
    # elapsed seconds come behind a plain comparison
    for reason, plain in (("negative_duration", "<"), ("duration_extreme", ">=")):
        assert plain in str(raw_trip_rules(P)[reason]).split("timestampdiff")[0], reason


def test_numbers_and_dates(spark):
    day = F.lit("2026-01-05").cast("date")
    assert one(spark, iso_day_of_week(day)) == 1
    assert one(spark, iso_day_of_week(F.date_add(day, 6))) == 7
    assert one(spark, date_key(day)) == 20260105
    assert one(spark, round_to_long(F.lit(40.5))) == 41
    assert one(spark, safe_divide(F.lit(1), F.lit(0))) is None
    late = F.lit("2026-01-05 08:00:01.100").cast("timestamp_ntz")
    early = F.lit("2026-01-05 08:00:00.900").cast("timestamp_ntz")
    assert one(spark, elapsed("SECOND", late, early)) == 0
    here, there = (F.lit(40.0), F.lit(-74.0)), (F.lit(41.0), F.lit(-74.0))
    assert round(one(spark, haversine_km(*here, *there, P.earth_radius_km)), 1) == 111.2
    gone = F.lit(None).cast("double")
    assert one(spark, haversine_km(*here, gone, gone, P.earth_radius_km)) is None


def test_mapping_merges_same_name_and_place_only(spark):
    rows = trips(
        spark,
        trip(start_station_id="5343.10", start_station_name=" A ", end_station_id="1.1"),
        trip(start_station_id="5343.1", start_station_name="A", end_station_id="1.1",
             start_lat=40.7000000004),
        trip(start_station_id="77", start_station_name="A", start_lat=40.8, end_station_id="1.1"),
    )
    found = {r.station_id: r for r in staging.station_id_mapping(rows).collect()}
    assert found["5343.10"].canonical_station_id == "5343.1"
    assert found["5343.10"].is_merged_duplicate and found["5343.10"].ids_in_group == 2
    assert found["77"].canonical_station_id == "77" and found["77"].ids_in_group == 1
    assert found["1.1"].total_mentions == 3


def test_latest_ingested_trip_wins_and_rejected_rows_stay(spark):
    rows = trips(
        spark,
        trip(member_casual="casual"),
        trip(_ingested_at=T0 + MINUTE, member_casual=" Member "),
        trip(ride_id=" ", _source_file="bad"),
        trip(ride_id="", _source_file="bad"),
    )
    mapping = staging.station_id_mapping(rows)
    cleaned = staging.cleaned_trips(rows, mapping)
    kept = staging.stg_trips(cleaned, P).collect()
    assert [(r.ride_id, r.member_casual, r.duration_seconds) for r in kept] == [("r1", "member", 300)]
    assert staging.stg_trips_rejected(cleaned, P).count() == 2
    summary = intermediate.trips_dq_summary(rows, mapping, P).collect()
    counts = {(r._source_file, r.rejection_reason): r for r in summary}
    assert counts[("f.csv", None)].valid_rows == 1
    assert counts[("f.csv", None)].duplicate_rows == 1
    assert counts[("bad", "missing_ride_id")].rejected_rows == 2


def test_status_dedup_keeps_the_later_poll(spark):
    rows = status(
        spark,
        {"num_bikes_available": 1},
        {"num_bikes_available": 2, "_ingested_at": T0 + MINUTE, "snapshot_timestamp": T0 + MINUTE},
    )
    kept = staging.stg_station_status(staging.cleaned_status(rows), P).collect()
    assert [(r.num_bikes_available, r.report_age_seconds) for r in kept] == [(2, 60)]
    per_poll = Params(status_dedup_key=("station_id", "snapshot_timestamp"))
    assert staging.stg_station_status(staging.cleaned_status(rows), per_poll).count() == 2


def bridge(spark, capacity):
    return spark.createDataFrame(
        [("k", "5000.01", "g-1", "A", 40.7, -74.0, capacity, "r")],
        "station_key string, station_id string, gbfs_station_id string, station_name string, "
        "lat double, lng double, capacity long, region_id string",
    )


@pytest.mark.parametrize(
    ("bikes", "docks", "capacity", "renting", "level", "severity"),
    [
        (0, 10, 10, False, "not_operational", 0),
        (0, 10, 10, True, "empty", 5),
        (10, 0, 10, True, "full", 5),
        (1, 9, 10, True, "low", 3),
        (9, 1, 10, True, "high", 3),
        (2, 8, 10, True, "balanced", 1),
        (11, 1, 10, True, "unknown_capacity", 1),
        (0, 1, None, True, "unknown_capacity", 1),
    ],
)
def test_risk_levels(spark, bikes, docks, capacity, renting, level, severity):
    rows = status(
        spark,
        {"num_bikes_available": bikes, "num_docks_available": docks, "is_renting": renting},
    )
    cleaned = staging.stg_station_status(staging.cleaned_status(rows), P)
    risk = intermediate.station_risk(cleaned, bridge(spark, capacity), P).first()
    assert (risk.risk_level, risk.risk_severity) == (level, severity)
    assert risk.is_unknown_station is False


def test_zero_capacity_is_unknown(spark):
    stations = spark.createDataFrame(
        [("5000.01", None, None, None, 1, T0, T0)],
        "station_id string, station_name string, lat double, lng double, trip_mentions long, "
        "first_seen_at timestamp_ntz, last_seen_at timestamp_ntz",
    )
    info = spark.createDataFrame(
        [("g-2", "Info", "5000.01", 40.7, -73.9, 0, "1"), ("g-1", "First", "5000.01", 40.7, -73.9, 0, "1")],
        "station_id string, name string, short_name string, lat double, lon double, "
        "capacity long, region_id string",
    )
    row = intermediate.station_id_bridge(stations, info).first()
    assert (row.gbfs_station_id, row.station_name, row.capacity) == ("g-1", "First", None)
    assert row.has_capacity_info is False and row.is_missing_from_gbfs is False


def test_calendar_of_empty_facts(spark):
    empty = trips(spark, trip()).where("false").withColumn("trip_date", F.col("_ride_started_date"))
    none = status(spark, {}).where("false")
    days = core.dim_date(empty, none, P).agg(F.min("date_day"), F.max("date_day")).first()
    assert days[0] == P.calendar_default_start
    assert days[1] == P.as_of.date() + dt.timedelta(days=7)
