"""Incremental trips against full builds, and what a refresh may open."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from velomart.operators.quality import QualityGateError
from velomart.params import Params
from velomart.plans import trip_increments as ti
from velomart.plans.models import Models
from velomart.schemas import STATION_INFORMATION, STATION_STATUS, TRIPS
from velomart.sources.snapshots import SEGMENT, SnapshotStore
from velomart.workspace import materialize

P = Params(as_of=dt.datetime(2026, 1, 20), quarantine_alert_pct=95.0)
NOW = dt.datetime(2026, 1, 15)


def trip(rng, ride, day, file, stamp=0):
    start = dt.datetime(2026, 1, day, rng.randrange(24), rng.randrange(60))
    a, b = rng.randrange(6), rng.randrange(6)
    return (
        ride if rng.random() > 0.03 else None or " ", rng.choice(["classic_bike", " Electric_Bike"]), start,
        start + dt.timedelta(seconds=rng.choice([-5, 60, 600, 601, 90_000])), f"S{a // 2} ", rng.choice([f"{a}.1", f"{a}.1_", None, "Shop"]) if rng.random() < 0.3 else f"{a}.1",
        f"S{b // 2}", f"{b}.1", 40.7 + (a // 2) * 0.01, -74.0, rng.choice([40.8, None, 42.0]) if rng.random() < 0.2 else 40.8, -74.1,
        rng.choice(["member", "casual"]), file, NOW + dt.timedelta(hours=stamp), start.date(),
    )


def good(ride, day, file, stamp=0):
    start = dt.datetime(2026, 1, day, 8)
    return (
        ride, "classic_bike", start, start + dt.timedelta(minutes=9), "S0", "1.1", "S1", "2.1", 40.7, -74.0, 40.8, -74.1,
        "member", file, NOW + dt.timedelta(hours=stamp), start.date(),
    )


class World:
    """Raw files by name, stored as a table partitioned by date."""

    def __init__(self, spark, path):
        self.spark, self.path, self.files, self.store = spark, path, {}, SnapshotStore(spark, f"{path}/state")
        self.version = 0

    def load(self, **files):
        days = {r[-1] for f in files for r in [*self.files.get(f, []), *(files[f] or [])]}
        self.files |= files
        rows = [r for f in self.files.values() for r in f or []]
        self.version += 1
        self.spark.createDataFrame(rows, TRIPS).write.partitionBy("_ride_started_date").parquet(f"{self.path}/raw{self.version}")
        return days

    @property
    def raw(self):
        return self.spark.read.schema(TRIPS).parquet(f"{self.path}/raw{self.version}").select(*TRIPS.names)

    def refresh(self, days, p=P):
        return ti.refresh_trips(self.store, self.raw, days, p)

    def models(self):
        status, info = (self.spark.createDataFrame([], s) for s in (STATION_STATUS, STATION_INFORMATION))
        stored = ti.StoredTrips(self.store, self.store.snapshot(), self.raw, status, info, P)
        return stored, Models(self.raw, status, info, P, store_trips=True)


NAMES = [
    "station_id_mapping", "cleaned_trips", "stg_trips", "stg_trips_rejected", "fct_trips", "stations_deduplicated",
    "trips_dq_summary", "trip_summary_daily", "usage_pattern_hourly", "member_vs_casual_behavior", "demand_vs_supply",
    "trip_gate", "dim_station", "calendar",
]


def same(stored, full):
    for name in NAMES:
        a, b = getattr(stored, name), getattr(full, name)
        assert sorted(a.columns) == sorted(b.columns), name
        rows = [sorted(map(str, d.select(sorted(b.columns)).collect())) for d in (a, b)]
        assert rows[0] == rows[1], name


def test_ingest_correct_remove_and_redeliver(spark, tmp_path):
    rng = random.Random(1)
    world = World(spark, str(tmp_path))
    one = [trip(rng, f"r{k}", 1 + k % 5, "one.csv") for k in range(120)]
    two = [trip(rng, f"r{100 + k}", 4 + k % 4, "two.csv", 1) for k in range(60)]
    steps = [
        {"one.csv": one, "two.csv": two},
        {"three.csv": [trip(rng, f"r{k}", 12 + k % 2, "three.csv", 2) for k in range(0, 120, 9)]},  # newer copies
        {"two.csv": [trip(rng, r[0], 5 + k % 2, "two.csv", 3) for k, r in enumerate(two[:30])]},  # corrected
        {"three.csv": []},  # removed: the older copies count again
        # many mentions under one name and place: other stations are merged into another one
        {"four.csv": [(*trip(rng, f"n{k}", 14, "four.csv")[:4], "S0 ", "1.1", "S0", "1.1", 40.7, -74.0, 40.7, -74.0, "member", "four.csv", NOW, dt.date(2026, 1, 14)) for k in range(300)]},
        {"one.csv": one[:50], "five.csv": [trip(rng, f"r{k}", 2, "five.csv", 9) for k in range(0, 200, 3)]},
    ]
    results, touched = [], []
    for files in steps:
        touched.append(world.load(**files))
        results.append(world.refresh(touched[-1]))
        if len(results) in (2, 4, 6):
            same(*world.models())
    assert results[1].settled and not results[0].opened
    # dates of stations that are mapped to another one now are derived as well
    assert any(set(r.derived) > days for r, days in zip(results[1:], touched[1:], strict=True))
    before = results[-1].snapshot
    again = world.refresh([dt.date(2026, 1, 2)])
    assert again.derived == [dt.date(2026, 1, 2)] and not again.settled
    same(*world.models())
    assert world.store.snapshot(before.number) == before


def violations(models):
    names = ("stg_trips", "fct_trips", "stg_trips_rejected", "station_id_mapping", "trip_summary_daily")
    return sorted(map(tuple, models.assertions_report(names).collect()))


def test_data_tests_over_three_refreshes(spark, tmp_path):
    rng = random.Random(6)
    world = World(spark, str(tmp_path))
    one = [trip(rng, f"r{k}", 1 + k % 3, "one.csv") for k in range(40)] + [(*good("odd", 2, "one.csv")[:12], "someone", *good("odd", 2, "one.csv")[13:])]
    for files in ({"one.csv": one}, {"two.csv": [good(f"r{k}", 5, "two.csv", 2) for k in range(9)]}, {"one.csv": one[:20]}):
        world.refresh(world.load(**files))
        stored, full = world.models()
        assert violations(stored) == violations(full)
    # a ride that is a fact of two dates, and one whose station nobody knows
    change = ti.Change(world.store)
    day = dt.date(2026, 1, 6)
    more = world.store.read("facts", segments=[dt.date(2026, 1, 5)]).where("ride_id in ('r0', 'r1')")
    more = more.withColumn(SEGMENT, F.lit(day)).withColumn("start_station_key", F.lit("nobody"))
    more = materialize(more, "more")
    change.replace("facts", more, [day])
    buckets = {r[0] for r in ti.segment_checks._keys(more, [c for c in ti.trip_checks(P, "fct_trips") if c.unique]).select("_bucket").distinct().collect()}
    for d in range(1, 6):
        spoil(f"{world.path}/state/facts", f"2026-01-0{d}")
        spoil(f"{world.path}/state/clean", f"2026-01-0{d}")
    for folder, _, files in os.walk(f"{world.path}/state/facts__keys"):
        if "_bucket=" in folder and int(folder.rsplit("=", 1)[1]) not in buckets:
            for name in files:
                open(os.path.join(folder, name), "wb").close()
    again = ti.update_checks(change, "facts", change.read("facts", [day]), [day], ti.trip_checks(P, *ti.FACT_MODELS))
    assert set(again) == buckets
    change.publish()
    found = dict((f"{m}.{c}", n) for m, c, n in ti.segment_checks.report(
        world.store, world.store.snapshot(), "facts", ti.trip_checks(P, *ti.FACT_MODELS),
        {name: getattr(stored, name) for name in ("dim_station", "dim_date", "dim_rider_type")}).collect())
    assert (found["fct_trips.unique_ride_id"], found["stg_trips.unique_ride_id"], found["fct_trips.unique_trip_key"]) == (2, 2, 2)
    assert found["fct_trips.relationship_start_station_key"] == 2
    # the same rows again are the same digests: nothing is counted
    change = ti.Change(world.store)
    change.replace("facts", more, [day])
    assert ti.update_checks(change, "facts", change.read("facts", [day]), [day], ti.trip_checks(P, *ti.FACT_MODELS)) == []


def spoil(root, day):
    """Make the files of a segment unreadable."""
    for folder, _, files in os.walk(root):
        if f"={day}" in folder and "/_bucket=" not in folder or f"={day}/" in folder:
            for name in files:
                if name.endswith(".parquet"):
                    with open(os.path.join(folder, name), "wb") as file:
                        file.write(b"spoiled")


def test_only_touched_segments_are_opened(spark, tmp_path):
    world = World(spark, str(tmp_path))
    rides = {d: [f"d{d}-{k}" for k in range(20)] for d in range(1, 9)}
    files = {f"{d}.csv": [good(r, d, f"{d}.csv") for r in rides[d]] for d in rides}
    world.refresh(world.load(**files))
    extra = [good(r, 10, "10.csv", 5) for r in [*rides[3][:4], *[f"x{k}" for k in range(10)]]]
    days = world.load(**{"10.csv": extra})
    for day in (1, 2, 4, 5, 6, 7, 8):  # neither facts, nor clean, nor raw trips of these
        for table in ("facts", "clean"):
            spoil(f"{world.path}/state/{table}", f"2026-01-0{day}")
        spoil(f"{world.path}/raw{world.version}", f"2026-01-0{day}")
    found = world.refresh(days)
    assert found.derived == [dt.date(2026, 1, 10)] and found.opened == [dt.date(2026, 1, 3)]
    kept = world.store.read("facts", segments=[dt.date(2026, 1, 3), dt.date(2026, 1, 10)])
    places = {r.ride_id: r[SEGMENT].day for r in kept.collect()}
    assert places == {r: 10 if k < 4 else 3 for k, r in enumerate(rides[3])} | {f"x{k}": 10 for k in range(10)}


def test_index_opens_hit_buckets_only(spark, tmp_path):
    rng = random.Random(3)
    world = World(spark, str(tmp_path))
    world.refresh(world.load(**{"1.csv": [trip(rng, f"a{k}", 1, "1.csv") for k in range(200)]}))
    change = ti.Change(world.store)
    change.replace(
        "rides",
        spark.createDataFrame([("a7", dt.date(2026, 1, 9))], "ride_id string, _segment date").withColumn(ti.BUCKET, ti._bucket(8)),
        [dt.date(2026, 1, 9)], ["ride_id"], [ti.BUCKET], {"parquet.bloom.filter.enabled#ride_id": "true"},
    )
    bucket = change.read("rides", [dt.date(2026, 1, 9)]).first()[ti.BUCKET]
    for other in set(range(8)) - {bucket}:
        for version in os.listdir(f"{world.path}/state/rides"):
            spoil_bucket = f"{world.path}/state/rides/{version}/_segment=2026-01-01/_bucket={other}"
            for name in os.listdir(spoil_bucket) if os.path.isdir(spoil_bucket) else []:
                open(f"{spoil_bucket}/{name}", "wb").close()
    found = ti.copies_elsewhere(change, [dt.date(2026, 1, 9)], 8)
    assert [tuple(r) for r in found.collect()] == [("a7", dt.date(2026, 1, 1))]


def test_a_failed_gate_publishes_nothing(spark, tmp_path):
    rng = random.Random(4)
    world = World(spark, str(tmp_path))
    world.refresh(world.load(**{"1.csv": [trip(rng, f"a{k}", 1, "1.csv") for k in range(50)]}))
    before = world.store.snapshot()
    bad = [(*good(f"b{k}", 1, "bad.csv")[:5], "Shop", *good(f"b{k}", 1, "bad.csv")[6:]) for k in range(9)]
    days = world.load(**{"bad.csv": bad})
    with pytest.raises(QualityGateError, match="bad.csv=100.0%"):
        world.refresh(days)
    assert world.store.snapshot() == before
    assert world.store.read("facts").where(F.col("_source_file") == "bad.csv").isEmpty()
    world.load(**{"bad.csv": []})
    world.refresh(days)
    same(*world.models())


def test_raw_trips_are_scanned_twice(spark, tmp_path, monkeypatch):
    rng = random.Random(5)
    world = World(spark, str(tmp_path))
    days = world.load(**{"1.csv": [trip(rng, f"a{k}", 1 + k % 3, "1.csv") for k in range(50)]})
    plans, replace = [], ti.Change.replace

    def noted(self, table, rows, *rest, **more):
        plans.append((table, rows.inputFiles()))
        return replace(self, table, rows, *rest, **more)

    monkeypatch.setattr(ti.Change, "replace", noted)
    found = world.refresh(days)
    reads_raw = [table for table, files in plans if any("/raw1/" in f for f in files)]
    assert reads_raw == ["mentions", "clean"]
    assert (found.raw_rows, found.rejected_rows) == (50, world.models()[0].stg_trips_rejected.count())


def test_filters_on_either_key_skip_row_groups(spark, tmp_path):
    import pyarrow.parquet as pq

    store = SnapshotStore(spark, str(tmp_path))
    rows = spark.range(40_000).selectExpr(
        "md5(string(id)) AS ride_id", "concat(1000 + pmod(hash(id), 200), '.01') AS start_station_id",
        "if(id % 3 = 0, 'casual', 'member') AS member_casual", "date'2026-01-01' AS _segment",
    )
    change = ti.Change(store)
    change.replace("facts", rows.coalesce(1), [dt.date(2026, 1, 1)], ti.FACT_ORDER, options={"parquet.block.size": "100000"})
    groups = []
    for folder, _, files in os.walk(tmp_path):
        for name in files:
            if name.endswith(".parquet"):
                meta = pq.ParquetFile(os.path.join(folder, name)).metadata
                for g in range(meta.num_row_groups):
                    columns = [meta.row_group(g).column(c) for c in range(meta.num_columns)]
                    groups.append({c.path_in_schema: (c.statistics.min, c.statistics.max) for c in columns})
    assert len(groups) >= 6
    for column, value in (("start_station_id", "1100.01"), ("member_casual", "casual")):
        hit = sum(g[column][0] <= value <= g[column][1] for g in groups)
        assert 0 < hit <= len(groups) * 0.7, (column, hit, len(groups))


def test_scratch_copies_hold_staged_trips_and_stores_the_fact(spark):
    raw = spark.createDataFrame([good("r1", 5, "a.csv"), good("r1", 5, "a.csv", 1), good("r2", 6, "b.csv")], TRIPS)
    status, info = (spark.createDataFrame([], s) for s in (STATION_STATUS, STATION_INFORMATION))
    graph = Models(raw, status, info, P, store_trips=True)
    facts = sorted(graph.fct_trips.collect())
    assert [r.ride_id for r in facts] == ["r1", "r2"]
    files = graph.fct_trips.inputFiles()
    assert files and all("/stg_trips-" in f for f in files)
    names = []

    def store(df, name):
        names.append(name)
        return materialize(df, name)

    other = Models(raw, status, info, P, store_trips=True, store=store)
    assert sorted(other.fct_trips.collect()) == facts
    assert names == ["station_id_mapping", "fct_trips"]
