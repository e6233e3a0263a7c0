"""One pointer for many tables: readers, writers that fail, writers that race, old versions."""

import datetime as dt
import glob
import os
import tempfile
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from velomart.sources import storage
from velomart.sources.snapshots import SEGMENT, Change, ConflictError, SnapshotStore, merge_rows
from velomart.workspace import FREE_SHUFFLES, freed_shuffles, materialize

DAYS = [dt.date(2026, 1, d) for d in (1, 2, 3)]


def rows(spark, *values):
    return spark.createDataFrame([(k, v, DAYS[k % 3]) for k, v in values], f"k int, v int, {SEGMENT} date")


def content(frame):
    return sorted((r.k, r.v) for r in frame.collect())


@pytest.fixture
def store(spark, tmp_path):
    return SnapshotStore(spark, str(tmp_path / "store"))


def test_a_reader_sees_one_state_of_all_tables(spark, store):
    change = Change(store)
    change.replace("a", rows(spark, (0, 1), (1, 1)), DAYS)
    change.replace("b", rows(spark, (0, 1)), DAYS)
    change.publish()
    at = store.snapshot()
    before = store.read("a", at)
    change = Change(store)
    change.replace("a", rows(spark, (0, 2)), [DAYS[0]])
    assert content(store.read("a")) == [(0, 1), (1, 1)]  # not published yet
    assert content(change.read("a")) == [(0, 2), (1, 1)]
    change.replace("b", rows(spark), DAYS)
    change.publish()
    assert content(before) == [(0, 1), (1, 1)] and content(store.read("b", at)) == [(0, 1)]
    assert content(store.read("a")) == [(0, 2), (1, 1)] and content(store.read("b")) == []
    assert store.expire(keep=1) > 0
    assert content(store.read("a")) == [(0, 2), (1, 1)]
    files = [r.path for r in storage.listing(spark, store.root).collect()]
    assert sum("/a/" in f for f in files) == 2 and not any("/b/" in f for f in files)


def test_a_write_that_dies_leaves_the_old_state(spark, store):
    merge_rows(store, "a", rows(spark, (0, 1)), ["k"], ["v"])
    broken = rows(spark, (0, 5), (1, 5)).withColumn("v", F.when(F.col("k") == 1, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        merge_rows(store, "a", broken, ["k"], ["v"])
    assert content(store.read("a")) == [(0, 1)] and store.snapshot().number == 1
    change = Change(store)  # dies after its tables are written, before the pointer is
    change.replace("a", rows(spark, (0, 9)), DAYS)
    assert content(store.read("a")) == [(0, 1)]
    store.expire()
    assert sum("/a/" in r.path for r in storage.listing(spark, store.root).collect()) == 1


def test_merges_touch_their_segments_and_repeat(spark, store):
    merge_rows(store, "a", rows(spark, (0, 1), (1, 1), (3, 1)), ["k"], ["v"])
    first = store.snapshot().tables["a"]
    for _ in range(2):
        merge_rows(store, "a", rows(spark, (0, 7), (3, 0), (6, 2)), ["k"], ["v"])
        assert content(store.read("a")) == [(0, 7), (1, 1), (3, 1), (6, 2)]
    now = store.snapshot().tables["a"]
    assert now["2026-01-02"] == first["2026-01-02"] and now["2026-01-01"] != first["2026-01-01"]
    assert content(store.read("a", segments=[DAYS[1]])) == [(1, 1)]


def test_of_two_writers_one_is_told(spark, store):
    one, two = Change(store), Change(store)
    one.replace("a", rows(spark, (0, 1)), DAYS)
    two.replace("a", rows(spark, (0, 2)), DAYS)
    one.publish()
    with pytest.raises(ConflictError):
        two.publish()
    two.abandon()
    assert content(store.read("a")) == [(0, 1)]


def test_columns_are_derived_after_rows_are_gathered(spark, store):
    change = Change(store)
    derive = lambda t: t.withColumn("text", F.concat(F.lit("k"), "k"))
    change.replace("a", rows(spark, (0, 1), (1, 5)), DAYS, ["v"], derive=derive)
    change.publish()
    stored = store.read("a")
    assert stored.columns == ["k", "v", "text", SEGMENT]
    assert sorted((r.k, r.v, r.text) for r in stored.collect()) == [(0, 1, "k0"), (1, 5, "k1")]


def test_rows_in_place_are_not_gathered_again(spark, store):
    change = Change(store)
    parts = materialize(rows(spark, *[(3 * k, k) for k in range(30)]).repartition(3), "parts")
    change.replace("gathered", parts, DAYS)
    change.replace("placed", parts, DAYS, in_place=True)
    files = {t: glob.glob(f"{store.root}/{t}/*/*/*.parquet") for t in ("gathered", "placed")}
    assert (len(files["gathered"]), len(files["placed"])) == (1, 3)
    assert content(change.read("placed")) == content(change.read("gathered"))


def test_writes_leave_no_shuffle_files(spark, store):
    root = spark.conf.get("spark.local.dir", tempfile.gettempdir())
    shuffled = lambda: set(glob.glob(f"{root}/blockmgr-*/*/shuffle_*"))
    before = shuffled()
    keyed = spark.range(5_000).selectExpr("id % 700 AS k").groupBy("k").agg(F.count(F.lit(1)).alias("v"))
    assert materialize(keyed, "keyed").count() == 700
    Change(store).replace("a", keyed.withColumn(SEGMENT, F.lit(DAYS[0])), DAYS)
    left = {f for f in shuffled() - before if os.path.getsize(f) > 1_000}
    assert not left


def test_freed_shuffles_resets_the_session(spark):
    def inside(_):
        with freed_shuffles(spark):
            return spark.conf.get(FREE_SHUFFLES)

    with freed_shuffles(spark), ThreadPoolExecutor(4) as pool:
        assert set(pool.map(inside, range(8))) == {"true"}
        assert spark.conf.get(FREE_SHUFFLES) == "true"
    assert spark.conf.get(FREE_SHUFFLES, "false") == "false"
    spark.conf.set(FREE_SHUFFLES, "true")
    try:  # the user's own setting stays
        inside(0)
        assert spark.conf.get(FREE_SHUFFLES) == "true"
    finally:
        spark.conf.unset(FREE_SHUFFLES)
