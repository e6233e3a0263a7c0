"""Distributed ranks and neighbours against plain windows, also with a hot key."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from velomart.operators import (
    keep_latest,
    marked_apart,
    marks_of_repeated,
    signed_endpoints,
    with_neighbor,
    with_percent_rank,
    with_rank,
    with_row_number,
)
from velomart.operators.quality import (
    QualityGateError,
    Check,
    check_summary,
    enforce,
    gate_trips,
    run_checks,
)
from velomart.params import Params
from velomart.workspace import materialize


@pytest.fixture(scope="module")
def rows(spark):
    """2 000 rows; a third of them share one value, some values are NULL."""
    value = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(
        (F.col("id") * 37) % 101
    )
    return materialize(spark.range(2_000).select("id", value.cast("long").alias("v")), "rows")


def pairs(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def test_row_number(rows):
    order = [F.col("v").desc_nulls_last(), F.col("id").asc()]
    plain = rows.withColumn("n", F.row_number().over(Window.orderBy(*order)))
    assert pairs(with_row_number(rows, order, "n"), "id", "n") == pairs(plain, "id", "n")


@pytest.mark.parametrize("descending", [True, False])
def test_rank_and_percent_rank(rows, descending):
    order = F.col("v").desc_nulls_last() if descending else F.col("v").asc_nulls_first()
    window = Window.orderBy(order)
    plain = rows.withColumns({"r": F.rank().over(window), "p": F.percent_rank().over(window)})
    ranked = with_percent_rank(with_rank(rows, "v", "r", descending), "v", "p", descending)
    assert pairs(ranked, "id", "r", "p") == pairs(plain, "id", "r", "p")


def test_percent_rank_of_one_row(spark):
    one = spark.range(1).select(F.lit(3).alias("v"))
    assert with_percent_rank(one, "v", "p").first().p == 0.0


@pytest.mark.parametrize("following", [False, True])
@pytest.mark.parametrize("bucket_size", [1, 7, 10_000])
def test_neighbor_equals_plain_window(spark, following, bucket_size):
    key = F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 10))
    df = spark.range(300).select(
        key.alias("k"),
        F.col("id").alias("t"),
        F.when(F.col("id") % 4 > 0, F.col("id") * 2).alias("x"),
        F.floor(F.col("id") / bucket_size).alias("b"),
    )
    found = with_neighbor(df, ["k"], ["t"], "b", ["t", "x"], "n", following)
    step = F.lead if following else F.lag
    plain = df.withColumn("n", step(F.struct("t", "x")).over(Window.partitionBy("k").orderBy("t")))
    assert pairs(found, "k", "t", "n") == pairs(plain, "k", "t", "n")


def test_keep_latest_breaks_every_tie(spark):
    df = spark.createDataFrame(
        [("a", 1, "y"), ("a", 1, "x"), ("a", None, "z"), (None, 5, "q")], "k string, t int, v string"
    )
    assert pairs(keep_latest(df, ["k"], ["t"]), "k", "t", "v") == [("a", 1, "x"), (None, 5, "q")]
    plan = keep_latest(df, ["k"], ["t"])
    assert plan.count() == 2


def test_marks_keep_all_rows_of_a_repeated_key_together(spark):
    df = materialize(spark.range(3_000).selectExpr("if(id % 50 = 0, null, string(id % 2900)) AS k", "id AS t"), "copies")
    once, more = marked_apart(df, ["k"], marks_of_repeated(df, ["k"]))
    counts = {r.k: r.n for r in df.groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect()}
    found = [r.k for r in more.collect()]
    assert {k for k, n in counts.items() if n > 1} <= set(found)
    assert all(found.count(k) == counts[k] for k in set(found))
    assert len(set(found)) < 600  # most single rows are not among them
    assert once.columns == df.columns
    assert pairs(once.unionByName(more), "k", "t") == pairs(df, "k", "t")
    assert pairs(once.unionByName(keep_latest(more, ["k"], ["t"])), "k", "t") == pairs(keep_latest(df, ["k"], ["t"]), "k", "t")
    # nothing repeated: nothing is marked, and the rows are not shuffled
    single = df.where("k IS NOT NULL").dropDuplicates(["k"])
    once, more = marked_apart(single, ["k"], marks_of_repeated(single, ["k"]))
    assert (once.count(), more.count()) == (single.count(), 0)


def test_signed_endpoints_skip_missing_ids(spark):
    trips = spark.createDataFrame(
        [("a", "b"), ("a", None), (None, "a"), ("c", "c")], "s string, e string"
    )
    found = pairs(signed_endpoints(trips, "s", "e"), "station_id", "departure_count",
                  "arrival_count", "total_activity", "net_flow")
    assert found == [("a", 2, 1, 3, 1), ("b", 0, 1, 1, -1), ("c", 1, 1, 2, 0)]


def test_gate_counts_a_file_without_valid_rows_as_fully_rejected(spark):
    valid = spark.createDataFrame([("a",)] * 99, "_source_file string")
    rejected = spark.createDataFrame([("a",), ("b",), (None,)], "_source_file string")
    gate = gate_trips(valid, rejected, Params())
    found = {r.source: (r.rejected_pct, r.is_violation) for r in gate.collect()}
    assert found == {"a": (1.0, False), "b": (100.0, True), "(tidak diketahui)": (100.0, True)}
    with pytest.raises(QualityGateError, match="trips/b=100.0%"):
        enforce(gate)
    enforce(gate.where("source = 'a'"))


def test_checks_count_violations(spark):
    child = spark.createDataFrame([(1, "x"), (1, None), (2, "y"), (None, "y")], "id int, p string")
    parent = spark.createDataFrame([("x",)], "p string")
    checks = [
        Check("child", "not_null_id", bad="id IS NULL"),
        Check("child", "not_null_p", bad="p IS NULL"),
        Check("child", "unique_id", unique=("id",)),
        Check("child", "parent", parent=("p", "parent", "p")),
    ]
    report = run_checks({"child": child, "parent": parent}, checks).collect()
    assert {r.check_name: r.violations for r in report} == {
        "not_null_id": 1, "not_null_p": 1, "unique_id": 1, "parent": 2,
    }


def test_check_summary(spark):
    rows = spark.createDataFrame(
        [("b", "STALE", 1.0), ("a", "OK", 2.0), ("c", "SKIPPED", None)],
        "check_name string, status string, observed double",
    )
    summary = check_summary([rows]).first()
    assert tuple(summary) == (3, 1, "a=OK,b=STALE,c=SKIPPED")


def test_as_of_is_a_date_time():
    assert isinstance(Params().as_of, dt.datetime)


def test_ranking_few_rows_under_many_partitions_writes_few_files(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2000")
    try:
        df = spark.range(500).select(F.col("id"), (F.col("id") % 50).alias("value"))
        ranks = with_rank(df, "value", "place")
        numbers = with_row_number(df, [F.desc("value"), F.asc("id")], "nth")
        assert len(numbers.inputFiles()) <= 20 and len(ranks.inputFiles()) <= 20
        assert {r.place for r in ranks.collect()} == set(range(1, 500, 10))
        assert sorted(r.nth for r in numbers.collect()) == list(range(1, 501))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_trips_through_a_column_are_the_staged_ones(spark):
    from velomart.plans import staging

    at = dt.datetime(2024, 1, 1, 23)
    names = staging.TRIP_COLUMNS
    first = ["r1", "a", at, at + dt.timedelta(hours=10), 60, at.date(), "A", "1.1", "B", "2.2", 40.7, -74.0, 40.8, -74.1, "m", "f", at]
    rows = [first]
    for name, value in (("rideable_type", "b"), ("started_at", at + dt.timedelta(hours=2)), ("end_lng", -74.0),
                        ("start_station_id", None), ("member_casual", None), ("_ingested_at", at - dt.timedelta(days=1))):
        rows.append([value if n == name else v for n, v in zip(names, first)])
    rows[2][names.index("trip_date")] = dt.date(2024, 1, 2)
    rows.append(["r2", *rows[2][1:]])
    schema = (
        "ride_id string, rideable_type string, started_at timestamp, ended_at timestamp, duration_seconds long, "
        "trip_date date, start_station_name string, start_station_id string, end_station_name string, "
        "end_station_id string, start_lat double, start_lng double, end_lat double, end_lng double, "
        "member_casual string, _source_file string, _ingested_at timestamp"
    )
    cleaned = spark.createDataFrame([tuple(r) for r in rows], schema)
    whole = staging.stg_trips(cleaned, Params())
    assert whole.count() == 2
    for last in ("trip_date", "end_lng"):
        part = staging.stg_trips_through(cleaned, Params(), last)
        assert part.columns == names[: names.index(last) + 1]
        assert sorted(map(tuple, part.collect())) == sorted(map(tuple, whole.select(*part.columns).collect()))
    plan = staging.stg_trips_through(cleaned, Params(), "trip_date")._jdf.queryExecution().optimizedPlan().toString()
    assert "_source_file" not in plan.split("Window")[1].split("\n")[0]
