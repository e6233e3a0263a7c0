"""Mergeable state against exact figures."""

import random

import pytest
from pyspark.sql import functions as F

from velomart.operators.mergeable import (
    distinct_state,
    extended_numbers,
    merged_distinct,
    merged_quantile,
    quantile_state,
    rank_error,
)
from velomart.workspace import materialize


def test_distinct_of_months_from_days(spark):
    rng = random.Random(1)
    rows = [(d // 30, d, rng.choice([f"s{rng.randrange(300)}", None, "hot", "hot"])) for d in range(90) for _ in range(50)]
    df = spark.createDataFrame(rows, "month int, day int, station string")
    numbers = materialize(extended_numbers(df.where("day < 40"), "station"), "numbers")
    more = extended_numbers(df, "station", numbers)
    kept = {r.station: r.number for r in numbers.collect()}
    now = {r.station: r.number for r in more.collect()}
    assert kept.items() <= now.items() and sorted(now.values()) == list(range(1, len(now) + 1))
    # numbers far apart fall into several bitmaps
    spread = df.join(more, "station", "left").withColumn("number", F.col("number") * 40_000)
    state = materialize(distinct_state(spread, ["month", "day"], F.col("number")), "state")
    assert state.count() > 90
    got = {r.month: r.n for r in merged_distinct(state, ["month"]).collect()}
    assert got == {m: len({s for k, _, s in rows if k == m and s is not None}) for m in range(3)}


def test_quantiles_of_months_from_days_lie_in_the_bound(spark):
    rng = random.Random(2)
    rows = [(d // 30, d, int(rng.expovariate(1 / 600)) if rng.random() > 0.01 else None) for d in range(60) for _ in range(400)]
    df = spark.createDataFrame(rows, "month int, day int, seconds long")
    state = materialize(quantile_state(df, ["month", "day"], F.col("seconds")), "sketches")
    for share in (0.1, 0.5, 0.99):
        for r in merged_quantile(state, ["month"], share).collect():
            values = sorted(v for m, _, v in rows if m == r.month and v is not None)
            assert r.n == len(values)
            below, upto = sum(v < r.value for v in values), sum(v <= r.value for v in values)
            slack = 2 * rank_error(400)
            assert below / len(values) - slack <= share <= upto / len(values) + slack


def test_empty(spark):
    none = spark.createDataFrame([], "day int, v long, s string")
    assert extended_numbers(none, "s").collect() == []
    assert merged_distinct(distinct_state(none, ["day"], F.col("v")), ["day"]).collect() == []
    assert merged_quantile(quantile_state(none, ["day"], F.col("v")), ["day"], 0.5).collect() == []


def test_monthly_figures_deduplicate_without_unused_columns(spark, monkeypatch):
    import workload_runs
    from velomart.params import Params
    from velomart.plans.models import Models
    from velomart.schemas import STATION_INFORMATION, STATION_STATUS, TRIPS

    class Seen(Exception):
        pass

    def seen(df, name):
        raise Seen(df._jdf.queryExecution().optimizedPlan().toString())

    nothing = spark.sparkContext.emptyRDD()  # a plan over it is not folded away
    empty = [spark.createDataFrame(nothing, schema) for schema in (TRIPS, STATION_STATUS, STATION_INFORMATION)]
    monkeypatch.setattr(workload_runs, "materialize", seen)
    with pytest.raises(Seen) as found:
        workload_runs._monthly(Models(*empty, Params()))
    window = str(found.value).split("Window")[1].split("\n")[0]
    assert "start_station_id" in window and "member_casual" not in window
