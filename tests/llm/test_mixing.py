import math
import random

import pytest

from velomart.llm import mixing

SCHEMA = "doc_id long, source string, text string, size int, copy int"


def words(n):
    return " ".join(["w"] * n)


def filled(sizes, weights=(3, 1, 2), budget=1.5, most=2):
    """Targets by sharing the rest again and again."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, left = {}, budget * sum(sizes.values())
    while len(target) < len(names):
        level = left / sum(weight[s] for s in names if s not in target)
        full = [s for s in names if s not in target and weight[s] * level >= most * sizes[s]]
        if not full:
            return target | {s: weight[s] * level for s in names if s not in target}
        for s in full:
            target[s] = most * sizes[s]
            left -= target[s]
    return target


def corpus(seed=1):
    rng = random.Random(seed)
    rows = []
    for k in range(1200):
        source = rng.choice(["big"] * 6 + ["b", "a", "ä", None, "tiny"])
        rows.append((k, source, None if k % 50 == 0 else words(rng.randint(0, 60)), 1, 2))
    return rows + [(None, "big", words(9), 1, 2)] * 3 + [(7, "void", "", 1, 2)]


def test_targets_and_taken_words(spark):
    rows = corpus()
    plan = mixing.mix_plan(spark.createDataFrame(rows, SCHEMA)).collect()
    sizes = {}
    for _, source, text, *_ in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    want = filled(sizes)
    assert len(plan) == len(rows)
    taken, target = {}, {}
    for r in plan:
        assert r.taken in (0, r.size, 2 * r.size)
        taken[r.source_size] = taken.get(r.source_size, 0) + r.taken
        target[r.source_size] = r.target
    assert sum(target.values()) == pytest.approx(1.5 * sum(sizes.values()))
    for source, size in sizes.items():
        assert target[size] == pytest.approx(want[source])
        assert abs(taken[size] - target[size]) <= 130


def test_targets_stop_at_twice_the_size(spark):
    rows = [(k, "a", words(1), 0, 0) for k in range(2)] + [(10 + k, "b", words(100), 0, 0) for k in range(20)]
    plan = mixing.mix_plan(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.target for r in plan if r.source_size == 2} == {4.0}
    assert all(r.taken == 2 for r in plan if r.source_size == 2)


def test_the_mix_is_the_plan_and_reruns_agree(spark):
    df = spark.createDataFrame(corpus(2), SCHEMA)
    plan, mix = mixing.mix_plan(df), mixing.mix(df)
    assert mix.columns == [*df.columns, "copy_"]
    assert mix.count() == sum(r.copies for r in plan.collect())
    again = mixing.mix(df.repartition(7))
    key = ["doc_id", "copy_"]
    assert sorted(map(str, mix.where("doc_id is not null").select(*key).collect())) == sorted(
        map(str, again.where("doc_id is not null").select(*key).collect())
    )


def test_systematic_copies_follow_the_running_sum(spark):
    df = spark.createDataFrame([(k, "s", words(3), 0, 0) for k in range(100)], SCHEMA)
    rows = sorted(mixing.mix_plan(df, budget=0.37).collect(), key=lambda r: r.doc_id)
    running = 0
    for n, r in enumerate(rows, 1):
        running += r.copies
        assert abs(running - 0.37 * n) < 1
    assert math.isclose(rows[0].target, 0.37 * 300)


def test_empty_tables_and_empty_texts(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert mixing.mix_plan(none).collect() == [] and mixing.mix(none).collect() == []
    blank = mixing.mix_plan(spark.createDataFrame([(1, None, None, 0, 0), (2, "a", "", 0, 0)], SCHEMA)).collect()
    assert [(r.size, r.target, r.taken) for r in blank] == [(0, 0.0, 0)] * 2
