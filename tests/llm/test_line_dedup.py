import random

import pytest

from tests_llm_helpers import brute_runs
from velomart.llm import line_dedup


def removed(spans):
    return [p for s in spans for p in range(s.lo, s.hi)]


def check(spark, docs, min_words, repartition=1):
    df = spark.createDataFrame(
        [(a, b, k, "x") for k, (a, b) in enumerate(docs)], "doc_id long, text string, line int, kept_text string"
    ).coalesce(repartition)
    out = line_dedup.dedup_lines(df, min_words=min_words)
    assert out.columns == ["doc_id", "text", "line", "kept_text", "kept_text_", "deleted_spans"]
    got = {r.line: (r.kept_text_, removed(r.deleted_spans)) for r in out.collect()}
    assert got == brute_runs(docs, min_words)


@pytest.mark.parametrize("seed, min_words", [(1, 10), (2, 6), (3, 1)])
def test_equals_every_run_tried(spark, seed, min_words):
    rng = random.Random(seed)
    pool = [" ".join([f"w{k}"] * rng.choice([0, 1, 2, 3, 5, 8])) for k in range(12)]
    docs = []
    for k in range(50):
        text = "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 12)))
        docs.append((rng.choice([k, k, k, None, 7]), None if k % 17 == 0 else text))
    check(spark, docs + docs[:5], min_words)


def test_long_runs_need_several_doublings(spark):
    rng = random.Random(5)
    shared = [f"one{k}" for k in range(40)]
    docs = [(k, "\n".join([f"own{k}", *shared[rng.randint(0, 4) :], f"end{k}"])) for k in range(8)]
    check(spark, docs, 30)


def test_a_line_in_most_documents(spark):
    hot = " ".join(["common"] * 12)
    docs = [(k, f"{hot}\nown line {k} with some words") for k in range(300)]
    check(spark, docs, 10)


def test_empty_table_and_copies_inside_one_text(spark):
    assert line_dedup.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    check(spark, [(1, "a b c\na b c\na b c"), (1, "a b c"), (None, ""), (2, "\n\n")], 3)
