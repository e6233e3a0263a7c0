import math

import numpy as np
import pytest

from velomart.llm import topk


def brute(rows, query_ids, k):
    whole = []
    for key, v in rows:
        if key is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        item = (key, tuple(math.floor(64 * x) for x in v))
        if item not in whole:
            whole.append(item)
    out = []
    for q in sorted(query_ids):
        own = sorted(v for key, v in whole if key == q)
        if own:
            scores = [(-sum(a * b for a, b in zip(own[0], v)), key) for key, v in whole if key != q and len(v) == len(own[0])]
            edge = (1 << 63) - 1
            out += [(q, n + 1, key, max(-edge, min(edge, -s))) for n, (s, key) in enumerate(sorted(scores)[:k])]
    return out


def check(spark, rows, step=5, k=7):
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, score int, id int").selectExpr("*", "1 AS v", "1 AS dim", "1 AS beyond", "1 AS vm_row")
    got = topk.top_k(df, df.where(f"vec_id % {step} = 0"), k=k)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    wanted = brute(rows, {key for key, _ in rows if key is not None and key % step == 0}, k)
    assert sorted(tuple(r) for r in got.collect()) == sorted(wanted)


@pytest.mark.parametrize("sizes", [(16_384, 4_096), (40, 9)])
def test_equals_brute_force(spark, monkeypatch, sizes):
    monkeypatch.setattr(topk, "SHARD_ROWS", sizes[0])
    monkeypatch.setattr(topk, "BLOCK_ROWS", sizes[1])
    rng = np.random.default_rng(6)
    rows = [(k, rng.normal(size=4).round(1).tolist()) for k in range(200)]
    rows += [(900 + k, rows[3][1]) for k in range(40)] + [rows[5], (7, rows[8][1]), (10, [0.0] * 4)]
    rows += [(300, None), (301, [1.0, None, 0.0, 0.0]), (305, [float("nan")] * 4), (310, [float("inf")] * 4)]
    rows += [(None, rows[0][1]), (315, [1.0, 2.0]), (316, [2.0, 2.0]), (320, []), (321, [])]
    check(spark, rows)


def test_large_components_are_exact(spark):
    check(spark, [(k, [float(10**7 + k), float(-(10**6) * k)]) for k in range(30)])


@pytest.mark.parametrize("sizes", [(16_384, 4_096), (10, 5)])
def test_finite_components_of_any_size(spark, monkeypatch, sizes):
    monkeypatch.setattr(topk, "SHARD_ROWS", sizes[0])
    monkeypatch.setattr(topk, "BLOCK_ROWS", sizes[1])
    rng = np.random.default_rng(2)
    rows = []
    for k, size in enumerate([1e-3, 1.0, 1e4, 1e6, 1e8, 1e8 + 0.3, 1e12, 1e17, 2.0**56, 1e300, 1e300] * 6):
        rows.append((k, (rng.normal(size=3) * size).tolist()))
    rows += [(200 + k, [1e9 + k, 1e9, -1e9 - k]) for k in range(12)] + [(250, [1e300, 1e300, -1e300]), (251, [0.0] * 3)]
    check(spark, rows)
    check(spark, [(k, [-(2.0 ** (30 + k)), 2.0**31]) for k in range(40)])


def test_order_of_whole_numbers_as_bytes():
    numbers = sorted({s * (2**e + d) for e in (0, 7, 8, 63, 64, 200) for d in (-1, 0, 1) for s in (1, -1)})
    assert sorted(numbers, key=topk._ordered) == numbers


def test_leaves_are_pruned_without_loss():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 8)) * 400
    points = np.floor(centres[rng.integers(0, 20, 3000)] + rng.normal(size=(3000, 8)) * 20)
    ids = rng.permutation(3000).astype(np.int64)
    queries, own = points[:50], ids[:50]
    floor = np.full(50, topk._NONE, np.int64)
    got = {int(own[q]): list(zip(s.tolist(), w.tolist())) for q, w, s in topk.search(queries, own, floor, points, ids, 9)}
    for q in range(50):
        scores = (points @ queries[q]).astype(np.int64)
        best = sorted((-int(s), int(i)) for s, i in zip(scores, ids) if i != own[q])[:9]
        assert got[int(own[q])] == [(-s, i) for s, i in best]


def test_empty_and_single_tables(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert topk.top_k(none, none).collect() == []
    one = spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<double>")
    assert topk.top_k(one, one).collect() == [] and topk.top_k(one, none).collect() == []
