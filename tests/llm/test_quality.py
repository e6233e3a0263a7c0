import math
import re
import zlib

import numpy as np
import pytest

from velomart.llm import quality

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = {r.doc_id: r for r in quality.score_quality(docs, labels).collect()}
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 3 == 1) for k, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())
    tested = [(r.quality, rows[r.doc_id]) for r in labels.collect() if rows[r.doc_id].held_out]
    for label in (0, 1):
        right = [r.predicted == label for q, r in tested if q == label]
        assert np.mean(right) >= 0.95
    good = np.array([r.score for q, r in tested if q == 1])
    bad = np.array([r.score for q, r in tested if q == 0])
    assert (good[:, None] > bad[None, :]).mean() >= 0.98


def test_held_out_labels_change_nothing(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.withColumn("quality", (1 - labels.quality).cast("int")).where(quality.held_out(labels.doc_id))
    both = labels.where(~quality.held_out(labels.doc_id)).unionByName(flipped)
    one, other = quality.train(docs, labels), quality.train(docs, both)
    assert np.array_equal(one.weights, other.weights) and one.cut == other.cut


def test_the_cut_covers_all_labelled_rows_whatever_the_sample(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    learned = {r.doc_id: r.quality for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 != 1}
    text = {r.doc_id: r.text for r in docs.collect() if r.doc_id in learned}
    rows, bad = np.array([quality.features(t) for t in text.values()]), sum(learned[k] == 0 for k in text)
    assert bad > 40 and len(text) - bad > 40
    for per_class in (40, 4000):
        ranker = quality.train(docs, labels, per_class=per_class)
        scores = np.sort(quality.weighted(rows, ranker.weights))
        assert ranker.cut == (scores[bad - 1] + scores[bad]) / 2


def test_cut_among_ties_and_signs(spark):
    weights = np.eye(quality.N_FEATURES)[0]
    for scores in ([3.0, -2.0, 0.5, -0.0, 0.0, -1e-300, 7.0], [1.0] * 5 + [2.0], [-1.0, -1.0, 1.0, 1.0]):
        known = spark.createDataFrame([([x] + [0.0] * 10,) for x in scores], "x array<double>")
        for bad in range(1, len(scores)):
            low, high = sorted(scores)[bad - 1 : bad + 1]
            assert quality.quantile_cut(known, weights, bad) == (low + high) / 2


def test_fit_is_bradley_terry():
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(400, quality.N_FEATURES))
    good = rows[:, 0] + 0.3 * rng.normal(size=400) > 0.5
    ranker = quality.fit(rows[good], rows[~good])
    assert np.argmax(np.abs(ranker.weights)) == 0 and ranker.weights[0] > 0
    assert (ranker.score(rows) < 0.5).sum() == (~good).sum()


def test_edge_cases(spark):
    docs = spark.createDataFrame(
        [(1, None, 1), (None, "", 1), (2, "fine words here", 1), (2, "fine words here", 1), (3, "a " * 300_000, 1)],
        "doc_id long, text string, score int",
    )
    labels = spark.createDataFrame([(2, 1), (None, 0), (99, 0), (3, None)], "doc_id long, quality int")
    rows = quality.score_quality(docs, labels).collect()
    assert len(rows) == 5 and {(r.score, r.predicted) for r in rows} == {(0.5, 1)}
    assert [r.held_out for r in rows if r.doc_id is None] == [False]
    kept = quality.drop_low_quality(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 5
    assert quality.score_quality(docs.limit(0), labels.limit(0)).collect() == []
    known = spark.createDataFrame([(2, 1), (3, 0), (3, 0)], "doc_id long, quality int")
    learned = [r for r in (2, 3) if zlib.crc32(str(r).encode()) % 3 != 1]
    scores = {r.doc_id: r.score for r in quality.score_quality(docs, known).collect()}
    assert len(learned) < 2 or scores[2] > scores[3]


def plain_features(text):
    """The features word by word and character by character."""
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    if not words:
        return [0.0] * 10 + [1.0]
    size, n = len(text.encode()), len(words)
    among = lambda chars: math.sqrt(sum(c in chars for c in text) / size)
    again = sum(words[k] == words[k - 1] for k in range(1, n))
    triples = {(words[k], words[k + 1], words[k + 2]) for k in range(n - 2)}
    shouts, bars = text.count("!"), text.count("|")
    return [
        among("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        among("!#$%&*|@^~=+<>{}[]_/\\"),
        among("0123456789"),
        min(1.0, math.sqrt(shouts / n)),
        math.sqrt(min(1.0, bars / n)),
        math.sqrt(again / n),
        math.sqrt(1 - len(triples) / max(1, n - 2)),
        (n - len(set(words))) / n,
        math.log(size / n),
        math.log(n) / 10,
        0.0,
    ]


def test_every_score_is_that_of_plain_features(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    ranker = quality.train(docs, labels)
    scores = {r.doc_id: r.score for r in quality.score_quality(docs, labels).collect()}
    for r in docs.collect():
        z = sum(w * x for w, x in zip(ranker.weights, plain_features(r.text), strict=True)) - ranker.cut
        assert scores[r.doc_id] == pytest.approx(1 / (1 + math.exp(-max(-40, min(40, z)))), rel=1e-9)
    odd = [None, "", " \n", "a", "a b", "A A A !!! | 12", "É é" * 50, "x " * 999, "!|!|"]
    for text in odd:
        assert quality.features(text) == pytest.approx(plain_features(text))


def test_the_fit_is_the_least_loss_of_its_pairs():
    """The loss of all preference pairs, summed one by one, grows in every direction."""
    rng = np.random.default_rng(4)
    good, bad = rng.normal(0.4, 1, (60, quality.N_FEATURES)), rng.normal(0, 1.3, (50, quality.N_FEATURES))
    weights = quality.fit(good, bad).weights
    draw = np.random.default_rng(20)
    scale = np.concatenate([good, bad]).std(axis=0)
    n = min(quality.PAIRS, len(good) * len(bad))
    pairs = list(zip(draw.integers(0, len(good), n).tolist(), draw.integers(0, len(bad), n).tolist(), strict=True))

    def loss(w):
        chances = [math.log1p(math.exp(-sum(w * (good[g] - bad[b])))) for g, b in pairs]
        return sum(chances) / n + 0.5 * 1e-3 * sum((w * scale) ** 2)

    least = loss(weights)
    for _ in range(6):
        step = rng.normal(size=quality.N_FEATURES) * 0.02
        assert loss(weights + step) > least and loss(weights - step) > least
