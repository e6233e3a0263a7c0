"""Quality classifier: Bradley-Terry ranking of labelled pairs, cut at a score quantile.

Each preference pair is a good and a bad labelled document. The model gives every document the
score ``w . x`` of its features, and the pair the chance ``1 / (1 + exp(-(w . (x_good - x_bad))))``
that the good one wins; ``w`` minimises the logistic loss over the pairs plus a small ridge. The
cut is the quantile of the scores of all labelled documents that are not held out at the share
of bad labels among them, and a score becomes a number between 0 and 1 by its distance from it.

Features describe the whole text and nothing else. They are made and scored where the rows
are; of the labelled rows they are stored once, and no text is shuffled. Only the fit of the
weights is bounded: at most ``per_class`` labelled documents of either class, those with the
least hashes, and ``PAIRS`` pairs of them. The cut is exact at every size: it is found by
counts of score keys, 16 bits at a time.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velomart.llm.common import filter_in_arrow
from velomart.workspace import materialize

#: Labelled documents of either class that the fit may use.
PER_CLASS = 4000
#: Preference pairs drawn from them.
PAIRS = 60_000
HOLD_OUT_PARTS, HOLD_OUT = 3, 1
_UPPER = string.ascii_uppercase.encode()
_DIGITS = string.digits.encode()
_SYMBOLS = b"!#$%&*|@^~=+<>{}[]_/\\"


def features(text: str | None) -> list[float]:
    """Shares of a whole text: letter case, symbols, digits, repetition, and its sizes."""
    data = text.encode() if text else b""
    words = data.split()
    if not words:
        return [0.0] * 10 + [1.0]
    size, n = len(data), len(words)

    def share(of: bytes) -> float:
        return ((size - len(data.translate(None, of))) / size) ** 0.5

    repeated = sum(map(bytes.__eq__, words, words[1:])) / n
    triples = 1 - len(set(zip(words, words[1:], words[2:], strict=False))) / max(1, n - 2)
    return [
        share(_UPPER),
        share(_SYMBOLS),
        share(_DIGITS),
        (data.count(b"!") / n) ** 0.5 if data.count(b"!") < n else 1.0,
        min(1.0, data.count(b"|") / n) ** 0.5,
        repeated**0.5,
        max(0.0, triples) ** 0.5,
        1 - len(set(words)) / n,
        float(np.log(size / n)),
        float(np.log(n)) / 10,
        0.0,
    ]


N_FEATURES = len(features(None))


@dataclass
class Ranker:
    """Weights on raw features and the score at the cut."""

    weights: np.ndarray
    cut: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(weighted(rows, self.weights) - self.cut, -40, 40)))


def weighted(rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """``rows @ weights``, to the last bit the same however rows are put into batches."""
    out = np.zeros(len(rows))
    for k, weight in enumerate(weights):
        out += rows[:, k] * weight
    return out


def fit(good: np.ndarray, bad: np.ndarray, ridge: float = 1e-3, seed: int = 20) -> Ranker:
    """Newton steps on the mean logistic loss of feature differences.

    Without labels of either class there is no pair: every score is one half.
    """
    if not len(good) or not len(bad):
        return Ranker(np.zeros(N_FEATURES), 0.0)
    rng = np.random.default_rng(seed)
    both = np.concatenate([good, bad])
    scale = both.std(axis=0)
    scale[scale == 0] = 1.0
    pairs = min(PAIRS, len(good) * len(bad))
    diff = (good[rng.integers(0, len(good), pairs)] - bad[rng.integers(0, len(bad), pairs)]) / scale
    w = np.zeros(N_FEATURES)
    for _ in range(40):
        lost = 1 / (1 + np.exp(np.clip(diff @ w, -40, 40)))
        slope = -(diff * lost[:, None]).mean(axis=0) + ridge * w
        curve = (diff * (lost * (1 - lost))[:, None]).T @ diff / pairs + ridge * np.eye(N_FEATURES)
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    w = w / scale
    scores = np.sort(weighted(both, w))
    at = len(bad)  # the quantile at the share of bad labels, between its two neighbours
    return Ranker(w, float((scores[at - 1] + scores[at]) / 2))


def _feature_batches():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            found = pa.array([features(texts[k].as_py()) for k in range(len(texts))], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], found], names=[*batch.schema.names[:-1], "x"]
            )

    return run


def _scores(ranker: Ranker, texts: pa.Array) -> np.ndarray:
    rows = np.array([features(texts[k].as_py()) for k in range(len(texts))], np.float64)
    return ranker.score(rows.reshape(-1, N_FEATURES))


def _score_batches(ranker: Ranker):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(_scores(ranker, batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), scores], names=["id", "score"])

    return run


def _order_keys(scores: np.ndarray) -> np.ndarray:
    """Longs in the order of the doubles; the same again turns them back."""
    bits = (scores + 0.0).view(np.int64)  # no negative zero
    return bits ^ ((bits >> 63) & np.int64((1 << 63) - 1))


def _score_of(key: int) -> float:
    bits = np.array([key], np.int64)
    return float((bits ^ ((bits >> 63) & np.int64((1 << 63) - 1))).view(np.float64)[0])


def _key_batches(weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array(batch.column(0).to_pylist(), np.float64).reshape(-1, N_FEATURES)
            keys = pa.array(_order_keys(weighted(rows, weights)), pa.int64())
            yield pa.RecordBatch.from_arrays([keys], names=["key"])

    return run


def _good_batches(ranker: Ranker, place: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_scores(ranker, batch.column(place)) >= 0.5))

    return run


def held_out(id_col: Column) -> Column:
    """Whether a document is kept from the fit; a null id is not."""
    part = F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(HOLD_OUT_PARTS))
    return F.coalesce(part == HOLD_OUT, F.lit(False))


def quantile_cut(known: DataFrame, weights: np.ndarray, bad: int) -> float:
    """The middle between the ``bad`` lowest scores of all rows of ``known`` and the others.

    Each step counts the next 16 bits of the score keys that can still be the place looked
    for, so a step returns 65 536 counts at most.
    """
    keys = materialize(known.select("x").mapInArrow(_key_batches(weights), "key long"), "quality_keys")
    below, found = 0, None
    for shift in (48, 32, 16, 0):
        left = keys if found is None else keys.where(F.shiftright("key", shift + 16) == found)
        for r in left.groupBy(F.shiftright("key", shift).alias("part")).count().orderBy("part").collect():
            found, here = r["part"], r["count"]
            if below + here >= bad:
                break
            below += here
    above = found if below + here > bad else keys.where(F.col("key") > found).agg(F.min("key")).first()[0]
    return (_score_of(found) + _score_of(above)) / 2


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    per_class: int = PER_CLASS,
) -> Ranker:
    """The ranker of the labelled rows that are not held out: weights of a sample, cut of all.

    Null ids and labels other than 0 and 1 are not learned from; a label for a document that
    is not there, and a repeated label, mean nothing more. A repeated document counts once.
    """
    known = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("label"))
    learned = F.col("id").isNotNull() & ~held_out(F.col("id"))
    known = known.where(learned & F.col("label").isin(0, 1)).distinct()
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    made = rows.where(learned).mapInArrow(_feature_batches(), f"id {kind}, x array<double>")
    made = made.groupBy("id").agg(F.min("x").alias("x"))
    known = materialize(made.join(known, "id").select("id", "label", "x"), "quality_features")
    order = [F.xxhash64(F.col("id").cast("string")), F.col("id")]
    sample = known.where("label = 0").orderBy(*order).limit(per_class).unionByName(
        known.where("label = 1").orderBy(*order).limit(per_class)
    )
    found = sorted(sample.collect(), key=lambda r: (r.id, r.label))
    by_class = [np.array([r.x for r in found if r.label == label], np.float64) for label in (1, 0)]
    ranker = fit(*[x.reshape(-1, N_FEATURES) for x in by_class])
    if all(map(len, by_class)):
        ranker.cut = quantile_cut(known, ranker.weights, known.where("label = 0").count())
    return ranker


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    per_class: int = PER_CLASS,
) -> DataFrame:
    """(id, held_out, score, predicted) of every row; see ``train`` for what is learned.

    Null and blank texts have a score like any other, of the features of an empty text. Rows
    are independent, so null and repeated ids are kept. An empty document table gives no rows;
    without labels of both classes every score is one half. Other columns are not read.
    """
    ranker = train(docs, labels, id_col, text_col, label_col, per_class)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    scored = rows.mapInArrow(_score_batches(ranker), f"id {kind}, score double")
    return scored.select(
        F.col("id").alias(id_col),
        held_out(F.col("id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def drop_low_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    per_class: int = PER_CLASS,
) -> DataFrame:
    """The rows of ``docs`` that are predicted good, all columns."""
    ranker = train(docs, labels, id_col, text_col, label_col, per_class)
    return filter_in_arrow(docs, _good_batches(ranker, docs.columns.index(text_col)))
