"""The pipeline against a plain version of its five stages, and its stages on odd tables."""

import hashlib
import math
import zlib

import numpy as np
import pytest

import corpus_pipeline
from tests_llm_helpers import WORDS, brute_runs, connected
from velomart.llm import decontaminate, quality, simhash

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def plain_quality(docs, labels):
    text = {d["doc_id"]: d["text"] for d in docs}
    known = sorted({(r.doc_id, r.quality) for r in labels if r.doc_id in text})
    known = [(k, q) for k, q in known if zlib.crc32(str(k).encode()) % 3 != 1]
    rows = [np.array([quality.features(text[k]) for k, q in known if q == label]) for label in (1, 0)]
    ranker = quality.fit(*rows)
    return [d for d in docs if ranker.score(np.array([quality.features(d["text"])]))[0] >= 0.5]


def plain_lines(docs):
    kept = brute_runs([(d["doc_id"], d["text"]) for d in docs], 50)
    out = []
    for k, d in enumerate(docs):
        text, gone = kept[k]
        if not gone:
            out.append(d)
        elif WORDS.search(text):
            out.append(d | {"text": text, "n_chars": len(text)})
    return out


def plain_near(docs):
    prints = [simhash.fingerprint(d["text"], 3) for d in docs]
    n = len(docs)
    roots = connected(n, [(i, j) for i in range(n) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2])
    least = {}
    for k in range(n):
        least[roots[k]] = min(least.get(roots[k], docs[k]["doc_id"]), docs[k]["doc_id"])
    return [d for d in docs if d["doc_id"] in least.values()]


def plain_clean(docs, items):
    index = decontaminate.Index(items, 0.8, 0.99, 3, 5, 20)
    out = []
    for d in docs:
        tokens = index.tokens_of(decontaminate.words_of(d["text"]))
        if not any(decontaminate.nearest(t, tokens, e)[0] <= e for t, e in zip(index.tokens, index.edits)):
            out.append(d)
    return out


def plain_mix(docs):
    size = {d["doc_id"]: len(WORDS.findall(d["text"] or "")) for d in docs}
    by = {}
    for d in docs:
        by.setdefault(d["source"], []).append(d)
    names = sorted(by)
    total = {s: sum(size[d["doc_id"]] for d in by[s]) for s in names}
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    level, full = 0.0, set()
    while True:
        left = 1.5 * sum(total.values()) - 2 * sum(total[s] for s in full)
        level = left / sum(weight[s] for s in names if s not in full)
        now = {s for s in names if weight[s] * level >= 2 * total[s]}
        if now == full:
            break
        full = now
    out = []
    for s in names:
        rate = min(weight[s] * level, 2.0 * total[s]) / total[s]
        offset = int(hashlib.md5(f"={s}/20".encode()).hexdigest()[:5], 16) / (1 << 20)
        ordered = sorted(by[s], key=lambda d: (size[d["doc_id"]], d["doc_id"]))
        for n, d in enumerate(ordered):
            copies = math.floor(offset + (n + 1) * rate) - math.floor(offset + n * rate)
            out += [(d["doc_id"], k) for k in range(copies)]
    return out


def test_the_stages_equal_their_plain_versions(spark, sf_dir):
    from velomart.workspace import materialize

    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    labels = read("labels").collect()
    items = [(r.item_id, r.text) for r in read("benchmark").collect()]
    plain = {
        "quality_classifier": lambda docs: plain_quality(docs, labels),
        "line_dedup": plain_lines,
        "simhash_near_dedup": plain_near,
        "benchmark_decontamination": lambda docs: plain_clean(docs, items),
    }
    docs = read("documents")
    for name, stage in corpus_pipeline.STAGES:
        before = [r.asDict() for r in docs.collect()]
        docs = materialize(stage(spark, docs, sf_dir), name)
        rows = docs.collect()
        if name in plain:
            assert docs.columns == COLUMNS
            key = lambda d: d["doc_id"]
            assert sorted((r.asDict() for r in rows), key=key) == sorted(plain[name](before), key=key), name
            assert 0 < len(rows) <= len(before)
        else:
            assert sorted((r.doc_id, r.copy) for r in rows) == sorted(plain_mix(before))
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect())) == sorted(map(tuple, rows))


def test_the_stages_are_the_dealt_ones():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "source_mixing",
    ]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_odd_tables(spark, sf_dir, name, stage):
    schema = "doc_id long, text string, lang string, source string, n_chars int, copy int, kept_text string, id int"
    none = spark.createDataFrame([], schema)
    assert stage(spark, none, sf_dir).collect() == []
    rows = [(None, None, None, None, None, 1, "x", 2), (1, "", None, None, 0, 1, "x", 2), (1, "", None, None, 0, 1, "x", 2)]
    rows += [(5, "The of and to be is, with one more line.", "en", "src0", 40, 1, "x", 2)]
    rows += [(6, "of the " * 100_000, "en", "src0", 700_000, 1, "x", 2)]
    out = stage(spark, spark.createDataFrame(rows, schema), sf_dir)
    assert out.columns[:8] == none.columns
    kept = out.collect()
    assert all(r.kept_text == "x" and r.id == 2 for r in kept)
    assert name == "source_mixing" or any(r.doc_id == 5 for r in kept)
