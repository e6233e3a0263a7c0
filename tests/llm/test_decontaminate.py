import random

import numpy as np
import pyarrow as pa

from velomart.llm import decontaminate as d


def plain_edits(item, text):
    """Least edits between an item and any stretch of a text, cell by cell."""
    row = [0] * (len(text) + 1)
    for i, word in enumerate(item, 1):
        new = [i]
        for j, other in enumerate(text, 1):
            new.append(min(row[j - 1] + (word != other), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def edited(words, edits, rng):
    words = list(words)
    for n in range(edits):
        at, kind = rng.randrange(len(words)), rng.randrange(3)
        if kind == 0:
            words[at] = f"new{n}"
        elif kind == 1 and len(words) > 1:
            del words[at]
        else:
            words.insert(at, f"more{n}")
    return words


def data(n_docs=300, seed=3):
    rng = random.Random(seed)
    vocabulary = [f"wort{k}" for k in range(400)]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.randint(8, 60)))) for k in range(30)]
    docs = []
    for k in range(n_docs):
        words = rng.choices(vocabulary, k=rng.randint(0, 150))
        if k % 3 == 0:
            item = items[k % 30][1].split()
            planted = edited(item, rng.randint(0, d.allowed_edits(len(item), 0.8)), rng)
            at = rng.randrange(len(words) + 1)
            words = words[:at] + planted + words[at:]
        docs.append((k, " ".join(words).title() + "."))
    return items, docs


def frames(spark, items, docs):
    return (
        spark.createDataFrame([(*r, 0) for r in docs], "doc_id long, text string, extra int"),
        spark.createDataFrame(items, "item_id long, text string"),
    )


def brute(items, docs):
    out = {}
    for doc, text in docs:
        for item, passage in items:
            words = d.words_of(passage)
            if len(words) >= 5:
                edits = plain_edits(words, d.words_of(text))
                if edits <= d.allowed_edits(len(words), 0.8):
                    out[doc, item] = edits
    return out


def test_recall_and_precision_against_brute_force(spark):
    items, docs = data()
    expected = brute(items, docs)
    rows = d.contaminated(*frames(spark, items, docs)).collect()
    got = {(r.doc_id, r.item_id): r.edits for r in rows}
    assert all(expected[key] == edits for key, edits in got.items())
    assert len(got) >= 0.95 * len(expected) > 90


def test_exact_copies_are_always_found(spark):
    items, _ = data()
    docs = [(k, f"before it, {text.upper()}! after it") for k, text in items]
    got = {(r.doc_id, r.item_id, r.edits) for r in d.contaminated(*frames(spark, items, docs)).collect()}
    assert {(k, k, 0) for k, _ in items} <= got


def test_nearest_stretch():
    rng = np.random.default_rng(2)
    for _ in range(200):
        item = rng.integers(2, 6, rng.integers(1, 8)).astype(np.uint64)
        text = rng.integers(2, 6, rng.integers(0, 15)).astype(np.uint64)
        edits, first = d.nearest(item, text, len(item))
        assert edits == plain_edits(list(item), list(text))
        assert any(plain_whole(item, text[first:end]) == edits for end in range(first, len(text) + 1))


def plain_whole(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[j - 1] + 1))
        row = new
    return row[-1]


def test_several_blocks_of_items_give_the_same(spark):
    items, docs = data(120)
    tables = frames(spark, items, docs)
    whole = {(r.doc_id, r.item_id) for r in d.contaminated(*tables).collect()}
    parts = {(r.doc_id, r.item_id) for r in d.contaminated(*tables, block_chars=2000).collect()}
    assert len(whole ^ parts) <= 0.05 * len(whole)
    clean = d.drop_contaminated(*tables, block_chars=2000)
    assert "MapInArrow" not in clean._jdf.queryExecution().executedPlan().toString()
    assert clean.columns == tables[0].columns
    assert {r.doc_id for r in clean.collect()} == {doc for doc, _ in docs} - {doc for doc, _ in parts}


def test_codes_of_a_table_are_those_of_each_part():
    items, _ = long_items([15, 20, 30, 45, 59, 64, 200])
    index = d.Index(items, 0.8, 0.99, 3, 5, 20)
    for c in index.classes:
        own = [(int(code), k) for k in c.members for code in d.embed(index.parts[k], np.zeros(1, np.int64), c)[:, 0]]
        assert sorted(zip(map(int, c.codes), c.owners.tolist(), strict=True)) == sorted(own)


def test_edge_cases(spark):
    items = [(1, "one two three four five six"), (2, None), (3, ""), (4, "too short"), (1, "one two three four five six")]
    text = "x one two three four five six y"
    docs = [(1, text), (1, text), (None, text), (2, None), (3, ""), (4, "word " * 200_000 + text)]
    rows = d.contaminated(*frames(spark, items, docs)).collect()
    assert sorted(str(r.doc_id) for r in rows) == ["1", "1", "4", "None"] and {r.item_id for r in rows} == {1}
    none = frames(spark, [], docs)
    assert d.contaminated(*none).collect() == [] and d.drop_contaminated(*none).count() == len(docs)
    assert d.contaminated(*frames(spark, items, [])).collect() == []
    clean = d.drop_contaminated(*frames(spark, items, docs))
    assert clean.columns == ["doc_id", "text", "extra"]
    assert sorted(r.doc_id for r in clean.collect()) == [2, 3]


def test_documents_do_not_run_into_each_other():
    index = d.Index([(1, "one two three four five six seven eight nine ten")], 0.8, 0.99, 3, 5, 20)
    texts = pa.array(["one two three four five six", "seven eight nine ten", "seven eight nine ten"])
    assert list(d._found(index, texts)) == []


def exactly_edited(words, edits, rng):
    """That many words of ``words``, all at different places, substituted, deleted or preceded by a new one."""
    words = list(words)
    for at in sorted(rng.sample(range(len(words)), edits), reverse=True):
        kind = rng.randrange(3)
        words[at : at + (kind != 2)] = [f"new{at}"] if kind != 1 else []
    return words


def long_items(sizes, seed=11):
    rng = random.Random(seed)
    vocabulary = [f"wort{k}" for k in range(5000)]
    items = [(k, " ".join(rng.choices(vocabulary, k=n))) for k, n in enumerate(sizes)]
    texts = []
    for _, text in items:
        words = text.split()
        planted = exactly_edited(words, d.allowed_edits(len(words), 0.8), rng)
        texts.append(" ".join([*rng.choices(vocabulary, k=90), *planted, *rng.choices(vocabulary, k=90)]))
    return items, texts


def test_long_items_are_found_at_the_threshold():
    sizes = [65, 100, 129, 300, 1000, 1000] + [1600] * 6 + [3200] * 6
    items, texts = long_items(sizes)
    index = d.Index(items, 0.8, 0.99, 3, 5, 20)
    found = {(row[0], row[1]): row for row in d._found(index, pa.array(texts))}
    assert set(found) == {(k, k) for k in range(len(sizes))}
    for (k, _), (_, _, edits, first, size) in found.items():
        assert edits <= d.allowed_edits(sizes[k], 0.8) and abs(first - 90) <= 20 and size == sizes[k]
    over = " ".join(exactly_edited(items[5][1].split(), 300, random.Random(1)))
    piece = " ".join(items[5][1].split()[100:300])
    assert list(d._found(index, pa.array([over, piece]))) == []


def test_an_item_beside_a_copy_of_one_of_its_parts():
    items, texts = long_items([400])
    index = d.Index(items, 0.8, 0.99, 3, 5, 20)
    part = " ".join(items[0][1].split()[150:260])
    for text in (f"{part} {texts[0]}", f"{texts[0]} {part}", " ".join(texts[0].split()[90:-90])):
        (row,) = d._found(index, pa.array([text]))
        assert row[2] == plain_edits(items[0][1].split(), text.split())


def test_every_class_meets_the_recall_it_promises():
    items, _ = long_items([15, 20, 30, 45, 59, 64, 200, 1500])
    index = d.Index(items, 0.8, 0.99, 3, 5, 20)
    assert all(c.recall >= 0.99 and c.longest <= d.PART_WORDS for c in index.classes)
