import numpy as np
import xxhash

from velomart.llm import simhash
from tests_llm_helpers import connected


def plain_fingerprint(text, k=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, radius):
    prints = [plain_fingerprint(text) for _, text in rows]
    n = len(rows)
    pairs = [(i, j) for i in range(n) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= radius]
    roots = connected(n, pairs)
    least = {}
    for k, root in enumerate(roots):
        if rows[k][0] is not None:
            least[root] = min(least.get(root, rows[k][0]), rows[k][0])
    return sorted(((rows[k][0], f"{prints[k]:016x}", least.get(roots[k])) for k in range(n)), key=str)


def corpus():
    rng = np.random.default_rng(4)
    vocabulary = [f"Wört{k}" for k in range(300)]
    rows = []
    for k in range(60):
        words = list(rng.choice(vocabulary, 120))
        rows.append((k, " ".join(words)))
        for copy in range(int(rng.integers(0, 4))):
            near = list(words)
            near[int(rng.integers(0, 120))] = "andere"
            rows.append((100 + 10 * k + copy, "\t".join(near)))
    rows += [(2000, None), (2001, ""), (2002, " \n "), (2003, "ein"), (2004, "EIN"), (2005, "zwei Wörter"), rows[3], (None, "x y z"), (None, rows[0][1])]
    return rows


def test_fingerprint_by_definition():
    for text in (None, "", "a", "A b", "a b c", "a  b\tc d e\x0bf", "é É", " ".join(map(str, range(5000)))):
        assert simhash.fingerprint(text, 3) == plain_fingerprint(text)


def test_bit_sliced_distances():
    rng = np.random.default_rng(1)
    for n in (1, 2, 64, 65, 300):
        for radius in (0, 1, 2, 3, 5):
            prints = rng.integers(0, 2**63, max(1, n // 8), dtype=np.uint64)[rng.integers(0, max(1, n // 8), n)]
            for _ in range(4):
                prints = prints ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64))
            i, j = simhash.close_pairs(prints, radius)
            near = np.triu(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= radius, 1)
            assert set(zip(i.tolist(), j.tolist())) == set(zip(*[x.tolist() for x in np.nonzero(near)]))


def found(spark, rows, radius):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, fp string, root int")
    got = simhash.near_duplicates(df, radius=radius).collect()
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=str)


def test_components_equal_brute_force(spark):
    rows = corpus()
    assert found(spark, rows, 2) == brute(rows, 2)
    assert found(spark, rows, 3) == brute(rows, 3)


def test_large_buckets_are_dealt_again(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 1)
    rows = corpus()
    assert found(spark, rows, 2) == brute(rows, 2)
    assert found(spark, rows, 3) == brute(rows, 3)


def test_one_row_of_each_component_stays(spark):
    rows = corpus()
    df = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, vm_file int").coalesce(1)
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    expected = sorted({(c if c is not None else -1) for _, _, c in brute(rows, 2)})
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in kept.collect()) == expected


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(df).collect() == []
    assert simhash.drop_near_duplicates(df).collect() == []
