import random
import re
from collections import Counter, defaultdict

import pytest

from velomart.llm import collocations as co

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def plain(rows, longest, least, top, contained=100):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in candidates.items():
            if any(
                len(q) > len(p) and 100 * b >= contained * a and any(q[i : i + len(p)] == p for i in range(len(q)))
                for q, b in candidates.items()
            ):
                continue
            score, cut = min((1000 * a * n[lang] // (counts[p[:c]] * counts[p[c:]]), c) for c in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), counts[p[:cut]], counts[p[cut:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(kept)[:top], 1):  # noqa: E741
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def rows_of(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()))


def corpus(seed):
    rng = random.Random(seed)
    words = ["a", "b", "c", "É", "é", "d-e", "x y", "\x1c"]
    out = []
    for _ in range(300):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t ", ". ", ",", "\n", "\x0c", " ;"]) for _ in range(rng.randint(0, 25)))
        out.append((rng.choice(["en", "en", None, "und", ""]), rng.choice([text, text, text.upper(), "A b C d-e a", None])))
    return out


@pytest.mark.parametrize("sent", [(1 << 18, 1 << 20), (0, 0), (1 << 18, 3)])
@pytest.mark.parametrize("block_bytes", [1, 700, 1 << 20])
def test_counts_cuts_and_containment(spark, sent, block_bytes):
    rows = corpus(block_bytes)
    docs = spark.createDataFrame(rows, "lang string, text string").selectExpr("*", "lang AS `block`", "text AS word", "1 AS n")
    got = co.collocations(docs, least=8, top=40, block_bytes=block_bytes, words_sent=sent[0], phrases_sent=sent[1])
    assert rows_of(got) == plain(rows, 5, 8, 40)


@pytest.mark.parametrize("contained", [60, 101])
def test_other_lengths_and_shares(spark, contained):
    rows = corpus(5)
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert rows_of(co.collocations(docs, longest=3, least=3, top=9, contained=contained)) == plain(rows, 3, 3, 9, contained)


def test_a_text_of_one_piece_and_a_long_one(spark):
    rows = [("en", "x y " * 40_000), ("en", "q w. " * 60_000), ("fr", "")]
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert rows_of(co.collocations(docs, block_bytes=1000)) == plain(rows, 5, 100, 2000)


def test_scores_beyond_64_bits(spark):
    words = "a: long, l: long, r: long, n: long"
    row = spark.createDataFrame([(10**12, 10**12, 10**12, 10**13)], words.replace(":", "")).selectExpr("*", "array(l) AS heads", "array(r) AS tails")
    assert row.select(co._scored(2).alias("c")).first().c.score == 10_000


def test_none(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert rows_of(co.collocations(empty)) == []
    assert rows_of(co.collocations(spark.createDataFrame([(None, None), ("en", "a b")], "lang string, text string"))) == []
