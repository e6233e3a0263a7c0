import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from velomart.llm.token_counts import WordBpe, token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY, OWN = Tokenizer.from_file(PATH), WordBpe(PATH)


def library_count(text):
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    assert OWN.text(text, 10)[1] == library_count(text)


def test_every_prefix_of_words():
    rng = random.Random(3)
    for _ in range(300):
        word = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzeeaatt") for _ in range(rng.randint(1, 30)))
        assert OWN.prefix_counts(word)[1:] == [library_count(word[:k]) for k in range(1, len(word) + 1)]


@pytest.mark.parametrize(
    "text",
    ["<|endoftext|>", "a<|startoftext|>b <|endoftext|>", "<|endoftext", "É e\u0301 'S don't I'LL", "١٢3 ①", "\x1c\x00 \u200b\ufeff", "x" * 5000, "🙂🙂 漢字"],
)
def test_special_and_odd_texts(text):
    assert OWN.text(text, 10)[1] == library_count(text)


def longest_beginning(text, limit):
    """Bytes of the longest prefix that the library gives ``limit`` tokens at most, by trying all."""
    return max(len(text[:k].encode()) for k in range(len(text) + 1) if library_count(text[:k]) <= limit)


def test_truncation_keeps_the_longest_beginning():
    rng = random.Random(5)
    for k in range(150):
        alphabet = ["abcé!", "abcdefghij'stlved ", "漢字かな", "🙂👍a1", "ABCxyz019+/"][k % 5]
        words = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 25))) for _ in range(12)]
        text = rng.choice(["", "  "]) + rng.choice([" ", "", "\n "]).join(words)
        for limit in (0, 1, 7, 20):
            assert OWN.text(text, limit)[2] == longest_beginning(text, limit), (text, limit)


@pytest.mark.parametrize("text", ["漢字仮名交じり文" * 600, "QmFzZTY0IGlz+/" * 500, "🙂🤖🎉" * 400, "a" * 5000, "don't'll've" * 300, "1234567890" * 300])
def test_truncation_of_long_texts_without_white_space(text):
    limit = 300
    kept = OWN.text(text, limit)[2]
    head = text.encode()[:kept].decode()
    assert kept and library_count(head) <= limit
    after = len(head)
    assert all(library_count(text[:k]) > limit for k in range(after + 1, min(len(text), after + 60) + 1))


def test_special_strings_and_marks_are_not_parted():
    text = "ab <|endoftext|>cd e\u0301e\u0301e\u0301zz"
    for limit in range(8):
        head = text.encode()[: OWN.text(text, limit)[2]].decode()
        assert library_count(head) <= limit
        assert "<|" not in head or "<|endoftext|>" in head
        assert not text[len(head) :].startswith("\u0301")


def test_tables_hold_bounded_bytes():
    from velomart.llm.token_counts import KEY_BYTES, TABLE_BYTES, Table

    table = Table()
    for k in range(100_000):
        table.keep(f"{k}" * 30, k)
    assert sum(map(len, table)) <= TABLE_BYTES and sum(map(len, table.old)) <= TABLE_BYTES
    table.keep("x" * (KEY_BYTES + 1), 1)
    assert "x" * (KEY_BYTES + 1) not in table


def test_whole_table_and_edge_cases(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r.doc_id: r for r in token_counts(docs).collect()}
    for r in docs.collect():
        n = library_count(r.text)
        assert (got[r.doc_id].n_bytes, got[r.doc_id].n_tokens, got[r.doc_id].over_limit) == (len(r.text.encode()), n, n > 2048)
    odd = spark.createDataFrame([(None, None, 1), (1, "", 1), (1, "", 1), (2, "word " * 100_000, 1)], "doc_id long, text string, id int")
    rows = sorted(map(tuple, token_counts(odd).collect()), key=str)
    assert rows == [(1, 0, 0, False, 0), (1, 0, 0, False, 0), (2, 500_000, 100_000, True, 5 * 2048), (None, 0, 0, False, 0)]
    assert token_counts(odd.limit(0)).collect() == []
