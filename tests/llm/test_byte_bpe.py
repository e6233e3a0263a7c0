import hashlib
import random
import sys
import unicodedata

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from velomart.llm import byte_bpe, queries

NAME = "byte_bpe_50k.tiktoken"
RANKS = byte_bpe.read_ranks(public_tokenizers.path(NAME))
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def own(text):
    return [i for piece in byte_bpe.pre_tokens(text) for i in byte_bpe.merge(piece.encode(), RANKS)]


def test_the_pattern_is_the_vocabularys():
    assert public_tokenizers.PATTERN == byte_bpe.PATTERN


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=80))
def test_any_text(text):
    assert own(text) == LIBRARY.encode_ordinary(text)
    assert "".join(byte_bpe.pre_tokens(text)) == text


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abe '\t\n\r\x0b\x1c!1٣é'stlvr　 ", max_size=60))
def test_borders(text):
    assert own(text) == LIBRARY.encode_ordinary(text)


def test_characters_that_tables_of_different_age_class_differently():
    recent = [chr(c) for c in range(0x80, sys.maxunicode) if unicodedata.category(chr(c)) == "Cn" and byte_bpe.regex.match(r"\p{Assigned}", chr(c))]
    for char in random.Random(2).sample(recent, 300):
        text = f"a{char}b 1{char}2 !{char}? {char}"
        assert own(text) == LIBRARY.encode_ordinary(text)


@pytest.mark.parametrize("word", ["a" * 3000, "ab" * 2000, "=" * 999, "漢字" * 500, "the" * 700, "🙂" * 300])
def test_long_words_by_heap_and_by_steps(word):
    data = word.encode()
    assert byte_bpe._merge_long(data, RANKS) == LIBRARY.encode_ordinary(word)
    short = data[: byte_bpe.SHORT]
    assert byte_bpe.merge(short, RANKS) == ([RANKS[short]] if short in RANKS else byte_bpe._merge_long(short, RANKS))


def test_packed_numbers_come_back():
    for numbers in ([], [0], [1, 255, 256, 65_536, 2**32 - 1]):
        assert byte_bpe.unpack(byte_bpe.pack(np.array(numbers, np.uint32))).tolist() == numbers


def test_whole_table(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = queries.op11_byte_bpe(spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = LIBRARY.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_edge_cases_and_small_blocks(spark):
    rows = [(None, None, 1), (1, "", 2), (1, "", 2), (2, "<|endoftext|> a", 3), (None, "x y" * 50_000, 4), (3, "z" * 20_000, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, block int").selectExpr("*", "block AS ids", "block AS words")
    wanted = sorted(((i, LIBRARY.encode_ordinary(t or ""), (t or "").encode()) for i, t, _ in rows), key=str)
    for chars in (byte_bpe.BLOCK_CHARS, 1, 60_000):
        found = byte_bpe.decode(byte_bpe.encode(docs, NAME, block_chars=chars), NAME, decoded_col="as_text").collect()
        assert sorted(((r.doc_id, list(r.ids), bytes(r.as_text)) for r in found), key=str) == wanted
    packed = byte_bpe.encode_packed(docs, NAME, block_chars=1, bucket_rows=2, part_blocks=2)
    found = byte_bpe.decode(packed, NAME).collect()
    assert sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist(), bytes(r.decoded)) for r in found), key=str) == wanted
    both = byte_bpe.encode_packed(docs, NAME, block_chars=60_000, decoded=True).collect()
    assert sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist(), bytes(r.decoded)) for r in both), key=str) == wanted
    assert byte_bpe.encode(docs.limit(0), NAME).collect() == []
    none = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [bytes(r.decoded) for r in byte_bpe.decode(none, NAME).collect()] == [b"", b""]
    with pytest.raises(Exception, match="no token"):
        byte_bpe.decode(spark.createDataFrame([(1, [50_256])], "doc_id long, ids array<int>"), NAME).collect()
