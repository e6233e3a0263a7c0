"""Byte-level BPE: every distinct pre-token of the corpus is encoded once.

A text is cut into pre-tokens, and each is merged by the ranks of a vocabulary file. Pre-tokens
repeat all over a corpus, so they are exploded with their positions, shuffled by pre-token, and
encoded where equal ones meet; the ids go back by block, and positions put them in order.

Before the shuffle the exploded rows are aggregated. Whole texts are gathered to blocks of
bounded size, and a block holds each of its distinct pre-tokens once, with a number that stands at
each position. Only (block, number, pre-token) is dealt by the hash of the pre-token, packed by
bucket; the positions go once, packed, to the task that puts the block together again.

The number of buckets grows with the rows to deal, and a bucket holds the rows of about
``BLOCKS`` blocks at most, so a pre-token that occurs everywhere adds so many rows to a bucket at most.
Above that many blocks it is encoded once for each ``BLOCKS`` of them.

Decoding joins ids with the table of token bytes. That table has one row per token of the
vocabulary file, its size is checked, and it is broadcast.
"""

from __future__ import annotations

import base64
import heapq
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velomart.llm.blocks import (
    Codes,
    block_numbers,
    gather,
    pack,
    pack_bytes,
    pack_ids,
    unpack,
    unpack_bytes,
    unpack_ids,
)
from velomart.workspace import materialize

#: A block ends with the text that brings it to so many characters or rows.
BLOCK_CHARS, BLOCK_ROWS = 32 << 20, 1 << 16
#: Positions of a block are packed, and put in order, so many at a time; a text is not parted.
PIECE = 1 << 20
#: A bucket holds about so many (block, pre-token) rows, from so many blocks at most.
BUCKET_ROWS, BLOCKS = 1 << 20, 1 << 20
#: Most bytes of a table of token bytes that is broadcast; vocabularies hold a few hundred kB.
TABLE_BYTES = 64 << 20
#: Pre-tokens of more bytes are merged with a heap.
SHORT = 48

# fixed values: the pattern of the vocabulary, and the same for texts of ASCII alone
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII)
_ANY = regex.compile(PATTERN)


@lru_cache(maxsize=1 << 16)
def _stand_in(char: str) -> str:
    """A letter, digit or sign of the class that the library gives a character.

    Character tables of different age part on recent characters only, so the library is asked
    for those: it merges a letter, digit or sign with the first byte of a character if no border
    of pre-tokens lies between.
    """
    import tiktoken

    first = char.encode()[:1]
    ranks = {bytes([b]): b for b in range(256)} | {p + first: 256 + k for k, p in enumerate((b"a", b"1", b"!"))}
    probe = tiktoken.Encoding("probe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return next((p for p in "a1!" if probe.encode_ordinary(p + char)[0] >= 256), "\u3000")


def pre_tokens(text: str) -> list[str]:
    """The pieces of ``text`` that are encoded on their own; joined they are the text."""
    if text.isascii():
        return _ASCII.findall(text)
    recent = {c for c in set(text) if unicodedata.category(c) == "Cn"}
    if not recent:
        return _ANY.findall(text)
    shadow = text.translate({ord(c): _stand_in(c) for c in recent})
    return [text[m.start() : m.end()] for m in _ANY.finditer(shadow)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the pair of lowest rank is merged first, the leftmost of equals."""
    if word in ranks:
        return [ranks[word]]
    if len(word) > SHORT:
        return _merge_long(word, ranks)
    none, get = len(ranks) + (1 << 32), ranks.get
    cuts = list(range(len(word) + 1))
    pairs = [get(word[i : i + 2], none) for i in range(len(word) - 1)]
    while pairs:
        best = min(pairs)
        if best == none:
            break
        at = pairs.index(best)
        del cuts[at + 1], pairs[at]
        if at < len(pairs):
            pairs[at] = get(word[cuts[at] : cuts[at + 2]], none)
        if at:
            pairs[at - 1] = get(word[cuts[at - 1] : cuts[at + 1]], none)
    return [ranks[word[i:j]] for i, j in zip(cuts, cuts[1:], strict=False)]


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same in n log n steps: a heap of pairs over a linked list of parts."""
    n = len(word)
    end = list(range(1, n + 1))  # where the part that starts here ends; 0 if none starts here
    before = list(range(-1, n - 1))
    heap: list[tuple[int, int, int]] = []

    def offer(start: int) -> None:
        middle = end[start]
        if middle < n:
            rank = ranks.get(word[start : end[middle]])
            if rank is not None:
                heapq.heappush(heap, (rank, start, end[middle]))

    for start in range(n - 1):
        offer(start)
    while heap:
        rank, start, stop = heapq.heappop(heap)
        middle = end[start]
        if not middle or middle >= n or end[middle] != stop or ranks.get(word[start:stop]) != rank:
            continue
        end[start], end[middle] = stop, 0
        if stop < n:
            before[stop] = start
        offer(start)
        if before[start] >= 0:
            offer(before[start])
    out, at = [], 0
    while at < n:
        out.append(ranks[word[at : end[at]]])
        at = end[at]
    return out


@lru_cache(maxsize=2)
def _ranks_of_worker(name: str) -> dict[bytes, int]:
    import public_tokenizers

    return read_ranks(public_tokenizers.path(name))


_BLOCK = {
    "block": (T.LongType(), pa.int64()),
    "sizes": (T.ArrayType(T.IntegerType()), pa.list_(pa.int32())),
    "pieces": (T.ArrayType(T.BinaryType()), pa.list_(pa.binary())),
    "texts": (T.ArrayType(T.IntegerType()), pa.list_(pa.int32())),
    "words": (T.BinaryType(), pa.binary()),
    "n_words": (T.LongType(), pa.int64()),
}


class _Block:
    """What a task gathers: ids, pre-tokens per text, packed numbers by position, pre-tokens."""

    def __init__(self) -> None:
        self.words, self.ids, self.sizes, self.chars = Codes(), [], [], 0
        self.pieces: list[bytes] = []
        self.texts: list[int] = []
        self._open: list[np.ndarray] = []
        self._tokens = 0

    def add(self, key: pa.Array, text: str) -> None:
        cut = pre_tokens(text)
        self.ids.append(key)
        self.sizes.append(len(cut))
        self.chars += len(text)
        self._open.append(np.fromiter(map(self.words.__getitem__, cut), np.uint32, len(cut)))
        self._tokens += len(cut)
        if self._tokens >= PIECE:
            self._close()

    def _close(self) -> None:
        self.pieces.append(pack(np.concatenate(self._open)))
        self.texts.append(len(self._open))
        self._open, self._tokens = [], 0

    def row(self, number: int) -> pa.RecordBatch:
        if self._open:
            self._close()
        words = pack_bytes([w.encode() for w in self.words])
        values = (number, self.sizes, self.pieces, self.texts, words, len(self.words))
        columns = [pa.array([v], kind) for v, (_, kind) in zip(values, _BLOCK.values(), strict=True)]
        ids = pa.ListArray.from_arrays([0, len(self.ids)], pa.concat_arrays(self.ids))
        return pa.RecordBatch.from_arrays([*columns, ids], names=[*_BLOCK, "ids"])


def _cut(block_chars: int):
    """(id, text) rows to blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = block_numbers()
        block = _Block()
        for batch in batches:
            for i, value in enumerate(batch.column(1)):
                block.add(batch.column(0).slice(i, 1), value.as_py() or "")
                if block.chars >= block_chars or len(block.sizes) >= BLOCK_ROWS:
                    yield block.row(next(numbers))
                    block = _Block()
        if block.sizes:
            yield block.row(next(numbers))

    return run


def _deal(buckets: int):
    """(part, block, words) to one row per bucket: the pre-tokens of a bucket and their numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, block, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = unpack_bytes(packed)
                dealt = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)) % np.uint64(buckets)
                order = np.argsort(dealt, kind="stable")
                ends = np.flatnonzero(np.diff(dealt[order], append=np.uint64(buckets)))
                rows, lo = [], 0
                for hi in (ends + 1).tolist():
                    codes = order[lo:hi]
                    steps = pack(np.diff(codes, prepend=0))
                    rows.append((int(dealt[codes[0]]), part, block, steps, pack_bytes([words[c] for c in codes])))
                    lo = hi
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _DEALT, strict=True)], schema=_DEALT
                    )

    return run


_DEALT = pa.schema(
    [("bucket", pa.int64()), ("part", pa.int64()), ("block", pa.int64()), ("steps", pa.binary()), ("words", pa.binary())]
)


def _encode_bucket(name: str):
    """The rows of one bucket with ids for pre-tokens: each distinct one is merged once."""

    def run(rows: pa.Table) -> pa.Table:
        ranks = _ranks_of_worker(name)
        known = Codes()
        sizes, tokens, out = [], [], []
        for packed in rows["words"]:
            wanted = np.fromiter(map(known.__getitem__, unpack_bytes(packed.as_py())), np.int64)
            out.append(wanted)
        for word in known:
            found = merge(word, ranks)
            sizes.append(len(found))
            tokens += found
        sizes, tokens = np.array(sizes, np.int64), np.array(tokens, np.uint32)
        starts = np.cumsum(sizes) - sizes
        return pa.Table.from_arrays(
            [
                rows["block"],
                rows["steps"],
                pa.array([pack(sizes[w]) for w in out], pa.binary()),
                pa.array([pack_ids(gather(tokens, starts[w], sizes[w])) for w in out], pa.binary()),
            ],
            names=["of_block", "steps", "sizes", "tokens"],
        )

    return run


def _binary(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Values of one byte each as binary values that end at ``ends``."""
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values, np.uint8))]
    )


class _TokenBytes:
    """The table of token bytes as three columns: bytes laid end to end, starts and sizes."""

    def __init__(self, tokens: DataFrame):
        bound = tokens.agg(F.sum(F.length("bytes")), F.max("token")).first()
        if max(bound[0] or 0, bound[1] or 0) > TABLE_BYTES:
            raise ValueError("the table of token bytes is too large to broadcast")
        pairs = sorted((r.token, bytes(r.bytes)) for r in tokens.collect())
        self.sizes = np.full(pairs[-1][0] + 1, -1, np.int64)
        self.sizes[[t for t, _ in pairs]] = [len(b) for _, b in pairs]
        self.starts = np.cumsum(np.maximum(self.sizes, 0)) - np.maximum(self.sizes, 0)
        self.flat = np.frombuffer(b"".join(b for _, b in pairs), np.uint8)

    def decoded(self, ids: np.ndarray, per_row: np.ndarray) -> pa.Array:
        """Rows of ``per_row`` ids each to the bytes they stand for."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.sizes) or (self.sizes[ids] < 0).any()):
            raise ValueError("an id is no token of the vocabulary")
        sizes = self.sizes[ids]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        return _binary(gather(self.flat, self.starts[ids], sizes), upto[np.cumsum(per_row, dtype=np.int64)])


def _put_together(table=None):
    """One block and the ids of its pre-tokens to one row per text, decoded again with a table."""

    def run(block: pa.Table, parts: pa.Table) -> pa.Table:
        names = ["id", "ids"] if table is None else ["id", "ids", "decoded"]
        kind = block.schema.field("ids").type.value_type
        if block.num_rows == 0:
            return pa.Table.from_arrays([pa.array([], kind), *[pa.array([], pa.binary()) for _ in names[1:]]], names=names)
        ids, per_text = (block[c].combine_chunks().flatten() for c in ("ids", "sizes"))
        per_text = per_text.to_numpy(zero_copy_only=False)
        numbers = [np.cumsum(unpack(v.as_py()), dtype=np.int64) for v in parts["steps"]]
        sizes, tokens = ([f(v.as_py()) for v in parts[c]] for c, f in (("sizes", unpack), ("tokens", unpack_ids)))
        none = [np.zeros(0, np.uint32)]
        numbers, sizes, tokens = (np.concatenate(none + found) for found in (numbers, sizes, tokens))
        starts, lengths = np.zeros(len(numbers), np.int64), np.zeros(len(numbers), np.int64)
        numbers, sizes = numbers.astype(np.int64), sizes.astype(np.int64)
        starts[numbers], lengths[numbers] = np.cumsum(sizes) - sizes, sizes
        packed, decoded, at = [], [], 0
        for piece, texts in zip(block["pieces"][0], block["texts"][0], strict=True):
            codes, here = unpack(piece.as_py()), per_text[at : at + texts.as_py()]
            length = lengths[codes]
            upto = np.concatenate([[0], np.cumsum(length)])
            ends = upto[np.cumsum(here)]
            in_order = gather(tokens, starts[codes], length).astype("<u4")
            packed.append(_binary(in_order.view(np.uint8), ends * 4))
            if table is not None:
                decoded.append(table.value.decoded(in_order, np.diff(ends, prepend=0)))
            at += texts.as_py()
        columns = [packed] if table is None else [packed, decoded]
        return pa.Table.from_arrays([ids, *[pa.chunked_array(c, pa.binary()) for c in columns]], names=names)

    return run


def encode_packed(
    docs: DataFrame,
    vocabulary: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_chars: int = BLOCK_CHARS,
    bucket_rows: int = BUCKET_ROWS,
    part_blocks: int = BLOCKS,
    decoded: bool = False,
) -> DataFrame:
    """``id_col`` and ``ids``: the ids as little-endian unsigned 32-bit integers in one value.

    With ``decoded`` a column of that name has the bytes decoded from the ids, in the same task.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = rows.schema["id"].dataType
    block = T.StructType([T.StructField(name, kind) for name, (kind, _) in _BLOCK.items()])
    block = block.add("ids", T.ArrayType(kind))
    blocks = materialize(rows.mapInArrow(_cut(block_chars), block), "pre_token_blocks")
    n_blocks, n_words = blocks.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_words"), F.lit(0))).first()
    parts = -(-n_blocks // part_blocks) or 1
    buckets = -(-n_words // (bucket_rows * parts)) or 1
    dealt = blocks.select(F.pmod(F.xxhash64("block"), F.lit(parts)).alias("part"), "block", "words").mapInArrow(
        _deal(buckets), "bucket long, part long, block long, steps binary, words binary"
    )
    found = dealt.groupBy("bucket", "part").applyInArrow(
        _encode_bucket(vocabulary), "of_block long, steps binary, sizes binary, tokens binary"
    )
    out = T.StructType([T.StructField("id", kind), T.StructField("ids", T.BinaryType())])
    table = None
    if decoded:
        out = out.add("decoded", T.BinaryType())
        table = docs.sparkSession.sparkContext.broadcast(_TokenBytes(token_bytes(docs.sparkSession, vocabulary)))
    whole = (
        blocks.drop("words", "n_words")
        .groupBy("block")
        .cogroup(found.groupBy("of_block"))
        .applyInArrow(_put_together(table), out)
    )
    return whole.toDF(id_col, *whole.columns[1:])


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed = [v.as_buffer() for v in batch.column(1)]
        ends = np.cumsum([0] + [len(p) // 4 for p in packed]).astype(np.int32)
        flat = pa.array(np.frombuffer(b"".join(packed), "<u4").astype(np.int32), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.ListArray.from_arrays(pa.array(ends), flat)], names=["id", "ids"]
        )


def encode(
    docs: DataFrame,
    vocabulary: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``id_col`` and ``ids`` (an array of int) of every row, by the ranks of a vocabulary file.

    Null and empty texts give no ids. Repeated rows and null ids stay rows of their own. Strings
    of special tokens are ordinary text, a text of any length is one value. An empty table gives
    no rows; other columns are not read. A block ends with the text that brings it to
    ``block_chars``.
    """
    packed = encode_packed(docs, vocabulary, id_col, text_col, block_chars).withColumnRenamed(id_col, "id")
    out = T.StructType([packed.schema["id"], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return packed.mapInArrow(_listed, out).withColumnRenamed("id", id_col)


def token_bytes(spark: SparkSession, vocabulary: str) -> DataFrame:
    """(token, bytes) of every token of a vocabulary file."""
    import public_tokenizers

    ranks = read_ranks(public_tokenizers.path(vocabulary))
    return spark.createDataFrame([(rank, bytearray(token)) for token, rank in ranks.items()], "token int, bytes binary")


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch with their ids and the ids per row; a slice ends with the row that fills it."""
    column = batch.column(1)
    if pa.types.is_binary(column.type):
        per_row = np.array([len(v.as_buffer()) // 4 if v.is_valid else 0 for v in column], np.int64)
    else:
        per_row = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    full = np.cumsum(per_row) // PIECE
    cuts = [0, *(np.flatnonzero(np.diff(full)) + 1).tolist(), len(column)]
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        part = column.slice(lo, hi - lo)
        if pa.types.is_binary(column.type):
            ids = np.frombuffer(b"".join(v.as_buffer() for v in part if v.is_valid), "<u4")
        else:
            ids = part.flatten().to_numpy(zero_copy_only=False)
        yield batch.slice(lo, hi - lo), ids, per_row[lo:hi]


def _decode_batches(table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, ids, per_row in _pieces(batch):
                decoded = table.value.decoded(ids, per_row)
                yield pa.RecordBatch.from_arrays([*rows.columns, decoded], names=[*batch.schema.names, "decoded"])

    return run


def decode(
    rows: DataFrame,
    vocabulary: str,
    id_col: str = "doc_id",
    ids_col: str = "ids",
    decoded_col: str = "decoded",
) -> DataFrame:
    """``id_col``, ``ids_col`` and the bytes that the ids stand for, of every row.

    ``ids_col`` is an array of int, or packed as of ``encode_packed``. Null or no ids give no
    bytes, repeated rows stay, an id that the vocabulary lacks is an error. An empty table gives
    no rows; other columns are not read.
    """
    spark = rows.sparkSession
    rows = rows.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{ids_col}`").alias("ids"))
    table = spark.sparkContext.broadcast(_TokenBytes(token_bytes(spark, vocabulary)))
    out = T.StructType([*rows.schema.fields, T.StructField("decoded", T.BinaryType())])
    return rows.mapInArrow(_decode_batches(table), out).toDF(id_col, ids_col, decoded_col)
