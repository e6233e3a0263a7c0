"""Collocations by set-oriented mining over relations of phrase occurrences.

The relation of length k holds (piece, position, phrase) for every occurrence of a frequent phrase
of k words. It is sorted by piece and position, stored, and joined with itself by piece and
adjacent position: two overlapping phrases of k words make one of k + 1. The new occurrences are
group-counted, and a semi-join with the frequent groups leaves the next relation. Every part of
a frequent phrase is frequent, so nothing is lost, and the counts are exact.

Occurrences are stored in blocks of bounded size, one row per block, as two packed columns: the
place (pieces are told apart by gaps, so one number is piece and position) and the phrase's id. Both
sides of the merge-join are the same sorted columns, so it needs no shuffle. Group counts are
aggregated within a block, then by Spark on the map side, then by key. The semi-join sends the
frequent groups to the blocks where their number is within a checked bound, and otherwise joins
the distinct keys of every block with them and brings the ids back by block.

A phrase's id is its number among the frequent phrases of its length, so a pair of ids names a
longer phrase exactly.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velomart.llm.blocks import Codes, block_numbers, pack, pack_bytes, unpack, unpack_bytes
from velomart.operators.ranking import with_row_number
from velomart.workspace import materialize

#: A block ends with the text that brings its language to so many bytes, or all to four times.
BLOCK_BYTES = 8 << 20
#: Frequent words, and frequent longer phrases, that are sent to all tasks at most.
WORDS_SENT, PHRASES_SENT = 1 << 18, 1 << 20
# the end of a piece: no word can be this, since it splits pieces
_END = b"."
_SEPARATORS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", _END * 10)

_OCCURRENCES = "block long, lang string, places binary, ids binary"


def _slices(data: bytes, size: int) -> Iterator[bytes]:
    """``data`` in stretches of whole pieces, each of ``size`` bytes or the piece that reaches it."""
    lo = 0
    while lo < len(data):
        hi = data.find(_END, lo + size)
        hi = len(data) if hi < 0 else hi + 1
        yield data[lo:hi]
        lo = hi


def _first_blocks(block_bytes: int):
    """(lang, text) rows to blocks of words: codes by place (0 ends a piece), words, counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = block_numbers()
        words: dict[str, Codes] = defaultdict(lambda: Codes({_END: 0}))
        parts: dict[str, list[np.ndarray]] = defaultdict(list)
        held: dict[str, int] = defaultdict(int)

        def block(lang: str) -> pa.RecordBatch:
            codes, known = np.concatenate(parts.pop(lang)), words.pop(lang)
            held.pop(lang)
            counts = np.bincount(codes, minlength=len(known))[1:]
            columns = [
                pa.array([next(numbers)], pa.int64()),
                pa.array([lang], pa.string()),
                pa.array([int(counts.sum())], pa.int64()),
                *[pa.array([x], pa.binary()) for x in (pack(codes), pack_bytes(list(known)[1:]), pack(counts))],
            ]
            return pa.RecordBatch.from_arrays(columns, names=["block", "lang", "n", "codes", "words", "counts"])

        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                lang = lang.as_py()
                data = (text.as_py() or "").encode().lower().translate(_SEPARATORS)
                for part in _slices(data, block_bytes):
                    tokens = part.replace(_END, b" . ").split()
                    tokens.append(_END)
                    parts[lang].append(np.fromiter(map(words[lang].__getitem__, tokens), np.uint32, len(tokens)))
                    held[lang] += len(part)
                    if held[lang] >= block_bytes:
                        yield block(lang)
                if sum(held.values()) >= 4 * block_bytes:
                    for full in list(held):
                        yield block(full)
        for rest in list(held):
            yield block(rest)

    return run


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lang, words, counts in zip(*batch.columns, strict=True):
            found = unpack_bytes(words.as_py())
            if found:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.repeat(lang, len(found)),
                        pa.array(found, pa.binary()),
                        pa.array(unpack(counts.as_py()).astype(np.int64)),
                    ],
                    names=["lang", "word", "n"],
                )


def _occurrences(row: dict) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum(unpack(row["places"]), dtype=np.int64), unpack(row["ids"]).astype(np.int64)


def _joined(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """The relation joined with itself at adjacent positions: places and pairs of ids."""
    places, ids = _occurrences(row)
    at = np.flatnonzero(places[1:] == places[:-1] + 1)
    return places[at], ids[at] << 32 | ids[at + 1]


def _pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            keys, counts = np.unique(_joined(row)[1], return_counts=True)
            if len(keys):
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["pair", "n"])


def _kept(row: dict, places: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    """The next relation of a block: its occurrences with an id."""
    at = np.flatnonzero(ids)
    columns = [
        pa.array([row["block"]], pa.int64()),
        pa.array([row["lang"]], pa.string()),
        pa.array([pack(np.diff(places[at], prepend=0))], pa.binary()),
        pa.array([pack(ids[at])], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["block", "lang", "places", "ids"])


def _word_places(row: dict) -> tuple[np.ndarray, np.ndarray]:
    codes = unpack(row["codes"]).astype(np.int64)
    places = np.flatnonzero(codes)
    return places, codes[places] - 1


def _semi_join_sent(sent, first: bool):
    """Blocks to the next relation, with the frequent groups in every task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = sent.value
        for batch in batches:
            for row in batch.to_pylist():
                if first:
                    places, codes = _word_places(row)
                    known = frequent.get(row["lang"], {})
                    words = unpack_bytes(row["words"])
                    ids = np.fromiter((known.get(w, 0) for w in words), np.int64, len(words))
                    yield _kept(row, places, ids[codes])
                else:
                    places, pairs = _joined(row)
                    keys, ids = frequent
                    at = np.searchsorted(keys, pairs)
                    at[at == len(keys)] = 0
                    yield _kept(row, places, np.where(keys[at] == pairs, ids[at], 0))

    return run


def _distinct(first: bool):
    """(block, group) of every group that occurs in a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                groups = unpack_bytes(row["words"]) if first else np.unique(_joined(row)[1])
                if len(groups):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(groups), row["block"]), pa.int64()),
                            pa.repeat(pa.scalar(row["lang"], pa.string()), len(groups)),
                            pa.array(groups, pa.binary() if first else pa.int64()),
                        ],
                        names=["of_block", "of_lang", "of_group"],
                    )

    return run


def _semi_join_brought(first: bool):
    """One block and the ids of its frequent groups to the next relation."""

    def run(block: pa.Table, found: pa.Table) -> pa.Table:
        out = []
        for row in block.to_pylist():
            if first:
                places, codes = _word_places(row)
                known = dict(zip(found["group"].to_pylist(), found["id"].to_pylist(), strict=True))
                words = unpack_bytes(row["words"])
                ids = np.fromiter((known.get(w, 0) for w in words), np.int64, len(words))[codes]
            else:
                places, pairs = _joined(row)
                order = np.argsort(found["group"].to_numpy())
                keys, numbers = found["group"].to_numpy()[order], found["id"].to_numpy()[order]
                at = np.minimum(np.searchsorted(keys, pairs), max(0, len(keys) - 1))
                ids = np.where(keys[at] == pairs, numbers[at], 0) if len(keys) else np.zeros(len(pairs), np.int64)
            out.append(_kept(row, places, ids))
        kinds = [("block", pa.int64()), ("lang", pa.string()), ("places", pa.binary()), ("ids", pa.binary())]
        return pa.Table.from_batches(out, pa.schema(kinds))

    return run


def _semi_join(blocks: DataFrame, frequent: DataFrame, n: int, most_sent: int, first: bool) -> DataFrame:
    """The occurrences in ``blocks`` of the ``n`` groups of ``frequent``, with their ids."""
    if n <= most_sent:
        found = frequent.select("lang", "group", "id").toArrow()
        if first:
            table: dict | tuple = defaultdict(dict)
            for lang, word, number in zip(*(c.to_pylist() for c in found.columns), strict=True):
                table[lang][word] = number
            table = dict(table)
        else:
            keys, ids = found["group"].to_numpy(), found["id"].to_numpy()
            order = np.argsort(keys)
            table = (keys[order], ids[order])
        sent = blocks.sparkSession.sparkContext.broadcast(table)
        return blocks.mapInArrow(_semi_join_sent(sent, first), _OCCURRENCES)
    kind = "binary" if first else "long"
    asked = blocks.mapInArrow(_distinct(first), f"of_block long, of_lang string, of_group {kind}")
    same = F.col("group") == F.col("of_group")
    if first:
        same &= F.col("lang") == F.col("of_lang")
    brought = asked.join(frequent.select("lang", "group", "id"), same).select("of_block", "group", "id")
    return (
        blocks.groupBy("block")
        .cogroup(brought.groupBy("of_block"))
        .applyInArrow(_semi_join_brought(first), _OCCURRENCES)
    )


def _frequent_words(blocks: DataFrame, least: int) -> DataFrame:
    """(id, lang, group, phrase, f, heads, tails) of the words that occur ``least`` times."""
    counted = (
        blocks.select("lang", "words", "counts")
        .mapInArrow(_word_counts, "lang string, word binary, n long")
        .groupBy("lang", "word")
        .agg(F.sum("n").alias("f"))
        .where(F.col("f") >= least)
    )
    none = F.array().cast("array<bigint>")
    return with_row_number(counted, [F.col("lang"), F.col("word")], "id").select(
        "id", "lang", F.col("word").alias("group"), F.col("word").cast("string").alias("phrase"), "f",
        none.alias("heads"), none.alias("tails"),
    )


def _frequent_pairs(relation: DataFrame, shorter: DataFrame, least: int) -> DataFrame:
    """The frequent phrases one word longer than those of ``shorter``, in the same columns.

    ``heads`` holds the counts of the first 1, 2, ... words, ``tails`` those of the last.
    """
    counted = (
        relation.select("block", "lang", "places", "ids")
        .mapInArrow(_pair_counts, "pair long, n long")
        .groupBy("pair")
        .agg(F.sum("n").alias("f"))
        .where(F.col("f") >= least)
        .select(
            F.col("pair").alias("group"),
            "f",
            F.shiftright("pair", 32).alias("left_id"),
            F.col("pair").bitwiseAND((1 << 32) - 1).alias("right_id"),
        )
    )
    left = shorter.select(
        F.col("id").alias("left_id"),
        "lang",
        F.col("phrase").alias("left_phrase"),
        F.concat("heads", F.array("f")).alias("heads"),
    )
    right = shorter.select(
        F.col("id").alias("right_id"),
        F.substring_index("phrase", " ", -1).alias("last_word"),
        F.concat("tails", F.array("f")).alias("tails"),
    )
    found = counted.join(left, "left_id").join(right, "right_id")
    found = found.withColumn("phrase", F.concat_ws(" ", "left_phrase", "last_word"))
    return with_row_number(found, [F.col("group")], "id").select(
        "id", "lang", "group", "phrase", "f", "heads", "tails", "left_id", "right_id"
    )


def _scored(k: int) -> Column:
    """(score, words before the cut, l, r) of the lowest-scoring cut, the earliest of equals.

    Products have up to 38 digits, so they are exact far beyond 64 bits.
    """

    def cut(i: Column) -> Column:
        l, r = F.element_at("heads", i), F.element_at("tails", F.lit(k) - i)  # noqa: E741
        wide = lambda c: c.cast("decimal(18,0)")
        score = F.call_function("div", wide(F.col("a")) * wide(F.col("n")) * F.lit(1000), wide(l) * wide(r))
        return F.struct(score.alias("score"), i.alias("at"), l.alias("l"), r.alias("r"))

    return F.array_min(F.transform(F.sequence(F.lit(1), F.lit(k - 1)), cut))


def collocations(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    longest: int = 5,
    least: int = 100,
    top: int = 2000,
    contained: int = 100,
    block_bytes: int = BLOCK_BYTES,
    words_sent: int = WORDS_SENT,
    phrases_sent: int = PHRASES_SENT,
) -> DataFrame:
    """The ``top`` phrases of 2 to ``longest`` words of each language: lang, rank, phrase, a, l, r, n, score.

    A-Z count as a-z, pieces end at ``.,;:!?`` and line ends, words are parted by blanks and tabs.
    A phrase is a candidate with ``least`` occurrences ``a``. Its score is ``1000 a n / (l r)``, rounded
    down, at its worst cut, with ``n`` words in the language and ``l`` and ``r`` occurrences of the
    parts. It goes if a longer candidate holds it and has ``contained`` percent of its occurrences.
    Ranks go by score, then ``a``, then the phrase's bytes.

    Null texts are empty; a null language is ``und``. Repeated rows and copies count each time. An
    empty table gives no rows; other columns are not read. ``words_sent`` and ``phrases_sent`` bound
    what is sent to every task; beyond them groups are joined, with the same result.
    """
    rows = docs.select(
        F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    )
    blocks = materialize(
        rows.mapInArrow(
            _first_blocks(block_bytes),
            "block long, lang string, n long, codes binary, words binary, counts binary",
        ),
        "word_blocks",
    )
    totals = blocks.groupBy("lang").agg(F.sum("n").alias("n"))
    found = [materialize(_frequent_words(blocks, least), "frequent_words")]
    relation, most_sent = blocks, words_sent
    while len(found) < longest:
        n = found[-1].count()
        if n == 0:
            break
        if n >> 32:
            raise ValueError("more than 2**32 frequent phrases of one length")
        relation = materialize(_semi_join(relation, found[-1], n, most_sent, len(found) == 1), "occurrences")
        found.append(materialize(_frequent_pairs(relation, found[-1], least), "frequent_phrases"))
        most_sent = phrases_sent
    candidates = None
    for k, phrases in enumerate(found[1:], 2):
        scored = phrases.join(totals, "lang").withColumn("a", F.col("f")).withColumn("cut", _scored(k))
        if k < len(found):
            # a longer candidate that holds a phrase holds one longer by a word, at least as often
            parts = [found[k].select(F.col(c).alias("id"), "f") for c in ("left_id", "right_id")]
            around = parts[0].unionByName(parts[1]).groupBy("id").agg(F.max("f").alias("around"))
            scored = scored.join(around, "id", "left").where(
                F.coalesce(F.col("around") * 100 < F.col("a") * contained, F.lit(True))
            )
        scored = scored.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
        candidates = scored if candidates is None else candidates.unionByName(scored)
    if candidates is None:
        kinds = "lang string, rank long, phrase string, a long, l long, r long, n long, score long"
        return docs.sparkSession.createDataFrame([], kinds)
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = candidates.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
