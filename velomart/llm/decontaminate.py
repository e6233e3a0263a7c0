"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit distance.

Units are words: lower case, ASCII punctuation as white space. An item of n words is found in a
document if some stretch of it is within ``floor((1 - similarity) * n)`` word edits.

A CGK embedding walks over a text: step j writes the word under the pointer, and a random bit
of (j, word) says whether the pointer moves. Two texts at a small edit distance meet again
after each edit, so their embeddings differ in few places, and an LSH key of a few sampled
places agrees with a probability that is measured, not assumed: before the scan the driver
edits the items at random to the very threshold, scans these texts and adds repetitions until
the share found meets the target recall. That probability falls with the length, so an item of
more than ``PART_WORDS`` words is looked for by parts: of the parts of a passage within the
threshold one at least has no higher rate of edits. Windows have the size of the parts, in
length classes a quarter apart. A window is only embedded if it holds as many of the items'
word pairs as any stretch within the threshold must (the q-gram lemma), which loses nothing.
Every hit is verified by an exact edit distance of the part, then of the whole item, against
all stretches around the window.

Documents are never shuffled. The items go to the tasks in blocks of a bounded size, one scan
per block. With several blocks each scan stores what it found before the next index is built,
so a large benchmark takes more scans, not more memory.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velomart.llm.common import filter_in_arrow, unused, with_row_key
from velomart.workspace import materialize

#: Characters of the items that one scan takes along; the bound of what tasks get.
BLOCK_CHARS = 4_000_000
#: Words of documents that are worked on at once.
CHUNK_WORDS = 1 << 19
PAIR_BITS = 22
#: Length classes: the longest item of a class is this much longer than the shortest.
CLASS_RATIO = 1.25
#: Longer items are looked for by parts of nearly equal size.
PART_WORDS = 64
#: Edited parts of a length class that are scanned to measure the recall.
TRIALS = 200
#: Repetitions times windows that are embedded at once.
CELLS = 1 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)
_TABLE = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))


def words_of(text: str | None) -> list[bytes]:
    return text.lower().encode().translate(_TABLE).split() if text else []


def allowed_edits(n: int, similarity: float) -> int:
    return int((1 - similarity) * n + 1e-9)


@dataclass
class LengthClass:
    """Parts of similar length, their embedding and their LSH table."""

    size: int  # words of a window: the shortest part
    longest: int
    pairs: int  # known word pairs that a window of the longest size must hold
    members: np.ndarray  # index of parts
    moves: np.ndarray = field(default=None)  # repetitions x steps: odd multipliers of the walk
    sampled: np.ndarray = field(default=None)  # repetitions x steps, bool
    codes: np.ndarray = field(default=None)  # sorted LSH codes
    recall: float = 0.0  # share of the edited parts that a scan finds
    owners: np.ndarray = field(default=None)  # index of part for each code


def embed(tokens: np.ndarray, starts: np.ndarray, c: LengthClass) -> np.ndarray:
    """LSH codes (repetitions x starts) of the windows of ``c.size`` words at ``starts``."""
    reps, steps = c.moves.shape
    at = np.zeros((reps, len(starts)), np.int64)
    codes = np.broadcast_to(np.arange(1, reps + 1, dtype=np.uint64)[:, None] * _MIX, at.shape).copy()
    limit = len(tokens) - 1
    for j in range(steps):
        inside = at < c.size
        word = np.where(inside, tokens[np.minimum(starts[None, :] + at, limit)], np.uint64(1))
        took = c.sampled[:, j]
        if took.any():
            codes[took] = (codes[took] ^ word[took]) * _MIX
            codes[took] ^= codes[took] >> np.uint64(29)
        at += (((word + np.uint64(j + 1)) * c.moves[:, j][:, None]) >> np.uint64(63)).astype(np.int64)
    return codes


def _walk(c: LengthClass, reps: int, samples: int, rng: np.random.Generator) -> None:
    steps = 2 * c.size
    c.moves = rng.integers(1, 1 << 63, (reps, steps), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    c.sampled = np.zeros((reps, steps), bool)
    for r in range(reps):
        c.sampled[r, rng.choice(steps, min(samples, steps), replace=False)] = True


def _edited(tokens: np.ndarray, edits: int, rng: np.random.Generator) -> np.ndarray:
    """``tokens`` with that many words substituted, deleted or preceded by a new one."""
    out = list(tokens)
    for at in sorted(rng.choice(len(out), edits, replace=False).tolist(), reverse=True):
        kind = int(rng.integers(0, 3))
        out[at : at + (kind != 2)] = [np.uint64(0)] if kind != 1 or len(out) == 1 else []
    return np.array(out, np.uint64)


class Index:
    """What a task needs to find the items of one block."""

    def __init__(
        self,
        items: list[tuple[object, str | None]],
        similarity: float,
        recall: float,
        samples: int,
        min_words: int,
        seed: int,
    ):
        split = [(item, words_of(text)) for item, text in items]
        split = [(item, words) for item, words in split if len(words) >= min_words]
        self.ids = [item for item, _ in split]
        vocabulary = sorted({w for _, words in split for w in words})
        self.word = {w: k + 2 for k, w in enumerate(vocabulary)}  # 0: unknown, 1: past the end
        self.tokens = [np.array([self.word[w] for w in words], np.uint64) for _, words in split]
        self.edits = [allowed_edits(len(t), similarity) for t in self.tokens]
        cuts = [np.array_split(t, -(-len(t) // PART_WORDS)) for t in self.tokens]
        self.parts = [part for own in cuts for part in own]
        self.part_edits = [allowed_edits(len(part), similarity) for part in self.parts]
        self.item_of = np.repeat(np.arange(len(cuts)), [len(own) for own in cuts]).tolist()
        self.offsets = [int(n) for own in cuts for n in np.cumsum([0, *map(len, own)])[:-1]]
        self.pairs = np.zeros(1 << PAIR_BITS, bool)
        for t in self.tokens:
            self.pairs[_pair_slots(t)] = True
        rng = np.random.default_rng(seed)
        self.classes = [self._table(c, recall, samples, rng) for c in self._length_classes()]

    def _length_classes(self) -> list[LengthClass]:
        out, order = [], sorted(range(len(self.parts)), key=lambda k: len(self.parts[k]))
        while order:
            size = len(self.parts[order[0]])
            own = [k for k in order if len(self.parts[k]) <= CLASS_RATIO * size]
            needed = min(len(self.parts[k]) - 1 - 2 * self.part_edits[k] for k in own)
            out.append(LengthClass(size, len(self.parts[own[-1]]), max(0, needed), np.array(own)))
            order = order[len(own) :]
        return out

    def _table(self, c: LengthClass, recall: float, samples: int, rng: np.random.Generator) -> LengthClass:
        """Indexes the parts with as many repetitions as the target recall takes on edited parts."""
        trial = c.members[rng.integers(0, len(c.members), TRIALS)]
        near = [_edited(self.parts[k], self.part_edits[k], rng) for k in trial]
        gap = np.zeros(c.longest, np.uint64)
        laid = np.concatenate([x for text in near for x in (gap, text, gap)])
        bounds = np.cumsum([0, *[len(text) + 2 * len(gap) for text in near]])
        starts = self._starts(laid, self._known(laid), c)
        _walk(c, 16, samples, rng)
        zero = np.zeros(1, np.int64)
        same = [embed(self.parts[k], zero, c) == embed(_fill(x, c.size), zero, c) for k, x in zip(trial, near, strict=True)]
        chance = min(0.999, max(1, np.sum(same)) / (16 * TRIALS))  # a first guess, without a say in the end
        reps = max(4, int(np.ceil(np.log(1 - recall) / np.log(1 - chance))))
        while True:
            _walk(c, reps, samples, rng)
            self._fill_table(c, np.unique(trial))
            found = {(doc, part) for doc, part, _ in self._near(laid, starts, bounds, c)}
            c.recall = sum((doc, part) in found for doc, part in enumerate(trial.tolist())) / TRIALS
            if c.recall >= recall:
                self._fill_table(c, c.members)
                return c
            reps = -(-5 * reps // 4)

    def _fill_table(self, c: LengthClass, parts: np.ndarray) -> None:
        """The codes of ``parts``: all are embedded as windows of one text, since none is shorter."""
        laid = np.concatenate([self.parts[k] for k in parts])
        starts = np.cumsum([0, *[len(self.parts[k]) for k in parts]])[:-1]
        step = max(1, CELLS // len(c.moves))
        codes = [embed(laid, starts[lo : lo + step], c) for lo in range(0, len(starts), step)]
        flat, owners = np.concatenate(codes, axis=1).T.ravel(), np.repeat(parts, len(c.moves))
        order = np.argsort(flat, kind="stable")
        c.codes, c.owners = flat[order], owners[order]

    def tokens_of(self, words: list[bytes]) -> np.ndarray:
        get = self.word.get
        return np.array([get(w, 0) for w in words], np.uint64)

    def find(self, tokens: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(document, item, edits, first word) for documents laid end to end at ``bounds``."""
        if not len(tokens) or not self.classes:
            return
        known = self._known(tokens)
        near: set[tuple[int, int, int]] = set()
        for c in self.classes:
            near.update(self._near(tokens, self._starts(tokens, known, c), bounds, c))
        yield from self._verified(tokens, bounds, sorted(near))

    def _known(self, tokens: np.ndarray) -> np.ndarray:
        """Running number of word pairs that the items have."""
        known = np.zeros(len(tokens) + 1, np.int32)
        if len(tokens) > 1:
            hit = self.pairs[_pair_slots(tokens)] & (tokens[:-1] > 0) & (tokens[1:] > 0)
            np.cumsum(hit, out=known[1:-1])
            known[-1] = known[-2]
        return known

    def _starts(self, tokens: np.ndarray, known: np.ndarray, c: LengthClass) -> np.ndarray:
        ends = np.minimum(np.arange(len(tokens)) + c.longest - 1, len(tokens) - 1)
        return np.nonzero(known[ends] - known[: len(tokens)] >= c.pairs)[0]

    def _near(
        self, tokens: np.ndarray, starts: np.ndarray, bounds: np.ndarray, c: LengthClass
    ) -> Iterator[tuple[int, int, int]]:
        step = max(1, CELLS // len(c.moves))
        for lo in range(0, len(starts), step):
            yield from self._candidates(tokens, starts[lo : lo + step], bounds, c)

    def _candidates(
        self, tokens: np.ndarray, starts: np.ndarray, bounds: np.ndarray, c: LengthClass
    ) -> Iterator[tuple[int, int, int]]:
        codes = embed(tokens, starts, c)
        left = np.searchsorted(c.codes, codes.ravel(), "left")
        n = np.searchsorted(c.codes, codes.ravel(), "right") - left
        hits = np.nonzero(n)[0]
        if not len(hits):
            return
        where = np.repeat(hits, n[hits])
        nth = np.arange(len(where)) - np.repeat(np.cumsum(n[hits]) - n[hits], n[hits])
        parts = c.owners[left[where] + nth]
        at = starts[where % len(starts)]
        docs = np.searchsorted(bounds, at, "right") - 1
        found = np.unique(np.stack([docs, parts, at]), axis=1)
        yield from map(tuple, found.T.tolist())

    def _verified(
        self, tokens: np.ndarray, bounds: np.ndarray, near: list[tuple[int, int, int]]
    ) -> Iterator[tuple[int, int, int, int]]:
        best: dict[tuple[int, int], tuple[int, int]] = {}
        whole: set[tuple[int, int, int]] = set()
        for doc, part, distance, first, lo, hi in _closest(tokens, bounds, near, self.parts, self.part_edits, 1):
            item, offset = self.item_of[part], self.offsets[part]
            if len(self.parts[part]) < len(self.tokens[item]):
                whole |= {(doc, item, lo - offset), (doc, item, hi - offset)}
            else:
                best[doc, item] = min(best.get((doc, item), (1 << 60, 0)), (distance, first))
        # edits before a part move it, so that the item may begin and end later by as many words
        for doc, item, distance, first, _, _ in _closest(tokens, bounds, sorted(whole), self.tokens, self.edits, 2):
            best[doc, item] = min(best.get((doc, item), (1 << 60, 0)), (distance, first))
        for (doc, item), (distance, first) in sorted(best.items()):
            yield doc, item, distance, first


def _closest(
    tokens: np.ndarray,
    bounds: np.ndarray,
    near: list[tuple[int, int, int]],
    wanted: list[np.ndarray],
    edits: list[int],
    after: int,
) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(document, wanted, edits, first word, lo, hi) of the runs lo to hi of ``near`` that hold it.

    Text is read from ``edits`` words before a run to ``after * edits`` beyond its last stretch.
    """
    k = 0
    while k < len(near):
        doc, which, lo = near[k]
        size, most = len(wanted[which]), edits[which]
        hi = lo
        while k < len(near) and near[k][:2] == (doc, which) and near[k][2] <= hi + size:
            hi = near[k][2]
            k += 1
        begin, end = max(bounds[doc], lo - most), min(bounds[doc + 1], hi + size + after * most)
        distance, first = nearest(wanted[which], tokens[begin:end], most)
        if distance <= most:
            yield doc, which, distance, int(begin - bounds[doc]) + first, lo, hi


def _fill(tokens: np.ndarray, size: int) -> np.ndarray:
    return np.concatenate([tokens, np.zeros(max(0, size - len(tokens)) + 1, np.uint64)])


def _pair_slots(tokens: np.ndarray) -> np.ndarray:
    mixed = (tokens[:-1] * _MIX + tokens[1:]) * np.uint64(0xD6E8FEB86659FD93)
    return (mixed >> np.uint64(64 - PAIR_BITS)).astype(np.int64)


def _last_row(item: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Least edits between ``item`` and a stretch of ``text`` ending at each place."""
    steps = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for i, word in enumerate(item):
        new = row + 1
        new[1:] = np.minimum(new[1:], row[:-1] + (text != word))
        new[0] = i + 1
        row = np.minimum.accumulate(new - steps) + steps
    return row


def nearest(item: np.ndarray, text: np.ndarray, most: int) -> tuple[int, int]:
    """Edits of the stretch of ``text`` closest to ``item``, and where it begins."""
    row = _last_row(item, text)
    end = int(row.argmin())
    if row[end] > most:
        return int(row[end]), 0
    back = _last_row(item[::-1], text[:end][::-1])
    return int(row[end]), end - int(back.argmin())


def _documents(texts: pa.Array) -> Iterator[tuple[int, int, list[list[bytes]]]]:
    """Stretches [from, to) of rows with about ``CHUNK_WORDS`` words together."""
    lo, held, words = 0, 0, []
    for k in range(len(texts)):
        words.append(words_of(texts[k].as_py()))
        held += len(words[-1])
        if held >= CHUNK_WORDS:
            yield lo, k + 1, words
            lo, held, words = k + 1, 0, []
    if words:
        yield lo, len(texts), words


def _found(index: Index, texts: pa.Array) -> Iterator[tuple[int, int, int, int, int]]:
    for lo, _, words in _documents(texts):
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        tokens = np.concatenate([index.tokens_of(w) for w in words])
        for doc, item, edits, first in index.find(tokens, bounds):
            yield lo + doc, item, edits, first, len(index.tokens[item])


def _match_batches(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            rows = list(_found(index, batch.column(1)))
            if rows:
                docs, items, edits, first, size = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(docs)),
                        pa.array([index.ids[k] for k in items], pa.int64()),
                        *[pa.array(x, pa.int64()) for x in (edits, size, first)],
                    ],
                    names=["id", "item", "edits", "item_words", "first_word"],
                )

    return run


def _clean_batches(shared, place: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            bad = {row[0] for row in _found(index, batch.column(place))}
            yield batch.filter(pa.array([k not in bad for k in range(batch.num_rows)], pa.bool_()))

    return run


def _bad_keys(shared):
    """(file, row, text) to the keys of the rows that hold an item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            bad = sorted({row[0] for row in _found(index, batch.column(2))})
            if bad:
                yield batch.select([0, 1]).take(pa.array(bad))

    return run


def _indexes(benchmark: DataFrame, item_col: str, text_col: str, settings: tuple, block_chars: int) -> list:
    """For each block of items, of about ``block_chars`` characters at most, what makes its index."""
    items = benchmark.select(
        F.col(f"`{item_col}`").cast("long").alias("item"), F.col(f"`{text_col}`").cast("string").alias("text")
    ).distinct()
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-2 * chars // block_chars) or 1
    if blocks > 1:
        items = materialize(items, "benchmark_items")

    def index(block: int) -> Index:
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)
        return Index([(r.item, r.text) for r in part.orderBy("item", "text").collect()], *settings)

    return [lambda block=block: index(block) for block in range(blocks)]


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    similarity: float = 0.8,
    recall: float = 0.99,
    samples: int = 3,
    min_item_words: int = 5,
    seed: int = 20,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """(id, item, edits, item_words, first_word): the closest stretch of each item in each row.

    Only rows within ``floor((1 - similarity) * words)`` edits of an item are returned. Null and
    blank texts hold no item. Items with fewer than ``min_item_words`` words, null and blank
    ones are in no document; a repeated item counts once per id. Rows are independent: null ids
    and repeated rows are kept as they are. Either table may be empty; other columns are not read.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, item long, edits long, item_words long, first_word long"
    settings = (similarity, recall, samples, min_item_words, seed)
    indexes = _indexes(benchmark, item_col, item_text_col, settings, block_chars)
    out = None
    for index in indexes:
        shared = docs.sparkSession.sparkContext.broadcast(index())
        found = rows.mapInArrow(_match_batches(shared), schema)
        if len(indexes) > 1:
            found = materialize(found, "matches")
            shared.destroy()
        out = found if out is None else out.unionByName(found)
    return out.withColumnsRenamed({"id": id_col, "item": unused(item_col, [id_col])})


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    similarity: float = 0.8,
    recall: float = 0.99,
    samples: int = 3,
    min_item_words: int = 5,
    seed: int = 20,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The rows of ``docs`` in which no item is found, all columns; see ``contaminated``."""
    settings = (similarity, recall, samples, min_item_words, seed)
    indexes = _indexes(benchmark, item_col, item_text_col, settings, block_chars)
    if len(indexes) == 1:
        shared = docs.sparkSession.sparkContext.broadcast(indexes[0]())
        return filter_in_arrow(docs, _clean_batches(shared, docs.columns.index(text_col)))
    file, row = unused("vm_file", docs.columns), unused("vm_row", docs.columns)
    keyed = with_row_key(docs, file, row)
    texts = keyed.select(
        F.col(file).alias("file"), F.col(row).alias("row"), F.col(f"`{text_col}`").cast("string").alias("text")
    )
    bad = None
    for index in indexes:
        shared = docs.sparkSession.sparkContext.broadcast(index())
        found = materialize(texts.mapInArrow(_bad_keys(shared), "file long, row long"), "contaminated_rows")
        shared.destroy()
        bad = found if bad is None else bad.unionByName(found)
    bad = bad.distinct().select(F.col("file").alias(file), F.col("row").alias(row))
    return keyed.join(bad, [file, row], "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
