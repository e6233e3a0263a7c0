"""SimHash near-duplicates with a bit-sliced comparison.

Fingerprints are made where the rows are. Equal fingerprints become one class before anything
is compared, so copies cost nothing. Two fingerprints that differ in at most ``radius`` bits
agree on all but ``radius`` of ``radius + 4`` bit blocks, so each class is dealt out once per
choice of blocks to leave out, and every pair within the radius shares a bucket. Buckets are
compared bit-sliced: plane ``b`` holds bit ``b`` of all members side by side, one exclusive-or
updates 64 distances at once in carry-save counters, and a row of a block is abandoned when all
its distances exceed the radius.

A bucket larger than ``BLOCK`` is dealt again by its left-out bits: each member goes to every
pattern within ``ceil(radius / 2)`` flips. Members within the radius of each other still meet,
and such a sub-bucket has a fixed largest size. Nothing is capped. A block gives a spanning
forest of its links, at most one row per member, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velomart.llm.common import unused, with_row_key
from velomart.llm.components import components
from velomart.workspace import materialize

SEED = 42
#: Members of a compared block, and of the largest bucket that is compared as it is.
BLOCK = 1024
#: Shingles hashed at once, so a very long text needs no more memory than this many.
CHUNK = 1 << 16
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str | None, shingle_words: int) -> int:
    """The 64-bit SimHash of a text; null and blank texts give 0."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter((len(w) + 1 for w in words), np.int64, len(words))) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) >= shingle_words:
        starts, ends = starts[: len(words) - shingle_words + 1], ends[shingle_words - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(starts), CHUNK):
        spans = zip(starts[at : at + CHUNK].tolist(), ends[at : at + CHUNK].tolist(), strict=True)
        hashes = np.array([digest(joined[s:e], SEED) for s, e in spans], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(starts), bitorder="little").view(np.uint64)[0])


def _fingerprint_batches(shingle_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            prints = np.fromiter(
                (fingerprint(texts[i].as_py(), shingle_words) for i in range(len(texts))),
                np.uint64,
                len(texts),
            )
            columns = [*batch.columns[:-1], pa.array(prints.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "fp"])

    return run


def fingerprints(rows: DataFrame, text: str, shingle_words: int) -> DataFrame:
    """The columns of ``rows`` but ``text``, and ``fp``: the fingerprint as a signed long."""
    kept = [F.col(f"`{c}`") for c in rows.columns if c != text]
    rows = rows.select(*kept, F.col(f"`{text}`").cast("string").alias(text))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return rows.mapInArrow(_fingerprint_batches(shingle_words), ", ".join([*fields, "fp long"]))


def left_out_masks(radius: int) -> list[int]:
    """For each choice of ``radius`` of ``radius + 4`` blocks: the bits left out of the key."""
    n = radius + 4
    edges = [64 * i // n for i in range(n + 1)]
    blocks = [(1 << hi) - (1 << lo) for lo, hi in zip(edges, edges[1:], strict=False)]
    return [sum(choice) for choice in combinations(blocks, radius)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _flips(mask: int, most: int) -> list[int]:
    """Every pattern of at most ``most`` of the bits of ``mask``."""
    bits = [1 << b for b in range(64) if mask >> b & 1]
    return [_signed(sum(c)) for k in range(most + 1) for c in combinations(bits, k)]


def close_pairs(prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i, j), i < j, of ``prints`` (uint64) that differ in at most ``radius`` bits.

    Bit-sliced: 64 distances per word, counted in carry-save counters of
    ``bit_length(radius)`` planes and a sticky overflow plane.
    """
    n = len(prints)
    words = -(-n // 64)
    padded = np.zeros(words * 64, np.uint64)
    padded[:n] = prints
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    packed = np.packbits(bits.T, axis=1, bitorder="little")
    planes = np.ascontiguousarray(packed).view(np.uint64)  # 64 x words
    later = np.zeros((n, words * 64), np.uint8)
    later[:, :n] = np.triu(np.ones((n, n), np.uint8), 1)
    dead = ~np.packbits(later, axis=1, bitorder="little").view(np.uint64)
    rows = np.arange(n)
    counters = [np.zeros_like(dead) for _ in range(radius.bit_length())]
    for b in range(64):
        own = np.where(bits[rows, b] != 0, _ALL, np.uint64(0))
        carry = planes[b][None, :] ^ own[:, None]
        for c in counters:
            carry, c[...] = c & carry, c ^ carry
        dead |= carry
        if b % 8 == 7:
            over = dead | _above(counters, radius)
            alive = (over != _ALL).any(axis=1)
            if not alive.all():
                rows, dead = rows[alive], over[alive]
                counters = [c[alive] for c in counters]
            if not len(rows):
                break
    near = np.unpackbits(
        (~(dead | _above(counters, radius))).view(np.uint8), axis=1, bitorder="little"
    )
    i, j = np.nonzero(near)
    return rows[i], j


def _above(counters: list[np.ndarray], radius: int) -> np.ndarray | np.uint64:
    """A plane with a one where the counters hold more than ``radius``."""
    above, equal = np.uint64(0), _ALL
    for level in reversed(range(len(counters))):
        if radius >> level & 1:
            equal = equal & counters[level]
        else:
            above = above | (equal & counters[level])
            equal = equal & ~counters[level]
    return above


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least index reachable from each of ``n`` by the links (i, j)."""
    least = np.arange(n)
    while True:
        before = least.copy()
        np.minimum.at(least, j, least[i])
        np.minimum.at(least, i, least[j])
        least = least[least]
        if (least == before).all():
            return least


def _block_links(buckets: list[np.ndarray], radius: int) -> Iterator[pa.RecordBatch]:
    prints = np.unique(np.concatenate(buckets))
    roots = _forest(len(prints), *close_pairs(prints, radius))
    linked = np.nonzero(roots != np.arange(len(prints)))[0]
    if len(linked):
        signed = prints.view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(signed[linked]), pa.array(signed[roots[linked]])], names=["a", "b"]
        )


def _bucket_batches(radius: int):
    """Sorted (way, head, tail, fp) rows; whole buckets are packed into blocks.

    Links between buckets of one block are true links too, so they may stay.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, waiting, held = None, [], 0
        for batch in batches:
            rows = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)])
            rows = rows if rest is None else np.concatenate([rest, rows], axis=1)
            if not rows.shape[1]:
                continue
            new = (rows[:3, 1:] != rows[:3, :-1]).any(axis=0)
            cuts = np.concatenate([[0], np.nonzero(new)[0] + 1])
            rest = rows[:, cuts[-1] :]
            sizes = np.diff(cuts)
            for k in np.nonzero(sizes > 1)[0]:
                if held + sizes[k] > BLOCK and waiting:
                    yield from _block_links(waiting, radius)
                    waiting, held = [], 0
                waiting.append(rows[3, cuts[k] : cuts[k + 1]].view(np.uint64))
                held += sizes[k]
        if rest is not None and rest.shape[1] > 1:
            if held + rest.shape[1] > BLOCK and waiting:
                yield from _block_links(waiting, radius)
                waiting = []
            waiting.append(rest[3].view(np.uint64))
        if waiting:
            yield from _block_links(waiting, radius)

    return run


def links(prints: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) that join up all distinct ``fp`` of ``prints`` within ``radius`` bits.

    Not every link is returned, but every one lies inside a component of those returned.
    """
    ways = left_out_masks(radius)
    keyed = prints.select(
        "fp",
        F.posexplode(
            F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(~m & (1 << 64) - 1))) for m in ways])
        ).alias("way", "head"),
    )
    keyed = keyed.select(F.col("way").cast("long").alias("way"), "head", "fp")
    sizes = keyed.groupBy("way", "head").agg(F.count(F.lit(1)).alias("n"))
    shared = keyed.join(materialize(sizes.where("n > 1"), "buckets"), ["way", "head"])
    plain = shared.where(F.col("n") <= BLOCK).select("way", "head", F.lit(0).cast("long").alias("tail"), "fp")
    again = shared.where(F.col("n") > BLOCK).select("way", "head", "fp")
    again = again.select("way", "head", F.explode(_patterns(ways, radius)).alias("tail"), "fp")
    return (
        plain.unionByName(again)
        .repartition("way", "head", "tail")
        .sortWithinPartitions("way", "head", "tail", "fp")
        .mapInArrow(_bucket_batches(radius), "a long, b long")
    )


def _patterns(ways: list[int], radius: int) -> Column:
    """The left-out bits of ``fp`` with up to half the radius flipped, for its way."""
    cases = None
    for way, mask in enumerate(ways):
        tail = F.col("fp").bitwiseAND(F.lit(_signed(mask)))
        near = F.array(*[tail.bitwiseXOR(F.lit(x)) for x in _flips(mask, -(-radius // 2))])
        cases = F.when(F.col("way") == way, near) if cases is None else cases.when(F.col("way") == way, near)
    return cases if cases is not None else F.array(F.lit(0).cast("long"))


def _classes(prints: DataFrame, first: Column, radius: int) -> DataFrame:
    """(fp, kept) with the least ``first`` of the component of each distinct fingerprint."""
    classes = materialize(prints.groupBy("fp").agg(F.min(first).alias("least")), "classes")
    roots = components(links(classes.select("fp"), radius))
    rooted = classes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    kept = rooted.groupBy("root").agg(F.min("least").alias("kept"))
    return materialize(rooted.join(kept, "root").select("fp", "kept"), "components")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 3,
    radius: int = 2,
) -> DataFrame:
    """``id_col``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row.

    The component id is the least id reachable over links of at most ``radius`` bits. Null and
    blank texts have fingerprint zero and link like any other. Null ids are no candidates for
    the least id: a component of such rows only has a null id. Repeated rows stay repeated. An
    empty table gives no rows. Other columns are not read.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    prints = materialize(fingerprints(rows, "text", shingle_words), "fingerprints")
    classes = _classes(prints, F.col("id"), radius)
    return prints.join(classes, "fp").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("kept").alias("component_id"),
    )


def drop_near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 3,
    radius: int = 2,
) -> DataFrame:
    """One row of every component, all columns: the least id, nulls last, then file order.

    Repeated rows with one id count as members of their component, so one of them stays.
    """
    file, row = unused("vm_file", docs.columns), unused("vm_row", docs.columns)
    keyed = with_row_key(docs, file, row)
    rows = keyed.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(file).alias("file"),
        F.col(row).alias("row"),
        F.col(f"`{text_col}`").alias("text"),
    )
    prints = materialize(fingerprints(rows, "text", shingle_words), "fingerprints")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "file", "row")
    classes = _classes(prints, order, radius)
    # the dropped rows are few, so their join is the one that may turn out to need no shuffle
    dropped = prints.join(classes, "fp").where(
        (F.col("kept.file") != F.col("file")) | (F.col("kept.row") != F.col("row"))
    )
    dropped = materialize(
        dropped.select(F.col("file").alias(file), F.col("row").alias(row)), "dropped_rows"
    )
    return keyed.join(dropped, [file, row], "left_anti").select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )
