"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velomart.workspace import materialize


def keep_latest(
    df: DataFrame,
    keys: Sequence[str],
    latest_by: Sequence[str],
    first_by: Sequence[Column] = (),
) -> DataFrame:
    """The row per key with the greatest ``latest_by`` columns.

    ``first_by`` orderings come after them and every remaining column breaks the ties that
    are left. The ``= 1`` filter directly on the row number lets Catalyst cut each map
    partition to one row per key before the shuffle, so a key holding a third of the input
    reaches its reducer as one row per map task.
    """
    rest = [c for c in df.columns if c not in keys and c not in latest_by]
    order = [F.col(c).desc_nulls_last() for c in latest_by]
    order += list(first_by)
    order += [F.col(c).asc_nulls_last() for c in rest]
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_position", F.row_number().over(window))
        .where(F.col("_position") == 1)
        .drop("_position")
    )


def merge_states(
    current: DataFrame, incoming: DataFrame, keys: Sequence[str], latest_by: Sequence[str]
) -> DataFrame:
    """Upsert: rows of both inputs, one per key, the latest one winning."""
    return keep_latest(current.unionByName(incoming), keys, latest_by)


#: Hashes are told apart by so many bits when they are counted.
_COUNTED_BITS = 36
#: Bits of the marks: so many per repeated hash, a power of two within these bounds. Where more hashes
#: are repeated than that allows for, more single rows are marked, which costs time and changes no result.
_BITS_EACH, _LEAST_BITS, _MOST_BITS = 32, 2**12, 2**28


@dataclass(frozen=True)
class Marks:
    """A bitmap over hashes: blocks of 64 words of 64 bits, as a stored table."""

    blocks: DataFrame
    size: int


def _place(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys).bitwiseAND(F.lit(2**_COUNTED_BITS - 1))


def marks_of_repeated(df: DataFrame, keys: Sequence[str]) -> Marks:
    """Marks of every key that ``df`` holds more than once, at most 32 MB. Only hashes are shuffled."""
    counted = df.select(_place(keys).alias("_at")).groupBy("_at").agg(F.count(F.lit(1)).alias("_n"))
    repeated = materialize(counted.where("_n > 1").select("_at"), "repeated")
    size = min(max(2 ** (_BITS_EACH * repeated.count()).bit_length(), _LEAST_BITS), _MOST_BITS)
    bits = repeated.select(F.col("_at").bitwiseAND(F.lit(size - 1)).alias("_at"))
    words = bits.groupBy(F.shiftright("_at", 6).alias("_word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(_at & 63 AS int)))").alias("_bits")
    )
    entry = F.struct(F.expr("cast(_word & 63 AS int)"), "_bits")
    blocks = words.groupBy(F.shiftright("_word", 6).alias("_block")).agg(
        F.map_from_entries(F.collect_list(entry)).alias("_set")
    )
    dense = F.expr("transform(sequence(0, 63), k -> coalesce(_set[k], 0L))")
    return Marks(materialize(blocks.select("_block", dense.alias("_words")), "marks"), size)


def marked_apart(df: DataFrame, keys: Sequence[str], marks: Marks) -> tuple[DataFrame, DataFrame]:
    """(rows whose key is there once, other rows), by the marks of a table that holds all of ``df``.

    The rows of one key are all on one side, and no row moves, since the marks are broadcast. Hashes
    meet, so that a few single rows are among the others.
    """
    at = _place(keys).bitwiseAND(F.lit(marks.size - 1))
    word = F.get("_words", F.shiftright(at, 6).bitwiseAND(F.lit(63)).cast("int"))
    marked = F.coalesce(F.getbit(word, at.bitwiseAND(F.lit(63)).cast("int")) == 1, F.lit(False))
    block = F.shiftright(at, 12) == F.col("_block")
    placed = df.join(F.broadcast(marks.blocks), block, "left")
    return placed.where(~marked).select(*df.columns), placed.where(marked).select(*df.columns)
