"""Mixing sources to target weights by systematic sampling.

Targets are filled like water: each source gets its share by weight, a source that would get
more than ``most`` times its size stops there, and what is left is shared again by weight among
the others until none is above. Each round reads two sums, never the sources themselves.

A document of a source is expected ``target / source size`` times. The documents of a source
stand in order of size, expected copies are summed along that order, one random offset per
source is added, and a document is emitted once for each integer that its stretch crosses. The
order makes neighbours alike in size, so the words taken stay close to the target.

Places in the order come from one range sort over all rows, which cuts a large source like any
other, and one running sum per source over the ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velomart.llm.common import n_words, unused, with_row_key
from velomart.operators.ranking import with_row_number
from velomart.workspace import materialize

#: An offset is a multiple of 1 / OFFSETS, so it adds exactly to whole numbers of copies.
OFFSETS = 1 << 20
_ROW_BITS = 33


def source_targets(sizes: DataFrame, weights: tuple[int, ...], budget: float, most: int) -> DataFrame:
    """(source, source_size, weight, target) from (source, source_size), nulls last in order."""
    ordered = with_row_number(sizes, [F.col("source").asc_nulls_last()], "nth")
    cycle = F.array(*[F.lit(w) for w in weights])
    turn = F.pmod(F.col("nth") - 1, F.lit(len(weights))).cast("int") + 1
    weighed = materialize(
        ordered.select("source", "source_size", F.element_at(cycle, turn).alias("weight")),
        "weighed_sources",
    )
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    level, stopped = None, None
    while total:
        full = F.lit(False) if level is None else F.col("weight") * level >= F.col("source_size") * most
        state = weighed.agg(
            F.coalesce(F.sum(F.when(full, F.col("source_size"))), F.lit(0)).alias("held"),
            F.count(F.when(full, 1)).alias("n"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)).alias("open"),
        ).first()
        if state.n == stopped or not state.open:
            break
        level, stopped = (budget * total - most * state.held) / state.open, state.n
    share = F.lit(0.0) if level is None else F.col("weight") * F.lit(level)
    return weighed.withColumn("target", F.least(share, (F.col("source_size") * most).cast("double")))


def _offset(source: Column, seed: int) -> Column:
    """The offset of a source in [0, 1), from its name and the seed."""
    digest = F.md5(F.concat(F.coalesce(F.concat(F.lit("="), source), F.lit("null")), F.lit(f"/{seed}")))
    return F.conv(F.substring(digest, 1, 5), 16, 10).cast("long") / F.lit(OFFSETS)


def _places(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` with ``place``: the number of rows of the same source that stand before."""
    # no fixed number of ranges: adaptive execution sizes them
    numbered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = numbered.withColumn("vm_n", F.monotonically_increasing_id())
    stored = materialize(numbered.withColumn("vm_range", F.shiftright("vm_n", _ROW_BITS)), "ordered_rows")
    parts = stored.groupBy("source", "vm_range").agg(
        F.count(F.lit(1)).alias("vm_rows"), F.min("vm_n").alias("vm_first")
    )
    before = Window.partitionBy("source").orderBy("vm_range").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        F.col("source").alias("vm_source"),
        "vm_range",
        (F.coalesce(F.sum("vm_rows").over(before), F.lit(0)) - F.col("vm_first")).alias("vm_shift"),
    )
    joined = stored.join(
        parts, (stored["vm_range"] == parts["vm_range"]) & stored["source"].eqNullSafe(parts["vm_source"])
    )
    return joined.select(*[stored[c] for c in rows.columns], (F.col("vm_n") + F.col("vm_shift")).alias("place"))


def _copies(place: Column, rate: Column, offset: Column, most: int) -> Column:
    crossed = F.floor(offset + (place + 1) * rate) - F.floor(offset + place * rate)
    return F.least(crossed, F.lit(most)).cast("long")


def _mixed(
    docs: DataFrame,
    id_col: str,
    source_col: str,
    text_col: str,
    weights: tuple[int, ...],
    budget: float,
    most: int,
    seed: int,
    key: list[str],
) -> DataFrame:
    """(id, source, size, copies, source_size, target) and the ``key`` columns for every row."""
    rows = materialize(
        docs.select(
            F.col(f"`{id_col}`").alias("id"),
            F.col(f"`{source_col}`").cast("string").alias("source"),
            F.coalesce(n_words(F.col(f"`{text_col}`").cast("string")), F.lit(0).cast("long")).alias("size"),
            *[F.col(k).alias(f"vm_key{i}") for i, k in enumerate(key)],
        ),
        "sizes",
    )
    keys = [F.col(f"vm_key{i}") for i in range(len(key))]
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = materialize(source_targets(sizes, weights, budget, most), "targets")
    order = [F.col("source").asc_nulls_last(), F.col("size"), F.col("id").asc_nulls_last(), *keys]
    placed = _places(rows, order)
    targets = targets.withColumnRenamed("source", "vm_of")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return placed.join(targets, placed["source"].eqNullSafe(targets["vm_of"])).select(
        "id",
        "source",
        "size",
        "source_size",
        "target",
        _copies(F.col("place"), rate, _offset(F.col("source"), seed), most).alias("copies"),
        *keys,
    )


def mix_plan(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    weights: tuple[int, ...] = (3, 1, 2),
    budget: float = 1.5,
    most: int = 2,
    seed: int = 20,
) -> DataFrame:
    """(id, size, source_size, target, taken, copies) of every row; see ``mix``."""
    file, row = unused("vm_file", docs.columns), unused("vm_row", docs.columns)
    keyed = with_row_key(docs, file, row)
    found = _mixed(keyed, id_col, source_col, text_col, weights, budget, most, seed, [file, row])
    return found.select(
        F.col("id").alias(id_col),
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        "copies",
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    weights: tuple[int, ...] = (3, 1, 2),
    budget: float = 1.5,
    most: int = 2,
    seed: int = 20,
    copy_col: str = "copy",
) -> DataFrame:
    """The mix itself: every row of ``docs`` once per copy, numbered from 0 in ``copy_col``.

    Sizes are words; a null text has size 0. Sources weigh ``weights`` in turn, by code point,
    a null source last and on its own. All sources share ``budget`` times all sizes, and no
    source or document exceeds ``most`` times its size. Rows are drawn in the order of size,
    id (nulls last) and place in their file, so repeated rows and ids are drawn one by one and
    reruns agree. A source without words has target 0 and gives no copies. An empty table gives
    no rows; other columns pass through.
    """
    file, row = unused("vm_file", docs.columns), unused("vm_row", docs.columns)
    keyed = with_row_key(docs, file, row)
    found = _mixed(keyed, id_col, source_col, text_col, weights, budget, most, seed, [file, row])
    copies = unused("vm_copies", docs.columns)
    drawn = found.where("copies > 0").select(
        F.col("vm_key0").alias(file), F.col("vm_key1").alias(row), F.col("copies").alias(copies)
    )
    numbers = F.explode(F.sequence(F.lit(0), F.col(copies).cast("int") - 1))
    return keyed.join(drawn, [file, row]).select(
        *[F.col(f"`{c}`") for c in docs.columns], numbers.alias(unused(copy_col, docs.columns))
    )
