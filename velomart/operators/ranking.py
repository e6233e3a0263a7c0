"""Global ranks without a single-task window.

A window without ``PARTITION BY`` pulls every row into one task. Here the rows (or, for
ranks with ties, their distinct sort keys with counts) are range-partitioned, sorted, and
written once. The stored numbering gives each row its place inside its range; one small
total per range gives the offset of the range. Only those totals, one row per range, are
ever summed in a single place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velomart.workspace import materialize

# monotonically_increasing_id keeps the partition above bit 33 and the row below it
_ROW_BITS = 33


def _sorted_ranges(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """``df`` range-partitioned and sorted by ``order``, stored with _range and _place."""
    numbered = (
        df.repartitionByRange(*order)  # no fixed number: adaptive execution sizes the ranges
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    return materialize(
        numbered.select(
            *df.columns,
            F.shiftright("_id", _ROW_BITS).alias("_range"),
            F.col("_id").bitwiseAND((1 << _ROW_BITS) - 1).alias("_place"),
        ),
        name,
    )


def _range_offsets(ranges: DataFrame, weight: Column) -> DataFrame:
    """How many rows precede each range: one row per range, at most one per task."""
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranges.groupBy("_range")
        .agg(F.sum(weight).alias("_rows"))
        .select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )


def with_row_number(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Global ``row_number`` over an ordering that is unique per row."""
    ranges = _sorted_ranges(df, order, name)
    offsets = _range_offsets(ranges, F.lit(1))
    number = (F.col("_offset") + F.col("_place") + 1).cast("long")
    return (
        ranges.join(F.broadcast(offsets), "_range")
        .withColumn(name, number)
        .select(*df.columns, name)
    )


def _ranked_keys(df: DataFrame, key: str, descending: bool, name: str) -> DataFrame:
    """Distinct values of ``key`` with their competition rank."""
    order = F.col(key).desc_nulls_last() if descending else F.col(key).asc_nulls_first()
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_count"))
    ranges = _sorted_ranges(counts, [order], name)
    offsets = _range_offsets(ranges, F.col("_count"))
    before = (
        Window.partitionBy("_range")
        .orderBy("_place")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = F.coalesce(F.sum("_count").over(before), F.lit(0))
    return ranges.withColumn("_inside", inside).join(F.broadcast(offsets), "_range").select(
        F.col(key).alias("_key"),
        (F.col("_offset") + F.col("_inside") + 1).cast("long").alias(name),
        "_count",
    )


def with_rank(df: DataFrame, key: str, name: str, descending: bool = True) -> DataFrame:
    """Global ``rank`` by one column; equal values share the rank.

    Read ``df`` from a stored table: it is aggregated once and joined once.
    """
    ranks = _ranked_keys(df, key, descending, name).drop("_count")
    return df.join(ranks, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")


def with_percent_rank(df: DataFrame, key: str, name: str, descending: bool = False) -> DataFrame:
    """Global ``percent_rank`` by one column: (rank - 1) / (rows - 1), 0 for a single row."""
    ranks = _ranked_keys(df, key, descending, name)
    others = ranks.agg((F.sum("_count") - 1).cast("double")).scalar()
    share = F.coalesce(F.try_divide((F.col(name) - 1).cast("double"), others), F.lit(0.0))
    ranks = ranks.select("_key", share.alias(name))
    return df.join(ranks, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")
