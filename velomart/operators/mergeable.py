"""Distinct counts and quantiles as state that merges: figures of a month from its days.

Distinct values are exact: each value has a dense number, and a state row holds a bitmap over 32 768
of these numbers, so states merge by an or. Quantiles are held in KLL sketches, whose rank error is
bounded whatever was merged; ``rank_error`` gives the bound. The exact forms stay where rows are read
anyway (``count_distinct``, histograms).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velomart.operators.ranking import with_row_number


def extended_numbers(values: DataFrame, column: str, known: DataFrame | None = None) -> DataFrame:
    """(column, number) for every distinct non-null value; a known value keeps its number.

    Numbers are dense from 1, and new values follow the known ones in their order.
    """
    new = values.select(column).where(F.col(column).isNotNull()).distinct()
    if known is None:
        return with_row_number(new, [F.col(column)], "number")
    new = new.join(known, column, "left_anti")
    last = known.agg(F.coalesce(F.max("number"), F.lit(0))).scalar()
    numbered = with_row_number(new, [F.col(column)], "number")
    return known.unionByName(numbered.withColumn("number", F.col("number") + last))


def distinct_state(rows: DataFrame, by: Sequence[str], number: Column) -> DataFrame:
    """(by, bucket, bitmap): the numbers that occur; a NULL is no value."""
    found = rows.select(*by, number.alias("_n")).where("_n IS NOT NULL")
    bucket, bit = F.bitmap_bucket_number("_n"), F.bitmap_bit_position("_n")
    return found.groupBy(*by, bucket.alias("bucket")).agg(F.bitmap_construct_agg(bit).alias("bitmap"))


def merged_distinct(state: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, n): distinct values of states together."""
    whole = state.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return whole.groupBy(*by).agg(F.sum(F.bitmap_count("bitmap")).alias("n"))


def rank_error(k: int) -> float:
    """The rank error that a sketch of size ``k`` keeps with 99 % confidence (published bound)."""
    return 2.296 / k**0.9021


def quantile_state(rows: DataFrame, by: Sequence[str], value: Column, k: int = 400) -> DataFrame:
    """(by, sketch, n) of whole numbers."""
    found = rows.select(*by, value.cast("long").alias("_v")).where("_v IS NOT NULL")
    return found.groupBy(*by).agg(
        F.kll_sketch_agg_bigint("_v", k).alias("sketch"), F.count(F.lit(1)).alias("n")
    )


def merged_quantile(state: DataFrame, by: Sequence[str], share: float, k: int = 400) -> DataFrame:
    """(by, value, n): the value below which ``share`` of all values of the states lie."""
    whole = state.groupBy(*by).agg(F.kll_merge_agg_bigint("sketch", k).alias("sketch"), F.sum("n").alias("n"))
    return whole.select(*by, F.kll_sketch_get_quantile_bigint("sketch", F.lit(share)).alias("value"), "n")
