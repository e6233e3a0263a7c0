"""Helpers of the training-data operators: row identity and stored intermediates."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velomart.workspace import materialize

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"
#: A word of the contracts: a run of anything but blank, tab, line feed, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"


def unused(wanted: str, taken: Iterable[str]) -> str:
    """``wanted``, lengthened until no column has that name in any letter case."""
    names = {name.lower() for name in taken}
    while wanted.lower() in names:
        wanted += "_"
    return wanted


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def filter_in_arrow(docs: DataFrame, run) -> DataFrame:
    """``docs.mapInArrow`` for a function that keeps the columns, whatever their names are."""
    numbered = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    return numbered.mapInArrow(run, numbered.schema).toDF(*docs.columns)


def with_row_key(df: DataFrame, file: str, row: str) -> DataFrame:
    """``df`` with two longs that name each row of its files.

    File and row number do not depend on how a scan is split, so a second scan, or a task that
    runs again on another executor, sees the same key. A frame that is no plain file scan is
    written once below the shared folder first.
    """
    key = (
        F.xxhash64("_metadata.file_path").alias(file),
        F.col("_metadata.row_index").alias(row),
    )
    if "_metadata" not in (name.lower() for name in df.columns):
        try:
            return df.select("*", *key)
        except AnalysisException:
            return materialize(df, "rows").select("*", *key)
    clash = next(name for name in df.columns if name.lower() == "_metadata")
    stand_in = unused("_metadata_column", df.columns)
    stored = materialize(df.withColumnRenamed(clash, stand_in), "rows")
    return stored.select("*", *key).withColumnRenamed(stand_in, clash)
