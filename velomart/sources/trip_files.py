"""Monthly trip CSV files: discovery, typed reading, ingestion columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velomart.params import CSV_NULL_TOKENS
from velomart.schemas import TRIP_CSV_COLUMNS, TRIPS, conform

TRIP_FILE_PATTERN = "*.csv"

_TEXT = T.StructType([T.StructField(c, T.StringType()) for c in TRIP_CSV_COLUMNS])


def discover_files(
    spark: SparkSession, folder: str, pattern: str = TRIP_FILE_PATTERN, limit: int = 0
) -> list[str]:
    """Sorted paths matching ``pattern``; a positive ``limit`` keeps the first ones."""
    listing = (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    ).select("path")
    paths = listing.orderBy("path")
    found = [row.path for row in (paths.limit(limit) if limit > 0 else paths).collect()]
    if not found:
        raise FileNotFoundError(f"no file matches {pattern!r} in {folder}")
    return found


def read_trip_text(
    spark: SparkSession, paths: str | Sequence[str], multi_line: bool = False
) -> DataFrame:
    """Every column as text, missing-value tokens as NULL, with the file name.

    The header of each file is compared with the schema; a file with other columns fails
    the read instead of shifting values. ``multi_line`` allows line breaks inside quotes,
    at the price of one task per file.
    """
    rows = (
        spark.read.schema(_TEXT)
        .option("header", True)
        .option("enforceSchema", False)
        .option("multiLine", multi_line)
        .csv(paths if isinstance(paths, str) else list(paths))
    )
    columns = [
        F.when(~F.col(c).isin(*CSV_NULL_TOKENS), F.col(c)).alias(c) for c in TRIP_CSV_COLUMNS
    ]
    return rows.select(*columns, F.col("_metadata.file_name").alias("_source_file"))


def _number(text: Column) -> Column:
    # a Java type suffix such as 1.5d is not a number in a CSV file
    return F.when(~text.rlike("[dDfF]$"), text).try_cast("double")


def typed_trips(text: DataFrame, ingested_at: dt.datetime) -> DataFrame:
    """Raw trips; text that does not parse is NULL."""
    times = {c: F.col(c).try_cast("timestamp_ntz") for c in ("started_at", "ended_at")}
    places = {c: _number(F.col(c)) for c in ("start_lat", "start_lng", "end_lat", "end_lng")}
    typed = text.withColumns({**times, **places}).withColumns(
        {
            "_ingested_at": F.lit(ingested_at).cast("timestamp"),
            "_ride_started_date": F.to_date("started_at"),
        }
    )
    return conform(typed, TRIPS)


def split_unplaceable(trips: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with a start time, rows without one for the quarantine).

    Rows without a start time belong to no date partition; they are kept aside, not lost.
    """
    placed = F.col("started_at").isNotNull()
    lost = trips.where(~placed).withColumn("rejection_reason", F.lit("missing_started_at"))
    return trips.where(placed), lost
