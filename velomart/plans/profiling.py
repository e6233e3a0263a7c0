"""Profiling of raw trip files before any rule is written."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velomart.functions import clean_text, elapsed
from velomart.functions.columns import WHITE_SPACE
from velomart.params import Params

# Fixed value: the plain numeric station id.
NUMERIC_ID = r"^[0-9]+(\.[0-9]+)?$"


def _rows() -> Column:
    return F.count(F.lit(1))


def header_consistency(lines: DataFrame, header_start: str = "ride_id") -> DataFrame:
    """Columns per file and how they differ from the most common header.

    ``lines`` holds the text lines of the files with ``_source_file``; header lines start
    with the first column name, quoted or not.
    """
    names = F.split(F.regexp_replace("value", r'["\r﻿]', ""), ",")
    is_header = F.regexp_replace(F.substring("value", 1, 200), r'["﻿]', "").startswith(
        header_start
    )
    headers = (
        lines.where(is_header)
        .select("_source_file", F.array_sort(names).alias("columns"))
        .distinct()
    )
    common = headers.groupBy("columns").agg(_rows().alias("n"))
    base = common.agg(F.min_by("columns", F.struct(-F.col("n"), "columns"))).scalar()
    return headers.select(
        "_source_file",
        F.size("columns").cast("long").alias("n_cols"),
        F.array_join(F.array_except("columns", base), "|").alias("extra_columns"),
        F.array_join(F.array_except(base, "columns"), "|").alias("missing_columns"),
    )


def cast_failures(text: DataFrame, casts: dict[str, str]) -> DataFrame:
    """Per column: values lost by the cast, and values that were blank to begin with."""
    blank = {c: clean_text(F.col(c)).isNull() for c in casts}
    lost = {c: ~blank[c] & F.col(c).try_cast(t).isNull() for c, t in casts.items()}
    counts = text.agg(
        *[F.count_if(lost[c]).alias(f"{c}_lost") for c in casts],
        *[F.count_if(blank[c]).alias(f"{c}_blank") for c in casts],
    )
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"{c}_lost").alias("cast_failures"),
            F.col(f"{c}_blank").alias("blank_values"),
        )
        for c in casts
    ]
    return counts.select(F.inline(F.array(*rows)))


def trip_profile(trips: DataFrame, p: Params) -> DataFrame:
    """One row: range, duplicates, durations, coordinates."""
    c = F.col
    seconds = elapsed("SECOND", c("ended_at"), c("started_at"))
    sides = ("start", "end")
    no_place = {s: c(f"{s}_lat").isNull() | c(f"{s}_lng").isNull() for s in sides}
    inside = reduce(
        lambda a, b: a & b,
        [
            c(f"{s}_lat").between(p.lat_min, p.lat_max)
            & c(f"{s}_lng").between(p.lng_min, p.lng_max)
            for s in sides
        ],
    )
    placed = ~no_place["start"] & ~no_place["end"]
    totals = trips.agg(
        _rows().alias("total_rows"),
        F.countDistinct("ride_id").alias("distinct_rides"),
        F.min("started_at").alias("first_started_at"),
        F.max("ended_at").alias("last_ended_at"),
        F.min(seconds).alias("min_seconds"),
        F.round(F.avg(seconds), 2).alias("avg_seconds"),
        F.max(seconds).alias("max_seconds"),
        F.count_if(seconds < 0).alias("negative_durations"),
        F.count_if(seconds > p.max_trip_duration_seconds).alias("extreme_durations"),
        F.count_if(no_place["start"]).alias("start_without_place"),
        F.count_if(no_place["end"]).alias("end_without_place"),
        F.count_if(c("start_lat").isNull() & c("end_lat").isNull()).alias("both_without_lat"),
        F.count_if(placed & ~inside).alias("outside_box"),
    )
    return totals.withColumn("duplicate_rows", c("total_rows") - c("distinct_rides"))


def category_counts(trips: DataFrame) -> DataFrame:
    """Rows per rideable type and per rider type, from one pass."""
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("column_name"), F.col(name).alias("category"))
            for name in ("rideable_type", "member_casual")
        ]
    )
    return trips.select(F.inline(pairs)).groupBy("column_name", "category").agg(
        _rows().alias("n")
    )


def _observed_stations(trips: DataFrame) -> DataFrame:
    ends = F.array(
        *[
            F.struct(
                F.col(f"{s}_station_id").alias("station_id"),
                F.col(f"{s}_station_name").alias("station_name"),
            )
            for s in ("start", "end")
        ]
    )
    seen = trips.select(F.inline(ends)).where("station_id IS NOT NULL AND station_id <> ''")
    return seen.groupBy("station_id", "station_name").agg(_rows().alias("n"))


def station_id_profile(trips: DataFrame) -> DataFrame:
    """Per raw station id: rows, names, format, and whether the base of a suffixed id exists."""
    ids = (
        _observed_stations(trips)
        .groupBy("station_id")
        .agg(F.sum("n").alias("row_count"), F.countDistinct("station_name").alias("name_count"))
    )
    plain = F.col("station_id").rlike(NUMERIC_ID)
    suffixed = F.col("station_id").endswith("_")
    kind = F.when(plain, "numeric").when(suffixed, "suffixed").otherwise("other")
    base = F.when(suffixed, F.regexp_replace("station_id", "_$", ""))
    known = ids.where(plain).select(F.col("station_id").alias("_base"), F.lit(True).alias("_has"))
    return (
        ids.withColumns({"id_format": kind, "_base": base})
        .join(known, "_base", "left")
        .select(
            "station_id",
            "row_count",
            "name_count",
            "id_format",
            (F.col("name_count") > 1).alias("has_several_names"),
            F.when(F.col("_base").isNotNull(), F.coalesce("_has", F.lit(False))).alias(
                "base_exists"
            ),
        )
    )


def station_profile_totals(trips: DataFrame) -> DataFrame:
    """One row: ids, names, pairs, rows with an unusual id, names with outer spaces."""
    pairs = _observed_stations(trips)
    odd = ~F.col("station_id").rlike(NUMERIC_ID)
    spaced = F.col("station_name") != F.btrim("station_name", F.lit(WHITE_SPACE))
    counted = F.col("n")
    return pairs.agg(
        F.sum("n").alias("station_rows"),
        F.countDistinct("station_id").alias("distinct_ids"),
        F.countDistinct("station_name").alias("distinct_names"),
        _rows().alias("id_name_pairs"),
        F.sum(F.when(odd, counted).otherwise(0)).alias("odd_id_rows"),
        F.sum(F.when(spaced, counted).otherwise(0)).alias("spaced_name_rows"),
    )


def trips_per_day(trips: DataFrame) -> DataFrame:
    return trips.groupBy(F.to_date("started_at").alias("day")).agg(_rows().alias("trips"))


def trips_per_month(trips: DataFrame) -> DataFrame:
    """Trips, days and the rounded daily mean per month."""
    days = trips_per_day(trips)
    return days.groupBy(F.date_format("day", "yyyy-MM").alias("month")).agg(
        F.sum("trips").alias("total_trips"),
        _rows().alias("day_count"),
        F.round(F.avg("trips"), 0).alias("mean_trips_per_day"),
    )


def file_boundaries(trips: DataFrame) -> DataFrame:
    """First and last times per file; shows whether files are cut by start or by end."""
    return trips.groupBy("_source_file").agg(
        _rows().alias("row_count"),
        F.min("started_at").alias("first_started_at"),
        F.max("started_at").alias("last_started_at"),
        F.min("ended_at").alias("first_ended_at"),
        F.max("ended_at").alias("last_ended_at"),
    )


def duration_histogram(trips: DataFrame, upto_seconds: int = 7_200, bins: int = 60) -> DataFrame:
    """Trips per duration bin up to a limit."""
    seconds = elapsed("SECOND", F.col("ended_at"), F.col("started_at"))
    width = upto_seconds / bins
    number = F.least(F.floor(seconds / F.lit(width)), F.lit(bins - 1))
    return (
        trips.where((seconds >= 0) & (seconds <= upto_seconds))
        .groupBy(number.cast("long").alias("bin"))
        .agg(_rows().alias("trips"))
        .withColumn("from_seconds", F.col("bin") * width)
    )
