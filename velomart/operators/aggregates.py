"""Aggregates the built-in functions do not name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_by(value: Column, *order: Column) -> Column:
    """The non-null ``value`` that sorts first by ``order``; the value itself breaks ties.

    Apply it to pre-aggregated rows: the ordering struct is not hash-aggregatable.
    """
    ranked = F.when(value.isNotNull(), F.struct(*order, value))
    return F.min_by(value, ranked)


def signed_endpoints(trips: DataFrame, start_id: str, end_id: str, *by: str) -> DataFrame:
    """Departures and arrivals per station and ``by``, from one pass over the trips.

    Each trip contributes a departure and an arrival row that are summed map-side, which
    replaces two aggregations and their full outer join, and flattens hot stations.
    """
    departure = F.struct(
        F.col(start_id).alias("station_id"),
        F.lit(1).cast("long").alias("departures"),
        F.lit(0).cast("long").alias("arrivals"),
    )
    arrival = F.struct(
        F.col(end_id).alias("station_id"),
        F.lit(0).cast("long").alias("departures"),
        F.lit(1).cast("long").alias("arrivals"),
    )
    departures, arrivals = F.sum("departures"), F.sum("arrivals")
    return (
        trips.select(*by, F.inline(F.array(departure, arrival)))
        .where(F.col("station_id").isNotNull())
        .groupBy(*by, "station_id")
        .agg(
            departures.alias("departure_count"),
            arrivals.alias("arrival_count"),
            (departures + arrivals).alias("total_activity"),
            (departures - arrivals).alias("net_flow"),
        )
    )
