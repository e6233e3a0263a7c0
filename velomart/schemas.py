"""Declared schemas of the raw tables. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "date": T.DateType(),
    "strings": T.ArrayType(T.StringType()),
}


def _struct(required: str, **columns: str) -> T.StructType:
    return T.StructType(
        [T.StructField(name, _TYPES[kind], name != required) for name, kind in columns.items()]
    )


TRIPS = _struct(
    "ride_id",
    ride_id="string",
    rideable_type="string",
    started_at="timestamp_ntz",
    ended_at="timestamp_ntz",
    start_station_name="string",
    start_station_id="string",
    end_station_name="string",
    end_station_id="string",
    start_lat="double",
    start_lng="double",
    end_lat="double",
    end_lng="double",
    member_casual="string",
    _source_file="string",
    _ingested_at="timestamp",
    _ride_started_date="date",
)

STATION_STATUS = _struct(
    "station_id",
    station_id="string",
    num_bikes_available="long",
    num_ebikes_available="long",
    num_scooters_available="long",
    num_docks_available="long",
    num_bikes_disabled="long",
    num_docks_disabled="long",
    is_installed="boolean",
    is_renting="boolean",
    is_returning="boolean",
    is_disabled="boolean",
    last_reported="timestamp",
    snapshot_timestamp="timestamp",
    _ingested_at="timestamp",
    _snapshot_date="date",
)

STATION_STATUS_DLQ = _struct(
    "",
    raw_payload="string",
    error_reason="string",
    kafka_topic="string",
    kafka_partition="long",
    kafka_offset="long",
    failed_at="timestamp",
)

STATION_INFORMATION = _struct(
    "station_id",
    station_id="string",
    name="string",
    short_name="string",
    lat="double",
    lon="double",
    capacity="long",
    region_id="string",
    rental_methods="strings",
    eightd_has_key_dispenser="boolean",
    _ingested_at="timestamp",
)

DQ_METRICS = _struct(
    "",
    run_date="date",
    layer="string",
    run_id="string",
    total_rows="long",
    valid_rows="long",
    rejected_rows="long",
    duplicate_rows="long",
    rejected_pct="double",
    noted_at="timestamp",
)

TRIP_CSV_COLUMNS = [f.name for f in TRIPS.fields if not f.name.startswith("_")]


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the columns of ``schema`` with their types; absent columns become typed NULLs."""
    present = set(df.columns)

    def pick(field: T.StructField) -> Column:
        source = F.col(field.name) if field.name in present else F.lit(None)
        return source.cast(field.dataType).alias(field.name)

    return df.select(*[pick(field) for field in schema.fields])
