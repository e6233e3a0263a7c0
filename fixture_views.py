"""The raw tables of the engine, derived from the driver's parquet tables by Spark SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from velomart.params import Params
from velomart.plans.models import Models
from velomart.schemas import STATION_INFORMATION, STATION_STATUS, TRIPS, conform
from velomart.workspace import SESSION_SETTINGS, materialize

PARAMS = Params(
    max_trip_duration_seconds=190_080_000,
    freshness_minutes=720,
    gap_minutes=2_880,
    as_of=dt.datetime(2024, 2, 1),
)

TRIPS_SQL = """
WITH b AS (
  SELECT /*+ MERGE(o) */ l.*, o.o_orderdate, c.c_mktsegment,
         l_suppkey AS sk, l_partkey % 50 AS ek,
         CASE WHEN l_partkey % 50 = 0 THEN o_orderdate ELSE least(o_orderdate, l_shipdate) END AS s0,
         CASE WHEN l_partkey % 50 = 0 THEN l_shipdate ELSE greatest(o_orderdate, l_shipdate) END AS e0
  FROM {lineitem} l JOIN {orders} o ON l_orderkey = o_orderkey
                  JOIN {customer} c ON o_custkey = c_custkey)
SELECT concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS ride_id,
  CASE WHEN l_linestatus = 'O' THEN ' Electric_Bike ' ELSE 'classic_bike' END AS rideable_type,
  s0 + (l_partkey % 24) * INTERVAL '1' HOUR AS started_at,
  e0 + (l_partkey % 24) * INTERVAL '1' HOUR + CAST(l_quantity AS INT) * INTERVAL '1' MINUTE AS ended_at,
  concat('Station ', CAST(CAST(floor(sk / 2) AS BIGINT) AS STRING), ' ') AS start_station_name,
  CASE WHEN l_quantity = 1 THEN NULL
       WHEN l_linenumber = 7 AND l_partkey % 20 = 0 THEN 'Shop Morgan'
       WHEN l_linenumber = 6 THEN concat(CAST(5000 + sk AS STRING), '.01_')
       WHEN l_linenumber = 5 THEN concat('  ', CAST(5000 + sk AS STRING), '.01')
       ELSE concat(CAST(5000 + sk AS STRING), '.01') END AS start_station_id,
  concat('Station ', CAST(CAST(floor(ek / 2) AS BIGINT) AS STRING)) AS end_station_name,
  concat(CAST(5000 + ek AS STRING), '.01') AS end_station_id,
  CASE WHEN l_linenumber = 4 AND l_partkey % 25 = 0 THEN NULL
       WHEN l_partkey % 333 = 0 THEN CAST(41.5 AS DOUBLE)
       ELSE round(CAST(40.5 AS DOUBLE) + (CAST(floor(sk / 2) AS BIGINT) % 100) * CAST(0.004 AS DOUBLE), 6) END AS start_lat,
  CAST(-74.0 AS DOUBLE) AS start_lng,
  round(CAST(40.5 AS DOUBLE) + (CAST(floor(ek / 2) AS BIGINT) % 100) * CAST(0.004 AS DOUBLE), 6) AS end_lat,
  CAST(-74.0 AS DOUBLE) AS end_lng,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 'casual' ELSE 'member' END AS member_casual,
  concat('trips_', CAST(year(o_orderdate) AS STRING), '.csv') AS _source_file,
  l_shipdate AS _ingested_at,
  CAST(s0 AS DATE) AS _ride_started_date
FROM b
"""

STATION_STATUS_SQL = """
WITH e AS (
  SELECT *, 10 + user_id % 40 AS cap,
         date_trunc('day', ts) + (user_id % 24) * INTERVAL '1' HOUR AS lr FROM {events}),
f AS (
  SELECT *, CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 101 = 0 THEN -1
                 ELSE CAST(floor(value) AS BIGINT) % (cap + 2) END AS bikes FROM e)
SELECT concat('g-', CAST(user_id AS STRING)) AS station_id,
  bikes AS num_bikes_available, CAST(0 AS BIGINT) AS num_ebikes_available,
  CAST(NULL AS BIGINT) AS num_scooters_available,
  greatest(cap - coalesce(bikes, 0), 0) AS num_docks_available,
  CAST(0 AS BIGINT) AS num_bikes_disabled, CAST(0 AS BIGINT) AS num_docks_disabled,
  TRUE AS is_installed, (event_type <> 'error' OR event_id % 3 <> 0) AS is_renting,
  TRUE AS is_returning, CAST(NULL AS BOOLEAN) AS is_disabled,
  CASE WHEN event_id % 200 = 0 THEN date_trunc('day', ts) - INTERVAL '20000' DAY
       WHEN event_id % 331 = 0 THEN ts + INTERVAL '2' DAY ELSE lr END AS last_reported,
  date_trunc('day', ts) + INTERVAL '1' DAY AS snapshot_timestamp,
  ts AS _ingested_at, CAST(date_trunc('day', ts) + INTERVAL '1' DAY AS DATE) AS _snapshot_date
FROM f
"""

STATION_INFORMATION_SQL = """
SELECT DISTINCT concat('g-', CAST(user_id AS STRING)) AS station_id,
  concat('Info ', CAST(user_id AS STRING)) AS name,
  CASE WHEN user_id % 20 = 0 THEN NULL ELSE concat(CAST(5000 + user_id AS STRING), '.01') END AS short_name,
  CAST(40.7 AS DOUBLE) AS lat, CAST(-73.9 AS DOUBLE) AS lon,
  CASE WHEN user_id % 25 = 0 THEN 0 ELSE 10 + user_id % 40 END AS capacity,
  CASE WHEN user_id % 10 = 0 THEN NULL ELSE CAST(user_id % 5 AS STRING) END AS region_id
FROM {events}
"""


# Declared, so that reading a table starts no inference job.
BASE_SCHEMAS = {
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "customer": "c_custkey bigint, c_mktsegment string",
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(BASE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _view(spark: SparkSession, sf_dir: str, sql: str, *names: str) -> DataFrame:
    for key, value in SESSION_SETTINGS.items():
        spark.conf.set(key, value)
    return spark.sql(sql, **{n: table(spark, sf_dir, n) for n in names})


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lazy view, for queries that read the trips once."""
    return conform(_view(spark, sf_dir, TRIPS_SQL, "lineitem", "orders", "customer"), TRIPS)


def raw_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(_view(spark, sf_dir, STATION_STATUS_SQL, "events"), STATION_STATUS)


def raw_information(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(_view(spark, sf_dir, STATION_INFORMATION_SQL, "events"), STATION_INFORMATION)


def models(spark: SparkSession, sf_dir: str, store_trips: bool = False) -> Models:
    """The model graph over a stored raw trips table, which the mapping and staging both read."""
    trips = materialize(raw_trips(spark, sf_dir), "raw_trips")
    status, information = raw_status(spark, sf_dir), raw_information(spark, sf_dir)
    return Models(trips, status, information, PARAMS, store_trips)
