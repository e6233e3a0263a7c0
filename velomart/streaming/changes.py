"""Change detection on a stream of station facts.

State is a table with the last seen row of each station. A micro-batch is compared with it by
the same plan as the batch archive: a union, one neighbour step and a filter, so a poll with
one row for each of very many stations is a join and not a call per station. Rows at or before
the newest seen time of their station are late and are ignored.

The changes of batch ``n`` go to a ``BatchLog``, which compacts them in tiers, and the next state
to a folder of that number; the batch reads the state of the batch before. A batch that runs again
after a failure therefore reads the same state and replaces exactly its own folders.
"""

from __future__ import annotations

from functools import cache
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from velomart.operators import keep_latest
from velomart.plans.intermediate import ARCHIVE_COLUMNS, compared_rows, status_changes
from velomart.sources import storage
from velomart.streaming.batch_log import BatchLog
from velomart.workspace import scratch_path

_BATCH = "_batch_id"
#: What ``compared_rows`` gives of a station fact.
COMPARED_ROWS = (
    "gbfs_station_id string, snapshot_timestamp timestamp, num_bikes_available long, "
    "num_docks_available long, num_ebikes_available long, num_scooters_available long, "
    "is_installed boolean, is_renting boolean, is_returning boolean, is_disabled boolean, "
    "station_key string, legacy_station_id string, station_name string, risk_level string, "
    "is_operational boolean, is_unknown_station boolean, last_reported timestamp, "
    "report_age_seconds long"
)


def _state_numbers(spark: SparkSession, path: str) -> list[int]:
    files = storage.listing(spark, path)
    if files is None:
        return []
    number = storage.partition_value(_BATCH).try_cast("long")
    return sorted(r[0] for r in files.select(number).distinct().collect() if r[0] is not None)


def _after_state(rows: DataFrame, state: DataFrame) -> DataFrame:
    """Rows newer than what was seen of their station."""
    seen = state.select("gbfs_station_id", F.col("snapshot_timestamp").alias("_seen"))
    joined = rows.join(seen, "gbfs_station_id", "left")
    fresh = F.col("_seen").isNull() | (F.col("snapshot_timestamp") > F.col("_seen"))
    return joined.where(fresh).select(*rows.columns)


def apply_batch(batch: DataFrame, batch_id: int, root: str) -> None:
    """Changes and next state of one micro-batch, below ``root``.

    The batch's rows are stored while it runs, since two plans read them, and dropped after.
    """
    spark = batch.sparkSession
    work = scratch_path(spark, "micro_batch")
    compared_rows(batch).write.parquet(f"{work}/rows")
    rows = spark.read.schema(compared_rows(batch).schema).parquet(f"{work}/rows")
    numbers = [n for n in _state_numbers(spark, f"{root}/state") if n < batch_id]
    state = None
    if numbers:
        state = spark.read.schema(rows.schema).parquet(f"{root}/state/{_BATCH}={numbers[-1]}")
        _after_state(rows, state).write.parquet(f"{work}/fresh")
        rows = spark.read.schema(rows.schema).parquet(f"{work}/fresh")
    change_log(spark, root).append(status_changes(rows, state), batch_id)
    seen = rows if state is None else state.unionByName(rows)
    seen = keep_latest(seen, ["gbfs_station_id"], ["snapshot_timestamp", "last_reported"])
    seen.write.mode("overwrite").parquet(f"{root}/state/{_BATCH}={batch_id}")
    storage.delete(spark, [work, *[f"{root}/state/{_BATCH}={n}" for n in numbers[:-1]]])


def detect_changes(
    facts: DataFrame, root: str, checkpoint: str, trigger: dict[str, Any] | None = None
) -> StreamingQuery:
    """Start writing the changes of a stream of status facts to ``<root>/changes``."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        apply_batch(batch, batch_id, root)

    return (
        facts.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


@cache
def _change_schema() -> T.StructType:
    empty = SparkSession.active().createDataFrame([], COMPARED_ROWS)
    return status_changes(empty).schema


def change_log(spark: SparkSession, root: str) -> BatchLog:
    """The changes found so far, by date."""
    return BatchLog(spark, f"{root}/changes", _change_schema(), "snapshot_date")


def stored_changes(spark: SparkSession, root: str) -> DataFrame:
    return change_log(spark, root).read().select(*ARCHIVE_COLUMNS)
