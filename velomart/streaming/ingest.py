"""Streaming ingestion: messages in, status table and dead letters out."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from velomart.operators import keep_latest
from velomart.params import Params
from velomart.plans.staging import cleaned_status, stg_station_status
from velomart.sources import storage
from velomart.sources.lake import merge_into, write_batches
from velomart.sources.station_feed import dead_letters, decode_messages, status_rows


def kafka_messages(spark: SparkSession, servers: str, topics: str, per_trigger: int) -> DataFrame:
    """Messages of Kafka topics; needs the Kafka connector on the class path."""
    stream = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topics)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", per_trigger)
        .load()
    )
    return stream.select(
        F.col("value").cast("string").alias("value"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").cast("long").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
    )


def file_messages(spark: SparkSession, path: str, files_per_trigger: int) -> DataFrame:
    """Messages stored one per line; new files are picked up as they arrive."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path)
    return lines.select("value")


def _start(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: dict[str, Any] | None,
) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def write_status_stream(
    messages: DataFrame,
    status_path: str,
    dlq_path: str,
    checkpoint: str,
    now: Column | None = None,
    trigger: dict[str, Any] | None = None,
) -> StreamingQuery:
    """Append decoded messages to the status table and the dead-letter table.

    Files go to ``<date>/_batch_id=<n>``. Offsets are committed after the write; a batch
    that is replayed after a failure overwrites exactly its own folders, so nothing is lost
    and nothing is doubled.
    """
    stamp = F.current_timestamp() if now is None else now

    def handle(batch: DataFrame, batch_id: int) -> None:
        decoded = decode_messages(batch, stamp).persist()
        try:
            for rows, path, name, day in (
                (status_rows(decoded), status_path, "_snapshot_date", F.col("_snapshot_date")),
                (dead_letters(decoded), dlq_path, "_failed_date", F.to_date("failed_at")),
            ):
                dated = rows.withColumns({name: day, "_batch_id": F.lit(batch_id).cast("long")})
                write_batches(dated, path, name)
        finally:
            decoded.unpersist()

    return _start(messages, handle, checkpoint, trigger)


def append_status_stream(
    status: DataFrame,
    path: str,
    checkpoint: str,
    p: Params,
    trigger: dict[str, Any] | None = None,
) -> StreamingQuery:
    """Append the valid rows of each batch to ``<day of last_reported>/_batch_id=<n>`` folders.

    A batch writes its own rows and nothing else, whatever the table holds. Redeliveries are
    resolved by ``compact_status`` on a schedule, or by ``last_per_key`` when read before.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        valid = stg_station_status(cleaned_status(batch), p)
        dated = valid.withColumns(
            {"_reported_date": F.to_date("last_reported"), "_batch_id": F.lit(batch_id).cast("long")}
        )
        write_batches(dated, path, "_reported_date")

    return _start(status, handle, checkpoint, trigger)


def compact_status(
    spark: SparkSession,
    log_path: str,
    path: str,
    p: Params,
    after: int = -1,
    keep_batches: int | None = None,
) -> int:
    """Merge the batches after number ``after`` into the deduplicated table; returns the newest.

    The last delivery of each (station, last_reported) wins. The table is partitioned by the
    day of ``last_reported``, which is part of the key, so a late redelivery meets its earlier
    copy in the same partition, and only days with new rows are rewritten. With ``keep_batches``
    the log forgets merged batches but the newest so many; a batch that is replayed after that is
    merged once more, which changes nothing.
    """
    files = storage.listing(spark, log_path)
    number = storage.partition_value("_batch_id").try_cast("long")
    newest = None if files is None else files.agg(F.max(number)).first()[0]
    if newest is None or newest <= after:
        return after
    new = spark.read.parquet(log_path).where(F.col("_batch_id") > after)
    latest_by = ["_ingested_at", "snapshot_timestamp"]
    new = keep_latest(new.drop("_batch_id"), list(p.status_dedup_key), latest_by)
    merge_into(new, path, list(p.status_dedup_key), latest_by, "_reported_date")
    if keep_batches is not None:
        old = files.where(number <= newest - keep_batches).select("folder").distinct()
        storage.delete(spark, [r.folder for r in old.toLocalIterator()])
    return newest


def last_per_key(rows: DataFrame) -> DataFrame:
    """The deduplicated view of appended batches."""
    return keep_latest(rows, ["station_id", "last_reported"], ["_ingested_at", "snapshot_timestamp"])


def dlq_windows(dlq: DataFrame, p: Params, slide: str = "5 minutes") -> DataFrame:
    """Dead letters per sliding window with the alert verdict.

    On a stream give ``dlq`` a watermark; see ``write_dlq_windows``.
    """
    size = f"{p.dlq_window_minutes} minutes"
    return (
        dlq.groupBy(F.window("failed_at", size, slide).alias("w"))
        .agg(F.count(F.lit(1)).alias("rows_dlq"))
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "rows_dlq",
            F.when(F.col("rows_dlq") > p.dlq_alert_rows, "SURGE").otherwise("OK").alias("status"),
        )
    )


def write_dlq_windows(
    dlq: DataFrame,
    path: str,
    checkpoint: str,
    p: Params,
    lateness: str = "10 minutes",
    slide: str = "5 minutes",
    name: str | None = None,
    trigger: dict[str, Any] | None = None,
) -> StreamingQuery:
    """Append each window of a dead-letter stream once, when the watermark has passed its end.

    State holds open windows, and for ``lateness`` the place of each letter, so that a letter that
    is delivered again counts once. Letters that come more than ``lateness`` after the newest one
    are dropped, one by one, and their number is in the query's progress (``ProgressLog``).
    """
    place = ["kafka_topic", "kafka_partition", "kafka_offset"]
    once = dlq.withWatermark("failed_at", lateness).dropDuplicatesWithinWatermark(place)
    windows = dlq_windows(once, p, slide)
    writer = windows.writeStream.format("parquet").outputMode("append").option("path", path)
    if name is not None:
        writer = writer.queryName(name)
    return (
        writer.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
