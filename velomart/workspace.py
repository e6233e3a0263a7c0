"""Session settings and intermediate tables.

Intermediate results that several consumers read (the station mapping, the station bridge,
the two facts, range-sorted ranking inputs) are written once as Parquet below the shared
folder named by ``spark.checkpoint.dir``. A written table cuts the lineage, survives lost
executors, and gives Catalyst an exact size, so the planner broadcasts a dimension only when
its files are below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it otherwise.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # a fifth smaller than snappy at the same speed, for trips
    "spark.sql.parquet.compression.codec": "zstd",
}


#: With this setting shuffle files go when their query ends, instead of when the JVM collects its plan.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_writers: Counter[SparkSession] = Counter()
_writers_lock = threading.Lock()


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes inside leave no shuffle files behind, so that those of a long run do not add up.

    Only for queries that run once, as every write does: one that runs again would compute its
    shuffles anew. Writers of several threads may be inside; the last one out resets the session.
    """
    with _writers_lock:
        ours = _writers[spark] > 0 or spark.conf.get(FREE_SHUFFLES, "false") != "true"
        if ours:
            _writers[spark] += 1
            spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        with _writers_lock:
            if ours:
                _writers[spark] -= 1
                if not _writers[spark]:
                    del _writers[spark]
                    spark.conf.unset(FREE_SHUFFLES)


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediates: the cluster's, or a scratch one in local mode only."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    scratch = tempfile.mkdtemp(prefix="velomart-")
    spark.conf.set("spark.checkpoint.dir", scratch)
    return scratch


def application_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/velomart/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{application_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str, partition: str | None = None) -> DataFrame:
    """Write ``df`` once and return the stored table, partitioned by a column if one is named."""
    path = scratch_path(df.sparkSession, name)
    rows = df if partition is None else df.hint("rebalance", F.col(partition))
    writer = rows.write.mode("errorifexists")
    if partition is not None:
        writer = writer.partitionBy(partition)
    with freed_shuffles(df.sparkSession):
        writer.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    return stored if partition is None else stored.select(*df.columns)


def sizing(input_bytes: int, partition_bytes: int = 192 * 2**20) -> dict[str, str]:
    """Settings for an input of a known size: shuffle partitions that fit a task's memory.

    Adaptive execution merges partitions that turn out small, so the count errs upwards.
    """
    partitions = max(200, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(256 * 2**20),
    }
