"""Partitioned Parquet tables: layout, idempotent loads, merges, retention, reconciliation."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velomart.operators import merge_states
from velomart.operators.quality import union_all
from velomart.params import Params
from velomart.sources import storage
from velomart.workspace import freed_shuffles, materialize


class EmptyReplaceError(ValueError):
    """A replace load would have emptied its table."""


#: Trips next to each other then repeat their stations' ids, names and places.
TRIP_ORDER = ("start_station_id", "end_station_id")


#: Stored files from this size on are not merged with others: opening them costs less than reading.
LARGE_FILE = 4 * 2**20


def clustered(df: DataFrame, partition: str, cluster: Sequence[str] = ()) -> DataFrame:
    """Rows gathered per date and sorted by the cluster columns.

    ``rebalance`` groups rows by date but lets adaptive execution split a date that is far
    larger than the others and merge small ones, so a hot date is not one task or one file.
    """
    return df.hint("rebalance", F.col(partition)).sortWithinPartitions(partition, *cluster)


def write_partitions(
    df: DataFrame,
    path: str,
    partition: str,
    cluster: Sequence[str] = (),
    mode: str = "overwrite",
    in_place: DataFrame | None = None,
) -> None:
    """Write date partitions. Overwriting replaces only the dates present in ``df`` and ``in_place``."""
    rows = df.hint("rebalance", F.col(partition))
    if in_place is not None:
        rows = rows.unionByName(in_place)
    rows = rows.sortWithinPartitions(partition, *cluster)
    writer = rows.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    with freed_shuffles(df.sparkSession):
        writer.partitionBy(partition).parquet(path)


def write_daily_lake(trips: DataFrame, path: str, files: Sequence[str] = ()) -> list[dt.date]:
    """Raw trips as ``dt=YYYY-MM-DD/_source_file=…`` folders; row counts live in the footers.

    ``files`` names the source files that ``trips`` holds whole. A rerun then replaces exactly
    what each of them contributed: folders on dates it no longer has are deleted after the
    write. Returns the dates that held or hold rows of these files.
    """
    before = _paths_of(trips.sparkSession, path, files)
    order = ["_source_file", *TRIP_ORDER]  # as loads sort them: their shuffle packs better for it
    rows = clustered(trips.withColumn("dt", F.col("_ride_started_date")), "dt", order)
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    with freed_shuffles(trips.sparkSession):
        writer.partitionBy("dt", "_source_file").parquet(path)
    after = _paths_of(trips.sparkSession, path, files)
    if before is None or after is None:
        return [] if after is None else _days(after)
    touched = _days(before.unionByName(after))
    _delete_untouched(before, after)
    return touched


def write_per_file(df: DataFrame, path: str, files: Sequence[str]) -> None:
    """Rows in ``_source_file=…`` folders; a listed file without rows loses its old folder."""
    before = _paths_of(df.sparkSession, path, files)
    write_partitions(df, path, "_source_file")
    after = _paths_of(df.sparkSession, path, files)
    if before is not None and after is not None:
        _delete_untouched(before, after)


def _paths_of(spark: SparkSession, path: str, files: Sequence[str]) -> DataFrame | None:
    """Stored data files of the given source files, as they are now."""
    found = storage.listing(spark, path) if files else None
    if found is None:
        return None
    names = spark.createDataFrame([(name,) for name in sorted(set(files))], "source string")
    listed = found.withColumn("source", storage.partition_value("_source_file"))
    listed = listed.join(names, "source").select(
        "path", "folder", storage.partition_value("dt").try_cast("date").alias("day")
    )
    return materialize(listed, "listing")


def _days(listed: DataFrame) -> list[dt.date]:
    return sorted(r.day for r in listed.select("day").where("day is not null").distinct().collect())


def _delete_untouched(before: DataFrame, after: DataFrame) -> None:
    """Delete folders whose files a write left as they were: their source has no rows there."""
    stale = before.join(after, "path", "left_semi").select("folder").distinct()
    storage.delete(before.sparkSession, (r.folder for r in stale.toLocalIterator()))


def load_trips(lake: DataFrame, path: str) -> None:
    """Idempotent load of whole dates: each date of ``lake`` is replaced by what it holds."""
    write_partitions(lake.drop("dt"), path, "_ride_started_date", TRIP_ORDER)


def load_files(
    lake: DataFrame, path: str, files: Sequence[str], days: Sequence[dt.date]
) -> None:
    """Replace the rows of ``files`` on ``days`` by what the lake holds of them.

    Only these dates are read and rewritten; rows of other files stay, also when the lake has
    expired its copies. A date that is left without rows loses its partition. Both tables lie by
    date: their small files are merged per date, and what large ones hold is not shuffled.
    """
    spark, day = lake.sparkSession, "_ride_started_date"
    rows = lake.where(F.col("dt").isin(list(days)) & F.col("_source_file").isin(list(files)))
    names = rows.drop("dt").columns
    sides = [rows]
    current = read_or_none(spark, path)
    if current is not None:
        kept = current.where(F.col(day).isin(list(days)) & ~F.col("_source_file").isin(list(files)))
        sides = [kept, rows]
    apart = [_by_file_size(side, names) for side in sides]
    small = union_all([small for small, _ in apart])
    large = [large for _, large in apart if large is not None]
    rewrite_dates(small, path, day, days, TRIP_ORDER, union_all(large) if large else None)


def _by_file_size(stored: DataFrame, names: Sequence[str]) -> tuple[DataFrame, DataFrame | None]:
    """(rows of small files, rows of large files), the latter None where rows have no file."""
    is_large = F.col("_metadata.file_size") >= LARGE_FILE
    try:
        large = stored.where(is_large).select(*names)
        _ = large.schema  # resolves the file's columns
    except AnalysisException:
        return stored.select(*names), None
    return stored.where(~is_large).select(*names), large


def reconcile(left: DataFrame, right: DataFrame, left_day: str, right_day: str) -> DataFrame:
    """Dates whose row counts differ between two tables, from one aggregation."""
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    sides = left.select(
        F.col(left_day).alias("day"), one.alias("l"), zero.alias("r")
    ).unionByName(right.select(F.col(right_day).alias("day"), zero.alias("l"), one.alias("r")))
    counts = sides.groupBy("day").agg(
        F.sum("l").alias("lake_rows"), F.sum("r").alias("table_rows")
    )
    return counts.where("lake_rows <> table_rows")


def enforce_reconciled(differences: DataFrame) -> None:
    wrong = differences.orderBy("day").collect()  # one row per date at most
    if wrong:
        listed = ", ".join(f"{r.day}: {r.lake_rows} <> {r.table_rows}" for r in wrong)
        raise ValueError(f"row counts differ: {listed}")


def replace_table(df: DataFrame, path: str) -> DataFrame:
    """Full replace of a reference table; refuses to replace it by nothing."""
    staged = materialize(df, "replace")
    if staged.isEmpty():
        raise EmptyReplaceError(f"no rows to put into {path}; the stored table is kept")
    staged.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return staged


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").json(path)


def append_metrics(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("append").partitionBy("run_date").parquet(path)


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        # no folder yet, or one from which every file has expired
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def merge_into(
    incoming: DataFrame, path: str, keys: Sequence[str], latest_by: Sequence[str], partition: str
) -> None:
    """Upsert by key. Only the dates of ``incoming`` are read and rewritten.

    A key must always fall into the same date. A dynamic overwrite puts new files aside until its
    last task is through, so the merged dates may be read from the folders they replace.
    Repeating the call with the same rows changes nothing.
    """
    spark = incoming.sparkSession
    incoming = materialize(incoming, "incoming")
    days = [row[0] for row in incoming.select(partition).distinct().collect()]
    if not days:
        return
    merged = incoming
    current = read_or_none(spark, path)
    if current is not None:
        touched = current.where(F.col(partition).isin(days)).select(*incoming.columns)
        merged = merge_states(touched, incoming, keys, latest_by)
    write_partitions(merged, path, partition, list(keys))


def rewrite_dates(
    rows: DataFrame,
    path: str,
    partition: str,
    days: Sequence[dt.date],
    cluster: Sequence[str] = (),
    in_place: DataFrame | None = None,
) -> None:
    """Replace whole dates by ``rows``, which may be read from them; a date without rows goes.

    ``in_place`` are more such rows, which lie by date already and are not gathered.

    Rows are written once, straight to their place: a dynamic overwrite replaces folders when its
    last task is through. Which dates have rows is asked before, of that column alone.
    """
    every = rows if in_place is None else rows.unionByName(in_place)
    filled = {r[0] for r in every.select(partition).distinct().collect()}
    write_partitions(rows, path, partition, cluster, in_place=in_place)
    storage.delete(
        rows.sparkSession, [f"{path}/{partition}={d.isoformat()}" for d in days if d not in filled]
    )


def write_batches(rows: DataFrame, path: str, day: str) -> None:
    """``<day>/_batch_id=<n>`` folders; a batch that comes again replaces exactly its own."""
    (
        rows.hint("rebalance", F.col(day))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day, "_batch_id")
        .parquet(path)
    )


# --- retention ------------------------------------------------------------------------


def survivors(table: DataFrame, day: str, keep_days: int, p: Params) -> DataFrame:
    """Rows that stay when everything older than ``keep_days`` goes."""
    return table.where(F.col(day) >= F.lit(p.as_of.date() - dt.timedelta(days=keep_days)))


def retention_report(table: DataFrame, name: str, day: str, keep_days: int, p: Params) -> DataFrame:
    """One row: volume before and after, oldest day before and after."""
    kept = F.col(day) >= F.lit(p.as_of.date() - dt.timedelta(days=keep_days))
    return table.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(kept).alias("rows_after"),
        F.min(day).alias("oldest_before"),
        F.min(F.when(kept, F.col(day))).alias("oldest_after"),
    ).select(F.lit(name).alias("table_name"), F.lit(keep_days).cast("long").alias("keep_days"), "*")


def drop_expired_partitions(
    spark: SparkSession, path: str, partition: str, keep_days: int, p: Params
) -> list[dt.date]:
    """Delete the folders of expired dates; no surviving file is read or rewritten."""
    cutoff = p.as_of.date() - dt.timedelta(days=keep_days)
    expired = [d for d in storage.partition_dates(spark, path, partition) if d < cutoff]
    storage.delete(spark, (f"{path}/{partition}={day.isoformat()}" for day in expired))
    return expired


def expired_objects(spark: SparkSession, path: str, keep_days: int, p: Params) -> DataFrame | None:
    """Files below ``path`` that were written more than ``keep_days`` before ``as_of``."""
    files = storage.listing(spark, path)
    if files is None:
        return None
    cutoff = F.lit(p.as_of - dt.timedelta(days=keep_days)).cast("timestamp")
    return files.where(F.col("modified") < cutoff)


def apply_lake_lifecycle(spark: SparkSession, root: str, p: Params) -> dict[str, int]:
    """Delete lake objects by their own age, whatever dates they hold; returns how many."""
    gone = {}
    for prefix, days in p.lake_retention_days.items():
        old = expired_objects(spark, f"{root}/{prefix}", days, p)
        paths = () if old is None else (r.path for r in old.select("path").toLocalIterator())
        gone[prefix] = storage.delete(spark, paths)
    return gone


def newest_write(spark: SparkSession, path: str) -> DataFrame:
    """One row: modification time of the newest file below ``path`` (``newest``), or NULL."""
    files = storage.listing(spark, path)
    if files is None:
        return spark.range(1).select(F.lit(None).cast("timestamp").alias("newest"))
    return files.agg(F.max("modified").alias("newest"))
