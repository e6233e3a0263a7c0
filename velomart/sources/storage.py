"""Listing, deleting and writing small stored files.

Files are listed by Spark's ``binaryFile`` source, which reads no content when only paths and
times are asked for. Spark has no public call that deletes or renames files or names folders, so
``delete``, ``write_text`` and ``child_names`` ask the session's Hadoop file system. They are the
only use of private members in this package, and need a classic session, not Spark Connect.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def listing(spark: SparkSession, path: str) -> DataFrame | None:
    """(path, folder, modified) of every file below ``path``; None while there is no such path."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise
    return files.select(
        "path",
        F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder"),
        F.col("modificationTime").alias("modified"),
    )


def partition_value(partition: str) -> Column:
    """The value of a partition column in ``path``, as text; empty where it has none."""
    text = F.regexp_extract("path", f"/{partition}=([^/]*)/", 1)
    return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)


def partition_dates(spark: SparkSession, path: str, partition: str = "dt") -> list[dt.date]:
    """Dates of the stored partitions, ascending. Folders whose name is no date are skipped."""
    files = listing(spark, path)
    if files is None:
        return []
    day = partition_value(partition).try_cast("date")
    rows = files.select(day.alias("day")).where("day is not null").distinct().collect()
    return sorted(r.day for r in rows)


def delete(spark: SparkSession, paths: Iterable[str]) -> int:
    """Delete files or whole folders; returns how many were there."""
    context, gone = spark.sparkContext, 0
    for path in paths:
        target = context._jvm.org.apache.hadoop.fs.Path(path)
        files = target.getFileSystem(context._jsc.hadoopConfiguration())
        gone += bool(files.delete(target, True))
    return gone


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder; none if there is no such folder."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(context._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in files.listStatus(place)] if files.exists(place) else []


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.format("binaryFile").load(path).select(F.col("content").cast("string")).first()[0]


def write_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file so that it is there whole or not at all; False if it is there already.

    The content goes to a neighbour, which is renamed; a rename onto an existing file fails.
    """
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path
    folder, name = path.rsplit("/", 1)
    target, draft = place(path), place(f"{folder}/_{name}.{uuid.uuid4().hex[:8]}")
    files = target.getFileSystem(context._jsc.hadoopConfiguration())
    stream = files.create(draft)
    stream.write(bytearray(text.encode()))
    stream.close()
    if not files.exists(target) and files.rename(draft, target):
        return True
    files.delete(draft, False)
    return False
