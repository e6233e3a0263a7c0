"""Tables whose changes become visible at once: version folders and one pointer file.

A store holds several tables cut into dated segments. A change writes the new rows of the segments
it replaces to ``<table>/_version=<id>/_segment=<date>`` and touches nothing else. The last step
writes one small file, ``snapshots/<number>.json``, which names for every table the version of
every segment. A reader resolves the newest such file once and keeps its folders, so it sees
the state before a change or after it, over all tables alike. A change that dies half-way has
written folders that no pointer names; ``expire`` removes them, and versions no longer named.

This is a layout, not a table format: Spark lists, writes and reads plain Parquet folders.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Collection, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velomart.operators import merge_states
from velomart.sources import storage
from velomart.workspace import freed_shuffles, materialize

SEGMENT, VERSION = "_segment", "_version"
#: The segment of a table that is always replaced whole.
WHOLE = dt.date(1970, 1, 1)


class ConflictError(RuntimeError):
    """Another change was published since the one at hand began."""


@dataclass(frozen=True)
class Snapshot:
    number: int = 0
    # table: segment: version
    tables: dict[str, dict[str, str]] = field(default_factory=dict)
    schemas: dict[str, str] = field(default_factory=dict)

    def segments(self, table: str) -> list[dt.date]:
        return sorted(dt.date.fromisoformat(s) for s in self.tables.get(table, {}))


@dataclass(frozen=True)
class SnapshotStore:
    spark: SparkSession
    root: str

    def snapshot(self, number: int | None = None) -> Snapshot:
        """The newest published state, or an earlier one that has not expired."""
        if number is None:
            numbers = self._numbers()
            if not numbers:
                return Snapshot()
            number = numbers[-1]
        found = json.loads(storage.read_text(self.spark, self._pointer(number)))
        return Snapshot(number, found["tables"], found["schemas"])

    def _numbers(self) -> list[int]:
        names = storage.child_names(self.spark, f"{self.root}/snapshots")
        return sorted(int(n.removesuffix(".json")) for n in names if n[0].isdigit())

    def _pointer(self, number: int) -> str:
        return f"{self.root}/snapshots/{number:012d}.json"

    def read(
        self, table: str, at: Snapshot | None = None, segments: Collection[dt.date] | None = None
    ) -> DataFrame:
        """A table as of a snapshot, with its segment; only the folders of ``segments`` are opened."""
        at = at or self.snapshot()
        schema = T.StructType.fromJson(json.loads(at.schemas[table])).add(SEGMENT, T.DateType())
        wanted = None if segments is None else {s.isoformat() for s in segments}
        folders = [
            f"{self.root}/{table}/{VERSION}={version}/{SEGMENT}={segment}"
            for segment, version in sorted(at.tables.get(table, {}).items())
            if wanted is None or segment in wanted
        ]
        if not folders:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/{table}")
        return reader.parquet(*folders).select(*schema.names)

    def expire(self, keep: int = 2) -> int:
        """Delete pointers but the newest ``keep`` and the segments that none of those names."""
        numbers = self._numbers()
        live = {
            (table, version, segment)
            for n in numbers[-keep:]
            for table, segments in self.snapshot(n).tables.items()
            for segment, version in segments.items()
        }
        files = storage.listing(self.spark, self.root)
        stale: list[str] = [self._pointer(n) for n in numbers[:-keep]]
        if files is not None:
            place = F.regexp_extract("path", f"/([^/]+)/{VERSION}=[^/]+/", 1).alias("table")
            named = [storage.partition_value(name).alias(name) for name in (VERSION, SEGMENT)]
            for r in files.select(place, *named).where(f"{VERSION} <> ''").distinct().toLocalIterator():
                if tuple(r) not in live:
                    stale.append(f"{self.root}/{r.table}/{VERSION}={r[1]}/{SEGMENT}={r[2]}")
        return storage.delete(self.spark, stale)


def gathered(rows: DataFrame, *within: str) -> DataFrame:
    """Rows brought together by segment; adaptive execution splits large ones and merges small ones."""
    return rows.hint("rebalance", F.col(SEGMENT), *map(F.col, within))


class Change:
    """New versions of segments, readable by their writer, visible to others once published."""

    def __init__(self, store: SnapshotStore):
        self.store = store
        self.before = store.snapshot()
        self.version = uuid.uuid4().hex[:12]
        self._tables = {t: dict(s) for t, s in self.before.tables.items()}
        self._schemas = dict(self.before.schemas)

    @property
    def now(self) -> Snapshot:
        return Snapshot(self.before.number + 1, self._tables, self._schemas)

    def replace(
        self,
        table: str,
        rows: DataFrame,
        segments: Iterable[dt.date],
        cluster: Sequence[str] = (),
        within: Sequence[str] = (),
        options: dict[str, str] | None = None,
        derive: Callable[[DataFrame], DataFrame] | None = None,
        in_place: bool = False,
    ) -> None:
        """The ``segments`` of a table become ``rows``; a segment without rows is gone.

        ``rows`` carries its segment and may read the table as it was. A table is replaced once
        per change. ``derive`` works out columns row by row after rows are gathered by segment,
        so that they need not be shuffled. ``in_place`` rows lie by segment already, as they are read
        from files of one segment each or were just shuffled by it, and are not gathered again.
        """
        path = f"{self.store.root}/{table}/{VERSION}={self.version}"
        self._tables.setdefault(table, {})
        placed = rows if in_place else gathered(rows, *within)
        placed = placed if derive is None else derive(placed)
        writer = placed.sortWithinPartitions(SEGMENT, *within, *cluster).write.mode("errorifexists")
        with freed_shuffles(self.store.spark):
            writer.options(**(options or {})).partitionBy(SEGMENT, *within).parquet(path)
        kept = {s: v for s, v in self._tables.get(table, {}).items()}
        for segment in segments:
            kept.pop(segment.isoformat(), None)
        for name in storage.child_names(self.store.spark, path):
            if name.startswith(f"{SEGMENT}="):
                kept[name.removeprefix(f"{SEGMENT}=")] = self.version
        self._tables[table] = kept
        stored = T.StructType([f for f in placed.schema.fields if f.name != SEGMENT])
        self._schemas[table] = json.dumps(stored.jsonValue())

    def replace_together(self, rows_of: Mapping[str, DataFrame], segments: Collection[dt.date]) -> None:
        """Replace the same ``segments`` of several tables by jobs that run side by side."""
        with ThreadPoolExecutor(len(rows_of)) as pool:
            jobs = [
                pool.submit(inheritable_thread_target(self.store.spark)(self.replace), table, rows, segments)
                for table, rows in rows_of.items()
            ]
            for job in jobs:
                job.result()

    def replace_whole(self, table: str, rows: DataFrame) -> None:
        self.replace(table, rows.withColumn(SEGMENT, F.lit(WHOLE)), [WHOLE])

    def read(self, table: str, segments: Collection[dt.date] | None = None) -> DataFrame:
        return self.store.read(table, self.now, segments)

    def abandon(self) -> None:
        """Delete what was written and not published."""
        root = self.store.root
        storage.delete(self.store.spark, [f"{root}/{t}/{VERSION}={self.version}" for t in self._tables])

    def publish(self) -> Snapshot:
        """Write the pointer, the one step that others can see."""
        now = self.now
        content = json.dumps({"tables": now.tables, "schemas": now.schemas})
        if not storage.write_text(self.store.spark, self.store._pointer(now.number), content):
            raise ConflictError(f"snapshot {now.number} of {self.store.root} was published meanwhile")
        return now


def merge_rows(
    store: SnapshotStore, table: str, incoming: DataFrame, keys: Sequence[str], latest_by: Sequence[str]
) -> Snapshot:
    """Upsert ``incoming`` by key and publish; only its segments are read and written.

    A key must always fall into the same segment, which ``incoming`` carries. Repeating the call
    with the same rows changes no row.
    """
    change = Change(store)
    try:
        incoming = materialize(incoming, "incoming")
        days = [r[0] for r in incoming.select(SEGMENT).distinct().collect()]
        rows = incoming
        if table in change.before.tables:
            rows = merge_states(
                store.read(table, change.before, days).select(*incoming.columns), incoming, keys, latest_by
            )
        change.replace(table, rows, days, list(keys))
        return change.publish()
    except BaseException:
        change.abandon()
        raise
