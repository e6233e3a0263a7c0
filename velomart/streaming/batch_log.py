"""A table that micro-batches append to, compacted in tiers.

A batch writes one folder, named by its number, on level 0. When a level holds ``fan`` folders, the
oldest ``fan`` are merged into one folder of the next level, named by the range of batches it
covers, so n batches leave at most ``fan`` folders on each of about log(n) levels. A numbered
manifest, written last and whole, says which folders are read; folders that it covers go with the
manifest after it, so a reader that began before still finds them. A batch that runs again after a
failure replaces its own folder, or does nothing if a merged folder covers it already.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velomart.sources import storage


@dataclass(frozen=True, order=True)
class Tier:
    first: int
    last: int
    level: int

    @property
    def folder(self) -> str:
        return f"level-{self.level}/{self.first:012d}-{self.last:012d}"


@dataclass(frozen=True)
class BatchLog:
    spark: SparkSession
    root: str
    schema: T.StructType
    partition: str | None = None
    fan: int = 8
    #: Applied to the rows of merged folders, for instance to keep the last row of a key. Applying
    #: it to parts first must not change what it gives for the whole.
    merge: Callable[[DataFrame], DataFrame] | None = None

    def append(self, rows: DataFrame, batch: int) -> None:
        """Write a batch, unless a merged folder holds it, and merge what is due."""
        if any(t.first <= batch <= t.last for t in self._merged()):
            return
        self._write(rows, Tier(batch, batch, 0))
        self.compact()

    def read(self) -> DataFrame:
        folders = [f"{self.root}/{t.folder}" for t in self.tiers()]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        frames = [self.spark.read.schema(self.schema).parquet(f) for f in folders]
        found = frames[0]
        for frame in frames[1:]:
            found = found.unionByName(frame)
        return found.select(*self.schema.names)

    def tiers(self) -> list[Tier]:
        """The folders that make up the table, oldest batches first."""
        merged = self._merged()
        covered = max((t.last for t in merged), default=-1)
        return sorted([*merged, *[t for t in self._single() if t.first > covered]])

    def compact(self) -> int:
        """Merge until no level is full; returns the number of merges."""
        merges = 0
        while True:
            live = self.tiers()
            due = self._due(live)
            if not due:
                return merges
            whole = Tier(due[0].first, due[-1].last, due[0].level + 1)
            rows = BatchLog.read(_View(self, due))
            self._write(rows if self.merge is None else self.merge(rows), whole)
            kept = [t for t in live if t not in due and t.level > 0]
            self._publish(sorted([*kept, whole]))
            merges += 1

    def _due(self, live: list[Tier]) -> list[Tier]:
        """The oldest ``fan`` folders of the lowest full level; only neighbours are merged."""
        for level in sorted({t.level for t in live}):
            same = [t for t in live if t.level == level]
            if len(same) >= self.fan:
                return same[: self.fan]
        return []

    def _write(self, rows: DataFrame, tier: Tier) -> None:
        rows = rows.select(*self.schema.names)
        if self.partition is not None:
            rows = rows.hint("rebalance", F.col(self.partition))
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
        if self.partition is not None:
            writer = writer.partitionBy(self.partition)
        writer.parquet(f"{self.root}/{tier.folder}")

    def _single(self) -> list[Tier]:
        """Batches on level 0 whose write was finished."""
        names = storage.child_names(self.spark, f"{self.root}/level-0")
        found = [Tier(*map(int, n.split("-")), 0) for n in names if n[0].isdigit()]
        covered = max((t.last for t in self._merged()), default=-1)
        return [
            t for t in found
            if t.first > covered and "_SUCCESS" in storage.child_names(self.spark, f"{self.root}/{t.folder}")
        ]

    def _manifests(self) -> list[str]:
        names = storage.child_names(self.spark, f"{self.root}/manifests")
        return sorted(n for n in names if n[0].isdigit())

    def _listed(self, manifest: str) -> list[Tier]:
        return [Tier(*t) for t in json.loads(storage.read_text(self.spark, f"{self.root}/manifests/{manifest}"))]

    def _merged(self) -> list[Tier]:
        found = self._manifests()
        return self._listed(found[-1]) if found else []

    def _publish(self, tiers: list[Tier]) -> None:
        """Write the next manifest, then drop folders that neither it nor the one before reads."""
        older = self._manifests()
        before = self._listed(older[-1]) if older else []
        number = int(older[-1].removesuffix(".json")) + 1 if older else 1
        content = json.dumps([[t.first, t.last, t.level] for t in tiers])
        path = f"{self.root}/manifests/{number:012d}.json"
        if not storage.write_text(self.spark, path, content):
            raise RuntimeError(f"{path} is there already: two writers of one log")
        covered = max((t.last for t in before), default=-1)
        read = {t.folder for t in [*tiers, *before]}
        stale = []
        for level in storage.child_names(self.spark, self.root):
            if not level.startswith("level-"):
                continue
            for name in storage.child_names(self.spark, f"{self.root}/{level}"):
                folder = f"{level}/{name}"
                if name[0].isdigit() and folder not in read and int(name.split("-")[1]) <= covered:
                    stale.append(f"{self.root}/{folder}")
        storage.delete(self.spark, [*stale, *[f"{self.root}/manifests/{m}" for m in older[:-1]]])


class _View(BatchLog):
    """A log as if it held some of its folders only."""

    def __init__(self, log: BatchLog, tiers: list[Tier]):
        super().__init__(log.spark, log.root, log.schema, log.partition, log.fan, log.merge)
        object.__setattr__(self, "_tiers", tiers)

    def tiers(self) -> list[Tier]:
        return self._tiers
