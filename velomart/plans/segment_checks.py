"""Data tests of tables in segments, from partial results that merge.

* A row condition keeps its violations per segment; they add up.
* A uniqueness test keeps a multiset of 128-bit key hashes per segment, cut by hash prefix into
  buckets, and a digest of each (segment, bucket): the number of keys and the exclusive or of their
  hashes. A refresh computes the digests of the segments it changed. Only buckets whose digest is
  another one now are counted again, over all segments; the verdict on every other bucket stands.
* A relationship keeps the distinct child keys per segment with their rows. They are few next to the
  table and are compared with the parent whenever a report is made, since parents change too.

So neither a refresh nor a report reads a row of an unchanged segment.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velomart.operators.quality import Check, union_all
from velomart.sources.snapshots import SEGMENT, Change, Snapshot, SnapshotStore

BUCKETS, BUCKET = 16, "_bucket"


def _names(table: str) -> tuple[str, str, str, str, str]:
    return tuple(f"{table}__{part}" for part in ("rows", "children", "keys", "digests", "verdicts"))


def _key_of(check: Check) -> str:
    """Tests of the same columns share their keys, unless they differ on NULLs."""
    return ",".join(check.unique) + ("" if check.skip_null else " with NULLs")


def _row_violations(rows: DataFrame, checks: Sequence[Check]) -> DataFrame:
    counted = rows.groupBy(SEGMENT).agg(
        F.lit(0).alias("v"), *[F.count_if(F.expr(c.bad)).alias(f"v{i}") for i, c in enumerate(checks)]
    )
    each = [
        F.struct(F.lit(f"{c.model}.{c.name}").alias("check"), F.col(f"v{i}").alias("violations"))
        for i, c in enumerate(checks)
    ]
    none = F.array().cast("array<struct<check:string,violations:bigint>>")
    return counted.select(SEGMENT, F.inline(F.array(*each) if each else none))


def _children(rows: DataFrame, checks: Sequence[Check]) -> DataFrame:
    each = [
        F.struct(F.lit(f"{c.model}.{c.name}").alias("check"), F.col(c.parent[0]).cast("string").alias("key"))
        for c in checks
    ]
    none = F.array().cast("array<struct<check:string,key:string>>")
    keys = rows.select(SEGMENT, F.inline(F.array(*each) if each else none)).where("key IS NOT NULL")
    return keys.groupBy(SEGMENT, "check", "key").agg(F.count(F.lit(1)).alias("seen"))


def _keys(rows: DataFrame, checks: Sequence[Check]) -> DataFrame:
    def entry(check: Check) -> Column:
        columns = [F.col(c) for c in check.unique]
        parts = [x for c in columns for x in (c, c.isNull())]
        found = F.struct(
            F.lit(_key_of(check)).alias("key_of"),
            F.xxhash64(*parts).alias("h1"),
            F.xxhash64(F.lit(-1), *parts).alias("h2"),
        )
        if not check.skip_null:
            return found
        return F.when(reduce(lambda a, b: a & b, [c.isNotNull() for c in columns]), found)

    distinct = {_key_of(c): entry(c) for c in checks}
    none = F.array().cast("array<struct<key_of:string,h1:bigint,h2:bigint>>")
    each = F.array_compact(F.array(*distinct.values())) if distinct else none
    keys = rows.select(SEGMENT, F.inline(each)).withColumn(BUCKET, F.pmod("h1", F.lit(BUCKETS)).cast("int"))
    # shuffled once: equal keys meet where their bucket is written
    placed = keys.repartition(SEGMENT, BUCKET).groupBy(SEGMENT, BUCKET, "key_of", "h1", "h2")
    return placed.agg(F.count(F.lit(1)).alias("seen")).select(SEGMENT, "key_of", "h1", "h2", "seen", BUCKET)


def changed_buckets(change: Change, table: str, segments: Sequence[dt.date]) -> list[int]:
    """Buckets in which the keys of a changed segment are others than before."""
    digests = _names(table)[3]
    sides = change.read(digests, segments).withColumn("side", F.lit(1))
    if digests in change.before.tables:
        was = change.store.read(digests, change.before, segments).withColumn("side", F.lit(-1))
        sides = sides.unionByName(was)
    same = sides.groupBy(SEGMENT, BUCKET, "key_of", "n", "digest").agg(F.sum("side").alias("side"))
    return sorted(r[0] for r in same.where("side <> 0").select(BUCKET).distinct().collect())


def update_checks(
    change: Change, table: str, rows: DataFrame, segments: Sequence[dt.date], checks: Sequence[Check]
) -> list[int]:
    """Bring the partial results of a table in line with its changed ``segments``.

    ``rows`` are the rows of these segments as they are now. Returns the buckets counted again.
    """
    by_rows, children, keys, digests, verdicts = _names(table)
    parts = {
        by_rows: _row_violations(rows, [c for c in checks if c.bad is not None]),
        children: _children(rows, [c for c in checks if c.parent]),
    }
    change.replace_together(parts, segments)
    unique = [c for c in checks if c.unique]
    change.replace(keys, _keys(rows, unique), segments, within=[BUCKET], in_place=True)
    per_bucket = change.read(keys, segments).groupBy(SEGMENT, BUCKET, "key_of").agg(
        F.sum("seen").alias("n"), F.bit_xor(F.xxhash64("h1", "h2", "seen")).alias("digest")
    )
    change.replace(digests, per_bucket, segments)
    again = changed_buckets(change, table, segments)
    repeated = (
        change.read(keys)
        .where(F.col(BUCKET).isin(again))
        .groupBy(BUCKET, "key_of", "h1", "h2")
        .agg(F.sum("seen").alias("seen"))
        .where("seen > 1")
        .groupBy(BUCKET, "key_of")
        .agg(F.count(F.lit(1)).alias("violations"))
    )
    if verdicts in change.before.tables:
        standing = change.store.read(verdicts, change.before).drop(SEGMENT)
        standing = standing.where(~F.col(BUCKET).isin(again))
        repeated = standing.unionByName(repeated.select(*standing.columns))
    change.replace_whole(verdicts, repeated)
    return again


def report(
    store: SnapshotStore, at: Snapshot, table: str, checks: Sequence[Check], parents: Mapping[str, DataFrame]
) -> DataFrame:
    """(model, check_name, violations) of every check, from the partial results of a snapshot."""
    by_rows, children, _, _, verdicts = _names(table)
    name, zero = F.col("check"), F.lit(0).cast("long")
    listed = store.spark.createDataFrame(
        [(c.model, c.name, f"{c.model}.{c.name}", _key_of(c) if c.unique else None) for c in checks],
        "model string, check_name string, check string, key_of string",
    )
    keyed = store.read(verdicts, at).groupBy("key_of").agg(F.sum("violations").alias("violations"))
    found = [
        store.read(by_rows, at).select("check", "violations"),
        listed.join(keyed, "key_of").select("check", "violations"),
    ]
    for check in checks:
        if check.parent:
            _, parent, column = check.parent
            known = parents[parent].select(F.col(column).cast("string").alias("key")).distinct()
            mine = store.read(children, at).where(name == f"{check.model}.{check.name}")
            found.append(mine.join(known, "key", "left_anti").select("check", F.col("seen").alias("violations")))
    total = union_all(found).groupBy("check").agg(F.sum("violations").alias("violations"))
    return listed.join(total, "check", "left").select(
        "model", "check_name", F.coalesce("violations", zero).alias("violations")
    )
