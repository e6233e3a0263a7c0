"""What a status refresh keeps, so that it reads the dates a delivery touched and no others.

Tables of a ``SnapshotStore``, cut by the date of the table they describe:

* ``batches``: raw and rejected rows of every delivery; ``staged``: staged rows per day. Together the
  running counts of the gate and the metrics.
* ``sizes``: stations per snapshot, from which the latest complete one is chosen.
* ``movement``: changes per station and archive date, summed into volatility.
* partial results of the data tests of the staged status, the fact and the archive.

Dates are noted before the tables they belong to are written and dealt with after, so a run that
dies between is made good by the next one.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velomart.operators import quality as q
from velomart.operators.quality import Check
from velomart.params import Params
from velomart.plans import intermediate, marts, segment_checks
from velomart.plans.checks import declared_checks
from velomart.sources.snapshots import SEGMENT, WHOLE, Change, Snapshot, SnapshotStore

#: table of the store: (its date column, models whose data tests it answers)
TESTED = {
    "staged": ("_reported_date", ("stg_station_status",)),
    "facts": ("snapshot_date", ("fct_station_status",)),
    # every change opens one window, so the windows' test is one on the changes
    "changes": ("snapshot_date", ("status_changes", "status_windows")),
}
RUNNING = "batch long, raw_rows long, rejected_rows long, untold_rows long"


def checks_of(p: Params, table: str) -> list[Check]:
    return [c for c in declared_checks(p) if c.model in TESTED[table][1]]


@dataclass
class Touched:
    """Dates of each table that a run changed; None stands for all of them."""

    staged: set[dt.date] | None = field(default_factory=set)
    facts: set[dt.date] | None = field(default_factory=set)
    changes: set[dt.date] | None = field(default_factory=set)


def _on(rows: DataFrame, day: str, days: Collection[dt.date] | None) -> DataFrame:
    """Rows of some dates, pruned by their folders, with the date as segment."""
    chosen = rows if days is None else rows.where(F.col(day).isin(sorted(days)))
    return chosen.withColumn(SEGMENT, F.col(day))


def batch_counts(batch: int, raw: DataFrame, rejected: DataFrame) -> DataFrame:
    """One row: raw rows of a delivery, rejected ones, and those of them without a reason."""
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    untold = F.col("rejection_reason").isNull().cast("long")
    sides = raw.select(one.alias("raw_rows"), zero.alias("rejected_rows"), zero.alias("untold_rows"))
    sides = sides.unionByName(
        rejected.select(zero.alias("raw_rows"), one.alias("rejected_rows"), untold.alias("untold_rows"))
    )
    names = ("raw_rows", "rejected_rows", "untold_rows")
    return sides.agg(*[F.coalesce(F.sum(n), zero).alias(n) for n in names]).select(
        F.lit(batch).cast("long").alias("batch"), *names
    )


def counts(
    store: SnapshotStore, at: Snapshot, new: DataFrame | None = None,
    staged: DataFrame | None = None, days: Collection[dt.date] = (),
) -> DataFrame:
    """One row: raw, valid and rejected rows, with a new delivery and staged rows of ``days`` if given.

    ``staged`` replaces what the store knows of these days; a batch counts once.
    """
    zero = F.lit(0).cast("long")
    batches = store.read("batches", at).drop(SEGMENT)
    if new is not None:
        known = batches.join(new.select("batch"), "batch", "left_anti").select(*batches.columns)
        batches = known.unionByName(new.select(*batches.columns))
    valid = store.read("staged_rows", at).where(~F.col(SEGMENT).isin(sorted(days))).select("n")
    if staged is not None:
        valid = valid.unionByName(staged.agg(F.count(F.lit(1)).alias("n")))
    names = ("raw_rows", "valid_rows", "rejected_rows")
    rows = batches.select("raw_rows", zero.alias("valid_rows"), "rejected_rows").unionByName(
        valid.select(zero.alias("raw_rows"), F.col("n").alias("valid_rows"), zero.alias("rejected_rows"))
    )
    return rows.agg(*[F.coalesce(F.sum(n), zero).alias(n) for n in names])


def update(
    store: SnapshotStore,
    touched: Touched,
    staged: DataFrame,
    facts: DataFrame,
    changes: DataFrame,
    batches: DataFrame,
    p: Params,
) -> Snapshot:
    """Bring all partial results in line with the tables as they are now, on touched dates."""
    change = Change(store)
    try:
        if "batches" in change.before.tables and touched.staged is not None:
            known = store.read("batches", change.before).drop(SEGMENT)
            known = known.join(batches.select("batch"), "batch", "left_anti")
            batches = known.select(*batches.columns).unionByName(batches)
        change.replace_whole("batches", batches)
        tables = {"staged": staged, "facts": facts, "changes": changes}
        for name, rows in tables.items():
            days = getattr(touched, name)
            mine = _on(rows, TESTED[name][0], days)
            segments = _segments(change, name, days)
            segment_checks.update_checks(change, name, mine, segments, checks_of(p, name))
            if name == "staged":
                change.replace("staged_rows", mine.groupBy(SEGMENT).agg(F.count(F.lit(1)).alias("n")), segments)
            elif name == "facts":
                change.replace("sizes", intermediate.snapshot_sizes(mine, SEGMENT), segments)
            else:
                change.replace("movement", marts.station_movement(mine, SEGMENT), segments)
        found = change.publish()
    except BaseException:
        change.abandon()
        raise
    store.expire()
    return found


def _segments(change: Change, name: str, days: set[dt.date] | None) -> list[dt.date]:
    """The segments to replace: the touched dates, or all that the store holds."""
    if days is not None:
        return sorted(days)
    return [s for s in change.before.segments(f"{name}__digests") if s != WHOLE]


def latest_complete_snapshot(store: SnapshotStore, at: Snapshot, p: Params) -> DataFrame:
    return intermediate.latest_of_sizes(store.read("sizes", at).drop(SEGMENT), p)


def station_volatility(store: SnapshotStore, at: Snapshot, p: Params) -> DataFrame:
    return marts.volatility_of_movement(store.read("movement", at).drop(SEGMENT), p)


def single_creates(store: SnapshotStore, at: Snapshot) -> DataFrame:
    """Stations with more than one create row; every change is a create or an update."""
    return (
        store.read("movement", at)
        .groupBy("gbfs_station_id")
        .agg(F.sum(F.col("changes") - F.col("updates")).alias("creates"))
        .where("creates > 1")
    )


def assertions_report(
    store: SnapshotStore, at: Snapshot, parents: dict[str, DataFrame], p: Params, names: Sequence[str]
) -> DataFrame:
    """The data tests of the status tables among ``names``, from the results kept per date."""
    reports = []
    for table, (_, models) in TESTED.items():
        checks = [c for c in checks_of(p, table) if c.model in names]
        if checks:
            reports.append(segment_checks.report(store, at, table, checks, parents))
    rejected = [c for c in declared_checks(p) if c.model == "stg_station_status_rejected" and c.model in names]
    untold = store.read("batches", at).agg(F.coalesce(F.sum("untold_rows"), F.lit(0)).alias("untold"))
    for check in rejected:  # the stamp is a constant, the reason is counted with the delivery
        bad = F.col("untold") if "rejection_reason" in check.bad else F.lit(0).cast("long")
        reports.append(untold.select(F.lit(check.model).alias("model"), F.lit(check.name).alias("check_name"), bad.alias("violations")))
    if "status_changes" in names:
        counted = single_creates(store, at).agg(F.count(F.lit(1)).alias("violations"))
        reports.append(counted.select(F.lit("status_changes").alias("model"), F.lit("single_create").alias("check_name"), "violations"))
    return q.union_all(reports)
