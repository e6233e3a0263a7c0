"""Trip models kept up to date by the dates that a load touched.

Every table is cut into segments, the dates by which raw trips are stored. A refresh gets the
segments that a load changed, derives those anew and publishes them together:

* ``mentions``: station mentions per segment. Their sum is the input of the id mapping. Where a
  station's canonical id changes, the segments that mention it are derived again as well.
* ``clean``: every raw trip, cleaned and tagged with its reasons, from the one pass over the raw
  rows that the rules need. Counts are observed while it is written.
* ``rides``: the key index, (ride, segment) of every row valid by any rule, in hash buckets with
  a Parquet Bloom filter on the ride in each file. A ride that is also stored elsewhere is found
  here, and only the segments it names are opened to decide again which copy stays.
* ``facts``: the trip fact.
* ``daily``, ``hourly``, ``durations``, ``flows``, ``sightings``, ``file_counts``, ``dq_counts`` and
  ``dq_kept``: partial aggregates per segment. A segment is retracted by replacing it, and marts
  are sums over partials, so they never read the trips.

The gate is decided on the unpublished versions, before the pointer is written.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Collection, Iterable, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from velomart.operators import Marks, keep_latest, marked_apart, marks_of_repeated, signed_endpoints
from velomart.operators import quality as q
from velomart.operators.quality import Check
from velomart.operators.rules import is_valid, status_rules
from velomart.params import Params
from velomart.plans import core, intermediate, marts, segment_checks, staging
from velomart.plans.checks import declared_checks
from velomart.plans.models import Models, scratch
from velomart.plans.segment_checks import update_checks
from velomart.plans.staging import TRIP_COLUMNS
from velomart.sources.snapshots import SEGMENT, Change, Snapshot, SnapshotStore, gathered
from velomart.workspace import materialize

RAW_DAY, BUCKET = "_ride_started_date", "_bucket"
#: So many rides are looked for by their values, which Bloom filters answer; more by a join.
FEW_RIDES = 200
LATEST = ["_ingested_at", "ended_at"]
#: Up to so many merged stations Catalyst broadcasts them, so that trips stay where they are read.
FEW_MERGED = 200_000
#: The key of few values first: then a row group has few values of either key, and a filter on one
#: of them alone skips the others by their statistics.
FACT_ORDER = ["member_casual", "start_station_id"]
#: Models that are the fact's rows, whose data tests are kept with the segments of the fact.
FACT_MODELS = ("stg_trips", "fct_trips")


@dataclass(frozen=True)
class TripRefresh:
    snapshot: Snapshot
    #: Segments derived from raw rows: those that were touched, and those of stations mapped anew.
    derived: list[dt.date]
    #: Other segments of which facts changed, since a ride has another copy now.
    settled: list[dt.date]
    #: Other segments that were opened to look at copies of rides.
    opened: list[dt.date]
    raw_rows: int
    rejected_rows: int


def on_segments(raw: DataFrame, segments: Collection[dt.date]) -> DataFrame:
    """The raw rows of some segments, with the segment; others are pruned by their folders."""
    return raw.where(F.col(RAW_DAY).isin(sorted(segments))).withColumn(SEGMENT, F.col(RAW_DAY))


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("ride_id"), F.lit(buckets)).cast("int")


def _remapped(change: Change, mapping: DataFrame, touched: set[dt.date]) -> set[dt.date]:
    """Untouched segments that mention a station whose canonical id is another one now."""
    if "mapping" not in change.before.tables:
        return set()
    old = change.store.read("mapping", change.before).select(
        F.col("station_id").alias("_id"), F.col("canonical_station_id").alias("_was")
    )
    now = mapping.select("station_id", "canonical_station_id")
    both = now.join(old, F.col("station_id") == F.col("_id"), "full")
    # a station without an entry stands for itself
    station = F.coalesce("station_id", "_id")
    differs = F.coalesce("canonical_station_id", station) != F.coalesce("_was", station)
    moved = both.where(differs).select(station.alias("station_id"))
    mentions = change.read("mentions").select("station_id", SEGMENT)
    found = mentions.join(moved, "station_id", "left_semi").select(SEGMENT).distinct()
    return {r[0] for r in found.collect()} - touched


def copies_elsewhere(change: Change, derived: list[dt.date], buckets: int) -> DataFrame:
    """(ride, segment) of rides of ``derived``, as they were or are, in any other segment.

    Only buckets that such a ride falls into are opened. A few rides are looked for by value, so
    that a file whose Bloom filter has none of them is skipped.
    """
    store, before = change.store, change.before
    others = [s for s in before.segments("rides") if s not in set(derived)]
    rides = change.read("rides", derived).select("ride_id", BUCKET)
    if "rides" in before.tables:
        gone = store.read("rides", before, derived).select("ride_id", BUCKET)
        rides = rides.unionByName(gone)
    if not others:
        return store.spark.createDataFrame([], "ride_id string, _segment date")
    rides = materialize(rides.distinct(), "derived_rides")
    hit = [r[0] for r in rides.select(BUCKET).distinct().collect()]
    index = store.read("rides", before, others).where(F.col(BUCKET).isin(hit))
    some = [r[0] for r in rides.select("ride_id").limit(FEW_RIDES + 1).collect()]
    if len(some) <= FEW_RIDES:
        # short lists, since a long one is pushed to the files as a range only
        lists = [F.col("ride_id").isin(some[k : k + 10]) for k in range(0, len(some), 10)]
        wanted = F.lit(False)
        for one in lists:
            wanted = wanted | one
        found = index.where(wanted)
    else:
        found = index.join(rides.select("ride_id"), "ride_id", "left_semi")
    return materialize(found.select("ride_id", SEGMENT), "copies_elsewhere")


def _valid(clean: DataFrame) -> DataFrame:
    return clean.where(F.col("reason").isNull())


def _summary_rows(clean: DataFrame) -> DataFrame:
    """The rows that the quality summary counts as valid, in its columns."""
    rows = clean.where(F.col("raw_reason").isNull())
    return rows.select("ride_id", *LATEST, "_source_file", SEGMENT)


def _kept_per_file(rows: DataFrame) -> DataFrame:
    return rows.groupBy(SEGMENT, "_source_file").agg(F.count(F.lit(1)).alias("kept"))


def _quarantined(clean: DataFrame, p: Params, *keep: str) -> DataFrame:
    rejected = clean.where(F.col("reason").isNotNull()).withColumnRenamed("reason", "rejection_reason")
    return staging.quarantined(rejected, p, *keep)


def trip_checks(p: Params, *models: str) -> list[Check]:
    return [c for c in declared_checks(p) if c.model in models]


def _latest_apart(rows: DataFrame, marks: Marks) -> tuple[DataFrame, DataFrame]:
    """(rows of rides that come once, where they lie; the latest copy of other rides)."""
    once, more = marked_apart(rows, ["ride_id"], marks)
    return once, keep_latest(more, ["ride_id"], LATEST)


def _settle(
    change: Change,
    clean: DataFrame,
    marks: Marks,
    copies: DataFrame,
    derived: list[dt.date],
    opened: list[dt.date],
    p: Params,
) -> list[dt.date]:
    """Replace the facts of ``derived``, and of the opened segments that gain or lose a ride."""
    store, before = change.store, change.before
    valid = _valid(clean).select(*TRIP_COLUMNS, SEGMENT)

    def facts_of(rows: DataFrame) -> DataFrame:
        return core.fct_trips(rows, p, SEGMENT)

    if not opened:
        once, latest = _latest_apart(valid, marks)
        rows = once.unionByName(gathered(latest))
        change.replace("facts", rows, derived, FACT_ORDER, derive=facts_of, in_place=True)
        return []
    shared = materialize(copies.select("ride_id").distinct(), "shared_rides")
    away = _valid(store.read("clean", before, opened)).select(*TRIP_COLUMNS, SEGMENT)
    among = valid.unionByName(away).join(shared, "ride_id", "left_semi").select(*valid.columns)
    chosen = materialize(keep_latest(among, ["ride_id"], LATEST), "chosen_copies")
    own = valid.join(shared, "ride_id", "left_anti").select(*valid.columns)
    elsewhere = F.col(SEGMENT).isin(opened)
    was = store.read("facts", before, opened).join(shared, "ride_id", "left_semi")
    places = was.select("ride_id", SEGMENT, F.lit(1).alias("side")).unionByName(
        chosen.where(elsewhere).select("ride_id", SEGMENT, F.lit(-1).alias("side"))
    )
    differs = places.groupBy("ride_id", SEGMENT).agg(F.sum("side").alias("side")).where("side <> 0")
    settled = sorted(r[0] for r in differs.select(SEGMENT).distinct().collect())
    once, latest = _latest_apart(own, marks)
    rows = once.unionByName(latest).unionByName(
        chosen.where(~elsewhere | F.col(SEGMENT).isin(settled))
    )
    if settled:
        kept = store.read("facts", before, settled).join(shared, "ride_id", "left_anti")
        rows = rows.unionByName(kept.select(*rows.columns))
    change.replace("facts", rows, [*derived, *settled], FACT_ORDER, derive=facts_of)
    return settled


def _count_files(
    change: Change,
    clean: DataFrame,
    marks: Marks,
    copies: DataFrame,
    derived: list[dt.date],
    opened: list[dt.date],
) -> None:
    """Counts per segment and file for the gate and the quality summary."""
    rejected = clean.where(F.col("reason").isNotNull()).groupBy(SEGMENT, "_source_file")
    reasons = clean.groupBy(SEGMENT, "_source_file", "raw_reason")
    counted = {
        "rejected_files": rejected.agg(F.count(F.lit(1)).alias("rejected_rows")),
        "dq_counts": reasons.agg(F.count(F.lit(1)).alias("row_count")),
    }
    change.replace_together(counted, derived)
    rows = _summary_rows(clean)
    if not opened:
        once, latest = _latest_apart(rows, marks)
        change.replace("dq_kept", _kept_per_file(once.unionByName(latest)), derived)
        return
    # all copies of a shared ride are in derived and opened segments, those of others in derived ones
    store, before = change.store, change.before
    shared = materialize(copies.select("ride_id").distinct(), "shared_rides")
    away = _summary_rows(store.read("clean", before, opened))
    earlier = _summary_rows(store.read("clean", before, [*derived, *opened]))

    def settled(copies_of: DataFrame) -> DataFrame:
        among = copies_of.join(shared, "ride_id", "left_semi").select(*rows.columns)
        return keep_latest(among, ["ride_id"], LATEST)

    now = materialize(settled(rows.unionByName(away)), "kept_copies")
    elsewhere = F.col(SEGMENT).isin(opened)
    once, latest = _latest_apart(rows.join(shared, "ride_id", "left_anti").select(*rows.columns), marks)
    here = _kept_per_file(once.unionByName(latest).unionByName(now.where(~elsewhere)))
    gone = _kept_per_file(settled(earlier).where(elsewhere)).withColumn("kept", -F.col("kept"))
    there = (
        store.read("dq_kept", before, opened)
        .unionByName(gone)
        .unionByName(_kept_per_file(now.where(elsewhere)))
        .groupBy(SEGMENT, "_source_file")
        .agg(F.sum("kept").alias("kept"))
        .where("kept <> 0")
    )
    change.replace("dq_kept", here.unionByName(there.select(*here.columns)), [*derived, *opened])


def _aggregate(change: Change, segments: list[dt.date]) -> None:
    """Partial aggregates of the facts of some segments."""
    facts = change.read("facts", segments)
    files = facts.groupBy(SEGMENT, "_source_file").agg(F.count(F.lit(1)).alias("valid_rows"))
    partials = {
        "fact_files": files,
        "daily": marts.daily_totals(facts, SEGMENT),
        "hourly": marts.hourly_cells(facts, SEGMENT),
        "durations": marts.duration_histogram(facts, SEGMENT, "trip_date"),
        "flows": signed_endpoints(facts, "start_station_id", "end_station_id", SEGMENT),
        "sightings": intermediate.station_sightings(facts, SEGMENT),
    }
    change.replace_together(partials, segments)


def _files_of(change: Change, segments: list[dt.date]) -> DataFrame:
    """Valid and rejected rows per file, over all segments, of the files in some."""
    zero = F.lit(0).cast("long")
    both = change.read("fact_files").select("_source_file", "valid_rows", zero.alias("rejected_rows"))
    both = both.unionByName(
        change.read("rejected_files").select("_source_file", zero.alias("valid_rows"), "rejected_rows")
    )
    files = change.read("dq_counts", segments).select(F.col("_source_file").alias("_file")).distinct()
    return both.join(files, F.col("_source_file").eqNullSafe(F.col("_file")), "left_semi")


def _reconcile(change: Change, derived: list[dt.date], raw_rows: int) -> None:
    """Rows seen on the way into ``clean`` against the rows stored there."""
    stored = change.read("clean", derived).count()
    if stored != raw_rows:
        raise ValueError(f"{raw_rows} raw trips were read and {stored} stored")


def refresh_trips(
    store: SnapshotStore,
    raw: DataFrame,
    touched: Iterable[dt.date],
    p: Params,
    buckets: int = 8,
) -> TripRefresh:
    """Bring all tables of ``store`` in line with ``raw``, of which ``touched`` segments changed.

    ``raw`` is partitioned by ``_ride_started_date``; it is read twice, on derived segments only. An
    error, that of the gate included, publishes nothing. A repeated call changes no result.
    """
    change = Change(store)
    try:
        return _refreshed(change, raw, set(touched), p, buckets)
    except BaseException:
        change.abandon()
        raise


def _refreshed(change: Change, raw: DataFrame, touched: set[dt.date], p: Params, buckets: int) -> TripRefresh:
    change.replace("mentions", staging.station_mentions(on_segments(raw, touched), SEGMENT), touched)
    counted = change.read("mentions").groupBy("station_id", "station_name", "lat", "lng")
    mapping = staging.mapping_of(counted.agg(F.sum("mentions").alias("mentions")))
    change.replace_whole("mapping", mapping)
    mapping = change.read("mapping").drop(SEGMENT)
    derived = sorted(touched | _remapped(change, mapping, touched))

    counts = Observation("clean trips")
    clean = staging.tagged_trips(on_segments(raw, derived), mapping, p, SEGMENT).observe(
        counts,
        F.count(F.lit(1)).alias("raw_rows"),
        F.count("reason").alias("rejected_rows"),
    )
    few = mapping.where("is_merged_duplicate").limit(FEW_MERGED + 1).count() <= FEW_MERGED
    change.replace("clean", clean, derived, ["start_station_id", "end_station_id"], in_place=few)
    clean = change.read("clean", derived)

    keyed = clean.where(F.col("reason").isNull() | F.col("raw_reason").isNull())
    marks = marks_of_repeated(keyed, ["ride_id"])
    keyed = keyed.where(F.col("ride_id").isNotNull())
    keyed = keyed.select("ride_id", SEGMENT, _bucket(buckets).alias(BUCKET))
    keyed = keyed.repartition(SEGMENT, BUCKET).distinct()  # shuffled once, to where it is written
    bloom = {"parquet.bloom.filter.enabled#ride_id": "true"}
    change.replace("rides", keyed, derived, ["ride_id"], [BUCKET], bloom, in_place=True)

    copies = copies_elsewhere(change, derived, buckets)
    opened = sorted(r[0] for r in copies.select(SEGMENT).distinct().collect())
    settled = _settle(change, clean, marks, copies, derived, opened, p)
    _count_files(change, clean, marks, copies, derived, opened)
    changed = sorted({*derived, *settled})
    _aggregate(change, changed)
    update_checks(change, "facts", change.read("facts", changed), changed, trip_checks(p, *FACT_MODELS))
    rejected = _quarantined(clean, p, SEGMENT)
    update_checks(change, "rejected", rejected, derived, trip_checks(p, "stg_trips_rejected"))

    q.enforce(q.gate_of_counts(_files_of(change, derived), p))
    seen = counts.get
    _reconcile(change, derived, seen["raw_rows"])
    return TripRefresh(
        change.publish(), derived, settled, opened, seen["raw_rows"], seen["rejected_rows"]
    )


class StoredTrips(Models):
    """The model graph whose trip models come from a published snapshot of a ``SnapshotStore``."""

    def __init__(
        self,
        trips: SnapshotStore,
        at: Snapshot,
        raw: DataFrame,
        status: DataFrame,
        information: DataFrame,
        p: Params,
        store: Callable[[DataFrame, str], DataFrame] = scratch,
    ) -> None:
        super().__init__(raw, status, information, p, store_trips=True, store=store)
        self._trips_at = trips, at

    def _table(self, name: str) -> DataFrame:
        store, at = self._trips_at
        return store.read(name, at).drop(SEGMENT)

    def _summed(self, name: str, *keys: str) -> DataFrame:
        rows = self._table(name)
        return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in rows.columns if c not in keys])

    @cached_property
    def station_id_mapping(self) -> DataFrame:
        return self._table("mapping")

    @cached_property
    def cleaned_trips(self) -> DataFrame:
        return self._table("clean").select(*TRIP_COLUMNS)

    @cached_property
    def fct_trips(self) -> DataFrame:
        return self._table("facts")

    @cached_property
    def stg_trips(self) -> DataFrame:
        return self.fct_trips.select(*TRIP_COLUMNS)

    @cached_property
    def stg_trips_rejected(self) -> DataFrame:
        return _quarantined(self._table("clean"), self.params)

    @cached_property
    def stations_deduplicated(self) -> DataFrame:
        return intermediate.stations_of(self._table("sightings"))

    @cached_property
    def calendar(self) -> DataFrame:
        status = self.cleaned_status.where(is_valid(status_rules(self.params)))
        return core.dim_date(self._table("daily"), status, self.params)

    @cached_property
    def dim_date(self) -> DataFrame:
        return self.calendar

    @cached_property
    def trips_dq_summary(self) -> DataFrame:
        counts = self._summed("dq_counts", "_source_file", "raw_reason")
        counts = counts.withColumnRenamed("raw_reason", "rejection_reason")
        kept = self._summed("dq_kept", "_source_file")
        return materialize(intermediate.dq_summary_of(counts, kept, self.params), "trips_dq_summary")

    @cached_property
    def station_demand(self) -> DataFrame:
        return self._summed("flows", "station_id")

    @cached_property
    def trip_counts(self) -> DataFrame:
        """One row: raw, valid and rejected trips, from the counts per file."""
        zero = F.lit(0).cast("long")
        counted = (("dq_counts", "row_count", "raw_rows"), ("fact_files", "valid_rows", "valid_rows"),
                   ("rejected_files", "rejected_rows", "rejected_rows"))
        names = [name for *_, name in counted]
        rows = [
            self._table(table).select(*[F.col(column).alias(n) if n == name else zero.alias(n) for n in names])
            for table, column, name in counted
        ]
        return q.union_all(rows).agg(*[F.coalesce(F.sum(n), zero).alias(n) for n in names])

    @cached_property
    def demand_vs_supply(self) -> DataFrame:
        supply = intermediate.current_supply(
            self.stored_fct_station_status, self.latest_complete_snapshot
        )
        return intermediate.demand_of(self.station_demand, supply)

    @cached_property
    def trip_summary_daily(self) -> DataFrame:
        return marts.summary_of_days(self._table("daily"), self.calendar)

    @cached_property
    def usage_pattern_hourly(self) -> DataFrame:
        return marts.usage_of_cells(self._table("hourly"), self.calendar)

    @cached_property
    def member_vs_casual_behavior(self) -> DataFrame:
        days = self.calendar.select(F.col("date_day").alias("trip_date"), "is_weekend")
        histogram = self._table("durations").join(days, "trip_date", "left")
        return marts.behavior_of_histogram(histogram, self.dim_rider_type)

    @cached_property
    def trip_gate(self) -> DataFrame:
        zero = F.lit(0).cast("long")
        valid = self._table("fact_files").withColumn("rejected_rows", zero)
        rejected = self._table("rejected_files").withColumn("valid_rows", zero)
        return q.gate_of_counts(valid.unionByName(rejected), self.params)

    def assertions_report(self, names: Sequence[str] | None = None) -> DataFrame:
        """As in ``Models``; tests of the trips come from the results kept per segment."""
        wanted = set(names or [c.model for c in declared_checks(self.params)])
        kept = {"facts": FACT_MODELS, "rejected": ("stg_trips_rejected",)}
        others = wanted - {model for models in kept.values() for model in models}
        reports = [super().assertions_report(sorted(others))] if others else []
        for table, models in kept.items():
            checks = trip_checks(self.params, *(m for m in models if m in wanted))
            if checks:
                parents = {c.parent[1]: getattr(self, c.parent[1]) for c in checks if c.parent}
                reports.append(segment_checks.report(*self._trips_at, table, checks, parents))
        return q.union_all(reports)
