"""Quality gates, metrics, watchdog checks and assertions.

Checks return small DataFrames. Gates that must stop a run go through ``enforce``, which
collects only the violating rows, one per source file.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velomart.functions import elapsed, safe_divide
from velomart.params import Params


# Fixed value: label of rows without a source file.
UNKNOWN_SOURCE = "(tidak diketahui)"


class QualityGateError(ValueError):
    """Too many rows were quarantined."""


def _share(rejected: Column, total: Column) -> Column:
    return F.round(safe_divide(rejected, total) * 100, 4)


def _rows() -> Column:
    return F.count(F.lit(1))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union as a balanced tree; a chain would be analysed again with every link."""
    if len(frames) == 1:
        return frames[0]
    middle = len(frames) // 2
    return union_all(frames[:middle]).unionByName(union_all(frames[middle:]))


def gate_trips(valid: DataFrame, rejected: DataFrame, p: Params) -> DataFrame:
    """Rejected share per source file; a file without one valid row counts as 100 %.

    Both sides are aggregated map-side in one union, so no file is gathered whole.
    """
    sides = valid.select("_source_file", F.lit(0).alias("_bad")).unionByName(
        rejected.select("_source_file", F.lit(1).alias("_bad"))
    )
    bad = F.sum("_bad")
    counts = sides.groupBy("_source_file").agg(
        (_rows() - bad).alias("valid_rows"), bad.alias("rejected_rows")
    )
    return gate_of_counts(counts, p)


def gate_of_counts(counts: DataFrame, p: Params) -> DataFrame:
    """The trip gate from valid and rejected rows per file; parts of a file add up."""
    valid, rejected = F.sum("valid_rows"), F.sum("rejected_rows")
    return (
        counts.groupBy("_source_file")
        .agg(
            valid.alias("total_rows"),
            rejected.alias("rejected_rows"),
            _share(rejected, valid + rejected).alias("rejected_pct"),
        )
        .where(F.col("rejected_rows") > 0)
        .select(
            F.lit("trips").alias("layer"),
            F.coalesce("_source_file", F.lit(UNKNOWN_SOURCE)).alias("source"),
            "total_rows",
            "rejected_rows",
            "rejected_pct",
            (F.col("rejected_pct") > p.quarantine_alert_pct).alias("is_violation"),
        )
    )


def gate_status(valid: DataFrame, rejected: DataFrame, p: Params) -> DataFrame:
    """Overall rejected share of the status feed; an empty feed passes with 0."""
    return status_gate_of_counts(counts_by_side(valid, rejected), p)


def status_gate_of_counts(counts: DataFrame, p: Params) -> DataFrame:
    """The status gate from one row of valid and rejected counts."""
    total = F.nullif(F.col("valid_rows") + F.col("rejected_rows"), F.lit(0))
    pct = _share(F.col("rejected_rows"), total)
    return counts.select(
        F.lit("station_status").alias("layer"),
        F.lit("station_status").alias("source"),
        F.col("valid_rows").alias("total_rows"),
        "rejected_rows",
        F.coalesce(pct, F.lit(0.0)).alias("rejected_pct"),
        F.coalesce(pct > p.quarantine_alert_pct, F.lit(False)).alias("is_violation"),
    )


def counts_by_side(valid: DataFrame, rejected: DataFrame) -> DataFrame:
    """One row: valid rows, rejected rows, rejected share."""
    sides = valid.select(F.lit(0).alias("_bad")).unionByName(
        rejected.select(F.lit(1).alias("_bad"))
    )
    bad = F.coalesce(F.sum("_bad"), F.lit(0))
    return sides.agg(
        (_rows() - bad).alias("valid_rows"),
        bad.alias("rejected_rows"),
        _share(bad, F.nullif(_rows(), F.lit(0))).alias("rejected_pct"),
    )


def enforce(gate: DataFrame) -> None:
    """Raise when the gate holds a violation, naming every source, one row per file."""
    violations = gate.where("is_violation").orderBy(F.desc("rejected_pct"), "source").collect()
    if violations:
        listed = ", ".join(f"{v.layer}/{v.source}={v.rejected_pct}%" for v in violations)
        raise QualityGateError(f"quarantine share above the threshold: {listed}")


class DataTestError(ValueError):
    """A declared data test found violations."""


def enforce_checks(report: DataFrame) -> None:
    """Raise when a check found violations, naming every such check."""
    failed = report.where("violations > 0").orderBy("model", "check_name").collect()
    if failed:
        listed = ", ".join(f"{r.model}.{r.check_name}={r.violations}" for r in failed)
        raise DataTestError(f"data tests failed: {listed}")


def dq_metrics(
    layers: Mapping[str, tuple[DataFrame, DataFrame, DataFrame]], run_id: str, p: Params
) -> DataFrame:
    """One metrics row per layer of (valid, rejected, raw), ready for ``dq_metrics``.

    What is neither valid nor rejected was a duplicate.
    """

    def one(layer: str, valid: DataFrame, rejected: DataFrame, raw: DataFrame) -> DataFrame:
        counts = counts_by_side(valid, rejected).withColumn("raw_rows", raw.agg(_rows()).scalar())
        return dq_metrics_of_counts(layer, counts, run_id, p)

    return reduce(DataFrame.unionByName, [one(n, *sides) for n, sides in layers.items()])


def dq_metrics_of_counts(layer: str, counts: DataFrame, run_id: str, p: Params) -> DataFrame:
    """The metrics row of one layer from its raw, valid and rejected rows."""
    total = F.col("valid_rows") + F.col("rejected_rows")
    share = _share(F.col("rejected_rows"), F.nullif(total, F.lit(0)))
    return counts.select(
        F.lit(p.as_of.date()).alias("run_date"),
        F.lit(layer).alias("layer"),
        F.lit(run_id).alias("run_id"),
        total.alias("total_rows"),
        "valid_rows",
        "rejected_rows",
        (F.col("raw_rows") - total).cast("long").alias("duplicate_rows"),
        F.coalesce(share, F.lit(0.0)).alias("rejected_pct"),
        F.lit(p.as_of).cast("timestamp").alias("noted_at"),
    )


# --- watchdog -------------------------------------------------------------------------


def _check(df: DataFrame, name: str, status: Column, observed: Column) -> DataFrame:
    return df.select(
        F.lit(name).alias("check_name"),
        status.alias("status"),
        F.round(observed.cast("double"), 4).alias("observed"),
    )


def check_freshness(status: DataFrame, p: Params) -> DataFrame:
    """Age in minutes of the newest snapshot: EMPTY, STALE or OK."""
    seconds = elapsed("SECOND", F.lit(p.as_of).cast("timestamp"), F.col("newest"))
    newest = status.agg(F.max("snapshot_timestamp").alias("newest"))
    verdict = (
        F.when(F.col("newest").isNull(), "EMPTY")
        .when(seconds > p.freshness_minutes * 60, "STALE")
        .otherwise("OK")
    )
    return _check(newest, "freshness", verdict, F.round(seconds / 60, 1))


def check_liveness(newest_write: DataFrame, p: Params) -> DataFrame:
    """Age in minutes of the newest stored file (column ``newest``)."""
    seconds = elapsed("SECOND", F.lit(p.as_of).cast("timestamp"), F.col("newest"))
    verdict = (
        F.when(F.col("newest").isNull(), "EMPTY")
        .when(seconds > p.liveness_minutes * 60, "STALE")
        .otherwise("OK")
    )
    return _check(newest_write, "consumer_liveness", verdict, F.round(seconds / 60, 1))


def check_dlq_growth(dlq: DataFrame, p: Params) -> DataFrame:
    """Dead letters inside the last window."""
    since = F.lit(p.as_of).cast("timestamp") - F.make_dt_interval(mins=F.lit(p.dlq_window_minutes))
    recent = dlq.where(F.col("failed_at") >= since).agg(_rows().alias("rows_dlq"))
    verdict = F.when(F.col("rows_dlq") > p.dlq_alert_rows, "SURGE").otherwise("OK")
    return _check(recent, "dlq_growth", verdict, F.col("rows_dlq"))


def check_staging_rejection(valid: DataFrame, rejected: DataFrame, p: Params) -> DataFrame:
    counts = counts_by_side(valid, rejected)
    verdict = (
        F.when(F.col("rejected_pct").isNull(), "SKIPPED")
        .when(F.col("rejected_pct") > p.quarantine_alert_pct, "SURGE")
        .otherwise("OK")
    )
    return _check(counts, "staging_rejection", verdict, F.col("rejected_pct"))


def check_summary(checks: Sequence[DataFrame]) -> DataFrame:
    """Number of checks and of issues, and every verdict."""
    rows = union_all(list(checks))
    issue = ~F.col("status").isin("OK", "SKIPPED")
    pairs = F.transform(
        F.array_sort(F.collect_list(F.struct("check_name", "status"))),
        lambda x: F.concat_ws("=", x["check_name"], x["status"]),
    )
    return rows.agg(
        _rows().alias("checks"),
        F.count_if(issue).alias("issues"),
        F.array_join(pairs, ",").alias("statuses"),
    )


# --- assertions -----------------------------------------------------------------------


@dataclass(frozen=True)
class Check:
    """One declared data test. ``bad`` is a row condition; the other kinds need a shuffle."""

    model: str
    name: str
    bad: str | None = None
    unique: tuple[str, ...] = ()
    skip_null: bool = True
    parent: tuple[str, str, str] | None = None  # (child column, parent model, parent column)


def not_null(model: str, *columns: str) -> list[Check]:
    return [Check(model, f"not_null_{c}", bad=f"{c} IS NULL") for c in columns]


def unique(model: str, *columns: str) -> list[Check]:
    return [Check(model, f"unique_{c}", unique=(c,)) for c in columns]


def unique_combination(model: str, *columns: str) -> Check:
    name = f"unique_combination_{'_'.join(columns)}"
    return Check(model, name, unique=columns, skip_null=False)


def accepted_values(model: str, column: str, values: Sequence[object]) -> Check:
    listed = ", ".join(repr(v) for v in values)
    return Check(model, f"accepted_values_{column}", bad=f"{column} NOT IN ({listed})")


def expression_is_true(model: str, name: str, expression: str) -> Check:
    return Check(model, f"expression_{name}", bad=f"NOT ({expression})")


def relationship(model: str, column: str, parent: str, parent_column: str) -> Check:
    return Check(model, f"relationship_{column}", parent=(column, parent, parent_column))


def _row_checks(table: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All row conditions of one model from one scan and one aggregate."""
    counted = table.agg(
        *[F.count_if(F.expr(c.bad)).alias(f"v{i}") for i, c in enumerate(checks)]
    )
    rows = [
        F.struct(
            F.lit(c.model).alias("model"),
            F.lit(c.name).alias("check_name"),
            F.col(f"v{i}").alias("violations"),
        )
        for i, c in enumerate(checks)
    ]
    return counted.select(F.inline(F.array(*rows)))


def _entry(number: int, key: Sequence[Column], seen: int, known: bool) -> Column:
    """(check, 128-bit hash of the key, times seen, key is known to the parent).

    Two longs per key of any type keep the grouping in fixed-width hash aggregation. NULL marks
    are hashed too, so a NULL in one column is not mistaken for one in another.
    """
    parts = [x for c in key for x in (c, c.isNull())]
    return F.struct(
        F.lit(number).alias("check"),
        F.xxhash64(*parts).alias("h1"),
        F.xxhash64(F.lit(-1 - number), *parts).alias("h2"),
        F.lit(seen).cast("long").alias("seen"),
        F.lit(known).alias("known"),
    )


def _key_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """Uniqueness and relationships of all models from one grouping of their keys.

    Keys are counted map-side per check, so a frequent key is one row per map task. A key
    seen more than once breaks uniqueness; a key no parent row knows is an orphan, counted
    with all its rows.
    """
    spark = next(iter(tables.values())).sparkSession
    entries: dict[str, list[Column]] = {}
    for number, check in enumerate(checks):
        if check.parent:
            column, parent, parent_column = check.parent
            kind = tables[parent].schema[parent_column].dataType
            child = _entry(number, [F.col(column).cast(kind)], 1, False)
            entries.setdefault(check.model, []).append(F.when(F.col(column).isNotNull(), child))
            entry = _entry(number, [F.col(parent_column)], 0, True)
            entries.setdefault(parent, []).append(entry)
        else:
            entry = _entry(number, [F.col(c) for c in check.unique], 1, False)
            if check.skip_null:
                present = reduce(
                    lambda a, b: a & b, [F.col(c).isNotNull() for c in check.unique]
                )
                entry = F.when(present, entry)
            entries.setdefault(check.model, []).append(entry)
    # one entry per check without a key, so that a check of an empty table still reports 0
    none = F.lit(None).cast("long")
    seeds = [
        F.struct(F.lit(i).alias("check"), none.alias("h1"), none.alias("h2"),
                 F.lit(0).cast("long").alias("seen"), F.lit(False).alias("known"))
        for i in range(len(checks))
    ]
    keyed = [spark.range(0, 1, 1, 1).select(F.inline(F.array(*seeds)))]
    for model, columns in entries.items():
        keyed.append(tables[model].select(F.inline(F.array_compact(F.array(*columns)))))
    per_key = (
        union_all(keyed)
        .groupBy("check", "h1", "h2")
        .agg(F.sum("seen").alias("seen"), F.max("known").alias("known"))
    )
    is_relationship = F.col("check").isin([i for i, c in enumerate(checks) if c.parent])
    violations = F.when(
        is_relationship, F.when(~F.col("known"), F.col("seen")).otherwise(0)
    ).otherwise((F.col("seen") > 1).cast("long"))
    names = F.array(
        *[F.struct(F.lit(c.model).alias("m"), F.lit(c.name).alias("n")) for c in checks]
    )
    name = F.element_at(names, F.col("check") + 1)
    return (
        per_key.groupBy("check")
        .agg(F.sum(violations).alias("violations"))
        .select(name["m"].alias("model"), name["n"].alias("check_name"), "violations")
    )


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """(model, check_name, violations) for every check."""
    rows = [c for c in checks if c.bad is not None]
    keys = [c for c in checks if c.bad is None]
    results = [
        _row_checks(tables[model], [c for c in rows if c.model == model])
        for model in dict.fromkeys(c.model for c in rows)
    ]
    if keys:
        results.append(_key_checks(tables, keys))
    return union_all(results)


def phantom_stations(stations: DataFrame) -> DataFrame:
    """Stations that share name and place but not the id."""
    ids = F.array_sort(F.collect_set("station_id"))
    return (
        stations.dropna(subset=["station_name", "lat", "lng"])
        .withColumns({"lat": F.round("lat", 6), "lng": F.round("lng", 6)})
        .groupBy("station_name", "lat", "lng")
        .agg(
            F.countDistinct("station_id").alias("n_station_ids"),
            F.array_join(ids, " | ").alias("station_ids"),
        )
        .where("n_station_ids > 1")
    )


def repeated_creates(changes: DataFrame) -> DataFrame:
    """Stations with more than one create row in the change archive."""
    creates = F.count_if(F.col("op") == "c")
    return (
        changes.groupBy("gbfs_station_id").agg(creates.alias("creates")).where("creates > 1")
    )


def reconcile_split(
    raw: DataFrame, valid: DataFrame, kept: DataFrame, rejected: DataFrame
) -> DataFrame:
    """raw = kept + duplicates + rejected, as one row."""

    def count(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.lit(name).alias("side"))

    sides = reduce(
        DataFrame.unionByName,
        [count(raw, "raw"), count(valid, "valid"), count(kept, "kept"), count(rejected, "bad")],
    )
    n = {s: F.count_if(F.col("side") == s) for s in ("raw", "valid", "kept", "bad")}
    return sides.agg(
        n["raw"].alias("raw_rows"),
        n["kept"].alias("valid_rows"),
        (n["valid"] - n["kept"]).alias("duplicate_rows"),
        n["bad"].alias("rejected_rows"),
        (n["raw"] == n["valid"] + n["bad"]).alias("is_balanced"),
    )
