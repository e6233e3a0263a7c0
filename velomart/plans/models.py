"""The model graph over one set of raw tables.

Each attribute is a model. The station mapping, the bridge and the two facts have several
readers and are written once per graph; everything else stays a lazy DataFrame, so a query
that reads one mart never computes the columns it does not use.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from copy import copy
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velomart.operators.quality import (
    gate_status,
    gate_trips,
    phantom_stations,
    repeated_creates,
    run_checks,
)
from velomart.operators.rules import is_valid, status_rules, trip_rules
from velomart.params import Params
from velomart.plans import core, intermediate, marts, staging
from velomart.plans.checks import declared_checks
from velomart.workspace import materialize


CHECKED_OFTEN = (
    "stg_trips", "stg_station_status", "stations_deduplicated", "dim_date", "trips_dq_summary",
    "trip_summary_daily", "demand_vs_supply",
)


# scratch copies of these are partitioned, so that a reader of one snapshot opens one date
PARTITIONED = {"fct_station_status": "snapshot_date", "status_changes": "snapshot_date"}


def scratch(df: DataFrame, name: str) -> DataFrame:
    return materialize(df, name, PARTITIONED.get(name))


class Models:
    """``store_trips`` writes the trips before their first use, which pays off as soon as
    two models of the graph read them: the deduplication shuffle then runs once. A scratch copy
    holds the staged rows, half the size of the fact, whose keys and distances are worked out where
    they are read; any other ``store`` gets the fact itself.
    ``store(df, name)`` writes a table and returns it as stored. A model that is stored
    already can be assigned to its attribute before the first use."""

    def __init__(
        self,
        trips: DataFrame,
        status: DataFrame,
        information: DataFrame,
        params: Params,
        store_trips: bool = False,
        store: Callable[[DataFrame, str], DataFrame] = scratch,
    ) -> None:
        self.raw_trips = trips
        self.raw_status = status
        self.raw_information = information
        self.params = params
        self.store_trips = store_trips
        self.store = store

    # --- staging ---

    @cached_property
    def station_id_mapping(self) -> DataFrame:
        return self.store(staging.station_id_mapping(self.raw_trips), "station_id_mapping")

    @cached_property
    def cleaned_trips(self) -> DataFrame:
        return staging.cleaned_trips(self.raw_trips, self.station_id_mapping)

    @property
    def _stores_staged_trips(self) -> bool:
        return self.store_trips and self.store is scratch

    @cached_property
    def stg_trips(self) -> DataFrame:
        trips = staging.stg_trips(self.cleaned_trips, self.params)
        return self.store(trips, "stg_trips") if self._stores_staged_trips else trips

    def trips_through(self, last: str) -> DataFrame:
        """``stg_trips`` up to a column; a copy of it that was assigned or stored is used as it is."""
        if "stg_trips" in self.__dict__:
            return self.stg_trips
        return staging.stg_trips_through(self.cleaned_trips, self.params, last)

    @cached_property
    def stg_trips_rejected(self) -> DataFrame:
        return staging.stg_trips_rejected(self.cleaned_trips, self.params)

    @cached_property
    def cleaned_status(self) -> DataFrame:
        return staging.cleaned_status(self.raw_status)

    @cached_property
    def stg_station_status(self) -> DataFrame:
        return staging.stg_station_status(self.cleaned_status, self.params)

    @cached_property
    def stg_station_status_rejected(self) -> DataFrame:
        return staging.stg_station_status_rejected(self.cleaned_status, self.params)

    # --- stations and facts ---

    @cached_property
    def stations_deduplicated(self) -> DataFrame:
        trips = self.fct_trips if self.store_trips else self.trips_through("end_lng")
        return intermediate.stations_deduplicated(trips)

    @cached_property
    def station_id_bridge(self) -> DataFrame:
        bridge = intermediate.station_id_bridge(self.stations_deduplicated, self.raw_information)
        return self.store(bridge, "station_id_bridge")

    @cached_property
    def dim_station(self) -> DataFrame:
        return core.dim_station(self.station_id_bridge)

    @cached_property
    def station_risk(self) -> DataFrame:
        return intermediate.station_risk(
            self.stg_station_status, self.station_id_bridge, self.params
        )

    @cached_property
    def fct_trips(self) -> DataFrame:
        trips = core.fct_trips(self.stg_trips, self.params)
        return self.store(trips, "fct_trips") if self.store_trips and not self._stores_staged_trips else trips

    @cached_property
    def fct_station_status(self) -> DataFrame:
        return core.fct_station_status(self.station_risk)

    @cached_property
    def stored_fct_station_status(self) -> DataFrame:
        return self.store(self.fct_station_status, "fct_station_status")

    @cached_property
    def dim_date(self) -> DataFrame:
        trips = self.fct_trips if self.store_trips else self.trips_through("trip_date")
        return core.dim_date(trips, self.stg_station_status, self.params)

    @cached_property
    def calendar(self) -> DataFrame:
        """The days of ``dim_date`` without deduplicating: valid rows have the same bounds."""
        trips = (
            self.fct_trips
            if self.store_trips
            else self.cleaned_trips.where(is_valid(trip_rules(self.params)))
        )
        status = self.cleaned_status.where(is_valid(status_rules(self.params)))
        return core.dim_date(trips, status, self.params)

    @cached_property
    def dim_rider_type(self) -> DataFrame:
        return core.dim_rider_type(self.raw_trips.sparkSession)

    # --- derived ---

    @cached_property
    def latest_complete_snapshot(self) -> DataFrame:
        return intermediate.latest_complete_snapshot(self.stored_fct_station_status, self.params)

    @cached_property
    def demand_vs_supply(self) -> DataFrame:
        return intermediate.demand_vs_supply(
            self.fct_trips, self.stored_fct_station_status, self.latest_complete_snapshot
        )

    @cached_property
    def status_changes(self) -> DataFrame:
        return intermediate.status_changes(self.stored_fct_station_status)

    @cached_property
    def stored_status_changes(self) -> DataFrame:
        return self.store(self.status_changes, "status_changes")

    @cached_property
    def status_windows(self) -> DataFrame:
        return intermediate.status_windows(self.stored_status_changes, self.params)

    @cached_property
    def trips_dq_summary(self) -> DataFrame:
        """Stored: one row per file and reason, read by several reports."""
        summary = intermediate.trips_dq_summary(
            self.raw_trips, self.station_id_mapping, self.params
        )
        return materialize(summary, "trips_dq_summary")

    # --- marts ---

    @cached_property
    def trip_summary_daily(self) -> DataFrame:
        return marts.trip_summary_daily(self.fct_trips, self.calendar)

    @cached_property
    def station_popularity(self) -> DataFrame:
        return marts.station_popularity(self.demand_vs_supply)

    @cached_property
    def usage_pattern_hourly(self) -> DataFrame:
        return marts.usage_pattern_hourly(self.fct_trips, self.calendar)

    @cached_property
    def member_vs_casual_behavior(self) -> DataFrame:
        return marts.member_vs_casual_behavior(
            self.fct_trips, self.calendar, self.dim_rider_type
        )

    @cached_property
    def station_availability_realtime(self) -> DataFrame:
        return marts.station_availability_realtime(
            self.stored_fct_station_status, self.latest_complete_snapshot, self.params
        )

    @cached_property
    def station_risk_monitoring(self) -> DataFrame:
        return marts.station_risk_monitoring(
            self.stored_fct_station_status, self.latest_complete_snapshot, self.params
        )

    @cached_property
    def station_supply_demand(self) -> DataFrame:
        return marts.station_supply_demand(self.demand_vs_supply, self.params)

    @cached_property
    def station_volatility(self) -> DataFrame:
        return marts.station_volatility(self.stored_status_changes, self.params)

    # --- checks ---

    def assertions_report(self, names: Sequence[str] | None = None) -> DataFrame:
        """Violations of the declared checks and of the three whole-table ones.

        ``names`` limits the report to checks on these models. Models that several checks would
        compute again are stored first, in a copy of the graph, which itself stays as it is.
        """
        checks = declared_checks(self.params)
        wanted = set(names or [c.model for c in checks])
        checks = [c for c in checks if c.model in wanted]
        needed = {c.model for c in checks} | {c.parent[1] for c in checks if c.parent}
        graph = copy(self)
        for name in CHECKED_OFTEN:
            if name in needed and not (name == "stg_trips" and self._stores_staged_trips):
                setattr(graph, name, materialize(getattr(graph, name), f"checked_{name}"))
        if "status_changes" in needed or "status_windows" in needed:
            graph.status_changes = graph.stored_status_changes
        if "fct_station_status" in needed:
            graph.fct_station_status = graph.stored_fct_station_status
        tables = {name: getattr(graph, name) for name in sorted(needed)}
        whole = {
            ("dim_station", "no_phantom_station_ids"): phantom_stations,
            ("trips_dq_summary", "rejected_pct_below_threshold"): lambda t: intermediate.dq_per_file(
                t, self.params
            ).where("is_violation"),
            ("status_changes", "single_create"): repeated_creates,
        }
        report = run_checks(tables, checks)
        for (model, name), violations in whole.items():
            if model in wanted:
                counted = violations(tables[model]).agg(F.count(F.lit(1)).alias("violations"))
                report = report.unionByName(
                    counted.select(
                        F.lit(model).alias("model"), F.lit(name).alias("check_name"), "violations"
                    )
                )
        return report

    # --- gates ---

    @cached_property
    def trip_gate(self) -> DataFrame:
        valid = self.fct_trips if self.store_trips else self.stg_trips
        return gate_trips(valid, self.stg_trips_rejected, self.params)

    @cached_property
    def status_gate(self) -> DataFrame:
        return gate_status(
            self.stg_station_status, self.stg_station_status_rejected, self.params
        )
