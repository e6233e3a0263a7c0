"""Row rules: named conditions that reject a row.

A rule set is an ordered mapping of reason to a condition that is TRUE for a bad row. The
same conditions give the reason text, the reason array and the validity predicate, so the
valid and the rejected side of a split cannot drift apart.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velomart.functions import elapsed
from velomart.params import Params

Rules = Mapping[str, Column]

# Fixed value: accepted station ids.
STATION_ID_FORMAT = r"^([0-9]+(\.[0-9]+)?|(SYS|JC|HB)[0-9]+)$"


def reason_text(rules: Rules) -> Column:
    """Reasons that hit, joined by a comma; empty text for a valid row."""
    return F.concat_ws(",", *[F.when(bad, F.lit(reason)) for reason, bad in rules.items()])


def reason_array(rules: Rules) -> Column:
    hits = F.array(*[F.when(bad, F.lit(reason)) for reason, bad in rules.items()])
    return F.array_compact(hits)


def is_valid(rules: Rules) -> Column:
    """TRUE when no rule hits.

    One disjunction below a coalesce: Catalyst would split a conjunction of negated rules,
    push the parts to different operators and evaluate the cleaned columns again in each.
    """
    return ~F.coalesce(reduce(lambda a, b: a | b, rules.values()), F.lit(False))


def split(df: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with ``rejection_reason``)."""
    valid = is_valid(rules)
    return df.where(valid), df.where(~valid).withColumn("rejection_reason", reason_text(rules))


def _outside_box(lat: Column, lng: Column, p: Params) -> Column:
    in_lat = lat.between(p.lat_min, p.lat_max)
    in_lng = lng.between(p.lng_min, p.lng_max)
    return lat.isNotNull() & (~in_lat | ~in_lng)


def _duration_rules(p: Params) -> dict[str, Column]:
    """Rules of the duration. A plain comparison comes first: most rows need no elapsed seconds."""
    start, end, longest = F.col("started_at"), F.col("ended_at"), p.max_trip_duration_seconds
    seconds = elapsed("SECOND", end, start)
    latest = F.try_add(start, F.make_dt_interval(secs=F.lit(longest)))
    return {
        "negative_duration": (end < start) & (seconds < 0),
        "duration_extreme": (end >= latest) & (seconds > longest),
    }


def trip_rules(p: Params) -> Rules:
    """Rules of a cleaned trip with canonical station ids."""
    c = F.col
    timed = c("ride_id").isNotNull() & c("started_at").isNotNull() & c("ended_at").isNotNull()
    return {
        "missing_ride_id": c("ride_id").isNull(),
        "missing_started_at": c("started_at").isNull(),
        "missing_ended_at": c("ended_at").isNull(),
        **{reason: timed & bad for reason, bad in _duration_rules(p).items()},
        "invalid_start_station_id": ~c("start_station_id").rlike(STATION_ID_FORMAT),
        "invalid_end_station_id": ~c("end_station_id").rlike(STATION_ID_FORMAT),
        "missing_start_location": c("start_station_id").isNull()
        & (c("start_lat").isNull() | c("start_lng").isNull()),
        "missing_end_location": c("end_station_id").isNull()
        & (c("end_lat").isNull() | c("end_lng").isNull()),
        "start_coord_out_of_nyc": _outside_box(c("start_lat"), c("start_lng"), p),
        "end_coord_out_of_nyc": _outside_box(c("end_lat"), c("end_lng"), p),
    }


def raw_trip_rules(p: Params) -> Rules:
    """The rules of the quality summary: durations need no ride id, coordinates are unchecked."""
    return {
        **{r: bad for r, bad in trip_rules(p).items() if not r.endswith("_out_of_nyc")},
        **_duration_rules(p),
    }


def status_rules(p: Params) -> Rules:
    """Rules of a station-status row that need no reference data."""
    c = F.col
    sentinel = F.lit(p.status_sentinel_before).cast("timestamp")
    tolerance = F.make_dt_interval(mins=F.lit(p.status_future_tolerance_minutes))
    auxiliary = ("num_ebikes_available", "num_bikes_disabled", "num_docks_disabled")
    negative_auxiliary = reduce(
        lambda a, b: a | b, [F.coalesce(c(name), F.lit(0)) < 0 for name in auxiliary]
    )
    return {
        "missing_station_id": c("station_id").isNull(),
        "missing_bikes_available": c("num_bikes_available").isNull(),
        "missing_docks_available": c("num_docks_available").isNull(),
        "negative_availability": (c("num_bikes_available") < 0) | (c("num_docks_available") < 0),
        "negative_auxiliary_count": negative_auxiliary,
        "missing_last_reported": c("last_reported").isNull(),
        "invalid_last_reported_sentinel": c("last_reported") < sentinel,
        "last_reported_in_future": c("last_reported") > c("snapshot_timestamp") + tolerance,
        "missing_snapshot_timestamp": c("snapshot_timestamp").isNull(),
    }
