"""Every threshold, label and semantic decision in one place.

Decisions worth knowing before reading the plans:

* Station status is deduplicated on ``(station_id, last_reported)`` and the latest poll
  wins. ``status_dedup_key`` switches to one row per station and poll.
* Numbers cast to integers are rounded half away from zero, never truncated.
* Durations count whole elapsed units truncated towards zero.
* Trip times are local wall-clock (``timestamp_ntz``); status times are UTC instants.
* Every tie left open by an ordering is broken by the remaining columns, so a rerun
  gives the same rows.
* "Now" is always the ``as_of`` argument, never the clock.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field

# Output labels of the dashboard marts.
AVAILABILITY_LABELS = {
    "not_operational": "Tidak beroperasi",
    "empty": "Kosong",
    "full": "Penuh",
    "low": "Sepeda sedikit",
    "high": "Dock sedikit",
    "unknown_capacity": "Kapasitas tidak diketahui",
    "otherwise": "Normal",
}
ACTION_LABELS = {
    "send": "Kirim sepeda ke stasiun ini",
    "collect": "Tarik sepeda dari stasiun ini",
    "otherwise": "Pantau",
}
DIRECTION_LABELS = {
    "supply": "Kirim sepeda (permintaan tinggi, pasokan rendah)",
    "drain": "Tarik sepeda (pasokan berlebih)",
    "demand": "Permintaan tinggi, pasokan cukup",
    "surplus": "Pasokan berlebih, permintaan rendah",
    "otherwise": "Seimbang",
}
VOLATILITY_LABELS = {"top": "sangat_fluktuatif", "high": "fluktuatif", "otherwise": "tenang"}
UNMAPPED_STATION_PREFIX = "Stasiun tak terpetakan ("
RIDER_TYPES = {
    "member": "Pengguna langganan tahunan (annual member)",
    "casual": "Pengguna harian / single ride (casual)",
}

# CSV tokens read as missing.
CSV_NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


@dataclass(frozen=True)
class Params:
    # trip rules
    max_trip_duration_seconds: int = 86_400
    lat_min: float = 40.47
    lat_max: float = 40.92
    lng_min: float = -74.27
    lng_max: float = -73.60
    # status rules
    status_sentinel_before: str = "2000-01-01 00:00:00"
    status_future_tolerance_minutes: int = 5
    status_dedup_key: tuple[str, ...] = ("station_id", "last_reported")
    # risk
    low_occupancy_pct: float = 20.0
    high_occupancy_pct: float = 80.0
    freshness_minutes: int = 10
    complete_snapshot_share: float = 0.95
    # change archive
    gap_minutes: int = 10
    volatility_top: float = 0.90
    volatility_high: float = 0.70
    # quality gates and watchdogs
    quarantine_alert_pct: float = 5.0
    liveness_minutes: int = 10
    dlq_window_minutes: int = 30
    dlq_alert_rows: int = 200
    # retention in days
    retention_days: Mapping[str, int] = field(
        default_factory=lambda: {"station_status": 14, "station_status_dlq": 30, "dq_metrics": 90}
    )
    lake_retention_days: Mapping[str, int] = field(
        default_factory=lambda: {"raw/station_status": 30, "raw/trips": 180, "reference": 365}
    )
    # geography: mean radius of the sphere used for distances
    earth_radius_km: float = 6371.01
    # calendar
    as_of: dt.datetime = dt.datetime(2026, 3, 31)
    calendar_default_start: dt.date = dt.date(2026, 1, 1)
    calendar_default_end: dt.date = dt.date(2026, 3, 31)
    calendar_lookahead_days: int = 7
    # labels
    availability_labels: Mapping[str, str] = field(default_factory=lambda: AVAILABILITY_LABELS)
    action_labels: Mapping[str, str] = field(default_factory=lambda: ACTION_LABELS)
    direction_labels: Mapping[str, str] = field(default_factory=lambda: DIRECTION_LABELS)
    volatility_labels: Mapping[str, str] = field(default_factory=lambda: VOLATILITY_LABELS)
