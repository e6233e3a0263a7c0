"""Pure column expressions; all of them stay inside Catalyst."""

from velomart.functions.columns import (
    clean_text,
    date_key,
    elapsed,
    haversine_km,
    iso_day_of_week,
    percentage,
    round_to_long,
    rounded_place,
    safe_divide,
    station_id_text,
    surrogate_key,
)

__all__ = [
    "clean_text",
    "date_key",
    "elapsed",
    "haversine_km",
    "iso_day_of_week",
    "percentage",
    "round_to_long",
    "rounded_place",
    "safe_divide",
    "station_id_text",
    "surrogate_key",
]
