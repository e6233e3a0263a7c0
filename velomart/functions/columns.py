from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text standing for NULL inside a hashed key.
KEY_NULL_TEXT = "~null~"

# The characters of the Unicode property White_Space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def _stripped(value: Column, stored: bool) -> Column:
    """Without outer white space. A ``stored`` value is a column of a table, which may be named
    several times: text with visible ASCII at both ends once its blanks are off is done, and only
    other text is searched for the whole set, which is slow. Computed values would be computed anew."""
    searched = F.btrim(value, F.lit(WHITE_SPACE))
    if not stored:
        return searched
    text = F.btrim(value)
    octets = text.cast("binary")
    visible = [F.substring(octets, at, 1).between(F.lit(b"!"), F.lit(b"~")) for at in (1, -1)]
    return F.when(visible[0] & visible[1], text).otherwise(searched)


def clean_text(value: Column, stored: bool = False) -> Column:
    """Strip outer white space, not only blanks; empty text is NULL."""
    return F.nullif(_stripped(value, stored), F.lit(""))


def station_id_text(value: Column, stored: bool = False) -> Column:
    """A trimmed station id without one trailing underscore; empty text is NULL."""
    trimmed = _stripped(value, stored)
    shorter = F.substring(trimmed, F.lit(1), F.length(trimmed) - 1)
    return F.nullif(F.when(trimmed.endswith("_"), shorter).otherwise(trimmed), F.lit(""))


def rounded_place(value: Column) -> Column:
    """A coordinate to six decimals. One that has no more is left as it is, which is cheap to tell;
    ``round`` goes through a decimal per value."""
    return F.when(F.rint(value * 1e6) / 1e6 == value, value).otherwise(F.round(value, 6))


def elapsed(unit: str, later: Column, earlier: Column) -> Column:
    """Whole elapsed units from ``earlier`` to ``later``, truncated towards zero."""
    return F.timestamp_diff(unit, earlier, later)


def iso_day_of_week(value: Column) -> Column:
    """1 is Monday, 7 is Sunday."""
    return (F.weekday(value) + 1).cast("long")


def date_key(day: Column) -> Column:
    """A date as the number yyyymmdd."""
    return F.year(day).cast("long") * 10_000 + F.month(day) * 100 + F.dayofmonth(day)


def round_to_long(value: Column) -> Column:
    """Round half away from zero, then cast; a bare cast would truncate."""
    return F.round(value, 0).cast("long")


def safe_divide(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percentage(part: Column, whole: Column, scale: int = 2) -> Column:
    return F.round(safe_divide(part, whole) * 100, scale)


def surrogate_key(*values: Column) -> Column:
    """Hash of the values as text, joined by a dash, with a sentinel for NULL."""
    texts = [F.coalesce(v.cast("string"), F.lit(KEY_NULL_TEXT)) for v in values]
    return F.md5(F.concat_ws("-", *texts))


def haversine_km(
    lat1: Column, lng1: Column, lat2: Column, lng2: Column, radius_km: float
) -> Column:
    """Great-circle distance in km; NULL when any coordinate is NULL."""
    half_lat = F.radians(lat2 - lat1) / 2
    half_lng = F.radians(lng2 - lng1) / 2
    chord = F.sin(half_lat) * F.sin(half_lat) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.sin(half_lng) * F.sin(half_lng)
    capped = F.when(chord > 1, 1.0).otherwise(chord)  # rounding may exceed 1 at antipodes
    return F.lit(2 * radius_km) * F.asin(F.sqrt(capped))
