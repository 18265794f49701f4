"""Null-safe arithmetic, bucketing, distance and key functions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, sub

from pyspark.sql import Column
from pyspark.sql import functions as F

# They decide the results and must stay as they are.
EARTH_RADIUS_MILES = 3961
KM_PER_MILE = 1.60934
NULL_KEY_TEXT = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _zeroed(fields: Sequence[Column | str]) -> list[Column]:
    if isinstance(fields, (str, Column)) or not fields:
        raise ValueError("pass a non-empty list of columns")
    return [F.coalesce(_col(f), F.lit(0)) for f in fields]


def safe_add(fields: Sequence[Column | str]) -> Column:
    return reduce(add, _zeroed(fields))


def safe_subtract(fields: Sequence[Column | str]) -> Column:
    return reduce(sub, _zeroed(fields))


def safe_divide(numerator: Column | str, denominator: Column | str) -> Column:
    """NULL instead of an error when the denominator is zero or NULL."""
    return F.try_divide(_col(numerator), _col(denominator))


def width_bucket(value: Column | str, low: Column | float, high: Column | float, buckets: Column | int) -> Column:
    """0 below `low`, 1..n inside, n+1 from `high` on."""
    as_double = [F.lit(x).cast("double") for x in (low, high)]
    return F.width_bucket(_col(value).cast("double"), *as_double, F.lit(buckets).cast("bigint"))


def haversine_distance(lat1, lon1, lat2, lon2, unit: str = "mi") -> Column:
    if unit not in ("mi", "km"):
        raise ValueError(f"unit must be 'mi' or 'km', got {unit!r}")
    lat1, lon1, lat2, lon2 = (_col(c) for c in (lat1, lon1, lat2, lon2))
    half_lat = F.sin(F.radians((lat2 - lat1) / 2))
    half_lon = F.sin(F.radians((lon2 - lon1) / 2))
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    miles = F.asin(F.sqrt(chord)) * (2 * EARTH_RADIUS_MILES)
    return miles * KM_PER_MILE if unit == "km" else miles


def surrogate_key(fields: Sequence[Column | str], null_as_empty: bool = False) -> Column:
    """md5 over the text of the fields; NULL gets its own text unless `null_as_empty`."""
    null_text = F.lit("" if null_as_empty else NULL_KEY_TEXT)
    texts = [F.coalesce(_col(f).cast("string"), null_text) for f in fields]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *texts))


def hashed_id(fields: Sequence[Column | str]) -> Column:
    """Repeatable 24-hex-digit id over `|`-joined fields."""
    return F.substring(F.sha2(F.concat_ws("|", *[_col(f).cast("string") for f in fields]), 256), 1, 24)
