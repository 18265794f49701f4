"""URL parts by text splitting, so they also work on addresses without a scheme."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WEB_SCHEMES = ("http://", "https://")
APP_SCHEME = "android-app://"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _without(text: Column, prefixes) -> Column:
    for prefix in prefixes:
        text = F.replace(text, F.lit(prefix), F.lit(""))
    return text


def _before(text: Column, mark: str) -> Column:
    return F.substring_index(text, mark, 1)


def url_host(url: Column | str) -> Column:
    bare = _without(_col(url), (APP_SCHEME, *WEB_SCHEMES))
    return _before(_before(bare, "/"), "?")


def url_path(url: Column | str) -> Column:
    """What follows the first `/` (or, with no slash, starts at `?`), up to the query."""
    bare = _without(_col(url), WEB_SCHEMES)
    slash = F.instr(bare, F.lit("/"))
    skipped = F.when(slash > 0, slash).otherwise(F.instr(bare, F.lit("?")) - 1)
    return _before(F.substr(bare, F.greatest(skipped, F.lit(0)) + 1), "?")


def url_parameter(url: Column | str, name: str) -> Column:
    """Text after `name=` up to the next `&`; NULL when absent or empty."""
    value = F.split_part(_col(url), F.lit(f"{name}="), F.lit(2))
    return F.nullif(_before(value, "&"), F.lit(""))
