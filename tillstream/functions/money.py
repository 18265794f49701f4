"""Exact money arithmetic and the rounding used by the marts.

Amounts carry two decimals, so sums run over whole cents in a bigint: the total does not depend on
how rows are partitioned, overflow raises instead of wrapping, and no decimal objects are allocated.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cents(amount: Column | str) -> Column:
    return F.rint(_col(amount) * 100).cast("bigint")


def money_sum(amount: Column | str) -> Column:
    return F.sum(cents(amount)) / F.lit(100.0)


def money_avg(amount: Column | str) -> Column:
    """Average over the non-null amounts; NULL when there are none."""
    return money_sum(amount) / F.nullif(F.count(_col(amount)), F.lit(0))


def round_away(x: Column | str, places: int) -> Column:
    """Round halves away from zero on the double itself (scale, round, unscale)."""
    x = _col(x).cast("double")
    scale = float(10**places)
    return F.signum(x) * F.floor(F.abs(x) * scale + 0.5) / F.lit(scale)


#: part of the last kept place within which a value below a half still counts as the half
TIE_SLACK = 1e-7


def round_steady(x: Column | str, places: int) -> Column:
    """`round_away` for running statistics: their last bits depend on the order of the additions,
    which must not decide a tie."""
    x = _col(x).cast("double")
    scale = float(10**places)
    return F.signum(x) * F.floor(F.abs(x) * scale + (0.5 + TIE_SLACK)) / F.lit(scale)


def ratio_pct(
    num: Column | str, den: Column | str, places: int = 2, otherwise: float | None = None, scale_first: bool = False
) -> Column:
    """`num / den * 100` where the denominator is positive, else `otherwise`.

    `scale_first` takes `num * 100 / den`, which can differ in the last kept place.
    """
    num, den = _col(num), _col(den)
    safe = F.when(den > 0, den)
    value = round_away(num * 100 / safe if scale_first else num / safe * 100, places)
    if otherwise is None:
        return value
    return F.when(den > 0, value).otherwise(F.lit(float(otherwise)))


def compact_number(n: Column | str) -> Column:
    """Text such as `3.4M`, `1.2K` or `950`."""
    n = _col(n).cast("double")
    return (
        F.when(n >= 1_000_000, F.format_string("%.1fM", round_away(n / 1_000_000, 1)))
        .when(n >= 1_000, F.format_string("%.1fK", round_away(n / 1_000, 1)))
        .otherwise(F.format_number(n, 0))
    )


def compact_currency(n: Column | str) -> Column:
    """Text such as `$3.45M`, `$1.2K` or `$950.00`."""
    n = _col(n).cast("double")
    return (
        F.when(n >= 1_000_000, F.format_string("$%.2fM", round_away(n / 1_000_000, 2)))
        .when(n >= 1_000, F.format_string("$%.1fK", round_away(n / 1_000, 1)))
        .otherwise(F.concat(F.lit("$"), F.format_number(n, 2)))
    )
