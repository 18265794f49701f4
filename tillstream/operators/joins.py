"""Equi joins used by the marts and checks. Inputs are aggregated or made distinct before the
shuffle, so a key that is frequent on either side costs one row per input partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def left_with_default(left: DataFrame, right: DataFrame, on: Sequence[str], defaults: dict) -> DataFrame:
    """Left join; right columns named in `defaults` get the default where there is no match."""
    return left.join(right, list(on), "left").fillna(defaults)


def unmatched_keys(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    left_where: str | Column | None = None,
    right_where: str | Column | None = None,
) -> DataFrame:
    """`id, n_rows` for the non-null left keys without a right match."""
    left = left.where(left_where) if left_where is not None else left
    right = right.where(right_where) if right_where is not None else right
    ids = left.where(F.col(left_key).isNotNull()).groupBy(F.col(left_key).alias("id")).agg(F.count("*").alias("n_rows"))
    known = right.where(F.col(right_key).isNotNull()).select(F.col(right_key).alias("id")).distinct()
    return ids.join(known, "id", "left_anti")


def orphans(left: DataFrame, right: DataFrame, key: str, limit: int | None = None) -> DataFrame:
    """Left rows whose key is unknown on the right. `left` should hold one row per key."""
    missing = left.join(right.select(key), key, "left_anti")
    return missing.orderBy(key).limit(limit) if limit is not None else missing


def group_counts(a: DataFrame, b: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """Row counts of both inputs per group, as a full outer join: `count_a` or `count_b` is NULL
    where a group is on one side only. NULL group values match nothing, as in an equi join."""
    keys = list(group_by)

    def counted(df: DataFrame, name: str) -> DataFrame:
        # Without groups, an empty table gives no row at all.
        return df.groupBy(*(keys or [F.lit(1).alias("_all")])).agg(F.count("*").alias(name))

    on = keys or ["_all"]
    joined = counted(a, "count_a").join(counted(b, "count_b"), on, "full")
    return joined.select(*keys, "count_a", "count_b")
