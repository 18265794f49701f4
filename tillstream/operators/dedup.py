"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def deduplicate(
    df: DataFrame,
    partition_by: Sequence[str | Column] | str,
    order_by: Sequence[str | Column],
    drop_null_rows: bool = False,
) -> DataFrame:
    """First row of each key by `order_by`; give a total order for a repeatable choice.

    Catalyst turns the rank filter into a group limit that also runs before the shuffle, so a key
    holding a large share of the rows sends one row per input partition.
    `drop_null_rows` leaves out rows with a NULL in any column, which is what joining the ranked
    rows back with a natural join gives.
    """
    keys = [partition_by] if isinstance(partition_by, (str, Column)) else list(partition_by)
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by)))
    kept = ranked.where(F.col("_rn") == 1).drop("_rn")
    return kept.dropna(how="any") if drop_null_rows else kept


def dedup_latest(
    df: DataFrame,
    key: Sequence[str] | str = "txn_id",
    order: str = "timestamp",
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Latest row per key; equal times are settled by `tiebreak`, largest first."""
    latest = [F.col(c).desc_nulls_last() for c in (order, *tiebreak)]
    return deduplicate(df, key, latest)
