"""Daily spend per user over event time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.functions.money import cents, round_away

LATENESS = "5 seconds"
DAY_SECONDS = 86_400


def spend_windows(df: DataFrame, key: str = "user_id", size_seconds: int = DAY_SECONDS) -> DataFrame:
    """Count, total and average per key and tumbling window, aligned to the epoch in UTC.

    Works on a stream with a watermark and on a table. Partial aggregation runs before the
    shuffle, so a busy user sends one row per input partition and window.
    """
    total = F.sum(F.coalesce(cents("amount"), F.lit(0))) / F.lit(100.0)
    grouped = df.groupBy(key, F.window("timestamp", f"{size_seconds} seconds").alias("w"))
    spend = grouped.agg(F.count("*").alias("txn_count"), total.alias("total_spend"))
    average = round_away(F.col("total_spend") / F.col("txn_count"), 2)
    return spend.select(
        key,
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "txn_count",
        "total_spend",
        average.alias("avg_spend"),
    )


def daily_spend(
    stream: DataFrame, key: str = "user_id", size_seconds: int = DAY_SECONDS, lateness: str = LATENESS
) -> DataFrame:
    """Windows of a stream, each emitted once when the watermark passes its end; rows later than
    that are dropped."""
    return spend_windows(stream.withWatermark("timestamp", lateness), key, size_seconds)
