"""Typed, de-duplicated staging models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.functions.times import date_parts, truncated
from tillstream.operators.dedup import dedup_latest

_COMMON = ["txn_id", "user_id", "amount", "currency", "timestamp", "merchant_id", "merchant_category", "payment_method"]
_CASTS = {
    "amount": "double",
    "location_lat": "double",
    "location_lon": "double",
    "user_txn_count": "int",
    "user_running_mean": "double",
    "z_score": "double",
    "is_anomaly": "boolean",
}


def _typed(names: Sequence[str]):
    return [F.col(c).cast(_CASTS[c]).alias(c) if c in _CASTS else F.col(c) for c in names]


def stg_transactions(raw: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    names = [*_COMMON, "status", "location_lat", "location_lon"]
    names += ["user_txn_count", "user_running_mean", "z_score", "is_anomaly"]
    return dedup_latest(raw, tiebreak=tiebreak).select(*_typed(names), *date_parts(raw))


def stg_anomalies(raw: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    names = [*_COMMON, "z_score", "user_running_mean", "user_txn_count"]
    day = truncated(raw, "day").alias("anomaly_date")
    size = F.abs(F.col("z_score").cast("double")).alias("abs_z_score")
    return dedup_latest(raw, tiebreak=tiebreak).select(*_typed(names), day, size)


def approved_only(txns: DataFrame) -> DataFrame:
    return txns.where(F.col("status") == "approved")
