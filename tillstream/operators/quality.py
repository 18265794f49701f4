"""Hourly checks on stored transactions, relative to `as_of`.

All counters come from one pass over the last 24 hours; only duplicate ids need a shuffle of rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.functions.times import AsOf, within_lookback
from tillstream.operators.contract import violations
from tillstream.schemas import CURRENCIES, PAYMENT_METHODS, STATUSES, TRANSACTION_CONTRACT

# Fixed limits of the checks.
REQUIRED_FIELDS = ("txn_id", "user_id", "amount", "currency", "timestamp", "merchant_id", "status")
ACCEPTED = {"currency": CURRENCIES, "payment_method": PAYMENT_METHODS, "status": STATUSES}
VOLUME_FACTOR = 3.0
APPROVED_SHARE = (0.80, 0.96)
STALE_MINUTES = 15
AMOUNT_RANGE = (0.01, 50_000.0)
SCORE_COLUMNS = ("user_txn_count", "user_running_mean", "z_score", "is_anomaly")


def recent(df: DataFrame, as_of: AsOf, amount: int, datepart: str = "hour") -> DataFrame:
    return df.where(within_lookback("timestamp", as_of, amount, datepart))


def schema_violations(
    df: DataFrame, as_of: AsOf, contract: Mapping = TRANSACTION_CONTRACT, allowed_extra: Sequence[str] = SCORE_COLUMNS
) -> DataFrame:
    """Each rule broken in the last hour, with the number of rows breaking it."""
    rows = recent(df, as_of, 1)
    broken = rows.select(F.explode(violations(df, contract, allowed_extra)).alias("violation"))
    return broken.groupBy("violation").agg(F.count("*").alias("n_rows"))


def volume(df: DataFrame, as_of: AsOf, factor: float = VOLUME_FACTOR) -> DataFrame:
    """Last hour against the hourly average of the last 24 hours."""
    last_hour = F.count_if(within_lookback("timestamp", as_of, 1, "hour"))
    counts = recent(df, as_of, 24).agg(last_hour.alias("last_hour"), F.count("*").alias("last_day"))
    ratio = F.col("last_hour") / F.nullif(F.col("last_day") / F.lit(24.0), F.lit(0.0))
    out = counts.withColumn("ratio", ratio)
    status = (
        F.when(F.col("ratio").isNull(), "skip")
        .when(F.col("ratio") > factor, "spike")
        .when(F.col("ratio") < 1.0 / factor, "drop")
        .otherwise("pass")
    )
    return out.withColumn("status", status)


def _blank(df: DataFrame, field: str) -> Column:
    if field not in df.columns:
        return F.lit(True)
    empty = F.col(field) == "" if isinstance(df.schema[field].dataType, T.StringType) else F.lit(False)
    return F.col(field).isNull() | empty


def null_fields(df: DataFrame, as_of: AsOf, fields: Sequence[str] = REQUIRED_FIELDS) -> DataFrame:
    """`field, n_rows` for required fields that are NULL or empty in the last hour."""
    counts = recent(df, as_of, 1).agg(*[F.count_if(_blank(df, f)).alias(f) for f in fields])
    return counts.unpivot([], list(fields), "field", "n_rows").where(F.col("n_rows") > 0)


def status_drift(
    df: DataFrame,
    as_of: AsOf,
    share: tuple[float, float] = APPROVED_SHARE,
    statuses: Sequence[str] = STATUSES,
    hours: int = 6,
) -> DataFrame:
    """Approved share over the last hours, and whether an unknown status occurs (NULL is one)."""
    known = F.coalesce(F.col("status").isin(list(statuses)), F.lit(False))
    counts = recent(df, as_of, hours).agg(
        F.count("*").alias("total"),
        F.count_if(F.col("status") == "approved").alias("approved"),
        F.count_if(~known).alias("unknown"),
    )
    rate = F.col("approved") / F.nullif(F.col("total"), F.lit(0))
    status = (
        F.when(F.col("total") == 0, "skip")
        .when(F.col("unknown") > 0, "invalid_status")
        .when(~F.col("approved_rate").between(*share), "drift")
        .otherwise("pass")
    )
    return counts.withColumn("approved_rate", rate).withColumn("status", status)


def staleness(df: DataFrame, as_of: AsOf, minutes: int = STALE_MINUTES) -> DataFrame:
    """Rows of the last minutes; none is stale. The time filter reaches the scan, so old files are
    skipped instead of searched for their latest row."""
    counts = recent(df, as_of, minutes, "minute").agg(F.count("*").alias("fresh_rows"))
    return counts.withColumn("status", F.when(F.col("fresh_rows") > 0, "pass").otherwise("stale"))


def duplicate_ids(df: DataFrame, as_of: AsOf, hours: int = 1, key: str = "txn_id") -> DataFrame:
    """Every id that occurs more than once in the window, with its count."""
    counted = recent(df, as_of, hours).groupBy(key).agg(F.count("*").alias("n_rows"))
    return counted.where(F.col("n_rows") > 1)


def top_duplicates(duplicates: DataFrame, k: int = 10, key: str = "txn_id") -> DataFrame:
    """The most repeated ids, for the report."""
    return duplicates.orderBy(F.col("n_rows").desc(), F.col(key)).limit(k)


def surplus_rows(duplicates: DataFrame) -> DataFrame:
    """Rows beyond the first of each id, over all ids."""
    return duplicates.agg(
        F.count("*").alias("n_ids"), F.coalesce(F.sum(F.col("n_rows") - 1), F.lit(0)).alias("surplus_rows")
    )


def amount_outliers(df: DataFrame, as_of: AsOf, limits: tuple[float, float] = AMOUNT_RANGE) -> DataFrame:
    """Last hour's amounts that are not positive, above the maximum, or positive below the minimum."""
    a, (low, high) = F.col("amount"), limits
    return recent(df, as_of, 1).agg(
        F.count_if(a <= 0).alias("not_positive"),
        F.count_if(a > high).alias("over_max"),
        F.count_if((a > 0) & (a < low)).alias("under_min"),
    )


def unexpected_values(
    df: DataFrame, as_of: AsOf, accepted: Mapping[str, Sequence[str]] = ACCEPTED, hours: int = 1
) -> DataFrame:
    """`field, value, n_rows` outside the accepted sets in the last hour; NULL is a violation."""
    fields = list(accepted)
    pairs = recent(df, as_of, hours).select(*fields).unpivot([], fields, "field", "value")
    known = F.lit(False)
    for field, values in accepted.items():
        known = known | ((F.col("field") == field) & F.col("value").isin(list(values)))
    counted = pairs.where(~F.coalesce(known, F.lit(False))).groupBy("field", "value")
    return counted.agg(F.count("*").alias("n_rows"))


def quality_report(df: DataFrame, as_of: AsOf, allowed_extra: Sequence[str] = SCORE_COLUMNS) -> DataFrame:
    """One row per check: failures and pass, fail or skip."""
    hour = within_lookback("timestamp", as_of, 1, "hour")
    six = within_lookback("timestamp", as_of, 6, "hour")
    stale_after = within_lookback("timestamp", as_of, STALE_MINUTES, "minute")
    a, (low, high) = F.col("amount"), AMOUNT_RANGE

    def unknown(field: str) -> Column:
        return ~F.coalesce(F.col(field).isin(list(ACCEPTED[field])), F.lit(False))

    def total(conditions) -> Column:
        out = F.lit(0).cast("bigint")
        for c in conditions:
            out = out + F.count_if(hour & c)
        return out

    broken = F.size(violations(df, TRANSACTION_CONTRACT, allowed_extra)) > 0
    counts = recent(df, as_of, 24).agg(
        F.count("*").alias("day"),
        F.count_if(hour).alias("hour"),
        F.count_if(stale_after).alias("fresh"),
        F.count_if(six).alias("six"),
        F.count_if(six & (F.col("status") == "approved")).alias("approved"),
        F.count_if(six & unknown("status")).alias("unknown_status"),
        F.count_if(hour & broken).alias("schema_violations"),
        total(_blank(df, f) for f in REQUIRED_FIELDS).alias("null_fields"),
        total([a <= 0, a > high, (a > 0) & (a < low)]).alias("amount_outliers"),
        total(unknown(f) for f in ACCEPTED).alias("accepted_values"),
    )
    ratio = F.col("hour") / F.nullif(F.col("day") / F.lit(24.0), F.lit(0.0))
    rate = F.col("approved") / F.nullif(F.col("six"), F.lit(0))
    off_volume = F.coalesce((ratio > VOLUME_FACTOR) | (ratio < 1.0 / VOLUME_FACTOR), F.lit(False))
    off_rate = F.coalesce(~rate.between(*APPROVED_SHARE), F.lit(False))

    def entry(name: str, failures: Column, skip: Column | None = None) -> Column:
        status = F.when(failures > 0, "fail").otherwise("pass")
        status = status if skip is None else F.when(skip, "skip").otherwise(status)
        return F.struct(F.lit(name).alias("check_name"), failures.cast("bigint").alias("failures"), status.alias("status"))

    entries = F.array(
        entry("schema_violations", F.col("schema_violations"), F.col("hour") == 0),
        entry("volume", off_volume.cast("int"), F.col("day") == 0),
        entry("null_fields", F.col("null_fields")),
        entry("status_drift", F.greatest(F.col("unknown_status"), off_rate.cast("bigint")), F.col("six") == 0),
        entry("staleness", (F.col("fresh") == 0).cast("int")),
        entry("amount_outliers", F.col("amount_outliers")),
        entry("accepted_values", F.col("accepted_values")),
    )
    counters = counts.select(F.explode(entries).alias("e")).select("e.*")
    repeated = surplus_rows(duplicate_ids(df, as_of)).select(entry("duplicates", F.col("surplus_rows")).alias("e"))
    return counters.unionAll(repeated.select("e.*"))
