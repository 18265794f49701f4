"""Revenue, merchant and anomaly marts.

The row-level work is one partial-then-final aggregation per mart; joins and windows run on its
output (one row per day or merchant). Stored marts are not sorted, readers order what they show.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstream.functions.money import cents, money_avg, money_sum, ratio_pct, round_away
from tillstream.functions.times import AsOf, within_lookback
from tillstream.operators.joins import left_with_default
from tillstream.plans.staging import approved_only


def daily_revenue(approved: DataFrame) -> DataFrame:
    return approved.groupBy("txn_date", "merchant_category", "currency").agg(
        F.count("*").alias("txn_count"),
        money_sum("amount").alias("total_revenue"),
        money_avg("amount").alias("avg_txn_amount"),
        F.min("amount").alias("min_txn_amount"),
        F.max("amount").alias("max_txn_amount"),
        F.count_distinct("user_id").alias("unique_users"),
        F.count_distinct("merchant_id").alias("unique_merchants"),
    )


def with_rolling_revenue(daily: DataFrame) -> DataFrame:
    """Trailing 7-row sum, 30-row average and growth per category and currency.

    Frames count rows (days with revenue), not calendar days. Sums stay in whole cents.
    """
    days = Window.partitionBy("merchant_category", "currency").orderBy("txn_date")
    in_cents = F.rint(F.col("total_revenue") * 100).cast("bigint")
    week, month = days.rowsBetween(-6, 0), days.rowsBetween(-29, 0)
    rolled = daily.withColumns(
        {
            "rolling_7d_revenue": F.sum(in_cents).over(week) / F.lit(100.0),
            "rolling_30d_avg_revenue": F.sum(in_cents).over(month) / F.lit(100.0) / F.count("*").over(month),
            "prev_day_revenue": F.lag("total_revenue").over(days),
        }
    )
    growth = F.col("total_revenue") - F.col("prev_day_revenue")
    return rolled.withColumn("dod_growth_pct", ratio_pct(growth, "prev_day_revenue"))


def fct_daily_revenue(stg_transactions: DataFrame) -> DataFrame:
    return with_rolling_revenue(daily_revenue(approved_only(stg_transactions)))


def merchant_stats(approved: DataFrame) -> DataFrame:
    return approved.groupBy("merchant_id", "merchant_category").agg(
        F.count("*").alias("lifetime_txn_count"),
        money_sum("amount").alias("lifetime_revenue"),
        money_avg("amount").alias("avg_txn_amount"),
        F.min("amount").alias("min_txn_amount"),
        F.max("amount").alias("max_txn_amount"),
        F.count_distinct("user_id").alias("unique_customers"),
        F.count_distinct("currency").alias("currency_count"),
        F.min("timestamp").alias("first_txn_at"),
        F.max("timestamp").alias("last_txn_at"),
    )


def anomaly_counts(stg_anomalies: DataFrame) -> DataFrame:
    return stg_anomalies.groupBy("merchant_id").agg(F.count("*").alias("anomaly_count"))


def dim_merchants(stg_transactions: DataFrame, stg_anomalies: DataFrame) -> DataFrame:
    """Lifetime statistics with the anomaly rate: anomalies of any status over approved
    transactions, so it can exceed 100."""
    stats = merchant_stats(approved_only(stg_transactions))
    joined = left_with_default(stats, anomaly_counts(stg_anomalies), ["merchant_id"], {"anomaly_count": 0})
    rate = ratio_pct("anomaly_count", "lifetime_txn_count", 4, otherwise=0, scale_first=True)
    return joined.withColumn("anomaly_rate_pct", rate)


def recent_merchants(approved: DataFrame, as_of: AsOf, days: int = 30) -> DataFrame:
    return (
        approved.where(within_lookback("txn_date", as_of, days))
        .groupBy("merchant_id", "merchant_category")
        .agg(
            F.count("*").alias("recent_txn_count"),
            money_sum("amount").alias("recent_revenue"),
            money_avg("amount").alias("recent_avg_amount"),
            F.count_distinct("user_id").alias("recent_unique_users"),
        )
    )


def lifetime_merchants(approved: DataFrame) -> DataFrame:
    return approved.groupBy("merchant_id").agg(
        F.count("*").alias("lifetime_txn_count"), money_sum("amount").alias("lifetime_revenue")
    )


def fct_merchant_rollup(stg_transactions: DataFrame, as_of: AsOf, days: int = 30) -> DataFrame:
    """One pass over the history: per merchant and category all rows and, by condition, the recent ones; the
    lifetime of a merchant is the sum over its categories."""
    approved = approved_only(stg_transactions).where("merchant_id is not null")
    recent = within_lookback("txn_date", as_of, days)
    amount = F.when(recent, F.col("amount"))
    per_category = approved.groupBy("merchant_id", "merchant_category").agg(
        F.count_if(recent).alias("recent_txn_count"),
        money_sum(amount).alias("recent_revenue"),
        money_avg(amount).alias("recent_avg_amount"),
        F.count_distinct(F.when(recent, F.col("user_id"))).alias("recent_unique_users"),
        F.count("*").alias("txn_count"),
        F.sum(cents("amount")).alias("cents"),
    )
    merchant = Window.partitionBy("merchant_id")
    return (
        per_category.withColumn("lifetime_txn_count", F.sum("txn_count").over(merchant))
        .withColumn("lifetime_revenue", F.sum("cents").over(merchant) / F.lit(100.0))
        .where("recent_txn_count > 0")
        .select(
            "merchant_id",
            "merchant_category",
            "recent_txn_count",
            "recent_revenue",
            round_away("recent_avg_amount", 2).alias("recent_avg_amount"),
            "recent_unique_users",
            "lifetime_txn_count",
            "lifetime_revenue",
            ratio_pct("recent_revenue", "lifetime_revenue", 2, otherwise=0).alias(f"pct_revenue_last_{days}d"),
        )
    )


def anomaly_daily(stg_anomalies: DataFrame) -> DataFrame:
    """Daily counts and severities. The bounds overlap: a score of exactly 4 is mild and moderate.

    Scores carry four decimals, so their average runs over whole ten-thousandths.
    """
    z = F.col("abs_z_score")
    units = F.sum(F.rint(z * 10000).cast("bigint"))
    return stg_anomalies.groupBy("anomaly_date", "merchant_category").agg(
        F.count("*").alias("anomaly_count"),
        F.count_distinct("user_id").alias("affected_users"),
        F.count_distinct("merchant_id").alias("affected_merchants"),
        (units / F.lit(10000.0) / F.count(z)).alias("avg_z_score"),
        F.max(z).alias("max_z_score"),
        money_sum("amount").alias("flagged_amount"),
        F.count_if(z.between(3, 4)).alias("mild_count"),
        F.count_if(z.between(4, 6)).alias("moderate_count"),
        F.count_if(z > 6).alias("severe_count"),
    )


def with_rolling_anomalies(daily: DataFrame) -> DataFrame:
    week = Window.partitionBy("merchant_category").orderBy("anomaly_date").rowsBetween(-6, 0)
    return daily.withColumn("rolling_7d_avg_anomalies", F.avg("anomaly_count").over(week))


def fct_anomaly_summary(stg_anomalies: DataFrame) -> DataFrame:
    return with_rolling_anomalies(anomaly_daily(stg_anomalies))
