"""Parameterised queries behind the API and the dashboard. They read raw transactions of every
status; `as_of` stands for the request time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.functions.money import money_avg, money_sum, round_away
from tillstream.functions.times import AsOf, truncated, within_lookback


def check_bounds(name: str, value: int, low: int, high: int) -> int:
    if not low <= value <= high:
        raise ValueError(f"{name} must be between {low} and {high}, got {value}")
    return value


def lookback(df: DataFrame, as_of: AsOf, days: int) -> DataFrame:
    return df.where(within_lookback("timestamp", as_of, check_bounds("days", days, 1, 365)))


def newest_first() -> list[Column]:
    return [F.col("timestamp").desc(), F.col("txn_id").asc()]


# ---- API -----------------------------------------------------------------------------------


def user_rows(df: DataFrame, user_id: str, as_of: AsOf, days: int = 30) -> DataFrame:
    return lookback(df, as_of, days).where(F.col("user_id") == user_id)


def user_stats(rows: DataFrame) -> DataFrame:
    """One row, zeros for an unknown user. The currency list is bounded by the currency codes."""
    total, count = F.coalesce(money_sum("amount"), F.lit(0.0)), F.count("*")
    return rows.agg(
        count.alias("total_transactions"),
        total.alias("total_spend"),
        F.coalesce(round_away(total / F.nullif(count, F.lit(0)), 2), F.lit(0.0)).alias("avg_transaction"),
        F.sort_array(F.collect_set("currency")).alias("currencies"),
    )


def user_categories(rows: DataFrame, k: int = 5) -> DataFrame:
    spend = rows.groupBy(F.col("merchant_category").alias("category")).agg(
        money_sum("amount").alias("spend"), F.count("*").alias("count")
    )
    return spend.orderBy(F.col("spend").desc(), F.col("category")).limit(k)


def recent_user_transactions(rows: DataFrame, limit: int = 20) -> DataFrame:
    return rows.orderBy(*newest_first()).limit(check_bounds("limit", limit, 1, 100))


def user_trends(
    df: DataFrame, user_id: str, as_of: AsOf, days: int = 30, limit: int = 20, cache: bool = True
) -> dict[str, DataFrame]:
    """Statistics, top categories and newest transactions over one filtered input. The filter
    reaches the scan; with `cache` the user's rows are read once for all three."""
    rows = user_rows(df, user_id, as_of, days)
    rows = rows.persist() if cache else rows
    return {
        "stats": user_stats(rows),
        "top_categories": user_categories(rows),
        "recent_transactions": recent_user_transactions(rows, limit),
    }


def user_trends_row(df: DataFrame, user_id: str, as_of: AsOf, days: int = 30, limit: int = 20) -> DataFrame:
    """The same answer as one nested row."""
    parts = user_trends(df, user_id, as_of, days, limit, cache=False)
    row = parts["stats"].select(F.lit(user_id).alias("user_id"), F.lit(days).alias("period_days"), "*")
    columns = row.columns
    for name in ("top_categories", "recent_transactions"):  # at most 5 and 100 rows
        packed = parts[name].agg(F.collect_list(F.struct("*")).alias(name))
        row = row.unionByName(packed, allowMissingColumns=True)
        columns = [*columns, name]
    return row.agg(*[F.first(c, ignorenulls=True).alias(c) for c in columns])


def trends_of_users(df: DataFrame, as_of: AsOf, days: int = 30, limit: int = 20, categories: int = 5) -> DataFrame:
    """The answer of `user_trends` for every user with rows in the period, one nested row each: statistics,
    `top_categories` (by spend, then name) and `recent_transactions` (newest first, all columns).

    Statistics and categories are grouping sets of one pass, so a busy user sends one row per category and task. The
    newest rows are cut to `limit` in every task before the shuffle. A user's list of categories is as long as there
    are categories; nothing else is collected.
    """
    rows = lookback(df, as_of, days)
    check_bounds("limit", limit, 1, 100)
    fields = rows.select("user_id", "merchant_category", "amount", "currency")
    sets = fields.groupingSets([["user_id"], ["user_id", "merchant_category"]], "user_id", "merchant_category")
    facets = sets.agg(
        F.grouping("merchant_category").alias("is_total"),
        F.count("*").alias("n"),
        F.coalesce(money_sum("amount"), F.lit(0.0)).alias("spend"),
        F.collect_set("currency").alias("currencies"),
    )
    total = lambda c: F.first(F.when(F.col("is_total") == 1, c), ignorenulls=True)
    category = F.struct((-F.col("spend")).alias("minus"), F.col("merchant_category").alias("category"), F.col("n").alias("count"))
    ranked = F.slice(F.sort_array(F.collect_list(F.when(F.col("is_total") == 0, category))), 1, categories)
    named = F.transform(ranked, lambda c: F.struct(c["category"].alias("category"), (-c["minus"]).alias("spend"), c["count"].alias("count")))
    answers = facets.groupBy("user_id").agg(
        total(F.col("n")).alias("total_transactions"),
        total(F.col("spend")).alias("total_spend"),
        F.sort_array(total(F.col("currencies"))).alias("currencies"),
        named.alias("top_categories"),
    )
    place = F.row_number().over(Window.partitionBy("user_id").orderBy(*newest_first()))
    newest = rows.withColumn("place", place).where(F.col("place") <= limit)
    kept = F.struct("place", *[c for c in rows.columns if c != "user_id"])
    recent = newest.groupBy(F.col("user_id").alias("of_user")).agg(F.sort_array(F.collect_list(kept)).alias("recent_transactions"))
    joined = answers.join(recent, F.col("user_id").eqNullSafe(F.col("of_user")))
    average = round_away(F.col("total_spend") / F.col("total_transactions"), 2)
    return joined.select(
        "user_id",
        F.lit(days).alias("period_days"),
        "total_transactions",
        "total_spend",
        average.alias("avg_transaction"),
        "currencies",
        "top_categories",
        F.transform("recent_transactions", lambda r: r.dropFields("place")).alias("recent_transactions"),
    )


def anomalies(
    df: DataFrame,
    as_of: AsOf,
    days: int = 7,
    limit: int = 50,
    user_id: str | None = None,
    min_z: float | None = None,
    absolute: bool = False,
) -> DataFrame:
    """Newest anomalies. `min_z` compares the signed score unless `absolute`."""
    rows = df.where(within_lookback("timestamp", as_of, check_bounds("days", days, 1, 90)))
    if user_id:
        rows = rows.where(F.col("user_id") == user_id)
    if min_z is not None:
        z = F.abs("z_score") if absolute else F.col("z_score")
        rows = rows.where(z >= min_z)
    return rows.orderBy(*newest_first()).limit(check_bounds("limit", limit, 1, 500))


def top_merchants(df: DataFrame, as_of: AsOf, days: int = 30, limit: int = 10) -> DataFrame:
    totals = (
        lookback(df, as_of, days)
        .groupBy("merchant_id", "merchant_category")
        .agg(
            money_sum("amount").alias("total_revenue"),
            F.count("*").alias("transaction_count"),
            round_away(money_avg("amount"), 2).alias("avg_transaction"),
        )
    )
    order = [F.col("total_revenue").desc(), F.col("merchant_id"), F.col("merchant_category")]
    return totals.orderBy(*order).limit(check_bounds("limit", limit, 1, 50))


# ---- dashboard -----------------------------------------------------------------------------


def kpis(df: DataFrame, anomaly_rows: DataFrame, as_of: AsOf, days: int) -> DataFrame:
    """One row: counts, revenue, average and anomaly count, zeros when there is nothing."""
    zero, flagged = F.lit(0.0), F.col("flagged")
    txns = lookback(df, as_of, days).select("amount", F.lit(False).alias("flagged"))
    alerts = lookback(anomaly_rows, as_of, days)
    alerts = alerts.select(F.lit(None).cast(df.schema["amount"].dataType).alias("amount"), F.lit(True).alias("flagged"))
    return txns.unionAll(alerts).agg(
        F.count_if(~flagged).alias("total_txns"),
        F.coalesce(money_sum("amount"), zero).alias("total_revenue"),
        F.coalesce(round_away(money_avg("amount"), 2), zero).alias("avg_amount"),
        F.count_if(flagged).alias("anomaly_count"),
    )


def hourly_volume(df: DataFrame, as_of: AsOf, days: int) -> DataFrame:
    hours = lookback(df, as_of, days).groupBy(truncated(df, "hour").alias("timestamp"))
    return hours.agg(F.count("*").alias("transactions"), money_sum("amount").alias("revenue")).orderBy("timestamp")


def category_breakdown(df: DataFrame, as_of: AsOf, days: int) -> DataFrame:
    by_category = lookback(df, as_of, days).groupBy(F.col("merchant_category").alias("category"))
    spend = by_category.agg(money_sum("amount").alias("spend"), F.count("*").alias("count"))
    return spend.orderBy(F.col("spend").desc(), F.col("category"))


def status_distribution(df: DataFrame, as_of: AsOf, days: int) -> DataFrame:
    counts = lookback(df, as_of, days).groupBy("status").agg(F.count("*").alias("count"))
    return counts.orderBy(F.col("count").desc(), F.col("status"))


def dashboard_top_merchants(df: DataFrame, as_of: AsOf, days: int, limit: int = 10) -> DataFrame:
    return top_merchants(df, as_of, days, limit).select(
        "merchant_id",
        F.col("merchant_category").alias("category"),
        F.col("total_revenue").alias("revenue"),
        F.col("transaction_count").alias("txn_count"),
    )


def dashboard_recent_anomalies(df: DataFrame, as_of: AsOf, days: int, limit: int = 20) -> DataFrame:
    columns = ["timestamp", "txn_id", "user_id", "amount", "currency", "merchant_category"]
    rows = lookback(df, as_of, days).orderBy(*newest_first()).limit(limit)
    return rows.select(*columns, round_away("z_score", 2).alias("z_score"))


# ---- operations ----------------------------------------------------------------------------


def slow_ops(
    log: DataFrame, as_of: AsOf, duration: str, time: str, tiebreak: str, threshold=200, hours: int = 24, k: int = 20
) -> DataFrame:
    """Slowest rows of an operation log in the last hours."""
    slow = log.where((F.col(duration) >= threshold) & within_lookback(time, as_of, hours, "hour"))
    return slow.orderBy(F.col(duration).desc(), F.col(tiebreak)).limit(k)
