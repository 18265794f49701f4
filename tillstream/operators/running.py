"""Running statistics per key over event order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.functions.money import round_steady
from tillstream.operators.ordered import HOT_ROWS, slices_for, sorted_slices
from tillstream.session import pinned

#: largest list of hot keys that is broadcast; beyond it the key join shuffles
MAX_BROADCAST_KEYS = 100_000


def score_columns(n: Column, mean: Column, m2: Column, value: Column, threshold: float) -> list[Column]:
    """The four output columns from the moments that already include the row itself."""
    spread = F.sqrt(F.when(n >= 2, m2 / (n - 1)))
    z = F.when(spread > 0, (value - mean) / spread).otherwise(F.lit(0.0))
    return [
        n.alias("user_txn_count"),
        round_steady(mean, 2).alias("user_running_mean"),
        round_steady(z, 4).alias("z_score"),
        (F.abs(z) > threshold).alias("is_anomaly"),
    ]


def _moments(frame) -> tuple[Column, Column, Column]:
    n = F.count("*").over(frame)
    return n, F.avg("_value").over(frame), F.var_pop("_value").over(frame) * n


#: the running moments of a row, itself included
MOMENTS = ("_n", "_mean", "_m2")


def merged_moments(n0: Column, mean0: Column, m20: Column, n1: Column, mean1: Column, m21: Column) -> list[Column]:
    """The moments of two sets of values together; the first one may be empty (0 or NULL)."""
    n0 = F.coalesce(n0, F.lit(0))
    n = n0 + n1
    gap = mean1 - F.coalesce(mean0, F.lit(0.0))
    mean = F.when(n0 == 0, mean1).otherwise(mean0 + gap * n1 / n)
    m2 = F.when(n0 == 0, m21).otherwise(m20 + m21 + gap * gap * n0 * n1 / n)
    return [n.alias("_n"), mean.alias("_mean"), m2.alias("_m2")]


def _plain(df: DataFrame, key: str, order: Sequence[str], columns: list[str]) -> DataFrame:
    frame = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    n, mean, m2 = _moments(frame)
    return df.select(*columns, n.alias("_n"), mean.alias("_mean"), m2.alias("_m2"))


def _sliced(df: DataFrame, key: str, order: Sequence[str], columns: list[str], slices: int) -> DataFrame:
    """Window inside each slice, then add the moments of the key's earlier slices.

    Copies of one row would all sort into one slice, so every row gets a number first. The numbered
    rows are pinned: a rerun task must not number them differently.
    """
    order = [*order, "_row"]
    rows = sorted_slices(pinned(df.withColumn("_row", F.monotonically_increasing_id())), [key, *order], slices)
    totals = rows.groupBy(key, "_slice").agg(
        F.count("*").alias("n"), F.avg("_value").alias("mean"), F.var_pop("_value").alias("var")
    )
    # Means are taken against the key's own mean, so the prefix sums do not cancel.
    whole = Window.partitionBy(key)
    before = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    centred = totals.withColumn("_mid", F.sum(F.col("n") * F.col("mean")).over(whole) / F.sum("n").over(whole))
    shift = F.col("mean") - F.col("_mid")
    sums = centred.select(
        F.col(key),
        "_slice",
        F.col("_mid"),
        F.sum("n").over(before).alias("_n0"),
        F.sum(F.col("n") * shift).over(before).alias("_d0"),
        F.sum(F.col("n") * (F.col("var") + shift * shift)).over(before).alias("_q0"),
    )
    carried = sums.where(F.col("_n0") > 0).select(
        key,
        "_slice",
        "_n0",
        (F.col("_mid") + F.col("_d0") / F.col("_n0")).alias("_mean0"),
        F.greatest(F.col("_q0") - F.col("_d0") * F.col("_d0") / F.col("_n0"), F.lit(0.0)).alias("_m20"),
    )
    frame = Window.partitionBy(key, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    n1, mean1, m21 = _moments(frame)
    local = rows.select("*", n1.alias("_n1"), mean1.alias("_mean1"), m21.alias("_m21"))
    # Null-safe: rows without a key are one key too.
    carried = carried.withColumnsRenamed({key: "_carried_key", "_slice": "_carried_slice"})
    same = F.col(key).eqNullSafe(F.col("_carried_key")) & (F.col("_slice") == F.col("_carried_slice"))
    joined = local.join(carried, same, "left")
    moments = merged_moments(*[F.col(c) for c in ("_n0", "_mean0", "_m20", "_n1", "_mean1", "_m21")])
    return joined.select(*columns, *moments)


def running_moments(
    df: DataFrame,
    key: str = "user_id",
    order: Sequence[str] = ("timestamp", "txn_id"),
    value: str = "amount",
    hot_rows: int = HOT_ROWS,
    slices: int | None = None,
) -> DataFrame:
    """Input columns plus `_value` (the value, 0 if missing) and the running MOMENTS of the row's key.

    Keys with more than `hot_rows` rows are spread over slices of the event order; all others take one window. At
    most `rows / hot_rows` keys can be hot.
    """
    rows = df.withColumn("_value", F.coalesce(F.col(value).cast("double"), F.lit(0.0)))
    columns = list(rows.columns)
    counts = df.groupBy(F.col(key).alias("_hot")).agg(F.count("*").alias("_rows"))
    hot = counts.where(F.col("_rows") > hot_rows)
    found = hot.limit(MAX_BROADCAST_KEYS + 1).collect()
    if not found:
        return _plain(rows, key, order, columns)
    spark = df.sparkSession
    if len(found) <= MAX_BROADCAST_KEYS:
        hot_total = sum(r["_rows"] for r in found)
        hot = F.broadcast(spark.createDataFrame(found, hot.schema))
    else:
        hot_total = hot.agg(F.sum("_rows")).first()[0]
    hot = hot.drop("_rows")
    slices = slices or slices_for(spark, hot_total, hot_rows)
    is_hot = F.col(key).eqNullSafe(F.col("_hot"))
    cold_rows, hot_part = rows.join(hot, is_hot, "left_anti"), rows.join(hot, is_hot, "left_semi")
    return _plain(cold_rows, key, order, columns).unionByName(_sliced(hot_part, key, order, columns, slices))


def running_zscore(
    df: DataFrame,
    key: str = "user_id",
    order: Sequence[str] = ("timestamp", "txn_id"),
    value: str = "amount",
    threshold: float = 3.0,
    hot_rows: int = HOT_ROWS,
    slices: int | None = None,
) -> DataFrame:
    """Score each row against its key's running mean and deviation, the row included; see `running_moments`."""
    rows = running_moments(df, key, order, value, hot_rows, slices)
    return rows.select(*df.columns, *score_columns(*[F.col(c) for c in (*MOMENTS, "_value")], threshold))


def totals_per_key(df: DataFrame, key: str = "user_id", value: str = "amount") -> DataFrame:
    """key and the MOMENTS of all its rows, partial before the shuffle."""
    x = F.coalesce(F.col(value).cast("double"), F.lit(0.0))
    totals = df.groupBy(key).agg(F.count("*").alias("_n"), F.avg(x).alias("_mean"), F.var_pop(x).alias("_var"))
    return totals.select(key, "_n", "_mean", (F.col("_var") * F.col("_n")).alias("_m2"))


def continued_zscore(
    df: DataFrame,
    before: DataFrame,
    key: str = "user_id",
    order: Sequence[str] = ("timestamp", "txn_id"),
    value: str = "amount",
    threshold: float = 3.0,
    hot_rows: int = HOT_ROWS,
    slices: int | None = None,
) -> DataFrame:
    """`running_zscore` of rows that go on from earlier ones: `before` holds the MOMENTS of each key's earlier
    rows, one row per key; a key that is not in it starts anew."""
    rows = running_moments(df, key, order, value, hot_rows, slices)
    start = before.select(F.col(key).alias("_start"), *[F.col(c).alias(f"{c}0") for c in MOMENTS])
    joined = rows.join(start, F.col(key).eqNullSafe(F.col("_start")), "left")
    merged = merged_moments(*[F.col(f"{c}0") for c in MOMENTS], *[F.col(c) for c in MOMENTS])
    joined = joined.select(*df.columns, "_value", *merged)
    return joined.select(*df.columns, *score_columns(*[F.col(c) for c in (*MOMENTS, "_value")], threshold))
