"""The given tables read as payment records.

`events` plays the live transactions and `lineitem` the stored history, which holds repeated ids.
Ids carry the text forms of the transaction contract.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.functions.money import cents
from tillstream.functions.scalars import hashed_id
from tillstream.operators.running import running_zscore
from tillstream.schemas import CURRENCIES, MERCHANT_CATEGORIES, PAYMENT_METHODS, STATUSES
from tillstream.session import file_bytes, is_single_file

#: "now" for each dataset, just after its last row
EVENTS_AS_OF = "2024-01-31"
HISTORY_AS_OF = "2001-11-05"

#: bytes of a Parquet file whose rows go to one partition
SPREAD_BYTES = 8 << 20

#: settles equal times of one id in the history
HISTORY_TIEBREAK = ("amount", "user_id", "merchant_id", "payment_method", "location_lat", "location_lon", "status")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, path: str, *columns: str) -> DataFrame:
    """A table that is one single file is read by few tasks (one per row group); hash its rows over
    all cores before the per-row work, and over more partitions the larger the file is: what a task sorts or
    holds stays the same. Tables of many files are left as they are."""
    spark = df.sparkSession
    if is_single_file(spark, path):
        parts = -(-file_bytes(spark, path) // SPREAD_BYTES)
        return df.repartition(max(spark.sparkContext.defaultParallelism, parts), *columns)
    return df


def _pick(values: list[str], position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (position % len(values) + 1).cast("int"))


def _padded(prefix: str, number: Column, digits: int) -> Column:
    text = number.cast("string")
    return F.concat(F.lit(prefix), F.lpad(text, F.greatest(F.lit(digits), F.length(text)), F.lit("0")))


def transactions_from_events(events: DataFrame, *keep: str) -> DataFrame:
    """Live transactions, with the columns to `keep`; also works on a stream of events."""
    k = F.get_json_object("props", "$.k").cast("int")
    user, event = F.col("user_id"), F.col("event_id")
    status = F.when(event % 20 < 18, STATUSES[0]).when(event % 20 == 18, STATUSES[1]).otherwise(STATUSES[2])
    return events.select(
        hashed_id([user, F.unix_micros(F.col("ts").cast("timestamp")), cents("value"), event]).alias("txn_id"),
        _padded("user_", user, 6).alias("user_id"),
        F.col("value").alias("amount"),
        _pick(CURRENCIES, F.floor(event / 5)).alias("currency"),
        F.col("ts").alias("timestamp"),
        _padded("merchant_", k, 4).alias("merchant_id"),
        _pick(MERCHANT_CATEGORIES, k).alias("merchant_category"),
        _pick(PAYMENT_METHODS, event).alias("payment_method"),
        status.alias("status"),
        F.struct(
            ((k * 7) % 181 - 90).cast("double").alias("lat"), ((k * 13) % 361 - 180).cast("double").alias("lon")
        ).alias("location"),
        *keep,
    )


def live_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return transactions_from_events(spread(events, f"{sf_dir}/events.parquet", "event_id"))


def scored_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return running_zscore(live_transactions(spark, sf_dir))


def raw_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_transactions(spark, sf_dir).where("is_anomaly").drop("location", "status", "is_anomaly")


def raw_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored transactions as exported: flat, with scores, ids repeated."""
    order, line, part, supplier = (F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    second_of_day = (part * 37 + supplier * 11) % 86400
    status = (
        F.when(F.col("l_returnflag") != "R", STATUSES[0])
        .when(F.col("l_linestatus") == "F", STATUSES[1])
        .otherwise(STATUSES[2])
    )
    items = table(spark, sf_dir, "lineitem").withColumn("txn_id", F.concat_ws("-", order, line))
    # Dealt by the id itself, rows need no second shuffle and sort when they are de-duplicated by it.
    return spread(items, f"{sf_dir}/lineitem.parquet", "txn_id").select(
        "txn_id",
        _padded("user_", part, 6).alias("user_id"),
        F.col("l_extendedprice").alias("amount"),
        _pick(CURRENCIES, line).alias("currency"),
        F.timestamp_add("SECOND", second_of_day.cast("int"), "l_shipdate").alias("timestamp"),
        _padded("merchant_", supplier, 4).alias("merchant_id"),
        _pick(MERCHANT_CATEGORIES, supplier).alias("merchant_category"),
        _pick(PAYMENT_METHODS, F.col("l_quantity").cast("int")).alias("payment_method"),
        status.alias("status"),
        (F.col("l_discount") * 100).alias("location_lat"),
        (F.col("l_tax") * 100).alias("location_lon"),
        F.col("l_quantity").cast("bigint").alias("user_txn_count"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("user_running_mean"),
        (F.col("l_discount") * 100 - 5).alias("z_score"),
        (F.col("l_tax") > 0.07).alias("is_anomaly"),
    )
