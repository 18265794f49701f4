"""Whole jobs: text in, stored tables out.

Raw texts go through `gate.clean_transactions` first; `score_clean` and `roll_up_clean` read the feed it writes. The
jobs that read text drop unreadable ones, which `quarantine` keeps. Each micro-batch writes to a folder of its own number and overwrites it on a retry, so a batch
replayed after a failure leaves the same files. `availableNow` drains what is there and stops;
pass a processing-time trigger for a continuous job.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillstream.session import apply_state_settings
from tillstream.sources import codecs
from tillstream.sources.stores import append_dedup, upsert_by_key
from tillstream.streaming.feeds import by_topic
from tillstream.streaming.gate import split_by_time, write_once
from tillstream.streaming.scoring import score_stream
from tillstream.streaming.windows import daily_spend

DRAIN = {"availableNow": True}
EVERY_30_SECONDS = {"processingTime": "30 seconds"}


def _start(df: DataFrame, write, checkpoint: str, trigger: dict) -> StreamingQuery:
    apply_state_settings(df.sparkSession)
    return df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def write_batches(df: DataFrame, path: str, checkpoint: str, trigger: dict = DRAIN) -> StreamingQuery:
    """Append-mode rows as Parquet, one folder per micro-batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return _start(df, write, checkpoint, trigger)


def score_transactions(
    text: DataFrame,
    enriched_path: str,
    anomalies_path: str,
    checkpoint: str,
    threshold: float = 3.0,
    trigger: dict = DRAIN,
) -> StreamingQuery:
    """Text to all scored transactions, and the flagged ones to a second table.

    The flagged rows are read back from the batch's own files: the scoring runs once per batch and
    nothing is held in executor memory between the two writes.
    """
    transactions, _ = codecs.parse_transactions(text)
    return score_clean(transactions, enriched_path, anomalies_path, checkpoint, threshold, trigger)


def score_clean(
    transactions: DataFrame,
    enriched_path: str,
    anomalies_path: str,
    checkpoint: str,
    threshold: float = 3.0,
    trigger: dict = DRAIN,
    before_commit: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """`score_transactions` for a stream of typed transactions. `before_commit` is called with the number of
    a micro-batch when its rows are written and Spark has not yet noted it as done."""
    scored = score_stream(transactions, threshold=threshold)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, folder = batch.sparkSession, f"batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(f"{enriched_path}/{folder}")
        stored = spark.read.schema(batch.schema).parquet(f"{enriched_path}/{folder}")
        stored.where("is_anomaly").write.mode("overwrite").parquet(f"{anomalies_path}/{folder}")
        if before_commit is not None:
            before_commit(batch_id)

    return _start(scored, write, checkpoint, trigger)


def quarantine(text: DataFrame, path: str, checkpoint: str, trigger: dict = DRAIN) -> StreamingQuery:
    """Texts that are not usable transactions, kept for inspection."""
    _, bad = codecs.parse_transactions(text)
    return write_batches(bad, path, checkpoint, trigger)


def roll_up_spend(
    text: DataFrame, path: str, checkpoint: str, size_seconds: int = 86_400, trigger: dict = DRAIN
) -> StreamingQuery:
    """Text to closed daily windows per user."""
    transactions, _ = codecs.parse_transactions(text)
    return write_batches(daily_spend(transactions, size_seconds=size_seconds), path, checkpoint, trigger)


def roll_up_clean(
    transactions: DataFrame, path: str, checkpoint: str, size_seconds: int = 86_400, trigger: dict = DRAIN
) -> StreamingQuery:
    """The clean feed of the gate to closed windows per user. Rows that the gate found late are left out: which
    rows count does not depend on how this job cuts the feed into micro-batches."""
    on_time = transactions.where("not is_late").drop("is_late")
    return write_batches(daily_spend(on_time, size_seconds=size_seconds), path, checkpoint, trigger)


def kafka_sink(df: DataFrame, topic: str, servers: str, checkpoint: str, trigger: dict = EVERY_30_SECONDS):
    """Rows as keyed JSON text to a topic. Needs the Spark Kafka connector."""
    writer = codecs.encode_json(df).writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
    return writer.option("topic", topic).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def store_scored(
    feed: DataFrame,
    routes: dict[str, str],
    checkpoint: str,
    trigger: dict = DRAIN,
    quarantine_path: str | None = None,
) -> StreamingQuery:
    """One feed of several topics of scored JSON to one stored table per topic (`topic -> path`),
    leaving out ids that are already stored.

    With `quarantine_path`, rows that cannot be read or whose time is impossible beside the others of the
    micro-batch go there (topic, value, reason), and the rows of topics without a route (`unknown topic`).
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # read once for all topics; lost blocks are read from the source again
        bad = batch.where(~F.coalesce(F.col("topic").isin(*routes), F.lit(False))).select("topic", "value", F.lit("unknown topic").alias("reason"))
        for topic, path in routes.items():
            rows, unreadable = codecs.decode_enriched(by_topic(batch, topic).select("value"), keep_text=True)
            rows, impossible = split_by_time(rows) if quarantine_path else (rows, rows.limit(0))
            for part, reason in ((unreadable, "unreadable"), (impossible, "impossible time")):
                bad = bad.unionByName(part.select(F.lit(topic).alias("topic"), "value", F.lit(reason).alias("reason")))
            append_dedup(rows.drop("value"), path)
        if quarantine_path:
            write_once(bad, quarantine_path, batch_id)
        batch.unpersist()

    return _start(feed, write, checkpoint, trigger)


def store_daily(
    text: DataFrame, path: str, checkpoint: str, trigger: dict = DRAIN, quarantine_path: str | None = None
) -> StreamingQuery:
    """Daily-spend JSON to the keyed table; a later record replaces an earlier one. Unreadable texts go to
    `quarantine_path` (value, reason)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        rows, unreadable = codecs.decode_daily(batch)
        arrived = rows.withColumn("_arrival", F.monotonically_increasing_id())
        upsert_by_key(arrived, path, ["user_id", "window_start"], "window_start", "_arrival")
        if quarantine_path:
            write_once(unreadable.select("value", F.lit("unreadable").alias("reason")), quarantine_path, batch_id)
        batch.unpersist()

    return _start(text, write, checkpoint, trigger)
