"""One feed of transactions to three topics: every scored row, the flagged ones, and closed daily spend.

The three are one stream of (topic, key, value), the form a topic sink takes as it is, so a transaction is scored
once whatever is made of it. The sink is a function of a topic's rows; the one here writes each topic's rows of a
micro-batch once, so a micro-batch that runs again after a crash between two topics completes what is missing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillstream.session import apply_state_settings
from tillstream.sources import codecs
from tillstream.streaming.gate import write_once
from tillstream.streaming.scoring import score_stream
from tillstream.streaming.windows import DAY_SECONDS, LATENESS, daily_spend

ENRICHED, ANOMALIES, DAILY = TOPICS = ("transactions_enriched", "anomalies", "daily_spend")
#: fields that a flagged row leaves out
NOT_IN_ANOMALIES = ("status", "location", "is_anomaly")

Send = Callable[[DataFrame, str, int], None]


def topic_rows(
    transactions: DataFrame, threshold: float = 3.0, size_seconds: int = DAY_SECONDS, lateness: str = LATENESS
) -> DataFrame:
    """topic, key and value (JSON text) of a stream of clean transactions with `is_late`. Late rows are
    scored like others, but belong to no open window."""
    scored = score_stream(transactions.drop("is_late"), threshold=threshold)
    scored = scored.withColumn("timestamp", codecs.iso_text("timestamp"))
    options = {"ignoreNullFields": "false"}
    flagged = F.struct(*[c for c in scored.columns if c not in NOT_IN_ANOMALIES])
    texts = F.array(
        F.struct(F.lit(ENRICHED).alias("topic"), F.to_json(F.struct("*"), options).alias("value")),
        F.when(F.col("is_anomaly"), F.struct(F.lit(ANOMALIES).alias("topic"), F.to_json(flagged, options).alias("value"))),
    )
    rows = scored.select(F.col("user_id").alias("key"), F.explode(F.filter(texts, lambda t: t.isNotNull())).alias("t"))
    rows = rows.select("t.topic", "key", "t.value")
    on_time = transactions.where("not is_late").drop("is_late")
    spend = codecs.encode_daily(daily_spend(on_time, size_seconds=size_seconds, lateness=lateness))
    return rows.unionByName(spend.select(F.lit(DAILY).alias("topic"), "key", "value"))


def folder_sink(path: str) -> Send:
    """A topic as a folder with one part per micro-batch."""

    def send(rows: DataFrame, topic: str, batch_id: int) -> None:
        write_once(rows, f"{path}/{topic}", batch_id)

    return send


def fan_out(
    transactions: DataFrame,
    send: Send,
    checkpoint: str,
    threshold: float = 3.0,
    size_seconds: int = DAY_SECONDS,
    lateness: str = LATENESS,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Score a stream of clean transactions, roll up its spend, and `send` each topic's (key, value) rows."""
    apply_state_settings(transactions.sparkSession)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # the topics are three reads of one result; lost blocks are computed again from the same state
        for topic in TOPICS:
            send(batch.where(F.col("topic") == topic).select("key", "value"), topic, batch_id)
        batch.unpersist()

    rows = topic_rows(transactions, threshold, size_seconds, lateness)
    writer = rows.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
