"""Scoring of micro-batches with hot keys, against the batch operator and across restarts."""

import json

from pyspark.sql import functions as F
from test_streaming import SCORES, feed_file, ordered_records

from tillstream.operators.running import continued_zscore, running_zscore, totals_per_key
from tillstream.sources import codecs
from tillstream.streaming import feeds, hot_scoring


def transactions(spark, records):
    return codecs.parse_transactions(spark.createDataFrame([(json.dumps(r),) for r in records], "value string"))[0]


def test_scores_go_on_over_micro_batches(spark, tmp_path, rows, monkeypatch):
    monkeypatch.setattr(hot_scoring, "SNAPSHOT", 2)
    records, source, root = ordered_records(), tmp_path / "in", str(tmp_path / "hot")
    for number in range(5):
        feed_file(source, number, records[number * 40 : (number + 1) * 40])

    def run():
        feed = codecs.parse_transactions(feeds.text_feed(spark, str(source), max_files=1))[0]
        hot_scoring.score_hot(feed, root, f"{root}-checkpoint", hot_rows=10).awaitTermination()

    run()
    feed_file(source, 5, records[200:])
    run()
    assert rows(spark.read.parquet(f"{root}/scored"), *SCORES) == rows(running_zscore(transactions(spark, records)), *SCORES)
    assert spark.read.parquet(f"{root}/snapshots").select("batch_id").distinct().count() == 2


def test_a_failed_micro_batch_changes_nothing_twice(spark, tmp_path, rows, monkeypatch):
    records, source, root = ordered_records(120), tmp_path / "in", str(tmp_path / "hot")
    for number in range(3):
        feed_file(source, number, records[number * 40 : (number + 1) * 40])
    real, calls = hot_scoring.write_once, []

    def failing(df, path, batch_id):
        calls.append(path)
        if batch_id == 1 and path.endswith("scored") and calls.count("failed") == 0:
            calls.append("failed")
            raise RuntimeError("crash after the moments were written")
        return real(df, path, batch_id)

    monkeypatch.setattr(hot_scoring, "write_once", failing)
    for _attempt in range(2):
        feed = codecs.parse_transactions(feeds.text_feed(spark, str(source), max_files=1))[0]
        try:
            hot_scoring.score_hot(feed, root, f"{root}-checkpoint", hot_rows=10).awaitTermination()
        except Exception as error:
            assert "crash after the moments" in str(error)
    assert "failed" in calls
    assert rows(spark.read.parquet(f"{root}/scored"), *SCORES) == rows(running_zscore(transactions(spark, records)), *SCORES)


def test_a_hot_key_is_spread_over_tasks(spark, rows):
    """One key with all rows of a micro-batch: no task holds more than its share, and the scores equal one window's."""
    n = 20_000
    df = spark.range(n).select(
        F.lit("u").alias("user_id"),
        F.concat(F.lit("t"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("txn_id"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).alias("timestamp"),
        (F.pmod(F.xxhash64("id"), 1000) / 10).alias("amount"),
    )
    first, second = df.where("txn_id < 't005000'"), df.where("txn_id >= 't005000'")
    before = totals_per_key(first)
    hot = continued_zscore(second, before, hot_rows=1000)
    per_task = hot.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(per_task) >= 4 and max(r["count"] for r in per_task) < 0.5 * n
    expected = running_zscore(df).where("txn_id >= 't005000'")
    assert rows(hot, *SCORES) == rows(expected, *SCORES)


def test_keys_without_a_past_start_anew(spark, rows):
    data = [(None, "a", 1, 5.0), (None, "b", 2, 7.0), ("v", "c", 1, 1.0)]
    df = spark.createDataFrame(data, "user_id string, txn_id string, timestamp long, amount double")
    before = totals_per_key(spark.createDataFrame([(None, 3.0), ("w", 9.0)], "user_id string, amount double"))
    found = continued_zscore(df, before)
    assert rows(found, "txn_id", "user_txn_count", "user_running_mean") == [("a", 2, 4.0), ("b", 3, 5.0), ("c", 1, 1.0)]
