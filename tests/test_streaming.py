"""Streaming jobs: equality with the batch twin, restart, late rows, bad input and sinks."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tillstream.operators.running import running_zscore
from tillstream.sources import codecs, stores
from tillstream.streaming import feeds, jobs
from tillstream.streaming.scoring import score_stream
from tillstream.streaming.windows import daily_spend, spend_windows

START = dt.datetime(2024, 3, 1)


def txn(i, user, seconds, amount, **extra):
    stamp = (START + dt.timedelta(seconds=seconds)).isoformat() + "+00:00"
    return {
        "txn_id": f"t{i:04d}",
        "user_id": user,
        "amount": amount,
        "currency": "CAD",
        "timestamp": stamp,
        "merchant_id": "merchant_0001",
        "merchant_category": "grocery",
        "payment_method": "credit_card",
        "status": "approved",
        "location": {"lat": 43.65, "lon": -79.38},
        **extra,
    }


def feed_file(folder, number, records):
    """One text file; the numbers order the files by modification time."""
    folder.mkdir(exist_ok=True)
    path = folder / f"part-{number:03d}.json"
    lines = [r if isinstance(r, str) else json.dumps(r) for r in records]
    path.write_text("\n".join(lines) + "\n")
    os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))


def ordered_records(n=240):
    rng = random.Random(1)
    users = ["user_000001"] * 5 + ["user_000002", "user_000003"]
    return [txn(i, rng.choice(users), i * 900, 900.0 if rng.random() < 0.04 else rng.randrange(1000, 3000) / 100) for i in range(n)]


SCORES = ["txn_id", "user_txn_count", "user_running_mean", "z_score", "is_anomaly"]


def test_scoring_equals_batch_and_survives_restart(spark, tmp_path, rows):
    records, source = ordered_records(), tmp_path / "in"
    paths = [str(tmp_path / n) for n in ("enriched", "anomalies", "checkpoint")]
    for number in range(3):
        feed_file(source, number, records[number * 60 : (number + 1) * 60])
    jobs.score_transactions(feeds.text_feed(spark, str(source), max_files=1), *paths).awaitTermination()
    feed_file(source, 3, records[180:])  # the rest arrives after a stop
    jobs.score_transactions(feeds.text_feed(spark, str(source), max_files=1), *paths).awaitTermination()

    stored = spark.read.parquet(paths[0])
    text = spark.createDataFrame([(json.dumps(r),) for r in records], "value string")
    batch = running_zscore(codecs.parse_transactions(text)[0])
    assert rows(stored, *SCORES) == rows(batch, *SCORES)
    assert stored.select("batch_id").distinct().count() == 4
    flagged = rows(batch.where("is_anomaly"), "txn_id")
    assert flagged and rows(spark.read.parquet(paths[1]), "txn_id") == flagged
    assert stored.select("location.lat").first()[0] == 43.65


def test_late_rows_are_scored_on_arrival(spark, tmp_path):
    source, paths = tmp_path / "in", [str(tmp_path / n) for n in ("e", "a", "c")]
    feed_file(source, 0, [txn(0, "u", 9000, 10.0), txn(1, "u", 9001, 20.0)])
    feed_file(source, 1, [txn(2, "u", 5, 30.0)])
    jobs.score_transactions(feeds.text_feed(spark, str(source), max_files=1), *paths).awaitTermination()
    counts = {r.txn_id: r.user_txn_count for r in spark.read.parquet(paths[0]).collect()}
    assert counts == {"t0000": 1, "t0001": 2, "t0002": 3}


def test_missing_amount_counts_as_zero(spark, tmp_path):
    source, paths = tmp_path / "in", [str(tmp_path / n) for n in ("e", "a", "c")]
    record = txn(1, "u", 1, 50.0, location=None)
    del record["amount"]
    feed_file(source, 0, [txn(0, "u", 0, 50.0), record])
    jobs.score_transactions(feeds.text_feed(spark, str(source)), *paths).awaitTermination()
    last = spark.read.parquet(paths[0]).where("txn_id = 't0001'").first()
    assert (last.amount, last.user_txn_count, last.user_running_mean, last.location) == (None, 2, 25.0, None)


def test_bad_texts_are_quarantined(spark, tmp_path, rows):
    source = tmp_path / "in"
    nobody = txn(1, None, 1, 5.0)
    wrong = txn(2, "u", 1, "many")
    feed_file(source, 0, [txn(0, "u", 0, 5.0), "not valid json", nobody, wrong, ""])
    feed = feeds.text_feed(spark, str(source))
    jobs.quarantine(feed, str(tmp_path / "bad"), str(tmp_path / "c1")).awaitTermination()
    bad = [r[0] for r in rows(spark.read.parquet(str(tmp_path / "bad")), "value")]
    assert len(bad) == 4 and "not valid json" in bad and "" in bad
    paths = [str(tmp_path / n) for n in ("e", "a", "c2")]
    jobs.score_transactions(feeds.text_feed(spark, str(source)), *paths).awaitTermination()
    assert rows(spark.read.parquet(paths[0]), "txn_id") == [("t0000",)]


def test_daily_windows_close_once(spark, tmp_path, rows):
    day, source = 86_400, tmp_path / "in"
    feed_file(source, 0, [txn(0, "u", 10, 10.0), txn(1, "u", 20, 20.0), txn(2, "v", 30, 1.0)])
    feed_file(source, 1, [txn(3, "u", day + 3, 5.0), txn(4, "u", day - 1, 30.0)])  # not late: 5 s are allowed
    feed_file(source, 2, [txn(5, "u", day + 60, 7.0)])  # closes the first day
    feed_file(source, 3, [txn(6, "u", day + 70, 1.0)])  # late rows are judged by the batch before
    feed_file(source, 4, [txn(7, "u", 40, 99.0), txn(8, "u", 2 * day + 60, 1.0)])  # the first row is too late
    out = str(tmp_path / "spend")
    job = jobs.roll_up_spend(feeds.text_feed(spark, str(source), max_files=1), out, str(tmp_path / "c"))
    job.awaitTermination()
    spend = spark.read.parquet(out).select("user_id", F.to_date("window_start").cast("string"), "txn_count", "total_spend", "avg_spend")
    assert rows(spend) == [
        ("u", "2024-03-01", 3, 60.0, 20.0),
        ("u", "2024-03-02", 3, 13.0, 4.33),
        ("v", "2024-03-01", 1, 1.0, 1.0),
    ]


def test_window_of_missing_amount(spark, rows):
    df = spark.createDataFrame([("u", START, 50.0), ("u", START, None)], "user_id string, timestamp timestamp, amount double")
    assert rows(spend_windows(df), "txn_count", "total_spend", "avg_spend") == [(2, 50.0, 25.0)]


def test_state_timeout_is_optional(spark):
    schema = "user_id string, txn_id string, timestamp timestamp, amount double"
    stream = spark.readStream.format("rate").load().selectExpr(
        "'u' as user_id", "cast(value as string) as txn_id", "timestamp", "cast(value as double) as amount"
    )
    columns = ["user_id", "txn_id", "timestamp", "amount", "user_txn_count", "user_running_mean", "z_score", "is_anomaly"]
    assert score_stream(stream).columns == columns
    assert score_stream(stream, ttl_ms=60_000).columns == columns
    assert daily_spend(stream).isStreaming and schema


def test_decoders(spark, rows):
    text = [
        '{"user_id": "user_000001", "window_start": 1709251200000, "window_end": 1709337600000, "txn_count": 5, '
        '"total_spend": 250.5, "avg_spend": 50.1}',
        "not valid json",
        "",
    ]
    good, bad = codecs.decode_daily(spark.createDataFrame([(t,) for t in text], "value string"))
    bounds = [F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")]
    assert rows(good, *bounds, "total_spend") == [(START, dt.datetime(2024, 3, 2), 250.5)]
    assert bad.count() == 2

    texts = [json.dumps(t) for t in (
        {"txn_id": "a", "timestamp": "2024-03-01T00:00:00+00:00", "z_score": 1.5},
        {"txn_id": "b", "timestamp": "not-a-date"},
        {"txn_id": "c", "timestamp": 1709251200},
        {"txn_id": "d"},
    )]
    good, bad = codecs.decode_enriched(spark.createDataFrame([(t,) for t in texts], "value string"))
    assert rows(good, "txn_id", F.col("timestamp").cast("timestamp_ntz")) == [("a", START), ("c", START), ("d", None)]
    assert bad.count() == 1


def test_json_keeps_nulls(spark, rows):
    df = spark.createDataFrame([("u", None, 1.5)], "user_id string, note string, amount double")
    assert rows(codecs.encode_json(df)) == [("u", '{"user_id":"u","note":null,"amount":1.5}')]


def test_topics_are_stored_apart_without_repeats(spark, tmp_path, rows):
    records = [{"txn_id": f"t{i}", "timestamp": f"2024-03-0{1 + i % 3}T00:00:00+00:00", "z_score": 1.0} for i in range(6)]
    data = [("all", json.dumps(r)) for r in records + records[:2]] + [("flagged", json.dumps(records[0])), ("all", "{}")]
    source = str(tmp_path / "feed")
    spark.createDataFrame(data, "topic string, value string").write.parquet(source)
    schema = spark.read.parquet(source).schema
    routes = {t: str(tmp_path / t) for t in ("all", "flagged")}
    for run in range(2):  # the second run delivers everything again
        feed = feeds.parquet_feed(spark, source, schema)
        jobs.store_scored(feed, routes, str(tmp_path / f"c{run}")).awaitTermination()
    assert [r[0] for r in rows(stores.read_by_day(spark, routes["all"]), "txn_id")] == [f"t{i}" for i in range(6)]
    assert rows(stores.read_by_day(spark, routes["flagged"]), "txn_id") == [("t0",)]


def test_daily_sink_takes_the_later_record(spark, tmp_path, rows):
    source = tmp_path / "in"
    base = {"user_id": "u", "window_start": 1709251200000, "window_end": 1709337600000, "txn_count": 1, "total_spend": 5.0}
    feed_file(source, 0, [base, {**base, "user_id": None}, {"user_id": "w"}])
    feed_file(source, 1, [{**base, "txn_count": 2}, {**base, "txn_count": 3, "total_spend": None}])
    out = str(tmp_path / "table")
    jobs.store_daily(feeds.text_feed(spark, str(source), max_files=1), out, str(tmp_path / "c")).awaitTermination()
    assert rows(stores.read_by_day(spark, out), "user_id", "txn_count", "total_spend") == [("u", 3, 5.0)]


def test_kafka_feed_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        feeds.kafka_feed(spark, ["a", "b"], "localhost:1", group="g")
