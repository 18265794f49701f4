"""The gate before the watermark, and the fan-out behind it: bad texts, impossible times, late rows, crashes."""

import json

import pytest
from pyspark.sql import functions as F
from test_streaming import START, feed_file, ordered_records, txn

from tillstream.operators.running import running_zscore
from tillstream.sources import codecs
from tillstream.streaming import fanout, feeds, gate, jobs

DAY = 86_400


def run_gate(spark, source, root, **options):
    feed = feeds.text_feed(spark, str(source), max_files=1)
    gate.clean_transactions(feed, str(root), f"{root}/checkpoint", **options).awaitTermination()


def clean_feed(spark, root):
    schema = spark.read.parquet(f"{root}/clean").drop("batch_id").schema
    return feeds.parquet_feed(spark, f"{root}/clean", schema, max_files=None)


def millis(record):
    """The same record with its time in milliseconds."""
    seconds = codecs_time(record["timestamp"])
    return {**record, "timestamp": seconds * 1000}


def codecs_time(text):
    import datetime as dt

    return int(dt.datetime.fromisoformat(text).timestamp())


def test_every_text_is_clean_or_quarantined(spark, tmp_path, rows):
    source, root = tmp_path / "in", tmp_path / "gate"
    good = [txn(i, "u", i * 60, 5.0) for i in range(30)]
    bad = ["not valid json", "", txn(90, None, 1, 5.0), millis(txn(91, "u", 5, 1.0)), {**txn(92, "u", 5, 1.0), "timestamp": "+56135-02-26T00:00:00Z"}]
    feed_file(source, 0, good[:20] + bad[:3])
    feed_file(source, 1, good[20:] + bad[3:])
    run_gate(spark, source, root)
    assert len(rows(gate.written(spark, root, "clean"), "txn_id")) + gate.written(spark, root, "quarantine").count() == 35
    reasons = rows(gate.written(spark, root, "quarantine").groupBy("reason").count())
    assert dict(reasons)["impossible time"] >= 1 and sum(n for _r, n in reasons) >= 4
    kept = {r[0] for r in rows(gate.written(spark, root, "clean"), "txn_id")}
    assert {r["txn_id"] for r in good} <= kept and "t0091" not in kept


def test_windows_close_after_an_impossible_time(spark, tmp_path, rows):
    """One time in milliseconds used to close every window for good."""

    def windows(name, with_bad_row):
        source, root = tmp_path / f"{name}-in", tmp_path / name
        first = [txn(1, "u", 10, 10.0), txn(2, "u", DAY + 10, 20.0)]
        feed_file(source, 0, first + ([millis(txn(3, "u", 20, 1.0))] if with_bad_row else []))
        for number, day in enumerate((4, 8, 19), start=1):
            feed_file(source, number, [txn(10 + number, "u", day * DAY, 5.0)])
        run_gate(spark, source, root)
        out = str(tmp_path / f"{name}-spend")
        job = jobs.roll_up_clean(clean_feed(spark, root), out, f"{out}-checkpoint")
        job.awaitTermination()
        return rows(spark.read.parquet(out), "window_start", "txn_count", "total_spend")

    expected = windows("clean", False)
    assert len(expected) == 4 and windows("dirty", True) == expected


def test_a_lone_impossible_time_is_judged_by_the_times_before(spark, tmp_path, rows):
    source, root = tmp_path / "in", tmp_path / "gate"
    feed_file(source, 0, [txn(i, "u", i, 1.0) for i in range(5)])
    feed_file(source, 1, [millis(txn(9, "u", 60, 1.0))])
    feed_file(source, 2, [txn(10, "u", 120, 1.0)])
    run_gate(spark, source, root)
    assert rows(gate.written(spark, root, "quarantine"), "reason") == [("impossible time",)]
    assert ("t0010",) in rows(gate.written(spark, root, "clean"), "txn_id")


def test_a_real_jump_of_the_clock_is_accepted_when_it_is_the_majority(spark, tmp_path, rows):
    source, root = tmp_path / "in", tmp_path / "gate"
    feed_file(source, 0, [txn(i, "u", i, 1.0) for i in range(4)])
    for number in range(1, 8):
        feed_file(source, number, [txn(100 + number, "u", 60 * DAY + number, 1.0)])
    run_gate(spark, source, root)
    kept = {r[0] for r in rows(gate.written(spark, root, "clean"), "txn_id")}
    assert {"t0105", "t0106", "t0107"} <= kept


def test_late_rows_are_kept_apart_and_change_no_window(spark, tmp_path, rows):
    source, root = tmp_path / "in", tmp_path / "gate"
    feed_file(source, 0, [txn(0, "u", 10, 10.0), txn(1, "u", DAY + 60, 20.0)])
    feed_file(source, 1, [txn(2, "u", 20, 99.0), txn(3, "u", DAY + 70, 1.0)])  # the first day is over
    feed_file(source, 2, [txn(4, "u", 30, 99.0), txn(5, "u", 2 * DAY + 60, 1.0)])
    feed_file(source, 3, [txn(6, "u", 3 * DAY + 60, 1.0)])
    run_gate(spark, source, root)
    assert rows(gate.written(spark, root, "late"), "txn_id", "batch_id") == [("t0002", 1), ("t0004", 2)]
    out = str(tmp_path / "spend")
    jobs.roll_up_clean(clean_feed(spark, root), out, f"{out}-checkpoint").awaitTermination()
    assert [r[1:] for r in rows(spark.read.parquet(out), "window_start", "txn_count", "total_spend")] == [(1, 10.0), (2, 21.0), (1, 1.0)]


def test_a_table_is_split_by_its_own_times(spark, rows):
    texts = [json.dumps(txn(i, "u", i, 1.0)) for i in range(10)] + [json.dumps(millis(txn(11, "u", 1, 1.0)))]
    parsed, _ = codecs.parse_transactions(spark.createDataFrame([(t,) for t in texts], "value string"))
    good, bad = gate.split_by_time(parsed)
    assert good.count() == 10 and rows(bad, "txn_id") == [("t0011",)]
    nothing = gate.split_by_time(parsed.limit(0))
    assert [df.count() for df in nothing] == [0, 0]
    untimed = parsed.withColumn("timestamp", F.lit(None).cast("timestamp"))
    assert [df.count() for df in gate.split_by_time(untimed)] == [11, 0]


def test_folders_are_written_once(spark, tmp_path, rows):
    path = str(tmp_path / "out")
    assert gate.write_once(spark.range(3), path, 0) and not gate.write_once(spark.range(9), path, 0)
    spark.range(5).write.parquet(f"{path}/_pending/batch_id=1")  # left by a crash
    assert spark.read.parquet(path).count() == 3
    assert gate.write_once(spark.range(4), path, 1) and spark.read.parquet(path).count() == 7


def fan_out_run(spark, tmp_path, name, records, failing=None):
    source, root = tmp_path / f"{name}-in", tmp_path / name
    for number in range(3):
        feed_file(source, number, records[number * 80 : (number + 1) * 80])
    run_gate(spark, source, root)
    out, seen = f"{root}/topics", []
    sink = fanout.folder_sink(out)

    def send(batch, topic, batch_id):
        if failing == (topic, len(seen)) and not any(s == "crash" for s in seen):
            seen.append("crash")
            raise RuntimeError("crash between two topics")
        seen.append(topic)
        sink(batch, topic, batch_id)

    schema = spark.read.parquet(f"{root}/clean").drop("batch_id").schema
    for _attempt in range(2):
        feed = feeds.parquet_feed(spark, f"{root}/clean", schema, max_files=1)
        job = fanout.fan_out(feed, send, f"{root}/fan-checkpoint")
        try:
            job.awaitTermination()
        except Exception as error:
            assert "crash between two topics" in str(error)
    return {t: rows_of(spark, f"{out}/{t}") for t in fanout.TOPICS}, seen


def rows_of(spark, path):
    return sorted((r["key"], r["value"]) for r in spark.read.parquet(path).select("key", "value").collect())


def test_fan_out_of_three_topics_survives_a_crash_between_two(spark, tmp_path, rows):
    records = ordered_records()
    whole, _ = fan_out_run(spark, tmp_path, "whole", records)
    broken, seen = fan_out_run(spark, tmp_path, "broken", records, (fanout.ANOMALIES, 4))
    assert "crash" in seen and broken == whole

    text = spark.createDataFrame([(json.dumps(r),) for r in records], "value string")
    batch = running_zscore(codecs.parse_transactions(text)[0])
    found = spark.createDataFrame([(v,) for _k, v in whole[fanout.ENRICHED]], "value string")
    scores = ["txn_id", "user_txn_count", "user_running_mean", "z_score", "is_anomaly"]
    assert rows(codecs.decode_enriched(found)[0], *scores) == rows(batch, *scores)
    assert [json.loads(v)["txn_id"] for _k, v in sorted(whole[fanout.ANOMALIES], key=lambda r: json.loads(r[1])["txn_id"])] == [
        r[0] for r in rows(batch.where("is_anomaly"), "txn_id")
    ]
    flagged = json.loads(whole[fanout.ANOMALIES][0][1])
    assert "location" not in flagged and "status" not in flagged and flagged["z_score"] > 3
    daily = spark.createDataFrame([(v,) for _k, v in whole[fanout.DAILY]], "value string")
    spend = codecs.decode_daily(daily)[0].groupBy("window_start").agg(F.sum("txn_count").alias("n"))
    assert rows(spend)[0] == (START, 96) and all(k == json.loads(v)["user_id"] for k, v in whole[fanout.DAILY])


def test_sinks_keep_bad_texts(spark, tmp_path, rows):
    source, bad = tmp_path / "in", str(tmp_path / "bad")
    base = {"user_id": "u", "window_start": 1709251200000, "window_end": 1709337600000, "txn_count": 1, "total_spend": 5.0}
    feed_file(source, 0, [base, "not valid json", ""])
    feed = feeds.text_feed(spark, str(source))
    jobs.store_daily(feed, str(tmp_path / "t"), str(tmp_path / "c"), quarantine_path=bad).awaitTermination()
    assert [r[0] for r in rows(spark.read.parquet(bad), "value")] == ["", "not valid json"]

    texts = [("all", json.dumps({"txn_id": f"t{i}", "timestamp": f"2024-03-01T00:00:{i:02d}+00:00"})) for i in range(20)]
    texts += [("all", "not valid json"), ("flagged", json.dumps({"txn_id": "x", "timestamp": 1709251200000}))]
    texts += [("flagged", json.dumps({"txn_id": f"y{i}", "timestamp": 1709251200 + i})) for i in range(20)]
    topics = str(tmp_path / "topics")
    spark.createDataFrame(texts, "topic string, value string").write.parquet(topics)
    feed = feeds.parquet_feed(spark, topics, spark.read.parquet(topics).schema)
    routes, bad = {t: str(tmp_path / t) for t in ("all", "flagged")}, str(tmp_path / "bad-topics")
    jobs.store_scored(feed, routes, str(tmp_path / "c2"), quarantine_path=bad).awaitTermination()
    assert rows(spark.read.parquet(bad), "topic", "reason") == [("all", "unreadable"), ("flagged", "impossible time")]
    assert [spark.read.parquet(p).count() for p in routes.values()] == [20, 20]


@pytest.mark.parametrize("size", [1, 7])
def test_sources_see_only_whole_folders(spark, tmp_path, size):
    """A pending folder is hidden from readers and from streams."""
    path = str(tmp_path / "out")
    spark.range(size).write.parquet(f"{path}/_pending/batch_id=0")
    gate.write_once(spark.range(2), path, 1)
    out = str(tmp_path / "copy")
    jobs.write_batches(feeds.parquet_feed(spark, path, spark.range(1).schema), out, f"{out}-c").awaitTermination()
    assert spark.read.parquet(out).count() == 2
