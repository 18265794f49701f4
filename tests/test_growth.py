"""What may not grow with the input: slices, state calls, rows of a task."""

import datetime as dt
import json
import threading

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F
from test_streaming import SCORES, feed_file, txn

from tillstream.operators import ordered
from tillstream.operators.running import running_zscore
from tillstream.plans import build, staging
from tillstream.queries import streams
from tillstream.sources import codecs, datasets
from tillstream.streaming import feeds, jobs, recovery, scoring


def test_slices_are_bounded_for_small_hot_rows(spark):
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert ordered.slices_for(spark, 15_000, 1000) == 15
    assert ordered.slices_for(spark, 3_000_000, 500) == ordered.SLICES_PER_PARTITION * usual
    assert ordered.slices_for(spark, 60_000_000, 500) == 60
    assert ordered.slices_for(spark, 60_000_000, 20_000_000) == usual


def events_file(path, n=40):
    start = dt.datetime(2024, 1, 1)
    rows = {
        "event_id": list(range(n)),
        "ts": [start + dt.timedelta(hours=17 * i) for i in range(n)],
        "user_id": [i % 5 for i in range(n)],
        "event_type": ["view"] * n,
        "value": [float(i) for i in range(n)],
        "props": ['{"k": 3}'] * n,
    }
    pq.write_table(pa.table(rows), path / "events.parquet")
    return str(path)


def test_a_larger_file_goes_to_more_partitions(spark, tmp_path, monkeypatch):
    sf = events_file(tmp_path)
    cores = spark.sparkContext.defaultParallelism
    assert datasets.live_transactions(spark, sf).rdd.getNumPartitions() == cores
    monkeypatch.setattr(datasets, "file_bytes", lambda *_: 1 << 30, raising=False)
    assert datasets.live_transactions(spark, sf).rdd.getNumPartitions() > 4 * cores


def test_slices_of_one_file_are_made_by_all_cores(spark, tmp_path):
    made = streams.arrivals(spark, events_file(tmp_path))
    assert made.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert {r[0] for r in made.select("arrival").distinct().collect()} == {0, 1, 2}


def test_a_text_is_parsed_once_for_both_sides(spark, rows):
    good = [json.dumps(txn(i, "u" if i else None, i * 60, 5.0)) for i in range(4)]
    texts = spark.createDataFrame([(t,) for t in [*good, "not json", "", None]], "value string")
    read = codecs.read_transactions(texts)
    usable, bad = codecs.parse_transactions(texts, keep_text=True)
    assert rows(read.where("usable").drop("usable")) == rows(usable)
    assert rows(read.where("not usable"), "value") == rows(bad)


def test_calls_of_the_state_function_are_bounded(spark, tmp_path, rows, monkeypatch):
    """Many users, few groups: every user keeps moments of their own, over micro-batches and a restart."""
    monkeypatch.setattr(scoring, "BUCKETS", 4, raising=False)
    records = [txn(i, f"user_{i * 7 % 60:06d}", (i // 2) * 900, 5.0 + i % 13) for i in range(360)]
    source, paths = tmp_path / "in", [str(tmp_path / n) for n in ("e", "a", "c")]
    for number in range(3):
        feed_file(source, number, records[number * 120 : (number + 1) * 120])
        jobs.score_transactions(feeds.text_feed(spark, str(source), max_files=1), *paths).awaitTermination()
    text = spark.createDataFrame([(json.dumps(r),) for r in records], "value string")
    batch = codecs.parse_transactions(text)[0]
    assert rows(spark.read.parquet(paths[0]), *SCORES) == rows(running_zscore(batch), *SCORES)
    assert spark.read.format("statestore").load(paths[2]).count() <= 4
    held = recovery.stored_moments(spark, paths[2]).select("user_id", "n", F.round("mean", 6).alias("mean"))
    want = batch.groupBy("user_id").agg(F.count("*").alias("n"), F.round(F.avg("amount"), 6).alias("mean"))
    assert rows(held) == rows(want)


def items_file(path, n=60):
    """Every id three times, on later and later days; one time the last two are equal but for the price."""
    day = dt.datetime(1999, 5, 1)
    rows = {
        "l_orderkey": [i // 6 for i in range(n)],
        "l_partkey": [7] * n,
        "l_suppkey": [3] * n,
        "l_linenumber": pa.array([i % 2 for i in range(n)], pa.int32()),
        "l_quantity": [2.0] * n,
        "l_extendedprice": [10.0 + i for i in range(n)],
        "l_discount": [0.05] * n,
        "l_tax": [0.01] * n,
        "l_returnflag": ["N"] * n,
        "l_linestatus": ["F"] * n,
        "l_shipdate": [day + dt.timedelta(days=0 if i < 6 else i) for i in range(n)],
    }
    pq.write_table(pa.table(rows), path / "lineitem.parquet")
    return str(path)


def test_history_is_shuffled_once_for_its_latest_rows(spark, tmp_path, rows):
    raw = datasets.raw_history(spark, items_file(tmp_path))
    latest = staging.stg_transactions(raw, datasets.HISTORY_TIEBREAK)
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1
    assert plan.count("Sort ") == 1
    want = [(f"{i // 6}-{i % 2}", 10.0 + i) for i in range(60) if i % 6 >= 4]
    assert rows(latest, "txn_id", "amount") == sorted(want, key=repr)


def test_models_that_do_not_read_each_other_are_written_together(spark, tmp_path, monkeypatch):
    """Each write waits until all of its group have begun."""
    groups = [{"stg_transactions", "stg_anomalies"}, {"fct_daily_revenue", "dim_merchants", "fct_merchant_rollup", "fct_anomaly_summary"}]
    meet = {name: barrier for g in groups for barrier in [threading.Barrier(len(g))] for name in g}
    write = build.materialize

    def met(df, name, path):
        meet[name].wait(timeout=60)
        return write(df, name, path)

    monkeypatch.setattr(build, "materialize", met)
    raw = datasets.raw_history(spark, items_file(tmp_path))
    flagged = raw.where("txn_id < '3'")
    models = build.build_models(raw, flagged, str(tmp_path / "models"), datasets.HISTORY_AS_OF, datasets.HISTORY_TIEBREAK)
    assert set(models) == set(build.NOT_NULL)
    assert models["stg_transactions"].count() == 20 and models["stg_anomalies"].count() == 6
    assert spark.table("dim_merchants").first()["lifetime_txn_count"] == 20
    results = build.check_models(models).collect()
    assert len(results) == 24 and {r["status"] for r in results} == {"pass"}
