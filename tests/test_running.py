"""Running statistics: plain and sliced forms, the streaming arithmetic, and the order operators."""

import datetime as dt
import math
import random
import statistics

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from tillstream.operators.ordered import sorted_slices, with_neighbour
from tillstream.operators.running import running_zscore
from tillstream.streaming.scoring import running_scores

AMOUNTS = st.lists(st.integers(0, 1_500_000).map(lambda c: c / 100), min_size=1, max_size=60)


def scored(values, moments=(0, 0.0, 0.0)):
    return running_scores(np.array(values, dtype="float64"), *moments, 3.0)


@pytest.mark.parametrize(
    "values, n, mean, sd",
    [([100], 1, 100, 0), ([50, 50], 2, 50, 0), ([100, 200], 2, 150, 70.7107), ([10, 20, 30, 40, 50], 5, 30, 15.811)],
)
def test_known_moments(values, n, mean, sd):
    *_, (count, average, m2) = scored(values)
    assert (count, average) == (n, mean)
    assert math.sqrt(m2 / max(n - 1, 1)) == pytest.approx(sd, abs=1e-3)


@given(AMOUNTS)
def test_moments_match_statistics(values):
    *_, (n, mean, m2) = scored(values)
    assert mean == pytest.approx(statistics.fmean(values), rel=1e-10)
    if n > 1:
        assert m2 / (n - 1) == pytest.approx(statistics.variance(values), rel=1e-8, abs=1e-8)


@given(AMOUNTS, st.integers(0, 60))
def test_moments_continue_over_batches(values, cut):
    whole = scored(values)
    moments, parts = (0, 0.0, 0.0), []
    for part in (values[:cut], values[cut:]):
        if part:
            n, mean, z, flag, moments = scored(part, moments)
            parts.append((n, z))
    assert np.concatenate([p[0] for p in parts]).tolist() == whole[0].tolist()
    assert np.allclose(np.concatenate([p[1] for p in parts]), whole[2], atol=2e-4)


@given(AMOUNTS)
@settings(max_examples=200)
def test_score_bound(values):
    """A row counts in its own mean, so |z| stays below (n - 1) / sqrt(n)."""
    n, _, z, flag, _ = scored(values)
    assert (np.abs(z) <= (n - 1) / np.sqrt(n) + 1e-4).all()
    assert not flag[:10].any()


def test_first_possible_flag():
    assert scored([5.0] * 9 + [50.0])[3].tolist() == [False] * 10
    assert scored([5.0] * 10 + [50.0])[3].tolist() == [False] * 10 + [True]


def skewed_rows(n=900):
    """One user holds most rows, one holds NULL as its id, some times and all of a user's repeat."""
    rng = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        user = "hot" if rng.random() < 0.6 else rng.choice(["a", "b", "c", None])
        seconds = 0 if user == "c" else rng.randrange(400)
        amount = None if rng.random() < 0.05 else rng.randrange(100, 100_000) / 100
        rows.append((f"t{i:05d}", user, start + dt.timedelta(seconds=seconds), amount))
    return rows


SCHEMA = "txn_id string, user_id string, timestamp timestamp_ntz, amount double"
SCORES = ["txn_id", "user_txn_count", "user_running_mean", "z_score", "is_anomaly"]


def expected_scores(rows):
    out = {}
    for user in {r[1] for r in rows}:
        mine = sorted((r for r in rows if r[1] == user), key=lambda r: (r[2], r[0]))
        n, mean, z, flag, _ = scored([r[3] or 0.0 for r in mine])
        out.update({r[0]: (int(n[i]), mean[i], z[i], bool(flag[i])) for i, r in enumerate(mine)})
    return out


@pytest.mark.parametrize("hot_rows", [10**9, 200, 0])
def test_forms_agree(spark, hot_rows):
    """No hot key, one hot key beside cold ones, all keys hot."""
    rows = skewed_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {r[0]: tuple(r)[1:] for r in running_zscore(df, hot_rows=hot_rows, slices=7).select(*SCORES).collect()}
    want = expected_scores(rows)
    assert got.keys() == want.keys() and len(got) == len(rows)
    for txn, (n, mean, z, flag) in want.items():
        assert got[txn][0] == n and got[txn][3] == flag
        assert got[txn][1] == pytest.approx(mean, abs=1e-9) and got[txn][2] == pytest.approx(z, abs=1e-9)


def test_copies_are_spread_and_counted(spark):
    """Most rows are copies of one event; each copy is scored, and they do not share one slice."""
    stamp = dt.datetime(2024, 1, 1)
    rows = [("a", "u", stamp, 10.0)] * 20 + [("b", "u", stamp, 30.0)] * 400 + [("c", "u", stamp, 10.0)] * 20
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    n, mean, z, flag, _ = scored([r[3] for r in rows])
    out = running_zscore(df, hot_rows=50, slices=8).select(*SCORES).collect()
    got = sorted((r.user_txn_count, r.txn_id, r.user_running_mean, r.z_score, r.is_anomaly) for r in out)
    assert [g[:2] for g in got] == [(i + 1, r[0]) for i, r in enumerate(rows)]
    assert np.allclose([g[2] for g in got], mean) and np.allclose([g[3] for g in got], z, atol=1e-9)
    assert [g[4] for g in got] == flag.tolist()
    numbered = df.withColumn("_row", F.monotonically_increasing_id())
    per_slice = sorted_slices(numbered, ["user_id", "timestamp", "txn_id", "_row"], 8).groupBy("_slice").count()
    assert max(r["count"] for r in per_slice.collect()) < 200


def test_rows_without_a_key_are_one_key(spark):
    """A NULL key that spans many slices goes on counting in each."""
    start = dt.datetime(2024, 1, 1)
    rows = [(f"t{i:04d}", None, start + dt.timedelta(minutes=i), float(i % 17)) for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    n, mean, z, flag, _ = scored([r[3] for r in rows])
    out = running_zscore(df, hot_rows=50, slices=8).orderBy("txn_id").select(*SCORES).collect()
    assert [r.user_txn_count for r in out] == list(range(1, 401))
    assert np.allclose([r.user_running_mean for r in out], mean) and np.allclose([r.z_score for r in out], z, atol=1e-9)


@pytest.mark.parametrize("offset", [1, -1])
@pytest.mark.parametrize("within", [["g"], []])
def test_neighbours(spark, offset, within):
    rng = random.Random(5)
    data = [(rng.choice([0, 0, 0, 1, None]), i) for i in range(60)]
    df = spark.createDataFrame(data, "g int, v int").repartition(5)
    order = [*within, "v"]
    ordered = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, r[1]) if within else r[1])
    expected = {}
    for k, (g, v) in enumerate(ordered):
        other = ordered[k + offset] if 0 <= k + offset < len(ordered) else None
        expected[v] = other[1] if other and (not within or other[0] == g) else None
    for slices in (None, 1, 6, 50):
        out = with_neighbour(df, order, offset, "near", within, slices=slices)
        assert {r.v: r.near and r.near.v for r in out.collect()} == expected
        assert out.columns == ["g", "v", "near"]
    assert with_neighbour(df.limit(0), order, offset, "near", within).collect() == []
    with pytest.raises(ValueError):
        with_neighbour(df, ["v"], 2, "near")
    with pytest.raises(ValueError):
        with_neighbour(df, ["v", "g"], 1, "near", ["g"])


def test_neighbours_over_many_batches_in_one_plan(spark):
    """No row is counted beforehand, nothing meets in one task, and both reads share one exchange."""
    n = 5000
    df = spark.range(n).select((F.col("id") * 7919 % n).alias("v"), F.lit("x").alias("extra"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")
    try:
        out = with_neighbour(df, ["v"], -1, "near", slices=5)
        found = {r.v: r.near and r.near.v for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found == {v: v - 1 if v else None for v in range(n)}
    plan = out._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan and "Window" not in plan
    executed = out._jdf.queryExecution().executedPlan().toString()
    assert executed.count("ReusedExchange") >= 1 and "rangepartitioning" in executed
