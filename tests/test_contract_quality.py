"""The transaction contract and the hourly checks."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tillstream.operators import quality
from tillstream.operators.contract import contract_failures, json_failures, json_violations, violations
from tillstream.plans import serving
from tillstream.schemas import TRANSACTION_CONTRACT, TRANSACTION_JSON

VALID = {
    "txn_id": "aabbccdd11223344aabbccdd",
    "user_id": "user_000001",
    "amount": 49.99,
    "currency": "CAD",
    "timestamp": "2026-03-01T12:00:00+00:00",
    "merchant_id": "merchant_0001",
    "merchant_category": "grocery",
    "payment_method": "credit_card",
    "status": "approved",
    "location": {"lat": 43.65, "lon": -79.38},
}

CASES = [
    ({}, []),
    ({"amount": 0.01}, []),
    ({"amount": 15000}, []),
    ({"amount": 15000.01}, ["amount: above maximum"]),
    ({"amount": 0}, ["amount: below minimum"]),
    ({"amount": "49.99"}, ["amount: type"]),
    ({"amount": None}, ["amount: type"]),
    ({"txn_id": "ABC"}, ["txn_id: pattern"]),
    ({"user_id": "user_1"}, ["user_id: pattern"]),
    ({"user_id": 1}, ["user_id: type"]),
    ({"currency": "JPY"}, ["currency: value"]),
    ({"status": "unknown", "payment_method": "cash"}, ["payment_method: value", "status: value"]),
    ({"timestamp": "yesterday"}, ["timestamp: format"]),
    ({"location": {"lat": 91, "lon": 0}}, ["location.lat: above maximum"]),
    ({"location": {"lat": 1}}, ["location.lon: missing"]),
    ({"location": "here"}, ["location: type"]),
    ({"location": {"lat": 1, "lon": 1, "alt": 2}}, ["location.alt: unexpected"]),
    ({"note": "x", "extra": 1}, ["extra,note: unexpected"]),
]


def test_json_contract(spark):
    texts = [json.dumps({**VALID, **change}) for change, _ in CASES]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = dict(df.select("i", json_violations("t", TRANSACTION_CONTRACT)).collect())
    for i, (change, expected) in enumerate(CASES):
        assert sorted(found[i]) == sorted(expected), change


@pytest.mark.parametrize("text", ["not json", "", None, "[1]", "null", "5"])
def test_json_that_is_no_object(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(json_violations("t", TRANSACTION_CONTRACT)).first()[0] == ["malformed"]


def test_missing_fields(spark):
    texts = [json.dumps({k: v for k, v in VALID.items() if k != name}) for name in VALID] + ["{}"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = dict(df.select("i", json_violations("t", TRANSACTION_CONTRACT)).collect())
    for i, name in enumerate(VALID):
        assert found[i] == [f"{name}: missing"]
    assert found[len(VALID)] == [f"{name}: missing" for name in VALID]


def test_column_contract(spark, rows):
    good, bad = dict(VALID), {**VALID, "txn_id": "x", "amount": None, "location": {"lat": 1.0, "lon": 300.0}}
    df = spark.createDataFrame([good, bad], TRANSACTION_JSON)
    failing = contract_failures(df, TRANSACTION_CONTRACT, "txn_id").collect()
    assert [(r.txn_id, sorted(r.violations)) for r in failing] == [
        ("x", ["amount: missing", "location.lon: above maximum", "txn_id: pattern"])
    ]
    odd = df.drop("status").withColumn("amount", F.lit("1")).withColumn("z_score", F.lit(1.0))
    texts = odd.limit(1).select(violations(odd, TRANSACTION_CONTRACT)).first()[0]
    assert sorted(texts) == ["amount: type", "status: missing", "z_score: unexpected"]
    assert "z_score: unexpected" not in odd.limit(1).select(violations(odd, TRANSACTION_CONTRACT, ["z_score"])).first()[0]


NOW = "2026-03-01 12:30:00"


def stored(spark, changes, minutes=None):
    rows = []
    for i, change in enumerate(changes):
        age = minutes[i] if minutes else 5
        stamp = dt.datetime(2026, 3, 1, 12, 30) - dt.timedelta(minutes=age)
        rows.append({**VALID, "txn_id": f"{i:024x}", "timestamp": stamp, **change})
    schema = TRANSACTION_JSON.simpleString().removeprefix("struct<").removesuffix(">").replace("timestamp:string", "timestamp:timestamp_ntz")
    return spark.createDataFrame([tuple(r[f.name] for f in TRANSACTION_JSON.fields) for r in rows], schema)


def report(df):
    return {r.check_name: (r.failures, r.status) for r in quality.quality_report(df, NOW).collect()}


def test_all_checks_pass(spark):
    df = stored(spark, [{}] * 9 + [{"status": "declined"}] + [{}] * 14, [5] + [60 * i + 10 for i in range(23)])
    df = df.unionAll(stored(spark, [{"txn_id": "f" * 24, "status": "declined"}], [30]))
    found = report(df)
    assert found["staleness"] == (0, "pass") and found["volume"] == (0, "pass")
    assert {n: s for n, (_, s) in found.items()} == dict.fromkeys(found, "pass")
    assert len(found) == 8


def test_checks_find_their_faults(spark, rows):
    df = stored(
        spark,
        [{}, {"amount": -5.0}, {"amount": 60_000.0}, {"amount": 0.001}, {"currency": None}, {"status": ""}, {"txn_id": "0" * 24}],
    )
    found = report(df)
    assert found["duplicates"] == (1, "fail")
    assert found["amount_outliers"] == (3, "fail")
    assert found["null_fields"] == (2, "fail")
    assert found["accepted_values"] == (2, "fail")
    assert found["schema_violations"] == (5, "fail")
    assert found["volume"] == (1, "fail") and found["status_drift"] == (1, "fail")
    assert rows(quality.null_fields(df, NOW)) == [("currency", 1), ("status", 1)]
    assert rows(quality.unexpected_values(df, NOW)) == [("currency", None, 1), ("status", "", 1)]
    assert quality.amount_outliers(df, NOW).first() == (1, 1, 1)
    assert quality.status_drift(df, NOW).first().status == "invalid_status"
    assert rows(quality.top_duplicates(quality.duplicate_ids(df, NOW))) == [("0" * 24, 2)]


def test_volume(spark):
    spike = stored(spark, [{}] * 30, [5] * 20 + [100] * 10)
    drop = stored(spark, [{}] * 480, [5] * 2 + [600] * 478)
    even = stored(spark, [{}] * 24, [60 * i + 10 for i in range(24)])
    assert [quality.volume(df, NOW).first().status for df in (spike, drop, even, even.limit(0))] == ["spike", "drop", "pass", "skip"]


def test_stale_and_empty(spark):
    old = stored(spark, [{}], [16])
    assert quality.staleness(old, NOW).first().status == "stale"
    assert quality.staleness(stored(spark, [{}], [14]), NOW).first().status == "pass"
    empty = report(old.limit(0))
    assert empty["staleness"] == (1, "fail")
    assert {n for n, (_, s) in empty.items() if s == "skip"} == {"schema_violations", "volume", "status_drift"}


def test_drift(spark):
    shares = [quality.status_drift(stored(spark, [{"status": "declined"}] * d + [{}] * (20 - d)), NOW).first() for d in (0, 2, 5)]
    assert [s.status for s in shares] == ["drift", "pass", "drift"]


def test_missing_column_is_null(spark, rows):
    df = stored(spark, [{}]).drop("merchant_id")
    assert rows(quality.null_fields(df, NOW)) == [("merchant_id", 1)]


# ---- serving -------------------------------------------------------------------------------


def test_bounds(spark):
    df = stored(spark, [{}])
    for days, limit in ((0, 10), (366, 10), (30, 0), (30, 51)):
        with pytest.raises(ValueError):
            serving.top_merchants(df, NOW, days, limit)
    with pytest.raises(ValueError):
        serving.anomalies(df, NOW, days=91)
    with pytest.raises(ValueError):
        serving.recent_user_transactions(df, 101)


def test_unknown_user_gets_zeros(spark):
    parts = serving.user_trends(stored(spark, [{}]), "user_999999", NOW)
    assert tuple(parts["stats"].first()) == (0, 0.0, 0.0, [])
    assert parts["top_categories"].count() == 0 and parts["recent_transactions"].count() == 0
    row = serving.user_trends_row(stored(spark, [{}, {"amount": 1.0}]), "user_000001", NOW).first()
    assert (row.total_transactions, row.total_spend, row.avg_transaction) == (2, 50.99, 25.5)
    assert [c.category for c in row.top_categories] == ["grocery"] and len(row.recent_transactions) == 2


def test_kpis_of_nothing(spark):
    empty = stored(spark, [{}]).limit(0)
    assert tuple(serving.kpis(empty, empty, NOW, 7).first()) == (0, 0.0, 0.0, 0)


def test_signed_minimum_score(spark, rows):
    df = stored(spark, [{}, {}]).withColumn("z_score", F.when(F.col("txn_id").endswith("1"), -5.0).otherwise(5.0))
    assert serving.anomalies(df, NOW, min_z=4.0).count() == 1
    assert serving.anomalies(df, NOW, min_z=4.0, absolute=True).count() == 2


def test_texts_are_read_once_for_all_rules(spark, rows):
    """The shared reading gives what the expression gives, for texts that break many rules."""
    good = {"txn_id": "a" * 24, "user_id": "user_000001", "amount": 1.5, "currency": "CAD", "timestamp": "2024-03-01T00:00:00Z"}
    good |= {"merchant_id": "merchant_0001", "merchant_category": "grocery", "payment_method": "credit_card", "status": "approved"}
    good["location"] = {"lat": 1.0, "lon": 2.0}
    texts = [good, {**good, "x": 1}, {**good, "amount": "1"}, {**good, "location": {"lat": 99, "alt": 1}}, {**good, "location": None}, [1], {}]
    values = [json.dumps(t) for t in texts] + ["", None, "{", '"text"']
    df = spark.createDataFrame(list(enumerate(values)), "id int, value string")
    found = {r.id: r.violations for r in json_failures(df, TRANSACTION_CONTRACT, "id").collect()}
    expected = {r.id: r.v for r in df.select("id", json_violations("value", TRANSACTION_CONTRACT).alias("v")).collect() if r.v}
    assert found == expected and 0 not in found and found[9] == ["malformed"]
    assert found[3] == ["location.lat: above maximum", "location.lon: missing", "location.alt: unexpected"]
    plan = json_failures(df, TRANSACTION_CONTRACT, "id")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parse_json") <= 2
