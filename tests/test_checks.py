"""Data checks on small inputs: which rows fail, and the edge rules for NULLs and groups."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tillstream.operators import checks


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


def test_value_rules(spark, rows):
    df = frame(spark, [(-1, "a"), (11, " "), (None, None), (11, "")], "id int, s string")
    assert checks.accepted_range(df, "id", -1, 11).count() == 0
    assert checks.accepted_range(df, "id", -2, 11.1, inclusive=False).count() == 0
    assert checks.accepted_range(df, "id", -1, 11, inclusive=False).count() == 3
    assert rows(checks.unique(df, "id")) == [(11, 2)]
    assert checks.not_null(df, "id").count() == 1
    assert rows(checks.accepted_values(df, "id", [-1])) == [(11, 2)]
    assert rows(checks.not_accepted_values(df, "id", [11, 12])) == [(11,)]
    assert checks.not_empty_string(df, "s").count() == 2
    assert checks.not_empty_string(df, "s", trim_whitespace=False).count() == 1
    assert checks.expression_is_true(df, "id > 0").count() == 1
    assert checks.expression_is_true(df, "+ 1 = 12", column="id").count() == 1
    assert checks.assert_equal(df.withColumn("b", F.lit(11)), "id", "b").count() == 1


def test_group_rules(spark, rows):
    df = frame(spark, [("a", 1), ("b", None), ("a", 1)], "field string, value int")
    assert checks.at_least_one(df, "value").count() == 0
    assert checks.at_least_one(df.where("value is null"), "value").count() == 1
    assert rows(checks.at_least_one(df, "value", ["field"])) == [("b", 0)]
    assert checks.not_constant(df, "field").count() == 0
    assert rows(checks.not_constant(df, "value", ["field"])) == [("a", 1)]
    assert rows(checks.not_null_proportion(df, "value", 0.9, group_by=["field"])) == [("b", 0.0)]
    assert checks.not_null_proportion(df, "value", 0.5).count() == 0
    assert checks.not_null_proportion(df.limit(0), "value", 0.5).count() == 0
    assert rows(checks.unique_combination(df, ["field", "value"])) == [("a", 1, 2)]


def test_recency(spark):
    df = frame(spark, [("x", dt.datetime(2024, 1, 30, 23))], "k string, t timestamp_ntz")
    assert checks.recency(df, "t", "day", 1, "2024-01-31 22:00:00").count() == 0
    assert checks.recency(df, "t", "day", 1, "2024-02-01 00:00:00").count() == 1
    assert checks.recency(df, "t", "day", 2, "2024-02-01 00:00:00", True, ["k"]).count() == 0
    assert checks.recency(df.limit(0), "t", "day", 1, "2030-01-01").count() == 0
    with pytest.raises(ValueError):
        checks.recency(df, "t", "fortnight", 1, "2024-01-31")


def test_row_counts(spark, rows):
    a = frame(spark, [(1,), (1,), (2,), (None,)], "k int")
    b = frame(spark, [(1,), (2,), (3,), (3,)], "k int")
    assert rows(checks.equal_rowcount(a, b, ["k"])) == [(1, 2, 1, 1)]
    assert len(rows(checks.equal_rowcount(a, b, ["k"], strict=True))) == 3
    assert checks.equal_rowcount(a, b).count() == 0
    assert checks.equal_rowcount(a, b.limit(0)).count() == 0
    assert checks.equal_rowcount(a, b.limit(0), strict=True).count() == 1
    assert rows(checks.fewer_rows_than(a, b, ["k"])) == [(1, 2, 1, 1), (2, 1, 1, 1)]
    assert checks.fewer_rows_than(a.limit(3), b).count() == 0


def test_equality(spark, rows):
    schema = "col_a int, col_b int, col_c int"
    a, b = frame(spark, [(1, 1, 3), (1, 2, 1), (2, 3, 3)], schema), frame(spark, [(1, 1, 2), (1, 2, 2), (2, 3, 2)], schema)
    assert checks.equality(a, a).count() == 0
    assert checks.equality(a, b).count() == 6
    assert checks.equality(a, b, compare_columns=["col_a", "col_b"]).count() == 0
    assert checks.equality(a, b, exclude_columns=["COL_C"]).count() == 0
    surplus = checks.equality(a, a.limit(1))
    assert surplus.agg(checks.equality_failures()).first()[0] == 4
    with pytest.raises(ValueError):
        checks.equality(a, b.drop("col_c"))
    with pytest.raises(ValueError):
        checks.equality(a, b, ["col_a"], ["col_b"])


def test_equality_precision(spark):
    a = frame(spark, [("x", 62.3888186), ("y", 23.3959675)], "id string, v double")
    b = frame(spark, [("x", 62.3888187), ("y", 23.3959676)], "id string, v double")
    assert checks.equality(a, b, precision=4).count() == 0
    assert checks.equality(a, b, precision=8).count() == 4


def test_cardinality_equality(spark, rows):
    a = frame(spark, [(1,), (2,), (2,), (None,)], "v int")
    b = frame(spark, [(1,), (2,), (None,)], "w int")
    assert rows(checks.cardinality_equality(a, "v", b, "w")) == [("a_minus_b", 2, 2), ("b_minus_a", 2, 1)]
    assert checks.cardinality_equality(a, "v", a, "v").count() == 0


def test_relationships_where(spark, rows):
    a, b = frame(spark, [(1,), (2,), (4,), (4,), (None,)], "id int"), frame(spark, [(1,), (2,), (3,)], "id int")
    assert rows(checks.relationships_where(a, "id", b, "id")) == [(4, 2)]
    assert checks.relationships_where(a, "id", b, "id", from_condition="id <> 4").count() == 0
    assert checks.relationships_where(a, "id", b, "id", "id <> 4", "id > 1").count() == 1


def test_ranges(spark):
    touching = frame(spark, [(0, 1), (1, 2), (2, 4)], "lo int, hi int")
    assert checks.mutually_exclusive_ranges(touching, "lo", "hi", gaps="not_allowed").count() == 0
    assert checks.mutually_exclusive_ranges(touching, "lo", "hi", gaps="required").count() == 2
    days = frame(
        spark,
        [(1, "2019-01-01", "2019-02-01"), (1, "2019-03-03", "2019-04-01"), (2, "2019-05-06", "2019-07-02"), (2, "2019-07-03", None)],
        "id int, lo string, hi string",
    ).select("id", F.to_date("lo").alias("lo"), F.to_date("hi").alias("hi"))
    closed = "coalesce(hi, date'2099-01-01')"
    for gaps in ("allowed", "required"):
        assert checks.mutually_exclusive_ranges(days, "lo", closed, ["id"], gaps).count() == 0
    assert checks.mutually_exclusive_ranges(days, "lo", "hi", ["id"]).count() == 1
    instant = frame(spark, [(3, 6, 7), (3, 8, 10), (3, 8, 8), (3, 12, 15)], "id int, lo int, hi int")
    assert checks.mutually_exclusive_ranges(instant, "lo", "hi", ["id"], zero_length_range_allowed=True).count() == 0
    assert checks.mutually_exclusive_ranges(instant, "lo", "hi", ["id"]).count() == 1
    with pytest.raises(ValueError):
        checks.mutually_exclusive_ranges(touching, "lo", "hi", gaps="some")


def brute_ranges(data, gaps, zero):
    """Row by row: sorted by bounds with NULLs last, each compared with the next."""
    apart = {"allowed": lambda u, n: u <= n, "not_allowed": lambda u, n: u == n, "required": lambda u, n: u < n}[gaps]
    last = lambda x: (x is None, x or 0)
    out = Counter()
    for key in {k for k, _, _ in data}:
        group = sorted(((lo, hi) for k, lo, hi in data if k == key), key=lambda r: (last(r[0]), last(r[1])))
        for i, (lo, hi) in enumerate(group):
            nxt = group[i + 1][0] if i + 1 < len(group) else None
            proper = lo is not None and hi is not None and (lo <= hi if zero else lo < hi)
            fits = nxt is None or (hi is not None and apart(hi, nxt))
            if not (proper and fits):
                out[(key, lo, hi, nxt)] += 1
    return out


def random_groups(seed, n_groups, bounds):
    """Groups of very different sizes, with NULLs and repeated rows."""
    rng = random.Random(seed)
    draw = lambda top: None if rng.random() < 0.1 else rng.randrange(top)
    return [(k, *(draw(b) for b in bounds)) for k in range(n_groups) for _ in range(rng.choice([1, 3, 6, 40]))]


@pytest.mark.parametrize("gaps, zero", [("allowed", False), ("not_allowed", True), ("required", False)])
@pytest.mark.parametrize("slices", [None, 1, 23])
def test_ranges_against_brute_force(spark, gaps, zero, slices):
    data = random_groups(7, 40, (7, 9))
    df = frame(spark, data, "k int, lo int, hi int")
    bad = checks.mutually_exclusive_ranges(df, "lo", "hi", ["k"], gaps, zero, slices=slices)
    found = Counter({(r.k, r.lower_bound, r.upper_bound, r.next_lower_bound): r.n_rows for r in bad.collect()})
    assert found == brute_ranges(data, gaps, zero)


def test_sequences(spark, rows):
    df = frame(spark, [(1, 2), (1, 4), (1, 6), (2, 8), (2, 10)], "g int, v int")
    assert checks.sequential_values(df, "v", 2).count() == 0
    assert checks.sequential_values(df, "v", 2, group_by=["g"]).count() == 0
    hours = [(dt.datetime(2021, 1, 1, h),) for h in range(4)]
    clock = frame(spark, hours, "t timestamp_ntz")
    assert checks.sequential_values(clock, "t", 1, "hour").count() == 0
    assert checks.sequential_values(clock, "t", 2, "hour").count() == 3


@pytest.mark.parametrize("slices", [None, 1, 23])
def test_sequences_against_brute_force(spark, slices):
    data = random_groups(11, 40, (25,))
    expected = Counter()
    for key in {k for k, _ in data}:
        ordered = sorted(v for k, v in data if k == key and v is not None)
        expected.update((key, b, a) for a, b in zip(ordered, ordered[1:]) if b != a + 1)
    df = frame(spark, data, "k int, v int")
    bad = checks.sequential_values(df, "v", group_by=["k"], slices=slices)
    assert Counter({(r.k, r.v, r.previous_v): r.n_rows for r in bad.collect()}) == expected


def test_columns_match_set(spark, rows):
    df = frame(spark, [(1, 2)], "a int, b int")
    assert checks.columns_match_set(df, ["A", "b"]).count() == 0
    assert rows(checks.columns_match_set(df, ["a", "c"])) == [("B", None), (None, "C")]


def test_results(spark, rows, tmp_path):
    df = frame(spark, [(1,), (2,), (None,)], "v int")
    found = checks.run_checks(
        [
            checks.Check("nulls", checks.not_null(df, "v")),
            checks.Check("soft", checks.not_null(df, "v"), error_if="> 5"),
            checks.Check("clean", checks.not_null(checks.filtered(df, "v > 0"), "v")),
            checks.Check("expected_to_fail", checks.not_null(df, "v"), warn_if="< 0", error_if="< 1"),
        ]
    )
    assert [(r.check_name, r.failures, r.status) for r in found.collect()] == [
        ("nulls", 1, "fail"),
        ("soft", 1, "warn"),
        ("clean", 0, "pass"),
        ("expected_to_fail", 1, "pass"),
    ]
    assert rows(checks.failing(found), "check_name") == [("nulls",)]
    checks.Check("nulls", checks.not_null(df, "v")).store_failures(str(tmp_path / "failures"))
    assert spark.read.parquet(str(tmp_path / "failures")).count() == 1
