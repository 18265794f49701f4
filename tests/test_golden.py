"""Small inputs with known results for scalar and reshaping operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillstream.functions import money, scalars, times, urls
from tillstream.operators import dedup, reshape


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_safe_arithmetic(spark):
    df = spark.createDataFrame([(1, 2, 3), (1, None, 3), (None, None, 2), (None, None, None)], "a int, b int, c int")
    assert values(df, scalars.safe_add(["a", "b", "c"])) == [6, 4, 2, 0]
    df = spark.createDataFrame([(3, 2, 1), (4, None, 3), (None, None, 2), (None, None, None)], "a int, b int, c int")
    assert values(df, scalars.safe_subtract(["a", "b", "c"])) == [0, 1, -2, 0]
    with pytest.raises(ValueError):
        scalars.safe_add("a")


def test_safe_divide(spark):
    pairs = [(6, 0), (10, 5), (None, None), (None, 0), (17, None), (0, None), (None, 9), (0, 5)]
    df = spark.createDataFrame(pairs, "n int, d int")
    assert values(df, scalars.safe_divide("n", "d")) == [None, 2.0, None, None, None, None, None, 0.0]


def test_width_bucket(spark):
    amounts = [190000.0, 290000.0, 320000.0, 399999.99, 400000.0, 470000.0, 510000.0, 610000.0]
    df = spark.createDataFrame([(a,) for a in amounts], "amount double")
    assert values(df, scalars.width_bucket("amount", 200000.0, 600000.0, 4)) == [0, 1, 2, 2, 3, 3, 4, 5]


def test_haversine(spark):
    df = spark.createDataFrame([(48.864716, 2.349014, 52.379189, 4.899431)], "a double, b double, c double, d double")
    assert round(values(df, scalars.haversine_distance("a", "b", "c", "d"))[0]) == 267
    assert round(values(df, scalars.haversine_distance("a", "b", "c", "d", "km"))[0]) == 430
    with pytest.raises(ValueError):
        scalars.haversine_distance("a", "b", "c", "d", "m")


def test_surrogate_key(spark):
    df = spark.createDataFrame(
        [("a", "b", "c"), ("a", None, "c"), (None, None, "c"), (None, None, None)], "a string, b string, c string"
    )
    first, everything = scalars.surrogate_key(["a"]), scalars.surrogate_key(["a", "b", "c"])
    assert values(df, first) == ["0cc175b9c0f1b6a831c399e269772661"] * 2 + ["f14cc5cdce0420f4a5a6b6d9d7b85f39"] * 2
    assert values(df, everything) == [
        "7b193b3d33184464106f41ddf733783b",
        "4f32a73dc87b7bbb7a654d8898d58c7e",
        "d9c538b129f1a3ad6ecfe55345c32a05",
        "2fa5491950d66d153d23cfbcfea4e164",
    ]


@pytest.mark.parametrize(
    "url, host",
    [
        ("www.google.co.uk?utm_source=google&utm_medium=cpc&utm_campaign=spring-summer", "www.google.co.uk"),
        ("http://witanddelight.com/2018/01/tips-tricks-how-run-half-marathon-first-time/", "witanddelight.com"),
        ("https://www.nytimes.com/2018/01/01/blog", "www.nytimes.com"),
        ("android-app://m.facebook.com/", "m.facebook.com"),
        ("docs.nytimes.com/2021/01/01/index.js?utm_source=google", "docs.nytimes.com"),
        ("https://m.facebook.com/", "m.facebook.com"),
        (None, None),
    ],
)
def test_url_host(spark, url, host):
    assert values(spark.createDataFrame([(url,)], "url string"), urls.url_host("url")) == [host]


@pytest.mark.parametrize(
    "url, path",
    [
        ("www.google.co.uk?utm_source=google&utm_medium=cpc", ""),
        ("http://witanddelight.com/2018/01/half-marathon/", "2018/01/half-marathon/"),
        ("https://www.nytimes.com/2018/01/01/blog", "2018/01/01/blog"),
        ("http://witanddelight.com/2018/01/half-marathon/?utm_source=google", "2018/01/half-marathon/"),
        ("plain", "plain"),
    ],
)
def test_url_path(spark, url, path):
    assert values(spark.createDataFrame([(url,)], "url string"), urls.url_path("url")) == [path]


def test_url_parameter(spark):
    texts = [
        "http://drewbanin.com/milky?utm_medium=organic",
        "http://drewbanin.com/milky?utm_medium=organic&utm_source=github",
        "http://drewbanin.com/milky?utm_source=&x=1",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "url string")
    assert values(df, urls.url_parameter("url", "utm_medium")) == ["organic", "organic", None]
    assert values(df, urls.url_parameter("url", "utm_source")) == [None, "github", None]


def test_rounding_and_ratio(spark):
    df = spark.createDataFrame([(2.675, 0), (-2.5, 4), (1.005, -1), (None, None)], "x double, d int")
    assert values(df, money.round_away("x", 0)) == [3.0, -3.0, 1.0, None]
    assert values(df, money.ratio_pct("x", "d")) == [None, -62.5, None, None]
    assert values(df, money.ratio_pct("x", "d", otherwise=0)) == [0.0, -62.5, 0.0, 0.0]


def test_compact_text(spark):
    df = spark.createDataFrame([(0.0,), (950.4,), (1234.0,), (3_450_000.0,), (-5000.0,)], "n double")
    assert values(df, money.compact_number("n")) == ["0", "950", "1.2K", "3.5M", "-5,000"]
    assert values(df, money.compact_currency("n")) == ["$0.00", "$950.40", "$1.2K", "$3.45M", "$-5,000.00"]


def test_event_time(spark):
    texts = ["2026-03-01T12:00:00+00:00", "2026-03-01T07:00:00-05:00", "1709251200", "1709251200.5", "not-a-date", "", "NaN", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    noon, start, epoch = dt.datetime(2026, 3, 1, 12), dt.datetime(2024, 3, 1), dt.datetime(1970, 1, 1)
    expected = [noon, noon, start, start.replace(microsecond=500000), epoch, epoch, epoch, epoch]
    assert values(df, times.event_time("t").cast("timestamp_ntz")) == expected


def test_points_in_time(spark):
    aware = dt.datetime(2024, 1, 1, 7, tzinfo=dt.timezone(dt.timedelta(hours=2)))
    points = ["2024-01-01 05:00:00", dt.datetime(2024, 1, 1, 5), aware, F.lit("2024-01-01 05:00:00")]
    found = spark.range(1).select(*[times.as_of_column(p).alias(str(i)) for i, p in enumerate(points)]).first()
    assert set(found) == {dt.datetime(2024, 1, 1, 5)}
    assert spark.range(1).select(times.as_of_column(dt.date(2024, 1, 1))).first()[0] == dt.datetime(2024, 1, 1)


def test_deduplicate(spark, rows):
    df = spark.createDataFrame([(1, "play", 1), (1, "play", 2), (2, "pause", 1)], "user_id int, event string, version int")
    kept = dedup.deduplicate(df.where("user_id = 1"), "user_id", [F.col("version").desc()])
    assert rows(kept) == [(1, "play", 2)]


def test_deduplicate_null_rows(spark, rows):
    df = spark.createDataFrame([(1, None), (None, "x"), (None, "y"), (2, "b"), (2, "c")], "k int, v string")
    assert rows(dedup.deduplicate(df, "k", ["v"])) == [(1, None), (2, "b"), (None, "x")]
    assert rows(dedup.deduplicate(df, "k", ["v"], drop_null_rows=True)) == [(2, "b")]


def test_pivot(spark, rows):
    df = spark.createDataFrame([("S", "red"), ("S", "blue"), ("S", "blue's"), ("M", "red")], "size string, color string")
    assert rows(reshape.pivot(df, ["size"], "color", ["red", "blue"])) == [("M", 1, 0), ("S", 1, 1)]
    named = reshape.pivot(df, ["size"], "color", ["red", "blue", "blue's"], quote_identifiers=False)
    assert named.columns == ["size", "red", "blue", "blues"]
    assert rows(named) == [("M", 1, 0, 0), ("S", 1, 1, 1)]
    assert reshape.pivot(df, ["size"], "color").columns == ["size", "red", "blue", "blue's"]


def test_slugify():
    assert reshape.slugify("2nd Half-Year!") == "_2nd_half_year"
    assert reshape.slugify("") == ""


def test_unpivot(spark, rows):
    df = spark.createDataFrame(
        [(123, "active", "tier 1", True), (234, "active", None, False), (567, "churned", "tier 2", None)],
        "customer_id int, status string, segment string, is_updated boolean",
    )
    long = reshape.unpivot(df, exclude=["Customer_Id"], remove=["segment"], field_name="prop", value_name="val")
    assert rows(long) == sorted(
        [
            (123, "status", "active"),
            (123, "is_updated", "true"),
            (234, "status", "active"),
            (234, "is_updated", "false"),
            (567, "status", "churned"),
            (567, "is_updated", None),
        ],
        key=repr,
    )


def test_union_relations(spark, rows):
    one = spark.createDataFrame([(1, "drew", "pi"), (2, "bob", "e")], "id int, name string, favorite_number string")
    two = spark.createDataFrame([(1, "green", 7), (2, "pink", 13)], "id int, favorite_color string, favorite_number int")
    both = reshape.union_relations({"one": one, "two": two}, source_column_name=None)
    assert both.columns == ["id", "name", "favorite_number", "favorite_color"]
    assert rows(both)[0] == (1, "drew", "pi", None)
    assert (2, None, "13", "pink") in rows(both)
    assert "name" not in reshape.union_relations({"one": one, "two": two}, exclude=["NAME"]).columns
    override = reshape.union_relations({"two": two}, column_override={"favorite_number": "double"})
    assert dict(override.dtypes)["favorite_number"] == "double"
    with pytest.raises(ValueError):
        reshape.union_relations({"one": one}, include=["id"], exclude=["name"])
    with pytest.raises(ValueError):
        reshape.union_relations({"one": one}, include=["nothing"])


def test_union_by_prefix(spark, rows):
    for day, users in (("20180101", [1, 2]), ("20180102", [3, 4]), ("20180103", [5, 6])):
        data = [(u, "play" if u % 2 else "pause") for u in users]
        spark.createDataFrame(data, "user_id int, event string").createOrReplaceTempView(f"day_events_{day}")
    both = reshape.union_by_prefix(spark, "day_events_", source_column_name=None)
    assert [r[0] for r in rows(both)] == [1, 2, 3, 4, 5, 6]
    assert reshape.union_by_pattern(spark, "DAY_EVENTS_%", exclude="%03").count() == 4


def test_star_and_nullcheck(spark, rows):
    df = spark.createDataFrame([("a", "", 1), ("", "b", 2)], "field_1 string, field_2 string, field_3 int")
    assert df.select(*reshape.star(df, ["FIELD_3"], "p_", "_s")).columns == ["p_field_1_s", "p_field_2_s"]
    assert reshape.filtered_columns(df, ["field_1"]) == ["field_2", "field_3"]
    assert rows(reshape.nullcheck_table(df)) == [("a", None, 1), (None, "b", 2)]


def test_column_values(spark):
    data = [(v, c) for v, c in zip("abcdefggggg", "lrlrlrlrlrl")]
    df = spark.createDataFrame(data, "field string, side string")
    assert values(reshape.column_values(df, "field"), "value") == list("gabcdef")
    assert values(reshape.column_values(df, "field", where="side = 'l'"), "value") == list("gace")
    assert values(reshape.column_values(df, "field", max_records=2), "value") == ["g", "a"]
    assert reshape.table_column_values(spark, "no_such_table", "x", default=["d"]) == ["d"]
    with pytest.raises(ValueError):
        reshape.table_column_values(spark, "no_such_table", "x")


def test_lookups(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, s string")
    assert reshape.single_value(df) == 1
    assert reshape.single_value(df.where("n > 5"), default=9) == 9
    assert reshape.results_as_dict(df) == {"n": (1, 2), "s": ("a", "b")}
    with pytest.raises(ValueError):
        reshape.results_as_dict(df, max_rows=1)


def test_series_and_spine(spark):
    assert values(reshape.generate_series(spark, 10), "generated_number") == list(range(1, 11))
    with pytest.raises(ValueError):
        reshape.generate_series(spark, 0)
    days = reshape.date_spine(spark, "day", "2018-01-01", "2018-01-10")
    assert values(days, "date_day") == [dt.datetime(2018, 1, d) for d in range(1, 10)]
    months = reshape.date_spine(spark, "month", "2018-01-15", "2018-04-01")
    assert values(months, "date_month") == [dt.datetime(2018, m, 15) for m in (1, 2, 3)]
    assert reshape.date_spine(spark, "hour", "2018-01-02", "2018-01-01").count() == 0
