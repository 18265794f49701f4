"""Stored tables: appending, merging, snapshots and maintenance."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillstream.schemas import SNAPSHOT_ANOMALIES, SNAPSHOT_TRANSACTIONS
from tillstream.sources import stores

SCHEMA = "txn_id string, timestamp timestamp_ntz, amount double"


def at(day, hour=0):
    return dt.datetime(2024, 3, day, hour)


def test_append_keeps_the_first_row(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("a", at(1, 5), 1.0), ("a", at(1, 2), 2.0), (None, at(1), 3.0)], SCHEMA)
    second = spark.createDataFrame([("a", at(2), 4.0), ("b", at(1), 5.0)], SCHEMA)
    for batch in (first, second, second):
        stores.append_dedup(batch, path)
    assert rows(stores.read_by_day(spark, path), "txn_id", "amount") == [("a", 2.0), ("b", 5.0)]
    same_day = spark.createDataFrame([("a", at(1, 9), 6.0), ("c", at(1), 7.0)], SCHEMA)
    stores.append_dedup(same_day, path, whole_table=False)
    assert [r[0] for r in rows(stores.read_by_day(spark, path), "txn_id")] == ["a", "b", "c"]


def test_upsert_touches_only_its_days(spark, tmp_path, rows):
    path, keys = str(tmp_path / "t"), ["user_id", "window_start"]
    schema = "user_id string, window_start timestamp_ntz, total double, note string, arrival int"

    def store(data):
        stores.upsert_by_key(spark.createDataFrame(data, schema), path, keys, "window_start", "arrival")

    store([("u", at(1), 1.0, "x", 1), ("u", at(2), 2.0, "y", 1), (None, at(1), 9.0, "z", 1)])
    untouched = set((tmp_path / "t" / "event_date=2024-03-02").glob("*.parquet"))
    store([("u", at(1), 5.0, None, 1), ("u", at(1), None, "w", 2), ("v", at(1), 3.0, None, 1)])
    assert rows(stores.read_by_day(spark, path), "user_id", "total", "note") == [
        ("u", 2.0, "y"),
        ("u", 5.0, "w"),
        ("v", 3.0, None),
    ]
    assert set((tmp_path / "t" / "event_date=2024-03-02").glob("*.parquet")) == untouched
    store([(None, at(1), 9.0, "z", 1)])
    assert stores.read_by_day(spark, path).count() == 3
    with pytest.raises(ValueError):
        stores.upsert_by_key(spark.createDataFrame([], schema), path, ["user_id"], "window_start", "arrival")


def test_snapshot(spark, tmp_path, rows):
    data = [("a", at(1), 1.0, (1.0, 2.0)), ("b", at(9), 2.0, None), ("c", at(8), 3.0, (3.0, 4.0))]
    df = spark.createDataFrame(data, SCHEMA + ", location struct<lat: double, lon: double>")
    path = str(tmp_path / "snap")
    stores.export_snapshot(df, SNAPSHOT_TRANSACTIONS, path, "2024-03-10", lookback_days=5)
    out = spark.read.parquet(path)
    assert out.columns == [c.split()[0] for c in SNAPSHOT_TRANSACTIONS.split(", ")] and len(out.columns) == 15
    assert rows(out, "txn_id", "location_lat", "status") == [("b", None, None), ("c", 3.0, None)]
    stores.export_snapshot(df, SNAPSHOT_ANOMALIES, path, "2024-03-10")
    assert len(spark.read.parquet(path).columns) == 11 and spark.read.parquet(path).count() == 3


def test_purge_and_compact(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    for hour in (1, 5, 9):
        batch = spark.createDataFrame([(f"{d}-{hour}", at(d, hour), 1.0) for d in (1, 2, 3)], SCHEMA)
        stores.append_dedup(batch, path)
    kept_files = set((tmp_path / "t" / "event_date=2024-03-03").glob("*.parquet"))
    assert stores.purge(spark, path, "2024-03-12 04:00:00", days=10) == 4
    assert rows(stores.read_by_day(spark, path), "txn_id") == [("2-5",), ("2-9",), ("3-1",), ("3-5",), ("3-9",)]
    assert not (tmp_path / "t" / "event_date=2024-03-01").exists()
    assert set((tmp_path / "t" / "event_date=2024-03-03").glob("*.parquet")) == kept_files
    assert stores.purge(spark, path, "2024-03-12 04:00:00", days=10) == 0
    assert stores.compact(spark, path) == 1
    assert stores.compact(spark, path) == 0
    assert stores.read_by_day(spark, path).count() == 5
    assert len(list((tmp_path / "t" / "event_date=2024-03-03").glob("*.parquet"))) == 1


def test_orphans_are_removed(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    stores.append_dedup(spark.createDataFrame([("a", at(1), 1.0), ("b", at(1), 1.0), ("c", at(2), 1.0), ("d", at(3), 1.0)], SCHEMA), path)
    known = spark.createDataFrame([("a",), ("d",)], "txn_id string")
    assert stores.remove_orphans(spark, path, known, limit=1) == 1
    assert rows(stores.read_by_day(spark, path), "txn_id") == [("a",), ("c",), ("d",)]
    assert stores.remove_orphans(spark, path, known) == 1
    assert stores.remove_orphans(spark, path, known) == 0
    assert rows(stores.read_by_day(spark, path), "txn_id") == [("a",), ("d",)]


def test_orphans_without_a_time(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    stores.append_dedup(spark.createDataFrame([("a", at(1), 1.0), ("b", None, 1.0), ("c", None, 1.0)], SCHEMA), path)
    assert stores.remove_orphans(spark, path, spark.createDataFrame([("a",), ("c",)], "txn_id string")) == 1
    assert rows(stores.read_by_day(spark, path), "txn_id") == [("a",), ("c",)]
    assert stores.remove_orphans(spark, path, spark.createDataFrame([("a",)], "txn_id string")) == 1
    assert rows(stores.read_by_day(spark, path), "txn_id") == [("a",)]


def test_compaction_converges(spark, tmp_path):
    path = str(tmp_path / "t")
    for part in range(12):
        made = [(f"{part}-{i}", at(1) if i % 2 else None, float(i)) for i in range(200)]
        stores.write_by_day(stores._with_day(spark.createDataFrame(made, SCHEMA), "timestamp"), path)
    target = 8_000
    before = spark.read.parquet(path).count()
    assert stores.compact(spark, path, target) == 2
    for _ in range(3):
        if stores.compact(spark, path, target) == 0:
            break
    assert stores.compact(spark, path, target) == 0
    assert spark.read.parquet(path).count() == before


def test_stats_and_materialize(spark, tmp_path):
    df = spark.createDataFrame([("a", at(1), 1.0)], SCHEMA).unionAll(spark.createDataFrame([("b", at(1), 1.0)], SCHEMA))
    stored = stores.materialize(df, "a_model", str(tmp_path / "m"))
    row = stores.table_stats({"a_model": stored}).first()
    assert (row.table_name, row.row_count) == ("a_model", 2)
    assert row.total_bytes > 0 and row.avg_row_bytes == row.total_bytes / 2
    stores.materialize(df.where("txn_id = 'a'"), "a_model", str(tmp_path / "m"))
    assert spark.table("a_model").count() == 1
    stores.materialize(spark.table("a_model").select(F.lit(1)), "a_view")
    assert spark.table("a_view").first()[0] == 1


def scanned_rows(df):
    """Rows that the scans of a plan without exchanges put out."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(k).metrics().apply("numOutputRows").value() for k in range(leaves.size()))


def test_a_look_up_reads_few_row_groups(spark, tmp_path, rows):
    path, n = str(tmp_path / "t"), 40_000
    ids = spark.range(n).select(F.sha2(F.col("id").cast("string"), 256).alias("txn_id"), F.lit(at(1)).alias("timestamp"), F.rand(1).alias("amount"))
    stores.write_by_day(ids.withColumn(stores.DAY, F.to_date("timestamp")), path, key="txn_id", row_group_bytes=100_000)
    stored = spark.read.parquet(path)
    wanted = [r[0] for r in ids.select("txn_id").limit(3).collect()]
    batch = spark.createDataFrame([(w,) for w in [*wanted, "unknown", "unknown"]], "txn_id string")
    found = stores.stored_ids(stored, batch, "txn_id")
    assert rows(found, "txn_id") == sorted((w,) for w in wanted)
    few = stored.select("txn_id").where(F.col("txn_id").isin(wanted))
    nothing = stored.select("txn_id").where(F.col("txn_id").isin("7unknown", "cunknown"))  # inside the range of every file
    assert scanned_rows(few) < n / 3 and scanned_rows(nothing) == 0
    plan = found._jdf.queryExecution().toString()
    assert "PushedFilters: [In(txn_id" in plan or "PushedFilters: [Or(" in plan


def test_look_ups_of_any_size_agree(spark, tmp_path, rows, monkeypatch):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(f"t{i:03d}", at(1 + i % 3), float(i)) for i in range(40)], SCHEMA)
    stores.append_dedup(first, path)
    more = spark.createDataFrame([(f"t{i:03d}", at(9), 0.0) for i in range(30, 60)] + [(None, at(1), 1.0)], SCHEMA)
    expected = [(f"t{i:03d}",) for i in range(30, 40)]
    stored = spark.read.parquet(path)
    for pushed, broadcast in ((200, 500), (2, 500), (2, 3)):
        monkeypatch.setattr(stores, "MAX_PUSHED_IDS", pushed)
        monkeypatch.setattr(stores, "MAX_BROADCAST_IDS", broadcast)
        assert rows(stores.stored_ids(stored, more.where("txn_id is not null"), "txn_id"), "txn_id") == expected
    assert stores.stored_ids(stored, more.limit(0), "txn_id").collect() == []
    stores.append_dedup(more, path)
    assert stores.read_by_day(spark, path).count() == 60


def test_rows_without_a_time_are_not_stored_again(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    batch = spark.createDataFrame([("a", None, 1.0), ("b", at(1), 2.0)], SCHEMA)
    for _copy in range(3):
        stores.append_dedup(batch, path, whole_table=False)
    assert rows(stores.read_by_day(spark, path), "txn_id") == [("a",), ("b",)]


def test_stats_come_from_a_listing(spark, tmp_path):
    """Bytes and average as the file system tells them, without a pass over the rows."""
    path = tmp_path / "t"
    days = [(f"t{i}", at(1 + i % 3), float(i)) for i in range(300)] + [("x", None, 1.0)]
    df = stores._with_day(spark.createDataFrame(days, SCHEMA), "timestamp")
    for _copy in range(2):
        stores.write_by_day(df, str(path))
    files = [f for f in path.rglob("*.parquet")]
    total = sum(f.stat().st_size for f in files)
    row = stores.table_stats({"t": str(path)}).first()
    assert (row.row_count, row.file_count, row.total_bytes) == (602, len(files), total)
    assert row.avg_row_bytes == total / 602
    listing = stores.file_listing(spark, str(path))
    assert "content" not in listing._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]
    by_day = listing.groupBy(stores._day_of("file_path").alias("day")).agg(F.sum("bytes").alias("n"))
    found = {r.day: r.n for r in by_day.collect()}
    assert found[None] == sum(f.stat().st_size for f in files if "HIVE_DEFAULT" in str(f)) and len(found) == 4
    one = next(iter(files))
    assert stores.table_stats({"one": str(one)}).first().total_bytes == one.stat().st_size
