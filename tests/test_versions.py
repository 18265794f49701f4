"""Versioned tables: readers during a change, crashes, and the same results as the stores that overwrite."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillstream.sources import stores, versions
from tillstream.sources.versions import VersionedTable

SCHEMA = "user_id string, timestamp timestamp_ntz, total double, note string, arrival int"
KEYS = ["user_id", "timestamp"]


def at(day, hour=0):
    return dt.datetime(2024, 3, day, hour)


def batch(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


@pytest.fixture
def held(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "t"))


def test_upserts_equal_the_store_that_overwrites(spark, tmp_path, rows, held):
    path = str(tmp_path / "plain")
    batches = [
        batch(spark, ("u", at(1), 1.0, "x", 1), ("u", at(2), 2.0, "y", 1), (None, at(1), 9.0, "z", 1)),
        batch(spark, ("u", at(1), 5.0, None, 1), ("u", at(1), None, "w", 2), ("v", at(3), 3.0, None, 1)),
        batch(spark, ("u", at(2), None, None, 1)),
        batch(spark),
    ]
    for b in batches:
        held.upsert(b, KEYS, "arrival")
        stores.upsert_by_key(b, path, KEYS, "timestamp", "arrival")
    columns = ["user_id", "timestamp", "total", "note"]
    assert rows(held.read(), *columns) == rows(stores.read_by_day(spark, path), *columns)
    assert held.versions() == [0, 1, 2]
    assert held.entries()["2024-03-01"] == "change=1"  # untouched dates stay where they are
    with pytest.raises(ValueError):
        held.upsert(batches[0], ["user_id"], "arrival")


def test_a_reader_sees_before_or_after(spark, rows, held):
    assert held.read() is None
    held.upsert(batch(spark, ("u", at(1), 1.0, "old", 1), ("u", at(2), 1.0, "old", 1)), KEYS, "arrival")
    before = held.read().select("note")
    held.upsert(batch(spark, ("u", at(1), 1.0, "new", 1), ("u", at(2), 1.0, "new", 1)), KEYS, "arrival")
    assert rows(before) == [("old",), ("old",)]
    assert rows(held.read(), "note") == [("new",), ("new",)] and rows(held.read(0), "note") == [("old",), ("old",)]


def test_a_change_that_dies_has_changed_nothing(spark, rows, held, monkeypatch):
    held.upsert(batch(spark, ("u", at(1), 1.0, "old", 1), ("v", at(2), 1.0, "old", 1)), KEYS, "arrival")
    change = batch(spark, ("u", at(1), 2.0, "new", 1), ("w", at(3), 1.0, "new", 1))

    def dies(self, number, entries):
        raise RuntimeError("killed before the version")

    with monkeypatch.context() as patch:
        patch.setattr(VersionedTable, "_publish", dies)
        with pytest.raises(RuntimeError):
            held.upsert(change, KEYS, "arrival")
    assert rows(held.read(), "user_id", "note") == [("u", "old"), ("v", "old")] and held.versions() == [0]
    held.upsert(change, KEYS, "arrival")
    assert rows(held.read(), "user_id", "note") == [("u", "new"), ("v", "old"), ("w", "new")]


def test_two_writers_do_not_lose_a_change(spark, held, monkeypatch):
    held.upsert(batch(spark, ("u", at(1), 1.0, "a", 1)), KEYS, "arrival")
    real = VersionedTable._publish

    def late(self, number, entries):
        monkeypatch.setattr(VersionedTable, "_publish", real)
        VersionedTable(spark, held.path)._publish(number, self.entries())  # the other one is first
        real(self, number, entries)

    monkeypatch.setattr(VersionedTable, "_publish", late)
    with pytest.raises(RuntimeError, match="someone else"):
        held.upsert(batch(spark, ("u", at(1), 2.0, "b", 1)), KEYS, "arrival")


def test_orphans_purge_and_compaction(spark, rows, held, tmp_path):
    data = [(f"t{i}", at(1 + i % 4, i % 24), float(i), "n", 1) for i in range(40)] + [("x", None, 0.0, "n", 1)]
    for part in (data[:20], data[20:]):
        held_rows = held._with_day(batch(spark, *part)).repartition(3)
        old = held._of_dates(held._dates(held_rows))
        both = held_rows if old is None else old.unionByName(held_rows)
        held.replace(both, held._dates(both))
    assert held.read().count() == 41
    known = spark.createDataFrame([(f"t{i}",) for i in range(0, 40, 2)], "user_id string")
    assert held.remove_orphans(known, "user_id") == 21 and held.remove_orphans(known, "user_id") == 0
    assert rows(held.read(), "user_id") == sorted((f"t{i}",) for i in range(0, 40, 2))
    held.purge("2024-03-12 06:00:00", days=10)
    cut = at(2, 6)
    assert rows(held.read(), "user_id") == sorted((d[0],) for d in data[:40:2] if d[1] >= cut)
    version = held.versions()[-1]
    held.purge("2024-03-12 06:00:00", days=10)
    assert held.versions()[-1] == version
    many = held._dated().repartition(8)
    for day in list(held.entries()):
        part = many.where(F.col(stores.DAY) == day)
        part.write.partitionBy(stores.DAY).mode("append").parquet(f"{held.path}/data/{held.entries()[day]}")
    before = held.read().count()
    assert held.compact() >= 1 and held.compact() == 0 and held.read().count() == before
    assert held.expire(keep=1) > 0 and held.read().count() == before and held.versions() == [held.versions()[-1]]


def test_rows_must_lie_in_the_replaced_dates(spark, held):
    with pytest.raises(ValueError):
        held.replace(held._with_day(batch(spark, ("u", at(1), 1.0, "a", 1))), ["2024-03-02"])
    assert versions.VersionedTable(spark, held.path).read() is None
