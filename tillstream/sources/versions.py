"""Tables whose dates are replaced in one step.

Overwriting folders in place lets a reader meet half of the old and half of the new files. Here every change
writes its dates to a folder of its own, and the last step adds a version: a small Parquet table that names, for
each date, the folder its rows are in. It appears by one rename. A reader takes the newest version it finds and
reads exactly the folders that it names, so it sees a table before or after a change and never a mix; a change that
dies before its version exists has changed nothing. Dates that a change does not touch are not rewritten.

The list of dates is bounded by the calendar and passes through the driver. Two writers at once would make the same
version number: the second one fails and can start again. Old folders stay for readers until `expire`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.functions.times import AsOf, as_of_column, shift
from tillstream.operators.joins import orphans
from tillstream.session import file_system
from tillstream.sources.stores import DAY, TARGET_FILE_BYTES, file_listing, latest_per_key, merge_fields, write_by_day

_NULL = "__HIVE_DEFAULT_PARTITION__"
_ENTRY = f"{DAY} string, folder string"


class VersionedTable:
    """A table of rows by `event_date` below a folder; `time` is the column that the date is taken from."""

    def __init__(self, spark: SparkSession, path: str, time: str = "timestamp"):
        self.spark, self.path, self.time = spark, path.rstrip("/"), time

    # ---- versions --------------------------------------------------------------------------

    def versions(self) -> list[int]:
        fs, folder = file_system(self.spark, f"{self.path}/versions")
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n.removeprefix("version=")) for n in names if n.startswith("version="))

    def entries(self, version: int | None = None) -> dict[str, str]:
        """date -> folder of a version, the newest one if none is given."""
        known = self.versions()
        if not known:
            return {}
        at = f"{self.path}/versions/version={known[-1] if version is None else version}"
        return {r[DAY]: r["folder"] for r in self.spark.read.schema(_ENTRY).parquet(at).collect()}

    def read(self, version: int | None = None) -> DataFrame | None:
        """The rows of a version, None before the first one or when all its dates are empty."""
        folders = sorted(set(f"{self.path}/data/{f}/{DAY}={d}" for d, f in self.entries(version).items()))
        if not folders:
            return None
        return self.spark.read.option("basePath", f"{self.path}/data").parquet(*folders).drop("change", DAY)

    def _dated(self) -> DataFrame:
        folders = [f"{self.path}/data/{f}/{DAY}={d}" for d, f in self.entries().items()]
        return self.spark.read.option("basePath", f"{self.path}/data").parquet(*folders).drop("change")

    def replace(self, rows: DataFrame, dates: Sequence[str]) -> int:
        """Let `rows` (with `event_date`) take the place of all rows of `dates`, which must cover theirs;
        returns the number of the new version."""
        number = (self.versions() or [-1])[-1] + 1
        folder = f"change={number}"
        write_by_day(rows, f"{self.path}/data/{folder}", "overwrite")  # a dead attempt's files go
        fs, made = file_system(self.spark, f"{self.path}/data/{folder}")
        names = [s.getPath().getName() for s in fs.listStatus(made)]
        written = [n.removeprefix(f"{DAY}=") for n in names if n.startswith(f"{DAY}=")]
        if not set(written) <= set(dates):
            raise ValueError("rows of dates that are not replaced")
        kept = {d: f for d, f in self.entries().items() if d not in set(dates)}
        self._publish(number, kept | {d: folder for d in written})
        return number

    def _publish(self, number: int, entries: dict[str, str]) -> None:
        """The step that readers see."""
        pending = f"{self.path}/versions/_pending-{number}"
        self.spark.createDataFrame(sorted(entries.items()), _ENTRY).coalesce(1).write.mode("overwrite").parquet(pending)
        fs, source = file_system(self.spark, pending)
        _, target = file_system(self.spark, f"{self.path}/versions/version={number}")
        if fs.exists(target) or not fs.rename(source, target):
            raise RuntimeError(f"version {number} was written by someone else")

    def expire(self, keep: int = 2) -> int:
        """Drop all but the newest versions and the folders that none of them names; returns how many folders."""
        known = self.versions()
        used = {(f, d) for v in known[-keep:] for d, f in self.entries(v).items()}
        dropped = 0
        fs, data = file_system(self.spark, f"{self.path}/data")
        for change in fs.listStatus(data) if fs.exists(data) else []:
            for part in fs.listStatus(change.getPath()):
                name = part.getPath().getName()
                if name.startswith(f"{DAY}=") and (change.getPath().getName(), name.removeprefix(f"{DAY}=")) not in used:
                    dropped += bool(fs.delete(part.getPath(), True))
        for v in known[:-keep]:
            fs.delete(file_system(self.spark, f"{self.path}/versions/version={v}")[1], True)
        return dropped

    # ---- changes ---------------------------------------------------------------------------

    def _with_day(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(DAY, F.to_date(self.time))

    def _dates(self, rows: DataFrame) -> list[str]:
        """The dates of rows, as folders name them."""
        return [_NULL if r[0] is None else r[0].isoformat() for r in rows.select(DAY).distinct().collect()]

    def _of_dates(self, dates: Sequence[str]) -> DataFrame | None:
        entries = self.entries()
        folders = [f"{self.path}/data/{entries[d]}/{DAY}={d}" for d in dates if d in entries]
        if not folders:
            return None
        return self.spark.read.option("basePath", f"{self.path}/data").parquet(*folders).drop("change")

    def upsert(self, batch: DataFrame, keys: Sequence[str], arrival: str) -> None:
        """Insert or update by key, as `stores.upsert_by_key` does, in one step."""
        if self.time not in keys:
            raise ValueError("the partitioning time must be part of the key")
        newest = latest_per_key(batch, keys, arrival)
        dates = self._dates(self._with_day(newest.select(*keys)))
        if not dates:
            return
        touched = self._of_dates(dates)
        rows = newest if touched is None else merge_fields(touched.drop(DAY), newest, keys)
        self.replace(self._with_day(rows), dates)

    def remove_orphans(self, transactions: DataFrame, key: str = "txn_id") -> int:
        """Drop rows whose id is not in `transactions`; returns how many."""
        if not self.entries():
            return 0
        stored = self._dated()
        missing = orphans(stored.select(key, DAY).distinct(), transactions, key, None)
        dates = self._dates(missing)
        if not dates:
            return 0
        hit = self._of_dates(dates)
        kept = hit.join(transactions.select(F.col(key).alias("_known")).distinct(), F.col(key) == F.col("_known"), "left_semi")
        before = hit.count()
        number = self.replace(kept, dates)
        left = [f"{self.path}/data/{f}/{DAY}={d}" for d, f in self.entries(number).items() if f == f"change={number}"]
        return before - (self.spark.read.parquet(*left).count() if left else 0)

    def purge(self, as_of: AsOf, days: int = 90) -> None:
        """Drop rows older than the retention. Rows without a time have no age and stay."""
        cutoff = shift(as_of_column(as_of), "day", -days)
        first = self.spark.range(1).select(F.to_date(cutoff)).first()[0].isoformat()
        old = [d for d in self.entries() if d != _NULL and d < first]
        boundary = self._of_dates([first])
        if boundary is not None and boundary.where(F.col(self.time) < cutoff).isEmpty():
            boundary = None
        if boundary is None and not old:
            return
        if boundary is None:
            entries = {d: f for d, f in self.entries().items() if d not in set(old)}
            self._publish(self.versions()[-1] + 1, entries)
        else:
            self.replace(boundary.where(F.col(self.time) >= cutoff), [*old, first])

    def compact(self, target_bytes: int = TARGET_FILE_BYTES) -> int:
        """Rewrite the dates that hold more files than their size needs; returns how many dates."""
        entries = self.entries()
        if not entries:
            return 0
        listed = file_listing(self.spark, f"{self.path}/data")
        place = [F.regexp_extract("file_path", f"/(change=[0-9]+)/{DAY}=([^/]+)/", k) for k in (1, 2)]
        live = self.spark.createDataFrame([(d, f) for d, f in entries.items()], "day string, of_change string")
        files = listed.select(place[0].alias("of_change"), place[1].alias("day"), "bytes").join(F.broadcast(live), ["day", "of_change"])
        by_day = files.groupBy("day").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))
        crowded = [r["day"] for r in by_day.where(F.col("files") > F.greatest(F.lit(1), F.ceil(F.col("bytes") / target_bytes))).collect()]
        if crowded:
            self.replace(self._of_dates(crowded), crowded)
        return len(crowded)
