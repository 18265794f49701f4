"""Stored tables: Parquet folders partitioned by date.

Writers touch only the date partitions their rows fall in. Folders are replaced by Spark's dynamic
partition overwrite, which swaps files in at job commit; a table format with transactions can take
over by passing another `merge` function.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.functions.times import AsOf, as_of_column, shift, within_lookback
from tillstream.operators.dedup import deduplicate
from tillstream.operators.joins import orphans
from tillstream.session import file_system, is_single_file, scratch_path

DAY = "event_date"
#: most ids of a batch that are broadcast
MAX_BROADCAST_IDS = 500_000
#: most ids of a batch that go to the scan as values, where Parquet's Bloom filters skip row groups without them
MAX_PUSHED_IDS = 200
#: values of one IN list; Spark hands longer lists to Parquet as a range only
IN_LIST = 10
#: ids a row group's Bloom filter is made for
BLOOM_IDS = 1_000_000
TARGET_FILE_BYTES = 256 * 1024 * 1024


def has_table(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds at least one data partition or file."""
    fs, folder = file_system(spark, path)
    return fs.exists(folder) and any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(folder))


def _with_day(df: DataFrame, time: str) -> DataFrame:
    return df.withColumn(DAY, F.to_date(time))


def _days(df: DataFrame) -> list:
    """The dates a batch touches: bounded by the calendar, not by the rows."""
    return [r[0] for r in df.select(DAY).distinct().collect()]


def _in_days(days: list) -> Column:
    """Rows of some dates; None stands for rows without a date."""
    found = F.col(DAY).isin([d for d in days if d is not None])
    return found | F.col(DAY).isNull() if None in days else found


def _folder(path: str, day) -> str:
    """Where Spark keeps a date's rows."""
    return f"{path}/{DAY}={'__HIVE_DEFAULT_PARTITION__' if day is None else day.isoformat()}"


def write_by_day(
    df: DataFrame,
    path: str,
    mode: str = "append",
    needed: list | None = None,
    key: str | None = None,
    row_group_bytes: int | None = None,
) -> None:
    """Write partitioned by `event_date`. The rebalance lets AQE split a heavy day over several
    files and merge light ones, instead of one file per task and day.

    `needed` (date, files) fixes how many files a date gets at most instead. With a `key`, files are sorted by it and
    each row group has a Bloom filter of it, so that `stored_ids` reads only the row groups that may hold an id.
    """
    dealt = df.hint("rebalance", DAY)
    if needed is not None:
        files = df.sparkSession.createDataFrame([(r[0], r[1]) for r in needed], "_day date, _files int")
        dealt = df.join(F.broadcast(files), F.col(DAY).eqNullSafe(F.col("_day")))
        dealt = dealt.withColumn("_file", F.pmod(F.xxhash64(*df.columns), F.col("_files")))
        dealt = dealt.repartition(max(1, sum(r[1] for r in needed)), DAY, "_file").drop("_day", "_files", "_file")
    if key is not None:
        dealt = dealt.sortWithinPartitions(DAY, key)
    writer = dealt.write.mode(mode).partitionBy(DAY)
    if key is not None:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{key}", str(BLOOM_IDS))
    if row_group_bytes is not None:
        writer = writer.option("parquet.block.size", str(row_group_bytes))
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def read_by_day(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(DAY)


# ---- sinks ---------------------------------------------------------------------------------


def append_dedup(
    batch: DataFrame, path: str, key: str = "txn_id", time: str = "timestamp", whole_table: bool = True
) -> None:
    """Append rows whose id is neither NULL nor stored yet; the first of equal ids in the batch by
    time stays. `whole_table=False` looks for stored ids in the batch's own dates only, for feeds
    whose repeats carry the same time. Replaying a batch adds nothing."""
    spark = batch.sparkSession
    keyed = _with_day(batch.where(F.col(key).isNotNull()), time)
    fresh = deduplicate(keyed, key, [F.col(time).asc_nulls_last()])
    if has_table(spark, path):
        stored = spark.read.parquet(path)
        if not whole_table:
            stored = stored.where(_in_days(_days(keyed)))
        fresh = fresh.join(stored_ids(stored, keyed, key), key, "left_anti")
    write_by_day(fresh, path, key=key)


def stored_ids(stored: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """The batch's ids that are stored already; one pass over the batch finds how many ids it has.

    Few ids go to the scan as values: row groups whose Bloom filter has none of them are not read. More are
    sent to the scan of the id column as a table, so the stored table is not shuffled; a batch larger than what
    may be broadcast is joined by a shuffle. The result is the same.
    """
    ids = batch.select(key).distinct()
    few = [r[0] for r in ids.limit(MAX_PUSHED_IDS + 1).collect()]
    if len(few) <= MAX_PUSHED_IDS:
        lists = [F.col(key).isin(few[k : k + IN_LIST]) for k in range(0, len(few), IN_LIST)]
        asked = functools.reduce(lambda a, b: a | b, lists) if lists else F.lit(False)
        return stored.select(key).where(asked).distinct()
    if ids.limit(MAX_BROADCAST_IDS + 1).count() <= MAX_BROADCAST_IDS:
        ids = F.broadcast(ids)
    return stored.select(key).join(ids, key, "left_semi").distinct()


def latest_per_key(batch: DataFrame, keys: Sequence[str], arrival: str) -> DataFrame:
    """One row per key; each field takes its last non-null value by arrival."""
    fields = [c for c in batch.columns if c not in (*keys, arrival)]
    newest = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(arrival))).alias(c) for c in fields]
    return batch.dropna(subset=list(keys)).groupBy(*keys).agg(*newest)


def merge_fields(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer merge: fields of `new` win where they are set."""
    fields = [c for c in old.columns if c not in keys]
    renamed = new.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in new.columns if c not in keys])
    joined = old.join(renamed, list(keys), "full")
    merged = [F.coalesce(f"_new_{c}", c).alias(c) if c in new.columns else F.col(c) for c in fields]
    return joined.select(*keys, *merged)


def upsert_by_key(
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    time: str,
    arrival: str,
    merge: Callable[[DataFrame, DataFrame, Sequence[str]], DataFrame] = merge_fields,
) -> None:
    """Insert or update by key in the touched date partitions. Rows with a NULL key are skipped.

    `time` must be one of the keys: then a key always lives in the same partition.
    """
    if time not in keys:
        raise ValueError("the partitioning time must be part of the key")
    spark = batch.sparkSession
    newest = latest_per_key(batch, keys, arrival)
    if has_table(spark, path):
        days = _days(_with_day(newest, time))
        if not days:
            return
        touched = spark.read.parquet(path).where(F.col(DAY).isin(days)).drop(DAY)
        newest = merge(touched, newest, keys)
    write_by_day(_with_day(newest, time), path, "overwrite")


def export_snapshot(
    df: DataFrame, schema: str, path: str, as_of: AsOf, lookback_days: int = 90, time: str = "timestamp"
) -> None:
    """Recent rows as Parquet in a fixed schema, sorted by time across and inside the files.

    `location` is flattened if present; columns that are missing become NULL, others are left out.
    A row hash takes part in the ranges, so a time shared by many rows is split over several files.
    """
    if "location" in df.columns:
        df = df.withColumns({"location_lat": F.col("location.lat"), "location_lon": F.col("location.lon")})
    rows = snapshot_projection(df, schema, as_of, lookback_days, time)
    ranged = rows.repartitionByRange(F.col(time), F.xxhash64(*rows.columns)).sortWithinPartitions(time)
    ranged.write.mode("overwrite").option("compression", "snappy").parquet(path)


def snapshot_projection(df: DataFrame, schema: str, as_of: AsOf, lookback_days: int = 90, time: str = "timestamp"):
    wanted = df.sparkSession.createDataFrame([], schema).schema
    cells = [
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in wanted
    ]
    return df.where(within_lookback(time, as_of, lookback_days)).select(*cells)


def materialize(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """A model as a temporary view, or as Parquet at `path` (full refresh) with a view over it."""
    if path is not None:
        df.write.mode("overwrite").parquet(path)
        df = df.sparkSession.read.parquet(path)
    df.createOrReplaceTempView(name)
    return df


# ---- maintenance ---------------------------------------------------------------------------


def purge(spark: SparkSession, path: str, as_of: AsOf, days: int = 90, time: str = "timestamp") -> int:
    """Drop rows older than the retention and return how many. Whole dates before the cut are
    dropped as folders; only the boundary date is rewritten."""
    stored = spark.read.parquet(path)
    cutoff = shift(as_of_column(as_of), "day", -days)
    old = F.col(time) < cutoff
    counts = stored.where(F.col(DAY) <= F.to_date(cutoff)).groupBy(DAY)
    by_day = counts.agg(F.count_if(old).alias("old"), F.count("*").alias("rows")).where("old > 0").collect()
    for day in (r[DAY] for r in by_day if r["old"] < r["rows"]):
        write_by_day(stored.where((F.col(DAY) == F.lit(day)) & ~old), path, "overwrite")
    for day in (r[DAY] for r in by_day if r["old"] == r["rows"]):
        fs, folder = file_system(spark, f"{path}/{DAY}={day.isoformat()}")
        fs.delete(folder, True)
    return sum(r["old"] for r in by_day)


def remove_orphans(
    spark: SparkSession, path: str, transactions: DataFrame, key: str = "txn_id", limit: int | None = None
) -> int:
    """Drop stored rows whose id is not in `transactions`; `limit` caps the rows removed per run."""
    stored = spark.read.parquet(path)
    missing = orphans(stored.select(key, DAY).distinct(), transactions, key, limit)
    listed = scratch_path(spark, "orphans")
    missing.write.parquet(listed)
    missing = spark.read.parquet(listed)
    touched = _days(missing)
    if not touched:
        return 0
    hit = stored.where(_in_days(touched))
    # Rows without a time have no date; they are orphans like any others.
    missing = missing.select(F.col(key).alias("_orphan"), F.col(DAY).alias("_orphan_day"))
    same = (F.col(key) == F.col("_orphan")) & F.col(DAY).eqNullSafe(F.col("_orphan_day"))
    removed = hit.join(missing, same, "left_semi").count()
    kept = hit.join(missing, same, "left_anti")
    emptied = set(touched) - set(_days(kept))
    write_by_day(kept, path, "overwrite")
    for day in emptied:
        fs, folder = file_system(spark, _folder(path, day))
        fs.delete(folder, True)
    return removed


def file_listing(spark: SparkSession, path: str) -> DataFrame:
    """file_path and bytes of a table's Parquet files, as tasks list them: no file is opened."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if not is_single_file(spark, path):
        reader = reader.option("pathGlobFilter", "*.parquet")
    return reader.load(path).select(F.col("path").alias("file_path"), F.col("length").alias("bytes"))


def _day_of(file_path: str) -> Column:
    """The date of the folder that a file lies in; NULL for rows without a date."""
    return F.regexp_extract(file_path, f"/{DAY}=([^/]+)/", 1).try_cast("date")


def table_stats(tables: Mapping[str, DataFrame | str]) -> DataFrame:
    """Rows, files, bytes and average row size of tables. Of a table that is given by its path, files are
    listed and rows are counted from their footers; of a DataFrame over files, its rows name the files."""
    out = None
    for name, source in tables.items():
        if isinstance(source, str):
            spark = SparkSession.getActiveSession()
            listed = file_listing(spark, source).agg(F.count("*").alias("file_count"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("total_bytes"))
            counted = spark.read.parquet(source).agg(F.count("*").alias("row_count"))
            stats = counted.join(F.broadcast(listed)).select(F.lit(name).alias("table_name"), "row_count", "file_count", "total_bytes")
        else:
            files = source.select("_metadata.file_path", "_metadata.file_size").groupBy("file_path", "file_size")
            stats = files.agg(F.count("*").alias("rows")).agg(
                F.lit(name).alias("table_name"),
                F.coalesce(F.sum("rows"), F.lit(0)).alias("row_count"),
                F.count("*").alias("file_count"),
                F.coalesce(F.sum("file_size"), F.lit(0)).alias("total_bytes"),
            )
        stats = stats.withColumn("avg_row_bytes", F.col("total_bytes") / F.nullif("row_count", F.lit(0)))
        out = stats if out is None else out.unionAll(stats)
    return out


def compact(spark: SparkSession, path: str, target_bytes: int = TARGET_FILE_BYTES) -> int:
    """Rewrite the dates that hold more files than their size needs; returns how many dates."""
    stored = spark.read.parquet(path)
    files = file_listing(spark, path).withColumn(DAY, _day_of("file_path"))
    by_day = files.groupBy(DAY).agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))
    needed = by_day.select(DAY, F.greatest(F.lit(1), F.ceil(F.col("bytes") / target_bytes)).cast("int").alias("needed"), "files")
    needed = needed.where("files > needed").drop("files").collect()
    crowded = [r[DAY] for r in needed]
    if crowded:
        write_by_day(stored.where(_in_days(crowded)), path, "overwrite", needed)
    return len(crowded)
