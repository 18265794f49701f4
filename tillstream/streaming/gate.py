"""What a stream may trust: readable texts, possible event times, rows that are not too late.

One wrong event time moves a watermark for good, so texts pass this gate before any job that has one. The
gate writes clean rows as a feed of its own, one folder per micro-batch, and everything else beside it
with the reason. Each folder appears whole or not at all and is written once: a micro-batch that runs again
after a crash finds what it had written and leaves it, and readers never see half of one.

Times are judged by the spread of those that came with them. A time is possible up to `factor` times the way from
the first quartile to the median after the median, `floor_seconds` at least, or as long as `floor_seconds` after the highest time
accepted before; wrong times above the median have no part in that. A
wrong unit is a thousandfold too large and lies far beyond. Small micro-batches are judged together with the last times before them; since those are
kept as received, a real jump of the clock is accepted as soon as it is the majority. Old times are
never refused: they move no watermark, and the window they belong to decides whether they are late.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillstream.session import apply_state_settings, file_system
from tillstream.sources import codecs

FACTOR, FLOOR_SECONDS = 10.0, 2 * 86_400
#: received times that are kept for judging the next micro-batch
KEPT_TIMES = 400
#: the largest time a timestamp can hold
MOST_MICROS = (1 << 63) - 1
BATCH = "batch_id"


# ---- outputs that are written once ---------------------------------------------------------


def batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/{BATCH}={batch_id}"


def is_written(spark: SparkSession, path: str, batch_id: int) -> bool:
    fs, folder = file_system(spark, batch_folder(path, batch_id))
    return fs.exists(folder)


def write_once(rows: DataFrame, path: str, batch_id: int) -> bool:
    """Write a micro-batch's rows unless they are there. The files are made in a hidden folder that is
    renamed at the end; what an earlier attempt left in it is overwritten. Returns whether rows were written."""
    spark = rows.sparkSession
    if is_written(spark, path, batch_id):
        return False
    pending = f"{path}/_pending/{BATCH}={batch_id}"
    rows.write.mode("overwrite").parquet(pending)
    fs, source = file_system(spark, pending)
    _, target = file_system(spark, batch_folder(path, batch_id))
    if not fs.rename(source, target):
        raise RuntimeError(f"{pending} could not be moved to its place")
    return True


# ---- event times ---------------------------------------------------------------------------


def latest_possible(times: DataFrame, factor: float = FACTOR, floor_seconds: int = FLOOR_SECONDS) -> int | None:
    """The last possible time, in microseconds, by the spread of `time_us`; None without any time."""
    low, middle = times.agg(F.percentile_approx("time_us", [0.25, 0.5], 10_000).alias("q")).first()["q"] or (None, None)
    if middle is None:
        return None
    return min(middle + max(int(factor * (middle - low)), floor_seconds * 1_000_000), MOST_MICROS)


def split_by_time(
    rows: DataFrame, time: str = "timestamp", factor: float = FACTOR, floor_seconds: int = FLOOR_SECONDS
) -> tuple[DataFrame, DataFrame]:
    """(rows whose time is possible or missing, the others) of a table, by the spread of its own times."""
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    latest = latest_possible(rows.select(micros.alias("time_us")), factor, floor_seconds)
    possible = F.lit(True) if latest is None else F.coalesce(micros <= latest, F.lit(True))
    return rows.where(possible), rows.where(~possible)


def _received(spark: SparkSession, times: DataFrame, path: str, batch_id: int) -> DataFrame:
    """The times of this micro-batch, filled up with those kept before it where it is small; kept for the next."""
    if not is_written(spark, path, batch_id):
        now = times.where("time_us is not null").withColumn("age", F.lit(0))
        if batch_id > 0 and is_written(spark, path, batch_id - 1):
            before = spark.read.schema("time_us long, age int").parquet(batch_folder(path, batch_id - 1))
            now = now.unionByName(before.select("time_us", (F.col("age") + 1).alias("age")))
        # Drawn by hash, so a replay keeps the same.
        write_once(now.orderBy("age", F.xxhash64("time_us"), "time_us").limit(KEPT_TIMES).coalesce(1), path, batch_id)
    kept = spark.read.schema("time_us long, age int").parquet(batch_folder(path, batch_id))
    return times.select("time_us").unionAll(kept.where("age > 0").select("time_us"))


# ---- the job -------------------------------------------------------------------------------


def window_closed(time: str, watermark_us: int | None, size_seconds: int) -> Column:
    """Whether a row's tumbling window has ended at the watermark."""
    if watermark_us is None:
        return F.lit(False)
    end = F.window(time, f"{size_seconds} seconds")["end"]
    return F.coalesce(F.unix_micros(end) <= F.lit(watermark_us), F.lit(False))


def clean_transactions(
    text: DataFrame,
    root: str,
    checkpoint: str,
    factor: float = FACTOR,
    floor_seconds: int = FLOOR_SECONDS,
    lateness_seconds: int = 5,
    size_seconds: int = 86_400,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Texts of transactions to `root`/clean (typed, with `is_late`), `root`/late (the late ones again) and
    `root`/quarantine (value, reason: `unreadable` or `impossible time`). Every text is in clean or in quarantine.

    A row is late if its window had ended, `lateness_seconds` before the highest clean time of the micro-batches
    before its own. Late rows stay in the clean feed, since they are scored when they arrive; window jobs leave them out.
    """
    apply_state_settings(text.sparkSession)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # Parsed once for all outputs; lost blocks are read from the source again.
        texts = codecs.read_transactions(batch.select("value")).withColumn("time_us", F.unix_micros("timestamp")).persist()
        rows, unreadable = texts.where("usable").drop("usable"), texts.where("not usable").select("value")
        received = _received(spark, rows.select("time_us"), f"{root}/times", batch_id)
        before = highest_time(spark, root, batch_id - 1)
        latest = latest_possible(received, factor, floor_seconds)
        if before is not None and latest is not None:
            latest = max(latest, before + floor_seconds * 1_000_000)
        possible = F.lit(True) if latest is None else F.coalesce(F.col("time_us") <= latest, F.lit(True))
        bad = unreadable.select("value", F.lit("unreadable").alias("reason"))
        bad = bad.unionByName(rows.where(~possible).select("value", F.lit("impossible time").alias("reason")))
        write_once(bad, f"{root}/quarantine", batch_id)
        watermark = None if before is None else before - lateness_seconds * 1_000_000
        clean = rows.where(possible).drop("value", "time_us").withColumn("is_late", window_closed("timestamp", watermark, size_seconds))
        write_once(clean.where("is_late"), f"{root}/late", batch_id)
        high = rows.where(possible).agg(F.greatest(F.max("time_us"), F.lit(before).cast("long")).alias("high_us"))
        write_once(high.coalesce(1), f"{root}/high", batch_id)
        # Last: a reader that sees the clean rows finds all the rest in place.
        write_once(clean, f"{root}/clean", batch_id)
        texts.unpersist()

    writer = text.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def highest_time(spark: SparkSession, root: str, batch_id: int) -> int | None:
    """The highest clean time up to a micro-batch, in microseconds; each stores one row."""
    if batch_id < 0:
        return None
    return spark.read.schema("high_us long").parquet(batch_folder(f"{root}/high", batch_id)).first()[0]


def written(spark: SparkSession, root: str, part: str) -> DataFrame:
    """The rows of one output of the gate, with their micro-batch."""
    return spark.read.parquet(f"{root}/{part}")
