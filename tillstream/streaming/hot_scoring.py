"""Scoring of a stream in which one user may send most of a micro-batch.

The keyed state function gives all rows of a user to one task. Here a micro-batch is a table: each user's moments
of the batch are summed partially before the shuffle, merged with the stored moments of the batches before, and rows
are scored by `continued_zscore`, which spreads a hot user over slices of the event order and adds to every slice
what came before it. Stored moments are one folder per micro-batch with the users it touched; every `SNAPSHOT`
batches all users are written together, so a look-up reads one snapshot and a bounded number of folders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillstream.operators.running import MOMENTS, continued_zscore, merged_moments, totals_per_key
from tillstream.streaming.gate import BATCH, batch_folder, write_once

#: rows of a user in a micro-batch above which they are spread
HOT_BATCH_ROWS = 100_000
#: micro-batches between two snapshots of all moments
SNAPSHOT = 16


def moments_before(spark: SparkSession, root: str, base: int, batch_id: int, schema: str) -> DataFrame:
    """The moments of every key after the micro-batches before this one, from the snapshot at `base` (none at 0)
    and the folders since."""
    parts = [(batch_folder(f"{root}/snapshots", base), base - 1)] if base else []
    parts += [(batch_folder(f"{root}/moments", number), number) for number in range(base, batch_id)]
    known = spark.createDataFrame([], f"{schema}, {BATCH} int")
    for folder, number in parts:
        known = known.unionByName(spark.read.schema(schema).parquet(folder).withColumn(BATCH, F.lit(number)))
    key = known.columns[0]
    return known.groupBy(key).agg(F.max_by(F.struct(*MOMENTS), BATCH).alias("m")).select(key, "m.*")


def score_hot(
    transactions: DataFrame,
    root: str,
    checkpoint: str,
    key: str = "user_id",
    order: Sequence[str] = ("timestamp", "txn_id"),
    value: str = "amount",
    threshold: float = 3.0,
    hot_rows: int = HOT_BATCH_ROWS,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Scored rows of a stream in `root`/scored, and the keys' moments beside them.

    As in `score_stream`, micro-batches are scored in the order they arrive, rows of one in `order`, and a missing
    value counts as 0. A micro-batch that runs again changes nothing that it has written.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        schema = f"{key} {batch.schema[key].dataType.simpleString()}, _n long, _mean double, _m2 double"
        base = batch_id // SNAPSHOT * SNAPSHOT
        if base and base == batch_id:
            write_once(moments_before(spark, root, base - SNAPSHOT, base, schema), f"{root}/snapshots", base)
        before = moments_before(spark, root, base, batch_id, schema)
        now = totals_per_key(batch, key, value)
        known = before.select(F.col(key).alias("_known"), *[F.col(c).alias(f"{c}0") for c in MOMENTS])
        both = now.join(known, F.col(key).eqNullSafe(F.col("_known")), "left")
        merged = merged_moments(*[F.col(f"{c}0") for c in MOMENTS], *[F.col(c) for c in MOMENTS])
        write_once(both.select(key, *merged), f"{root}/moments", batch_id)
        start = before.join(now.select(F.col(key).alias("_now")), F.col(key).eqNullSafe(F.col("_now")), "left_semi")
        write_once(continued_zscore(batch, start, key, order, value, threshold, hot_rows), f"{root}/scored", batch_id)

    writer = transactions.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
