"""The state of a scoring job, read from its checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stored_moments(spark: SparkSession, checkpoint: str, batch_id: int | None = None, operator_id: int = 0) -> DataFrame:
    """user_id, n, mean and m2 (the sum of squared deviations) that the job holds per user after its last
    committed micro-batch, or after `batch_id`. The job need not run; nothing is changed."""
    reader = spark.read.format("statestore").option("operatorId", operator_id)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    held = reader.load(checkpoint).select("value.groupState.*")
    fields = [F.col(c) for c in ("keys", "n", "mean", "m2")]
    each = held.select(F.inline(F.arrays_zip(*fields)))
    return each.withColumnRenamed("keys", "user_id")
