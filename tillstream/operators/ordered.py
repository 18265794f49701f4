"""Neighbours in a global order without putting all rows in one task, and slices of such an order.

A window without a partition, or one over a key that holds most rows, runs in a single task. Here rows are
range-partitioned by the whole order and sorted, and each task finds the neighbours in its slice on its own. Only
the edge rows cross over: the plan reads the same shuffled slices a second time for them (Spark runs one exchange for
both), takes one row of each, and joins it to the open end of the slice beside it. Range bounds are values of
the data, so no slice but the last can be empty. Nothing is counted beforehand and the form is the same at any size.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.session import pinned

#: rows one task may take in a single sorted group before the sliced form is used
HOT_ROWS = 20_000_000
#: bounds of the number of slices, for any size of a hot group
SLICE_ROWS, SLICES_PER_PARTITION = 1_000_000, 4


def slices_for(spark: SparkSession, rows: int, hot_rows: int) -> int:
    """Enough slices that each holds about `hot_rows` at most, and never fewer than the shuffle uses. Small
    `hot_rows` make no more than `SLICES_PER_PARTITION` slices a shuffle partition as long as these hold at most
    `SLICE_ROWS` rows: every task reports to the driver, and range bounds are sampled for every slice."""
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if not hot_rows:
        return usual
    return max(usual, min(-(-rows // hot_rows), max(SLICES_PER_PARTITION * usual, -(-rows // SLICE_ROWS))))


def sorted_slices(df: DataFrame, order: Sequence[str], slices: int) -> DataFrame:
    """Rows with a `_slice` number; every row of a slice sorts before all rows of the next. They are written to the
    shared folder, for plans that read them in different ways."""
    ranged = df.repartitionByRange(slices, *order)
    return pinned(ranged.withColumn("_slice", F.spark_partition_id()))


def _beside(offset: int, order: Sequence[str], name: str):
    """The function of a task: sorted rows in, the same rows with their neighbour in the slice out."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        held: tuple[pa.RecordBatch, pa.StructArray] | None = None
        before: pa.StructArray | None = None

        def out(batch: pa.RecordBatch, row: pa.StructArray, after: pa.StructArray | None) -> pa.RecordBatch:
            n = batch.num_rows
            outside = after if offset == 1 else before
            outside = outside if outside is not None else pa.nulls(1, row.type)
            near = pa.concat_arrays([row[1:], outside] if offset == 1 else [outside, row[:-1]])
            # The row whose neighbour lies in another slice, and the one that is such a neighbour.
            last = [after is None and k == n - 1 for k in range(n)]
            first = [before is None and k == 0 for k in range(n)]
            flags = (last, first) if offset == 1 else (first, last)
            columns = [*batch.columns, near, pa.array([number] * n, pa.int32()), *(pa.array(f) for f in flags)]
            return pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, name, "_slice", "_open", "_edge"])

        for batch in batches:
            if not batch.num_rows:
                continue
            row = pa.StructArray.from_arrays([batch.column(c) for c in order], names=list(order))
            if held is not None:
                yield out(*held, row[:1])
                before = held[1][-1:]
            held = batch, row
        if held is not None:
            yield out(*held, None)

    return place


def with_neighbour(
    df: DataFrame, order: Sequence[str], offset: int, name: str, within: Sequence[str] = (), slices: int | None = None
) -> DataFrame:
    """Add `name`: the `order` columns of the next (+1) or previous (-1) row as a struct.

    `within` must lead `order`; the neighbour is NULL where it lies in another group. The order must be
    unique, and its columns sort ascending with NULLs first. There are as many slices as the session has shuffle
    partitions, or `slices`.
    """
    if offset not in (-1, 1):
        raise ValueError("offset must be 1 or -1")
    if list(order[: len(within)]) != list(within):
        raise ValueError("order must start with the grouping columns")
    spark = df.sparkSession
    if spark.conf.get("spark.sql.exchange.reuse", "true") != "true":
        raise RuntimeError("neighbours need spark.sql.exchange.reuse: both reads must see the same slices")
    slices = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    row_type = T.StructType([df.schema[c] for c in order])
    flags = [T.StructField("_slice", T.IntegerType()), T.StructField("_open", T.BooleanType()), T.StructField("_edge", T.BooleanType())]
    schema = T.StructType([*df.schema.fields, T.StructField(name, row_type), *flags])
    sliced = df.repartitionByRange(slices, *order).sortWithinPartitions(*order).mapInArrow(_beside(offset, order, name), schema)
    # One row per slice, whatever the number of rows.
    edges = sliced.where("_edge").select((F.col("_slice") - offset).alias("_for"), F.struct(*order).alias("_far"))
    joined = sliced.join(F.broadcast(edges), F.col("_open") & (F.col("_slice") == F.col("_for")), "left")
    near = F.coalesce(F.col(name), F.col("_far"))
    same_group = F.lit(True)
    for c in within:
        same_group = same_group & F.col(c).eqNullSafe(near.getField(c))
    return joined.select(*df.columns, F.when(same_group, near).alias(name))
