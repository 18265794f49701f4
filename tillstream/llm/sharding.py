"""Contiguous shards with the smallest possible largest shard.

Groups of equal texts are atomic. In the order of their first document they form a line of sizes,
and a shard is a stretch of that line. The smallest capacity for which greedy filling needs no more
than `shards` stretches is found by binary search. A step of the search only asks "which group ends
last before byte x of the line?". The driver answers from a bounded index of the line: runs of group
ends, refined with one aggregate over the line wherever an answer falls inside a run.

The cuts are then placed as near to equal shares as the capacity allows, so that shards stay near
equal even where one huge group sets the capacity.
"""

from __future__ import annotations

import bisect
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstream.llm.registry import query, stored, table

SHARDS = 40
#: runs of group ends in the driver's first index, and parts into which a run is refined
RUNS, FINER = 1 << 14, 1 << 8
#: bytes counted for a document besides its text
OVERHEAD = 16


class Line:
    """Ends of groups on the line of bytes, known exactly where it was asked for.

    `fetch(ranges)` gives (first end, last end, number of ends) of the non-empty pieces of each range
    (low, high], a bounded number for each.
    """

    def __init__(self, total: int, fetch: Callable[[list[tuple[int, int]]], list[tuple[int, int, int]]]):
        self.total, self.fetch = total, fetch
        self.runs = sorted(fetch([(0, total)])) if total else []
        self.firsts = [r[0] for r in self.runs]
        self.unsure: set[int] = set()

    def _run(self, x: int) -> int:
        return bisect.bisect_right(self.firsts, x) - 1

    def floor(self, x: int, up: bool) -> int:
        """The last end at or before x. Inside a run that is not resolved, a bound instead: the
        highest possible one (up) or the lowest."""
        i = self._run(x)
        if i < 0:
            return 0
        first, last, n = self.runs[i]
        if x >= last:
            return last
        if n <= 2:
            return first
        self.unsure.add(i)
        return x if up else first

    def refine(self) -> None:
        """Resolve the runs that were asked about, all in one aggregate."""
        asked = sorted(self.unsure)
        self.unsure.clear()
        new = self.fetch([(self.runs[i][0] - 1, self.runs[i][1]) for i in asked])
        gone = set(asked)
        self.runs = sorted([r for i, r in enumerate(self.runs) if i not in gone] + new)
        self.firsts = [r[0] for r in self.runs]


def fits(line: Line, capacity: int, shards: int, up: bool) -> bool:
    """Does greedy filling cover the line with that capacity?"""
    at = 0
    for _ in range(shards):
        if at >= line.total:
            return True
        to = line.floor(at + capacity, up)
        if to <= at:
            return False
        at = to
    return at >= line.total


def least_capacity(line: Line, shards: int, largest: int) -> int:
    """The smallest capacity that works. Low answers prove that a capacity works, high answers that
    it does not; where neither settles it, the runs in question are refined."""
    low, high = max(largest, -(-line.total // shards)), line.total
    while low < high:
        middle = (low + high) // 2
        line.unsure.clear()
        if fits(line, middle, shards, up=False):
            high = middle
        elif not fits(line, middle, shards, up=True):
            low = middle + 1
        else:
            line.refine()
    return low


def exact_floor(line: Line, x: int) -> int:
    while True:
        line.unsure.clear()
        found = line.floor(x, up=False)
        if not line.unsure:
            return found
        line.refine()


def exact_next(line: Line, x: int) -> int:
    """The first end after x (the total if none)."""
    while True:
        i = line._run(x)
        if i >= 0 and x < line.runs[i][1]:
            first, last, n = line.runs[i]
            if n <= 2:
                return last
            line.unsure = {i}
            line.refine()
            continue
        return line.runs[i + 1][0] if i + 1 < len(line.runs) else line.total


def place_cuts(line: Line, shards: int, capacity: int) -> list[int]:
    """Ends of the first `shards` - 1 shards. Each is the end nearest to an equal share of what is left,
    within the capacity, and late enough for the rest to fit into the shards that follow."""
    latest_start = [line.total]  # from the right: where the last k shards can begin at the earliest
    for _ in range(shards - 1):
        at = latest_start[-1]
        if at <= capacity:
            latest_start.append(0)
            continue
        wanted = at - capacity
        start = exact_floor(line, wanted)
        latest_start.append(start if start == wanted else exact_next(line, wanted))
    cuts, at = [], 0
    for k in range(shards - 1):
        left = shards - 1 - k
        low = max(at, latest_start[left])
        high = max(low, exact_floor(line, at + capacity))
        share = at + -(-(line.total - at) // (left + 1))
        below = exact_floor(line, share)
        above = exact_next(line, share) if below < share else below
        at = min(max(below if share - below <= above - share else above, low), high)
        cuts.append(at)
    return cuts


def _pieces(ranges: list[tuple[int, int]], pieces: int):
    """Counts ends by range and piece within a batch; ranges are few, do not overlap and ascend."""
    low, high = (np.array([r[k] for r in ranges], dtype=np.int64) for k in (0, 1))
    step = np.maximum(1, -(-(high - low) // pieces))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            end = np.sort(batch.column("end").to_numpy(zero_copy_only=False))
            i = np.minimum(np.searchsorted(high, end), len(high) - 1)
            inside = (end > low[i]) & (end <= high[i])
            end, i = end[inside], i[inside]
            piece = (end - low[i] - 1) // step[i]
            new = np.flatnonzero((np.diff(i, prepend=-1) != 0) | (np.diff(piece, prepend=-1) != 0))
            last = np.append(new[1:], len(end)) - 1 if len(new) else new
            arrays = [i[new].astype(np.int32), piece[new], end[new], end[last], last - new + 1]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=["i", "piece", "a", "b", "n"])

    return count


def assign_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Put every row into one of `shards` shards, equal texts together.

    Returns doc_id, size (UTF-8 bytes and 16 more), text_crc32, shard, slot (gapless from 0 in each
    shard, by the group's first doc_id and then doc_id). A null text is equal to an empty one and has
    size 16. Rows without a doc_id come first in their group. Repeated rows get a slot each. With
    fewer groups than shards the last shards stay empty; an empty table gives no rows.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("group"),
    )
    groups = rows.groupBy("group").agg(F.min("doc_id").alias("first"))
    keys = [F.col("first").asc_nulls_first(), F.col("group"), F.col("doc_id").asc_nulls_first()]
    # Ordered by ranges and written once: the part and the place of a row are data from here on.
    ordered = rows.join(groups, "group").repartitionByRange(*keys).sortWithinPartitions(*keys)
    ordered = stored(ordered.withColumn("place", F.monotonically_increasing_id()), "shard-order")
    ordered = ordered.withColumn("part", F.shiftright("place", 33).cast("int"))

    # One row per part is added up on the driver.
    spark = docs.sparkSession
    sums = ordered.groupBy("part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    starts, total, n_rows = [], 0, 0
    for r in sums:
        starts.append((r["part"], total, n_rows))
        total, n_rows = total + r["bytes"], n_rows + r["n"]
    begin = spark.createDataFrame(starts, "part int, before_bytes long, before_rows long")
    inside = Window.partitionBy("part").orderBy("place")
    placed = ordered.join(F.broadcast(begin), "part").select(
        "doc_id", "size", "text_crc32", "first", "group",
        (F.sum("size").over(inside) + F.col("before_bytes")).alias("end"),
        (F.col("place") % (1 << 33) + F.col("before_rows")).alias("number"),
    )
    line_of = stored(
        placed.groupBy("first", "group").agg(F.max("end").alias("end"), F.sum("size").alias("size"), F.min("number").alias("number"), F.count(F.lit(1)).alias("n")),
        "shard-line",
    )
    largest = line_of.agg(F.max("size").alias("most")).first()["most"] or 0

    def fetch(ranges: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
        runs = line_of.select("end").mapInArrow(_pieces(ranges, RUNS if len(ranges) == 1 else FINER), "i int, piece long, a long, b long, n long")
        runs = runs.groupBy("i", "piece").agg(F.min("a").alias("a"), F.max("b").alias("b"), F.sum("n").alias("n"))
        return [(r["a"], r["b"], r["n"]) for r in runs.collect()]

    line = Line(total, fetch)
    cuts = place_cuts(line, shards, least_capacity(line, shards, largest)) if total else []
    # Rows before each cut: at most one group ends at a cut.
    ends = line_of.where(F.col("end").isin(cuts)).select("end", (F.col("number") + F.col("n")).alias("rows")).collect()
    rows_at = {0: 0} | {r["end"]: r["rows"] for r in ends}
    before = F.array(*[F.lit(c) for c in cuts]) if cuts else F.array().cast("array<long>")
    first_rows = F.array(*[F.lit(n).cast("long") for n in [0, *(rows_at[c] for c in cuts)]])
    # A group lies after the cuts that are not beyond its first byte, so before its end.
    number = F.size(F.filter(before, lambda c: c < F.col("end"))).cast("int")
    numbered = placed.select("doc_id", "size", "text_crc32", number.alias("shard"), "number")
    return numbered.select("doc_id", "size", "text_crc32", "shard", (F.col("number") - F.get(first_rows, F.col("shard"))).alias("slot"))


@query("op2_sharding")
def op2_sharding(spark, sf_dir):
    """All documents in 40 shards of near equal bytes."""
    placed = assign_shards(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
