"""Exact duplicates by content-defined chunk recipes.

A text is cut where a rolling hash of its last 32 bytes says so, each chunk gets a 64-bit identifier,
and the document becomes an ordered list of identifiers, its recipe. Identifiers are verified: the
distinct (identifier, SHA-256) pairs are counted once for the whole table, and where one identifier
stands for several contents, each content gets a number of its own. Equal recipes are equal texts, so
from then on only recipes move, about a hundredth of the text; no text is shuffled at all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstream.llm.registry import query, table
from tillstream.llm.words import pieces, text_buffer

#: chunk lengths in bytes; the mean is about LEAST + 2^MASK_BITS
LEAST, MASK_BITS, MOST = 512, 10, 8192
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GEAR = np.random.default_rng(6).integers(0, 1 << 32, 256, dtype=np.uint32)


def boundaries(data: np.ndarray) -> np.ndarray:
    """Positions after which the rolling hash of the last 32 bytes ends a chunk. The hash of 2n bytes
    is made of two hashes of n bytes, so five passes over the array do."""
    rolled = _GEAR[data]
    for k in (1, 2, 4, 8, 16):
        longer = rolled.copy()
        longer[k:] += rolled[:-k] << np.uint32(k)
        rolled = longer
    return np.flatnonzero(rolled >> np.uint32(32 - MASK_BITS) == 0) + 1


def cuts(marks: np.ndarray, low: int, high: int) -> list[int]:
    """Ends of the chunks of the text [low, high): the first mark at least LEAST bytes on, MOST bytes at most.

    A mark counts only with 32 bytes of the same text before it, so equal texts get equal chunks.
    """
    out, at = [], low
    marks = marks[np.searchsorted(marks, low + LEAST) : np.searchsorted(marks, high)]
    i = 0
    while high - at > LEAST:
        i += int(np.searchsorted(marks[i:], at + LEAST))
        end = min(int(marks[i]) if i < len(marks) else high, at + MOST, high)
        out.append(end)
        at = end
    if at < high or not out:
        out.append(high)
    return out


def chunk_rows(docs: DataFrame) -> DataFrame:
    """One row per chunk: the row's key (doc_id and SHA-256 of the text), seq, id, and the chunk's own
    SHA-256 and length. An empty text has one empty chunk."""
    schema = "doc_id long, text_sha256 binary, seq int, id long, sha256 binary, n_bytes int"

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            ids = batch.column("doc_id").to_pylist()
            for low, high in pieces(offsets):
                out = []
                part = data[offsets[low] : offsets[high]]
                marks, raw = boundaries(part), part.tobytes()
                for row in range(low, high):
                    a, b = offsets[row] - offsets[low], offsets[row + 1] - offsets[low]
                    key = hashlib.sha256(raw[a:b]).digest()
                    at = int(a)
                    for seq, end in enumerate(cuts(marks, int(a), int(b))):
                        chunk = raw[at:end]
                        number = xxhash.xxh64_intdigest(chunk) - (1 << 63)
                        out.append((ids[row], key, seq, number, hashlib.sha256(chunk).digest(), end - at))
                        at = end
                kinds = [pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.binary(), pa.int32()]
                columns = [pa.array(c, type=k) for c, k in zip(zip(*out), kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_sha256", "seq", "id", "sha256", "n_bytes"])

    normal = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), normal.alias("text")).mapInArrow(chunks, schema)


def chunk_store(chunks: DataFrame) -> DataFrame:
    """The distinct chunks: id, sha256, n_bytes, n_uses, and `clash`: 0 for the first content of an
    identifier, 1 and up for others."""
    store = chunks.groupBy("id", "sha256").agg(F.first("n_bytes").alias("n_bytes"), F.count(F.lit(1)).alias("n_uses"))
    return store.withColumn("clash", F.row_number().over(Window.partitionBy("id").orderBy("sha256")) - 1)


def recipes(docs: DataFrame) -> DataFrame:
    """One row per distinct (doc_id, text): the ordered list of verified identifiers and n_rows, how
    often the row comes."""
    chunks = chunk_rows(docs)
    clashes = chunk_store(chunks).where("clash > 0").select("id", "sha256", "clash")
    verified = chunks.join(clashes, ["id", "sha256"], "left")
    # Repeated rows have equal chunks, which the set keeps once.
    item = F.struct("seq", F.struct("id", F.coalesce("clash", F.lit(0)).alias("clash")).alias("verified"))
    rows = verified.groupBy("doc_id", "text_sha256").agg(
        F.sort_array(F.collect_set(item)).alias("items"), F.count(F.when(F.col("seq") == 0, 1)).alias("n_rows")
    )
    return rows.select("doc_id", "text_sha256", F.col("items.verified").alias("recipe"), "n_rows")


def duplicate_groups(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, keep_id (the largest doc_id with an equal text), group_size,
    kept, text_sha256.

    Texts are equal when they are identical after lower-casing A-Z; null counts as empty. Rows that
    repeat a doc_id and its text are all reported; of those with the largest doc_id all are marked
    as kept, as they cannot be told apart. Rows without a doc_id sort below all others; they are kept
    only if no row of their text has one. Other columns are ignored.
    """
    rows = recipes(docs)
    groups = rows.groupBy("recipe").agg(F.max("doc_id").alias("keep_id"), F.sum("n_rows").alias("group_size"))
    found = rows.join(groups, "recipe")
    found = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n_rows").cast("int"))))
    return found.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("text_sha256")).alias("text_sha256"),
    )


SQL = f"""
with normal as (
  select doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) as text_sha256 from documents
)
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
       doc_id = max(doc_id) over w as kept, text_sha256
from normal window w as (partition by text_sha256)
"""


@query("op6_exact_dedup", SQL)
def op6_exact_dedup(spark, sf_dir):
    """Groups of documents with equal texts."""
    return duplicate_groups(table(spark, sf_dir, "documents"))
