"""Near duplicates by ProbMinHash on weighted word shingles.

The weight of a shingle is how often it occurs. Every shingle is a Poisson process with its weight as
rate; each arrival falls into one of the signature's registers, a register keeps the shingle that
arrived first, and a shingle's process ends when its next arrival is later than all registers of the
document. Two registers agree with the probability Jaccard similarity of the documents.

Signatures are banded. Equal texts are one node. In a bucket no pairs are formed at first: each node is
compared with the bucket's most popular node, which for copies of one original is the original
(popularity: the sizes of all buckets a node is in). Verified links join nodes to components. In buckets
that still hold several components, the sketches of all nodes of different components are compared, block
by block so that no task holds a hot bucket; only pairs whose sketches agree enough become rows. A link is
verified on the whole texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.registry import normal_words, query, stored, table
from tillstream.llm.words import (
    mixed,
    pieces,
    rows_of_words,
    text_buffer,
    whole_windows,
    window_hashes,
    word_hashes,
    word_spans,
)

#: words of a shingle, least similarity of a link
WORDS, SIMILARITY = 5, 0.8
#: bands and registers of a band: a pair at the least similarity is missed with probability 2.6e-5
BANDS, ROWS = 20, 4
#: registers of a signature, a prime; all of them, as one byte each, are the sketch that pairs are compared by
REGISTERS = 727
#: share of agreeing registers below which a pair is not verified: four standard deviations below the
#: least similarity, so that a pair at that similarity is missed with probability 5e-5
AGREEMENT = SIMILARITY - 4 * (SIMILARITY * (1 - SIMILARITY) / REGISTERS) ** 0.5
#: nodes of a bucket that are compared within one task
BLOCK = 4096
#: texts whose signatures are made at once: 16 bytes a register and text
PIECE_ROWS = 1024


# ---- weighted shingles and signatures ------------------------------------------------------


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, weight) of the distinct shingles of each text, ordered by row and hash. A text shorter
    than a shingle is one shingle; a text without words has none."""
    starts, ends, first = word_spans(data, offsets)
    words = word_hashes(data, starts, ends)
    row = rows_of_words(first)
    at = np.flatnonzero(whole_windows(row, size))
    hashes, rows = window_hashes(words, size)[at], row[at]
    counts = np.diff(first)
    for n in range(1, size):
        short = np.flatnonzero(counts == n)
        if len(short):
            hashes = np.concatenate([hashes, window_hashes(words, n)[first[short]]])
            rows = np.concatenate([rows, short])
    order = np.lexsort((hashes, rows))
    hashes, rows = hashes[order], rows[order]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
    begin = np.flatnonzero(new)
    return rows[begin], hashes[begin], np.diff(begin, append=len(rows))


def signatures(row: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n: int, registers: int = REGISTERS) -> np.ndarray:
    """The shingle that holds each register of each of n texts; zeros for a text without shingles.

    All texts take a step at once: each process that still runs has its next arrival, then ends if that is
    later than the latest register of its text. A shingle visits the registers without repeating one (a
    random start and stride modulo the prime number of registers), so its k-th arrival is slower by
    registers / (registers - k) and it ends after `registers` arrivals at the latest.
    """
    earliest = np.full((n, registers), np.inf)
    holder = np.zeros((n, registers), dtype=np.uint64)
    flat, flat_holder = earliest.reshape(-1), holder.reshape(-1)
    place = mixed(shingle ^ np.uint64(0xD1B54A32D192ED03))
    register = (place % np.uint64(registers)).astype(np.int64)
    stride = (mixed(place) % np.uint64(registers - 1)).astype(np.int64) + 1
    running, time = np.arange(len(row)), np.zeros(len(row))
    for step in range(registers):
        if not len(running):
            break
        random = mixed(shingle[running] + np.uint64((step + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        uniform = ((random >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)
        time[running] -= np.log(uniform) * (registers / (registers - step)) / weight[running]
        now = time[running]
        at = row[running] * registers + register[running]
        np.minimum.at(flat, at, now)
        first = flat[at] == now
        flat_holder[at[first]] = shingle[running[first]]
        register[running] = (register[running] + stride[running]) % registers
        # Rows ascend, so the texts that still run are found at the changes.
        new = np.diff(row[running], prepend=-1) != 0
        latest = earliest[row[running][new]].max(1)
        running = running[now < latest[np.cumsum(new) - 1]]
    return holder


def band_keys(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band, different for different bands."""
    n = len(signature)
    parts = signature[:, : bands * rows].reshape(n, bands, rows)
    keys = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.zeros((n, 1), dtype=np.uint64)
    for k in range(rows):
        keys = mixed(keys ^ parts[:, :, k]) + np.uint64(k + 1)
    return keys


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact probability Jaccard similarity of two weighted sets (ascending hashes, weights): the sum over
    shared x of 1 / sum over y of max(a[y]/a[x], b[y]/b[x])."""
    if not len(a[0]) and not len(b[0]):
        return 1.0
    shared, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(shared):
        return 0.0
    p, q = a[1][i].astype(float), b[1][j].astype(float)
    rest = a[1].sum() - p.sum(), b[1].sum() - q.sum()
    order = np.argsort(p / q, kind="stable")
    p, q = p[order], q[order]
    # Among shared y, a's quotient is the larger one from x on in this order.
    later = np.cumsum(p[::-1])[::-1]
    earlier = np.cumsum(q) - q
    return float((1 / ((later + rest[0]) / p + (earlier + rest[1]) / q)).sum())


# ---- nodes ---------------------------------------------------------------------------------


def _normal(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), normal_words(F.col("text")).alias("text"))


def sketched(rows: DataFrame) -> DataFrame:
    """doc_id, key (16 bytes that stand for the normalised text), the keys of the bands and the sketch."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            for low, high in pieces(offsets, rows=PIECE_ROWS):
                part, places = data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
                n, raw = high - low, part.tobytes()
                found = shingles(part, places)
                signature = signatures(*found, n)
                keys = band_keys(signature).astype(np.int64)
                sketches = [x.tobytes() for x in (signature >> np.uint64(56)).astype(np.uint8)]
                texts = [hashlib.md5(raw[a:b]).digest() for a, b in zip(places, places[1:])]
                bands = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * BANDS), pa.array(keys.reshape(-1)))
                columns = [batch.column("doc_id").slice(low, n), pa.array(texts, pa.binary()), bands, pa.array(sketches, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "key", "bands", "sketch"])

    return rows.mapInArrow(sketch, "doc_id long, key binary, bands array<long>, sketch binary")


# ---- links ---------------------------------------------------------------------------------


def verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) of text keys whose whole texts are similar enough, as nodes, with `similarity`."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            sides = [text_buffer(batch.column(c)) for c in ("text_a", "text_b")]
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            for low, high in pieces(sides[0][1] + sides[1][1]):
                sets = []
                for data, offsets in sides:
                    row, found, weight = shingles(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
                    cut = np.searchsorted(row, np.arange(high - low + 1))
                    sets.append([(found[x:y], weight[x:y]) for x, y in zip(cut, cut[1:])])
                for k, (x, y) in enumerate(zip(*sets)):
                    similarity = probability_jaccard(x, y)
                    if similarity >= least - 1e-9:  # sums of quotients are not exact to the last bit
                        out.append((a[low + k], b[low + k], similarity))
            columns = list(zip(*out)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()))], names=["a", "b", "similarity"])

    left = texts.select(F.col("key").alias("a"), F.col("node").alias("node_a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("key").alias("b"), F.col("node").alias("node_b"), F.col("text").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b").select(F.col("node_a").alias("a"), F.col("node_b").alias("b"), "text_a", "text_b")
    return both.mapInArrow(compare, "a long, b long, similarity double")


def agreeing_pairs(rows: DataFrame, agreement: float = AGREEMENT) -> DataFrame:
    """Pairs (a < b) of text keys of one bucket, but of different roots, whose sketches agree enough.

    rows: bucket, size (its rows), key, root, sketch, bands. A bucket is cut into blocks of nodes, and each
    pair of blocks is one group of at most two blocks' rows. A pair comes from the first band it shares.
    """
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    dealt = rows.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "key", "root", "sketch", "bands")
    keys = ["bucket", "i", "j"]

    def pairs(group: list[dict]) -> Iterator[tuple[bytes, bytes]]:
        sketch = np.frombuffer(b"".join(r["sketch"] for r in group), dtype=np.uint8).reshape(len(group), -1)
        root, block = (np.array([r[c] for r in group]) for c in ("root", "block"))
        bands, least = np.array([r["bands"] for r in group]), agreement * sketch.shape[1]
        bucket = group[0]["bucket"]
        between = group[0]["i"] != group[0]["j"]
        for k in range(len(group) - 1):
            near = np.flatnonzero((sketch[k + 1 :] == sketch[k]).sum(1) >= least) + k + 1
            near = near[(root[near] != root[k]) & (not between or block[near] != block[k])]
            if not len(near):
                continue
            same = bands[near] == bands[k]
            near = near[bands[k][same.argmax(1)] == bucket]
            for other in near:
                a, b = group[k]["key"], group[other]["key"]
                yield min(a, b), max(a, b)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        out: set[tuple[bytes, bytes]] = set()
        for batch in batches:
            for r in batch.to_pylist():
                if held and any(held[0][c] != r[c] for c in keys):
                    out.update(pairs(held))
                    held = []
                held.append(r)
            yield _pairs(out)
            out = set()
        if held:
            yield _pairs(set(pairs(held)))

    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(compare, "a binary, b binary").distinct()


def _pairs(found: set[tuple[bytes, bytes]]) -> pa.RecordBatch:
    columns = list(zip(*found)) or [[], []]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], names=["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """node and root (the smallest node it is connected with) of every node in a link (a, b).

    Alternating stars: every node sends its larger neighbours, then its smaller ones, to the smallest
    node it knows. Each round is written to the shared folder; a few rounds do even for long chains.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        edges = stored(small.where("a <> b").distinct(), "links")
        found = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("h")).first()
        if tuple(found) == mark:
            nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        mark = tuple(found)


def near_duplicate_classes(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One row per input row: doc_id, class_id (the smallest doc_id of its class), class_size (rows) and
    kept (doc_id is class_id).

    Words are runs of letters and digits in lower case. Two texts are linked if the probability Jaccard
    similarity of their shingles of five words, weighted by occurrences, is `least` or more; classes are
    the connected groups. Texts without words, null ones too, are equal to each other; a text of
    fewer than five words is one shingle. Rows that share a doc_id are in one class. Rows without doc_id are
    not compared: class_id is null and kept is true. Other columns are ignored.
    """
    rows = _normal(docs)
    sketches = stored(sketched(rows), "sketches")
    known = sketches.where(F.col("doc_id").isNotNull())
    nodes = stored(known.groupBy("key").agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")), "nodes")

    # Buckets with company, and how popular each text in them is.
    banded = nodes.select("key", "node", F.explode("bands").alias("bucket"))
    sizes = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = stored(banded.join(sizes, "bucket"), "buckets")
    popular = shared.groupBy("key", "node").agg(F.sum("n").alias("popularity"))
    ranked = F.struct(F.col("popularity"), -F.col("node"), F.col("key"))
    centers = shared.join(popular.select("key", "popularity"), "key").groupBy("bucket").agg(F.max_by("key", ranked).alias("center"))
    spokes = shared.join(centers, "bucket").where("key <> center")
    first = spokes.select(F.col("center").alias("a"), F.col("key").alias("b")).distinct()

    # Every text is verified, also the further ones of a doc_id; copies are read from their smallest doc_id only.
    keyed = rows.withColumn("key", F.unhex(F.md5("text"))).join(popular.select("key", F.col("node").alias("doc_id")), ["doc_id", "key"])
    texts = stored(keyed.groupBy(F.col("doc_id").alias("node"), "key").agg(F.max("text").alias("text")), "texts")
    links = stored(verified(first, texts, least).select("a", "b"), "links")

    # Buckets that hold several components still. Their centers have been compared with all others. Pairs
    # that are likely links come first: they spare those pairs that end up in one component.
    tried = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    for agreement in (least, least - (SIMILARITY - AGREEMENT)):
        placed = shared.select("bucket", "key", "node").join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
        placed = placed.join(centers, "bucket").where("key <> center")
        still = placed.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("size"))
        still = still.where("low <> high").select("bucket", "size")
        rest = placed.drop("node").join(still, "bucket").join(nodes, "key")
        pairs = stored(agreeing_pairs(rest.select("bucket", "size", "key", "root", "sketch", "bands"), agreement).join(tried, ["a", "b"], "left_anti"), "pairs")
        links = links.unionByName(stored(verified(pairs, texts, least).select("a", "b"), "links"))
        tried = tried.unionByName(pairs)
    # Texts of one doc_id are one document.
    same = known.groupBy("doc_id").agg(F.count_distinct("key").alias("n")).where("n > 1").select("doc_id")
    same = known.join(same, "doc_id").join(nodes.select("key", "node"), "key").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    roots = stored(components(links.unionByName(same)), "classes")

    classes = nodes.select("key", "node").join(roots, "node", "left").select("key", F.coalesce("root", "node").alias("class_id"))
    members = known.groupBy("key").agg(F.count(F.lit(1)).alias("n")).join(classes, "key")
    sizes = members.groupBy("class_id").agg(F.sum("n").alias("class_size"))
    by_key = stored(members.join(sizes, "class_id").select("key", "class_id", "class_size"), "class-keys")
    found = sketches.select("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("key")).alias("key")).join(by_key, "key", "left")
    return found.select(
        "doc_id",
        "class_id",
        F.coalesce("class_size", F.lit(1)).alias("class_size"),
        F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)).alias("kept"),
    )


@query("op7_near_dedup")
def op7_near_dedup(spark, sf_dir):
    """The near-duplicate class of every document."""
    return near_duplicate_classes(table(spark, sf_dir, "documents"))
