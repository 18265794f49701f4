"""Benchmark decontamination by greedy string tiling.

Seeds are the benchmark's windows of SEED words, by rolling (Karp-Rabin) hash. A document's rolling
hashes are looked up among them; where an item shares seeds with the document, the item is tiled
greedily: again and again the longest match of words not yet marked on either side is marked, down to
the seed length. Matches may come in any order, so passages that were reordered are caught. A
document is contaminated by an item if its tiles cover enough of the item. An item shorter than a seed is
one seed of its own length: it is found where the document has all its words in a row.

Documents are read once per block of benchmark items and nothing is shuffled. A block has a bounded
number of words, so the index that every task holds is bounded too, however long the benchmark is.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.registry import normal_words, query, table
from tillstream.llm.words import (
    pieces,
    rows_of_words,
    text_buffer,
    whole_windows,
    window_hashes,
    word_hashes,
    word_spans,
)

#: words of a seed, which is also the shortest tile
SEED = 5
#: share of an item's words that must be covered
COVERAGE = 0.5
#: benchmark words in one block
BLOCK_WORDS = 1 << 20
_FOUND = "doc_id long, item_id long, coverage double, n_item_words int, n_covered int, tiles array<struct<item_word:int,doc_word:int,words:int>>"


# ---- tiling --------------------------------------------------------------------------------


def tiles(item: np.ndarray, doc: np.ndarray, seeds: np.ndarray, least: int = SEED) -> list[tuple[int, int, int]]:
    """Greedy string tiling of an item's words by a document's.

    `seeds` are the pairs (item word, document word) at which `least` words agree. Runs of seeds on a
    diagonal are the maximal matches. They wait in a heap by length; one that has lost words to
    an earlier tile is cut into what is left of it and goes back.
    """
    if not len(seeds):
        return []
    order = np.lexsort((seeds[:, 0], seeds[:, 1] - seeds[:, 0]))
    i, shift = seeds[order, 0], (seeds[:, 1] - seeds[:, 0])[order]
    new = np.flatnonzero((np.diff(i, prepend=-2) != 1) | (np.diff(shift, prepend=shift[0] - 1) != 0))
    ends = np.append(new[1:], len(i))
    # Longest first; ties go to the place that comes first in the item, then in the document.
    heap = [(-(int(e - b) + least - 1), int(i[b]), int(i[b] + shift[b])) for b, e in zip(new, ends)]
    heapq.heapify(heap)
    item_free, doc_free = np.ones(len(item), dtype=bool), np.ones(len(doc), dtype=bool)
    out = []
    while heap:
        length, a, b = heapq.heappop(heap)
        length = -length
        free = item_free[a : a + length] & doc_free[b : b + length]
        if free.all():
            item_free[a : a + length] = False
            doc_free[b : b + length] = False
            out.append((a, b, length))
            continue
        edges = np.flatnonzero(np.diff(free.astype(np.int8), prepend=0, append=0))
        for low, high in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if high - low >= least:
                heapq.heappush(heap, (low - high, a + low, b + low))
    return out


class Seeds:
    """Windows of `size` words that begin at given places of a block's words, by hash."""

    def __init__(self, size: int, words: np.ndarray, at: np.ndarray):
        self.size = size
        hashes = window_hashes(words, size)[at]
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.places = hashes[order], at[order]
        # Most windows of a document are ruled out by the upper bits of their hash.
        self.sieve = np.zeros((1 << 22) if len(at) else 0, dtype=bool)
        self.sieve[(hashes >> np.uint64(42)).astype(np.int64)] = True

    def pairs(self, words: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers in the block and in the documents at which the windows agree."""
        none = np.zeros(0, dtype=np.int64)
        hashes, size = self.hashes, self.size
        if not len(hashes) or len(words) < size:
            return none, none
        probes = window_hashes(words, size)
        near = np.flatnonzero(self.sieve[(probes >> np.uint64(42)).astype(np.int64)] & whole_windows(row, size))
        low = np.searchsorted(hashes, probes[near], side="left")
        n = np.searchsorted(hashes, probes[near], side="right") - low
        near, low, n = near[n > 0], low[n > 0], n[n > 0]
        places = self.places[np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        return places, np.repeat(near, n)


class Block:
    """Benchmark items of one block with an index of their seeds."""

    def __init__(self, items: list[tuple[int, str]], seed: int):
        self.seed = seed
        self.ids = [i for i, _ in items]
        data, offsets = text_buffer(pa.array([t for _, t in items], pa.large_string()))
        starts, ends, self.first = word_spans(data, offsets)
        self.words = word_hashes(data, starts, ends)
        self.row = rows_of_words(self.first)
        counts = np.diff(self.first)
        self.indexes = [Seeds(seed, self.words, np.flatnonzero(whole_windows(self.row, seed)))]
        for n in range(1, seed):
            self.indexes.append(Seeds(n, self.words, self.first[:-1][counts == n]))

    def found(self, index: Seeds, words: np.ndarray, row: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """(document row, item, seeds as pairs of word numbers) for all that share a seed of an index."""
        item_at, doc_at = index.pairs(words, row)
        if not len(item_at):
            return
        item, doc = self.row[item_at], row[doc_at]
        order = np.lexsort((item, doc))
        item, doc, pairs = item[order], doc[order], np.stack([item_at[order], doc_at[order]], axis=1)
        cut = np.flatnonzero((np.diff(item, prepend=-1) != 0) | (np.diff(doc, prepend=-1) != 0))
        for b, e in zip(cut, np.append(cut[1:], len(item))):
            yield int(doc[b]), int(item[b]), pairs[b:e]

    def contaminated(self, words: np.ndarray, first: np.ndarray, coverage: float) -> Iterator[tuple]:
        """(document row, item id, coverage, words, covered, tiles) of the pairs that reach the coverage."""
        row = rows_of_words(first)
        for index in self.indexes:
            for d, k, pairs in self.found(index, words, row):
                low, high = int(self.first[k]), int(self.first[k + 1])
                n = high - low
                at = np.unique(pairs[:, 0])
                # Tiles cover at most the union of the seeds; most pairs end here.
                if np.minimum(np.diff(at, append=at[-1] + index.size), index.size).sum() < coverage * n:
                    continue
                seeds = pairs - np.array([low, first[d]])
                found = tiles(self.words[low:high], words[first[d] : first[d + 1]], seeds, index.size)
                covered = sum(t[2] for t in found)
                if covered >= coverage * n:
                    yield d, self.ids[k], covered / n, n, covered, found


# ---- the operator --------------------------------------------------------------------------


def blocks_of(benchmark: DataFrame, seed: int, block_words: int) -> Iterator[Block]:
    """The benchmark's items with a word in them, in blocks of at most `block_words` words or one item."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), normal_words(F.col("text")).alias("text"))
    held, n = [], 0
    for r in items.where("text <> ''").toLocalIterator():
        size = r["text"].count(" ") + 1
        if held and n + size > block_words:
            yield Block(held, seed)
            held, n = [], 0
        held.append((r["item_id"], r["text"]))
        n += size
    if held:
        yield Block(held, seed)


def contaminations(
    docs: DataFrame, benchmark: DataFrame, seed: int = SEED, coverage: float = COVERAGE, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """One row per pair of a document and an item whose tiles cover at least `coverage` of the item's words:
    doc_id, item_id, coverage, n_item_words, n_covered and the tiles (word numbers in item and document).

    Words are runs of letters and digits in lower case. Null and empty texts match nothing; items shorter
    than a seed are found only whole, with all their words in a row. Repeated rows are reported as often as they come. Whole texts are
    read. Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normal_words(F.col("text")).alias("text"))
    shared = docs.sparkSession.sparkContext

    def against(block: Block) -> DataFrame:
        held = shared.broadcast(block)  # bounded by block_words

        def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = held.value
            for batch in batches:
                data, offsets = text_buffer(batch.column("text"))
                ids = batch.column("doc_id").to_pylist()
                for low, high in pieces(offsets):
                    part = data[offsets[low] : offsets[high]]
                    starts, ends, first = word_spans(part, offsets[low : high + 1] - offsets[low])
                    words = word_hashes(part, starts, ends)
                    out = [(ids[low + d], *rest) for d, *rest in index.contaminated(words, first, coverage)]
                    if out:
                        yield _batch(out)

        return rows.mapInArrow(tile, _FOUND)

    found = [against(b) for b in blocks_of(benchmark, seed, block_words)]
    if not found:
        return docs.sparkSession.createDataFrame([], _FOUND)
    return reduce(DataFrame.unionByName, found)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    tile = pa.struct([("item_word", pa.int32()), ("doc_word", pa.int32()), ("words", pa.int32())])
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.list_(tile)]
    columns = list(zip(*rows))
    columns[5] = [[{"item_word": a, "doc_word": b, "words": n} for a, b, n in t] for t in columns[5]]
    names = ["doc_id", "item_id", "coverage", "n_item_words", "n_covered", "tiles"]
    return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds)], names=names)


def worst_item(found: DataFrame) -> DataFrame:
    """One row per contaminated document: the item it covers most (ties: smallest item_id) and how many
    items it holds."""
    best = F.max_by(F.struct("item_id", "coverage", "n_covered"), F.struct("coverage", -F.col("item_id")))
    rows = found.groupBy("doc_id").agg(best.alias("best"), F.count_distinct("item_id").alias("n_items"))
    return rows.select("doc_id", "best.item_id", "best.coverage", "best.n_covered", "n_items")


@query("op1_decontamination")
def op1_decontamination(spark, sf_dir):
    """Pairs of a document and a benchmark item it contains."""
    found = contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "coverage", "n_item_words", "n_covered", F.size("tiles").alias("n_tiles"))
