"""Exact repeats of word windows, found with fixed-block anchors.

Documents are dealt to parts by doc_id ranges, so "an earlier document" means an earlier part or an
earlier row of the same part. Then:

1. Index and probe. Each part indexes the non-overlapping blocks of half a window of its documents
   and probes with every rolling window of that length. What it can decide alone, it does; for the
   rest it sends each distinct hash once, as a sorted, delta-coded set. A passage that a third of
   all documents share is thus one entry per part, never a row per document.
2. The sets meet by hash range: for each hash, is there a block in an earlier part, and any
   occurrence in a later one? The answer is one bit per entry and question, in the order of the set.
3. Extend. Every window of `size` words contains a whole block of the document it repeats, so windows
   around hit probes and around hit blocks are all that can take part. Their 80-bit hashes (two
   independent hashes) meet in the same way, which says exactly which windows have begun before:
   runs of such windows are the maximal repeats.

The text is shuffled once (by part) and read three times. No pairs of documents are formed.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.registry import parts_for, query, table
from tillstream.llm.words import (
    rows_of_words,
    text_buffer,
    whole_windows,
    window_hashes,
    word_hashes,
    word_spans,
)

#: text bytes of a part; a part is held in one task's memory with a few numbers per word
PART_BYTES = 6 << 20
#: bits of a probe's hash below its hash range; a false agreement only costs a needless look in step 3
PROBE_BITS = 40
SET = "range int, part int, keys binary, flags binary"
ANSWER = "range int, part int, first binary, second binary"


# ---- sets of hashes as bytes ---------------------------------------------------------------


def pack_sorted(values: np.ndarray, width: int) -> bytes:
    """Ascending numbers below 2^(8 width) as compressed byte planes of their differences."""
    steps = np.diff(values, prepend=np.uint64(0)).astype("<u8")
    planes = steps.view(np.uint8).reshape(-1, 8)[:, :width].T
    return zstandard.compress(np.ascontiguousarray(planes).tobytes(), 1)


def unpack_sorted(packed: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(packed), dtype=np.uint8).reshape(width, -1)
    steps = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    steps[:, :width] = planes.T
    return np.cumsum(steps.reshape(-1).view("<u8"), dtype=np.uint64)


def pack_bits(flags: np.ndarray) -> bytes:
    return zstandard.compress(np.packbits(flags).tobytes(), 1)


def unpack_bits(packed: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zstandard.decompress(packed), dtype=np.uint8), count=n).astype(bool)


def _range_edges(sorted_hashes: np.ndarray, ranges: int) -> np.ndarray:
    """Where each of the equal hash ranges begins in an ascending array."""
    bounds = np.array([(i << 64) // ranges for i in range(1, ranges)], dtype=np.uint64)
    return np.concatenate([[0], np.searchsorted(sorted_hashes, bounds), [len(sorted_hashes)]])


def _low(ranges: int, at: int) -> np.uint64:
    return np.uint64((at << 64) // ranges)


# ---- one part ------------------------------------------------------------------------------


class Part:
    """The documents of a part in the order of doc_id, equal ids side by side."""

    def __init__(self, rows: pa.Table, block: int):
        rows = rows.sort_by("doc_id")
        self.ids = rows["doc_id"].to_numpy(zero_copy_only=False).astype(np.int64)
        self.data, self.offsets = text_buffer(rows["text"])
        starts, ends, self.first = word_spans(self.data, self.offsets)
        self.words = word_hashes(self.data, starts, ends)
        self.spans = starts, ends
        row = rows_of_words(self.first)
        # Rows with one id count as one document: none is earlier than the other.
        self.row, self.doc = row, (np.cumsum(np.diff(self.ids, prepend=self.ids[:1]) != 0)[row] if len(row) else row)
        self.block = block
        valid = whole_windows(row, block)
        probes = window_hashes(self.words, block)
        self.at = np.flatnonzero(valid)
        self.hash = probes[self.at]
        self.aligned = (self.at - self.first[row[self.at]]) % block == 0 if len(self.at) else np.zeros(0, dtype=bool)


def _groups(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, number of the distinct hash of each ordered item, begin of each distinct hash)."""
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    begin = np.flatnonzero(np.diff(ordered, prepend=~ordered[:1]) != 0) if len(ordered) else np.zeros(0, dtype=np.int64)
    group = np.zeros(len(ordered), dtype=np.int64)
    group[begin[1:]] = 1
    return order, np.cumsum(group), begin


class Probes:
    """Step 1: what a part knows of its probes, and the set of hashes it asks about."""

    def __init__(self, part: Part, ranges: int):
        self.part, self.ranges = part, ranges
        self.order, self.group, begin = _groups(part.hash)
        doc, aligned = part.doc[part.at[self.order]], part.aligned[self.order]
        n = len(begin)
        far = np.iinfo(np.int64).max
        least, most = np.full(n, far), np.full(n, -1)
        if n:
            least = np.minimum.reduceat(np.where(aligned, doc, far), begin)
            most = np.maximum.reduceat(doc, begin)
        self.hit = least[self.group] < doc
        self.named = aligned & (most[self.group] > doc)
        self.aligned = aligned
        self.keys, self.has_block = part.hash[self.order][begin], least < far
        self.edges = _range_edges(self.keys, ranges)

    def sets(self, number: int) -> list[tuple]:
        out = []
        for r in range(self.ranges):
            a, b = self.edges[r], self.edges[r + 1]
            if a < b:
                keys = _shortened(self.keys[a:b], self.ranges, r)
                out.append((r, number, pack_sorted(keys, PROBE_BITS // 8), pack_bits(self.has_block[a:b])))
        return out

    def marks(self, answers: dict[int, tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Word positions where a probe hit an earlier block, and where a block was hit by a later probe."""
        earlier, later = np.zeros(len(self.keys), dtype=bool), np.zeros(len(self.keys), dtype=bool)
        for r, (first, second) in answers.items():
            a, b = self.edges[r], self.edges[r + 1]
            earlier[a:b], later[a:b] = unpack_bits(first, b - a), unpack_bits(second, b - a)
        hit = self.hit | earlier[self.group]
        named = self.named | (self.aligned & later[self.group])
        at = self.part.at[self.order]
        return at[hit], at[named]


def _shortened(keys: np.ndarray, ranges: int, r: int) -> np.ndarray:
    """Hashes of a range as PROBE_BITS-bit numbers in the same order (equal ones may arise)."""
    width = (1 << 64) // ranges + 1
    shift = max(0, width.bit_length() - PROBE_BITS)
    return (keys - _low(ranges, r)) >> np.uint64(shift)


class Windows:
    """Step 3: the windows that can take part, and what the part knows of them."""

    def __init__(self, part: Part, probes: Probes, answers: dict, size: int, ranges: int):
        self.part, self.size, self.ranges = part, size, ranges
        n = len(part.words) - size + 1
        valid = whole_windows(part.row, size)
        asks, tells = (self._around(marks, n) & valid if n > 0 else valid for marks in probes.marks(answers))
        self.at = np.flatnonzero(asks | tells)
        self.asks, self.tells = asks[self.at], tells[self.at]
        hashes = window_hashes(part.words, size, seed=3)[self.at]
        check = window_hashes(part.words, size, seed=4)[self.at] & np.uint64(0xFFFF)
        self.order = np.lexsort((check, hashes))
        high, low = hashes[self.order], check[self.order]
        new = np.ones(len(high), dtype=bool)
        new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        begin = np.flatnonzero(new)
        self.group = np.cumsum(new) - 1
        doc = part.doc[self.at[self.order]]
        self.repeat = np.zeros(len(doc), dtype=bool)
        self.keys, self.check = high[begin], low[begin]
        self.told = np.zeros(len(begin), dtype=bool)
        self.asked = np.zeros(len(begin), dtype=bool)
        if len(begin):
            self.repeat = np.minimum.reduceat(doc, begin)[self.group] < doc
            self.told = np.logical_or.reduceat(self.tells[self.order], begin)
            self.asked = np.logical_or.reduceat(self.asks[self.order] & ~self.repeat, begin)
        self.sent = np.flatnonzero(self.told | self.asked)
        self.edges = _range_edges(self.keys[self.sent], ranges)

    def _around(self, marks: np.ndarray, n: int) -> np.ndarray:
        """Window starts whose window holds a whole block begun at a mark."""
        change = np.zeros(n + 1, dtype=np.int64)
        np.add.at(change, np.clip(marks - (self.size - self.part.block), 0, n), 1)
        np.add.at(change, np.clip(marks + 1, 0, n), -1)
        return np.cumsum(change[:n]) > 0

    def sets(self, number: int) -> list[tuple]:
        out = []
        for r in range(self.ranges):
            a, b = self.edges[r], self.edges[r + 1]
            if a < b:
                sent = self.sent[a:b]
                keys = pack_sorted(self.keys[sent] - _low(self.ranges, r), 8)
                check = self.check[sent].astype("<u2").tobytes()
                flags = pack_bits(np.concatenate([self.told[sent], self.asked[sent]]))
                out.append((r, number, len(check).to_bytes(8, "little") + check + keys, flags))
        return out

    def covered(self, answers: dict[int, tuple[bytes, bytes]]) -> np.ndarray:
        """A flag for each word: is it in a window that an earlier document has too?"""
        earlier = np.zeros(len(self.keys), dtype=bool)
        for r, (first, _second) in answers.items():
            a, b = self.edges[r], self.edges[r + 1]
            earlier[self.sent[a:b]] = unpack_bits(first, b - a)
        repeat = self.repeat | (earlier[self.group] & self.asks[self.order])
        change = np.zeros(len(self.part.words) + 1, dtype=np.int64)
        begins = self.at[self.order][repeat]
        np.add.at(change, begins, 1)
        np.add.at(change, begins + self.size, -1)
        return np.cumsum(change[:-1]) > 0


def _answers(rows: pa.Table) -> dict[int, tuple[bytes, bytes]]:
    return {r["range"]: (r["first"], r["second"]) for r in rows.select(["range", "first", "second"]).to_pylist()}


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "binary": pa.binary(), "long": pa.int64(), "string": pa.string()}
    fields = [(f.split()[0], kinds[f.split()[1]]) for f in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [[] for _ in fields]
    return pa.table([pa.array(c, type=k) for c, (_n, k) in zip(columns, fields)], names=[n for n, _k in fields])


# ---- meeting by hash range -----------------------------------------------------------------


def meet_probes(rows: pa.Table) -> pa.Table:
    """For each entry of each part's set: a block in an earlier part? an occurrence in a later part?"""
    sets = sorted(rows.to_pylist(), key=lambda r: r["part"])
    keys = [unpack_sorted(r["keys"], PROBE_BITS // 8) for r in sets]
    blocks = [unpack_bits(r["flags"], len(k)) for r, k in zip(sets, keys)]
    part = np.repeat(np.arange(len(sets)), [len(k) for k in keys])
    every, block = np.concatenate(keys), np.concatenate(blocks)
    _order, group, begin = _groups(every)
    far = len(sets)
    # `every` is in the order of parts and the sort is stable, so the order within a hash is by part.
    part_o, block_o = part[_order], block[_order]
    least = np.minimum.reduceat(np.where(block_o, part_o, far), begin)
    most = np.maximum.reduceat(part_o, begin)
    earlier, later = np.empty(len(every), dtype=bool), np.empty(len(every), dtype=bool)
    earlier[_order] = least[group] < part_o
    later[_order] = most[group] > part_o
    return _split(sets, keys, earlier, later)


def meet_windows(rows: pa.Table) -> pa.Table:
    """For each entry of each part's set: has the window begun in an earlier part?"""
    sets = sorted(rows.to_pylist(), key=lambda r: r["part"])
    keys, checks, told = [], [], []
    for r in sets:
        n = int.from_bytes(r["keys"][:8], "little")
        checks.append(np.frombuffer(r["keys"][8 : 8 + n], dtype="<u2"))
        keys.append(unpack_sorted(r["keys"][8 + n :], 8))
        told.append(unpack_bits(r["flags"], 2 * (n // 2))[: n // 2])
    part = np.repeat(np.arange(len(sets)), [len(k) for k in keys])
    every, check, tells = np.concatenate(keys), np.concatenate(checks), np.concatenate(told)
    order = np.lexsort((check, every))
    high, low = every[order], check[order]
    new = np.ones(len(high), dtype=bool)
    new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
    begin, group, part_o = np.flatnonzero(new), np.cumsum(new) - 1, part[order]
    least = np.minimum.reduceat(np.where(tells[order], part_o, len(sets)), begin)
    earlier = np.empty(len(every), dtype=bool)
    earlier[order] = least[group] < part_o
    return _split(sets, keys, earlier, np.zeros(len(every), dtype=bool))


def _split(sets: list[dict], keys: list[np.ndarray], first: np.ndarray, second: np.ndarray) -> pa.Table:
    out, low = [], 0
    for r, k in zip(sets, keys):
        high = low + len(k)
        out.append((r["range"], r["part"], pack_bits(first[low:high]), pack_bits(second[low:high])))
        low = high
    return _table(out, ANSWER)


# ---- the operator --------------------------------------------------------------------------


def part_of(df: DataFrame, parts: int) -> Column:
    """The number of the doc_id range of a row; a row without an id is in part 0."""
    shares = [i / parts for i in range(1, parts)]
    bounds = df.agg(F.percentile_approx("doc_id", shares, 100 * parts)).first()[0] if shares else None
    bounds = sorted(set(bounds or []))
    if not bounds:
        return F.lit(0)
    return F.coalesce(F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b < F.col("doc_id"))), F.lit(0))


def remove_repeats(docs: DataFrame, size: int = 50, part_bytes: int = PART_BYTES) -> DataFrame:
    """Remove each word covered by a window of `size` words that also begins in a document with a
    smaller doc_id. Windows are judged on the input.

    Returns doc_id, n_words, n_removed, kept (the words left, joined by one space) and
    `repeats`, the removed runs as (first word, words), one row per input row.
    Null and empty texts, and texts shorter than a window, lose nothing. Rows with one doc_id count
    as one document, so none of them removes words of another; a row without doc_id loses and
    removes nothing. Other columns of the input are ignored.
    """
    block = size // 2
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    parts = parts_for(rows, "text", part_bytes)
    # Part -1 holds rows without an id: they meet nobody.
    placed = rows.select(F.when(F.col("doc_id").isNull(), -1).otherwise(part_of(rows, parts)).alias("part"), "doc_id", "text")

    def ask(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        number = key[0].as_py()
        if number < 0:
            return _table([], SET)
        return _table(Probes(Part(rows, block), parts).sets(number), SET)

    def ask_windows(key: tuple[pa.Scalar, ...], rows: pa.Table, answers: pa.Table) -> pa.Table:
        number = key[0].as_py()
        if number < 0:
            return _table([], SET)
        part = Part(rows, block)
        return _table(Windows(part, Probes(part, parts), _answers(answers), size, parts).sets(number), SET)

    def finish(key: tuple[pa.Scalar, ...], rows: pa.Table, answers: pa.Table) -> pa.Table:
        first = answers.filter(pa.compute.equal(answers["step"], 1))
        second = answers.filter(pa.compute.equal(answers["step"], 2))
        if key[0].as_py() < 0:
            data, offsets = text_buffer(rows["text"])
            return _kept(None, data, offsets, np.zeros(len(word_spans(data, offsets)[0]), dtype=bool))
        part = Part(rows, block)
        windows = Windows(part, Probes(part, parts), _answers(first), size, parts)
        return _kept(part.ids, part.data, part.offsets, windows.covered(_answers(second)))

    asked = placed.groupBy("part").applyInArrow(ask, SET)
    found = asked.groupBy("range").applyInArrow(meet_probes, ANSWER)
    windows = placed.groupBy("part").cogroup(found.groupBy("part")).applyInArrow(ask_windows, SET)
    begun = windows.groupBy("range").applyInArrow(meet_windows, ANSWER)
    told = found.withColumn("step", F.lit(1)).unionByName(begun.withColumn("step", F.lit(2)))
    schema = "doc_id long, n_words long, n_removed long, kept string, repeats array<struct<first:long,words:long>>"
    return placed.groupBy("part").cogroup(told.groupBy("part")).applyInArrow(finish, schema)


def _kept(ids: np.ndarray | None, data: np.ndarray, offsets: np.ndarray, covered: np.ndarray) -> pa.Table:
    raw = data.tobytes()
    rows, low = [], 0
    for i in range(len(offsets) - 1):
        words = raw[offsets[i] : offsets[i + 1]].split()
        mask = covered[low : low + len(words)]
        low += len(words)
        runs = []
        if mask.any():
            edges = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0))
            runs = [{"first": int(a), "words": int(b - a)} for a, b in zip(edges[::2], edges[1::2])]
        kept = b" ".join(itertools.compress(words, (~mask).tolist()) if runs else words)
        rows.append((None if ids is None else int(ids[i]), len(words), int(mask.sum()), kept.decode(), runs))
    columns = list(zip(*rows)) if rows else [[]] * 5
    run = pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64())]))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), run]
    names = ["doc_id", "n_words", "n_removed", "kept", "repeats"]
    return pa.table([pa.array(c, type=k) for c, k in zip(columns, kinds)], names=names)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


SQL = r"""
with words as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), starts as (
  select doc_id, unnest(range(1, len(w) - 48)) as p, w from words where len(w) >= 50
), windows as (
  select doc_id, p, sha256(array_to_string(list_slice(w, p, p + 49), ' ')) as h from starts
), repeated as (
  select doc_id, p from (select *, min(doc_id) over (partition by h) as least from windows) where least < doc_id
), covered as (
  select doc_id, list_distinct(flatten(list(range(p, p + 50)))) as gone from repeated group by doc_id
), kept as (
  select doc_id, len(w) as n_words, coalesce(len(gone), 0) as n_removed,
         case when gone is null then w
              else list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda x: not list_contains(gone, x[2])), lambda x: x[1]) end as k
  from words left join covered using (doc_id)
)
select doc_id, n_words, n_removed, sha256(coalesce(array_to_string(k, ' '), '')) as kept_sha256 from kept
"""


@query("op10_substring_dedup", SQL)
def op10_substring_dedup(spark, sf_dir):
    """Repeats of 50 words and more are removed from every document but the first that has them."""
    kept = remove_repeats(table(spark, sf_dir, "documents"), size=50)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))
