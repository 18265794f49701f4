"""Token ids in files of fixed-width bit packing, with random access.

A file row (a `page`) holds the ids of a run of documents, each in as many bits as the vocabulary
needs. Ids are packed in blocks of 64: a block takes exactly `bits` 64-bit little-endian words, so
the block of any id, and its place in the page, follow from its number alone:

    header   magic "TBP1", bits (u32), documents (u64), ids (u64), blocks (u64)
    index    blocks + 1 offsets of blocks from the begin of the body (u64)
    body     the packed blocks; the last is filled up with zeros

Pages are rows of a Parquet table with the columns page, first_id, doc_ids, n_tokens and content.
Spark's writer commits them, so lost executors leave no half-written file, and any store that Spark
can reach will do.
"""

from __future__ import annotations

import functools
import itertools
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillstream.llm.registry import parts_for, query, table
from tillstream.llm.words import pieces, text_buffer
from tillstream.session import scratch_path

MAGIC = b"TBP1"
BLOCK = 64
HEADER = struct.Struct("<4sIQQQ")
#: ids of a page; a longer document has a page of its own
PAGE_IDS = 1 << 19
#: text bytes of a range of documents
PART_BYTES = 32 << 20
#: text bytes that are encoded at once; a longer text is encoded alone
SLICE_BYTES = 4 << 20
#: bytes a worker uses to remember the ids of chunks, and what an entry takes beside its content
MEMO_BYTES, ENTRY_BYTES = 96 << 20, 180
#: parts that go through the library as one text
GROUP = 512
PAGES = "part int, page int, doc_ids array<long>, n_tokens array<long>, content binary"


# ---- the format ----------------------------------------------------------------------------


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids below 2^bits as blocks of 64 ids in `bits` words."""
    blocks = -(-len(ids) // BLOCK)
    filled = np.zeros(blocks * BLOCK, dtype=np.uint64)
    filled[: len(ids)] = ids
    columns = filled.reshape(blocks, BLOCK).T
    words = np.zeros((bits, blocks), dtype=np.uint64)
    for k in range(BLOCK):
        word, shift = divmod(k * bits, 64)
        words[word] |= columns[k] << np.uint64(shift)
        if shift + bits > 64:
            words[word + 1] |= columns[k] >> np.uint64(64 - shift)
    return np.ascontiguousarray(words.T).astype("<u8").tobytes()


def unpack(body: bytes | memoryview, bits: int, n: int) -> np.ndarray:
    words = np.frombuffer(body, dtype="<u8").reshape(-1, bits).T
    out, mask = np.empty((BLOCK, words.shape[1]), dtype=np.uint32), np.uint64((1 << bits) - 1)
    for k in range(BLOCK):
        word, shift = divmod(k * bits, 64)
        value = words[word] >> np.uint64(shift)
        if shift + bits > 64:
            value = value | (words[word + 1] << np.uint64(64 - shift))
        out[k] = value & mask
    return np.ascontiguousarray(out.T).reshape(-1)[:n]


def write_page(lists: list[np.ndarray], bits: int) -> bytes:
    ids = np.concatenate(lists) if lists else np.zeros(0, dtype=np.uint32)
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    body = pack(ids, bits)
    blocks = len(body) // (8 * bits)
    index = (np.arange(blocks + 1, dtype="<u8") * (8 * bits)).astype("<u8").tobytes()
    return HEADER.pack(MAGIC, bits, len(lists), len(ids), blocks) + index + body


def read_ids(content: bytes, low: int = 0, high: int | None = None) -> np.ndarray:
    """Ids [low, high) of a page; only the blocks that hold them are unpacked."""
    magic, bits, _documents, n, blocks = HEADER.unpack_from(content)
    if magic != MAGIC:
        raise ValueError("not a page of packed ids")
    high = n if high is None else min(high, n)
    if low >= high:
        return np.zeros(0, dtype=np.uint32)
    index = np.frombuffer(content, dtype="<u8", count=blocks + 1, offset=HEADER.size)
    first, last = low // BLOCK, -(-high // BLOCK)
    start = HEADER.size + 8 * (blocks + 1)
    body = memoryview(content)[start + int(index[first]) : start + int(index[last])]
    return unpack(body, bits, (last - first) * BLOCK)[low - first * BLOCK : high - first * BLOCK]


# ---- encoding ------------------------------------------------------------------------------


@functools.cache
def tokenizer(path: str) -> Tokenizer:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are what runs side by side
    return Tokenizer.from_file(path)


@functools.cache
def _specials(path: str) -> dict[str, int]:
    """The strings that the tokenizer takes out of a text before all else, and their ids."""
    return {t.content: i for i, t in tokenizer(path).get_added_tokens_decoder().items()}


class Memory:
    """Ids of parts that came before, in two generations: when the younger is full it becomes the older, whose
    entries are forgotten unless they are asked for again. So the bytes held are bounded and frequent parts stay."""

    def __init__(self, limit: int = MEMO_BYTES):
        self.limit, self.held = limit // 2, 0
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def find(self, parts: list[str]) -> list[bytes | None]:
        found = list(map(self.young.get, parts))
        missing = [k for k, ids in enumerate(found) if ids is None]
        again = {}
        for k, ids in zip(missing, map(self.old.get, [parts[k] for k in missing])):
            if ids is not None:
                found[k] = again[parts[k]] = ids
        self.put(again)
        return found

    def put(self, known: dict[str, bytes]) -> None:
        self.young.update(known)
        self.held += sum(map(len, known)) + sum(map(len, known.values())) + ENTRY_BYTES * len(known)
        if self.held > self.limit:
            self.young, self.old, self.held = {}, self.young, 0


@functools.cache
def _memory(path: str) -> Memory:
    return Memory()


def _bytes_of(text: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(text)] = True
    return table


_UPPER, _CLOSERS = _bytes_of(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _bytes_of(b".,;:!?")
_ALNUM = _bytes_of(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
_BLANKS = _bytes_of(b" \t\n\v\f\r")
#: first bytes of combining marks in UTF-8
_COMBINING = _bytes_of(b"\xcc\xcd")


def simplified(data: np.ndarray, offsets: np.ndarray, as_is: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts of a buffer with A-Z in lower case and a blank before closing punctuation: the tokenizer does
    the same, so its ids stay and fewer distinct parts are left. It composes characters before it lower-cases,
    so texts with combining marks, and those that `as_is` names, keep their case."""
    keep = as_is.copy()
    keep[np.searchsorted(offsets, np.flatnonzero(_COMBINING[data]), side="right") - 1] = True
    lowered = data + (_UPPER[data] * np.uint8(32))
    for k in np.flatnonzero(keep).tolist():
        lowered[offsets[k] : offsets[k + 1]] = data[offsets[k] : offsets[k + 1]]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    closer = np.zeros(len(data) + 2, dtype=bool)
    closer[1:-1] = _CLOSERS[data]
    start = np.flatnonzero(closer[1:-1] & (~closer[:-2] | edge[:-1]))
    end = np.flatnonzero(closer[1:-1] & (~closer[2:] | edge[1:])) + 1
    after = edge[end] | _BLANKS[data[np.minimum(end, len(data) - 1)]] if len(data) else edge[end]
    at = start[(start > 0) & ~edge[start] & after & _ALNUM[data[start - 1]]]
    return np.insert(lowered, at, np.uint8(32)), offsets + np.searchsorted(at, offsets)


@functools.cache
def _ends_word(path: str) -> np.ndarray:
    """Which ids end a word."""
    words = tokenizer(path).get_vocab(with_added_tokens=True)
    out = np.zeros(max(words.values()) + 1, dtype=bool)
    out[[i for w, i in words.items() if w.endswith("</w>")]] = True
    return out


def _together(groups: list[list[str]], between: str, path: str) -> Iterator[tuple[list[str], np.ndarray]]:
    texts = [between.join(g) for g in groups]
    for group, found in zip(groups, tokenizer(path).encode_batch_fast(texts, add_special_tokens=False)):
        yield group, np.array(found.ids, dtype="<u4")


def _grouped(parts: list[str]) -> list[list[str]]:
    return [parts[k : k + GROUP] for k in range(0, len(parts), GROUP)]


def _encode_parts(parts: list[str], path: str) -> dict[str, bytes]:
    """Ids of parts without blanks and special strings, many of which go through the library as one text.

    Parts of letters are one word each, and only the last id of a word ends one: where that shows as many ends
    as parts, blanks between them do. All others have a special string between them: the library cuts the text there
    first and encodes what is between on its own, and the string's id shows where one part ends.
    """
    out: dict[str, bytes] = {}
    others = [p for p in parts if not p.isalpha()]
    for group, ids in _together(_grouped([p for p in parts if p.isalpha()]), " ", path):
        ends = (np.flatnonzero(_ends_word(path)[ids]) + 1).tolist()
        if len(ends) != len(group) or ends[-1] != len(ids):
            others += group
            continue
        raw = ids.tobytes()
        out.update((p, raw[4 * x : 4 * y]) for p, x, y in zip(group, [0, *ends], ends))
    mark, number = next(iter(_specials(path).items()), (None, None))
    if mark is None:
        found = tokenizer(path).encode_batch_fast(others, add_special_tokens=False)
        out.update((p, np.array(f.ids, dtype="<u4").tobytes()) for p, f in zip(others, found))
        return out
    for group, ids in _together(_grouped(others), mark, path):
        ends = np.flatnonzero(ids == number).tolist()
        if len(ends) != len(group) - 1:
            raise RuntimeError("a special string got lost between two parts")
        raw = ids.tobytes()
        out.update((p, raw[4 * x : 4 * y]) for p, x, y in zip(group, [0, *[e + 1 for e in ends]], [*ends, len(ids)]))
    return out


def _ids_of(parts: list[str], path: str) -> list[bytes]:
    """Ids of distinct parts as bytes."""
    memory = _memory(path)
    found = memory.find(parts)
    new = [k for k, ids in enumerate(found) if ids is None]
    made = _encode_parts([parts[k] for k in new], path)
    for k in new:
        found[k] = made[parts[k]]
    memory.put(made)
    return found


def _strings(data: np.ndarray, offsets: np.ndarray) -> pa.LargeStringArray:
    buffers = (np.ascontiguousarray(offsets, dtype=np.int64), np.ascontiguousarray(data))
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, *map(pa.py_buffer, buffers))


def encode_texts(data: np.ndarray, offsets: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, where each text's ids begin and one more) of the UTF-8 texts in a buffer.

    The tokenizer drops white space before it merges, so a text's ids are those of its parts between blanks;
    each distinct part is looked up once and the ids are put together by number. A text with a special string
    goes through the library whole, which gives that string its own id.
    """
    texts = _strings(data, offsets)
    special, as_is = (np.zeros(len(texts), dtype=bool) for _ in range(2))
    for mark in _specials(path):
        special |= pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
        as_is |= pc.match_substring(texts, mark, ignore_case=True).to_numpy(zero_copy_only=False)
    lists = pc.ascii_split_whitespace(_strings(*simplified(data, offsets, as_is)))
    if special.any():
        lists = pc.if_else(pa.array(special), pa.scalar([], lists.type), lists)
    coded = lists.flatten().dictionary_encode()
    found = _ids_of(coded.dictionary.to_pylist(), path)
    ids, ends = np.frombuffer(b"".join(found), dtype="<u4"), np.cumsum([0, *[len(x) // 4 for x in found]])
    each = pa.LargeListArray.from_arrays(pa.array(ends), pa.array(ids)).take(coded.indices)
    flat, cuts = each.flatten().to_numpy(), each.offsets.to_numpy() - each.offsets[0].as_py()
    cuts = cuts[np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])]
    if not special.any():
        return flat, cuts
    own = [flat[a:b] for a, b in zip(cuts, cuts[1:])]
    for k in np.flatnonzero(special).tolist():
        own[k] = np.array(tokenizer(path).encode(texts[k].as_py(), add_special_tokens=False).ids, dtype="<u4")
    return np.concatenate([*own, flat[:0]]), np.concatenate([[0], np.cumsum([len(x) for x in own])])


def write_tokens(
    docs: DataFrame, folder: str, path: str | None = None, end_id: int = 2, part_bytes: int = PART_BYTES
) -> None:
    """Encode every text, append `end_id`, and write pages in ascending doc_id order (ties: by text).

    Texts are encoded whole as the library does without special tokens of its own; the strings of special tokens in
    a text get their ids. A null text counts as empty: its only id is `end_id`. Rows without doc_id come first. Repeated
    rows are written as often as they come; an empty table gives an empty folder of pages.
    """
    path = path or public_tokenizers.path("word_bpe_49k.json")
    bits = max(1, (tokenizer(path).get_vocab_size(with_added_tokens=True) - 1).bit_length())

    def pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, page = TaskContext.get().partitionId(), 0
        ids: list[int | None] = []
        lists: list[np.ndarray] = []
        held = 0
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            for low, high in pieces(offsets, SLICE_BYTES):
                flat, cuts = encode_texts(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], path)
                for k, doc in enumerate(batch.column("doc_id").slice(low, high - low).to_pylist()):
                    found = flat[cuts[k] : cuts[k + 1]]
                    if lists and held + len(found) >= PAGE_IDS:
                        yield _page(part, page, ids, lists, bits)
                        page, held, ids, lists = page + 1, 0, [], []
                    ids.append(doc)
                    lists.append(np.append(found, np.uint32(end_id)))
                    held += len(found) + 1
        if lists:
            yield _page(part, page, ids, lists, bits)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    parts = parts_for(rows, "text", part_bytes)
    ordered = rows.repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    ordered.mapInArrow(pages, PAGES).write.parquet(folder)


def _page(part: int, page: int, ids: list, lists: list[np.ndarray], bits: int) -> pa.RecordBatch:
    columns = [
        pa.array([part], pa.int32()),
        pa.array([page], pa.int32()),
        pa.array([ids], pa.list_(pa.int64())),
        pa.array([[len(x) for x in lists]], pa.list_(pa.int64())),
        pa.array([write_page(lists, bits)], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["part", "page", "doc_ids", "n_tokens", "content"])


def page_starts(pages: DataFrame) -> DataFrame:
    """The number of ids before each page. Sums of parts, one row each, are added up on the driver;
    pages of a part in a window over that part."""
    size = F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x)
    sums = pages.groupBy("part").agg(F.sum(size).alias("n")).orderBy("part").collect()
    before = list(itertools.accumulate([r["n"] for r in sums], initial=0))
    rows = [(r["part"], b) for r, b in zip(sums, before)]
    begin = pages.sparkSession.createDataFrame(rows, "part int, part_start long")
    earlier = Window.partitionBy("part").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    places = pages.select("part", "page", size.alias("size"))
    places = places.select("part", "page", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("inside"))
    return places.join(begin, "part").select("part", "page", (F.col("inside") + F.col("part_start")).alias("page_start"))


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids."""
    pages = spark.read.schema(PAGES).parquet(folder)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in range(batch.num_rows):  # one page at a time
                (row,) = batch.slice(number, 1).to_pylist()
                ends = np.cumsum(row["n_tokens"])
                ids = read_ids(row["content"])
                for low in range(0, len(ends), 1024):
                    lists = [ids[e - n : e] for e, n in zip(ends[low : low + 1024], row["n_tokens"][low : low + 1024])]
                    places = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
                    flat = np.concatenate(lists).astype(np.int32)
                    starts = [int(row["page_start"] + e - len(x)) for e, x in zip(ends[low:], lists)]
                    columns = [
                        pa.array(row["doc_ids"][low : low + 1024], pa.int64()),
                        pa.array(starts, pa.int64()),
                        pa.array(row["n_tokens"][low : low + 1024], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(places), pa.array(flat)),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids"])

    placed = pages.join(page_starts(pages), ["part", "page"])
    return placed.mapInArrow(documents, "doc_id long, start long, n_tokens long, ids array<int>")


def crc32_of_ids(ids: Column | str) -> Column:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""

    @F.arrow_udf("long")
    def crc32(lists: pa.Array) -> pa.Array:
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4")
        ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        lows = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        return pa.array([zlib.crc32(flat[a:b].tobytes()) for a, b in zip(lows, ends)], type=pa.int64())

    return crc32(ids)


@query("op9_token_files")
def op9_token_files(spark, sf_dir):
    """Token files of all documents, read back."""
    folder = scratch_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), folder)
    return read_tokens(spark, folder).select("doc_id", "start", "n_tokens", crc32_of_ids("ids").alias("ids_crc32"))
