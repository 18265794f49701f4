"""Spelling variants by Bloom-guided neighbourhoods.

Two words are near if one code point inserted, deleted or replaced makes one of the other. Every word
generates its shorter neighbours and those with a code point replaced by a larger one; the other half of the
relation is the same pairs seen from the other side. The neighbours are never built as text: their hashes
follow from the word's own by one addition and one product, a whole column at a time, and are looked up in
blocked Bloom filters of the vocabulary, one for each word length. Only those found become rows, and an exact
join with the vocabulary removes the false ones.

The filters lie in a row, block by block, and are broadcast in passes of at most `filter_bytes`; a larger
vocabulary takes more passes, and a word generates neighbours only in passes that hold a filter it asks. So
what is broadcast is bounded at any size, and it is built by Spark: tasks give each word its block and bits,
one aggregation ORs the bits of a block.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.registry import query, stored, table
from tillstream.llm.words import mixed

#: fixed values of the query: letters of a run, one in so many runs loses a letter, least length and
#: count of a word, how many times more frequent a form is
LETTERS, EVERY, LEAST_LETTERS, LEAST_COUNT, TIMES = "[A-Za-zÀ-ÿ]+", 31, 7, 2, 10
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: a block is 8 lanes of 64 bits with one bit of each word in every lane; words of a full block
LANES, BLOCK_WORDS = 8, 32
#: least blocks of a filter: lengths with few words get hardly any false positives
LEAST_BLOCKS = 16
#: bytes of filters that are broadcast at once
FILTER_BYTES = 32 << 20
#: words of this length or longer share a filter
LONGEST = 64
#: code points of one length that are worked on at once
PIECE = 1 << 18

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))


# ---- words ---------------------------------------------------------------------------------


def counted_words(docs: DataFrame, every: int = EVERY, letters: int = LEAST_LETTERS, count: int = LEAST_COUNT) -> DataFrame:
    """word and n: the letter runs of all texts, with A-Z in lower case. One run in `every`, chosen by the
    checksum of `<doc_id>:<run>`, loses the letter that the checksum names. Rows without doc_id lose none."""
    found = docs.select(
        F.col("doc_id").cast("long").cast("string").alias("doc_id"),
        F.explode(F.regexp_extract_all("text", F.lit(f"({LETTERS})"), F.lit(1))).alias("run"),
    )
    # A shorter run can't become a long enough word.
    found = found.where(F.length("run") >= letters).select("doc_id", F.translate("run", UPPER, LOWER).alias("run"))
    found = found.withColumn("h", F.crc32(F.encode(F.concat("doc_id", F.lit(":"), "run"), "UTF-8")))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % every == 0, shorter).otherwise(F.col("run")).alias("word")
    counts = found.select(word).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.where((F.length("word") >= letters) & (F.col("n") >= count))


# ---- hashes of words and of their neighbours -----------------------------------------------


@functools.lru_cache(maxsize=256)
def _powers(n: int) -> np.ndarray:
    steps = np.full(max(n, 1), _BASE, dtype=np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)[:n]


def _letter(code: np.ndarray) -> np.ndarray:
    return mixed((code.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1342543DE82EF95))


def code_points(words: list[str]) -> np.ndarray:
    """One row per word; all have the same length."""
    return np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").reshape(len(words), -1)


def finished(sums: np.ndarray, length: int) -> np.ndarray:
    """The hash that filters are asked with, from a sum over letters and the word's length."""
    return mixed(sums ^ np.uint64(length * 0xA24BAED4963EE407 % (1 << 64)))


def whole_sums(codes: np.ndarray) -> np.ndarray:
    return (_letter(codes) * _powers(codes.shape[1])).sum(1, dtype=np.uint64)


def deletions(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, place, sum) of all different words with one letter less. Of a run of equal letters only the
    first is deleted: the others give the same word."""
    terms = _letter(codes) * _powers(codes.shape[1])
    until = np.cumsum(terms, 1, dtype=np.uint64)
    sums = (until - terms) + (until[:, -1:] - until) * _BASE_INVERSE
    first = np.ones(codes.shape, dtype=bool)
    first[:, 1:] = codes[:, 1:] != codes[:, :-1]
    word, place = np.nonzero(first)
    return word, place, sums[word, place]


def replacements(codes: np.ndarray, alphabet: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(code, word, place, sum) of the words with a smaller letter replaced by each code of the alphabet."""
    letters, powers, sums = _letter(codes), _powers(codes.shape[1]), whole_sums(codes)
    for code in alphabet:
        word, place = np.nonzero(codes < code)
        change = _letter(np.array([code])) - letters[word, place]
        yield code, word, place, sums[word] + change * powers[place]


# ---- filters -------------------------------------------------------------------------------


class Line:
    """Where the filter of each length lies in the line of all blocks."""

    def __init__(self, counts: dict[int, int]):
        self.blocks = {s: max(LEAST_BLOCKS, -(-n // BLOCK_WORDS)) for s, n in sorted(counts.items())}
        self.first, at = {}, 0
        for s, n in self.blocks.items():
            self.first[s], at = at, at + n
        self.total = at

    def block(self, keys: np.ndarray, shard: int) -> np.ndarray:
        share = (keys * np.uint64(0x9FB21C651E98DF25)) >> np.uint64(32)
        return self.first[shard] + ((share * np.uint64(self.blocks[shard])) >> np.uint64(32)).astype(np.int64)

    def meets(self, length: int, low: int, high: int) -> bool:
        shard = min(length, LONGEST)
        return shard in self.blocks and self.first[shard] < high and low < self.first[shard] + self.blocks[shard]


def _bit(keys: np.ndarray, lane: int) -> np.ndarray:
    return (keys >> np.uint64(6 * lane)) & np.uint64(63)


def contained(bits: np.ndarray, line: Line, low: int, sums: np.ndarray, length: int) -> np.ndarray:
    """Which of the sums are in the filter, as far as the blocks from `low` on that `bits` holds go."""
    keys = finished(sums, length)
    block = line.block(keys, min(length, LONGEST)) - low
    alive = np.flatnonzero((block >= 0) & (block < len(bits)))
    for lane in range(LANES):
        alive = alive[(bits[block[alive], lane] >> _bit(keys[alive], lane)) & np.uint64(1) != 0]
    return alive


def by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    """(length, places) of words of equal length, at most PIECE letters or one word at a time."""
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    for length in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == length)
        step = max(1, PIECE // max(length, 1))
        for k in range(0, len(at), step):
            yield length, at[k : k + step]


def filter_blocks(vocabulary: DataFrame, line: Line) -> DataFrame:
    """block and its lanes, as signed numbers, of all blocks that hold a word."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("word").to_pylist()
            for length, at in by_length(words):
                keys = finished(whole_sums(code_points([words[i] for i in at])), length)
                lanes = [np.uint64(1) << _bit(keys, lane) for lane in range(LANES)]
                columns = [line.block(keys, min(length, LONGEST)), *[x.astype(np.int64) for x in lanes]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["block", *names])

    names = [f"lane{k}" for k in range(LANES)]
    rows = vocabulary.select("word").mapInArrow(bits, ", ".join(f"{c} long" for c in ["block", *names]))
    return rows.groupBy("block").agg(*[F.bit_or(c).alias(c) for c in names])


def near_candidates(vocabulary: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """word, n and near: generated neighbours that a filter holds, false positives among them."""
    spark = vocabulary.sparkSession
    shard = F.least(F.length("word"), F.lit(LONGEST))
    line = Line({r["shard"]: r["n"] for r in vocabulary.groupBy(shard.alias("shard")).agg(F.count(F.lit(1)).alias("n")).collect()})
    letters = vocabulary.select(F.explode(F.array_distinct(F.split("word", ""))).alias("letter")).where("letter <> ''").distinct()
    alphabet = sorted(ord(r["letter"]) for r in letters.collect())
    blocks = stored(filter_blocks(vocabulary, line), "filter")
    schema, step = "word string, n long, near string", max(1, filter_bytes // (8 * LANES))
    found = spark.createDataFrame([], schema)
    for low in range(0, line.total, step):
        high = min(low + step, line.total)
        held = blocks.where((F.col("block") >= low) & (F.col("block") < high)).toArrow()
        bits = np.zeros((high - low, LANES), dtype=np.uint64)
        where = held["block"].to_numpy() - low
        for lane in range(LANES):
            bits[where, lane] = held[f"lane{lane}"].to_numpy().astype(np.uint64)
        sent = spark.sparkContext.broadcast(bits)
        probed = vocabulary.select("word", "n").mapInArrow(_prober(sent, line, low, high, alphabet), schema)
        found = found.unionByName(stored(probed, "candidates"))
        sent.destroy()
    return found


def _prober(sent, line: Line, low: int, high: int, alphabet: list[int]):
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, counts = batch.column("word").to_pylist(), batch.column("n").to_pylist()
            out: list[tuple[str, int, str]] = []
            for length, at in by_length(words):
                shorter, same = line.meets(length - 1, low, high), line.meets(length, low, high)
                if not shorter and not same:
                    continue
                codes = code_points([words[i] for i in at])
                if shorter:
                    word, place, sums = deletions(codes)
                    for k in contained(sent.value, line, low, sums, length - 1).tolist():
                        i, p = at[word[k]], place[k]
                        out.append((words[i], counts[i], words[i][:p] + words[i][p + 1 :]))
                for code, word, place, sums in replacements(codes, alphabet if same else []):
                    for k in contained(sent.value, line, low, sums, length).tolist():
                        i, p = at[word[k]], place[k]
                        out.append((words[i], counts[i], words[i][:p] + chr(code) + words[i][p + 1 :]))
            columns = list(zip(*out)) or [[], [], []]
            kinds = (pa.string(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["word", "n", "near"])

    return probe


# ---- variants ------------------------------------------------------------------------------


def near_words(vocabulary: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """word, near and near_n: every pair of near words of a vocabulary (word, n; each word once), both ways."""
    known = vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = stored(near_candidates(vocabulary, filter_bytes).join(known, "near"), "near")
    there = pairs.select("word", "near", "near_n")
    return there.unionByName(pairs.select(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")))


def roots(forms: DataFrame) -> DataFrame:
    """word and root of all rows (word, form), where a form may have a form itself. Every step doubles the
    way a word looks ahead; each is written, and the loop ends when no word has got further."""
    ahead = forms.select("word", F.col("form").alias("root"))
    while True:
        further = ahead.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = ahead.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("went"))
        step = stored(step, "roots")
        ahead = step.select("word", "root")
        if step.where("went").isEmpty():
            return ahead


def spelling_variants(vocabulary: DataFrame, times: int = TIMES, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """One row per word of a vocabulary (word, n): word, form, root, n, n_near, form_n.

    The form of a word is its near word of largest n (ties: the smallest in code-point order), if that n
    is at least `times` its own; the root is found by following forms to the last. Without a form, form and
    form_n are null and the root is the word itself. An empty vocabulary gives no rows; words of any length
    are compared whole; a word must be there once, and null words are left out.
    """
    words = stored(vocabulary.where(F.col("word").isNotNull()).select("word", "n"), "vocabulary")
    best = near_words(words, filter_bytes).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best")
    )
    form_n = -F.col("best.minus")
    chosen = words.join(best, "word", "left").withColumn("form_n", F.when(form_n >= F.lit(times) * F.col("n"), form_n))
    chosen = chosen.withColumn("form", F.when(F.col("form_n").isNotNull(), F.col("best.near")))
    chosen = stored(chosen.select("word", "form", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "form_n"), "forms")
    ends = roots(chosen.where("form is not null"))
    return chosen.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def document_variants(docs: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """`spelling_variants` of the words of documents (doc_id, text).

    Null and empty texts have no words; whole texts are read, whatever their length. Repeated rows count as
    often as they come; rows without doc_id count with their runs unchanged. Other columns are ignored.
    """
    return spelling_variants(counted_words(docs), filter_bytes=filter_bytes)


# ---- the same in SQL -----------------------------------------------------------------------

SQL = r"""
with recursive bytes_table as materialized (
  select list(c order by i) as t from (
    select i, list_reduce(range(8), lambda c, k: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i) as c
    from (select unnest(range(256)) as i))
), runs as materialized (
  select doc_id, run, count(*) as k
  from (select doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run
        from documents)
  where length(run) >= 7 group by doc_id, run
), hashed as (
  select run, k, xor(list_reduce(
      flatten(list_transform(string_split(doc_id || ':' || run, ''), lambda x: case when unicode(x) < 128 then [unicode(x)] else [195, unicode(x) - 64] end)),
      lambda c, b: xor(c >> 8, t[cast(xor(c & 255, b) as int) + 1]), cast(4294967295 as bigint)), 4294967295) as h
  from runs, bytes_table
), words as materialized (
  select word, cast(sum(k) as bigint) as n
  from (select k, case when h % 31 = 0 then left(run, cast(h % length(run) as int)) || substr(run, cast(h % length(run) as int) + 2) else run end as word from hashed)
  group by word having length(word) >= 7 and sum(k) >= 2
), holes as materialized (
  select distinct word, n, left(word, i) || substr(word, i + 2) as less, left(word, i) || '*' || substr(word, i + 2) as hole
  from (select word, n, unnest(range(length(word))) as i from words)
), near as (
  select a.word, b.word as near, b.n as near_n from holes a join holes b on a.hole = b.hole and a.word <> b.word
  union select h.word, w.word, w.n from holes h join words w on w.word = h.less
  union select w.word, h.word, h.n from holes h join words w on w.word = h.less
), best as (
  select word, count(*) as n_near, max(near_n) as most, min_by(near, (-near_n, near)) as top from near group by word
), forms as materialized (
  select word, n, coalesce(n_near, 0) as n_near, case when most >= 10 * n then top end as form, case when most >= 10 * n then most end as form_n
  from words left join best using (word)
), walk as (
  select word, word as root, 0 as steps from forms
  union all select walk.word, forms.form, steps + 1 from walk join forms on forms.word = walk.root where forms.form is not null
)
select word, form, max_by(root, steps) as root, any_value(n) as n, any_value(n_near) as n_near, any_value(form_n) as form_n
from walk join forms using (word) group by word, form
"""


@query("op11_spelling", SQL)
def op11_spelling(spark, sf_dir):
    """The spelling variants in all documents."""
    return document_variants(table(spark, sf_dir, "documents"))
