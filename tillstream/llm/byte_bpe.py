"""Byte-level BPE: texts to token ids and back, by a local rank file and the tiktoken library.

Each match of the split pattern is merged on its own, so a text may be cut wherever a match is sure
to end. Long texts are cut there before the library sees them, which bounds its working memory.
"""

from __future__ import annotations

import base64
import functools
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.registry import query, table
from tillstream.llm.words import give_back

#: characters after which a text is cut at the next safe boundary
PIECE_CHARS = 1 << 16
#: Runs of white space that the library is not given: its pattern tries them blank by blank, and a long run ends it.
#: The characters that \\s stands for in the pattern.
_LONG_BLANKS = re.compile("[ \\t\\n\\x0b\\x0c\\r\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]{50000,}")
#: A letter or digit followed by a blank: no match of the pattern runs from the one into the other,
#: and what the pattern looks ahead at lies behind the blank.
_SAFE = re.compile(r"(?<=[^\W_])(?=[ \n])")


@functools.cache
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file; read once per worker. Special tokens: none."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines) if token}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def cut(text: str, size: int = PIECE_CHARS) -> list[str]:
    """The text in pieces of `size` characters or more, each ended by a safe boundary."""
    out, low = [], 0
    while len(text) - low > size:
        found = _SAFE.search(text, low + size)
        if found is None:
            break
        out.append(text[low : found.start()])
        low = found.start()
    return [*out, text[low:]]


def encode_text(text: str | None, path: str, pattern: str) -> list[int]:
    """Ids of a text of any length. A long run of white space is one match of the pattern up to its last
    character, which goes to what follows, or to its end where the text ends; it is merged as that match."""
    encoder, text = encoding(path, pattern), text or ""
    ids: list[int] = []
    low = 0
    for run in _LONG_BLANKS.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        for piece in cut(text[low : run.start()]):
            ids += encoder.encode_ordinary(piece)
        ids += encoder._encode_single_piece(text[run.start() : end].encode())
        low = end
    for piece in cut(text[low:]):
        ids += encoder.encode_ordinary(piece)
    return ids


def encoded(text: Column | str, path: str, pattern: str) -> Column:
    """Token ids of a text column as array<int>; null and empty texts give an empty array."""

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        # A list of Python numbers takes nine times the bytes of the ids, so only one text's is held.
        lists = [np.array(encode_text(t.as_py(), path, pattern), dtype=np.int32) for t in texts]
        ends = np.cumsum([0, *map(len, lists)], dtype=np.int32)
        give_back()
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*lists, np.zeros(0, dtype=np.int32)])))

    return encode(text)


def decoded(ids: Column | str, path: str, pattern: str) -> Column:
    """The raw bytes behind token ids; they need not be valid UTF-8. Null ids give no bytes."""

    @F.arrow_udf("binary")
    def decode(lists: pa.Array) -> pa.Array:
        encoder = encoding(path, pattern)
        return pa.array([encoder.decode_bytes(x.as_py() or []) for x in lists], type=pa.binary())

    return decode(ids)


def tokenize(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Adds `ids` and `n_tokens` to every row and drops nothing; columns of these names are replaced.

    Null texts count as empty and have no ids; texts may have any length and any run of white space. Repeated rows
    stay repeated.
    """
    path, pattern = path or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN
    return docs.withColumn("ids", encoded("text", path, pattern)).withColumn("n_tokens", F.size("ids").cast("long"))


def detokenize(rows: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Adds `raw`, the bytes of `ids`."""
    path, pattern = path or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN
    return rows.withColumn("raw", decoded("ids", path, pattern))


@query("op8_byte_bpe")
def op8_byte_bpe(spark, sf_dir):
    """Every document as token ids and back, as digests."""
    coded = tokenize(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_tokens", "ids")
    return detokenize(coded).select(
        "doc_id",
        "n_tokens",
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("raw", 256).alias("decoded_sha256"),
    )
