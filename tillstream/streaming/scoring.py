"""Keyed running statistics on a stream.

State per key is (n, mean, m2). A row is added to the statistics before it is scored, so with n
rows no score can exceed (n - 1) / sqrt(n): nothing is flagged before a key's 11th row.

Calling the state function costs far more than scoring the few rows a key has in a micro-batch. Keys are dealt
by hash to `BUCKETS` groups, and one call scores all keys of a group, so the number of calls does not grow with the keys.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tillstream.functions.money import TIE_SLACK
from tillstream.schemas import SCORE_FIELDS

#: groups of keys; the state of one holds the moments of its keys, and the last time each was seen
BUCKETS = 1 << 11
STATE = "keys array<string>, n array<long>, mean array<double>, m2 array<double>, seen array<long>"
#: columns beside those of the stream
_BUCKET, _KEY = "_bucket", "_key"

# The state function travels with its helpers, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _round_steady(x: np.ndarray, places: int) -> np.ndarray:
    scale = 10.0**places
    return np.sign(x) * np.floor(np.abs(x) * scale + (0.5 + TIE_SLACK)) / scale


def running_scores(values: np.ndarray, n0: int, mean0: float, m20: float, threshold: float):
    """Scores of `values` in order, continuing from the moments (n0, mean0, m20).

    Returns (count, rounded mean, rounded z, flag, new moments). Sums are taken around the carried
    mean (the first value, for a new key), which keeps them small.
    """
    centre = mean0 if n0 else values[0]
    offset = values - centre
    n = n0 + np.arange(1, len(values) + 1)
    total = np.cumsum(offset)
    mean = centre + total / n
    m2 = np.maximum(m20 + np.cumsum(offset * offset) - total * total / n, 0.0)
    spread = np.sqrt(m2 / np.maximum(n - 1, 1))
    scored = (n >= 2) & (spread > 0)
    z = np.divide(values - mean, spread, out=np.zeros(len(values)), where=scored)
    moments = (int(n[-1]), float(mean[-1]), float(m2[-1]))
    return n, _round_steady(mean, 2), _round_steady(z, 4), np.abs(z) > threshold, moments


def _sorted_codes(rows: pd.DataFrame, order: Sequence[str]) -> tuple[np.ndarray, list, np.ndarray]:
    """(positions of the rows by key and `order`, the keys, where each key's rows start among the positions)."""
    codes, keys = pd.factorize(rows[_KEY], use_na_sentinel=False)
    # Later sort keys only matter where the first one repeats within a key.
    repeated = pd.DataFrame({"k": codes, "t": rows[order[0]].to_numpy()}).duplicated().any()
    by = list(order) if repeated else list(order[:1])
    at = rows[by].sort_values(by, kind="stable", ignore_index=False).index.to_numpy()
    at = at[np.argsort(codes[at], kind="stable")]
    starts = np.searchsorted(codes[at], np.arange(len(keys) + 1))
    return at, [None if pd.isna(k) else k for k in keys], starts


def _plain_columns(df: DataFrame) -> DataFrame:
    """Timestamps as microseconds and structs as separate columns: both are slow to turn into
    pandas objects and the state function only sorts by them or hands them on."""
    cells = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            cells.append(F.unix_micros(f.name).alias(f.name))
        elif isinstance(f.dataType, T.StructType):
            cells += [F.col(f.name).getField(g.name).alias(f"{f.name}__{g.name}") for g in f.dataType.fields]
        else:
            cells.append(F.col(f.name))
    return df.select(*cells)


def _typed_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Back to the columns of `schema`; a struct whose fields are all NULL becomes NULL."""
    cells = []
    for f in schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            cells.append(F.timestamp_micros(f.name).alias(f.name))
        elif isinstance(f.dataType, T.StructType):
            parts = [F.col(f"{f.name}__{g.name}").alias(g.name) for g in f.dataType.fields]
            empty = F.forall(F.array(*[p.isNull() for p in parts]), lambda missing: missing)
            cells.append(F.when(~empty, F.struct(*parts)).alias(f.name))
        else:
            cells.append(F.col(f.name))
    return df.select(*cells, *[g.name for g in SCORE_FIELDS])


def score_stream(
    stream: DataFrame,
    key: str = "user_id",
    order: Sequence[str] = ("timestamp", "txn_id"),
    value: str = "amount",
    threshold: float = 3.0,
    ttl_ms: int | None = None,
) -> DataFrame:
    """Input columns plus the four score columns, scored per key in arrival order of micro-batches
    and in `order` inside one.

    Late rows are scored when they arrive. A missing value counts as 0. A key's state never expires unless
    `ttl_ms` (idle processing time) is set. The source's rate limit bounds a key's rows per batch.
    """
    plain = _plain_columns(stream)
    names = plain.columns
    output = T.StructType([*plain.schema.fields, *SCORE_FIELDS])
    score_names = [f.name for f in SCORE_FIELDS]
    sort_keys = list(order)

    def update(_bucket, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:  # no key of the group was seen for so long
            state.remove()
            return
        rows = pd.concat(list(chunks), ignore_index=True)
        now = 0 if ttl_ms is None else state.getCurrentProcessingTimeMs()
        held = {}
        if state.exists:
            held = {k: (n, mean, m2, seen) for k, n, mean, m2, seen in zip(*state.get)}
        if ttl_ms is not None:
            held = {k: m for k, m in held.items() if now - m[3] < ttl_ms}
        at, keys, starts = _sorted_codes(rows, sort_keys)
        rows = rows.iloc[at]
        values = rows[value].fillna(0.0).to_numpy(dtype="float64")
        parts = []
        for k, start, end in zip(keys, starts[:-1], starts[1:]):
            *scores, moments = running_scores(values[start:end], *held.get(k, (0, 0.0, 0.0))[:3], threshold)
            held[k] = (*moments, now)
            parts.append(scores)
        state.update((list(held), *[list(c) for c in zip(*held.values())]))
        if ttl_ms is not None:
            state.setTimeoutDuration(ttl_ms)
        yield rows[names].assign(**{c: np.concatenate(p) for c, p in zip(score_names, zip(*parts))})

    timeout = GroupStateTimeout.NoTimeout if ttl_ms is None else GroupStateTimeout.ProcessingTimeTimeout
    bucket = F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int").alias(_BUCKET)
    grouped = plain.select("*", F.col(key).cast("string").alias(_KEY), bucket).groupBy(_BUCKET)
    scored = grouped.applyInPandasWithState(update, output, STATE, "append", timeout)
    return _typed_columns(scored, stream.schema)
