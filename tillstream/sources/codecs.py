"""JSON text to typed rows and back. Bad rows are split off, never lost silently."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.functions.times import event_time
from tillstream.schemas import DAILY_SPEND_JSON, ENRICHED_JSON, TRANSACTION_JSON

_CORRUPT = "_corrupt"


def decode_json(df: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """Input columns plus `record` (the typed struct) and `_corrupt` (the text, if malformed).

    The text is parsed in a generator: filters on the fields stay above it, so each text is parsed
    once. As a plain column the parser would be copied into every filter and field that uses it.
    """
    with_corrupt = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    parser = F.from_json(F.col(column), with_corrupt, options).alias("_parsed")
    parsed = df.select(*df.columns, F.inline(F.array(F.struct(parser))))
    record = F.struct(*[F.col(f"_parsed.{f.name}").alias(f.name) for f in schema.fields])
    # An empty or NULL text parses to NULL or to a record without any field.
    empty = F.col(column).isNull() | (F.trim(F.col(column)) == "")
    corrupt = F.when(empty, F.coalesce(F.col(column), F.lit(""))).otherwise(F.col(f"_parsed.{_CORRUPT}"))
    return parsed.select(*df.columns, record.alias("record"), corrupt.alias(_CORRUPT))


def _split(decoded: DataFrame, usable: Column, shape: list[Column], column: str) -> tuple[DataFrame, DataFrame]:
    good = F.col(_CORRUPT).isNull() & F.coalesce(usable, F.lit(False))
    return decoded.where(good).select(*shape), decoded.where(~good).select(column)


def parse_transactions(df: DataFrame, column: str = "value", keep_text: bool = False) -> tuple[DataFrame, DataFrame]:
    """(transactions with a typed event time, quarantined texts). A record needs a user. `keep_text` leaves the
    text in a last column of the transactions."""
    decoded = decode_json(df, TRANSACTION_JSON, column)
    fields = _transaction_fields() + ([F.col(column)] if keep_text else [])
    return _split(decoded, F.col("record.user_id").isNotNull(), fields, column)


def _transaction_fields() -> list[Column]:
    return [
        (event_time("record.timestamp") if f.name == "timestamp" else F.col(f"record.{f.name}")).alias(f.name)
        for f in TRANSACTION_JSON.fields
    ]


def read_transactions(df: DataFrame, column: str = "value") -> DataFrame:
    """Every text with its fields and `usable`, for callers that use both sides of `parse_transactions` and keep
    the result, so that each text is parsed once."""
    usable = F.col(_CORRUPT).isNull() & F.coalesce(F.col("record.user_id").isNotNull(), F.lit(False))
    return decode_json(df, TRANSACTION_JSON, column).select(*_transaction_fields(), F.col(column), usable.alias("usable"))


def decode_enriched(df: DataFrame, column: str = "value", keep_text: bool = False) -> tuple[DataFrame, DataFrame]:
    """(scored transactions, quarantined texts). A timestamp that cannot be read is quarantined; a
    missing one stays NULL and a numeric one is seconds. `keep_text` as in `parse_transactions`."""
    decoded = decode_json(df, ENRICHED_JSON, column)
    text = F.col("record.timestamp")
    seconds = text.try_cast("double")
    ts = F.when(seconds.isNotNull(), event_time(text)).otherwise(F.try_to_timestamp(text))
    fields = [
        (ts if f.name == "timestamp" else F.col(f"record.{f.name}")).alias(f.name) for f in ENRICHED_JSON.fields
    ]
    fields += [F.col(column)] if keep_text else []
    return _split(decoded, text.isNull() | ts.isNotNull(), fields, column)


def decode_daily(df: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """(daily spend with timestamp bounds, quarantined texts)."""
    decoded = decode_json(df, DAILY_SPEND_JSON, column)
    bounds = ("window_start", "window_end")
    fields = [
        (F.timestamp_millis(F.col(f"record.{f.name}")) if f.name in bounds else F.col(f"record.{f.name}")).alias(f.name)
        for f in DAILY_SPEND_JSON.fields
    ]
    return _split(decoded, F.lit(True), fields, column)


def encode_json(df: DataFrame, key: str | None = "user_id", column: str = "value") -> DataFrame:
    """Rows as JSON text with NULL fields kept, keyed for a topic when `key` is given."""
    text = F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias(column)
    return df.select(*([F.col(key).alias("key")] if key else []), text)


def iso_text(ts: Column | str) -> Column:
    """ISO-8601 text in UTC with microseconds."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def encode_transactions(df: DataFrame) -> DataFrame:
    """Transactions as the JSON text their producers send."""
    return encode_json(df.withColumn("timestamp", iso_text("timestamp")))


def encode_daily(df: DataFrame) -> DataFrame:
    """Closed windows as JSON text with bounds in epoch milliseconds."""
    millis = {c: F.unix_millis(F.col(c)) for c in ("window_start", "window_end")}
    return encode_json(df.withColumns(millis))


def flatten_location(df: DataFrame) -> DataFrame:
    """`location` struct to `location_lat` and `location_lon`; a missing struct gives NULLs."""
    flat = df.withColumns({"location_lat": F.col("location.lat"), "location_lon": F.col("location.lon")})
    return flat.drop("location")
