"""Queries of this package, their SQL, and helpers on DataFrames they share."""

from __future__ import annotations

import functools
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.session import apply_settings, scratch_path

#: bytes of an Arrow batch that goes to a Python worker; several such batches and what is made of them are held at once
BATCH_BYTES = "4m"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the settings that the operators of this package rely on."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return apply_settings(spark)


def query(name: str, sql: str | None = None):
    """Register a query; without `sql` it is tested against brute force only."""

    def register(build):
        @functools.wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(prepared(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: later steps survive lost executors and
    do not repeat the work before."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def normal_words(text: Column) -> Column:
    """Lower-cased letters and digits, one space between words."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+", " "))


def parts_for(df: DataFrame, column: str, part_bytes: int) -> int:
    """How many parts hold about `part_bytes` of the column's bytes each, and at least one for every
    shuffle partition. One counting pass: a plan's own estimate is far off after joins."""
    total = df.agg(F.sum(F.octet_length(column)).alias("n")).first()["n"] or 0
    return max(1, math.ceil(total / part_bytes), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
