"""From raw documents to token ids: five stages, each written and read again before the next.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage before kept. All but the last
return the columns they were given. The lists of dropped doc_ids are written first: a short list is then
broadcast by its known size, a long one is joined by a shuffle. Rows without a doc_id pass the stages that
drop by doc_id; rows that share a doc_id are one document and stay or go together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm.byte_bpe import detokenize, tokenize
from tillstream.llm.chunk_dedup import duplicate_groups
from tillstream.llm.decontamination import contaminations
from tillstream.llm.near_dedup import near_duplicate_classes
from tillstream.llm.registry import prepared, stored, table
from tillstream.llm.toxicity import fit, score_of


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The documents whose doc_id is not in a list."""
    ids = stored(dropped.select(F.col("doc_id").alias("dropped_id")).where("dropped_id is not null").distinct(), "dropped")
    return docs.join(ids, docs["doc_id"] == ids["dropped_id"], "left_anti")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier finds toxic go."""
    prepared(spark)
    model = fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return docs.where(score_of("text", model) < 0.5)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id stays."""
    prepared(spark)
    return _without(docs, duplicate_groups(docs.select("doc_id", "text")).where("not kept"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates the one with the smallest doc_id stays."""
    prepared(spark)
    return _without(docs, near_duplicate_classes(docs.select("doc_id", "text")).where("not kept"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    prepared(spark)
    return _without(docs, contaminations(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark")))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text byte by byte."""
    prepared(spark)
    coded = detokenize(tokenize(docs.select("doc_id", "lang", "source", "text")))
    exact = F.col("raw") == F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return coded.select("doc_id", "lang", "source", "n_tokens", "ids", exact.alias("exact"))


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("tokens", tokens),
]

#: SQL can't express the classifier, the signatures or the tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder of tables."""
    docs = table(prepared(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
