"""All queries of this package."""

from __future__ import annotations

from tillstream.llm import (
    byte_bpe,
    centroids,
    chunk_dedup,
    decontamination,
    licenses,
    main_text,
    near_dedup,
    set_join,
    sharding,
    spelling,
    substring,
    token_files,
    toxicity,
)
from tillstream.llm.registry import QUERIES, SQL

__all__ = [
    "QUERIES",
    "SQL",
    "byte_bpe",
    "centroids",
    "chunk_dedup",
    "decontamination",
    "licenses",
    "main_text",
    "near_dedup",
    "set_join",
    "sharding",
    "spelling",
    "substring",
    "token_files",
    "toxicity",
]
