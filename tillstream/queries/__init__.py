"""Every operator and model as a named query over the given tables, with its SQL counterpart."""

from __future__ import annotations

from tillstream.queries import aggregates, checks, rows, stores, streams
from tillstream.queries.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "aggregates", "checks", "rows", "stores", "streams"]
