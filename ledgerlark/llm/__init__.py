"""Operators for training-data pipelines, and the queries that apply them."""

from ledgerlark.llm import queries_archives, queries_native, queries_search, queries_text  # noqa: F401
from ledgerlark.llm.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
