"""Registered queries with the SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Queries by name; the SQL is left out where none says the same."""

    def __init__(self) -> None:
        self.queries: dict[str, Build] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None, name: str | None = None) -> Callable[[Build], Build]:
        """Register under ``name``, or the function's own name."""
        def keep(build: Build) -> Build:
            key = name or build.__name__
            self.queries[key] = build
            if sql is not None:
                self.sql[key] = sql
            return build
        return keep


def load() -> tuple[dict[str, Build], dict[str, str]]:
    """All queries and all SQL, theme by theme."""
    from . import cleaning, documents, enrichment, logs, messages, metrics, profiles, reports, storage

    themes = (cleaning, profiles, enrichment, storage, reports, documents, messages, logs, metrics)
    queries: dict[str, Build] = {}
    sql: dict[str, str] = {}
    for theme in themes:
        queries |= theme.registry.queries
        sql |= theme.registry.sql
    return queries, sql
