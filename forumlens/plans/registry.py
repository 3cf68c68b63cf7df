"""Registry of named queries: Spark plan plus (when SQL can say it) a DuckDB oracle.

Each module under ``plans`` registers its queries with ``@query(name, sql)``;
``all_queries()`` and ``all_oracles()`` feed ``__spark_entry__``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass
class Entry:
    name: str
    fn: QueryFn
    sql: str | None
    survey_id: str


_REGISTRY: dict[str, Entry] = {}
_MODULES = ("digest_queries", "refresh_queries", "state_queries", "context_queries",
            "news_queries", "archive_queries", "quality_queries", "stream_queries")


def query(name: str, survey_id: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _REGISTRY:
            raise ValueError(f"duplicate query {name}")
        _REGISTRY[name] = Entry(name, fn, sql, survey_id)
        return fn
    return deco


def entry_sql(name: str) -> str | None:
    """The oracle of a query that is registered already: another way to the same rows."""
    return _REGISTRY[name].sql


def _load_all() -> None:
    # Import for registration side effects.
    import importlib
    for mod in _MODULES:
        importlib.import_module(f"{__package__}.{mod}")


def all_queries() -> dict[str, QueryFn]:
    _load_all()
    return {k: e.fn for k, e in _REGISTRY.items()}


def all_oracles() -> dict[str, str]:
    _load_all()
    return {k: e.sql for k, e in _REGISTRY.items() if e.sql}


def entries() -> dict[str, Entry]:
    _load_all()
    return dict(_REGISTRY)
