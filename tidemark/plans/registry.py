"""Registry of named queries and their DuckDB oracle text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(key: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise KeyError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLE[key] = oracle
        return fn
    return deco


def add(key: str, fn: QueryFn, oracle: str | None = None) -> None:
    register(key, oracle)(fn)


def load_all() -> None:
    """Import every plan module so its queries register themselves."""
    from tidemark.plans import (bookings, cleaning_q, healthcare, leads, operators_q,  # noqa: F401
                                restaurant_reports, retail, sources_q, streaming_q, upserts_q)
