"""Registry of named queries and their SQL oracles.

Every query takes ``(spark, sf_dir)``, reads the driver's tables through the
fixtures and returns a DataFrame; ``ORACLE[name]`` is the same question in
portable SQL over the same tables.  Queries without an oracle are checked
against brute force in ``tests/``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from . import q_derive, q_flows, q_grid, q_quality, q_remap, q_serving, q_lifecycle, q_stores, q_stream, q_zones  # noqa: F401
