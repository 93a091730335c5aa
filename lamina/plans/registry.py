"""Registry of named queries: ``name -> (spark, sf_dir) -> DataFrame`` and the
matching oracle SQL (absent for results that are not SQL-expressible)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise KeyError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from lamina.plans import (  # noqa: F401
        batch_queries,
        gold_queries,
        io_queries,
        layer_queries,
        ml_queries,
        ml_train_queries,
    )
