"""Registry of named queries: a Spark builder plus its DuckDB oracle SQL.

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame over the
driver's tables; the oracle (when the operator is SQL-expressible) is ANSI
SQL over the same tables registered as views.  Floating outputs are rounded
identically on both sides so engine summation order does not matter.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ops: tuple[str, ...]


REGISTRY: dict[str, Query] = {}


def query(name: str, ops: tuple[str, ...] | str, sql: str | None = None):
    """Decorator registering a builder under ``name`` with optional oracle SQL."""
    if isinstance(ops, str):
        ops = (ops,)

    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, tuple(ops))
        return fn

    return deco


def load_all() -> dict[str, Query]:
    # importing the catalog modules fills the registry
    from . import (catalog_audit, catalog_decision, catalog_features, catalog_mart, catalog_misc, catalog_model,  # noqa: F401
                   catalog_pipelines, catalog_tables, catalog_wide)
    return REGISTRY
