"""Query registry: key -> (Spark builder, oracle SQL or None, check kind)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Registered:
    key: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    section: str


REGISTRY: dict[str, Registered] = {}


def query(key: str, sql: str | None = None, section: str = ""):
    """Register ``fn(spark, data_dir) -> DataFrame`` under ``key`` with the
    equivalent SQL (DuckDB dialect) or ``None`` when no SQL form exists."""
    def deco(fn):
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key}")
        REGISTRY[key] = Registered(key, fn, sql, section)
        return fn
    return deco


def load_all() -> dict[str, Registered]:
    # importing the plan modules fills REGISTRY
    from . import (catalog_relational, catalog_text, catalog_stats,  # noqa: F401
                   catalog_recsys, catalog_models, catalog_io, catalog_checks)
    return REGISTRY
