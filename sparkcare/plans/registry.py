"""Registry of the proof queries: name -> (spark, sf_dir) -> DataFrame, plus the
DuckDB SQL twin of each (tables are the driver's pre-registered views)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import LazyTables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register ``fn(t: dict[str, DataFrame], spark) -> DataFrame`` under ``name``."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(LazyTables(spark, sf_dir), spark)
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return dict(QUERIES)


def all_oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(ORACLE)


def _load_all() -> None:
    from . import claims, profiles, quality, runs, models, text  # noqa: F401
