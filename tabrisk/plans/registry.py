"""Registry of named queries: Spark builder + (optional) DuckDB oracle SQL.

Every builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the driver
tables. The oracle SQL runs on DuckDB views of the same Parquet files; queries whose
semantics are model fitting have no oracle (rows-only check).
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
            ORACLE[name] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    """Import every plan module so that its queries register themselves."""
    from tabrisk.plans import (  # noqa: F401
        bundle_plans,
        checked_models,
        cleaning,
        encoding,
        ensembles,
        features,
        io_plans,
        metrics_plans,
        presets,
        models_plans,
        profiling,
        knn_plans,
        scoring,
        splits,
    )
