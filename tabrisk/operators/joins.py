"""Join helpers: broadcast by size in bytes, null-safe key joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabrisk.session import scratch_path


def join_small(fact: DataFrame, small: DataFrame, on: Sequence[str], how: str = "left",
               null_safe: bool = False) -> DataFrame:
    """Join ``small`` (a fitted statistic / vocabulary table) onto ``fact``.

    ``small`` is written to the shared folder first, so Spark knows its size in bytes when it plans:
    it is broadcast under ``spark.sql.autoBroadcastJoinThreshold`` and shuffled beyond it, and
    nothing stays cached.
    """
    path = scratch_path(fact.sparkSession, "small")
    small.write.parquet(path)
    right = fact.sparkSession.read.schema(small.schema).parquet(path)
    return null_safe_join(fact, right, on, how) if null_safe else fact.join(right, list(on), how)


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join on ``on`` in which NULL keys meet NULL keys; the key columns come from ``left``."""
    renamed = right.select(*[F.col(k).alias(f"__r_{k}") for k in on],
                           *[c for c in right.columns if c not in on])
    cond = None
    for k in on:
        e = left[k].eqNullSafe(renamed[f"__r_{k}"])
        cond = e if cond is None else cond & e
    return left.join(renamed, cond, how).drop(*[f"__r_{k}" for k in on])
