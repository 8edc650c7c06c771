"""Shared preparation of the bound fact table and matching SQL fragments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabrisk.operators.clean import Imputer, fit_imputer, normalize_notebook
from tabrisk.session import checkpoint_dir
from tabrisk.sources.tables import BASE_SPEC, BASE_SQL, base

NUM = list(BASE_SPEC.numeric)
CAT = list(BASE_SPEC.categorical)
ID = BASE_SPEC.id
LABEL = BASE_SPEC.label
GROUP_KEYS = ["o_orderpriority", "c_mktsegment"]
KEY_SETS = [["o_orderpriority", "c_mktsegment"], ["o_orderpriority", "o_orderstatus"],
            ["c_mktsegment", "o_orderstatus"]]

# Output doubles are rounded to this many places on both engines.
DP = 4


def r(c: str | Column, dp: int = DP) -> Column:
    """Round like DuckDB ``round(x, dp)``: the binary value times 10^dp to the nearest
    integer (half away from zero), divided back. Spark's ``round`` rounds the shortest
    decimal text instead, which differs on exact decimal ties."""
    from tabrisk.functions.columns import round_binary
    return round_binary(c, dp)


def bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bound table written once to the shared checkpoint folder (``spark.checkpoint.dir``).

    For queries that make several passes (exact quantiles, modes, vocabularies, scaler,
    model fitting, then the final projection): every pass reads the written table instead
    of re-aggregating ``lineitem`` and re-joining, and the lineage is cut, so a lost
    executor recomputes from the written files, not from the scans.
    """
    # Hash-partition on the order key first: the written table keeps its partitioning, and
    # without a shuffle it would inherit the (possibly single-file) orders scan's split count.
    # AQE sizes this shuffle from the data (at least the default parallelism).
    checkpoint_dir(spark)
    return base(spark, sf_dir).repartition(ID).checkpoint(eager=True)


def prepared(spark: SparkSession, sf_dir: str, df: DataFrame | None = None) -> DataFrame:
    """base → mode fill + lower/strip of categories → median fill of numerics (fitted on train).

    ``df``: an already written bound table to reuse (see ``bound``)."""
    df = bound(spark, sf_dir) if df is None else df
    imp = fit_imputer(df, NUM, CAT, where=F.col("is_train") == 1)
    df = normalize_notebook(df, CAT, imp.modes)
    return Imputer(medians=imp.medians).apply(df)


def sql_with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes)


# Mode (ties → smallest) and median fitted on train rows, applied to all rows.
PREPARED_SQL = BASE_SQL.strip() + """,
fit_mode AS (
  SELECT (SELECT o_orderpriority FROM base WHERE is_train = 1 AND o_orderpriority IS NOT NULL
          GROUP BY o_orderpriority ORDER BY count(*) DESC, o_orderpriority LIMIT 1) AS m_pri,
         (SELECT c_mktsegment FROM base WHERE is_train = 1 AND c_mktsegment IS NOT NULL
          GROUP BY c_mktsegment ORDER BY count(*) DESC, c_mktsegment LIMIT 1) AS m_seg),
fit_med AS (
  SELECT median(o_totalprice) AS o_totalprice, median(c_acctbal) AS c_acctbal,
         median(n_lines) AS n_lines, median(sum_qty) AS sum_qty, median(avg_price) AS avg_price,
         median(avg_disc) AS avg_disc, median(avg_tax) AS avg_tax
  FROM base WHERE is_train = 1),
prepared AS (
  SELECT b.o_orderkey, b.o_orderstatus,
         lower(regexp_replace(coalesce(b.o_orderpriority, fm.m_pri), '^\\s+|\\s+$', '', 'g')) AS o_orderpriority,
         lower(regexp_replace(coalesce(b.c_mktsegment, fm.m_seg), '^\\s+|\\s+$', '', 'g')) AS c_mktsegment,
         coalesce(b.o_totalprice, md.o_totalprice) AS o_totalprice,
         coalesce(b.c_acctbal, md.c_acctbal) AS c_acctbal,
         coalesce(b.n_lines, md.n_lines) AS n_lines,
         coalesce(b.sum_qty, md.sum_qty) AS sum_qty,
         coalesce(b.avg_price, md.avg_price) AS avg_price,
         coalesce(b.avg_disc, md.avg_disc) AS avg_disc,
         coalesce(b.avg_tax, md.avg_tax) AS avg_tax,
         b.is_train
  FROM base b, fit_mode fm, fit_med md)"""


def rs(expr: str, dp: int = DP) -> str:
    """SQL rounding that matches Spark's (no negative zero after rounding)."""
    return f"(round({expr}, {dp}) + CAST(0 AS DOUBLE))"
