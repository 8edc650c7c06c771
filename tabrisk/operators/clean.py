"""Cleaning: category normalisation, median / mode imputation, duplicates, null reports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabrisk.functions.columns import nan_to_null, round_binary, strip_ws
from tabrisk.operators.ranking import exact_quantiles


def normalize_script(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Script order: NULL → the text ``'nan'``, then lower-case and strip."""
    return df.withColumns({c: F.coalesce(F.lower(strip_ws(c)), F.lit("nan")) for c in cols})


def normalize_notebook(df: DataFrame, cols: Sequence[str], modes: dict[str, str]) -> DataFrame:
    """Notebook order: impute the mode first, then lower-case and strip."""
    return df.withColumns({c: F.lower(strip_ws(F.coalesce(F.col(c), F.lit(modes[c])))) for c in cols})


def fit_medians(df: DataFrame, cols: Sequence[str], method: str = "exact") -> dict[str, float | None]:
    """Median of each column (NULL/NaN skipped). Exact by default via a distributed sort."""
    q = exact_quantiles(df, cols, [0.5], method=method).collect()
    got = {r["column_name"]: r["value"] for r in q}
    return {c: got.get(c) for c in cols}


def mode_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, value, n)`` of each column's most frequent non-null value, smallest on ties.

    Two partially aggregated passes (count per value, then max count per column)
    instead of a per-column value map, so a column with very many distinct values
    never lands in a single task.
    """
    long = (df.select(*[F.col(c).cast("string").alias(c) for c in cols])
            .unpivot([], list(cols), "column_name", "value").where(F.col("value").isNotNull()))
    counts = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    top = counts.groupBy("column_name").agg(F.max("n").alias("n"))
    return (counts.join(top, ["column_name", "n"], "inner")
            .groupBy("column_name").agg(F.min("value").alias("value"), F.first("n").alias("n")))


def fit_modes(df: DataFrame, cols: Sequence[str]) -> dict[str, str | None]:
    got = {r["column_name"]: r["value"] for r in mode_table(df, cols).collect()}
    return {c: got.get(c) for c in cols}


@dataclass(frozen=True)
class Imputer:
    """Fitted fill values (literals); ``apply`` is a projection usable on streams."""
    medians: dict = field(default_factory=dict)
    modes: dict = field(default_factory=dict)

    def apply(self, df: DataFrame, only_with_nulls: Sequence[str] | None = None) -> DataFrame:
        fills = {}
        for c, m in self.medians.items():
            if m is not None and (only_with_nulls is None or c in only_with_nulls):
                fills[c] = F.coalesce(nan_to_null(F.col(c).cast("double")), F.lit(float(m)))
        for c, m in self.modes.items():
            if m is not None and (only_with_nulls is None or c in only_with_nulls):
                fills[c] = F.coalesce(F.col(c), F.lit(m))
        return df.withColumns(fills) if fills else df


def fit_imputer(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (),
                where: "F.Column | None" = None, method: str = "exact") -> Imputer:
    """Fit medians / modes on ``df`` (optionally only rows matching ``where``, e.g. train)."""
    src = df.where(where) if where is not None else df
    return Imputer(medians=fit_medians(src, numeric, method) if numeric else {},
                   modes=fit_modes(src, categorical) if categorical else {})


def is_missing(df: DataFrame, c: str) -> Column:
    """NULL, or NaN in a floating column."""
    null = F.col(c).isNull()
    return null | F.isnan(F.col(c)) if dict(df.dtypes)[c] in ("double", "float") else null


def nan_as_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``df`` with NaN in the floating columns among ``cols`` as NULL."""
    kinds = dict(df.dtypes)
    fix = {c: nan_to_null(c) for c in cols if kinds[c] in ("double", "float")}
    return df.withColumns(fix) if fix else df


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(column, n_null)`` from one aggregate over all columns."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count_if(is_missing(df, c)).alias(c) for c in cols])
    return wide.unpivot([], cols, "column_name", "n_null")


def missing_report(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Missing count and percentage (2 dp) for columns with any NULL, most missing first."""
    cols = list(cols or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("__rows"),
                  *[F.count_if(is_missing(df, c)).alias(c) for c in cols])
    long = wide.unpivot(["__rows"], cols, "column_name", "missing")
    return (long.where(F.col("missing") > 0)
            .select("column_name", F.col("missing").cast("long").alias("missing"),
                    round_binary(F.col("missing") * 100.0 / F.col("__rows"), 2).alias("pct"))
            .orderBy(F.desc("missing"), "column_name"))


def dedup_rows(df: DataFrame) -> DataFrame:
    """``drop_duplicates()``: hash aggregate with map-side combine, so hot copies collapse early."""
    return df.dropDuplicates()


def dedup_keep_first(df: DataFrame, subset: Sequence[str], order: str) -> DataFrame:
    """Keep, per ``subset`` key, the row with the smallest ``order`` value.

    ``min_by`` over a struct is a partial aggregate with constant state per key, so a
    key holding a third of all rows is reduced map-side (no window over the group).
    """
    others = [c for c in df.columns if c not in subset]
    agg = df.groupBy(*subset).agg(F.min_by(F.struct(*others), F.col(order)).alias("__row"))
    return agg.select(*subset, *[F.col(f"__row.{c}").alias(c) for c in others]).select(*df.columns)


def duplicate_count(df: DataFrame) -> DataFrame:
    """``(rows, distinct_rows, duplicates)`` — ``df.duplicated().sum()``."""
    per = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    return per.agg(F.sum("__n").cast("long").alias("rows"),
                   F.count(F.lit(1)).cast("long").alias("distinct_rows"),
                   F.sum(F.col("__n") - 1).cast("long").alias("duplicates"))


def quality_snapshot(df: DataFrame, name: str) -> DataFrame:
    """One row: table name, rows, columns, missing cells, duplicate rows."""
    cols = df.columns
    # Copies share their null pattern, so one grouping by the whole row gives all three.
    per = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"))
    nulls = None
    for c in cols:
        t = is_missing(df, c).cast("long")
        nulls = t if nulls is None else nulls + t
    return per.agg(F.sum("__n").cast("long").alias("rows"),
                   F.sum(F.col("__n") * nulls).cast("long").alias("missing_cells"),
                   F.sum(F.col("__n") - 1).cast("long").alias("duplicates")).select(
        F.lit(name).alias("table_name"), "rows", F.lit(len(cols)).alias("n_columns"),
        "missing_cells", "duplicates")


def expect_no_nulls(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Violations of the zero-null expectation: ``(column, n_null)`` rows with n_null > 0."""
    return (null_counts(df, cols).where(F.col("n_null") > 0)
            .select("column_name", F.col("n_null").cast("long").alias("n_null")))


def assert_no_nulls(df: DataFrame, cols: Sequence[str] | None = None) -> None:
    bad = expect_no_nulls(df, cols).collect()
    if bad:
        raise AssertionError(f"null values found: {[(r['column_name'], r['n_null']) for r in bad]}")


def missing_pattern(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Null-pattern counts: one bit per column (1 = NULL), most frequent pattern first."""
    bits = F.concat(*[is_missing(df, c).cast("int").cast("string") for c in cols])
    return (df.groupBy(bits.alias("pattern")).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), "pattern"))
