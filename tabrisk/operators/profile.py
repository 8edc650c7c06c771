"""Profiling aggregates: describe, value counts, IQR outliers, histograms, box plots,
contingency, correlation. Each is a handful of partially aggregated passes; the
quantiles come from the distributed exact sort in ``ranking``."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabrisk.operators.clean import mode_table, nan_as_null
from tabrisk.operators.joins import join_small
from tabrisk.operators.ranking import exact_quantiles, quantile_wide


def describe_numeric(df: DataFrame, cols: Sequence[str], method: str = "exact") -> DataFrame:
    """``df.describe()``: count, mean, sample std, min, 25/50/75 %, max per column (long form).

    NaN is skipped like NULL."""
    cols = list(cols)
    df = nan_as_null(df, cols)
    wide = df.agg(*[F.count(c).alias(f"count__{c}") for c in cols],
                  *[F.avg(c).alias(f"mean__{c}") for c in cols],
                  *[F.stddev_samp(c).alias(f"std__{c}") for c in cols],
                  *[F.min(F.col(c).cast("double")).alias(f"min__{c}") for c in cols],
                  *[F.max(F.col(c).cast("double")).alias(f"max__{c}") for c in cols])
    stack = F.inline(F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.col(f"count__{c}").alias("count"), F.col(f"mean__{c}").alias("mean"),
        F.col(f"std__{c}").alias("std"), F.col(f"min__{c}").alias("min"), F.col(f"max__{c}").alias("max"))
        for c in cols]))
    moments = wide.select(stack)
    q = quantile_wide(exact_quantiles(df, cols, [0.25, 0.5, 0.75], method=method), ["column_name"],
                      {0.25: "p25", 0.5: "p50", 0.75: "p75"})
    return moments.join(q, "column_name", "left")


def describe_categorical(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``describe(include='object')``: count, unique, top (most frequent, smallest on ties), freq."""
    cols = list(cols)
    wide = df.agg(*[F.count(c).alias(f"count__{c}") for c in cols],
                  *[F.count_distinct(c).alias(f"unique__{c}") for c in cols])
    stats = wide.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.col(f"count__{c}").alias("count"), F.col(f"unique__{c}").alias("unique"))
        for c in cols])))
    top = mode_table(df, cols).select("column_name", F.col("value").alias("top"), F.col("n").alias("freq"))
    return stats.join(top, "column_name", "left")


def value_counts(df: DataFrame, col: str, normalize: bool = True) -> DataFrame:
    """``value_counts()``: non-null values by descending count (value as tie-break), with pct."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    if normalize:
        total = counts.agg(F.sum("n")).first()[0] or 0
        counts = counts.withColumn("pct", F.col("n") * 100.0 / F.lit(total))
    return counts.orderBy(F.desc("n"), col)


def iqr_outliers(df: DataFrame, cols: Sequence[str], k: float = 1.5, flag_pct: float = 5.0,
                 method: str = "exact") -> DataFrame:
    """Per column: Q1, Q3, IQR, bounds, outlier count / pct, and a flag when pct > ``flag_pct``.

    NaN is missing: never an outlier, but counted among the rows."""
    cols = list(cols)
    df = nan_as_null(df, cols)
    q = quantile_wide(exact_quantiles(df, cols, [0.25, 0.75], method=method), ["column_name"],
                      {0.25: "q1", 0.75: "q3"}).collect()
    bounds = {row["column_name"]: (row["q1"], row["q3"]) for row in q}
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for c in cols:
        q1, q3 = bounds.get(c, (None, None))
        if q1 is None:
            aggs.append(F.lit(0).cast("long").alias(f"out__{c}"))
            continue
        lo, hi = q1 - k * (q3 - q1), q3 + k * (q3 - q1)
        aggs.append(F.count_if((F.col(c) < lo) | (F.col(c) > hi)).alias(f"out__{c}"))
    counts = df.agg(*aggs)
    rows = []
    for c in cols:
        q1, q3 = bounds.get(c, (None, None))
        iqr = None if q1 is None else q3 - q1
        rows.append(F.struct(
            F.lit(c).alias("column_name"), F.lit(q1).cast("double").alias("q1"), F.lit(q3).cast("double").alias("q3"),
            F.lit(iqr).cast("double").alias("iqr"),
            F.lit(None if q1 is None else q1 - k * iqr).cast("double").alias("lower"),
            F.lit(None if q1 is None else q3 + k * iqr).cast("double").alias("upper"),
            F.col(f"out__{c}").cast("long").alias("n_outliers"),
            (F.col(f"out__{c}") * 100.0 / F.col("__rows")).alias("pct")))
    out = counts.select(F.inline(F.array(*rows)))
    return out.withColumn("is_flagged", (F.col("pct") > flag_pct).cast("int"))


def _bin_expr(x, mn, mx, bins: int):
    """Equal-width bin 1..bins, last bin closed (``np.histogram``); constant column → bin 1."""
    raw = F.floor((x - mn) * F.lit(bins) / (mx - mn)) + 1
    return F.when(mx == mn, F.lit(1)).otherwise(F.least(raw, F.lit(bins))).cast("int")


def histogram_bins(df: DataFrame, col: str, bins: int = 40, by: str | None = None) -> DataFrame:
    """Equal-width histogram over the global range, every bin listed (zero counts included)."""
    src = df.where(F.col(col).isNotNull() & ~F.isnan(F.col(col).cast("double")))
    rng = src.agg(F.min(F.col(col).cast("double")).alias("mn"), F.max(F.col(col).cast("double")).alias("mx")).first()
    mn, mx = rng["mn"], rng["mx"]
    if mn is None:
        key = f"{by} {dict(df.dtypes)[by]}, " if by else ""
        return df.sparkSession.createDataFrame([], f"{key}bin int, bin_lo double, bin_hi double, n long")
    keys = [by] if by else []
    counts = src.groupBy(*keys, _bin_expr(F.col(col).cast("double"), F.lit(mn), F.lit(mx), bins).alias("bin")) \
        .agg(F.count(F.lit(1)).alias("n"))
    grid = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    if by:
        groups = src.select(by).distinct()
        grid = _grid_by(groups, by, bins)
    width = (mx - mn) / bins
    # grid has bins × groups rows and counts at most as many: both sides are small.
    out = grid.join(counts, keys + ["bin"], "left")
    return out.select(*keys, "bin",
                      (F.lit(mn) + (F.col("bin") - 1) * F.lit(width)).alias("bin_lo"),
                      (F.lit(mn) + F.col("bin") * F.lit(width)).alias("bin_hi"),
                      F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"))


def _grid_by(groups: DataFrame, by: str, bins: int) -> DataFrame:
    """Every (group, bin) pair; groups is the (small) distinct key list, bins a literal array."""
    return groups.select(by, F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))


def boxplot_stats(df: DataFrame, col: str, by: str, method: str = "exact") -> DataFrame:
    """Per group: n, min, Q1, median, Q3, max, 1.5·IQR whiskers and outlier count."""
    df = nan_as_null(df, [col])
    src = df.where(F.col(col).isNotNull())
    q = quantile_wide(exact_quantiles(src, [col], [0.0, 0.25, 0.5, 0.75, 1.0], by=[by], method=method),
                      [by], {0.0: "min", 0.25: "q1", 0.5: "median", 0.75: "q3", 1.0: "max"})
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    joined = join_small(src.select(by, F.col(col).cast("double").alias("__x")), q, [by], how="inner")
    lo = F.col("q1") - F.lit(1.5) * F.col("iqr")
    hi = F.col("q3") + F.lit(1.5) * F.col("iqr")
    return joined.groupBy(by, "min", "q1", "median", "q3", "max", "iqr").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(F.col("__x") >= lo, F.col("__x"))).alias("whisker_lo"),
        F.max(F.when(F.col("__x") <= hi, F.col("__x"))).alias("whisker_hi"),
        F.count_if((F.col("__x") < lo) | (F.col("__x") > hi)).alias("n_outliers"))


def contingency(df: DataFrame, col: str, label: str, wide: bool = False) -> DataFrame:
    """Category × target counts; long ``(col, label, n)`` or pivoted one column per class."""
    long = df.groupBy(col, label).agg(F.count(F.lit(1)).alias("n"))
    if not wide:
        return long
    classes = [r[0] for r in df.select(label).distinct().orderBy(label).collect()]
    return df.groupBy(col).pivot(label, classes).count()


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson r for every ordered pair (pairwise complete rows), all pairs in one aggregate."""
    cols = list(cols)
    pairs = list(combinations(cols, 2))
    wide = df.agg(*[F.corr(a, b).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    entries = []
    for i, (a, b) in enumerate(pairs):
        entries += [F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"{i}").alias("r")),
                    F.struct(F.lit(b).alias("col_a"), F.lit(a).alias("col_b"), F.col(f"{i}").alias("r"))]
    entries += [F.struct(F.lit(c).alias("col_a"), F.lit(c).alias("col_b"), F.lit(1.0).alias("r")) for c in cols]
    return wide.select(F.inline(F.array(*entries)))


def high_correlation_pairs(df: DataFrame, cols: Sequence[str], threshold: float = 0.7) -> DataFrame:
    """Lower-triangle pairs with |r| > threshold, strongest first."""
    order = {c: i for i, c in enumerate(cols)}
    cm = correlation_matrix(df, cols)
    idx = F.create_map(*[x for c, i in order.items() for x in (F.lit(c), F.lit(i))])
    return (cm.where((idx[F.col("col_a")] > idx[F.col("col_b")]) & (F.abs("r") > threshold))
            .orderBy(F.desc(F.abs("r")), "col_a", "col_b"))


def pair_grid_counts(df: DataFrame, cols: Sequence[str], bins: int = 10, by: str | None = None) -> DataFrame:
    """2-D equal-width bin counts for every column pair (scatter-matrix density on all rows)."""
    cols = list(cols)
    src = df.na.drop(subset=cols)
    rng = src.agg(*[F.min(F.col(c).cast("double")).alias(f"mn_{c}") for c in cols],
                  *[F.max(F.col(c).cast("double")).alias(f"mx_{c}") for c in cols]).first()
    b = {c: _bin_expr(F.col(c).cast("double"), F.lit(rng[f"mn_{c}"]), F.lit(rng[f"mx_{c}"]), bins) for c in cols}
    entries = [F.struct(F.lit(a).alias("col_a"), F.lit(c2).alias("col_b"), b[a].alias("bin_a"), b[c2].alias("bin_b"))
               for a, c2 in combinations(cols, 2)]
    keys = [by] if by else []
    return (src.select(*keys, F.inline(F.array(*entries)))
            .groupBy(*keys, "col_a", "col_b", "bin_a", "bin_b").agg(F.count(F.lit(1)).alias("n")))
