"""Group statistics joined back to rows (deviation from group mean, group z-score).

``x - groupby(k)[c].transform('mean')`` as a window would sort the whole table per
key set and put each key's rows in one task. Here a key set costs one partially
aggregated ``groupBy`` (all columns at once) and a join of the small statistics
table back on the keys — broadcast when its size is proven small; several key sets
share one aggregate and one join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabrisk.operators.clean import nan_as_null
from tabrisk.operators.joins import join_small, null_safe_join
from tabrisk.session import scratch_path

Z_EPS = 1e-6
DIFF_NAME = "{col}_diff_{keys}"
Z_NAME = "{col}_z_{keys}"


def _tag(keys: Sequence[str]) -> str:
    return "_".join(keys)


def _z(dev: Column, std: Column) -> Column:
    return dev / (F.coalesce(std, F.lit(1.0)) + F.lit(Z_EPS))


def group_stats(df: DataFrame, keys: Sequence[str], cols: Sequence[str],
                with_std: bool = True, decimal_scale: dict[str, int] | None = None) -> DataFrame:
    """One aggregate per key set: ``mean`` and sample ``std`` of every column.

    ``decimal_scale`` names columns whose values have at most that many decimals: their
    mean is an exact DECIMAL sum divided by the count, so it does not depend on the
    order in which partial sums are combined (reproducible across runs and engines).
    """
    aggs = []
    decimal_scale = decimal_scale or {}
    df = nan_as_null(df, cols)
    for c in cols:
        if c in decimal_scale:
            exact = F.sum(F.col(c).cast(f"decimal(38,{decimal_scale[c]})")).cast("double")
            aggs.append((exact / F.count(c)).alias(f"__mean_{c}"))
        else:
            aggs.append(F.avg(c).alias(f"__mean_{c}"))
        if with_std:
            aggs.append(F.stddev_samp(c).alias(f"__std_{c}"))
    return df.groupBy(*keys).agg(*aggs)


def group_features(df: DataFrame, keys: Sequence[str], cols: Sequence[str],
                   diff: bool = True, zscore: bool = True, fit: DataFrame | None = None,
                   decimal_scale: dict[str, int] | None = None,
                   diff_name: str = DIFF_NAME, z_name: str = Z_NAME) -> DataFrame:
    """Add a deviation and/or a z-score column per ``cols``, named by the two patterns.

    Statistics come from ``fit`` (default: ``df`` itself, i.e. the stacked frame).
    z = (x - mean) / (std + 1e-6) with a singleton group's NULL std taken as 1.0.
    """
    stats = group_stats(fit if fit is not None else df, keys, cols, with_std=zscore, decimal_scale=decimal_scale)
    joined = join_small(df, stats, list(keys), how="left", null_safe=True)
    tag = _tag(keys)
    new = {}
    for c in cols:
        dev = F.col(c) - F.col(f"__mean_{c}")
        if diff:
            new[diff_name.format(col=c, keys=tag)] = dev
        if zscore:
            new[z_name.format(col=c, keys=tag)] = _z(dev, F.col(f"__std_{c}"))
    out = joined.withColumns(new)
    return out.drop(*[c for c in stats.columns if c.startswith("__")])


def group_diff(df: DataFrame, keys: Sequence[str], cols: Sequence[str], fit: DataFrame | None = None,
               decimal_scale: dict[str, int] | None = None, diff_name: str = DIFF_NAME) -> DataFrame:
    return group_features(df, keys, cols, diff=True, zscore=False, fit=fit, decimal_scale=decimal_scale,
                          diff_name=diff_name)


def group_zscore(df: DataFrame, keys: Sequence[str], cols: Sequence[str], fit: DataFrame | None = None,
                 decimal_scale: dict[str, int] | None = None) -> DataFrame:
    return group_features(df, keys, cols, diff=False, zscore=True, fit=fit, decimal_scale=decimal_scale)


def cell_moments(df: DataFrame, keys: Sequence[str], cols: Sequence[str],
                 decimal_scale: dict[str, int] | None = None) -> DataFrame:
    """One row per combination of all ``keys`` with each column's count, sum, mean and squared deviations.

    These add up: the statistics of any subset of ``keys`` follow from the cells without the rows.
    """
    decimal_scale = decimal_scale or {}
    aggs = []
    for c in cols:
        exact = F.col(c).cast(f"decimal(38,{decimal_scale[c]})") if c in decimal_scale else F.col(c)
        aggs += [F.count(c).alias(f"__n_{c}"), F.sum(exact).alias(f"__sum_{c}"), F.avg(c).alias(f"__avg_{c}"),
                 (F.var_pop(c) * F.count(c)).alias(f"__dev_{c}")]
    return nan_as_null(df, cols).groupBy(*keys).agg(*aggs)


def rolled_stats(cells: DataFrame, keys: Sequence[str], cols: Sequence[str], prefix: str) -> DataFrame:
    """``{prefix}mean_{c}`` and ``{prefix}std_{c}`` (sample) of the groups by ``keys``, from their cells.

    Squared deviations are moved from the cell's mean to the group's, so nothing cancels.
    """
    means = cells.groupBy(*keys).agg(*[
        (F.sum(f"__sum_{c}").cast("double") / F.sum(f"__n_{c}")).alias(f"{prefix}mean_{c}") for c in cols])
    moved = null_safe_join(cells, means, keys)
    aggs = []
    for c in cols:
        mean = F.col(f"{prefix}mean_{c}")
        n = F.sum(f"__n_{c}")
        shift = F.col(f"__avg_{c}") - mean
        squares = F.sum(F.col(f"__dev_{c}") + F.col(f"__n_{c}") * shift * shift)
        aggs += [F.first(mean, ignorenulls=True).alias(f"{prefix}mean_{c}"),
                 F.when(n > 1, F.sqrt(squares / (n - 1))).alias(f"{prefix}std_{c}")]
    return moved.groupBy(*keys).agg(*aggs)


def group_features_multi(df: DataFrame, key_sets: Sequence[Sequence[str]], cols: Sequence[str],
                         fit: DataFrame | None = None, decimal_scale: dict[str, int] | None = None,
                         diff_name: str = DIFF_NAME, z_name: str = Z_NAME) -> DataFrame:
    """Several key sets × columns × (diff, z): ``df`` is read twice, whatever the number of key sets.

    The rows are aggregated once, map-side, by all keys together (no copies of rows per key set). Every key
    set's statistics are rolled up from these cells, and all of them return to the rows by one join on the
    cells' keys. With ``fit`` (statistics of another table, whose cells need not hold all of ``df``'s) there
    is one aggregate and one join per key set.
    """
    if fit is not None:
        out = df
        for keys in key_sets:
            out = group_features(out, keys, cols, fit=fit, decimal_scale=decimal_scale,
                                 diff_name=diff_name, z_name=z_name)
        return out
    spark = df.sparkSession
    union = list(dict.fromkeys(k for keys in key_sets for k in keys))
    path = scratch_path(spark, "cells")
    moments = cell_moments(df, union, cols, decimal_scale)
    moments.write.parquet(path)
    cells = spark.read.schema(moments.schema).parquet(path)
    wide = cells.select(*union)
    for i, keys in enumerate(key_sets):
        wide = null_safe_join(wide, rolled_stats(cells, keys, cols, f"__{i}_"), keys)
    joined = join_small(df, wide, union, how="left", null_safe=True)
    new = {}
    for i, keys in enumerate(key_sets):
        tag = _tag(keys)
        for c in cols:
            dev = F.col(c) - F.col(f"__{i}_mean_{c}")
            new[diff_name.format(col=c, keys=tag)] = dev
            new[z_name.format(col=c, keys=tag)] = _z(dev, F.col(f"__{i}_std_{c}"))
    return joined.withColumns(new).drop(*[c for c in wide.columns if c not in union])
