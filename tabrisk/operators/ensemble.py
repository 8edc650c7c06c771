"""Blending of class-probability vectors, OOF reshaping and one-pass weight searches.

Probabilities are ``array<double>`` columns (one per model) or the long table
``(id, model, class, prob)``. A weight search evaluates every candidate of a fixed,
parameter-sized grid in one pass: each row is expanded by the grid (a constant
factor), confusion counts are partially aggregated per grid point before the
shuffle, so only ``partitions × grid × k²`` rows move. No per-step Spark job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabrisk.functions.columns import argmax_first
from tabrisk.operators import metrics


def weighted_blend(prob_cols: Mapping[str, float], k: int) -> Column:
    """Σ_m w_m · p_m per class (left to right), as an array<double>."""
    out = []
    for c in range(k):
        e = None
        for col, w in prob_cols.items():
            t = F.lit(float(w)) * F.col(col)[c]
            e = t if e is None else e + t
        out.append(e)
    return F.array(*out)


def mean_blend(prob_cols: Sequence[str], k: int) -> Column:
    """Simple average of the models' probability vectors."""
    out = []
    for c in range(k):
        e = None
        for col in prob_cols:
            e = F.col(col)[c] if e is None else e + F.col(col)[c]
        out.append(e / F.lit(len(prob_cols)))
    return F.array(*out)


def soft_vote(df: DataFrame, weights: Mapping[str, float], k: int, out: str = "blend") -> DataFrame:
    """Weighted soft vote + arg-max (first class on ties)."""
    return df.withColumn(out, weighted_blend(weights, k)).withColumn(f"{out}_pred", argmax_first(out))


def fold_average(long: DataFrame, id_col: str, n_folds: int) -> DataFrame:
    """``test += proba / folds``: mean over folds per (id, model, class)."""
    return long.groupBy(id_col, "model", "class").agg((F.sum("prob") / F.lit(n_folds)).alias("prob"))


def long_to_wide(long: DataFrame, id_col: str, models: Sequence[str], k: int) -> DataFrame:
    """Stack features: one column per (class, model), class-major like a row-major reshape."""
    keys = [f"c{c}_{m}" for c in range(k) for m in models]
    tagged = long.withColumn("__key", F.concat(F.lit("c"), F.col("class").cast("string"), F.lit("_"), F.col("model")))
    return tagged.groupBy(id_col).pivot("__key", keys).agg(F.first("prob"))


def multiplier_grid(values: Sequence[float], k: int) -> list[tuple[float, ...]]:
    """All per-class multiplier vectors on a lattice (``len(values) ** k`` points)."""
    return [tuple(p) for p in product(values, repeat=k)]


def simplex_grid(n_models: int, steps: int) -> list[tuple[float, ...]]:
    """All weight vectors with entries i/steps summing to one."""
    pts = []
    for combo in product(range(steps + 1), repeat=n_models):
        if sum(combo) == steps:
            pts.append(tuple(c / steps for c in combo))
    return pts


def _grid_column(points: Sequence[Sequence[float]], names: Sequence[str]) -> Column:
    return F.array(*[F.struct(F.lit(i).alias("grid_id"), *[F.lit(float(v)).alias(n) for v, n in zip(p, names)])
                     for i, p in enumerate(points)])


def score_class_multipliers(df: DataFrame, prob: str, label: str, points: Sequence[Sequence[float]],
                            k: int) -> DataFrame:
    """Weighted F1 of arg-max(w ⊙ p) for every multiplier vector w of the grid."""
    names = [f"w{c}" for c in range(k)]
    ex = df.select(label, prob, F.inline(_grid_column(points, names)))
    pred = argmax_first(F.array(*[F.col(f"w{c}") * F.col(prob)[c] for c in range(k)]))
    conf = metrics.confusion(ex.withColumn("__pred", pred), label, "__pred", by=["grid_id", *names])
    return metrics.summary(conf, by=["grid_id", *names]).select("grid_id", *names, "f1_w")


def score_blend_weights(df: DataFrame, prob_cols: Sequence[str], label: str,
                        points: Sequence[Sequence[float]], k: int) -> DataFrame:
    """Balanced accuracy of the weighted blend for every weight vector of the grid."""
    names = [f"w_{c}" for c in prob_cols]
    ex = df.select(label, *prob_cols, F.inline(_grid_column(points, names)))
    blend = []
    for c in range(k):
        e = None
        for pc, wn in zip(prob_cols, names):
            t = F.col(wn) * F.col(pc)[c]
            e = t if e is None else e + t
        blend.append(e)
    conf = metrics.confusion(ex.withColumn("__pred", argmax_first(F.array(*blend))), label, "__pred",
                             by=["grid_id", *names])
    return metrics.summary(conf, by=["grid_id", *names]).select("grid_id", *names, "balanced_accuracy")


def mark_best(scored: DataFrame, metric: str, order: str = "grid_id") -> DataFrame:
    """Flag the best grid point (ties → smallest id). The scored table has one row per point."""
    best = scored.orderBy(F.desc(metric), F.col(order)).limit(1).select(F.col(order).alias("__best"))
    return (scored.join(F.broadcast(best), F.col(order) == F.col("__best"), "left")
            .withColumn("is_best", F.col("__best").isNotNull().cast("int")).drop("__best"))
