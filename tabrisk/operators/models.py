"""Distributed model training, probabilities, cross-validation and searches on MLlib.

Fitting is MLlib's own distributed optimisation (treeAggregate over executors); the
fold loops here only select rows by a ``fold`` column and write each fold's held-out
predictions to a stage table, so lineage stays short and a lost executor only
recomputes the current fold.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabrisk.operators.score import ScoreBundle, predict_proba
from tabrisk.session import scratch_path

MAX_CONCURRENT_FITS = 4  # folds or members fitted at the same time
FOREST_PASS_MB = 256  # of node sums that each task of a forest's pass holds
MAX_TREE_DEPTH = 30  # MLlib's limit; a caller that wants no limit asks for this


def _depth(max_depth: int) -> int:
    if not 0 <= max_depth <= MAX_TREE_DEPTH:
        raise ValueError(f"max_depth {max_depth}: MLlib trees have a depth of 0 to {MAX_TREE_DEPTH}")
    return max_depth


def logistic_regression(label: str = "label", weight: str | None = "weight", max_iter: int = 200,
                        reg: float = 0.0, tol: float = 1e-4) -> LogisticRegression:
    """Multinomial L-BFGS; ``tol`` 1e-4 is the usual stopping tolerance of the reference's solver."""
    lr = LogisticRegression(family="multinomial", labelCol=label, featuresCol="features",
                            maxIter=max_iter, regParam=reg, standardization=False, tol=tol)
    if weight:
        lr.setWeightCol(weight)
    return lr


def decision_tree(label: str = "label", weight: str | None = "weight", max_depth: int = 10,
                  min_instances: int = 10, seed: int = 42) -> DecisionTreeClassifier:
    dt = DecisionTreeClassifier(labelCol=label, featuresCol="features", maxDepth=_depth(max_depth),
                                minInstancesPerNode=min_instances, seed=seed, cacheNodeIds=True,
                                maxMemoryInMB=1024, checkpointInterval=10)
    if weight:
        dt.setWeightCol(weight)
    return dt


def random_forest(label: str = "label", weight: str | None = "weight", num_trees: int = 100,
                  max_depth: int = 15, min_instances: int = 5, bootstrap: bool = True,
                  seed: int = 42) -> RandomForestClassifier:
    """Forest with sqrt feature sampling; ``bootstrap=False`` is the de-correlated
    no-resampling variant (MLlib offers no random cut-points, so not 'extra trees')."""
    # Deep trees: cache node ids (no re-descent per level). Every task of a pass holds sums for maxMemoryInMB of
    # nodes, and so do the merging tasks: a gigabyte each is too much where tasks share an executor.
    rf = RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=num_trees,
                                maxDepth=_depth(max_depth), minInstancesPerNode=min_instances,
                                featureSubsetStrategy="sqrt", bootstrap=bootstrap, seed=seed,
                                cacheNodeIds=True, maxMemoryInMB=FOREST_PASS_MB, checkpointInterval=10)
    if weight:
        rf.setWeightCol(weight)
    return rf


def fit_boosted_members(df: DataFrame, k: int, label: str = "label", weight: str | None = "weight",
                        max_iter: int = 50, step: float = 0.1, max_depth: int = 5,
                        subsample: float = 1.0, feature_subset: str = "all", seed: int = 42) -> ScoreBundle:
    """Multiclass boosting as one binary ``GBTClassifier`` per class (one-vs-rest).

    The binary members keep their probability columns, so class probabilities are
    ``p_c / Σ p`` with no Python in the plan, and the members also run on streams.
    """
    def member(c: int):
        g = GBTClassifier(labelCol="__bin", featuresCol="features", maxIter=max_iter, stepSize=step,
                          maxDepth=_depth(max_depth), subsamplingRate=subsample, featureSubsetStrategy=feature_subset,
                          seed=seed, cacheNodeIds=True, checkpointInterval=10)
        if weight:
            g.setWeightCol(weight)
        return g.fit(df.withColumn("__bin", (F.col(label) == c).cast("double")))

    # The members don't depend on each other: their jobs share the cluster.
    with ThreadPool(min(k, MAX_CONCURRENT_FITS)) as pool:
        members = pool.map(member, range(k))
    return ScoreBundle(feature_names=(), classes=tuple(str(c) for c in range(k)), members=tuple(members))


def proba_frame(model, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``keep`` columns + ``proba`` array + arg-max ``pred`` for a fitted model or member bundle."""
    from tabrisk.functions.columns import argmax_first
    if isinstance(model, ScoreBundle):
        out = predict_proba(df, model)
    else:
        out = model.transform(df).withColumn("proba", vector_to_array("probability"))
    return out.select(*keep, "proba").withColumn("pred", argmax_first("proba"))


def feature_importances(model, names: Sequence[str], spark: SparkSession, top: int | None = None) -> DataFrame:
    """Ranked ``(feature, importance)`` from a tree model (a tiny driver-side vector)."""
    imp = model.featureImportances.toArray().tolist()
    df = spark.createDataFrame([(n, float(v)) for n, v in zip(names, imp)], "feature string, importance double")
    df = df.orderBy(F.desc("importance"), "feature")
    return df.limit(top) if top else df


def weighted_f1(df: DataFrame, label: str = "label", pred: str = "pred") -> float:
    from tabrisk.operators.metrics import confusion, summary
    return summary(confusion(df, label, pred)).first()["f1_w"]


def oof_predictions(df: DataFrame, fit: Callable[[DataFrame], object], k_folds: int, keep: Sequence[str],
                    fold_col: str = "fold", name: str = "model") -> DataFrame:
    """Out-of-fold predictions: fit on folds ≠ f, predict fold f, for every fold.

    Each fold's predictions are written to its own part of a Parquet stage table in the shared
    checkpoint folder; the returned frame reads it back (every row predicted once).
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"oof_{name}")

    def one(f: int) -> str:
        model = fit(df.where(F.col(fold_col) != f))
        held = df.where(F.col(fold_col) == f)
        pf = proba_frame(model, held, [*keep, fold_col]).withColumn("model", F.lit(name))
        pf.write.parquet(f"{path}/part={f}")
        return f"{path}/part={f}"

    with ThreadPool(min(k_folds, MAX_CONCURRENT_FITS)) as pool:
        paths = pool.map(one, range(k_folds))
    return spark.read.parquet(*paths)


def cross_validate(df: DataFrame, fit: Callable[[DataFrame], object], k_folds: int, keep: Sequence[str],
                   label: str = "label", name: str = "model") -> tuple[DataFrame, DataFrame]:
    """OOF rows and per-fold weighted F1 (mean / population std via ``cv_summary``)."""
    from tabrisk.operators.metrics import confusion, summary
    oof = oof_predictions(df, fit, k_folds, keep, name=name)
    per_fold = summary(confusion(oof, label, "pred", by=["fold"]), by=["fold"]).select("fold", "f1_w")
    return oof, per_fold


def grid_search(df: DataFrame, estimator, grid: list, fold_col: str = "fold", label: str = "label",
                parallelism: int = 4, k_folds: int = 5):
    """``CrossValidator`` over user-assigned folds (weighted F1); best model refit on all rows."""
    ev = MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction", metricName="f1")
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=grid, evaluator=ev, foldCol=fold_col,
                        numFolds=k_folds, parallelism=parallelism, seed=42)
    return cv.fit(df.withColumn(fold_col, F.col(fold_col).cast("int")))


def random_search(df: DataFrame, estimator, grid: list, n_iter: int, seed: int = 42, **kw):
    """Seeded sample of ``n_iter`` parameter maps from the full grid, then ``grid_search``."""
    rng = random.Random(seed)
    picked = rng.sample(grid, min(n_iter, len(grid)))
    return grid_search(df, estimator, picked, **kw), picked


def save_pipeline(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def build_pipeline(stages: list) -> Pipeline:
    return Pipeline(stages=stages)


def param_grid(estimator, **params) -> list:
    b = ParamGridBuilder()
    for name, values in params.items():
        b = b.addGrid(estimator.getParam(name), list(values))
    return b.build()
