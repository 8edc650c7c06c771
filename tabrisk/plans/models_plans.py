"""Model queries (M1–M18, N4, N7) — rows-only tier: fitting has no SQL equivalent.

Models train on the bound order table (train rows) and score its validation rows,
so the work grows with the data.
"""

from __future__ import annotations

import random
from functools import reduce
from itertools import product

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabrisk.functions.columns import argmax_first
from tabrisk.operators import cube, encode, metric_knn, metrics, models, split, tree_models
from tabrisk.operators.score import fit_prep
from tabrisk.operators.tree_models import Fit
from tabrisk.operators.trees import Boosting, Forest, Growth
from tabrisk.plans.common import CAT, ID, LABEL, NUM, bound
from tabrisk.plans.registry import register
from tabrisk.sources.tables import CLASSES

K = len(CLASSES)

# The reference's settings. A share of rows without a frequency has no effect in the leaf-wise booster, so it isn't set there.
LGBM = Boosting(450, 0.03, Growth(depth=7, leaves=63, least=30, columns=0.85))
XGB = Boosting(400, 0.03, Growth(depth=6, l2=1.0, hessian=1.0, columns=0.85), rows=0.85)
HIST = Boosting(350, 0.03, Growth(leaves=63, least=20))
CATBOOST = Boosting(300, 0.05, Growth(depth=7, l2=3.0, symmetric=True))
EXTRA = Forest(150, Growth(depth=16, split=10, random_cuts=True), bootstrap=False)
FOREST = Forest(200, Growth(depth=15, split=10))
BOOSTED = Boosting(200, 0.1, Growth(depth=5, leaves=31, least=20), balanced=False)
STACK = {"lightgbm": LGBM, "xgboost": XGB, "histgb": HIST, "extratrees": EXTRA, "catboost": CATBOOST}
COMPARED = {"logreg": dict(max_iter=1000), "tree": dict(max_depth=10, min_instances=10), "forest": FOREST, "boosting": BOOSTED}
META_ITER = 1000
FOLDS = 5
FOREST_GRID = dict(trees=[100, 200], depth=[10, 15, 0], split=[5, 10], least=[1, 2])
BOOSTED_GRID = dict(rounds=[100, 150], step=[0.05, 0.1], depth=[3, 5])
DRAWN_GRID = dict(trees=[100, 150, 200], depth=[10, 12, 15, 20], split=[5, 10, 15], least=[1, 2, 4])
DRAWS = 15


def model_table(spark, sf_dir, with_folds: bool = False) -> tuple[DataFrame, tuple]:
    """Features (scaled numerics + codes), label code, balanced weight, fold and split.

    All statistics are fitted on the train rows only; the table is persisted because
    every fold / model re-reads it.
    """
    b = bound(spark, sf_dir)
    train = b.where(F.col("is_train") == 1)
    prep = fit_prep(train, NUM, CAT)
    df = prep.apply(b)
    code = F.array_position(F.array(*[F.lit(c) for c in CLASSES]), F.col(LABEL)) - 1
    df = df.withColumn("label", code.cast("double"))
    df = encode.assemble(df, prep.feature_names)
    df = split.balanced_weights(df, LABEL)
    if with_folds:
        tr = split.stratified_kfold(df.where(F.col("is_train") == 1).select(ID, LABEL), LABEL, ID, 5, 42)
        df = df.join(tr.select(ID, "fold"), ID, "left")
    else:
        df = df.withColumn("fold", F.lit(None).cast("int"))
    # AQE may coalesce a small shuffle into one partition; MLlib parallelises over the
    # input partitions, so spread the persisted training table over all executor cores.
    n = spark.sparkContext.defaultParallelism
    df = df.select(ID, "label", "weight", "fold", "is_train", "features").repartition(n, ID).persist()
    return df, prep.feature_names


def _train_valid(spark, sf_dir, with_folds: bool = False):
    df, names = model_table(spark, sf_dir, with_folds)
    return df.where(F.col("is_train") == 1), df.where(F.col("is_train") == 0), names


def _proba_out(model, valid: DataFrame) -> DataFrame:
    pf = models.proba_frame(model, valid, [ID, "label"])
    return pf.select(ID, F.col("label").cast("int").alias("label"), F.col("pred").cast("int").alias("pred"),
                     *[F.col("proba")[c].alias(f"p{c}") for c in range(K)])


@register("train_logreg")
def q_train_logreg(spark, sf_dir):
    train, valid, _ = _train_valid(spark, sf_dir)
    return _proba_out(models.logistic_regression(max_iter=1000).fit(train), valid)


@register("train_tree")
def q_train_tree(spark, sf_dir):
    train, valid, _ = _train_valid(spark, sf_dir)
    return _proba_out(models.decision_tree(max_depth=10, min_instances=10).fit(train), valid)


@register("train_forest")
def q_train_forest(spark, sf_dir):
    train, valid, _ = _train_valid(spark, sf_dir)
    return _proba_out(models.random_forest(num_trees=200, max_depth=15, min_instances=5).fit(train), valid)


@register("train_forest_nobootstrap")
def q_train_forest_nobootstrap(spark, sf_dir):
    train, valid, _ = _train_valid(spark, sf_dir)
    rf = models.random_forest(num_trees=150, max_depth=16, min_instances=5, bootstrap=False)
    return _proba_out(rf.fit(train), valid)


def hist_rows(spark, sf_dir) -> tuple[DataFrame, np.ndarray, tuple]:
    """The model table binned for histogram trees, its cut points (from the train rows) and the feature names."""
    df, names = model_table(spark, sf_dir, with_folds=True)
    edges = tree_models.cut_points(df.where(F.col("is_train") == 1).select(vector_to_array("features").alias("x")))
    return tree_models.binned(df, ID, edges), edges, names


def _hist_out(got: DataFrame) -> DataFrame:
    out = got.where("part = 'new'").select(F.col("id").alias(ID), F.col("y").alias("label"), argmax_first("proba").cast("int").alias("pred"),
                                           *[F.col("proba")[c].alias(f"p{c}") for c in range(K)])
    return out.withColumn("p_sum", F.col("p0") + F.col("p1") + F.col("p2"))


def _trained(spark, sf_dir, setting) -> DataFrame:
    """Predictions of the validation rows by one model fitted on all train rows."""
    rows, edges, _ = hist_rows(spark, sf_dir)
    return _hist_out(tree_models.fit_predict(rows, [Fit("model", setting)], K, edges))


@register("train_gbt")
def q_train_gbt(spark, sf_dir):
    """Leaf-wise boosting (M6, M8)."""
    return _trained(spark, sf_dir, LGBM)


@register("train_histgb")
def q_train_histgb(spark, sf_dir):
    """Leaf-wise boosting without a limit of depth (M7)."""
    return _trained(spark, sf_dir, HIST)


@register("ovr_probabilities")
def q_ovr_probabilities(spark, sf_dir):
    """Depth-wise boosting with row and column shares and explicit weights."""
    return _trained(spark, sf_dir, XGB)


@register("train_symmetric_boosting")
def q_train_symmetric_boosting(spark, sf_dir):
    """Boosting with symmetric trees."""
    return _trained(spark, sf_dir, CATBOOST)


@register("train_extra_trees")
def q_train_extra_trees(spark, sf_dir):
    """Extremely randomised trees (M5)."""
    return _trained(spark, sf_dir, EXTRA)


@register("top_features")
def q_top_features(spark, sf_dir):
    rows, edges, names = hist_rows(spark, sf_dir)
    share = tree_models.mean_importances(rows, Fit("forest", FOREST), K, edges)
    df = spark.createDataFrame([(n, float(v)) for n, v in zip(names, share)], "feature string, importance double")
    return df.orderBy(F.desc("importance"), "feature").limit(5)


def _fold_f1(oof: DataFrame, by: list[str]) -> DataFrame:
    """Weighted F1 per group of ``by``, from one table of confusion counts."""
    pred = oof.withColumn("pred", argmax_first("proba").cast("int"))
    return metrics.summary(metrics.confusion(pred, "y", "pred", by=by), by=by).select(*by, "f1_w")


@register("cross_validate")
def q_cross_validate(spark, sf_dir):
    """Five-fold weighted F1 of the six models of the comparison; fold -1 is their mean and standard deviation."""
    rows, edges, _ = hist_rows(spark, sf_dir)
    tree_fits = {n: s for n, s in COMPARED.items() if not isinstance(s, dict)} | {"tuned": tuned_setting(rows, edges)}
    fits = [Fit(n, s, f) for n, s in tree_fits.items() for f in range(FOLDS)]
    oof = cube.resumable(rows, fits, K, edges, only_held=True).withColumn("model", F.col("name"))
    per_fold = [_fold_f1(oof, ["model", "fold"])]
    train, _, _ = _train_valid(spark, sf_dir, with_folds=True)
    for name, settings in COMPARED.items():
        if isinstance(settings, dict):
            est = (models.decision_tree if "max_depth" in settings else models.logistic_regression)(**settings)
            _, got = models.cross_validate(train, est.fit, FOLDS, [ID, "label"], name=name)
            per_fold.append(got.select(F.lit(name).alias("model"), "fold", "f1_w"))
    per_fold.append(knn_folds(train).select(F.lit("knn").alias("model"), "fold", "f1_w"))
    each = reduce(DataFrame.unionByName, per_fold)
    mean = each.groupBy("model").agg(F.lit(-1).alias("fold"), F.avg("f1_w").alias("f1_w"), F.stddev_pop("f1_w").alias("f1_std"))
    return each.withColumn("f1_std", F.lit(None).cast("double")).unionByName(mean)


def knn_folds(train: DataFrame, k: int = 7) -> DataFrame:
    """Weighted F1 of the k-NN vote per fold: rows of a fold ask all rows of the other folds."""
    x = train.select(F.col(ID).alias("id"), vector_to_array("features").alias("x"), F.col("label").cast("int").alias("y"), "fold")
    got = metric_knn.classify(x, x, k, n_classes=K, skip="fold").join(x.select("id", "y", "fold"), "id")
    return metrics.summary(metrics.confusion(got, "y", "pred", by=["fold"]), by=["fold"]).select("fold", "f1_w")


_TUNED = "model string, n_trees int, max_depth int, min_split int, min_leaf int, step double, mean_f1 double, is_best int, best_valid_f1 double"


def _forest_points(grid: dict) -> list[tuple[int, int, int, int]]:
    return list(product(*(grid[n] for n in ("trees", "depth", "split", "least"))))


def search_forest(rows: DataFrame, edges: np.ndarray, points: list[tuple[int, int, int, int]]) -> dict[tuple[int, int, int, int], float]:
    """Mean F1 over the folds of every (trees, depth, split, least).

    One fit per (split, least) and fold serves all numbers of trees and all depths: fewer trees are its first ones,
    a smaller depth is the same trees cut off."""
    most, deepest = max(p[0] for p in points), 0 if any(p[1] == 0 for p in points) else max(p[1] for p in points)
    stops, depths = sorted({p[0] for p in points}), sorted({p[1] for p in points} - {0}) + ([0] if deepest == 0 else [])
    fits = [Fit(f"{split}-{least}", Forest(most, Growth(depth=deepest, split=split, least=least)), f) for split, least in sorted({p[2:] for p in points}) for f in range(FOLDS)]
    oof = cube.resumable(rows, fits, K, edges, stops, depths, only_held=True)
    mean = _fold_f1(oof, ["name", "stop", "depth", "fold"]).groupBy("name", "stop", "depth").agg(F.avg("f1_w").alias("f1")).collect()  # a row per point
    got = {(r["stop"], r["depth"], r["name"]): r["f1"] for r in mean}
    return {p: got[p[0], p[1], f"{p[2]}-{p[3]}"] for p in points}


def search_boosting(rows: DataFrame, edges: np.ndarray) -> dict[tuple[int, float, int], float]:
    """Mean F1 over the folds of every (rounds, step, depth); one fit serves all numbers of rounds."""
    most, pairs = max(BOOSTED_GRID["rounds"]), list(product(BOOSTED_GRID["step"], BOOSTED_GRID["depth"]))
    fits = [Fit(f"{step}-{depth}", _boosted_point(most, step, depth), f) for step, depth in pairs for f in range(FOLDS)]
    oof = cube.resumable(rows, fits, K, edges, BOOSTED_GRID["rounds"], only_held=True)
    mean = _fold_f1(oof, ["name", "stop", "fold"]).groupBy("name", "stop").agg(F.avg("f1_w").alias("f1")).collect()  # a row per point
    got = {(r["stop"], r["name"]): r["f1"] for r in mean}
    return {(n, step, depth): got[n, f"{step}-{depth}"] for n in BOOSTED_GRID["rounds"] for step, depth in pairs}


def _boosted_point(rounds: int, step: float, depth: int) -> Boosting:
    return Boosting(rounds, step, Growth(depth=depth, leaves=31, least=20), balanced=False)


def _forest_point(trees: int, depth: int, split: int, least: int) -> Forest:
    return Forest(trees, Growth(depth=depth, split=split, least=least))


def tuned_setting(rows: DataFrame, edges: np.ndarray) -> Boosting | Forest:
    """The best point of both grids."""
    forest, boosted = search_forest(rows, edges, _forest_points(FOREST_GRID)), search_boosting(rows, edges)
    f, b = max(forest, key=forest.get), max(boosted, key=boosted.get)
    return _forest_point(*f) if forest[f] >= boosted[b] else _boosted_point(*b)


def _held_f1(rows: DataFrame, edges: np.ndarray, settings: dict[str, Boosting | Forest]) -> dict[str, float]:
    """Validation F1 of the best points, refitted on all train rows."""
    got = tree_models.fit_predict(rows, [Fit(n, s) for n, s in settings.items()], K, edges).where("part = 'new'")
    return {r["name"]: r["f1_w"] for r in _fold_f1(got, ["name"]).collect()}


@register("grid_search")
def q_grid_search(spark, sf_dir):
    """All points of the forest grid (24) and the boosting grid (8), the best of each refitted and scored on the validation rows."""
    rows, edges, _ = hist_rows(spark, sf_dir)
    forest, boosted = search_forest(rows, edges, _forest_points(FOREST_GRID)), search_boosting(rows, edges)
    f, b = max(forest, key=forest.get), max(boosted, key=boosted.get)
    held = _held_f1(rows, edges, {"forest": _forest_point(*f), "boosting": _boosted_point(*b)})
    out = [("forest", *p, None, float(v), int(p == f), float(held["forest"])) for p, v in forest.items()]
    out += [("boosting", n, d, None, None, s, float(v), int((n, s, d) == b), float(held["boosting"])) for (n, s, d), v in boosted.items()]
    return spark.createDataFrame(out, _TUNED)


@register("random_search")
def q_random_search(spark, sf_dir):
    """Fifteen points drawn from the larger forest grid, the best refitted and scored on the validation rows."""
    rows, edges, _ = hist_rows(spark, sf_dir)
    points = random.Random(42).sample(_forest_points(DRAWN_GRID), DRAWS)
    forest = search_forest(rows, edges, points)
    f = max(forest, key=forest.get)
    held = _held_f1(rows, edges, {"forest": _forest_point(*f)})["forest"]
    return spark.createDataFrame([("forest", *p, None, float(v), int(p == f), float(held)) for p, v in forest.items()], _TUNED)


def stack_cube(spark, sf_dir) -> DataFrame:
    """Predictions of every member and fold: part "oof" for the fold left out, "new" for the validation rows. Resumed where a run stopped."""
    rows, edges, _ = hist_rows(spark, sf_dir)
    return cube.resumable(rows, [Fit(n, s, f, 42 + f) for n, s in STACK.items() for f in range(FOLDS)], K, edges)


def _long(got: DataFrame, *keep: str) -> DataFrame:
    return got.select(F.col("id").alias(ID), *keep, F.col("name").alias("model"), F.posexplode("proba").alias("class", "prob"))


@register("oof_stack")
def q_oof_stack(spark, sf_dir):
    return _long(stack_cube(spark, sf_dir).where("part = 'oof'"), F.col("y").alias("label"), "fold")


def stack_wide(got: DataFrame, part: str) -> DataFrame:
    """(o_orderkey, label, fold, one column per member and class); rows outside training have the mean over the folds' models."""
    from tabrisk.operators.ensemble import fold_average, long_to_wide
    mine = got.where(F.col("part") == part)
    long = _long(mine)
    wide = long_to_wide(long if part == "oof" else fold_average(long, ID, FOLDS), ID, list(STACK), K)
    return wide.join(mine.select(F.col("id").alias(ID), F.col("y").alias("label"), "fold").distinct(), ID)


@register("meta_learner")
def q_meta_learner(spark, sf_dir):
    """Logistic regression over the stacked probabilities, cross-fitted: the model that scores a fold never saw it."""
    wide = stack_wide(stack_cube(spark, sf_dir), "oof")
    stack_cols = [c for c in wide.columns if c not in (ID, "label", "fold")]
    meta = encode.assemble(split.balanced_weights(wide.withColumn("label", F.col("label").cast("double")), "label"), stack_cols)
    oof = models.oof_predictions(meta, models.logistic_regression(max_iter=META_ITER).fit, FOLDS, [ID, "label"], name="meta")
    return oof.select(ID, F.col("label").cast("int"), "fold", F.col("pred").cast("int"),
                      *[F.col("proba")[c].alias(f"p{c}") for c in range(K)])


SUBSET = list(STACK)[:4]
_STRATEGY = "strategy string, score double, chosen int"


def _meta(oof: DataFrame, new: DataFrame, cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """(id, label, pred) out of fold, and (id, pred) of the new rows, by logistic regression over ``cols``."""
    est = models.logistic_regression(max_iter=META_ITER)
    train = encode.assemble(split.balanced_weights(oof.withColumn("label", F.col("label").cast("double")), "label"), cols).select(ID, "label", "fold", "weight", "features")
    crossed = models.oof_predictions(train, est.fit, FOLDS, [ID, "label"], name="meta")
    return crossed, models.proba_frame(est.fit(train), encode.assemble(new, cols), [ID])


def _members(wide: DataFrame, names: list[str]) -> DataFrame:
    """One array of class probabilities per member."""
    return wide.select(ID, "label", *[F.array(*[F.col(f"c{c}_{n}") for c in range(K)]).alias(n) for n in names])


def stack_strategies(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(strategy, score, chosen) by out-of-fold balanced accuracy, and (id, pred) of the rows outside training by the chosen one.

    Strategies: mean, cross-fitted logistic regression and optimised weights, each over all members and over the first four."""
    from tabrisk.operators import ensemble, weights
    got = stack_cube(spark, sf_dir)
    oof, new = stack_wide(got, "oof"), stack_wide(got, "new").drop("label", "fold")
    new = new.withColumn("label", F.lit(None).cast("int"))
    scored = []
    for tag, names in (("all", list(STACK)), ("subset", SUBSET)):
        blend, blend_new = _members(oof, names).persist(), _members(new, names)
        w, best, equal = weights.optimise(blend, "label", names, K)
        blend.unpersist()
        scored.append((f"mean_{tag}", equal, ensemble.soft_vote(blend_new, {n: 1.0 / len(names) for n in names}, K).select(ID, F.col("blend_pred").alias("pred"))))
        scored.append((f"weights_{tag}", best, ensemble.soft_vote(blend_new, dict(zip(names, w)), K).select(ID, F.col("blend_pred").alias("pred"))))
        crossed, meta_new = _meta(oof, new, [f"c{c}_{n}" for c in range(K) for n in names])
        score = metrics.summary(metrics.confusion(crossed, "label", "pred")).first()["balanced_accuracy"]
        scored.append((f"meta_{tag}", float(score), meta_new.select(ID, "pred")))
    top = max(range(len(scored)), key=lambda i: (scored[i][1], -i))
    table = spark.createDataFrame([(n, float(s), int(i == top)) for i, (n, s, _) in enumerate(scored)], _STRATEGY)
    return table, scored[top][2]


@register("stack_strategies")
def q_stack_strategies(spark, sf_dir):
    """Scores of the six strategies over the stack."""
    return stack_strategies(spark, sf_dir)[0]


@register("stack_submission")
def q_stack_submission(spark, sf_dir):
    """Labels of the rows outside training by the best strategy."""
    table, pred = stack_strategies(spark, sf_dir)
    names = F.array(*[F.lit(c) for c in CLASSES])
    return pred.select(ID, F.element_at(names, F.col("pred").cast("int") + 1).alias("label"), F.lit(table.where("chosen = 1").first()["strategy"]).alias("strategy"))


@register("stack_fold_scores")
def q_stack_fold_scores(spark, sf_dir):
    """Balanced accuracy of the averaged blend per fold; fold -1: mean and standard deviation."""
    from tabrisk.operators.ensemble import mean_blend
    wide = stack_wide(stack_cube(spark, sf_dir), "oof")
    blend = _members(wide, list(STACK)).withColumn("pred", argmax_first(mean_blend(list(STACK), K))).join(wide.select(ID, "fold"), ID)
    each = metrics.summary(metrics.confusion(blend, "label", "pred", by=["fold"]), by=["fold"]).select("fold", "balanced_accuracy")
    mean = each.agg(F.lit(-1).alias("fold"), F.avg("balanced_accuracy").alias("balanced_accuracy"), F.stddev_pop("balanced_accuracy").alias("std"))
    return each.withColumn("std", F.lit(None).cast("double")).unionByName(mean)


@register("model_save_load")
def q_model_save_load(spark, sf_dir):
    from tabrisk.session import scratch_path
    df, names = model_table(spark, sf_dir)
    pipe = models.build_pipeline([models.logistic_regression(max_iter=50)])
    fitted = pipe.fit(df.where(F.col("is_train") == 1))
    path = scratch_path(spark, "pipeline_model")
    models.save_pipeline(fitted, path)
    loaded = models.load_pipeline(path)
    out = loaded.transform(df.where(F.col("is_train") == 0))
    return out.select(ID, F.col("prediction").cast("int").alias("pred"))


@register("bundle_metadata")
def q_bundle_metadata(spark, sf_dir):
    import pyspark
    train, valid, names = _train_valid(spark, sf_dir)
    model = models.decision_tree(max_depth=6).fit(train)
    f1 = models.weighted_f1(models.proba_frame(model, valid, ["label"]))
    row = [(
        {c: i for i, c in enumerate(CLASSES)}, list(names), {"valid_f1_weighted": float(f1)},
        {"spark": pyspark.__version__}, "DecisionTreeClassifier",
    )]
    meta = spark.createDataFrame(row, "class_map map<string,int>, feature_names array<string>, "
                                      "metrics map<string,double>, versions map<string,string>, model_type string")
    return meta.withColumn("created_at", F.current_timestamp())
