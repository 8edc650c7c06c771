"""Rows-only tier: schema, counts, probability sums and a metric floor on a separable table."""

import math

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tabrisk.operators import metrics, models, split
from tabrisk.sources.tables import table


def _embeddings(spark):
    e = table(spark, SF_SMALL, "embeddings")
    e = e.select("vec_id", F.col("label").cast("double").alias("label"),
                 array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    e = split.balanced_weights(e, "label")
    return split.stratified_kfold(e, "label", "vec_id", k=5)


def _separable(spark):
    """Three well separated clusters (a unit-test fixture; the driver embeddings carry
    labels unrelated to the vectors, so they cannot hold a metric floor)."""
    import random
    rnd = random.Random(7)
    rows = [(i, float(c), [c * 5.0 + rnd.gauss(0, 1), -c * 3.0 + rnd.gauss(0, 1)])
            for i, c in enumerate([j % 3 for j in range(300)])]
    df = spark.createDataFrame(rows, "vec_id long, label double, x array<double>")
    df = df.select("vec_id", "label", array_to_vector("x").alias("features"))
    df = split.balanced_weights(df, "label")
    return split.stratified_kfold(df, "label", "vec_id", k=5)


def test_models_metric_floor_on_separable_fixture(spark):
    e = _separable(spark)
    train, valid = e.where("fold != 0"), e.where("fold = 0")
    for est in (models.random_forest(num_trees=20, max_depth=5), models.logistic_regression(max_iter=50),
                models.decision_tree(max_depth=5)):
        pf = models.proba_frame(est.fit(train), valid, ["vec_id", "label"])
        acc = metrics.summary(metrics.confusion(pf, "label", "pred")).first()["accuracy"]
        assert acc > 0.9


def test_ovr_members_probabilities_sum_to_one(spark):
    e = _embeddings(spark).where("label < 3")
    bundle = models.fit_boosted_members(e, 3, max_iter=5, max_depth=3)
    pf = models.proba_frame(bundle, e, ["vec_id"])
    sums = [sum(r["proba"]) for r in pf.collect()]
    assert all(math.isclose(s, 1.0, rel_tol=1e-9) for s in sums)


def test_oof_predicts_every_row_once(spark):
    e = _embeddings(spark)
    oof = models.oof_predictions(e, models.logistic_regression(max_iter=20).fit, 5, ["vec_id", "label"])
    assert oof.count() == e.count()
    assert oof.select("vec_id").distinct().count() == e.count()


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    out = entry(spark)
    rows = out.collect()
    assert len(rows) == 3
    assert math.isclose(sum(r["pct"] for r in rows), 100.0, abs_tol=0.02)


def test_model_queries_have_the_reference_settings():
    from tabrisk.plans import models_plans as p
    from tabrisk.plans import scoring
    assert {n: (getattr(m, "rounds", None), getattr(m, "trees", None), m.growth.depth, m.growth.leaves) for n, m in p.STACK.items()} == {
        "lightgbm": (450, None, 7, 63), "xgboost": (400, None, 6, 0), "histgb": (350, None, 0, 63), "extratrees": (None, 150, 16, 0), "catboost": (300, None, 7, 0)}
    assert set(p.COMPARED) == {"logreg", "tree", "forest", "boosting"}  # and k-NN and the tuned model
    assert len(p._forest_points(p.FOREST_GRID)) == 24 and math.prod(map(len, p.BOOSTED_GRID.values())) == 8 and p.DRAWS == 15
    assert (p.FOREST.trees, p.FOREST.growth.depth) == (200, 15) == (scoring.SCORER["num_trees"], scoring.SCORER["max_depth"])


def _small_settings(monkeypatch):
    from tabrisk.operators.trees import Boosting, Forest, Growth
    from tabrisk.plans import models_plans as p
    monkeypatch.setattr(p, "COMPARED", {"logreg": dict(max_iter=2), "tree": dict(max_depth=2, min_instances=1), "forest": Forest(2, Growth(depth=3))})
    monkeypatch.setattr(p, "STACK", {"a": Boosting(3, 0.3, Growth(depth=2)), "b": Forest(2, Growth(depth=3, random_cuts=True), bootstrap=False)})
    monkeypatch.setattr(p, "FOREST_GRID", dict(trees=[1, 2], depth=[2, 0], split=[5], least=[1]))
    monkeypatch.setattr(p, "BOOSTED_GRID", dict(rounds=[1, 2], step=[0.3], depth=[2]))
    monkeypatch.setattr(p, "DRAWN_GRID", dict(trees=[1, 2], depth=[2], split=[5], least=[1]))
    monkeypatch.setattr(p, "DRAWS", 2)
    return p


def test_searches_and_comparison_run_every_member(spark, monkeypatch):
    p = _small_settings(monkeypatch)
    rows = p.q_random_search(spark, SF_SMALL).collect()
    assert len(rows) == 2 and sum(r["is_best"] for r in rows) == 1 and all(0 < r["best_valid_f1"] <= 1 for r in rows)
    rows = p.q_grid_search(spark, SF_SMALL).collect()
    assert len(rows) == 6 and sum(r["is_best"] for r in rows) == 2
    assert {(r["model"], r["fold"]) for r in p.q_cross_validate(spark, SF_SMALL).collect()} == {(m, f) for m in [*p.COMPARED, "tuned", "knn"] for f in range(-1, 5)}


def test_searched_points_equal_separate_fits(spark, monkeypatch):
    from tabrisk.operators import cube, tree_models
    p = _small_settings(monkeypatch)
    rows, edges, _ = p.hist_rows(spark, SF_SMALL)
    forest, boosted = p.search_forest(rows, edges, p._forest_points(p.FOREST_GRID)), p.search_boosting(rows, edges)
    alone = {"f": p._forest_point(1, 2, 5, 1), "b": p._boosted_point(1, 0.3, 2)}
    oof = tree_models.fit_predict(rows, [tree_models.Fit(n, s, f) for n, s in alone.items() for f in range(p.FOLDS)], p.K, edges).where("part = 'oof'")
    mean = {r["name"]: r["f1"] for r in p._fold_f1(oof, ["name", "fold"]).groupBy("name").agg(F.avg("f1_w").alias("f1")).collect()}
    assert math.isclose(mean["f"], forest[1, 2, 5, 1]) and math.isclose(mean["b"], boosted[1, 0.3, 2])
    assert cube.published(spark, cube.cube_root(spark))


def test_stack_reaches_the_unlabelled_rows(spark, monkeypatch):
    p = _small_settings(monkeypatch)
    got = p.stack_cube(spark, SF_SMALL)
    oof, new = p.stack_wide(got, "oof"), p.stack_wide(got, "new")
    assert len(oof.columns) == 3 + len(p.STACK) * p.K == len(new.columns)
    assert oof.count() + new.count() == table(spark, SF_SMALL, "orders").count()
    assert new.where("abs(c0_a + c1_a + c2_a - 1) > 1e-9").count() == 0
    rows = p.q_meta_learner(spark, SF_SMALL).collect()
    assert len(rows) == oof.count() and all(math.isclose(r["p0"] + r["p1"] + r["p2"], 1, rel_tol=1e-9) for r in rows)


def test_cube_resumes_after_a_stop(spark, monkeypatch, tmp_path):
    from tabrisk.operators import cube, tree_models
    from tabrisk.operators.trees import Boosting, Growth
    p = _small_settings(monkeypatch)
    monkeypatch.setattr(cube, "cube_root", lambda spark: f"{tmp_path}/cubes")
    monkeypatch.setattr(cube, "PARALLEL", 1)
    rows, edges, _ = p.hist_rows(spark, SF_SMALL)
    fits = [tree_models.Fit("m", Boosting(2, 0.3, Growth(depth=2)), f) for f in range(5)]
    done = []

    def fit(rows, some, *a):
        if len(done) == 2:
            raise RuntimeError("stopped")
        done.append(some[0].held)
        return tree_models.fit_predict(rows, some, *a)

    monkeypatch.setattr(cube, "fit_predict", fit)
    try:
        cube.resumable(rows, fits, p.K, edges)
        raise AssertionError
    except RuntimeError:
        assert done == [0, 1]
    again = []
    monkeypatch.setattr(cube, "fit_predict", lambda rows, some, *a: (again.append(some[0].held), tree_models.fit_predict(rows, some, *a))[1])
    got = cube.resumable(rows, fits, p.K, edges)
    assert again == [2, 3, 4] and got.where("part = 'oof'").count() == rows.where("learn").count()
    cube.resumable(rows, fits, p.K, edges)
    assert again == [2, 3, 4]


def test_stack_submission_uses_the_best_strategy(spark, monkeypatch):
    p = _small_settings(monkeypatch)
    monkeypatch.setattr(p, "META_ITER", 5)
    monkeypatch.setattr(p, "SUBSET", ["a", "b"])
    table_, pred = p.stack_strategies(spark, SF_SMALL)
    rows = table_.collect()
    assert len(rows) == 6 and sum(r["chosen"] for r in rows) == 1
    assert max(r["score"] for r in rows) == next(r["score"] for r in rows if r["chosen"])
    score = {r["strategy"]: r["score"] for r in rows}
    assert score["weights_all"] >= score["mean_all"]
    out = p.q_stack_submission(spark, SF_SMALL).collect()
    assert len(out) == len({r["o_orderkey"] for r in out}) == pred.count() and {r["label"] for r in out} <= {"F", "O", "P"}
    folds = p.q_stack_fold_scores(spark, SF_SMALL).collect()
    assert {r["fold"] for r in folds} == {-1, 0, 1, 2, 3, 4}


def test_weight_search(spark):
    from tabrisk.operators import weights
    rows = [(i % 3, [float(c == i % 3) for c in range(3)] if i % 5 else [0.4, 0.35, 0.25], [0.2, 0.2, 0.6] if i % 2 else [0.5, 0.3, 0.2]) for i in range(60)]
    df = spark.createDataFrame(rows + [(None, [1.0, 0.0, 0.0], [1.0, 0.0, 0.0]), (1, None, [1.0, 0.0, 0.0])], "y int, a array<double>, b array<double>")
    w, score, equal = weights.optimise(df, "y", ["a", "b"], 3)
    assert score >= equal and math.isclose(sum(w), 1)
    best = 0.0
    for i in range(101):
        hit = [[0, 0] for _ in range(3)]
        for y, a, b in rows:
            blend = [i / 100 * u + (1 - i / 100) * v for u, v in zip(a, b)]
            hit[y][0] += blend.index(max(blend)) == y
            hit[y][1] += 1
        best = max(best, sum(h / n for h, n in hit) / 3)
    assert score >= best - 1e-9


def test_forest_pass_holds_little_memory(spark):
    """Each of an executor's tasks holds the node sums of a pass, and copies of them are merged."""
    assert models.random_forest(num_trees=200, max_depth=15).getMaxMemoryInMB() <= 256
    assert models.random_forest(num_trees=150, max_depth=16, bootstrap=False).getMaxMemoryInMB() <= 256
