"""Fits in the JVM against the plain version in numpy."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabrisk.operators import jvm_trees, tree_models, trees
from tabrisk.operators.trees import Boosting, Forest, Growth

FEATURES, N = 10, 5000
EDGES = np.tile(np.arange(1, 256) / 256, (FEATURES, 1))
SETTINGS = [
    Boosting(6, 0.2, Growth(depth=7, leaves=20, least=10, columns=0.85)), Boosting(6, 0.2, Growth(depth=5, l2=1.0, hessian=1.0, columns=0.85), rows=0.8),
    Boosting(6, 0.2, Growth(leaves=25, least=5), balanced=False), Boosting(6, 0.2, Growth(depth=5, l2=3.0, symmetric=True)),
    Forest(3, Growth(depth=8, split=10, random_cuts=True), bootstrap=False), Forest(3, Growth(split=5, least=2)), Forest(3, Growth(depth=6), balanced=False)]


def _columns(seed=8):
    rng = np.random.default_rng(seed)
    x = rng.random((N, FEATURES))
    x[:, 7:] = np.floor(x[:, 7:] * 4) / 4
    y = np.clip(((x[:, 0] + x[:, 1] * x[:, 2] + 0.3 * rng.standard_normal(N)) * 2.2).astype(int), 0, 2)
    bins = np.stack([np.searchsorted(EDGES[f], x[:, f]) for f in range(FEATURES)], axis=1).astype(np.uint8)
    bins[:40, 3] = 255
    return bins, y, rng.uniform(0.5, 2, N).round(3), np.arange(N) * 7 + 5, np.arange(N) % 5, np.arange(N) % 10 < 8


@pytest.fixture(scope="module")
def table(spark):
    bins, y, w, ids, fold, learn = _columns()
    rows = pd.DataFrame({"id": ids, "bins": [r.tobytes() for r in bins], "y": y.astype("int32"), "w": w, "fold": fold.astype("int32"), "learn": learn})
    return spark.createDataFrame(rows, "id bigint, bins binary, y int, w double, fold int, learn boolean").repartition(3)


def _answers(df, k=3):
    got = [jvm_trees.read_answer(r["answer"], k) for r in df.collect()]
    got = [g for g in got if len(g[0])]
    ids, numbers = np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got], axis=1)
    return ids[np.argsort(ids)], numbers[:, np.argsort(ids)]


@pytest.mark.parametrize("setting", SETTINGS)
def test_trees_of_the_jvm_are_those_of_numpy(spark, table, setting):
    bins, y, w, ids, fold, learn = _columns()
    learnt = learn & (fold != 2)
    if isinstance(setting, Forest):
        weight, votes = w if setting.balanced else np.ones(N), [0, 0]
        for number in range(setting.trees):
            tree = trees.forest_tree(bins[learnt], y[learnt], weight[learnt], ids[learnt], 3, setting, 42, number, EDGES)
            votes = [a + b for a, b in zip(votes, trees.forest_votes(tree, bins[~learnt], (4, 0)))]
        want, stops, depths, last = np.stack(votes), (setting.trees,), (4, 0), setting.trees
    else:
        scores, _, _ = trees.boost(bins, y, w if setting.balanced else np.ones(N), ids, learnt, 3, setting, 42, EDGES, (4,))
        want, stops, depths, last = np.stack([scores[4][~learnt], scores[6][~learnt]]), (4, 6), (0,), 6
    files = jvm_trees.pack(table, FEATURES)
    job = jvm_trees.spec(setting, 2, 42, 3, EDGES, 0, last, stops, depths)
    ways = [jvm_trees.fitted(spark, files, [job])]
    if isinstance(setting, Boosting):
        ways += [jvm_trees.fitted_together(spark, files, job, n) for n in (1, 4)]
    for got in ways:
        asked, numbers = _answers(got)
        assert np.array_equal(asked, ids[~learnt])
        assert np.allclose(numbers, want, atol=1e-9)


def test_large_boosting_tables_are_fitted_by_many_tasks(spark, table, monkeypatch):
    fits = [tree_models.Fit("a", SETTINGS[0], 1), tree_models.Fit("s", SETTINGS[3])]

    def fitted():
        got = tree_models.fit_predict(table, fits, 3, EDGES, stops=(3,)).toPandas()
        return got.sort_values(["fit", "stop", "id"]).reset_index(drop=True)

    alone, asked = fitted(), []
    together = jvm_trees.fitted_together
    monkeypatch.setattr(tree_models, "ALONE_BYTES", 0)
    monkeypatch.setattr(jvm_trees, "fitted_together", lambda *a: asked.append(a[-1]) or together(*a))
    by_many = fitted()
    assert len(asked) == 2
    assert alone.drop(columns="proba").equals(by_many.drop(columns="proba"))
    assert np.allclose(np.stack(alone.proba.to_list()), np.stack(by_many.proba.to_list()), atol=1e-9)


def test_only_the_fold_left_out_is_predicted_if_asked(spark, table):
    got = tree_models.fit_predict(table, [tree_models.Fit("f", SETTINGS[5], 1)], 3, EDGES, only_held=True)
    assert {r["part"] for r in got.select("part").distinct().collect()} == {"oof"}
    assert got.count() == table.where("learn and fold = 1").count()


def test_rows_without_an_id_are_learnt_but_not_predicted(spark, table):
    rows = table.withColumn("id", F.when(F.col("id") % 3 > 0, F.col("id")))
    got = tree_models.fit_predict(rows, [tree_models.Fit("f", SETTINGS[6], 1)], 3, EDGES)
    assert got.count() == rows.where("id is not null and (not learn or fold = 1)").count()
