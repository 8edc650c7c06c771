"""Histogram trees against plain versions, and both ways of fitting against each other."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabrisk.operators import tree_models, trees
from tabrisk.operators.trees import Boosting, Forest, Growth

EDGES = np.tile(np.arange(1, 256) / 256, (4, 1))


def _data(n=900, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.random((n, 4))
    x[:, 3] = np.floor(x[:, 3] * 5) / 5
    y = np.clip(((x[:, 0] + x[:, 1] * x[:, 2] + 0.1 * rng.standard_normal(n)) * 2.2).astype(int), 0, 2)
    bins = np.stack([np.searchsorted(EDGES[f], x[:, f]) for f in range(4)], axis=1).astype(np.uint8)
    return x, bins, y, rng.uniform(0.5, 2, n).round(3), np.arange(n) * 7 + 5


def plain_tree(bins, g, h, depth, leaves, least, l2):
    """Best-first growth, one node at a time, every cut tried by hand."""
    value = lambda rows: g[rows].sum() ** 2 / (h[rows].sum() + l2) if len(rows) and h[rows].sum() + l2 else 0.0

    def best(rows):
        top = (0.0, None, None)
        if len(rows) >= 2 * least:
            for f in range(bins.shape[1]):
                for c in range(255):
                    a, b = rows[bins[rows, f] <= c], rows[bins[rows, f] > c]
                    if len(a) >= least and len(b) >= least and (gain := value(a) + value(b) - value(rows)) > top[0] * (1 + 1e-12):
                        top = (gain, f, c)
        return top

    nodes = [(np.arange(len(g)), 0, best(np.arange(len(g))))]
    while len(nodes) < leaves:
        at = max(range(len(nodes)), key=lambda i: (nodes[i][2][0], -i))
        rows, d, (gain, f, c) = nodes[at]
        if gain <= 1e-7 * trees.UNIT:
            break
        kids = [rows[bins[rows, f] <= c], rows[bins[rows, f] > c]]
        nodes[at:at + 1] = [(r, d + 1, best(r) if d + 1 < depth else (0.0, None, None)) for r in kids]
    out = np.zeros(len(g))
    for rows, _, _ in nodes:
        out[rows] = -g[rows].sum() / (h[rows].sum() + l2)
    return out


def test_boosting_equals_a_plain_version():
    _, bins, y, w, ids = _data(220)
    bins = bins // 16  # few bins keep the plain version short
    s = Boosting(6, 0.3, Growth(depth=4, leaves=7, least=5, l2=0.5))
    got, rounds, start = trees.boost(bins, y, w, ids, np.ones(len(y), bool), 3, s, 1, EDGES)
    raw = np.tile(np.round(np.log(np.bincount(y, weights=w) / w.sum()), 8), (len(y), 1))
    for _ in range(6):
        p = np.exp(raw) / np.exp(raw).sum(axis=1, keepdims=True)
        g, h = (np.rint(v * w[:, None] * trees.UNIT) for v in (p - np.eye(3)[y], p * (1 - p)))
        raw = raw + np.stack([0.3 * plain_tree(bins, g[:, c], h[:, c], 4, 7, 5, 0.5 * trees.UNIT) for c in range(3)], axis=1)
    assert np.allclose(got[6], raw, atol=1e-9)
    assert all(len(np.unique(t.descend(bins))) <= 7 for by_class in rounds for t in by_class)


def test_symmetric_trees_use_one_split_a_level():
    _, bins, y, w, ids = _data()
    _, rounds, _ = trees.boost(bins, y, w, ids, np.ones(len(y), bool), 3, Boosting(3, 0.1, Growth(depth=4, symmetric=True, l2=3)), 1, EDGES)
    for t in (t for by_class in rounds for t in by_class):
        for d in range(4):
            at = (t.depth == d) & (t.feature >= 0)
            assert at.sum() == 2 ** d and len({(f, c) for f, c in zip(t.feature[at], t.cut[at])}) == 1


def test_random_cuts_lie_in_node_ranges_and_differ_by_seed():
    _, bins, y, w, ids = _data()
    forest = Forest(1, Growth(depth=6, split=10, random_cuts=True), bootstrap=False)
    grown = [trees.forest_tree(bins, y, w, ids, 3, forest, seed, 0, EDGES) for seed in range(6)]
    cuts = set()
    for t in grown:
        at = np.zeros(len(bins), np.int64)
        for _ in range(6):
            for node in np.unique(at[t.feature[at] >= 0]):
                own = bins[at == node, t.feature[node]]
                assert own.min() <= t.cut[node] < own.max()
                cuts.add((int(t.feature[node]), int(t.cut[node])))
            inner = t.feature[at] >= 0
            at[inner] = t.left[at[inner]] + (bins[inner, t.feature[at[inner]]] > t.cut[at[inner]])
    assert len({(int(t.feature[0]), int(t.cut[0])) for t in grown}) > 3 and len(cuts) > 60
    best = trees.forest_tree(bins, y, w, ids, 3, Forest(1, Growth(depth=6), bootstrap=False), 0, 0, EDGES)
    assert (best.cut[0] != [t.cut[0] for t in grown if t.feature[0] == best.feature[0]]).any()


def test_fewer_trees_less_depth_and_fewer_rounds_come_from_one_fit():
    _, bins, y, w, ids = _data()
    deep = Forest(2, Growth(split=6))
    for number in range(2):
        whole = trees.forest_tree(bins, y, w, ids, 3, deep, 9, number, EDGES)
        for depth in (1, 3, 5):
            own = trees.forest_tree(bins, y, w, ids, 3, Forest(2, Growth(depth=depth, split=6)), 9, number, EDGES)
            assert np.allclose(trees.forest_votes(whole, bins, (depth, 0))[0], trees.class_shares(own)[own.descend(bins)])
    long, _, _ = trees.boost(bins, y, w, ids, ids % 3 > 0, 3, Boosting(8, 0.1, Growth(depth=3), rows=0.8), 2, EDGES, stops=(5,))
    short, _, _ = trees.boost(bins, y, w, ids, ids % 3 > 0, 3, Boosting(5, 0.1, Growth(depth=3), rows=0.8), 2, EDGES)
    assert np.array_equal(long[5], short[5])


def _frame(spark):
    x, _, y, w, ids = _data(600)
    rows = [(int(i), [float(v) for v in r], float(c) if i % 11 else None, float(q), int(i) % 3 if i % 4 else None, int(i % 4 > 0)) for i, r, c, q in zip(ids, x, y, w)]
    rows += [(100_001, [float("nan"), 0.5, None, 0.2], None, 1.0, None, 0), (100_002, [None] * 4, 1.0, 1.0, 1, 1)]
    return spark.createDataFrame(rows, "key bigint, features array<double>, label double, weight double, fold int, is_train int").repartition(5)


FITS = [tree_models.Fit("a", Boosting(4, 0.2, Growth(depth=4, leaves=9, least=5, columns=0.7), rows=0.8), 0),
        tree_models.Fit("s", Boosting(12, 0.2, Growth(depth=3, symmetric=True, l2=3), balanced=False), 1),
        tree_models.Fit("f", Forest(4, Growth(depth=5, split=4)), 2), tree_models.Fit("x", Forest(3, Growth(depth=4, random_cuts=True), bootstrap=False), -1)]


def test_fits_in_groups_equal_fits_by_level(spark, monkeypatch):
    df = _frame(spark)
    edges = tree_models.cut_points(df.where("is_train = 1").select(F.col("features").alias("x")))
    assert edges.shape == (4, 255) and np.isfinite(edges[3]).sum() == 4
    rows = tree_models.binned(df, "key", edges)
    assert rows.count() == df.count()

    def fitted():
        got = tree_models.fit_predict(rows, FITS, 3, edges, stops=(2,), depths=(2, 0)).toPandas()
        return got.sort_values(["fit", "stop", "depth", "id"]).reset_index(drop=True)

    groups = fitted()
    monkeypatch.setattr(tree_models, "GROUP_BYTES", 0)
    levels = fitted()
    same = ["fit", "name", "held", "part", "stop", "depth", "id"]
    assert groups[same].equals(levels[same])
    assert np.allclose(np.stack(groups.proba.to_list()), np.stack(levels.proba.to_list()), atol=1e-12)
    assert np.allclose(np.stack(groups.proba.to_list()).sum(axis=1), 1)
    assert set(groups.stop[groups.name == "a"]) == {2, 4} and set(groups.depth[groups.name == "f"]) == {0, 2}
    oof = groups[(groups.name == "a") & (groups.stop == 4) & (groups.part == "oof")]
    learnt = df.where("is_train = 1 and fold = 0").count()
    assert oof.id.is_unique and learnt <= len(oof) <= learnt + df.where("is_train = 1 and label is null").count()


def test_importances(spark, monkeypatch):
    df = _frame(spark)
    edges = tree_models.cut_points(df.select(F.col("features").alias("x")))
    rows = tree_models.binned(df, "key", edges)
    fit = tree_models.Fit("f", Forest(12, Growth(depth=4)))
    got = tree_models.mean_importances(rows, fit, 3, edges)
    assert sum(got) == pytest.approx(1) and got[0] == max(got) and got[3] == min(got)
    monkeypatch.setattr(tree_models, "GROUP_BYTES", 0)
    assert tree_models.mean_importances(rows, fit, 3, edges) == pytest.approx(got)


def test_boosting_walks_down_only_rows_it_has_not_placed(monkeypatch):
    """Growing a tree already places the rows that it uses; only other rows walk down from the root."""
    rng = np.random.default_rng(4)
    n = 400
    bins = rng.integers(0, 30, (n, 3)).astype(np.uint8)
    y, ids, learn = (bins[:, 0] > 9).astype(int) + (bins[:, 1] > 14), np.arange(n), np.arange(n) % 5 > 0
    edges = np.tile(np.arange(255.0), (3, 1))
    for setting in (trees.Boosting(6, 0.3, trees.Growth(leaves=5, least=3)), trees.Boosting(6, 0.3, trees.Growth(depth=3, symmetric=True)),
                    trees.Boosting(6, 0.3, trees.Growth(depth=4, columns=0.7), rows=0.8)):
        walked, descend = [], trees.Tree.descend
        with monkeypatch.context() as m:
            m.setattr(trees.Tree, "descend", lambda self, b, *rest: walked.append(len(b)) or descend(self, b, *rest))
            scores, rounds, start = trees.boost(bins, y, np.ones(n), ids, learn, 3, setting, 1, edges)
        unused = sum(int((trees.rows_of_round(ids[learn], setting, 1, r) == 0).sum()) for r in range(6))
        assert sum(walked) == 3 * (6 * int((~learn).sum()) + unused)
        raw = np.tile(start, (n, 1))
        for by_class in rounds:
            for c, t in enumerate(by_class):
                raw[:, c] += trees.leaf_scores(t, setting)[t.descend(bins)]
        assert (raw == scores[6]).all()


@pytest.mark.parametrize("forest", [
    Forest(1, Growth(split=5)), Forest(1, Growth(depth=7, split=10, least=3)), Forest(1, Growth(depth=9, split=10, random_cuts=True), bootstrap=False),
    Forest(1, Growth(leaves=20))])
def test_small_nodes_split_between_rows_as_by_histograms(monkeypatch, forest):
    _, bins, y, w, ids = _data()

    def grown(few, chunk):
        monkeypatch.setattr(trees, "FEW", few)
        monkeypatch.setattr(trees, "CHUNK", chunk)
        return [trees.forest_tree(bins, y, w, ids, 3, forest, 42, t, EDGES) for t in range(4)]

    some = grown(64, 100)
    for other in (grown(0, 1 << 16), grown(10_000, 1 << 16)):
        for a, b in zip(some, other):
            assert all((getattr(a, n) == getattr(b, n)).all() for n in ("feature", "cut", "left", "gain", "total"))


def test_nodes_of_few_rows_need_no_histograms(monkeypatch):
    _, bins, y, w, ids = _data()
    counted = []
    plain = trees.LocalRows.histograms
    monkeypatch.setattr(trees.LocalRows, "histograms", lambda self, slot, rows, cand: counted.append(len(cand)) or plain(self, slot, rows, cand))
    tree = trees.forest_tree(bins, y, w, ids, 3, Forest(1, Growth(split=5)), 42, 0, EDGES)
    assert sum(counted) * 10 < len(tree)


def test_a_large_forests_small_nodes_are_grown_in_one_task(spark, monkeypatch):
    df = _frame(spark)
    edges = tree_models.cut_points(df.where("is_train = 1").select(F.col("features").alias("x")))
    rows = tree_models.binned(df, "key", edges)
    fits = [tree_models.Fit("f", Forest(3, Growth(split=4)), 2), tree_models.Fit("x", Forest(3, Growth(depth=6, random_cuts=True), bootstrap=False), -1)]

    def fitted():
        got = tree_models.fit_predict(rows, fits, 3, edges, stops=(2,), depths=(2, 0)).toPandas()
        return got.sort_values(["fit", "stop", "depth", "id"]).reset_index(drop=True), tree_models.mean_importances(rows, tree_models.Fit("i", fits[0].setting), 3, edges)

    groups, shares = fitted()
    limit, asked, level = 150, [], tree_models._level
    monkeypatch.setattr(tree_models, "GROUP_BYTES", limit * 2 * (4 + tree_models.ROW_BYTES))
    monkeypatch.setattr(tree_models, "DEALT", 70)
    monkeypatch.setattr(tree_models, "_level", lambda rows, fits, work, *rest: asked.extend(w.tree.total[w.front, -1].min() for w in work) or level(rows, fits, work, *rest))
    mixed, mixed_shares = fitted()
    same = ["fit", "name", "held", "part", "stop", "depth", "id"]
    assert asked and min(asked) > limit
    assert groups[same].equals(mixed[same])
    assert np.allclose(np.stack(groups.proba.to_list()), np.stack(mixed.proba.to_list()), atol=1e-12)
    assert mixed_shares == pytest.approx(shares)


def test_bundled_histograms_equal_plain_ones(monkeypatch):
    rng = np.random.default_rng(5)
    n = 6000
    bins = np.stack([rng.integers(0, v, n) for v in (256, 200, 4, 3, 2, 256, 90, 80, 70, 60, 50, 40, 30)], axis=1).astype(np.uint8)
    bins[:50, 2] = 255  # missing values
    use = (rng.random(n) < 0.8).astype(float)
    channels = [np.rint(rng.standard_normal(n) * 2.0 ** 22) * use, np.rint(rng.random(n) * 2.0 ** 33) * use, use]
    edges = np.tile(np.arange(255.0), (13, 1))
    rows = np.flatnonzero(use)
    cand = np.broadcast_to(np.array([0, 2, 3, 5, 6, 9, 12]), (2, 7))
    slot = np.arange(len(rows)) % 2
    got, looked = {}, []
    bundled = trees.LocalRows._bundled
    monkeypatch.setattr(trees.LocalRows, "_bundled", lambda self, *a: looked.append(len(self.bundles[0])) or bundled(self, *a))
    for single in (True, False):
        got[single] = trees.LocalRows(bins, channels, trees.Growth(), False, edges, single=single).histograms(slot, rows, cand)
    assert looked and looked[0] < 13
    assert np.array_equal(got[True], got[False])


def test_rows_settle_where_they_descend_to():
    rng = np.random.default_rng(6)
    bins = rng.integers(0, 200, (4000, 3)).astype(np.uint8)
    y, w = (bins[:, 0] > 90).astype(int) + (bins[:, 1] > 60), np.ones(4000)
    edges = np.tile(np.arange(255.0), (3, 1))
    setting = trees.Boosting(1, 0.1, trees.Growth(depth=3))
    tree = trees.boost(bins, y, w, np.arange(4000), np.ones(4000, bool), 3, setting, 1, edges)[1][0][0]
    columns, want = [np.ascontiguousarray(c) for c in bins.T], tree.descend(bins)
    for rows in (np.arange(0, 4000, 2), np.arange(5), np.arange(0)):
        out = np.full(4000, -1, np.int32)
        tree.settle(columns, rows, out)
        assert np.array_equal(out[rows], want[rows]) and (np.delete(out, rows) == -1).all()
