"""The saved bundle: equal trees by both ways of fitting, exact reload, refusal of changed tables, batch equal to stream."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabrisk.operators import bundle as bundles
from tabrisk.operators import tree_models
from tabrisk.operators.tree_models import BoostedModel, Fit
from tabrisk.operators.trees import Boosting, Growth

SMALL = Boosting(5, 0.3, Growth(depth=3, leaves=6, least=3))
SCHEMA = "id long, a double, b double, seg string, label string"
CLASSES = ("x", "y", "z")


def _frame(spark, n=180):
    rows = [(i, None if i % 19 == 0 else float(i * 7 % 23), float("nan") if i % 17 == 0 else i % 5 + (i % 3) * 10.0,
             None if i % 13 == 0 else f" Seg{i % 4}", CLASSES[i % 3]) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def fitted(spark):
    from tabrisk.session import checkpoint_dir
    checkpoint_dir(spark)
    return bundles.fit_bundle(_frame(spark), "id", "label", CLASSES, ["a", "b"], ["seg"], SMALL, "small")


def test_kept_trees_predict_as_the_fit_does_in_both_ways(spark, monkeypatch):
    from tabrisk.session import checkpoint_dir
    checkpoint_dir(spark)
    df = _frame(spark).select("id", F.array("a", "b").alias("features"), (F.col("id") % 3).alias("label"), F.lit(1.0).alias("weight"),
                              F.lit(0).alias("fold"), (F.col("id") % 4 != 0).cast("int").alias("is_train"))
    edges = tree_models.cut_points(df.select(F.col("features").alias("x")))
    rows, fit = tree_models.binned(df, "id", edges), Fit("m", SMALL)
    want = {r["id"]: r["proba"] for r in tree_models.fit_predict(rows, [fit], 3, edges).where("part = 'new'").collect()}
    assert len(want) == 45
    for size in (tree_models.GROUP_BYTES, 0):
        monkeypatch.setattr(tree_models, "GROUP_BYTES", size)
        table, start = tree_models.fit_boosting(rows, fit, 3, edges)
        assert table.count() == 15
        got = df.where("is_train = 0").select("id", BoostedModel(edges, start, table).proba(F.col("features")).alias("proba"))
        for r in got.collect():
            assert np.allclose(r["proba"], want[r["id"]], atol=1e-12)


def test_reload_is_exact_and_changes_are_refused(spark, fitted, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "bundle")
    fitted.save(spark, path)
    loaded = bundles.Bundle.load(spark, path)
    assert loaded.metadata == fitted.metadata and loaded.class_map == {"x": 0, "y": 1, "z": 2}
    df = _frame(spark).drop("label")
    before, after = (b.score(df).select("id", "pred_label", "proba").orderBy("id").collect() for b in (fitted, loaded))
    assert before == after and len(after) == 180
    loaded.model.trees.limit(3).write.mode("append").parquet(f"{path}/trees")
    with pytest.raises(ValueError, match="trees"):
        bundles.Bundle.load(spark, path)


def test_unseen_null_and_repeated_rows_and_an_empty_table(spark, fitted):
    odd = spark.createDataFrame([(1, None, None, None), (1, None, None, None), (2, float("inf"), -1e300, "never seen")],
                                "id long, a double, b double, seg string")
    got = fitted.score(odd).orderBy("id").collect()
    assert len(got) == 3 and got[0]["proba"] == got[1]["proba"]
    assert all(abs(sum(r["proba"]) - 1) < 1e-9 and set(r["class_probs"]) == set(CLASSES) for r in got)
    assert fitted.score(odd.limit(0)).count() == 0


def test_holdout_metadata_counts_every_held_row(fitted):
    assert [sum(row) for row in fitted.metadata["confusion"]] == [12, 12, 12]
    assert set(fitted.metadata["valid"]) == {"accuracy", "f1_w", "f1_macro"}


def test_stream_scores_as_the_batch_does(spark, fitted, tmpdir_fresh):
    from tabrisk.streaming.scorer import start_bundle_scoring
    path, src, sink = (os.path.join(tmpdir_fresh, n) for n in ("bundle", "incoming", "scored"))
    fitted.save(spark, path)
    df = _frame(spark).drop("label")
    df.repartition(3).write.parquet(src)
    q = start_bundle_scoring(spark, src, df.schema, path, "id", sink, os.path.join(tmpdir_fresh, "ckpt"), max_files_per_trigger=1)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    streamed = spark.read.parquet(sink).orderBy("id").collect()
    assert streamed == fitted.score(df).select("id", "pred_code", "pred_label", "proba").orderBy("id").collect()


def test_rows_that_are_alike_are_one_row_of_a_fit(spark, monkeypatch):
    """A table too large for a task is fitted in one if its combinations of bins, label and weight are few, to the same trees."""
    from tabrisk.session import checkpoint_dir
    checkpoint_dir(spark)
    df = spark.range(600).select("id", F.array((F.col("id") % 5).cast("double"), (F.floor(F.col("id") / 5) % 4).cast("double")).alias("features"),
                                 F.when(F.col("id") % 7 < 2, F.col("id") % 3).otherwise(F.col("id") % 2).cast("int").alias("label"), (1 + F.col("id") % 2 / 4).alias("weight"),
                                 F.lit(None).cast("int").alias("fold"), (F.col("id") % 4 != 0).cast("int").alias("is_train"))
    edges = tree_models.cut_points(df.select(F.col("features").alias("x")))
    rows, fit = tree_models.binned(df, "id", edges), Fit("m", SMALL)
    few = tree_models.alike(rows)
    assert few.count() < 200 and few.agg(F.sum("n")).first()[0] == 600
    whole, start = tree_models.fit_boosting(rows, fit, 3, edges)
    monkeypatch.setattr(tree_models, "GROUP_BYTES", few.count() * (2 + tree_models.ROW_BYTES))
    monkeypatch.setattr(tree_models, "_grow_by_level", None)
    merged, start_merged = tree_models.fit_boosting(rows, fit, 3, edges)
    assert start == start_merged
    assert whole.orderBy("round", "class").collect() == merged.orderBy("round", "class").collect()
