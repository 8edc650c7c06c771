"""The production bundle: fitted at the reference's settings, saved, loaded and served, on labels with a known rule.

The order key modulo 3 decides which of three measures is large, so that a right bundle names every row's class.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabrisk.operators.bundle import Bundle, fit_bundle
from tabrisk.operators.metrics import confusion, confusion_wide
from tabrisk.operators.trees import Boosting, Growth
from tabrisk.plans.common import ID, r
from tabrisk.plans.registry import register
from tabrisk.session import checkpoint_dir, scratch_path
from tabrisk.sources.tables import CLASSES, scores_wide, table

# The reference's settings.
PRODUCTION = Boosting(300, 0.05, Growth(depth=7, leaves=31, least=20))
NUMERIC = [f"f{c}" for c in range(len(CLASSES))]
CATEGORICAL = ["o_orderpriority"]
_RULE = "CASE o_orderkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'O' ELSE 'P' END"


def ruled(spark, sf_dir) -> DataFrame:
    """(o_orderkey, f0, f1, f2, o_orderpriority, label); every eleventh priority is NULL."""
    o = table(spark, sf_dir, "orders").select(ID, "o_totalprice", "o_custkey", "o_orderpriority")
    noise = [(F.floor("o_totalprice") % 10) / 10.0, (F.col("o_custkey") % 10) / 10.0, (F.col("o_custkey") % 7) / 7.0]
    turn = F.col(ID) % len(CLASSES)
    return o.select(ID, *[(F.when(turn == c, 10.0).otherwise(0.0) + n).alias(f"f{c}") for c, n in enumerate(noise)],
                    F.when(F.col(ID) % 11 != 0, F.col("o_orderpriority")).alias("o_orderpriority"),
                    F.element_at(F.array(*[F.lit(c) for c in CLASSES]), (turn + 1).cast("int")).alias("label"))


def loaded(spark, sf_dir) -> tuple[DataFrame, Bundle]:
    """All rows, and the bundle as loaded from the folder that it was saved in."""
    checkpoint_dir(spark)
    rows = ruled(spark, sf_dir)
    path = scratch_path(spark, "bundle")
    fit_bundle(rows.where(F.col(ID) % 10 < 7), ID, "label", CLASSES, NUMERIC, CATEGORICAL, PRODUCTION, "production").save(spark, path)
    return rows, Bundle.load(spark, path)


@register("bundle_served", f"""
SELECT o_orderkey, {_RULE} AS pred_label, CAST(o_orderkey % 3 AS INTEGER) AS pred_code, CAST(1.0 AS DOUBLE) AS total FROM orders""")
def q_bundle_served(spark, sf_dir):
    """The prediction table is written, as the other tree queries write theirs; the trees run in numpy in that job."""
    rows, bundle = loaded(spark, sf_dir)
    path = scratch_path(spark, "predictions")
    bundle.score(rows.drop("label")).select(ID, "pred_label", "pred_code", "proba").write.parquet(path)
    scored = spark.read.schema(f"{ID} long, pred_label string, pred_code int, proba array<double>").parquet(path)
    return scored.select(ID, "pred_label", "pred_code", r(F.aggregate("proba", F.lit(0.0), lambda a, x: a + x)).alias("total"))


@register("bundle_holdout", f"""
WITH n AS (SELECT CAST(o_orderkey % 3 AS INTEGER) AS code, {_RULE} AS label, count(*) AS n FROM orders WHERE o_orderkey % 10 < 7 GROUP BY ALL)
SELECT label, code, CAST(floor(0.2::DOUBLE * n + 0.5::DOUBLE) AS BIGINT) AS right_rows, CAST(0 AS BIGINT) AS wrong_rows,
       CAST(1.0 AS DOUBLE) AS accuracy, CAST(1.0 AS DOUBLE) AS f1_w, CAST(1.0 AS DOUBLE) AS f1_macro FROM n""")
def q_bundle_holdout(spark, sf_dir):
    """What the loaded bundle's metadata says of its hold-out, a row per class."""
    _, bundle = loaded(spark, sf_dir)
    cells, valid = bundle.metadata["confusion"], bundle.metadata["valid"]
    rows = [(c, i, cells[i][i], sum(cells[i]) - cells[i][i], valid["accuracy"], valid["f1_w"], valid["f1_macro"])
            for c, i in bundle.class_map.items()]
    return spark.createDataFrame(rows, "label string, code int, right_rows long, wrong_rows long, accuracy double, f1_w double, f1_macro double")


@register("confusion_matrix_wide", """
WITH s AS (SELECT o_orderstatus AS label, CAST(1 + (o_orderkey * 7 + o_custkey * 3) % 10 + CASE WHEN o_orderstatus = 'F' THEN 6 ELSE 0 END AS DOUBLE) AS a,
                  CAST(1 + (o_orderkey * 7 + o_custkey * 4) % 10 + CASE WHEN o_orderstatus = 'O' THEN 6 ELSE 0 END AS DOUBLE) AS b,
                  CAST(1 + (o_orderkey * 7 + o_custkey * 5) % 10 + CASE WHEN o_orderstatus = 'P' THEN 6 ELSE 0 END AS DOUBLE) AS c FROM orders),
p AS (SELECT label, CASE WHEN a / (a + b + c) >= b / (a + b + c) AND a / (a + b + c) >= c / (a + b + c) THEN 0
                         WHEN b / (a + b + c) >= c / (a + b + c) THEN 1 ELSE 2 END AS pred FROM s)
SELECT label, CAST(count(*) FILTER (pred = 0) AS BIGINT) AS "pred_F", CAST(count(*) FILTER (pred = 1) AS BIGINT) AS "pred_O",
       CAST(count(*) FILTER (pred = 2) AS BIGINT) AS "pred_P" FROM p GROUP BY label""")
def q_confusion_matrix_wide(spark, sf_dir):
    from tabrisk.functions.columns import argmax_first
    preds = scores_wide(spark, sf_dir).select("label", argmax_first("p_m1").alias("pred"))
    return confusion_wide(confusion(preds, "label", "pred", classes=range(len(CLASSES))), CLASSES)
