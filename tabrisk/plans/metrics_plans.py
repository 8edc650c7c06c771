"""Metric queries (X*, T-1/T-2, W4, M18, G16) over the pseudo-model predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabrisk.functions.columns import argmax_first
from tabrisk.operators import metrics, split
from tabrisk.plans.common import r, rs, sql_with
from tabrisk.plans.registry import register
from tabrisk.sources.tables import CLASSES, MODELS, SCORES_SQL, scores_wide

# --- shared SQL ---------------------------------------------------------------
PRED_SQL = SCORES_SQL.strip() + """,
pw AS (SELECT o_orderkey, label, model,
              max(prob) FILTER (WHERE class = 0) AS p0, max(prob) FILTER (WHERE class = 1) AS p1,
              max(prob) FILTER (WHERE class = 2) AS p2
       FROM scores GROUP BY o_orderkey, label, model),
preds AS (SELECT o_orderkey, CAST(label AS INTEGER) AS label, model,
                 CAST(CASE WHEN p0 >= p1 AND p0 >= p2 THEN 0 WHEN p1 >= p2 THEN 1 ELSE 2 END AS INTEGER) AS pred,
                 CASE WHEN o_orderkey % 10 < 7 THEN 'train' ELSE 'valid' END AS split
          FROM pw)"""


def metric_ctes(src: str, by: list[str], prefix: str = "") -> str:
    """CTEs ``{prefix}conf``, ``{prefix}pc``, ``{prefix}summ`` grouped by ``by``."""
    b = ", ".join(by)
    bsel = (b + ", ") if by else ""
    on = " AND ".join([f"s.{c} = p.{c}" for c in by] + ["s.class = p.class"])
    co = ", ".join(f"coalesce(s.{c}, p.{c}) AS {c}" for c in by)
    co = (co + ", ") if by else ""
    gb = f"GROUP BY {b}" if by else ""
    return f"""
{prefix}conf AS (SELECT {bsel}label, pred, count(*) AS n FROM {src} GROUP BY {bsel}label, pred),
{prefix}sup AS (SELECT {bsel}label AS class, sum(n) AS support, sum(CASE WHEN label = pred THEN n ELSE 0 END) AS tp
                FROM {prefix}conf GROUP BY {bsel}label),
{prefix}prd AS (SELECT {bsel}pred AS class, sum(n) AS n_pred FROM {prefix}conf GROUP BY {bsel}pred),
{prefix}pc0 AS (SELECT {co}coalesce(s.class, p.class) AS class, coalesce(s.support, 0) AS support,
                       coalesce(p.n_pred, 0) AS n_pred, coalesce(s.tp, 0) AS tp
                FROM {prefix}sup s FULL OUTER JOIN {prefix}prd p ON {on}),
{prefix}pc1 AS (SELECT *, CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0.0 END AS precision,
                       CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM {prefix}pc0),
{prefix}pc AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2.0 * precision * recall / (precision + recall)
                             ELSE 0.0 END AS f1 FROM {prefix}pc1),
{prefix}summ AS (SELECT {bsel}sum(tp) / sum(support) AS accuracy,
                        sum(precision * support) / sum(support) AS precision_w,
                        sum(recall * support) / sum(support) AS recall_w,
                        sum(f1 * support) / sum(support) AS f1_w,
                        avg(f1) AS f1_macro,
                        avg(CASE WHEN support > 0 THEN recall END) AS balanced_accuracy
                 FROM {prefix}pc {gb})"""


_SUMMARY_COLS = ["accuracy", "precision_w", "recall_w", "f1_w", "f1_macro", "balanced_accuracy"]


def preds_long(spark, sf_dir):
    """``(o_orderkey, label, model, pred, split)`` from the three pseudo models."""
    w = scores_wide(spark, sf_dir)
    entries = [F.struct(F.lit(m).alias("model"), argmax_first(f"p_{m}").alias("pred")) for m in MODELS]
    return w.select("o_orderkey", F.col("label").cast("int").alias("label"), F.inline(F.array(*entries)),
                    F.when(F.col("o_orderkey") % 10 < 7, "train").otherwise("valid").alias("split"))


# --- queries ------------------------------------------------------------------
@register("metrics_overall", sql_with(PRED_SQL, metric_ctes("preds", ["model"])) + f"""
SELECT model, {', '.join(rs(c, 6) + ' AS ' + c for c in _SUMMARY_COLS)} FROM summ""")
def q_metrics_overall(spark, sf_dir):
    s = metrics.summary(metrics.confusion(preds_long(spark, sf_dir), "label", "pred", by=["model"]), by=["model"])
    return s.select("model", *[r(c, 6).alias(c) for c in _SUMMARY_COLS])


@register("balanced_accuracy", sql_with(PRED_SQL, metric_ctes("preds", ["model", "split"])) + f"""
SELECT model, split, {rs('balanced_accuracy', 6)} AS balanced_accuracy FROM summ""")
def q_balanced_accuracy(spark, sf_dir):
    by = ["model", "split"]
    s = metrics.summary(metrics.confusion(preds_long(spark, sf_dir), "label", "pred", by=by), by=by)
    return s.select(*by, r("balanced_accuracy", 6).alias("balanced_accuracy"))


@register("confusion_matrix", sql_with(PRED_SQL) + """,
g AS (SELECT m.model, l.label, p.pred FROM (SELECT DISTINCT model FROM preds) m,
      (VALUES (0), (1), (2)) l(label), (VALUES (0), (1), (2)) p(pred)),
c AS (SELECT model, label, pred, count(*) AS n FROM preds GROUP BY model, label, pred)
SELECT g.model, CAST(g.label AS INTEGER) AS label, CAST(g.pred AS INTEGER) AS pred, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM g LEFT JOIN c ON g.model = c.model AND g.label = c.label AND g.pred = c.pred""")
def q_confusion_matrix(spark, sf_dir):
    c = metrics.confusion(preds_long(spark, sf_dir), "label", "pred", by=["model"], classes=[0, 1, 2])
    return c.select("model", F.col("label").cast("int"), F.col("pred").cast("int"), "n")


@register("classification_report", sql_with(PRED_SQL + """,
p1 AS (SELECT label, pred FROM preds WHERE model = 'm1')""", metric_ctes("p1", [])) + f"""
SELECT CASE class WHEN 0 THEN 'F' WHEN 1 THEN 'O' WHEN 2 THEN 'P' END AS row_name,
       {rs('precision', 6)} AS precision, {rs('recall', 6)} AS recall, {rs('f1', 6)} AS f1,
       CAST(support AS BIGINT) AS support FROM pc
UNION ALL SELECT 'accuracy', NULL, NULL, {rs('accuracy', 6)}, (SELECT CAST(sum(support) AS BIGINT) FROM pc) FROM summ
UNION ALL SELECT 'macro avg', (SELECT {rs('avg(precision)', 6)} FROM pc), (SELECT {rs('avg(recall)', 6)} FROM pc),
          {rs('f1_macro', 6)}, (SELECT CAST(sum(support) AS BIGINT) FROM pc) FROM summ
UNION ALL SELECT 'weighted avg', {rs('precision_w', 6)}, {rs('recall_w', 6)}, {rs('f1_w', 6)},
          (SELECT CAST(sum(support) AS BIGINT) FROM pc) FROM summ""")
def q_classification_report(spark, sf_dir):
    p = preds_long(spark, sf_dir).where(F.col("model") == "m1")
    rep = metrics.classification_report(metrics.confusion(p, "label", "pred"), dict(enumerate(CLASSES)))
    return rep.select("row_name", *[r(c, 6).alias(c) for c in ["precision", "recall", "f1"]], "support")


_LB_COLS = _SUMMARY_COLS + ["train_accuracy"]


@register("leaderboard", sql_with(PRED_SQL, metric_ctes("preds", ["model", "split"])) + f""",
v AS (SELECT s.*, t.accuracy AS train_accuracy FROM summ s
      LEFT JOIN (SELECT model, accuracy FROM summ WHERE split = 'train') t ON s.model = t.model
      WHERE s.split = 'valid')
SELECT model, {', '.join(rs(c, 6) + ' AS ' + c for c in _LB_COLS)},
       CAST(train_accuracy - accuracy > 0.10 AS INTEGER) AS is_overfit,
       CAST(row_number() OVER (ORDER BY f1_w DESC, model) AS INTEGER) AS rank,
       CAST(f1_w = max(f1_w) OVER () AS INTEGER) AS is_best
FROM v""")
def q_leaderboard(spark, sf_dir):
    lb = metrics.leaderboard(preds_long(spark, sf_dir), "model", "label", "pred", split="split")
    return lb.select("model", *[r(c, 6).alias(c) for c in _LB_COLS], "is_overfit", "rank", "is_best")


@register("champion", sql_with(PRED_SQL, metric_ctes("preds", ["model"])) + f"""
SELECT model, {rs('f1_w', 6)} AS f1_w FROM summ ORDER BY f1_w DESC, model LIMIT 1""")
def q_champion(spark, sf_dir):
    s = metrics.summary(metrics.confusion(preds_long(spark, sf_dir), "label", "pred", by=["model"]), by=["model"])
    return metrics.champion(s, "model").select("model", r("f1_w", 6).alias("f1_w"))


_FOLD_SQL = """,
pos AS (SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderstatus
          ORDER BY md5(concat_ws('-', CAST(o_orderkey AS VARCHAR), '42')), o_orderkey) AS p FROM orders),
fp AS (SELECT p.o_orderkey, p.label, p.model, p.pred, CAST((pos.p - 1) % 5 AS INTEGER) AS fold
       FROM preds p JOIN pos ON p.o_orderkey = pos.o_orderkey)"""


@register("cv_summary", sql_with(PRED_SQL + _FOLD_SQL, metric_ctes("fp", ["model", "fold"])) + f"""
SELECT model, {rs('avg(balanced_accuracy)', 6)} AS mean_score, {rs('stddev_pop(balanced_accuracy)', 6)} AS std_score,
       {rs('min(balanced_accuracy)', 6)} AS min_score, {rs('max(balanced_accuracy)', 6)} AS max_score,
       CAST(count(*) AS BIGINT) AS n_folds
FROM summ GROUP BY model""")
def q_cv_summary(spark, sf_dir):
    from tabrisk.sources.tables import table
    folds = split.stratified_kfold(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"),
                                   "o_orderstatus", "o_orderkey", 5, 42).select("o_orderkey", "fold")
    p = preds_long(spark, sf_dir).join(folds, "o_orderkey")
    by = ["model", "fold"]
    s = metrics.summary(metrics.confusion(p, "label", "pred", by=by), by=by)
    agg = s.groupBy("model").agg(F.avg("balanced_accuracy").alias("mean_score"),
                                 F.stddev_pop("balanced_accuracy").alias("std_score"),
                                 F.min("balanced_accuracy").alias("min_score"),
                                 F.max("balanced_accuracy").alias("max_score"),
                                 F.count(F.lit(1)).alias("n_folds"))
    return agg.select("model", *[r(c, 6).alias(c) for c in ["mean_score", "std_score", "min_score", "max_score"]],
                      F.col("n_folds").cast("long"))
