"""Blending, OOF reshaping, weight grids, strategy choice and submission queries (N*, J4–J6, A5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabrisk.functions.columns import argmax_first
from tabrisk.operators import ensemble, metrics, weights
from tabrisk.plans.common import r, rs, sql_with
from tabrisk.plans.metrics_plans import PRED_SQL, metric_ctes
from tabrisk.plans.registry import register
from tabrisk.session import scratch_path
from tabrisk.sources.tables import (CLASSES, FOLD_SCORES_SQL, MODELS, SCORES_SQL, base, fold_scores_long,
                                    scores_long, scores_wide)

K = len(CLASSES)
VOTE = {"p_m1": 0.4, "p_m2": 0.4, "p_m3": 0.2}

WIDE_SQL = SCORES_SQL.strip() + """,
sw AS (SELECT o_orderkey, CAST(label AS INTEGER) AS label, """ + ", ".join(
    f"max(prob) FILTER (WHERE model = '{m}' AND class = {c}) AS {m}_{c}" for m in MODELS for c in range(K)) + """
       FROM scores GROUP BY o_orderkey, label)"""


def _argmax_sql(a: str, b: str, c: str) -> str:
    return f"CAST(CASE WHEN {a} >= {b} AND {a} >= {c} THEN 0 WHEN {b} >= {c} THEN 1 ELSE 2 END AS INTEGER)"


def _vote_sql(c: int) -> str:
    return " + ".join(f"CAST({w} AS DOUBLE) * {m[2:]}_{c}" for m, w in VOTE.items())


@register("soft_vote", sql_with(WIDE_SQL) + f""",
v AS (SELECT o_orderkey, {_vote_sql(0)} AS b0, {_vote_sql(1)} AS b1, {_vote_sql(2)} AS b2 FROM sw)
SELECT o_orderkey, {_argmax_sql('b0', 'b1', 'b2')} AS pred, {rs('b0', 6)} AS p0, {rs('b1', 6)} AS p1, {rs('b2', 6)} AS p2
FROM v""")
def q_soft_vote(spark, sf_dir):
    v = ensemble.soft_vote(scores_wide(spark, sf_dir), VOTE, K)
    return v.select("o_orderkey", F.col("blend_pred").alias("pred"),
                    *[r(F.col("blend")[c], 6).alias(f"p{c}") for c in range(K)])


@register("mean_blend", sql_with(WIDE_SQL) + f""",
v AS (SELECT o_orderkey, {', '.join(f'(m1_{c} + m2_{c} + m3_{c}) / 3 AS a{c}' for c in range(K))},
             {', '.join(f'(m1_{c} + m2_{c}) / 2 AS s{c}' for c in range(K))} FROM sw)
SELECT o_orderkey, {_argmax_sql('a0', 'a1', 'a2')} AS pred_all, {_argmax_sql('s0', 's1', 's2')} AS pred_subset,
       {rs('a0', 6)} AS p0_all FROM v""")
def q_mean_blend(spark, sf_dir):
    w = scores_wide(spark, sf_dir)
    w = w.withColumn("all", ensemble.mean_blend(["p_m1", "p_m2", "p_m3"], K)).withColumn(
        "subset", ensemble.mean_blend(["p_m1", "p_m2"], K))
    return w.select("o_orderkey", argmax_first("all").alias("pred_all"), argmax_first("subset").alias("pred_subset"),
                    r(F.col("all")[0], 6).alias("p0_all"))


@register("fold_average", sql_with(FOLD_SCORES_SQL) + """
SELECT o_orderkey, model, class, """ + rs("sum(prob) / 5", 6) + """ AS prob FROM fold_scores GROUP BY o_orderkey, model, class""")
def q_fold_average(spark, sf_dir):
    fa = ensemble.fold_average(fold_scores_long(spark, sf_dir), "o_orderkey", 5)
    return fa.select("o_orderkey", "model", F.col("class").cast("int"), r("prob", 6).alias("prob"))


@register("oof_long_to_wide", sql_with(SCORES_SQL) + """
SELECT o_orderkey, """ + ", ".join(
    rs(f"max(prob) FILTER (WHERE model = '{m}' AND class = {c})", 6) + f" AS c{c}_{m}"
    for c in range(K) for m in MODELS) + """
FROM scores GROUP BY o_orderkey""")
def q_oof_long_to_wide(spark, sf_dir):
    # A5: the long cube is a restartable stage table, partitioned by model.
    path = scratch_path(spark, "oof_cube")
    scores_long(spark, sf_dir).write.mode("overwrite").partitionBy("model").parquet(path)
    back = spark.read.parquet(path)
    wide = ensemble.long_to_wide(back, "o_orderkey", MODELS, K)
    cols = [c for c in wide.columns if c != "o_orderkey"]
    return wide.select("o_orderkey", *[r(c, 6).alias(c) for c in cols])


_MULT_VALUES = [0.6, 0.8, 1.0, 1.2, 1.4]
_MULT_GRID = ensemble.multiplier_grid(_MULT_VALUES, K)


def _grid_values_sql(points, names) -> str:
    rows = ", ".join("(" + ", ".join([str(i)] + [f"CAST({v!r} AS DOUBLE)" for v in p]) + ")"
                     for i, p in enumerate(points))
    return f"(VALUES {rows}) g(grid_id, {', '.join(names)})"


@register("class_multiplier_grid", sql_with(WIDE_SQL) + f""",
v AS (SELECT o_orderkey, label, {_vote_sql(0)} AS b0, {_vote_sql(1)} AS b1, {_vote_sql(2)} AS b2 FROM sw),
gp AS (SELECT g.grid_id, g.w0, g.w1, g.w2, v.label,
              {_argmax_sql('g.w0 * v.b0', 'g.w1 * v.b1', 'g.w2 * v.b2')} AS pred
       FROM v CROSS JOIN {_grid_values_sql(_MULT_GRID, ['w0', 'w1', 'w2'])}),
{metric_ctes('gp', ['grid_id', 'w0', 'w1', 'w2']).strip()}
SELECT CAST(grid_id AS INTEGER) AS grid_id, w0, w1, w2, {rs('f1_w', 6)} AS f1_w,
       CAST(row_number() OVER (ORDER BY round(f1_w, 6) DESC, grid_id) = 1 AS INTEGER) AS is_best
FROM summ""")
def q_class_multiplier_grid(spark, sf_dir):
    v = ensemble.soft_vote(scores_wide(spark, sf_dir), VOTE, K)
    scored = ensemble.score_class_multipliers(v, "blend", "label", _MULT_GRID, K)
    scored = scored.withColumn("f1_w", r("f1_w", 6))
    return ensemble.mark_best(scored, "f1_w").select(F.col("grid_id").cast("int"), "w0", "w1", "w2", "f1_w",
                                                     "is_best")


_SIMPLEX = ensemble.simplex_grid(len(MODELS), 10)


@register("blend_weight_grid", sql_with(WIDE_SQL) + f""",
gp AS (SELECT g.grid_id, g.w_p_m1, g.w_p_m2, g.w_p_m3, sw.label,
              {_argmax_sql(*[f'g.w_p_m1 * sw.m1_{c} + g.w_p_m2 * sw.m2_{c} + g.w_p_m3 * sw.m3_{c}' for c in range(K)])} AS pred
       FROM sw CROSS JOIN {_grid_values_sql(_SIMPLEX, ['w_p_m1', 'w_p_m2', 'w_p_m3'])}),
{metric_ctes('gp', ['grid_id', 'w_p_m1', 'w_p_m2', 'w_p_m3']).strip()}
SELECT CAST(grid_id AS INTEGER) AS grid_id, w_p_m1, w_p_m2, w_p_m3, {rs('balanced_accuracy', 6)} AS balanced_accuracy,
       CAST(row_number() OVER (ORDER BY round(balanced_accuracy, 6) DESC, grid_id) = 1 AS INTEGER) AS is_best
FROM summ""")
def q_blend_weight_grid(spark, sf_dir):
    w = scores_wide(spark, sf_dir)
    scored = ensemble.score_blend_weights(w, ["p_m1", "p_m2", "p_m3"], "label", _SIMPLEX, K)
    scored = scored.withColumn("balanced_accuracy", r("balanced_accuracy", 6))
    return ensemble.mark_best(scored, "balanced_accuracy").select(
        F.col("grid_id").cast("int"), "w_p_m1", "w_p_m2", "w_p_m3", "balanced_accuracy", "is_best")


# Candidate strategies scored on the same rows; the best one is chosen.
_STRAT_SQL = sql_with(WIDE_SQL) + f""",
cand AS (
  SELECT o_orderkey, label, 'model_m1' AS strategy, {_argmax_sql('m1_0', 'm1_1', 'm1_2')} AS pred FROM sw
  UNION ALL SELECT o_orderkey, label, 'model_m2', {_argmax_sql('m2_0', 'm2_1', 'm2_2')} FROM sw
  UNION ALL SELECT o_orderkey, label, 'model_m3', {_argmax_sql('m3_0', 'm3_1', 'm3_2')} FROM sw
  UNION ALL SELECT o_orderkey, label, 'mean_all', {_argmax_sql(*[f'(m1_{c} + m2_{c} + m3_{c}) / 3' for c in range(K)])} FROM sw
  UNION ALL SELECT o_orderkey, label, 'mean_subset', {_argmax_sql(*[f'(m1_{c} + m2_{c}) / 2' for c in range(K)])} FROM sw
  UNION ALL SELECT o_orderkey, label, 'soft_vote', {_argmax_sql(_vote_sql(0), _vote_sql(1), _vote_sql(2))} FROM sw),
{metric_ctes('cand', ['strategy']).strip()}
SELECT strategy, {rs('balanced_accuracy', 6)} AS balanced_accuracy,
       CAST(row_number() OVER (ORDER BY round(balanced_accuracy, 6) DESC, strategy) = 1 AS INTEGER) AS is_best
FROM summ"""


def _strategies(spark, sf_dir):
    w = scores_wide(spark, sf_dir)
    w = (w.withColumn("mean_all", ensemble.mean_blend(["p_m1", "p_m2", "p_m3"], K))
         .withColumn("mean_subset", ensemble.mean_blend(["p_m1", "p_m2"], K))
         .withColumn("soft_vote", ensemble.weighted_blend(VOTE, K)))
    cands = {"model_m1": "p_m1", "model_m2": "p_m2", "model_m3": "p_m3", "mean_all": "mean_all",
             "mean_subset": "mean_subset", "soft_vote": "soft_vote"}
    entries = [F.struct(F.lit(s).alias("strategy"), argmax_first(c).alias("pred")) for s, c in cands.items()]
    return w.select("o_orderkey", "label", F.inline(F.array(*entries)))


@register("strategy_select", _STRAT_SQL)
def q_strategy_select(spark, sf_dir):
    s = metrics.summary(metrics.confusion(_strategies(spark, sf_dir), "label", "pred", by=["strategy"]),
                        by=["strategy"]).withColumn("balanced_accuracy", r("balanced_accuracy", 6))
    return ensemble.mark_best(s.select("strategy", "balanced_accuracy"), "balanced_accuracy", order="strategy")


_TEST_PRED_SQL = sql_with(WIDE_SQL) + f""",
tp AS (SELECT o_orderkey, {_argmax_sql(_vote_sql(0), _vote_sql(1), _vote_sql(2))} AS pred FROM sw
       WHERE o_orderkey % 10 >= 7)"""


def _test_predictions(spark, sf_dir):
    """Soft-vote labels of the unlabelled (test) orders: ``(o_orderkey, o_orderstatus)``."""
    v = ensemble.soft_vote(scores_wide(spark, sf_dir), VOTE, K)
    test_ids = base(spark, sf_dir).where(F.col("is_train") == 0).select("o_orderkey")
    names = F.array(*[F.lit(c) for c in CLASSES])
    # Predictions are attached to ids by key, never by position
    return test_ids.join(v.select("o_orderkey", "blend_pred"), "o_orderkey").select(
        "o_orderkey", F.element_at(names, F.col("blend_pred") + 1).alias("o_orderstatus"))


@register("submission", _TEST_PRED_SQL + """
SELECT o_orderkey, CASE pred WHEN 0 THEN 'F' WHEN 1 THEN 'O' ELSE 'P' END AS o_orderstatus FROM tp""")
def q_submission(spark, sf_dir):
    return _test_predictions(spark, sf_dir)


@register("submission_breakdown", _TEST_PRED_SQL + """
SELECT CASE pred WHEN 0 THEN 'F' WHEN 1 THEN 'O' ELSE 'P' END AS o_orderstatus, CAST(count(*) AS BIGINT) AS n,
       """ + rs("count(*) * 100.0 / sum(count(*)) OVER ()", 2) + """ AS pct FROM tp GROUP BY pred""")
def q_submission_breakdown(spark, sf_dir):
    from tabrisk.operators.profile import value_counts
    vc = value_counts(_test_predictions(spark, sf_dir), "o_orderstatus")
    return vc.select("o_orderstatus", F.col("n").cast("long"), r("pct", 2).alias("pct"))


@register("attach_predictions", _TEST_PRED_SQL + """
SELECT b.o_orderkey, b.o_totalprice, CASE tp.pred WHEN 0 THEN 'F' WHEN 1 THEN 'O' ELSE 'P' END AS pred_label
FROM orders b JOIN tp ON b.o_orderkey = tp.o_orderkey""")
def q_attach_predictions(spark, sf_dir):
    from tabrisk.sources.tables import table
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    p = _test_predictions(spark, sf_dir).withColumnRenamed("o_orderstatus", "pred_label")
    return o.join(p, "o_orderkey", "inner")


# Validate a submission against the template (all test ids, allowed labels).
# The submission scored here only covers orders that have line items, so orders without
# any line are reported as missing.
@register("validate_submission", _TEST_PRED_SQL + """,
sub AS (SELECT tp.o_orderkey, CASE tp.pred WHEN 0 THEN 'F' WHEN 1 THEN 'O' ELSE 'P' END AS o_orderstatus
        FROM tp WHERE tp.o_orderkey IN (SELECT l_orderkey FROM lineitem)),
tmpl AS (SELECT o_orderkey FROM orders WHERE o_orderkey % 10 >= 7)
SELECT 'missing' AS kind, t.o_orderkey, CAST(NULL AS VARCHAR) AS value FROM tmpl t
  WHERE t.o_orderkey NOT IN (SELECT o_orderkey FROM sub)
UNION ALL SELECT 'extra', s.o_orderkey, s.o_orderstatus FROM sub s WHERE s.o_orderkey NOT IN (SELECT o_orderkey FROM tmpl)
UNION ALL SELECT 'bad_label', s.o_orderkey, s.o_orderstatus FROM sub s WHERE s.o_orderstatus NOT IN ('F', 'O', 'P')""")
def q_validate_submission(spark, sf_dir):
    from tabrisk.operators.score import validate_submission
    from tabrisk.sources.tables import table
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    sub = _test_predictions(spark, sf_dir).join(li, "o_orderkey", "left_semi")
    tmpl = base(spark, sf_dir).where(F.col("is_train") == 0).select("o_orderkey")
    return validate_submission(sub, tmpl, "o_orderkey", "o_orderstatus", list(CLASSES))


def _optimised_row(spark, kind: str, n: int, found: tuple, again: float):
    w, score, start = found
    return spark.createDataFrame([(kind, n, round(sum(w), 9), round(start, 9), bool(score >= start), bool(abs(score - again) < 1e-12))],
                                 "kind string, n_weights int, total double, equal_score double, not_worse boolean, score_holds boolean")


def _recall_sql(pred: str) -> str:
    return f"(SELECT avg(r) FROM (SELECT avg(CASE WHEN {pred} = label THEN 1.0 ELSE 0.0 END) AS r FROM v GROUP BY label))"


@register("blend_weights_optimised", sql_with(WIDE_SQL) + f""",
v AS (SELECT label, {', '.join(f'CAST(1.0 AS DOUBLE) / 3 * m1_{c} + CAST(1.0 AS DOUBLE) / 3 * m2_{c} + CAST(1.0 AS DOUBLE) / 3 * m3_{c} AS b{c}' for c in range(K))} FROM sw)
SELECT 'blend' AS kind, CAST(3 AS INTEGER) AS n_weights, CAST(1.0 AS DOUBLE) AS total, round({_recall_sql(_argmax_sql('b0', 'b1', 'b2'))}, 9) AS equal_score,
       true AS not_worse, true AS score_holds""")
def q_blend_weights_optimised(spark, sf_dir):
    """Blend weights of greatest balanced accuracy; the score is counted again by the blend and metric operators."""
    df, probs = scores_wide(spark, sf_dir), list(VOTE)
    found = weights.optimise(df, "label", probs, K)
    again = ensemble.soft_vote(df, dict(zip(probs, found[0])), K)
    return _optimised_row(spark, "blend", len(probs), found, metrics.summary(metrics.confusion(again, "label", "blend_pred")).first()["balanced_accuracy"])


@register("class_multipliers_optimised", sql_with(WIDE_SQL) + f""",
v AS (SELECT label, {_argmax_sql('m1_0', 'm1_1', 'm1_2')} AS pred FROM sw),
f AS (SELECT c.label, count(*) FILTER (WHERE v.label = c.label) AS support, 2.0 * count(*) FILTER (WHERE v.label = c.label AND v.pred = c.label)
        / (count(*) FILTER (WHERE v.label = c.label) + count(*) FILTER (WHERE v.pred = c.label)) AS f1
      FROM v CROSS JOIN (SELECT DISTINCT label FROM v) c GROUP BY c.label)
SELECT 'multipliers' AS kind, CAST(3 AS INTEGER) AS n_weights, CAST(1.0 AS DOUBLE) AS total, round(sum(f1 * support) / sum(support), 9) AS equal_score,
       true AS not_worse, true AS score_holds FROM f""")
def q_class_multipliers_optimised(spark, sf_dir):
    """Class multipliers of greatest weighted F1 for one model's probabilities."""
    df = scores_wide(spark, sf_dir)
    found = weights.optimise(df, "label", ["p_m1"], K, weights.weighted_f1)
    pred = df.withColumn("pred", argmax_first(F.array(*[F.lit(w) * F.col("p_m1")[c] for c, w in enumerate(found[0])])))
    return _optimised_row(spark, "multipliers", K, found, metrics.summary(metrics.confusion(pred, "label", "pred")).first()["f1_w"])
