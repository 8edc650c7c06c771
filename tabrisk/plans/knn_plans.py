"""k-NN classification (M2 / J7): validation orders against all train orders on the nine features, and embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabrisk.operators import encode, metric_knn
from tabrisk.plans.common import CAT, ID, LABEL, PREPARED_SQL, prepared, r, sql_with
from tabrisk.plans.registry import register
from tabrisk.sources.tables import CLASSES, table

K_NEIGHBOURS = 7
# Fixed per-feature divisors put the features on comparable ranges (no fitted scaler, so both engines compute bit-identical
# coordinates and distances); means are rounded first, as engines may add up in another order.
FEATS = {"o_totalprice": 100000, "c_acctbal": 2000, "n_lines": 1, "sum_qty": 50, "avg_price": 10000, "avg_disc": 0.02, "avg_tax": 0.02}
ROUNDED = {"avg_price": 2, "avg_disc": 6, "avg_tax": 6}


def _vote_sql(near: str, out_id: str) -> str:
    """CTEs and final SELECT of the vote over ``near`` (qid, rid, label, dist): the seven nearest, weighted by 1 / distance."""
    return f"""
t AS (SELECT * FROM {near} QUALIFY row_number() OVER (PARTITION BY qid ORDER BY dist, rid) <= {K_NEIGHBOURS}),
z AS (SELECT qid, max(CASE WHEN dist = 0 THEN 1 ELSE 0 END) AS has0 FROM t GROUP BY qid),
v AS (SELECT t.qid, t.label,
             round(sum(CASE WHEN z.has0 = 1 THEN (CASE WHEN t.dist = 0 THEN 1.0 ELSE 0.0 END) ELSE 1.0 / t.dist END), 9) AS score
      FROM t JOIN z ON t.qid = z.qid GROUP BY t.qid, t.label)
SELECT qid AS {out_id}, CAST(label AS INTEGER) AS pred FROM v
QUALIFY row_number() OVER (PARTITION BY qid ORDER BY score DESC, label) = 1"""


_COORDS = [(f"round({c}, {ROUNDED[c]})" if c in ROUNDED else c) + f" / CAST({d} AS DOUBLE)" for c, d in FEATS.items()]
_X = [f"x{i}" for i in range(len(FEATS) + len(CAT))]
_X_SQL = ", ".join(f"{e} AS {x}" for e, x in zip([*_COORDS, "CAST(coalesce(vp.code, 0) AS DOUBLE)", "CAST(coalesce(vs.code, 0) AS DOUBLE)"], _X))
_D_SQL = "sqrt(" + " + ".join(f"(q.{x} - r.{x}) * (q.{x} - r.{x})" for x in _X) + ")"


@register("knn_classify", sql_with(PREPARED_SQL) + f""",
vp AS (SELECT value, row_number() OVER (ORDER BY value) - 1 AS code FROM (SELECT DISTINCT o_orderpriority AS value FROM prepared WHERE is_train = 1)),
vs AS (SELECT value, row_number() OVER (ORDER BY value) - 1 AS code FROM (SELECT DISTINCT c_mktsegment AS value FROM prepared WHERE is_train = 1)),
x AS (SELECT o_orderkey AS id, is_train, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS label, {_X_SQL}
      FROM prepared LEFT JOIN vp ON o_orderpriority = vp.value LEFT JOIN vs ON c_mktsegment = vs.value),
near AS (SELECT q.id AS qid, r.id AS rid, r.label, {_D_SQL} AS dist FROM x q, x r WHERE q.is_train = 0 AND r.is_train = 1),""" + _vote_sql("near", "o_orderkey"))
def q_knn_classify(spark, sf_dir):
    p = prepared(spark, sf_dir)
    train = p.where(F.col("is_train") == 1)
    for c in CAT:
        p = encode.label_encode(p, c, encode.fit_vocabulary(train, c))
    xs = [(r(c, ROUNDED[c]) if c in ROUNDED else F.col(c)) / F.lit(float(d)) for c, d in FEATS.items()] + [F.col(f"{c}_code").cast("double") for c in CAT]
    code = (F.array_position(F.array(*[F.lit(c) for c in CLASSES]), F.col(LABEL)) - 1).cast("int")
    x = p.select(F.col(ID).alias("id"), F.array(*xs).alias("x"), code.alias("y"), "is_train")
    got = metric_knn.classify(x.where("is_train = 0"), x.where("is_train = 1"), K_NEIGHBOURS, len(CLASSES))
    return got.select(F.col("id").alias(ID), "pred")


@register("knn_embeddings", """
WITH x AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS x, label FROM embeddings WHERE embedding IS NOT NULL),
near AS (SELECT q.id AS qid, r.id AS rid, r.label, list_distance(q.x, r.x) AS dist FROM x q, x r WHERE q.id % 5 = 0 AND r.id % 5 <> 0 AND r.label IS NOT NULL),""" + _vote_sql("near", "vec_id"))
def q_knn_embeddings(spark, sf_dir):
    """Vectors whose id is divisible by five against all others, on all components."""
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("x"), F.col("label").alias("y"))
    refs = e.where("id % 5 <> 0 and y is not null")
    n_classes = refs.agg(F.max("y")).first()[0]
    return metric_knn.classify(e.where("id % 5 = 0"), refs, K_NEIGHBOURS, (n_classes or 0) + 1).select(F.col("id").alias("vec_id"), "pred")
