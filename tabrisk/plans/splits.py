"""Sampling, stratified splits, folds and class weights (S*, W5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabrisk.operators import split
from tabrisk.plans.common import ID, LABEL, r, rs, sql_with
from tabrisk.plans.registry import register
from tabrisk.sources.tables import BASE_SQL, base

SEED = 42
_HK = "md5(concat_ws('-', CAST(o_orderkey AS VARCHAR), '42'))"
_POS_SQL = f""",
pos AS (SELECT o_orderkey, o_orderstatus,
               row_number() OVER (PARTITION BY o_orderstatus ORDER BY {_HK}, o_orderkey) AS p,
               count(*) OVER (PARTITION BY o_orderstatus) AS n_c
        FROM base)"""


@register("sample_exact_n", sql_with(BASE_SQL) + f"""
SELECT o_orderkey, o_orderstatus FROM base ORDER BY {_HK}, o_orderkey LIMIT 1000""")
def q_sample_exact_n(spark, sf_dir):
    return split.sample_exact_n(base(spark, sf_dir).select(ID, LABEL), 1000, ID, SEED)


@register("stratified_holdout", sql_with(BASE_SQL) + _POS_SQL + """
SELECT o_orderkey, o_orderstatus,
       CASE WHEN p <= floor(CAST(0.2 AS DOUBLE) * CAST(n_c AS DOUBLE) + 0.5) THEN 'valid' ELSE 'train' END AS split
FROM pos""")
def q_stratified_holdout(spark, sf_dir):
    return split.stratified_holdout(base(spark, sf_dir).select(ID, LABEL), LABEL, ID, 0.2, SEED)


@register("split_distribution", sql_with(BASE_SQL) + _POS_SQL + f""",
s AS (SELECT o_orderstatus,
             CASE WHEN p <= floor(CAST(0.2 AS DOUBLE) * CAST(n_c AS DOUBLE) + 0.5) THEN 'valid' ELSE 'train' END AS split
      FROM pos)
SELECT split, o_orderstatus, CAST(count(*) AS BIGINT) AS n,
       {rs('count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY split)', 2)} AS pct
FROM s GROUP BY split, o_orderstatus""")
def q_split_distribution(spark, sf_dir):
    s = split.stratified_holdout(base(spark, sf_dir).select(ID, LABEL), LABEL, ID, 0.2, SEED)
    d = split.split_distribution(s, "split", LABEL)
    return d.select("split", LABEL, F.col("n").cast("long"), r("pct", 2).alias("pct"))


@register("stratified_sample_n", sql_with(BASE_SQL) + _POS_SQL + """,
tot AS (SELECT count(*) AS n FROM base)
SELECT o_orderkey, o_orderstatus FROM pos, tot
WHERE p <= floor((CAST(least(6000, tot.n) AS DOUBLE) / CAST(tot.n AS DOUBLE)) * CAST(n_c AS DOUBLE) + 0.5)""")
def q_stratified_sample_n(spark, sf_dir):
    return split.stratified_sample_n(base(spark, sf_dir).select(ID, LABEL), LABEL, ID, 6000, SEED)


@register("stratified_kfold", sql_with(BASE_SQL) + _POS_SQL + """
SELECT o_orderkey, o_orderstatus, CAST((p - 1) % 5 AS INTEGER) AS fold FROM pos""")
def q_stratified_kfold(spark, sf_dir):
    return split.stratified_kfold(base(spark, sf_dir).select(ID, LABEL), LABEL, ID, 5, SEED)


@register("balanced_weights", sql_with(BASE_SQL) + f""",
c AS (SELECT o_orderstatus, count(*) AS n_c FROM base GROUP BY o_orderstatus),
t AS (SELECT sum(n_c) AS n, count(*) AS k FROM c)
SELECT b.o_orderkey, b.o_orderstatus,
       {rs('CAST(t.n AS DOUBLE) / (CAST(t.k AS DOUBLE) * c.n_c)', 6)} AS weight
FROM base b JOIN c ON b.o_orderstatus = c.o_orderstatus, t""")
def q_balanced_weights(spark, sf_dir):
    w = split.balanced_weights(base(spark, sf_dir).select(ID, LABEL), LABEL)
    return w.select(ID, LABEL, r("weight", 6).alias("weight"))
