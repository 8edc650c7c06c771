"""Encoding, scaling and dictionary-join queries (K*, J1, J3, U3, U4, D5–D25)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabrisk.operators import encode
from tabrisk.operators.joins import join_small
from tabrisk.plans.common import ID, LABEL, NUM, PREPARED_SQL, prepared, r, rs, sql_with
from tabrisk.plans.registry import register
from tabrisk.session import scratch_path
from tabrisk.sources.tables import BASE_SQL, base, scores_wide, table


@register("label_encode", sql_with(BASE_SQL) + """,
v AS (SELECT o_orderstatus AS value, CAST(row_number() OVER (ORDER BY o_orderstatus) - 1 AS INTEGER) AS code
      FROM (SELECT DISTINCT o_orderstatus FROM base WHERE is_train = 1 AND o_orderstatus IS NOT NULL))
SELECT b.o_orderkey, b.o_orderstatus, v.code AS label_code FROM base b LEFT JOIN v ON b.o_orderstatus = v.value""")
def q_label_encode(spark, sf_dir):
    b = base(spark, sf_dir)
    vocab = encode.fit_vocabulary(b.where(F.col("is_train") == 1), LABEL)
    return encode.label_encode(b.select(ID, LABEL), LABEL, vocab, out="label_code", unseen_code=None)


# Vocabulary fitted on the train rows of the raw category; NULL (and any
# value absent from train) falls back to code 0.
@register("label_encode_unseen", sql_with(BASE_SQL) + """,
v AS (SELECT o_orderpriority AS value, CAST(row_number() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS code
      FROM (SELECT DISTINCT o_orderpriority FROM base WHERE is_train = 1 AND o_orderpriority IS NOT NULL))
SELECT b.o_orderkey, b.o_orderpriority, coalesce(v.code, 0) AS o_orderpriority_code
FROM base b LEFT JOIN v ON b.o_orderpriority = v.value""")
def q_label_encode_unseen(spark, sf_dir):
    b = base(spark, sf_dir)
    vocab = encode.fit_vocabulary(b.where(F.col("is_train") == 1), "o_orderpriority")
    return encode.label_encode(b.select(ID, "o_orderpriority"), "o_orderpriority", vocab, unseen_code=0)


# U4 / J3 report: part-supplier pairs sold in test orders that never occur in train orders.
_UNSEEN_SQL = sql_with(BASE_SQL) + """,
lt AS (SELECT l.l_partkey || '-' || l.l_suppkey AS pair, b.is_train FROM lineitem l JOIN base b ON b.o_orderkey = l.l_orderkey),
v AS (SELECT DISTINCT pair AS value FROM lt WHERE is_train = 1)
SELECT lt.pair AS value, CAST(count(*) AS BIGINT) AS n FROM lt
WHERE lt.is_train = 0 AND lt.pair NOT IN (SELECT value FROM v) GROUP BY lt.pair"""


def _part_lines(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", F.concat_ws("-", "l_partkey", "l_suppkey").alias("pair"))
    flags = base(spark, sf_dir).select(F.col(ID).alias("l_orderkey"), "is_train")
    return li.join(flags, "l_orderkey").select("pair", "is_train")


@register("unseen_categories", _UNSEEN_SQL)
def q_unseen_categories(spark, sf_dir):
    lt = _part_lines(spark, sf_dir)
    vocab = encode.fit_vocabulary(lt.where(F.col("is_train") == 1), "pair")
    return encode.unseen_values(lt.where(F.col("is_train") == 0), "pair", vocab).select(
        "value", F.col("n").cast("long"))


@register("label_encode_union", sql_with(PREPARED_SQL) + """,
v AS (SELECT value, CAST(row_number() OVER (ORDER BY value) - 1 AS INTEGER) AS code
      FROM (SELECT o_orderpriority AS value FROM prepared WHERE is_train = 1
            UNION SELECT o_orderpriority FROM prepared WHERE is_train = 0))
SELECT p.o_orderkey, p.o_orderpriority, v.code AS o_orderpriority_code FROM prepared p JOIN v ON p.o_orderpriority = v.value""")
def q_label_encode_union(spark, sf_dir):
    p = prepared(spark, sf_dir)
    train, test = p.where(F.col("is_train") == 1), p.where(F.col("is_train") == 0)
    vocab = encode.fit_vocabulary_union([train, test], "o_orderpriority")
    return encode.label_encode(p.select(ID, "o_orderpriority"), "o_orderpriority", vocab)


@register("inverse_label", """
WITH s AS (
  SELECT o_orderkey,
         ((1 + (o_orderkey * 7 + o_custkey * 3) % 10) + CASE WHEN o_orderstatus = 'F' THEN 6 ELSE 0 END) AS s0,
         ((1 + (o_orderkey * 7 + o_custkey * 4) % 10) + CASE WHEN o_orderstatus = 'O' THEN 6 ELSE 0 END) AS s1,
         ((1 + (o_orderkey * 7 + o_custkey * 5) % 10) + CASE WHEN o_orderstatus = 'P' THEN 6 ELSE 0 END) AS s2
  FROM orders),
p AS (SELECT o_orderkey, CAST(CASE WHEN s0 >= s1 AND s0 >= s2 THEN 0 WHEN s1 >= s2 THEN 1 ELSE 2 END AS INTEGER) AS pred_code FROM s),
v AS (SELECT o_orderstatus AS value, CAST(row_number() OVER (ORDER BY o_orderstatus) - 1 AS INTEGER) AS code
      FROM (SELECT DISTINCT o_orderstatus FROM orders))
SELECT p.o_orderkey, p.pred_code, v.value AS pred_label FROM p LEFT JOIN v ON p.pred_code = v.code""")
def q_inverse_label(spark, sf_dir):
    from tabrisk.functions.columns import argmax_first
    s = scores_wide(spark, sf_dir).select(ID, argmax_first("p_m1").alias("pred_code"))
    vocab = encode.fit_vocabulary(table(spark, sf_dir, "orders"), LABEL)
    return encode.inverse_label(s, "pred_code", vocab, "pred_label").select(ID, "pred_code", "pred_label")


@register("class_map_json", """
WITH v AS (SELECT o_orderstatus AS value, CAST(row_number() OVER (ORDER BY o_orderstatus) - 1 AS INTEGER) AS code
           FROM (SELECT DISTINCT o_orderstatus FROM orders))
SELECT '{' || string_agg('"' || value || '":' || CAST(code AS VARCHAR), ',' ORDER BY value) || '}' AS class_map FROM v""")
def q_class_map_json(spark, sf_dir):
    vocab = encode.fit_vocabulary(table(spark, sf_dir, "orders"), LABEL)
    return encode.class_map_json(vocab)


# Dictionary lookup with default, as a map literal and as a broadcast join.
_PRIORITY_ORD = {"1-urgent": 5, "2-high": 4, "3-medium": 3, "4-not specified": 2}


@register("feat_ordinal_map", sql_with(PREPARED_SQL) + """
SELECT o_orderkey, o_orderpriority,
       CAST(CASE o_orderpriority WHEN '1-urgent' THEN 5 WHEN '2-high' THEN 4 WHEN '3-medium' THEN 3
            WHEN '4-not specified' THEN 2 ELSE 1 END AS INTEGER) AS priority_ord
FROM prepared""")
def q_feat_ordinal_map(spark, sf_dir):
    from tabrisk.functions.columns import ordinal_map
    p = prepared(spark, sf_dir)
    return p.select(ID, "o_orderpriority", ordinal_map("o_orderpriority", _PRIORITY_ORD, 1).cast("int")
                    .alias("priority_ord"))


@register("dict_join_default", """
SELECT c.c_custkey, c.c_nationkey, coalesce(n.n_name, 'unknown') AS nation_name
FROM customer c LEFT JOIN (SELECT n_nationkey, n_name FROM nation WHERE n_regionkey <> 4) n
ON c.c_nationkey = n.n_nationkey""")
def q_dict_join_default(spark, sf_dir):
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    dim = (table(spark, sf_dir, "nation").where(F.col("n_regionkey") != 4)
           .select(F.col("n_nationkey").alias("c_nationkey"), "n_name"))
    j = join_small(cust, dim, ["c_nationkey"], how="left")
    return j.select("c_custkey", "c_nationkey", F.coalesce("n_name", F.lit("unknown")).alias("nation_name"))


_SCALE = ["o_totalprice", "c_acctbal", "n_lines", "sum_qty", "avg_price"]


@register("standard_scale", sql_with(PREPARED_SQL) + f""",
m AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in _SCALE)} FROM prepared WHERE is_train = 1)
SELECT p.o_orderkey, p.is_train, {', '.join(rs(f'(p.{c} - m.m_{c}) / (CASE WHEN m.s_{c} = 0 THEN 1.0 ELSE m.s_{c} END)') + f' AS {c}' for c in _SCALE)}
FROM prepared p, m""")
def q_standard_scale(spark, sf_dir):
    p = prepared(spark, sf_dir)
    sc = encode.fit_scaler(p.where(F.col("is_train") == 1), _SCALE)
    return sc.apply(p, _SCALE).select(ID, "is_train", *[r(c).alias(c) for c in _SCALE])


@register("stage_handoff", sql_with(PREPARED_SQL) + """
SELECT o_orderkey, CASE WHEN is_train = 1 THEN 'train' ELSE 'test' END AS split, feature_idx, """ + rs("value") + """ AS value
FROM (""" + "\nUNION ALL\n".join(
    f"SELECT o_orderkey, is_train, {i} AS feature_idx, {c} AS value FROM prepared" for i, c in enumerate(NUM)) + ")")
def q_stage_handoff(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array
    p = prepared(spark, sf_dir)
    vec = encode.assemble(p, NUM).select(
        ID, F.when(F.col("is_train") == 1, "train").otherwise("test").alias("split"), "features")
    path = scratch_path(spark, "stage_handoff")
    vec.write.mode("overwrite").partitionBy("split").parquet(path)
    back = spark.read.parquet(path)
    return back.select(ID, "split", F.posexplode(vector_to_array("features")).alias("feature_idx", "value")).select(
        ID, "split", F.col("feature_idx").cast("int"), r("value").alias("value"))
