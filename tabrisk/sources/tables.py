"""Binding of the driver tables to the risk-table layout.

``base`` is the labelled/unlabelled fact table every operator is exercised on:
``orders ⋈ customer ⟕ per-order lineitem aggregates``. Orders without line items
give real NULLs in the aggregate columns. ``scores`` derives three pseudo-model
class-probability vectors from order columns so that metric and blend operators
have SQL-checkable inputs that grow with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabrisk.spec import TableSpec

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

BASE_SPEC = TableSpec(
    id="o_orderkey",
    label="o_orderstatus",
    numeric=("o_totalprice", "c_acctbal", "n_lines", "sum_qty", "avg_price", "avg_disc", "avg_tax"),
    categorical=("o_orderpriority", "c_mktsegment"),
)

# Class codes of the label, alphabetical (LabelEncoder order).
CLASSES = ("F", "O", "P")
MODELS = ("m1", "m2", "m3")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def line_aggregates(lineitem: DataFrame) -> DataFrame:
    """Per-order numeric aggregates (partial aggregation before the shuffle)."""
    return lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).cast("double").alias("n_lines"),
        F.sum("l_quantity").alias("sum_qty"),
        F.avg("l_extendedprice").alias("avg_price"),
        F.avg("l_discount").alias("avg_disc"),
        F.avg("l_tax").alias("avg_tax"),
    )


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    li = line_aggregates(table(spark, sf_dir, "lineitem"))
    key = F.col("o_orderkey")
    return (orders.join(customer, orders.o_custkey == customer.c_custkey, "inner")
            .join(li, key == li.l_orderkey, "left")
            .select(
                key,
                "o_orderstatus",
                # Categorical NULLs do not occur in the driver tables; inject a fixed pattern.
                F.when(key % 11 != 0, F.col("o_orderpriority")).alias("o_orderpriority"),
                "c_mktsegment",
                "o_totalprice", "c_acctbal", "n_lines", "sum_qty", "avg_price", "avg_disc", "avg_tax",
                (key % 10 < 7).cast("int").alias("is_train"),
            ))


BASE_SQL = """
li AS (
  SELECT l_orderkey, CAST(count(*) AS DOUBLE) AS n_lines, sum(l_quantity) AS sum_qty,
         avg(l_extendedprice) AS avg_price, avg(l_discount) AS avg_disc, avg(l_tax) AS avg_tax
  FROM lineitem GROUP BY l_orderkey),
base AS (
  SELECT o.o_orderkey, o.o_orderstatus,
         CASE WHEN o.o_orderkey % 11 <> 0 THEN o.o_orderpriority END AS o_orderpriority,
         c.c_mktsegment, o.o_totalprice, c.c_acctbal,
         li.n_lines, li.sum_qty, li.avg_price, li.avg_disc, li.avg_tax,
         CAST(CASE WHEN o.o_orderkey % 10 < 7 THEN 1 ELSE 0 END AS INTEGER) AS is_train
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN li ON li.l_orderkey = o.o_orderkey)"""


def _label_code(c: str) -> "F.Column":
    expr = None
    for i, v in enumerate(CLASSES):
        expr = F.when(F.col(c) == v, F.lit(i)) if expr is None else expr.when(F.col(c) == v, F.lit(i))
    return expr


def scores_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(o_orderkey, o_custkey, label, p_m1, p_m2, p_m3)`` with array<double> class probabilities.

    Raw score of model m (0-based mi) for class c:
    ``1 + (id*(7+2*mi) + custkey*(c+3)) % 10 + (6-2*mi if c is the true class)``,
    normalised by the sum over classes. All integers, so both engines agree bit for bit.
    """
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    o = o.withColumn("label", _label_code("o_orderstatus"))
    cols = []
    for mi, m in enumerate(MODELS):
        raw = [(F.lit(1) + (F.col("o_orderkey") * (7 + 2 * mi) + F.col("o_custkey") * (c + 3)) % 10
                + F.when(F.col("label") == c, F.lit(6 - 2 * mi)).otherwise(F.lit(0))).cast("double")
               for c in range(len(CLASSES))]
        total = (raw[0] + raw[1]) + raw[2]
        cols.append(F.array(*[r / total for r in raw]).alias(f"p_{m}"))
    return o.select("o_orderkey", "o_custkey", "label", *cols)


def scores_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(o_orderkey, label, model, class, prob)`` — the long prediction table."""
    w = scores_wide(spark, sf_dir)
    entries = [F.struct(F.lit(m).alias("model"), F.lit(c).alias("class"),
                        F.col(f"p_{m}")[c].alias("prob"))
               for m in MODELS for c in range(len(CLASSES))]
    return w.select("o_orderkey", "label", F.inline(F.array(*entries)))


SCORES_SQL = """
sc_raw AS (
  SELECT o.o_orderkey, o.o_custkey,
         CASE o.o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 WHEN 'P' THEN 2 END AS label,
         m.mi, m.model, k.class,
         CAST(1 + (o.o_orderkey * (7 + 2 * m.mi) + o.o_custkey * (k.class + 3)) % 10
              + CASE WHEN k.class = (CASE o.o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 WHEN 'P' THEN 2 END)
                     THEN 6 - 2 * m.mi ELSE 0 END AS DOUBLE) AS s
  FROM orders o
  CROSS JOIN (VALUES (0, 'm1'), (1, 'm2'), (2, 'm3')) m(mi, model)
  CROSS JOIN (VALUES (0), (1), (2)) k(class)),
scores AS (
  SELECT o_orderkey, label, model, CAST(class AS INTEGER) AS class,
         s / sum(s) OVER (PARTITION BY o_orderkey, model) AS prob
  FROM sc_raw)"""


def fold_scores_long(spark: SparkSession, sf_dir: str, n_folds: int = 5) -> DataFrame:
    """``(o_orderkey, label, fold, model, class, prob)``: a per-fold prediction cube.

    Fold f perturbs the raw score of class c by ``(id + f*(c+1)) % 3`` before normalising.
    """
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    o = o.withColumn("label", _label_code("o_orderstatus"))
    entries = []
    for mi, m in enumerate(MODELS):
        base_raw = [(F.lit(1) + (F.col("o_orderkey") * (7 + 2 * mi) + F.col("o_custkey") * (c + 3)) % 10
                     + F.when(F.col("label") == c, F.lit(6 - 2 * mi)).otherwise(F.lit(0)))
                    for c in range(len(CLASSES))]
        for f in range(n_folds):
            raw = [(b + (F.col("o_orderkey") + f * (c + 1)) % 3).cast("double") for c, b in enumerate(base_raw)]
            total = (raw[0] + raw[1]) + raw[2]
            for c in range(len(CLASSES)):
                entries.append(F.struct(F.lit(f).alias("fold"), F.lit(m).alias("model"),
                                        F.lit(c).alias("class"), (raw[c] / total).alias("prob")))
    return o.select("o_orderkey", "label", F.inline(F.array(*entries)))


FOLD_SCORES_SQL = """
fs_raw AS (
  SELECT o.o_orderkey, m.model, k.class, f.fold,
         CAST(1 + (o.o_orderkey * (7 + 2 * m.mi) + o.o_custkey * (k.class + 3)) % 10
              + CASE WHEN k.class = (CASE o.o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 WHEN 'P' THEN 2 END)
                     THEN 6 - 2 * m.mi ELSE 0 END
              + (o.o_orderkey + f.fold * (k.class + 1)) % 3 AS DOUBLE) AS s
  FROM orders o
  CROSS JOIN (VALUES (0, 'm1'), (1, 'm2'), (2, 'm3')) m(mi, model)
  CROSS JOIN (VALUES (0), (1), (2)) k(class)
  CROSS JOIN (VALUES (0), (1), (2), (3), (4)) f(fold)),
fold_scores AS (
  SELECT o_orderkey, model, CAST(class AS INTEGER) AS class, fold,
         s / sum(s) OVER (PARTITION BY o_orderkey, model, fold) AS prob
  FROM fs_raw)"""
