"""Classification metrics from confusion counts.

Everything is derived from one ``groupBy(by, label, pred).count()`` (partial
aggregation, at most ``groups × k²`` rows after the shuffle); per-class and summary
metrics are arithmetic on that small table. Definitions follow the usual
conventions: precision 0/0 → 0, macro over classes seen in truth or prediction,
weighted by support, balanced accuracy = mean recall over classes present in truth.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def confusion(df: DataFrame, label: str, pred: str, by: Sequence[str] = (),
              classes: Sequence[int] | None = None) -> DataFrame:
    """``(by, label, pred, n)``; with ``classes`` every cell is listed (zeros included)."""
    by = list(by)
    counts = df.groupBy(*by, F.col(label).alias("label"), F.col(pred).alias("pred")).agg(
        F.count(F.lit(1)).alias("n"))
    if classes is None:
        return counts
    cls = F.array(*[F.lit(c) for c in classes])
    groups = counts.select(*by).distinct() if by else df.sparkSession.range(1).select()
    grid = (groups.select(*by, F.explode(cls).alias("label"))
            .select(*by, "label", F.explode(cls).alias("pred")))
    return (grid.join(counts, [*by, "label", "pred"], "left")
            .select(*by, "label", "pred", F.coalesce("n", F.lit(0)).cast("long").alias("n")))


def confusion_wide(conf: DataFrame, classes: Sequence[str]) -> DataFrame:
    """A row per true class, a column ``pred_{class}`` per predicted class, zeros included; from ``confusion``'s cells."""
    names = F.array(*[F.lit(c) for c in classes])
    return conf.groupBy(F.element_at(names, F.col("label") + 1).alias("label")).agg(*[
        F.coalesce(F.sum(F.when(F.col("pred") == i, F.col("n"))), F.lit(0)).cast("long").alias(f"pred_{c}")
        for i, c in enumerate(classes)])


def per_class(conf: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(by, class, support, n_pred, tp, precision, recall, f1)`` for classes seen anywhere."""
    by = list(by)
    sup = conf.groupBy(*by, F.col("label").alias("class")).agg(F.sum("n").alias("support"),
                                                              F.sum(F.when(F.col("label") == F.col("pred"), F.col("n"))
                                                                    .otherwise(0)).alias("tp"))
    prd = conf.groupBy(*by, F.col("pred").alias("class")).agg(F.sum("n").alias("n_pred"))
    j = sup.join(prd, [*by, "class"], "full_outer").select(
        *by, "class", F.coalesce("support", F.lit(0)).alias("support"),
        F.coalesce("n_pred", F.lit(0)).alias("n_pred"), F.coalesce("tp", F.lit(0)).alias("tp"))
    j = j.where((F.col("support") > 0) | (F.col("n_pred") > 0))
    p = F.when(F.col("n_pred") > 0, F.col("tp") / F.col("n_pred")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    j = j.withColumn("precision", p).withColumn("recall", rec)
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                F.lit(2.0) * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))
                ).otherwise(F.lit(0.0))
    return j.withColumn("f1", f1)


def summary(conf: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, weighted precision / recall / F1, macro F1, balanced accuracy per group."""
    by = list(by)
    pc = per_class(conf, by)
    tot = F.sum("support")
    return pc.groupBy(*by).agg(
        (F.sum("tp") / tot).alias("accuracy"),
        (F.sum(F.col("precision") * F.col("support")) / tot).alias("precision_w"),
        (F.sum(F.col("recall") * F.col("support")) / tot).alias("recall_w"),
        (F.sum(F.col("f1") * F.col("support")) / tot).alias("f1_w"),
        F.avg("f1").alias("f1_macro"),
        F.avg(F.when(F.col("support") > 0, F.col("recall"))).alias("balanced_accuracy"))


def classification_report(conf: DataFrame, names: dict[int, str] | None = None) -> DataFrame:
    """Per-class rows plus 'accuracy', 'macro avg' and 'weighted avg' rows."""
    pc = per_class(conf)
    name = F.col("class").cast("string")
    if names:
        m = F.create_map(*[x for k, v in names.items() for x in (F.lit(k), F.lit(v))])
        name = F.coalesce(m[F.col("class")], name)
    rows = pc.select(name.alias("row_name"), "precision", "recall", "f1", F.col("support").cast("long"))
    s = summary(conf)
    n = pc.agg(F.sum("support").cast("long").alias("n"), F.avg("precision").alias("p_macro"),
               F.avg("recall").alias("r_macro"))
    srow = s.select("accuracy", "precision_w", "recall_w", "f1_w", "f1_macro").first()
    nrow = n.first()
    spark = conf.sparkSession
    extra = spark.createDataFrame([
        ("accuracy", None, None, srow["accuracy"], nrow["n"]),
        ("macro avg", nrow["p_macro"], nrow["r_macro"], srow["f1_macro"], nrow["n"]),
        ("weighted avg", srow["precision_w"], srow["recall_w"], srow["f1_w"], nrow["n"]),
    ], "row_name string, precision double, recall double, f1 double, support long")
    return rows.unionByName(extra)


def leaderboard(preds: DataFrame, model: str, label: str, pred: str, split: str | None = None,
                gap: float = 0.10, rank_metric: str = "f1_w") -> DataFrame:
    """All models' metrics in one pass; rank (stable), best flag and train/validation gap flag."""
    by = [model] + ([split] if split else [])
    s = summary(confusion(preds, label, pred, by=by), by=by)
    if split:
        tr = s.where(F.col(split) == "train").select(model, F.col("accuracy").alias("train_accuracy"))
        s = s.where(F.col(split) == "valid").drop(split).join(tr, model, "left")
        s = s.withColumn("is_overfit", ((F.col("train_accuracy") - F.col("accuracy")) > gap).cast("int"))
    w = Window.orderBy(F.desc(rank_metric), F.col(model))  # a handful of model rows
    return (s.withColumn("rank", F.row_number().over(w))
            .withColumn("is_best", (F.col(rank_metric) == F.max(rank_metric).over(Window.partitionBy())).cast("int")))


def champion(board: DataFrame, model: str, metric: str = "f1_w") -> DataFrame:
    """Arg-max row; the first model in name order wins ties."""
    return board.orderBy(F.desc(metric), F.col(model)).limit(1)
