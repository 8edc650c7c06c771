"""Deterministic sampling, stratified hold-out / sub-sample / K-fold, class weights.

Randomness is a keyed hash ``md5('<id>-<seed>')``: the same row always lands in the
same split, on any cluster size, in any engine that has md5. Strata sizes are exact:
each row's position inside its class (in hash order) comes from ``exact_row_number``,
which never routes a whole class through one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabrisk.functions.columns import hash_key
from tabrisk.operators.joins import join_small
from tabrisk.operators.ranking import exact_row_number


def sample_exact_n(df: DataFrame, n: int, id_col: str, seed: int = 42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, seeded, without replacement: the n first by hash key."""
    return first_by_hash(df, id_col, seed, F.lit(n))


def first_by_hash(df: DataFrame, id_col: str, seed: int, quota: Column, by: str | None = None) -> DataFrame:
    """The first ``quota`` rows of every class by hash key (ties by id); ``quota`` may use ``_class_n``, the class's rows.

    One pass counts rows by class and the first four digits of the key: at most 65,536 rows a
    class, in which the digits of the last row that is wanted are found. Rows with lower digits are taken by a filter; only rows
    that share these digits, about one in 65,536, are put in order. All rows without an id have one key."""
    keyed = df.withColumn("_hk", hash_key(id_col, seed)).withColumn("_k", F.col(by) if by else F.lit(0))
    keyed = keyed.withColumn("_digits", F.substring("_hk", 1, 4))
    counts = keyed.groupBy("_k", "_digits").agg(F.count(F.lit(1)).alias("_n"))
    one = Window.partitionBy("_k")
    upto = counts.select("_k", "_digits", "_n", F.sum("_n").over(one.orderBy("_digits")).alias("_upto"), F.sum("_n").over(one).alias("_class_n"))
    wanted = upto.withColumn("_want", F.least(quota.cast("long"), F.col("_class_n")))
    last = (wanted.where((F.col("_upto") >= F.col("_want")) & (F.col("_upto") - F.col("_n") < F.col("_want")))
            .select("_k", F.col("_digits").alias("_last"), (F.col("_want") - F.col("_upto") + F.col("_n")).alias("_need")))
    marked = join_small(keyed, last, ["_k"], how="inner", null_safe=True)
    edge = exact_row_number(marked.where(F.col("_digits") == F.col("_last")), ["_hk", id_col], by=["_k"], name="_pos").where(F.col("_pos") <= F.col("_need"))
    return marked.where(F.col("_digits") < F.col("_last")).select(*df.columns).unionByName(edge.select(*df.columns))


def class_positions(df: DataFrame, label: str, id_col: str, seed: int = 42,
                    pos: str = "_pos", total: str = "_class_n") -> DataFrame:
    """Add the 1-based position of each row inside its class (hash order) and the class size."""
    keyed = df.withColumn("_hk", hash_key(id_col, seed))
    out = exact_row_number(keyed, ["_hk", id_col], by=[label], name=pos, total=total)
    return out.drop("_hk")


def _take(frac: Column | float, n_col: str) -> Column:
    """Per-class quota ``floor(frac * n_c + 0.5)`` in double arithmetic."""
    f = frac if isinstance(frac, Column) else F.lit(float(frac))
    return F.floor(f * F.col(n_col).cast("double") + F.lit(0.5))


def stratified_holdout(df: DataFrame, label: str, id_col: str, test_frac: float = 0.2,
                       seed: int = 42, split_col: str = "split") -> DataFrame:
    """Mark ``round(test_frac · n_c)`` rows of each class 'valid', the rest 'train'."""
    pos = class_positions(df, label, id_col, seed)
    return (pos.withColumn(split_col, F.when(F.col("_pos") <= _take(test_frac, "_class_n"), F.lit("valid"))
                           .otherwise(F.lit("train")))
            .drop("_pos", "_class_n"))


def stratified_sample_n(df: DataFrame, label: str, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """Stratified fixed-size sub-sample: fraction ``min(n, rows)/rows`` of every class."""
    total = df.count()
    frac = min(n, total) / total if total else 0.0
    return first_by_hash(df, id_col, seed, _take(frac, "_class_n"), by=label)


def stratified_kfold(df: DataFrame, label: str, id_col: str, k: int = 5, seed: int = 42,
                     fold_col: str = "fold") -> DataFrame:
    """Fold 0..k-1 by position inside the class: fold sizes differ by at most one per class."""
    pos = class_positions(df, label, id_col, seed)
    return pos.withColumn(fold_col, F.pmod(F.col("_pos") - 1, F.lit(k)).cast("int")).drop("_pos", "_class_n")


def balanced_weights(df: DataFrame, label: str, weight_col: str = "weight") -> DataFrame:
    """``compute_sample_weight('balanced')``: n / (k · n_c), joined from a class-count table."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n_c"))
    stats = counts.agg(F.sum("_n_c").alias("n"), F.count(F.lit(1)).alias("k")).first()
    w = counts.select(label, (F.lit(float(stats["n"])) / (F.lit(float(stats["k"])) * F.col("_n_c"))).alias(weight_col))
    return join_small(df, w, [label], how="left", null_safe=True)


def split_distribution(df: DataFrame, split_col: str, label: str) -> DataFrame:
    """Class counts and percentages inside each split."""
    c = df.groupBy(split_col, label).agg(F.count(F.lit(1)).alias("n"))
    tot = c.groupBy(split_col).agg(F.sum("n").alias("_t"))
    return join_small(c, tot, [split_col], how="inner").select(
        split_col, label, "n", (F.col("n") * 100.0 / F.col("_t")).alias("pct"))
