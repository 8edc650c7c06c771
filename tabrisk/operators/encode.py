"""Label encoding with vocabularies as DataFrames, unseen handling, inverse, scaling, assembly."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabrisk.operators.clean import nan_as_null
from tabrisk.operators.joins import join_small
from tabrisk.operators.ranking import exact_row_number


def fit_vocabulary(df: DataFrame, col: str) -> DataFrame:
    """``LabelEncoder.fit``: sorted distinct non-null values → codes 0..k-1 as ``(value, code)``.

    Distinct is a partial aggregate; codes come from ``exact_row_number`` so even a
    very large vocabulary is numbered without a single-task window.
    """
    vals = df.select(F.col(col).cast("string").alias("value")).where(F.col("value").isNotNull()).distinct()
    return exact_row_number(vals, ["value"], name="code").select(
        "value", (F.col("code") - 1).cast("int").alias("code"))


def fit_vocabularies(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column_name, value, code)``: the vocabularies of several columns from one pass over the rows."""
    long = (df.select(*[F.col(c).cast("string").alias(c) for c in cols])
            .unpivot([], list(cols), "column_name", "value").where(F.col("value").isNotNull()).distinct())
    return exact_row_number(long, ["value"], by=["column_name"], name="code").select(
        "column_name", "value", (F.col("code") - 1).cast("int").alias("code"))


def fit_vocabulary_union(frames: Sequence[DataFrame], col: str) -> DataFrame:
    """Vocabulary of train ∪ test (competition scripts)."""
    u = frames[0].select(col)
    for f in frames[1:]:
        u = u.unionByName(f.select(col))
    return fit_vocabulary(u, col)


def label_encode(df: DataFrame, col: str, vocab: DataFrame, out: str | None = None,
                 unseen_code: int | None = 0) -> DataFrame:
    """Replace ``col`` by its code; unseen values get ``unseen_code`` (class 0, like the
    reference's fallback to ``classes_[0]``); ``None`` keeps them NULL."""
    out = out or f"{col}_code"
    v = vocab.select(F.col("value").alias("__v"), F.col("code").alias(out))
    joined = join_small(df.withColumn("__v", F.col(col).cast("string")), v, ["__v"], how="left").drop("__v")
    if unseen_code is not None:
        joined = joined.withColumn(out, F.coalesce(F.col(out), F.lit(unseen_code)))
    return joined


def unseen_values(df: DataFrame, col: str, vocab: DataFrame) -> DataFrame:
    """Values of ``col`` missing from the vocabulary, with their row counts (left anti join)."""
    v = vocab.select(F.col("value").alias("__v"))
    vals = df.select(F.col(col).cast("string").alias("__v")).where(F.col("__v").isNotNull())
    return (vals.join(v, ["__v"], "left_anti").groupBy("__v").agg(F.count(F.lit(1)).alias("n"))
            .withColumnRenamed("__v", "value"))


def inverse_label(df: DataFrame, code_col: str, vocab: DataFrame, out: str) -> DataFrame:
    """``inverse_transform``: code → value through the vocabulary table."""
    v = vocab.select(F.col("code").alias("__c"), F.col("value").alias(out))
    return join_small(df.withColumn("__c", F.col(code_col)), v, ["__c"], how="left").drop("__c")


def class_map_json(vocab: DataFrame) -> DataFrame:
    """One row with the class → code mapping as JSON text (the vocabulary is small)."""
    return vocab.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("value", "code")))))
                     .alias("class_map"))


@dataclass(frozen=True)
class Scaler:
    """Fitted means / population standard deviations (``StandardScaler``)."""
    mean: dict
    std: dict

    def apply(self, df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
        cols = list(cols or self.mean)
        new = {}
        for c in cols:
            s = self.std[c]
            scale = 1.0 if (s is None or s == 0.0) else s
            new[c] = (F.col(c) - F.lit(self.mean[c])) / F.lit(scale)
        return df.withColumns(new)


def fit_scaler(df: DataFrame, cols: Sequence[str]) -> Scaler:
    """Mean and **population** std of every column in one aggregate (zero variance → scale 1; NaN is skipped)."""
    df = nan_as_null(df, cols)
    row = df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols],
                 *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
    return Scaler({c: row[f"m_{c}"] for c in cols}, {c: row[f"s_{c}"] for c in cols})


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """Feature vector in the stored column order (invalid values raise)."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="error").transform(df)


def align_columns(df: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Reorder to a stored feature list, adding absent features as 0.0."""
    have = set(df.columns)
    return df.select(*keep, *[F.col(n) if n in have else F.lit(0.0).alias(n) for n in names])
