"""Batch / streaming scoring, audit trace, submission validation and table fingerprint."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabrisk.functions.columns import argmax_first, nan_to_null
from tabrisk.session import scratch_path


def validate_submission(sub: DataFrame, template: DataFrame, id_col: str, label_col: str,
                        allowed: Sequence[str]) -> DataFrame:
    """Violations ``(kind, id, value)``: ids missing from / extra to the template (anti joins
    both ways) and labels outside the allowed set. An empty result means conformant."""
    tmpl = template.select(id_col)
    missing = tmpl.join(sub.select(id_col), id_col, "left_anti").select(
        F.lit("missing").alias("kind"), id_col, F.lit(None).cast("string").alias("value"))
    extra = sub.join(tmpl, id_col, "left_anti").select(F.lit("extra").alias("kind"), id_col,
                                                        F.col(label_col).alias("value"))
    bad = sub.where(~F.col(label_col).isin(list(allowed)) | F.col(label_col).isNull()).select(
        F.lit("bad_label").alias("kind"), id_col, F.col(label_col).alias("value"))
    return missing.unionByName(extra).unionByName(bad)


def table_fingerprint(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Order-independent fingerprint: row count and the sum of a 32-bit slice of each row's md5.

    Two runs producing the same multiset of rows give the same fingerprint on any
    partitioning (sum is commutative); a single changed value changes it.
    """
    cols = list(cols or df.columns)
    # '|'-joined text of the values (NULL as \N): the same bytes in any SQL engine
    row_text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in cols])
    h = F.conv(F.substring(F.md5(row_text), 1, 8), 16, 10).cast("long")
    return df.agg(F.count(F.lit(1)).cast("long").alias("n_rows"), F.sum(h).cast("long").alias("checksum"))


@dataclass(frozen=True)
class ScoreBundle:
    """Everything the scorer needs, all literals or a fitted Spark ML model.

    ``prepare`` maps a raw frame to the model's input columns (normalise, impute,
    engineer, encode, scale) using only fitted literals, so the same plan runs on a
    streaming DataFrame; ``models`` are binary members (one per class) or a single
    multiclass model with a probability column.
    """
    feature_names: tuple[str, ...]
    classes: tuple[str, ...]
    members: tuple = ()
    model: object = None


def predict_proba(df: DataFrame, bundle: ScoreBundle, features: str = "features") -> DataFrame:
    """Class probabilities as ``array<double>`` without any Python evaluation node.

    A multiclass model exposes ``probability``; one-vs-rest members each give a binary
    probability, normalised as ``p_c / Σ p`` (``OneVsRestModel`` itself has no
    probability column and does not run on streams).
    """
    from pyspark.ml.functions import vector_to_array

    if bundle.model is not None:
        out = bundle.model.transform(df)
        return out.withColumn("proba", vector_to_array("probability")).drop(
            "rawPrediction", "probability", "prediction")
    cur = df
    for i, m in enumerate(bundle.members):
        m = m.copy()
        m.setRawPredictionCol(f"__raw{i}").setProbabilityCol(f"__prob{i}").setPredictionCol(f"__pred{i}")
        cur = m.transform(cur).withColumn(f"__p{i}", vector_to_array(f"__prob{i}")[1]).drop(
            f"__raw{i}", f"__prob{i}", f"__pred{i}")
    total = None
    for i in range(len(bundle.members)):
        total = F.col(f"__p{i}") if total is None else total + F.col(f"__p{i}")
    probs = F.array(*[F.col(f"__p{i}") / total for i in range(len(bundle.members))])
    return cur.withColumn("proba", probs).drop(*[f"__p{i}" for i in range(len(bundle.members))])


def label_predictions(df: DataFrame, classes: Sequence[str], proba: str = "proba") -> DataFrame:
    """Arg-max class code, its label, and a ``{class: prob}`` map."""
    names = F.array(*[F.lit(c) for c in classes])
    return (df.withColumn("pred_code", argmax_first(proba))
            .withColumn("pred_label", F.element_at(names, F.col("pred_code") + 1))
            .withColumn("class_probs", F.map_from_arrays(names, F.col(proba))))


def trace_json(df: DataFrame, id_col: str, groups: dict[str, Sequence[str]]) -> DataFrame:
    """Per-row audit record: named groups of columns (raw, engineered, scaled, …) as JSON."""
    st = F.struct(*[F.struct(*[F.col(c) for c in cols]).alias(g) for g, cols in groups.items()])
    return df.select(id_col, F.to_json(st).alias("trace"))


@dataclass(frozen=True)
class FittedPrep:
    """Fitted preprocessing: the same projection and table joins serve batch and stream.

    mode fill → lower/strip → median fill → label codes (unseen → 0) → standard scale. A
    vocabulary is a written ``(value, code)`` table of any size; it is joined, and Spark broadcasts
    it only if its files are small.
    """
    numeric: tuple
    categorical: tuple
    medians: dict
    modes: dict
    vocab: dict
    mean: dict
    std: dict

    @property
    def feature_names(self) -> tuple:
        return tuple(f"{c}_scaled" for c in self.numeric) + tuple(f"{c}_code" for c in self.categorical)

    def apply(self, df: DataFrame) -> DataFrame:
        from tabrisk.functions.columns import nan_to_null, strip_ws
        out = df.withColumns({c: F.lower(strip_ws(F.coalesce(F.col(c), F.lit(self.modes[c])))) for c in self.categorical})
        out = out.withColumns({c: F.coalesce(nan_to_null(F.col(c).cast("double")), F.lit(float(self.medians[c])))
                               for c in self.numeric})
        for c in self.categorical:
            codes = self.vocab[c].select(F.col("value").alias(f"__{c}"), F.col("code").alias(f"__{c}_code"))
            out = out.join(codes, out[c] == codes[f"__{c}"], "left").drop(f"__{c}")
            out = out.withColumn(f"{c}_code", F.coalesce(F.col(f"__{c}_code"), F.lit(0)).cast("double")).drop(f"__{c}_code")
        return out.withColumns({f"{c}_scaled": (F.col(c) - F.lit(self.mean[c])) / F.lit(self.std[c] or 1.0) for c in self.numeric})

    def save(self, spark: SparkSession, path: str) -> None:
        """Literals as one JSON line, every vocabulary as a Parquet table."""
        meta = {k: getattr(self, k) for k in ("numeric", "categorical", "medians", "modes", "mean", "std")}
        spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/literals")
        for c in self.categorical:
            self.vocab[c].write.mode("overwrite").parquet(f"{path}/vocab/{c}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FittedPrep:
        meta = json.loads(spark.read.text(f"{path}/literals").first()["value"])
        missing = {"numeric", "categorical", "medians", "modes", "mean", "std"} - meta.keys()
        if missing:
            raise ValueError(f"{path} lacks {sorted(missing)}")
        vocab = {c: spark.read.schema("value string, code int").parquet(f"{path}/vocab/{c}") for c in meta["categorical"]}
        return cls(tuple(meta["numeric"]), tuple(meta["categorical"]), meta["medians"], meta["modes"], vocab, meta["mean"], meta["std"])


def fit_prep(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> FittedPrep:
    from tabrisk.operators.clean import fit_imputer, normalize_notebook
    from tabrisk.operators.encode import fit_scaler, fit_vocabulary
    imp = fit_imputer(train, numeric, categorical)
    t = normalize_notebook(train, categorical, imp.modes)
    t = t.withColumns({c: F.coalesce(nan_to_null(F.col(c).cast("double")), F.lit(float(imp.medians[c]))) for c in numeric})
    spark, vocab = train.sparkSession, {}
    for c in categorical:
        path = scratch_path(spark, f"vocab_{c}")
        fit_vocabulary(t, c).write.parquet(path)
        vocab[c] = spark.read.schema("value string, code int").parquet(path)
    sc = fit_scaler(t, numeric)
    return FittedPrep(tuple(numeric), tuple(categorical), imp.medians, imp.modes, vocab, sc.mean, sc.std)
