"""One saved bundle: preprocessing, vocabularies, boosted trees, class map, feature order and metadata.

Saved as Parquet tables and one line of JSON, which is written last: a folder without it isn't a bundle. The line
holds fingerprints of the tables; loading checks them. The loaded bundle scores batches and streams by the same plan.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

import numpy as np
import pyspark
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabrisk.operators import metrics, split, tree_models
from tabrisk.operators.score import FittedPrep, fit_prep, label_predictions, table_fingerprint
from tabrisk.operators.tree_models import TREE_ROWS, BoostedModel, Fit
from tabrisk.operators.trees import Boosting


def _fingerprints(prep: FittedPrep, model: BoostedModel) -> dict:
    tables = {"trees": model.trees, **{f"vocab_{c}": prep.vocab[c] for c in prep.categorical}}
    return {name: list(table_fingerprint(t).first()) for name, t in tables.items()}


@dataclass(frozen=True)
class Bundle:
    prep: FittedPrep
    model: BoostedModel
    classes: tuple
    metadata: dict

    @property
    def class_map(self) -> dict:
        return {c: i for i, c in enumerate(self.classes)}

    def score(self, df: DataFrame) -> DataFrame:
        """``df`` prepared, with proba, pred_code, pred_label and class_probs; statistics come from the bundle only,
        so that a row's result doesn't depend on the rows beside it, and a stream can be scored."""
        features = F.array(*[F.col(c).cast("double") for c in self.prep.feature_names])
        return label_predictions(self.prep.apply(df).withColumn("proba", self.model.proba(features)), self.classes)

    def save(self, spark: SparkSession, path: str) -> None:
        """Write into ``path``, a folder that doesn't hold a bundle yet."""
        self.prep.save(spark, f"{path}/prep")
        self.model.trees.write.parquet(f"{path}/trees")
        spark.createDataFrame([(i, e.tolist()) for i, e in enumerate(self.model.edges)],
                              "feature int, cuts array<double>").write.parquet(f"{path}/cuts")
        line = {"classes": list(self.classes), "class_map": self.class_map, "feature_names": list(self.prep.feature_names),
                "start": self.model.start, "metadata": self.metadata, "fingerprints": _fingerprints(self.prep, self.model)}
        spark.createDataFrame([(json.dumps(line),)], "value string").coalesce(1).write.text(f"{path}/bundle")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Bundle:
        """The bundle at ``path``; raises ValueError if a table isn't the one that was saved."""
        line = json.loads(spark.read.text(f"{path}/bundle").first()["value"])
        prep = FittedPrep.load(spark, f"{path}/prep")
        cuts = spark.read.schema("feature int, cuts array<double>").parquet(f"{path}/cuts").orderBy("feature").collect()  # a row a feature
        model = BoostedModel(np.array([r["cuts"] for r in cuts], float), line["start"],
                             spark.read.schema(TREE_ROWS).parquet(f"{path}/trees"))
        changed = {k for k, v in _fingerprints(prep, model).items() if v != line["fingerprints"].get(k)}
        if changed or list(prep.feature_names) != line["feature_names"]:
            raise ValueError(f"{path}: not as saved: {sorted(changed) or 'feature order'}")
        return cls(prep, model, tuple(line["classes"]), line["metadata"])


def fit_bundle(df: DataFrame, id_col: str, label: str, classes: Sequence[str], numeric: Sequence[str],
               categorical: Sequence[str], setting: Boosting, name: str, valid_share: int = 20) -> Bundle:
    """Fit preprocessing on all labelled rows ``df`` and the trees on all but a stratified hold-out of ``valid_share``
    percent, on which the metadata's metrics are measured."""
    spark, k = df.sparkSession, len(classes)
    prep = fit_prep(df, numeric, categorical)
    code = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(label)) - 1
    held = split.stratified_holdout(df.select(id_col, label), label, id_col, valid_share / 100.0).select(
        id_col, (F.col("split") == "train").cast("int").alias("is_train"))
    features = F.array(*[F.col(c).cast("double") for c in prep.feature_names])
    rows = split.balanced_weights(df, label).join(held, id_col)
    rows = prep.apply(rows).select(id_col, code.alias("label"), "weight", F.lit(None).cast("int").alias("fold"), "is_train",
                                   features.alias("features"))
    rows = rows.checkpoint(eager=True)
    edges = tree_models.cut_points(rows.where("is_train = 1").select(F.col("features").alias("x")))
    table, start = tree_models.fit_boosting(tree_models.binned(rows, id_col, edges), Fit(name, setting), k, edges)
    model = BoostedModel(edges, start, table)
    valid = label_predictions(rows.where("is_train = 0").withColumn("proba", model.proba(F.col("features"))), classes)
    conf = metrics.confusion(valid, "label", "pred_code", classes=range(k)).persist()
    scores = metrics.summary(conf.where("n > 0")).first().asDict()
    cells = {(r["label"], r["pred"]): r["n"] for r in conf.collect()}  # classes x classes
    conf.unpersist()
    metadata = {
        "model_name": name, "model_type": "histogram boosting", "rounds": setting.rounds,
        "valid": {m: round(float(scores[m]), 4) for m in ("accuracy", "f1_w", "f1_macro")},
        "confusion": [[int(cells.get((a, b), 0)) for b in range(k)] for a in range(k)],
        "trained_at": datetime.now(timezone.utc).isoformat(), "versions": {"spark": pyspark.__version__, "numpy": np.__version__},
    }
    return Bundle(prep, model, tuple(classes), metadata)
