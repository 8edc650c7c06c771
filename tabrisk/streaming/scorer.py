"""Structured Streaming scorer.

The batch scorer is a stateless projection over fitted literals (``FittedPrep``) plus
a fitted Spark ML model, so the identical plan runs on a streaming DataFrame: new
Parquet files landing in ``source_dir`` are scored and appended to ``sink_dir``,
with progress tracked in ``checkpoint_dir`` (exactly-once file sink, restartable).
Global statistics are never computed on the stream — they come from the fitted side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tabrisk.operators import encode, score
from tabrisk.operators.bundle import Bundle


def score_stream_frame(stream: DataFrame, prep: score.FittedPrep, model, classes: Sequence[str],
                       id_col: str) -> DataFrame:
    feats = encode.assemble(prep.apply(stream), prep.feature_names)
    proba = score.predict_proba(feats, score.ScoreBundle(prep.feature_names, tuple(classes), model=model))
    out = score.label_predictions(proba, classes)
    return out.select(id_col, "pred_code", "pred_label", "proba")


def start_scoring(spark: SparkSession, source_dir: str, schema: T.StructType, prep: score.FittedPrep, model,
                  classes: Sequence[str], id_col: str, sink_dir: str, checkpoint_dir: str,
                  max_files_per_trigger: int = 100) -> StreamingQuery:
    """Start a file-stream → score → Parquet sink query (call ``processAllAvailable`` / ``stop``)."""
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
              .parquet(source_dir))
    scored = score_stream_frame(stream, prep, model, classes, id_col)
    return (scored.writeStream.format("parquet").option("path", sink_dir)
            .option("checkpointLocation", checkpoint_dir).outputMode("append").start())


def start_bundle_scoring(spark: SparkSession, source_dir: str, schema: T.StructType, bundle_path: str, id_col: str,
                         sink_dir: str, checkpoint_dir: str, max_files_per_trigger: int = 100) -> StreamingQuery:
    """Score files that land in ``source_dir`` by the saved bundle, as a batch does (``Bundle.score``)."""
    bundle = Bundle.load(spark, bundle_path)
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
              .parquet(source_dir))
    scored = bundle.score(stream).select(id_col, "pred_code", "pred_label", "proba")
    return (scored.writeStream.format("parquet").option("path", sink_dir)
            .option("checkpointLocation", checkpoint_dir).outputMode("append").start())
