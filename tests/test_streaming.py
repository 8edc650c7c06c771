"""The fitted scorer runs unchanged on a Parquet file stream."""

import os

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL


def test_stream_scoring(spark, tmpdir_fresh):
    from tabrisk.plans.common import LABEL
    from tabrisk.plans.scoring import fitted_scorer, score_frame
    from tabrisk.sources.tables import CLASSES, base
    from tabrisk.streaming.scorer import start_scoring

    prep, model = fitted_scorer(spark, SF_SMALL)
    test = base(spark, SF_SMALL).where(F.col("is_train") == 0).drop(LABEL)
    src = os.path.join(tmpdir_fresh, "incoming")
    test.repartition(3).write.parquet(src)
    q = start_scoring(spark, src, test.schema, prep, model, CLASSES, "o_orderkey",
                      os.path.join(tmpdir_fresh, "scored"), os.path.join(tmpdir_fresh, "ckpt"))
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    streamed = spark.read.parquet(os.path.join(tmpdir_fresh, "scored"))
    batch = score_frame(test, prep, model)
    assert streamed.count() == test.count()
    diff = streamed.select("o_orderkey", "pred_code").exceptAll(batch.select("o_orderkey", "pred_code"))
    assert diff.count() == 0
