"""Plan checks: no Python evaluation in the hot path, pushdown, bounded single-task windows."""

import pytest

from tests.conftest import SF_SMALL
from tabrisk.plans.registry import ORACLE, QUERIES, load_all

load_all()

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_no_python_nodes(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert not any(n in plan for n in PY_NODES), name


def test_scan_prunes_columns_and_pushes_filters(spark):
    from pyspark.sql import functions as F
    from tabrisk.sources.tables import table
    df = table(spark, SF_SMALL, "orders").where(F.col("o_orderkey") > 10).select("o_orderkey")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderkey), GreaterThan(o_orderkey,10)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan


def test_stratified_position_window_is_not_per_class(spark):
    """The position window is partitioned by (partition id, class), never by the class alone."""
    from tabrisk.operators.split import stratified_kfold
    from tabrisk.sources.tables import table
    o = table(spark, SF_SMALL, "orders").select("o_orderkey", "o_orderstatus")
    plan = _plan(stratified_kfold(o, "o_orderstatus", "o_orderkey"))
    assert "_pid" in plan


def test_wide_feature_set_repeats_no_cleaning_and_is_compiled(spark):
    from __spark_entry__ import queries
    from tabrisk.session import compiled_methods
    limit = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(limit)
    try:
        spark.conf.set(limit, "65535")
        plan = queries()["preset_ultimate"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert spark.conf.get(limit) == "8000"
        assert "regexp_replace" not in plan and "round(" not in plan
        spark.conf.set(limit, "4000")
        compiled_methods(spark)
        assert spark.conf.get(limit) == "4000"
    finally:
        spark.conf.set(limit, before)


def test_health_rows_round_the_price_once(spark):
    from tabrisk.sources.health import health
    plan = health(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("round(") == 1
