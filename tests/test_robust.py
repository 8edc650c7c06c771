"""Awkward input: NaN, zero divisors, quoted CSV, hot values, large vocabularies, cluster masters."""

import math
import os

import pytest
from pyspark.sql import functions as F

from tabrisk.functions import columns as fc
from tabrisk.operators import clean, encode, models, profile
from tabrisk.operators.ranking import exact_quantiles
from tabrisk.operators.score import FittedPrep, fit_prep
from tabrisk.plans.registry import QUERIES, load_all
from tabrisk.sources import files
from tabrisk.sources.tables import table
from tests.conftest import SF_SMALL

load_all()

NAN = float("nan")


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(NAN, "a"), (31.0, "a"), (20.0, "b"), (None, "b")], "bmi double, g string")
    got = df.select(fc.threshold_flag("bmi", ">=", 30.0).alias("f"), fc.interval_flag("bmi", 18.5, None).alias("i"),
                    fc.bin_right_closed("bmi", [18.5, 25.0]).alias("r"), fc.bin_left_closed("bmi", [18.5, 25.0]).alias("l")).collect()
    assert [tuple(x) for x in got] == [(0, 0, None, None), (1, 1, 2, 2), (0, 1, 1, 1), (0, 0, None, None)]
    d = profile.describe_numeric(df, ["bmi"]).first()
    assert (d["count"], d["mean"], d["max"], d["p50"]) == (2, 25.5, 31.0, 25.5)
    assert profile.iqr_outliers(df, ["bmi"]).first()["n_outliers"] == 0
    assert clean.missing_report(df).collect()[0]["missing"] == 2
    assert clean.expect_no_nulls(df).first()["n_null"] == 2
    assert {r["pattern"]: r["n"] for r in clean.missing_pattern(df, ["bmi", "g"]).collect()} == {"10": 2, "00": 2}
    assert clean.quality_snapshot(df, "t").first()["missing_cells"] == 2
    sc = encode.fit_scaler(df, ["bmi"])
    assert sc.mean["bmi"] == 25.5 and sc.std["bmi"] == 5.5


def test_division_never_raises(spark):
    df = spark.createDataFrame([(1.0, -1.0), (-1.0, -1.0), (0.0, -1.0), (NAN, -1.0), (None, -1.0), (4.0, 1.0)], "a double, b double")
    got = [r[0] for r in df.select(fc.guarded_ratio("a", "b", 1.0)).collect()]
    assert got[:2] == [math.inf, -math.inf] and math.isnan(got[2]) and math.isnan(got[3]) and got[4:] == [None, 2.0]


def test_csv_quotes_newlines_and_bad_cells(spark, tmpdir_fresh):
    rows = [(1, 'say "hi", ok', 1.5), (2, "two\nlines", None), (3, None, 2.0)]
    path = os.path.join(tmpdir_fresh, "csv")
    files.write_csv(spark.createDataFrame(rows, "id int, s string, x double"), path)
    assert sorted(tuple(r) for r in files.read_csv(spark, path, "id int, s string, x double").collect()) == rows
    with open(os.path.join(tmpdir_fresh, "bad.csv"), "w") as f:
        f.write("id,x\n1,NA\n2,oops\n")
    bad = files.read_csv(spark, os.path.join(tmpdir_fresh, "bad.csv"), "id int, x double")
    with pytest.raises(Exception, match="oops|CAST_INVALID"):
        bad.collect()


def test_csv_keeps_whole_texts(spark, tmpdir_fresh):
    texts = ["  lead", "trail \t", "\r", "two\r\nlines", "a\\", 'a\\"b"', '"', "é, " * 100_000 + '"tail"\n\\', None]
    rows = list(enumerate(texts))
    path = os.path.join(tmpdir_fresh, "csv")
    files.write_csv(spark.createDataFrame(rows, "id int, s string"), path)
    assert sorted(tuple(r) for r in files.read_csv(spark, path, "id int, s string").collect()) == rows


def test_csv_quoted_text_covers_every_character(spark):
    got = dict(QUERIES["csv_quoted_text"](spark, SF_SMALL).select("doc_id", "text").collect())
    want = dict(table(spark, SF_SMALL, "documents").select("doc_id", "text").collect())
    assert max(len(t) for t in want.values() if t) > 10_000
    assert got == {k: None if t in files.NA_TOKENS else t for k, t in want.items()}


def test_hot_value_is_one_row_of_the_sort(spark, monkeypatch):
    df = spark.range(20_000).select(F.when(F.col("id") % 10 > 0, 5.0).otherwise(F.col("id").cast("double")).alias("x"))
    got = {r["p"]: r["value"] for r in exact_quantiles(df, ["x"], [0.0, 0.05, 0.5, 0.999, 1.0]).collect()}
    want = df.toPandas()["x"].quantile([0.0, 0.05, 0.5, 0.999, 1.0])
    assert got == pytest.approx(want.to_dict())
    plan = df.unpivot([], ["x"], "c", "value").groupBy("c", "value").count()
    assert plan.count() == 2001  # what is range-partitioned: distinct values, not 18,000 copies


def test_large_vocabulary_is_a_table(spark, tmpdir_fresh):
    df = spark.range(12_000).select((F.col("id") * 0.5).alias("n"), F.concat(F.lit("v"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("c"))
    prep = fit_prep(df, ["n"], ["c"])
    prep.save(spark, os.path.join(tmpdir_fresh, "prep"))
    for p in (prep, FittedPrep.load(spark, os.path.join(tmpdir_fresh, "prep"))):
        out = p.apply(df.union(spark.createDataFrame([(1.0, "unseen")], "n double, c string")))
        assert out.where("c_code = cast(substring(c, 2) as int)").where("c <> 'unseen'").count() == 12_000
        assert out.where("c = 'unseen'").first()["c_code"] == 0.0


def test_depth_is_refused_not_changed():
    with pytest.raises(ValueError):
        models.decision_tree(max_depth=31)
    with pytest.raises(ValueError):
        models.random_forest(max_depth=31)


def test_empty_histogram_by_class_keeps_its_key(spark):
    out = profile.histogram_bins(spark.createDataFrame([], "x double, g string"), "x", by="g")
    assert out.columns == ["g", "bin", "bin_lo", "bin_hi", "n"] and out.count() == 0
