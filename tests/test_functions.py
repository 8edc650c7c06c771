"""Boundary rows from FIXTURES.md §3 on small literal frames."""

import math

import pytest
from pyspark.sql import functions as F

from tabrisk.functions import columns as fc
from tabrisk.operators import features as feat


def one_col(spark, values, name="x", typ="double"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {typ}")


def test_bin_right_closed(spark):
    df = one_col(spark, [18.5, 25.0, 30.0, 30.1, None], "bmi")
    got = [r[0] for r in df.select(feat.bmi_bin_right_closed()).collect()]
    assert got == [0.0, 1.0, 2.0, 3.0, None]


def test_bin_left_closed(spark):
    df = one_col(spark, [18.5, 25.0, 30.0, 18.4], "bmi")
    got = [r[0] for r in df.select(feat.bmi_bin_left_closed()).collect()]
    assert got == ["normal", "overweight", "obese", "underweight"]


def test_gap_between_normal_and_overweight(spark):
    df = one_col(spark, [24.95], "bmi")
    out = feat.apply_features(df, feat.FLAGS + feat.EXTRA_FLAGS).first()
    assert out["is_normal_bmi"] == 0 and out["is_overweight"] == 0


def test_closed_interval_and_thresholds(spark):
    sleep = one_col(spark, [7.0, 9.0, 9.01], "sleep_duration")
    assert [r[0] for r in sleep.select(fc.interval_flag("sleep_duration", 7.0, 9.0)).collect()] == [1, 1, 0]
    hr = one_col(spark, [100.0, 100.1, 60.0, 59.9], "heart_rate")
    out = feat.apply_features(hr, feat.FLAGS).collect()
    assert [r["is_tachycardia"] for r in out] == [0, 1, 0, 0]
    assert [r["is_bradycardia"] for r in out] == [0, 0, 0, 1]
    steps = one_col(spark, [7999.0, 8000.0, 12000.0], "step_count")
    out = feat.apply_features(steps, feat.FLAGS + feat.EXTRA_FLAGS).collect()
    assert [r["is_active_steps"] for r in out] == [0, 1, 1]
    assert [r["is_very_active"] for r in out] == [0, 0, 1]


def test_null_flag_is_zero(spark):
    df = one_col(spark, [None], "bmi")
    assert df.select(fc.flag(F.col("bmi") >= 30)).first()[0] == 0


def test_guarded_ratio(spark):
    df = spark.createDataFrame([(2200.0, 0.0)], "calorie_expenditure double, exercise_duration double")
    out = feat.apply_features(df, feat.RATIOS).first()
    assert out["activity_efficiency"] == 2200.0


def test_ordinal_defaults(spark):
    df = spark.createDataFrame([("average", "occasional")], "sleep_quality string, smoking_alcohol string")
    out = feat.apply_features(df, feat.ORDINALS).first()
    assert out["sleep_q_num"] == 2 and out["smoke_num"] == 0


def test_argmax_first_on_ties(spark):
    df = spark.createDataFrame([([0.4, 0.4, 0.2],)], "p array<double>")
    assert df.select(fc.argmax_first("p")).first()[0] == 0


def test_strip_and_script_normalise(spark):
    from tabrisk.operators.clean import normalize_script
    df = spark.createDataFrame([(" Male\t",), (None,)], "gender string")
    assert [r[0] for r in normalize_script(df, ["gender"]).collect()] == ["male", "nan"]


def test_notebook_normalise_uses_mode(spark):
    from tabrisk.operators.clean import fit_modes, normalize_notebook
    df = spark.createDataFrame([("a",), ("b",), ("b",), ("a",), (None,)], "c string")
    modes = fit_modes(df, ["c"])
    assert modes == {"c": "a"}  # tie → smallest value
    assert [r[0] for r in normalize_notebook(df, ["c"], modes).collect()] == ["a", "b", "b", "a", "a"]


def test_exact_median_even_count(spark):
    from tabrisk.operators.clean import fit_medians
    df = one_col(spark, [1.0, 2.0, 4.0, 8.0, None])
    assert fit_medians(df, ["x"]) == {"x": 3.0}


def test_coerce_double(spark):
    df = spark.createDataFrame([("12",), ("abc",), (None,), ("nan",), ("1e3",)], "s string")
    assert [r[0] for r in df.select(fc.coerce_double("s")).collect()] == [12.0, 0.0, 0.0, 0.0, 1000.0]


def test_clip_keeps_null(spark):
    df = one_col(spark, [-2.0, 3.0, None])
    assert [r[0] for r in df.select(fc.clip_lower("x", 0.0)).collect()] == [0.0, 3.0, None]


def test_round_half_even_and_binary(spark):
    df = one_col(spark, [2.125, 2.375, 0.125])
    assert [r[0] for r in df.select(fc.round_half_even("x", 2)).collect()] == [2.12, 2.38, 0.12]
    assert [r[0] for r in df.select(fc.round_binary("x", 2)).collect()] == [2.13, 2.38, 0.13]


def test_hash_key_matches_python_md5(spark):
    import hashlib
    df = spark.createDataFrame([(7,)], "id long")
    assert df.select(fc.hash_key("id", 42)).first()[0] == hashlib.md5(b"7-42").hexdigest()


def test_minmax_composite(spark):
    df = spark.createDataFrame([(0.0, 10.0), (10.0, 0.0)], "sleep_duration double, bmi double")
    out = feat.composite_minmax_score(df, ["sleep_duration"], ["bmi"]).collect()
    assert math.isclose(out[0]["health_score"], -1.0, abs_tol=1e-8)
    assert math.isclose(out[1]["health_score"], 1.0, abs_tol=1e-8)


@pytest.mark.parametrize("preset,n_new", [("fast", 5), ("champion", 12)])
def test_presets_add_features(spark, preset, n_new):
    cols = ("id long, exercise_duration double, sleep_duration double, step_count double, water_intake double, "
            "calorie_expenditure double, bmi double, heart_rate double")
    df = spark.createDataFrame([(1, 30.0, 7.5, 9000.0, 2.0, 2200.0, 22.0, 70.0),
                                (2, 0.0, 5.0, 3000.0, 1.0, 1800.0, 31.0, 105.0)], cols)
    fn = {"fast": feat.preset_fast, "champion": feat.preset_champion}[preset]
    out = fn(df)
    assert len(out.columns) - len(df.columns) == n_new


HEALTH_COLS = ("id long, gender string, diet_type string, smoking_alcohol string, sleep_quality string, "
               "stress_level string, physical_activity_level string, exercise_duration double, "
               "sleep_duration double, step_count double, water_intake double, calorie_expenditure double, "
               "bmi double, heart_rate double")


def _health(spark):
    rows = [(1, "male", "veg", "no", "good", "low", "active", 30.0, 7.5, 9000.0, 2.0, 2200.0, 22.0, 70.0),
            (2, "female", "balanced", "yes", "poor", "high", "sedentary", 0.0, 5.0, 3000.0, 1.0, 1800.0, 31.0, 105.0),
            (3, "male", "veg", "no", "excellent", "medium", "very active", 60.0, 8.0, 14000.0, 3.0, 2600.0,
             24.95, 58.0)]
    return spark.createDataFrame(rows, HEALTH_COLS)


@pytest.mark.parametrize("preset,total", [("champion", 29), ("bundle", 33), ("ultra", 63), ("master", 87), ("ultimate", 125)])
def test_wide_presets_feature_counts(spark, preset, total):
    df = _health(spark)
    out = feat.PRESETS[preset](df)
    assert len(out.columns) - 1 == total  # minus the id
    assert out.count() == 3


def test_notebook_preset_maps_and_names(spark):
    out = {r["id"]: r for r in feat.preset_notebook(_health(spark)).collect()}
    assert out[3]["sleep_score"] == 8.0 * 4 and out[1]["bmi_category"] == "normal" and out[2]["bmi_category"] == "obese"
    assert out[2]["stress_sleep_ratio"] == 3 / 6.0


def test_bundle_preset_codes_sorted_categories(spark):
    out = {r["id"]: r for r in feat.preset_bundle(_health(spark)).collect()}
    assert [out[i]["sleep_quality"] for i in (1, 2, 3)] == [1, 2, 0]  # excellent < good < poor
    assert out[2]["sleep_score"] == 10.0 and out[2]["bmi_category"] == 1 and out[2]["bmi_diff_from_group_mean"] == 0.0


def test_round_binary_is_round_half_away_from_zero_without_a_decimal(spark):
    inf, nan = float("inf"), float("nan")
    values = [None, nan, inf, -inf, -0.0, 0.125, -0.125, 0.375, -0.375, 0.00499999999999999, -0.001, 2.0 ** 53 + 2, 1e300]
    df = one_col(spark, values)
    out = df.select("x", fc.round_binary("x", 2).alias("got"), (F.round(F.col("x") * 100.0, 0) / 100.0).alias("want"))
    # As text, which also shows the sign of zero and NaN.
    assert all(str(r["got"]) == str(r["want"]) for r in out.collect())
    assert "decimal" not in (plan := out.select("got")._jdf.queryExecution().executedPlan().toString()) and "round(" not in plan


def test_division_by_zero_as_in_pandas(spark):
    inf, nan = float("inf"), float("nan")
    got = [r[0] for r in one_col(spark, [3.0, -3.0, inf, -inf, 0.0, nan, None]).select(fc.divide("x", F.lit(0.0))).collect()]
    assert got[:4] == [inf, -inf, inf, -inf] and got[4] != got[4] and got[5] != got[5] and got[6] is None
