"""Declarative feature registry: name → (inputs, Column builder), applied level by level.

A feature whose inputs are absent from the schema is skipped when the plan is built
(no run-time work). Each level is one ``withColumns`` projection, so a 125-feature set
is three projections, not 125 nested ``withColumn`` nodes.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabrisk.functions.columns import (bin_left_closed, bin_right_closed, clip_lower,
                                       guarded_ratio, interval_flag, ordinal_map, threshold_flag,
                                       weighted_sum)

col = F.col


@dataclass(frozen=True)
class Feature:
    name: str
    inputs: tuple[str, ...]
    build: Callable[[], Column]
    level: int = 1


def apply_features(df: DataFrame, specs: Sequence[Feature]) -> DataFrame:
    """Add every feature whose inputs exist; one projection per dependency level."""
    out = df
    for level in sorted({s.level for s in specs}):
        have = set(out.columns)
        batch = {s.name: s.build() for s in specs if s.level == level and set(s.inputs) <= have}
        if batch:
            out = out.withColumns(batch)
    return out


def ratio(name: str, num: str, den: str, eps: float, level: int = 1) -> Feature:
    return Feature(name, (num, den), lambda: guarded_ratio(num, den, eps), level)


def fit_minmax(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Global min / max of each column from one aggregate."""
    row = df.agg(*[F.min(c).alias(f"mn_{c}") for c in cols],
                 *[F.max(c).alias(f"mx_{c}") for c in cols]).first()
    return {c: (row[f"mn_{c}"], row[f"mx_{c}"]) for c in cols}


def minmax_column(c: str, lo: float, hi: float, eps: float) -> Column:
    return (col(c) - F.lit(lo)) / (F.lit(hi) - F.lit(lo) + F.lit(eps))


def composite_minmax_score(df: DataFrame, positive: Sequence[str], negative: Sequence[str],
                           name: str = "health_score", eps: float = 1e-9,
                           fitted: dict | None = None) -> DataFrame:
    """Σ min-max(positive) − Σ min-max(negative); ``fitted`` comes from the train side."""
    pos = [c for c in positive if c in df.columns]
    neg = [c for c in negative if c in df.columns]
    mm = fitted or fit_minmax(df, pos + neg)
    expr = None
    for c in pos:
        t = minmax_column(c, *mm[c], eps)
        expr = t if expr is None else expr + t
    for c in neg:
        t = minmax_column(c, *mm[c], eps)
        expr = -t if expr is None else expr - t
    return df.withColumn(name, expr)


# ---------------------------------------------------------------------------
# Fixed values of the health schema (must equal the reference's rules):
# guarded-ratio epsilons, flag thresholds, bin edges, ordinal dictionaries and
# linear-index weights.
# ---------------------------------------------------------------------------
POSITIVE = ["exercise_duration", "sleep_duration", "step_count", "water_intake", "calorie_expenditure"]
NEGATIVE = ["bmi", "heart_rate"]
BMI_EDGES = [18.5, 25.0, 30.0]
BMI_NAMES = ["underweight", "normal", "overweight", "obese"]
STRESS_MAP = {"low": 1, "medium": 2, "high": 3}
SLEEP_Q_MAP = {"poor": 1, "fair": 2, "good": 3, "excellent": 4}
ACTIVITY_MAP = {"sedentary": 1, "moderate": 2, "active": 3, "very active": 4}
SMOKE_MAP = {"no": 0, "yes": 1}
ORDINAL_DEFAULTS = {"stress_num": 2, "sleep_q_num": 2, "activity_num": 2, "smoke_num": 0}
# Notebook variant of the sleep-quality and stress dictionaries.
SLEEP_Q_MAP_NOTEBOOK = {"poor": 1, "average": 2, "good": 3, "excellent": 4}
STRESS_MAP_NOTEBOOK = {"low": 1, "medium": 2, "high": 3}

RATIOS = [
    ratio("activity_efficiency", "calorie_expenditure", "exercise_duration", 1.0),
    ratio("steps_per_calorie", "step_count", "calorie_expenditure", 1.0),
    ratio("heart_rate_to_sleep", "heart_rate", "sleep_duration", 0.5),
    ratio("steps_per_bmi", "step_count", "bmi", 0.1),
    ratio("water_per_exercise", "water_intake", "exercise_duration", 1.0),
]
EXTRA_RATIOS = [
    ratio("calorie_per_step", "calorie_expenditure", "step_count", 1.0, level=1),
    ratio("sleep_per_stress", "sleep_duration", "stress_num", 0.1, level=2),
    ratio("bmi_per_activity", "bmi", "activity_num", 0.1, level=2),
]

FLAGS = [
    Feature("is_ideal_sleep", ("sleep_duration",), lambda: interval_flag("sleep_duration", 7.0, 9.0)),
    Feature("is_deprived_sleep", ("sleep_duration",), lambda: threshold_flag("sleep_duration", "<", 6.0)),
    Feature("is_normal_bmi", ("bmi",), lambda: interval_flag("bmi", 18.5, 24.9)),
    Feature("is_obese", ("bmi",), lambda: threshold_flag("bmi", ">=", 30.0)),
    Feature("is_tachycardia", ("heart_rate",), lambda: threshold_flag("heart_rate", ">", 100.0)),
    Feature("is_bradycardia", ("heart_rate",), lambda: threshold_flag("heart_rate", "<", 60.0)),
    Feature("is_active_steps", ("step_count",), lambda: threshold_flag("step_count", ">=", 8000)),
]
EXTRA_FLAGS = [
    Feature("is_overweight", ("bmi",), lambda: interval_flag("bmi", 25.0, 30.0, hi_closed=False)),
    Feature("is_underweight", ("bmi",), lambda: threshold_flag("bmi", "<", 18.5)),
    Feature("is_very_active", ("step_count",), lambda: threshold_flag("step_count", ">=", 12000)),
    Feature("is_high_stress", ("stress_num",), lambda: threshold_flag("stress_num", "==", 3), level=2),
    Feature("is_smoker", ("smoke_num",), lambda: threshold_flag("smoke_num", "==", 1), level=2),
    Feature("is_excellent_sleep", ("sleep_q_num",), lambda: threshold_flag("sleep_q_num", "==", 4), level=2),
    Feature("is_poor_sleep", ("sleep_q_num",), lambda: threshold_flag("sleep_q_num", "==", 1), level=2),
]

ORDINALS = [
    Feature("stress_num", ("stress_level",), lambda: ordinal_map("stress_level", STRESS_MAP, 2)),
    Feature("sleep_q_num", ("sleep_quality",), lambda: ordinal_map("sleep_quality", SLEEP_Q_MAP, 2)),
    Feature("activity_num", ("physical_activity_level",),
            lambda: ordinal_map("physical_activity_level", ACTIVITY_MAP, 2)),
    Feature("smoke_num", ("smoking_alcohol",), lambda: ordinal_map("smoking_alcohol", SMOKE_MAP, 0)),
]

NONLINEAR = [
    Feature("bmi_sq", ("bmi",), lambda: col("bmi") * col("bmi")),
    Feature("hr_sq", ("heart_rate",), lambda: col("heart_rate") * col("heart_rate")),
    Feature("sleep_duration_sq", ("sleep_duration",), lambda: col("sleep_duration") * col("sleep_duration")),
    Feature("step_log", ("step_count",), lambda: F.log1p("step_count")),
    Feature("calorie_log", ("calorie_expenditure",), lambda: F.log1p("calorie_expenditure")),
    Feature("exercise_log", ("exercise_duration",), lambda: F.log1p("exercise_duration")),
    Feature("bmi_sqrt", ("bmi",), lambda: F.sqrt(clip_lower("bmi", 0.0))),
]


def _health_risk() -> Column:
    weighted = weighted_sum({"bmi": 0.4, "heart_rate": 0.3, "stress_num": 5.0, "smoke_num": 10.0, "sleep_quality_index": -2.0})
    return weighted - col("step_count") / F.lit(1000.0)


def _wellness() -> Column:
    return weighted_sum({"sleep_q_num": 3.0, "activity_num": 2.0}) + F.log1p("step_count") + weighted_sum({"stress_num": -2.0, "smoke_num": -5.0})


COMPOSITES = [
    Feature("sleep_quality_index", ("sleep_duration", "sleep_q_num"),
            lambda: col("sleep_duration") * col("sleep_q_num"), level=2),
    Feature("stress_bmi_load", ("bmi", "stress_num"), lambda: col("bmi") * col("stress_num"), level=2),
    Feature("cardio_strain", ("heart_rate", "stress_num", "sleep_duration"),
            lambda: guarded_ratio(col("heart_rate") * col("stress_num"), "sleep_duration", 0.5), level=2),
    Feature("recovery_index", ("sleep_duration", "sleep_q_num", "stress_num"),
            lambda: guarded_ratio(col("sleep_duration") * col("sleep_q_num"), "stress_num", 0.1), level=2),
    Feature("cardio_fitness", ("step_count", "heart_rate", "activity_num"),
            lambda: guarded_ratio("step_count", "heart_rate", 1.0) * col("activity_num"), level=2),
    Feature("health_risk_score", ("bmi", "heart_rate", "stress_num", "smoke_num", "step_count"),
            _health_risk, level=3),
    Feature("wellness_score", ("sleep_q_num", "activity_num", "step_count", "stress_num", "smoke_num"),
            _wellness, level=2),
    Feature("stress_smoke_bmi", ("stress_num", "smoke_num", "bmi"),
            lambda: col("stress_num") * col("smoke_num") * col("bmi"), level=2),
    Feature("active_sleep_stress", ("activity_num", "sleep_q_num", "stress_num"),
            lambda: guarded_ratio(col("activity_num") * col("sleep_q_num"), "stress_num", 0.1), level=2),
    Feature("risk_activity_combo", ("health_risk_score", "activity_num"),
            lambda: guarded_ratio("health_risk_score", "activity_num", 0.1), level=4),
]


def bmi_bin_right_closed(c: str = "bmi") -> Column:
    """(-inf,18.5] → 0, (18.5,25] → 1, (25,30] → 2, (30,inf) → 3, as double (``pd.cut``)."""
    return bin_right_closed(c, BMI_EDGES, [0.0, 1.0, 2.0, 3.0])


def bmi_bin_left_closed(c: str = "bmi") -> Column:
    """< 18.5 underweight, < 25 normal, < 30 overweight, else obese (row-callback rule)."""
    return bin_left_closed(c, BMI_EDGES, BMI_NAMES)


def preset_fast(df: DataFrame, fitted_minmax: dict | None = None) -> DataFrame:
    """13 raw + health_score, activity_efficiency, steps_per_calorie, sleep_score, bmi_category = 18."""
    out = composite_minmax_score(df, POSITIVE, NEGATIVE, eps=1e-9, fitted=fitted_minmax)
    specs = [RATIOS[0], RATIOS[1],
             Feature("sleep_score", ("sleep_duration",), lambda: col("sleep_duration")),
             Feature("bmi_category", ("bmi",), bmi_bin_right_closed)]
    return apply_features(out, specs)


def preset_notebook(df: DataFrame, fitted_minmax: dict | None = None) -> DataFrame:
    """Notebook chain: fast features with sleep_score = duration × ordinal, + stress_sleep_ratio = 19."""
    out = composite_minmax_score(df, POSITIVE, NEGATIVE, eps=1e-8, fitted=fitted_minmax)
    specs = [RATIOS[0], RATIOS[1],
             Feature("sleep_score", ("sleep_duration", "sleep_quality"),
                     lambda: col("sleep_duration") * ordinal_map("sleep_quality", SLEEP_Q_MAP_NOTEBOOK, 2)),
             Feature("bmi_category", ("bmi",), lambda: bin_right_closed("bmi", BMI_EDGES, BMI_NAMES)),
             Feature("stress_sleep_ratio", ("stress_level", "sleep_duration"),
                     lambda: guarded_ratio(ordinal_map("stress_level", STRESS_MAP_NOTEBOOK, 2), "sleep_duration", 1.0))]
    return apply_features(out, specs)


def preset_champion(df: DataFrame) -> DataFrame:
    """13 raw + 5 ratios + 7 flags + 4 group deviations = 29; without the group columns, these are left out."""
    from tabrisk.operators.groups import group_diff
    out = apply_features(df, RATIOS + FLAGS)
    cols = [c for c in GROUP_DIFF_COLS if c in out.columns]
    if not cols or not set(KEYSETS_ULTRA[0]) <= set(out.columns):
        return out
    return group_diff(out, KEYSETS_ULTRA[0], cols, decimal_scale=DECIMALS,
                      diff_name="{col}_diff_from_group_mean")


def code_categories(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Each category replaced by its position among the column's sorted distinct values."""
    from tabrisk.operators.encode import fit_vocabularies, label_encode
    vocabularies = fit_vocabularies(df, cols)
    out = df
    for c in cols:
        out = label_encode(out, c, vocabularies.where(col("column_name") == c), out=f"__code_{c}")
    return out.select(*[col(f"__code_{c}").alias(c) if c in cols else col(c) for c in df.columns])


def preset_bundle(df: DataFrame) -> DataFrame:
    """Production bundle: the BMI category is named first, the seven categories are coded (``df``'s own
    vocabularies), then ratios, raw health_score, flags and 4 zero columns over the codes = 33."""
    coded = apply_features(df, [Feature("bmi_category", ("bmi",), bmi_bin_left_closed)])
    coded = code_categories(coded, [c for c in CATEGORIES + ["bmi_category"] if c in coded.columns])
    raw_sum = Feature("health_score", tuple(POSITIVE + NEGATIVE), lambda: (
        sum((col(c) for c in POSITIVE[1:]), col(POSITIVE[0])) - (col(NEGATIVE[0]) + col(NEGATIVE[1]))))
    specs = RATIOS + [raw_sum] + [
        Feature("sleep_score", ("sleep_duration", "sleep_quality"),
                lambda: col("sleep_duration") * col("sleep_quality")),
    ] + FLAGS + [
        Feature("stress_sleep_ratio", ("stress_level", "sleep_duration"),
                lambda: guarded_ratio("stress_level", "sleep_duration", 1.0)),
    ] + [Feature(f"{c}_diff_from_group_mean", (), lambda: F.lit(0.0), level=9) for c in GROUP_DIFF_COLS]
    return apply_features(coded, specs)


def preset_extended(df: DataFrame) -> DataFrame:
    """Ordinals, all ratios, non-linear terms, indices and flags (the wide competition sets)."""
    return apply_features(df, ORDINALS + RATIOS + EXTRA_RATIOS + NONLINEAR + COMPOSITES + FLAGS + EXTRA_FLAGS)


# ---------------------------------------------------------------------------
# Categories, group key sets, aggregated columns and output names of the competition sets.
# ---------------------------------------------------------------------------
CATEGORIES = ["gender", "diet_type", "smoking_alcohol", "sleep_quality", "stress_level", "physical_activity_level"]
GROUP_DIFF_COLS = ["heart_rate", "bmi", "step_count", "calorie_expenditure"]
KEYSETS_ULTRA = [["gender", "physical_activity_level"], ["gender", "diet_type"], ["stress_level", "sleep_quality"]]
KEYSETS_MASTER = KEYSETS_ULTRA + [["gender", "smoking_alcohol"]]
KEYSETS_ULTIMATE = KEYSETS_MASTER + [["physical_activity_level", "diet_type"]]
AGG_ULTRA = ["heart_rate", "bmi", "step_count", "calorie_expenditure", "sleep_duration"]
AGG_MASTER = AGG_ULTRA + ["unhealth_risk_index"]
AGG_ULTIMATE = AGG_ULTRA + ["health_risk_score", "wellness_score"]
MASTER_NAMES = {"bmi_sq": "bmi_squared", "hr_sq": "heart_rate_squared", "step_log": "step_count_log",
                "health_risk_score": "unhealth_risk_index"}
# Measured columns have at most two decimals and the risk score four: their group sums are exact.
DECIMALS = {**{c: 2 for c in AGG_ULTRA}, "unhealth_risk_index": 4, "health_risk_score": 4}

_ALL = {f.name: f for f in ORDINALS + RATIOS + EXTRA_RATIOS + NONLINEAR + COMPOSITES + FLAGS + EXTRA_FLAGS}


def _pick(names: Sequence[str], renamed: dict[str, str] | None = None) -> list[Feature]:
    return [replace(_ALL[n], name=(renamed or {}).get(n, n)) for n in names]


def _wide_preset(df: DataFrame, specs: Sequence[Feature], key_sets, agg_cols,
                 diff_name: str = "{col}_diff_{keys}") -> DataFrame:
    from tabrisk.operators.groups import group_features_multi
    out = apply_features(df, specs)
    present = [c for c in agg_cols if c in out.columns]
    sets = [ks for ks in key_sets if set(ks) <= set(out.columns)]
    if not sets or not present:
        return out
    return group_features_multi(out, sets, present, decimal_scale=DECIMALS,
                                diff_name=diff_name, z_name="{col}_zscore_{keys}")


_RATIO6 = [f.name for f in RATIOS] + ["calorie_per_step"]
_FLAGS8 = [f.name for f in FLAGS] + ["is_high_stress"]


def preset_ultra(df: DataFrame) -> DataFrame:
    """13 raw + 3 ordinals + 6 ratios + 3 indices + 8 flags + 3 key sets × 5 columns × (diff, z) = 63."""
    names = ["stress_num", "sleep_q_num", "activity_num"] + _RATIO6 + [
        "sleep_quality_index", "stress_bmi_load", "cardio_strain"] + _FLAGS8
    return _wide_preset(df, _pick(names), KEYSETS_ULTRA, AGG_ULTRA, diff_name="{col}_diff_from_{keys}")


def preset_master(df: DataFrame) -> DataFrame:
    """13 raw + 4 ordinals + 6 ratios + 4 non-linear + 4 indices + 8 flags + 4 × 6 × 2 = 87."""
    names = [f.name for f in ORDINALS] + _RATIO6 + ["bmi_sq", "hr_sq", "sleep_duration_sq", "step_log"] + [
        "sleep_quality_index", "stress_bmi_load", "cardio_strain", "health_risk_score"] + _FLAGS8
    return _wide_preset(df, _pick(names, MASTER_NAMES), KEYSETS_MASTER, AGG_MASTER)


def preset_ultimate(df: DataFrame) -> DataFrame:
    """13 raw + 4 ordinals + 8 ratios + 6 non-linear + 7 indices + 14 flags + 3 triples + 5 × 7 × 2 = 125."""
    names = ([f.name for f in ORDINALS] + _RATIO6 + ["sleep_per_stress", "bmi_per_activity"]
             + ["bmi_sq", "hr_sq", "step_log", "calorie_log", "exercise_log", "bmi_sqrt"]
             + ["sleep_quality_index", "stress_bmi_load", "cardio_strain", "health_risk_score", "wellness_score",
                "recovery_index", "cardio_fitness"]
             + [f.name for f in FLAGS] + ["is_overweight", "is_underweight", "is_very_active", "is_high_stress",
                                          "is_smoker", "is_excellent_sleep", "is_poor_sleep"]
             + ["stress_smoke_bmi", "active_sleep_stress", "risk_activity_combo"])
    return _wide_preset(df, _pick(names), KEYSETS_ULTIMATE, AGG_ULTIMATE)


PRESETS = {"fast": preset_fast, "notebook": preset_notebook, "champion": preset_champion,
           "bundle": preset_bundle, "ultra": preset_ultra, "master": preset_master, "ultimate": preset_ultimate}
