"""The seven feature sets over the health schema, each with its SQL (cleaned as its pipeline cleans)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabrisk.operators import features as feat
from tabrisk.operators.clean import Imputer, fit_medians, fit_modes, normalize_notebook, normalize_script
from tabrisk.plans.common import r, rs, sql_with
from tabrisk.plans.registry import register
from tabrisk.session import checkpoint_dir, compiled_methods
from tabrisk.sources.health import CHOICES, HEALTH_SQL, ID, MEASURES, health

MEASURED = list(MEASURES)
CATEGORIES = list(CHOICES)


def cleaned(spark, sf_dir, fit: str, order: str = "script", rows: str = "all") -> DataFrame:
    """Normalised and imputed health rows, written once. ``fit``: medians (and modes) of the train rows or all
    rows; ``rows``: train rows only, or all."""
    checkpoint_dir(spark)
    compiled_methods(spark)
    df = health(spark, sf_dir)
    df = df.where(F.col("is_train") == 1) if rows == "train" else df
    if order == "script":
        # Needs no fit: done before the write, so that no later pass repeats it.
        df = normalize_script(df, CATEGORIES)
    out = df = df.repartition(ID).checkpoint(eager=True)
    src = df.where(F.col("is_train") == 1) if fit == "train" else df
    if order != "script":
        out = normalize_notebook(df, CATEGORIES, fit_modes(src, CATEGORIES))
    return Imputer(medians=fit_medians(src, MEASURED)).apply(out)


def _strip(c: str) -> str:
    return f"lower(regexp_replace({c}, '^\\s+|\\s+$', '', 'g'))"


def cleaned_sql(fit: str, order: str = "script", rows: str = "all") -> str:
    where = "WHERE is_train = 1" if fit == "train" else ""
    src = "(SELECT * FROM health WHERE is_train = 1)" if rows == "train" else "health"
    medians = ", ".join(f"median({c}) AS {c}" for c in MEASURED)
    if order == "script":
        modes, cats = "SELECT 1", [f"coalesce({_strip(f'h.{c}')}, 'nan') AS {c}" for c in CATEGORIES]
    else:
        modes = "SELECT " + ", ".join(
            f"(SELECT {c} FROM {src} {where} {'AND' if where else 'WHERE'} {c} IS NOT NULL "
            f"GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS {c}" for c in CATEGORIES)
        cats = [_strip(f"coalesce(h.{c}, mo.{c})") + f" AS {c}" for c in CATEGORIES]
    measured = [f"coalesce(h.{c}, md.{c}) AS {c}" for c in MEASURED]
    return f"""{HEALTH_SQL.strip()},
md AS (SELECT {medians} FROM {src} {where}),
mo AS ({modes}),
clean AS (SELECT h.id, h.health_condition, h.is_train, {', '.join(measured + cats)} FROM {src} h, md, mo)"""


def _shown(df: DataFrame) -> DataFrame:
    """Doubles rounded as in the SQL, other columns as they are."""
    return df.select(*[r(c).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def _case(c: str, codes: dict, default: int) -> str:
    return f"(CASE {c} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in codes.items()) + f" ELSE {default} END)"


def _ratio(a: str, b: str, eps: str) -> str:
    return f"CAST({a} AS DOUBLE) / ({b} + {eps})"


def _flag(cond: str) -> str:
    return f"CAST({cond} AS INTEGER)"


# The columns of the competition sets in SQL. "d": rounded double, "i": integer.
STRESS = _case("stress_level", {"low": 1, "medium": 2, "high": 3}, 2)
SLEEP = _case("sleep_quality", {"poor": 1, "fair": 2, "good": 3, "excellent": 4}, 2)
ACTIVITY = _case("physical_activity_level", {"sedentary": 1, "moderate": 2, "active": 3, "very active": 4}, 2)
SMOKE = _case("smoking_alcohol", {"no": 0, "yes": 1}, 0)
RISK = (f"0.4::DOUBLE * bmi + 0.3::DOUBLE * heart_rate + 5.0::DOUBLE * {STRESS} + 10.0::DOUBLE * {SMOKE}"
        f" - 2.0::DOUBLE * (sleep_duration * {SLEEP}) - step_count / 1000.0::DOUBLE")
WELL = (f"3.0::DOUBLE * {SLEEP} + 2.0::DOUBLE * {ACTIVITY} + ln(1 + step_count)"
        f" - 2.0::DOUBLE * {STRESS} - 5.0::DOUBLE * {SMOKE}")
FORMULAS = {
    "stress_num": ("i", STRESS), "sleep_q_num": ("i", SLEEP), "activity_num": ("i", ACTIVITY), "smoke_num": ("i", SMOKE),
    "activity_efficiency": ("d", _ratio("calorie_expenditure", "exercise_duration", "1.0")),
    "steps_per_calorie": ("d", _ratio("step_count", "calorie_expenditure", "1.0")),
    "heart_rate_to_sleep": ("d", _ratio("heart_rate", "sleep_duration", "0.5")),
    "steps_per_bmi": ("d", _ratio("step_count", "bmi", "0.1")),
    "water_per_exercise": ("d", _ratio("water_intake", "exercise_duration", "1.0")),
    "calorie_per_step": ("d", _ratio("calorie_expenditure", "step_count", "1.0")),
    "sleep_per_stress": ("d", _ratio("sleep_duration", f"{STRESS}::DOUBLE", "0.1")),
    "bmi_per_activity": ("d", _ratio("bmi", f"{ACTIVITY}::DOUBLE", "0.1")),
    "bmi_sq": ("d", "bmi * bmi"), "hr_sq": ("d", "heart_rate * heart_rate"),
    "sleep_duration_sq": ("d", "sleep_duration * sleep_duration"),
    "step_log": ("d", "ln(1 + step_count)"), "calorie_log": ("d", "ln(1 + calorie_expenditure)"),
    "exercise_log": ("d", "ln(1 + exercise_duration)"), "bmi_sqrt": ("d", "sqrt(greatest(bmi, 0))"),
    "sleep_quality_index": ("d", f"sleep_duration * {SLEEP}"), "stress_bmi_load": ("d", f"bmi * {STRESS}"),
    "cardio_strain": ("d", _ratio(f"heart_rate * {STRESS}", "sleep_duration", "0.5")),
    "health_risk_score": ("d", RISK), "wellness_score": ("d", WELL),
    "recovery_index": ("d", _ratio(f"sleep_duration * {SLEEP}", f"{STRESS}::DOUBLE", "0.1")),
    "cardio_fitness": ("d", _ratio("step_count", "heart_rate", "1.0") + f" * {ACTIVITY}"),
    "is_ideal_sleep": ("i", _flag("sleep_duration BETWEEN 7 AND 9")),
    "is_deprived_sleep": ("i", _flag("sleep_duration < 6")),
    "is_normal_bmi": ("i", _flag("bmi >= 18.5::DOUBLE AND bmi <= 24.9::DOUBLE")),
    "is_overweight": ("i", _flag("bmi >= 25 AND bmi < 30")), "is_obese": ("i", _flag("bmi >= 30")),
    "is_underweight": ("i", _flag("bmi < 18.5::DOUBLE")),
    "is_tachycardia": ("i", _flag("heart_rate > 100")), "is_bradycardia": ("i", _flag("heart_rate < 60")),
    "is_active_steps": ("i", _flag("step_count >= 8000")), "is_very_active": ("i", _flag("step_count >= 12000")),
    "is_high_stress": ("i", _flag(f"{STRESS} = 3")), "is_smoker": ("i", _flag(f"{SMOKE} = 1")),
    "is_excellent_sleep": ("i", _flag(f"{SLEEP} = 4")), "is_poor_sleep": ("i", _flag(f"{SLEEP} = 1")),
    "stress_smoke_bmi": ("d", f"{STRESS} * {SMOKE} * bmi"),
    "active_sleep_stress": ("d", _ratio(f"{ACTIVITY} * {SLEEP}", f"{STRESS}::DOUBLE", "0.1")),
    "risk_activity_combo": ("d", f"({RISK}) / ({ACTIVITY}::DOUBLE + 0.1::DOUBLE)"),
}
RATIO6 = ["activity_efficiency", "steps_per_calorie", "heart_rate_to_sleep", "steps_per_bmi", "water_per_exercise",
          "calorie_per_step"]
FLAGS7 = ["is_ideal_sleep", "is_deprived_sleep", "is_normal_bmi", "is_obese", "is_tachycardia", "is_bradycardia",
          "is_active_steps"]
RAW_SQL = ["id", "health_condition", "is_train", *CATEGORIES, *[rs(c) + f" AS {c}" for c in MEASURED]]


def _wide_sql(names: list[str], key_sets: list[list[str]], agg_cols: list[str], renamed: dict | None = None,
              diff: str = "{col}_diff_{keys}", z: str | None = "{col}_zscore_{keys}") -> str:
    """``clean`` with the formulas ``names`` and, per key set, deviations and z-scores of ``agg_cols``."""
    new = {(renamed or {}).get(n, n): FORMULAS[n] for n in names}
    ctes = [cleaned_sql("all"), "feats AS (SELECT *, " + ", ".join(f"{e} AS {n}" for n, (_, e) in new.items())
            + " FROM clean)"]
    out = RAW_SQL + [rs(n) + f" AS {n}" if kind == "d" else n for n, (kind, _) in new.items()]
    joins = []
    for i, ks in enumerate(key_sets):
        aggs = []
        for c in agg_cols:
            mean = f"avg({c})"
            if c in feat.DECIMALS:
                mean = f"CAST(sum(CAST({c} AS DECIMAL(38,{feat.DECIMALS[c]}))) AS DOUBLE) / count({c})"
            aggs.append(f"{mean} AS m{i}_{c}, stddev_samp({c}) AS s{i}_{c}")
            dev = f"({c} - m{i}_{c})"
            out.append(rs(dev) + " AS " + diff.format(col=c, keys="_".join(ks)))
            if z:
                out.append(rs(f"{dev} / (coalesce(s{i}_{c}, 1.0::DOUBLE) + 1e-6)") + " AS " + z.format(col=c, keys="_".join(ks)))
        ctes.append(f"g{i} AS (SELECT {', '.join(ks)}, {', '.join(aggs)} FROM feats GROUP BY {', '.join(ks)})")
        joins.append(f"JOIN g{i} USING ({', '.join(ks)})")
    return sql_with(*ctes) + f"\nSELECT {', '.join(out)} FROM feats {' '.join(joins)}"


def _minmax_sql(eps: str) -> str:
    def mm(c):
        over = "OVER (PARTITION BY is_train)"
        return f"({c} - min({c}) {over}) / (max({c}) {over} - min({c}) {over} + {eps})"
    plus = " + ".join(mm(c) for c in feat.POSITIVE)
    return rs(f"{plus} - {mm('bmi')} - {mm('heart_rate')}") + " AS health_score"


def _each_side(df: DataFrame, preset) -> DataFrame:
    """The preset on labelled and unlabelled rows apart: each side has its own minima and maxima."""
    train, test = (preset(df.where(F.col("is_train") == side)) for side in (1, 0))
    return train.unionByName(test)


def _plain_sql(names: list[str]) -> list[str]:
    return [(rs(FORMULAS[n][1]) if FORMULAS[n][0] == "d" else FORMULAS[n][1]) + f" AS {n}" for n in names]


@register("preset_fast", sql_with(cleaned_sql("train")) + f"""
SELECT {', '.join(RAW_SQL + [_minmax_sql('1e-9')] + _plain_sql(RATIO6[:2]))}, {rs('sleep_duration')} AS sleep_score,
       CASE WHEN bmi <= 18.5::DOUBLE THEN 0.0::DOUBLE WHEN bmi <= 25 THEN 1.0::DOUBLE WHEN bmi <= 30 THEN 2.0::DOUBLE
            ELSE 3.0::DOUBLE END AS bmi_category
FROM clean""")
def q_preset_fast(spark, sf_dir):
    return _shown(_each_side(cleaned(spark, sf_dir, "train"), feat.preset_fast))


@register("preset_notebook", sql_with(cleaned_sql("train", "notebook")) + f"""
SELECT {', '.join(RAW_SQL + [_minmax_sql('1e-8')] + _plain_sql(RATIO6[:2]))},
       {rs('sleep_duration * ' + _case('sleep_quality', {'poor': 1, 'average': 2, 'good': 3, 'excellent': 4}, 2))} AS sleep_score,
       CASE WHEN bmi <= 18.5::DOUBLE THEN 'underweight' WHEN bmi <= 25 THEN 'normal' WHEN bmi <= 30 THEN 'overweight'
            ELSE 'obese' END AS bmi_category,
       {rs(_ratio(STRESS, 'sleep_duration', '1.0'))} AS stress_sleep_ratio
FROM clean""")
def q_preset_notebook(spark, sf_dir):
    return _shown(_each_side(cleaned(spark, sf_dir, "train", "notebook"), feat.preset_notebook))


@register("preset_champion", _wide_sql(RATIO6[:5] + FLAGS7, feat.KEYSETS_ULTRA[:1], feat.GROUP_DIFF_COLS,
                                       diff="{col}_diff_from_group_mean", z=None))
def q_preset_champion(spark, sf_dir):
    return _shown(feat.preset_champion(cleaned(spark, sf_dir, "all")))


_CODED = [c for c in CATEGORIES + ["bmi_category"]]


@register("preset_bundle", sql_with(cleaned_sql("train", rows="train"), """
named AS (SELECT *, CASE WHEN bmi < 18.5::DOUBLE THEN 'underweight' WHEN bmi < 25 THEN 'normal'
                         WHEN bmi < 30 THEN 'overweight' ELSE 'obese' END AS bmi_category FROM clean)""", f"""
coded AS (SELECT * REPLACE ({', '.join(f'CAST(dense_rank() OVER (ORDER BY {c}) - 1 AS INTEGER) AS {c}' for c in _CODED)})
          FROM named)""") + f"""
SELECT {', '.join(RAW_SQL + ['bmi_category'] + _plain_sql(RATIO6[:5] + FLAGS7))},
       {rs('exercise_duration + sleep_duration + step_count + water_intake + calorie_expenditure - (bmi + heart_rate)')} AS health_score,
       {rs('sleep_duration * sleep_quality')} AS sleep_score,
       {rs(_ratio('stress_level', 'sleep_duration', '1.0'))} AS stress_sleep_ratio,
       {', '.join(f'0.0::DOUBLE AS {c}_diff_from_group_mean' for c in feat.GROUP_DIFF_COLS)}
FROM coded""")
def q_preset_bundle(spark, sf_dir):
    return _shown(feat.preset_bundle(cleaned(spark, sf_dir, "train", rows="train")))


@register("preset_ultra", _wide_sql(
    ["stress_num", "sleep_q_num", "activity_num"] + RATIO6 + ["sleep_quality_index", "stress_bmi_load", "cardio_strain"]
    + FLAGS7 + ["is_high_stress"], feat.KEYSETS_ULTRA, feat.AGG_ULTRA, diff="{col}_diff_from_{keys}"))
def q_preset_ultra(spark, sf_dir):
    return _shown(feat.preset_ultra(cleaned(spark, sf_dir, "all")))


@register("preset_master", _wide_sql(
    ["stress_num", "sleep_q_num", "activity_num", "smoke_num"] + RATIO6
    + ["bmi_sq", "hr_sq", "sleep_duration_sq", "step_log", "sleep_quality_index", "stress_bmi_load", "cardio_strain",
       "health_risk_score"] + FLAGS7 + ["is_high_stress"],
    feat.KEYSETS_MASTER, feat.AGG_MASTER, renamed=feat.MASTER_NAMES))
def q_preset_master(spark, sf_dir):
    return _shown(feat.preset_master(cleaned(spark, sf_dir, "all")))


@register("preset_ultimate", _wide_sql(
    [n for n in FORMULAS if n != "sleep_duration_sq"], feat.KEYSETS_ULTIMATE, feat.AGG_ULTIMATE))
def q_preset_ultimate(spark, sf_dir):
    return _shown(feat.preset_ultimate(cleaned(spark, sf_dir, "all")))
