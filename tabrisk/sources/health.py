"""The health schema bound to ``orders``, so that the feature presets run on the driver tables.

Measures are integer arithmetic on the order's price in cents (both engines agree bit for bit), categories
are picked from lists whose spellings carry case and spaces, and a fixed share of every column is NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabrisk.sources.tables import table

ID = "id"
LABEL = "health_condition"
# column → divisor of the cents, number of steps, lowest step, steps a unit
MEASURES = {
    "sleep_duration": (1, 91, 30, 10),
    "heart_rate": (3, 86, 40, 1),
    "bmi": (7, 251, 150, 10),
    "calorie_expenditure": (11, 2401, 1200, 1),
    "step_count": (13, 16001, 0, 1),
    "exercise_duration": (17, 121, 0, 1),
    "water_intake": (19, 46, 5, 10),
}
# column → divisor of the cents, spellings
CHOICES = {
    "gender": (23, ["Male", "female ", "OTHER", " female"]),
    "diet_type": (29, ["Balanced", "veg", "non-veg "]),
    "smoking_alcohol": (31, ["no", "Yes", "occasional", " no"]),
    "sleep_quality": (37, ["Good", "average", " poor", "fair", "EXCELLENT"]),
    "stress_level": (41, ["low", " Medium", "HIGH"]),
    "physical_activity_level": (43, ["active", "Moderate", " sedentary", "very active"]),
}


def health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, health_condition, 7 measures, 6 categories, is_train)``, one row an order."""
    # A projection of its own, so that the price is rounded once a row, not once a column.
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", F.round(F.col("o_totalprice") * 100, 0).cast("long").alias("__cents"))
    key, cents = F.col("o_orderkey"), F.col("__cents")
    cols = []
    for c, (div, steps, lowest, unit) in MEASURES.items():
        step = F.floor(cents / F.lit(div)) % steps + lowest
        cols.append(F.when((key + div) % 20 != 0, step.cast("double") / F.lit(float(unit))).alias(c))
    for c, (div, names) in CHOICES.items():
        at = (F.floor(cents / F.lit(div)) % len(names) + 1).cast("int")
        cols.append(F.when((key + div) % 17 != 0, F.element_at(F.array(*[F.lit(n) for n in names]), at)).alias(c))
    return o.select(key.alias(ID), F.col("o_orderstatus").alias(LABEL), *cols,
                    (key % 10 < 7).cast("int").alias("is_train"))


def _measure_sql(c: str) -> str:
    div, steps, lowest, unit = MEASURES[c]
    return (f"CASE WHEN (o_orderkey + {div}) % 20 <> 0 "
            f"THEN CAST((cents // {div}) % {steps} + {lowest} AS DOUBLE) / CAST({unit} AS DOUBLE) END AS {c}")


def _choice_sql(c: str) -> str:
    div, names = CHOICES[c]
    quoted = ", ".join(f"'{n}'" for n in names)
    return f"CASE WHEN (o_orderkey + {div}) % 17 <> 0 THEN ([{quoted}])[(cents // {div}) % {len(names)} + 1] END AS {c}"


HEALTH_SQL = f"""
health AS (
  SELECT o_orderkey AS id, o_orderstatus AS health_condition,
         {', '.join(_measure_sql(c) for c in MEASURES)},
         {', '.join(_choice_sql(c) for c in CHOICES)},
         CAST(CASE WHEN o_orderkey % 10 < 7 THEN 1 ELSE 0 END AS INTEGER) AS is_train
  FROM (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders))"""
