"""Feature queries: group deviations / z-scores and scalar feature expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabrisk.operators import features as feat
from tabrisk.operators.groups import group_diff, group_features_multi, group_zscore
from tabrisk.plans.common import (CAT, GROUP_KEYS, ID, KEY_SETS, NUM, PREPARED_SQL, prepared, r, rs,
                                  sql_with)
from tabrisk.plans.registry import register
from tabrisk.sources.tables import BASE_SQL, base

GZ_COLS = NUM
# Columns whose (imputed) values carry at most two decimals: exact DECIMAL group sums.
DEC2 = {"o_totalprice": 2, "c_acctbal": 2, "n_lines": 2, "sum_qty": 2}


def _mean_sql(c: str) -> str:
    if c in DEC2:
        return f"CAST(sum(CAST({c} AS DECIMAL(38,{DEC2[c]}))) AS DOUBLE) / count({c})"
    return f"avg({c})"


def _stats_sql(name: str, keys: list[str], cols: list[str]) -> str:
    aggs = ", ".join(f"{_mean_sql(c)} AS m_{c}, stddev_samp({c}) AS s_{c}" for c in cols)
    return f"{name} AS (SELECT {', '.join(keys)}, {aggs} FROM prepared GROUP BY {', '.join(keys)})"


def _z_sql(c: str, st: str, tag: str) -> str:
    return rs(f"(p.{c} - {st}.m_{c}) / (coalesce({st}.s_{c}, CAST(1.0 AS DOUBLE)) + 1e-6)") + f" AS {c}_z_{tag}"


def _diff_sql(c: str, st: str, tag: str) -> str:
    return rs(f"p.{c} - {st}.m_{c}") + f" AS {c}_diff_{tag}"


def _join_sql(st: str, keys: list[str]) -> str:
    cond = " AND ".join(f"p.{k} IS NOT DISTINCT FROM {st}.{k}" for k in keys)
    return f"LEFT JOIN {st} ON {cond}"


_TAG = "_".join(GROUP_KEYS)


@register("group_zscore", sql_with(PREPARED_SQL, _stats_sql("st", GROUP_KEYS, GZ_COLS)) + f"""
SELECT p.o_orderkey, p.o_orderpriority, p.c_mktsegment,
       {', '.join(_z_sql(c, 'st', _TAG) for c in GZ_COLS)}
FROM prepared p {_join_sql('st', GROUP_KEYS)}""")
def q_group_zscore(spark, sf_dir):
    df = group_zscore(prepared(spark, sf_dir), GROUP_KEYS, GZ_COLS, decimal_scale=DEC2)
    return df.select(ID, *GROUP_KEYS, *[r(f"{c}_z_{_TAG}").alias(f"{c}_z_{_TAG}") for c in GZ_COLS])


@register("group_diff", sql_with(PREPARED_SQL, _stats_sql("st", GROUP_KEYS, GZ_COLS)) + f"""
SELECT p.o_orderkey, p.o_orderpriority, p.c_mktsegment,
       {', '.join(_diff_sql(c, 'st', _TAG) for c in GZ_COLS)}
FROM prepared p {_join_sql('st', GROUP_KEYS)}""")
def q_group_diff(spark, sf_dir):
    df = group_diff(prepared(spark, sf_dir), GROUP_KEYS, GZ_COLS, decimal_scale=DEC2)
    return df.select(ID, *GROUP_KEYS, *[r(f"{c}_diff_{_TAG}").alias(f"{c}_diff_{_TAG}") for c in GZ_COLS])


_MULTI_COLS = ["o_totalprice", "c_acctbal", "sum_qty", "avg_price"]


def _multi_sql() -> str:
    ctes = [_stats_sql(f"st{i}", ks, _MULTI_COLS) for i, ks in enumerate(KEY_SETS)]
    sel, joins = [], []
    for i, ks in enumerate(KEY_SETS):
        tag = "_".join(ks)
        for c in _MULTI_COLS:
            sel += [_diff_sql(c, f"st{i}", tag), _z_sql(c, f"st{i}", tag)]
        joins.append(_join_sql(f"st{i}", ks))
    return sql_with(PREPARED_SQL, *ctes) + f"""
SELECT p.o_orderkey, {', '.join(sel)}
FROM prepared p {' '.join(joins)}"""


@register("group_features_multi", _multi_sql())
def q_group_features_multi(spark, sf_dir):
    df = group_features_multi(prepared(spark, sf_dir), KEY_SETS, _MULTI_COLS, decimal_scale=DEC2)
    cols = []
    for ks in KEY_SETS:
        tag = "_".join(ks)
        for c in _MULTI_COLS:
            cols += [f"{c}_diff_{tag}", f"{c}_z_{tag}"]
    return df.select(ID, *[r(c).alias(c) for c in cols])


@register("group_stats_join", sql_with(PREPARED_SQL) + """,
st AS (SELECT o_orderpriority, avg(o_totalprice) AS grp_mean, count(*) AS grp_n FROM prepared GROUP BY o_orderpriority)
SELECT p.o_orderkey, p.o_orderpriority, (round(st.grp_mean, 4) + CAST(0 AS DOUBLE)) AS grp_mean, CAST(st.grp_n AS BIGINT) AS grp_n,
       (round(p.o_totalprice - st.grp_mean, 4) + CAST(0 AS DOUBLE)) AS dev
FROM prepared p JOIN st ON p.o_orderpriority IS NOT DISTINCT FROM st.o_orderpriority""")
def q_group_stats_join(spark, sf_dir):
    from tabrisk.operators.joins import join_small
    df = prepared(spark, sf_dir)
    st = df.groupBy("o_orderpriority").agg(F.avg("o_totalprice").alias("grp_mean"),
                                           F.count(F.lit(1)).alias("grp_n"))
    j = join_small(df, st, ["o_orderpriority"], how="inner", null_safe=True)
    return j.select(ID, "o_orderpriority", r("grp_mean").alias("grp_mean"), F.col("grp_n").cast("long"),
                    r(F.col("o_totalprice") - F.col("grp_mean")).alias("dev"))


def _flagship_spark(spark, sf_dir):
    from tabrisk.sources.tables import CLASSES
    df = group_zscore(prepared(spark, sf_dir), GROUP_KEYS, GZ_COLS, decimal_scale=DEC2)
    code = F.array_position(F.array(*[F.lit(c) for c in CLASSES]), F.col("o_orderstatus")) - 1
    per = df.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(f"{c}_z_{_TAG}").alias(f"mean_z_{c}") for c in GZ_COLS])
    from pyspark.sql import Window
    total = F.sum("n").over(Window.partitionBy())  # a 3-row table
    return per.select("o_orderstatus", code.cast("int").alias("label_code"), F.col("n").cast("long"),
                      r(F.col("n") * 100.0 / total, 2).alias("pct"),
                      *[r(f"mean_z_{c}").alias(f"mean_z_{c}") for c in GZ_COLS])


_FLAGSHIP_SQL = sql_with(PREPARED_SQL, _stats_sql("st", GROUP_KEYS, GZ_COLS)) + f""",
z AS (SELECT p.o_orderkey, p.o_orderstatus, {', '.join(
    f"(p.{c} - st.m_{c}) / (coalesce(st.s_{c}, CAST(1.0 AS DOUBLE)) + 1e-6) AS z_{c}" for c in GZ_COLS)}
      FROM prepared p {_join_sql('st', GROUP_KEYS)})
SELECT o_orderstatus,
       CAST(CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 WHEN 'P' THEN 2 END AS INTEGER) AS label_code,
       CAST(count(*) AS BIGINT) AS n,
       (round(count(*) * 100.0 / sum(count(*)) OVER (), 2) + CAST(0 AS DOUBLE)) AS pct,
       {', '.join(rs(f"avg(z_{c})") + f" AS mean_z_{c}" for c in GZ_COLS)}
FROM z GROUP BY o_orderstatus"""


@register("flagship_class_summary", _FLAGSHIP_SQL)
def flagship(spark, sf_dir):
    return _flagship_spark(spark, sf_dir)


# --- scalar feature expressions bound to the order table (D1–D24) -------------
from tabrisk.functions import columns as fc  # noqa: E402
from tabrisk.operators.features import composite_minmax_score, fit_minmax  # noqa: E402

_RATIOS = {"price_per_line": ("o_totalprice", "n_lines", 1.0), "qty_per_line": ("sum_qty", "n_lines", 1.0),
           "price_per_qty": ("avg_price", "sum_qty", 0.5), "bal_per_price": ("c_acctbal", "o_totalprice", 0.1),
           "tax_per_disc": ("avg_tax", "avg_disc", 1.0)}


@register("feat_ratios", sql_with(PREPARED_SQL) + "\nSELECT o_orderkey, " + ", ".join(
    rs(f"{a} / ({b} + CAST({eps!r} AS DOUBLE))") + f" AS {n}" for n, (a, b, eps) in _RATIOS.items()) + " FROM prepared")
def q_feat_ratios(spark, sf_dir):
    p = prepared(spark, sf_dir)
    return p.select(ID, *[r(fc.guarded_ratio(a, b, eps)).alias(n) for n, (a, b, eps) in _RATIOS.items()])


@register("feat_nonlinear", sql_with(PREPARED_SQL) + "\nSELECT o_orderkey, " + ", ".join([
    rs("avg_disc * avg_disc", 6) + " AS disc_sq",
    rs("n_lines * n_lines") + " AS lines_sq",
    rs("ln(1 + sum_qty)") + " AS log_qty",
    rs("ln(1 + o_totalprice)") + " AS log_price",
    rs("CASE WHEN c_acctbal IS NOT NULL THEN greatest(c_acctbal, 0.0) END") + " AS acctbal_clip",
    rs("sqrt(CASE WHEN c_acctbal IS NOT NULL THEN greatest(c_acctbal, 0.0) END)") + " AS sqrt_acctbal",
]) + " FROM prepared")
def q_feat_nonlinear(spark, sf_dir):
    p = prepared(spark, sf_dir)
    clip = fc.clip_lower("c_acctbal", 0.0)
    return p.select(ID, r(F.col("avg_disc") * F.col("avg_disc"), 6).alias("disc_sq"),
                    r(F.col("n_lines") * F.col("n_lines")).alias("lines_sq"),
                    r(F.log1p("sum_qty")).alias("log_qty"), r(F.log1p("o_totalprice")).alias("log_price"),
                    r(clip).alias("acctbal_clip"), r(F.sqrt(clip)).alias("sqrt_acctbal"))


@register("feat_flags", sql_with(PREPARED_SQL) + """
SELECT o_orderkey,
       coalesce(CAST(avg_disc >= 0.02 AND avg_disc <= 0.06 AS INTEGER), 0) AS is_mid_discount,
       coalesce(CAST(n_lines >= 3 AND n_lines < 5 AS INTEGER), 0) AS is_mid_lines,
       coalesce(CAST(o_totalprice > 200000 AS INTEGER), 0) AS is_large_order,
       coalesce(CAST(sum_qty >= 100 AS INTEGER), 0) AS is_bulk,
       coalesce(CAST(c_acctbal < 0 AS INTEGER), 0) AS is_negative_balance,
       coalesce(CAST(o_orderpriority = '1-urgent' AS INTEGER), 0) AS is_urgent
FROM prepared""")
def q_feat_flags(spark, sf_dir):
    p = prepared(spark, sf_dir)
    return p.select(ID, fc.interval_flag("avg_disc", 0.02, 0.06).alias("is_mid_discount"),
                    fc.interval_flag("n_lines", 3, 5, hi_closed=False).alias("is_mid_lines"),
                    fc.threshold_flag("o_totalprice", ">", 200000).alias("is_large_order"),
                    fc.threshold_flag("sum_qty", ">=", 100).alias("is_bulk"),
                    fc.threshold_flag("c_acctbal", "<", 0).alias("is_negative_balance"),
                    fc.flag(F.col("o_orderpriority") == "1-urgent").alias("is_urgent"))


_EDGES = [50000.0, 150000.0, 300000.0]


@register("feat_bin_right_closed", sql_with(BASE_SQL) + """
SELECT o_orderkey, CASE WHEN o_totalprice <= 50000 THEN 0.0 WHEN o_totalprice <= 150000 THEN 1.0
                        WHEN o_totalprice <= 300000 THEN 2.0 WHEN o_totalprice IS NOT NULL THEN 3.0 END AS price_bin,
       CASE WHEN sum_qty <= 50 THEN 0.0 WHEN sum_qty <= 100 THEN 1.0 WHEN sum_qty <= 150 THEN 2.0
            WHEN sum_qty IS NOT NULL THEN 3.0 END AS qty_bin
FROM base""")
def q_feat_bin_right_closed(spark, sf_dir):
    b = base(spark, sf_dir)
    return b.select(ID, fc.bin_right_closed("o_totalprice", _EDGES, [0.0, 1.0, 2.0, 3.0]).alias("price_bin"),
                    fc.bin_right_closed("sum_qty", [50.0, 100.0, 150.0], [0.0, 1.0, 2.0, 3.0]).alias("qty_bin"))


@register("feat_bin_left_closed", sql_with(BASE_SQL) + """
SELECT o_orderkey, CASE WHEN o_totalprice < 50000 THEN 'low' WHEN o_totalprice < 150000 THEN 'mid'
                        WHEN o_totalprice < 300000 THEN 'high' WHEN o_totalprice IS NOT NULL THEN 'top' END AS price_band
FROM base""")
def q_feat_bin_left_closed(spark, sf_dir):
    b = base(spark, sf_dir)
    return b.select(ID, fc.bin_left_closed("o_totalprice", _EDGES, ["low", "mid", "high", "top"]).alias("price_band"))


_INDEX = {"o_totalprice": 0.4, "c_acctbal": 0.3, "sum_qty": 5.0, "n_lines": 10.0}


@register("feat_composites", sql_with(PREPARED_SQL) + """
SELECT o_orderkey,
       """ + rs("c_acctbal * n_lines") + """ AS bal_lines,
       """ + rs("o_totalprice * avg_disc / (n_lines + 0.5)") + """ AS disc_load,
       """ + rs("avg_price * avg_tax / (avg_disc + 0.1)") + """ AS tax_pressure,
       """ + rs(" + ".join(f"CAST({w!r} AS DOUBLE) * {c}" for c, w in _INDEX.items()) + " - 2.0 * avg_disc - sum_qty / 1000.0") + """ AS risk_index,
       """ + rs("o_totalprice + c_acctbal - (sum_qty + n_lines)") + """ AS raw_score,
       """ + rs("n_lines * CAST(CASE o_orderpriority WHEN '1-urgent' THEN 5 WHEN '2-high' THEN 4 WHEN '3-medium' THEN 3 WHEN '4-not specified' THEN 2 ELSE 1 END AS DOUBLE)") + """ AS lines_x_priority
FROM prepared""")
def q_feat_composites(spark, sf_dir):
    from tabrisk.plans.encoding import _PRIORITY_ORD
    p = prepared(spark, sf_dir)
    col = F.col
    risk = fc.weighted_sum(_INDEX) - F.lit(2.0) * col("avg_disc") - col("sum_qty") / F.lit(1000.0)
    return p.select(ID, r(col("c_acctbal") * col("n_lines")).alias("bal_lines"),
                    r(col("o_totalprice") * col("avg_disc") / (col("n_lines") + F.lit(0.5))).alias("disc_load"),
                    r(col("avg_price") * col("avg_tax") / (col("avg_disc") + F.lit(0.1))).alias("tax_pressure"),
                    r(risk).alias("risk_index"),
                    r(col("o_totalprice") + col("c_acctbal") - (col("sum_qty") + col("n_lines"))).alias("raw_score"),
                    r(col("n_lines") * fc.ordinal_map("o_orderpriority", _PRIORITY_ORD, 1).cast("double"))
                    .alias("lines_x_priority"))


_POS = ["o_totalprice", "sum_qty", "n_lines"]
_NEG = ["c_acctbal", "avg_disc"]


def _mm_sql(c: str) -> str:
    return f"(p.{c} - m.mn_{c}) / (m.mx_{c} - m.mn_{c} + 1e-9)"


@register("feat_minmax", sql_with(PREPARED_SQL) + f""",
m AS (SELECT {', '.join(f'min({c}) AS mn_{c}, max({c}) AS mx_{c}' for c in _POS + _NEG)} FROM prepared WHERE is_train = 1)
SELECT p.o_orderkey, {rs(' + '.join(_mm_sql(c) for c in _POS) + ' - ' + ' - '.join(_mm_sql(c) for c in _NEG))} AS health_score,
       {rs(_mm_sql('o_totalprice'))} AS mm_o_totalprice
FROM prepared p, m""")
def q_feat_minmax(spark, sf_dir):
    p = prepared(spark, sf_dir)
    mm = fit_minmax(p.where(F.col("is_train") == 1), _POS + _NEG)
    out = composite_minmax_score(p, _POS, _NEG, name="health_score", eps=1e-9, fitted=mm)
    lo, hi = mm["o_totalprice"]
    return out.select(ID, r("health_score").alias("health_score"),
                      r((F.col("o_totalprice") - F.lit(lo)) / (F.lit(hi) - F.lit(lo) + F.lit(1e-9))).alias("mm_o_totalprice"))


@register("round_half_even", """
SELECT l_orderkey, l_linenumber, l_quantity / 8 AS x, CAST(round_even(l_quantity / 8, 2) AS DOUBLE) AS x_round
FROM lineitem""")
def q_round_half_even(spark, sf_dir):
    from tabrisk.sources.tables import table
    li = table(spark, sf_dir, "lineitem")
    x = F.col("l_quantity") / F.lit(8)
    return li.select("l_orderkey", "l_linenumber", x.alias("x"), fc.round_half_even(x, 2).alias("x_round"))


@register("run_stamp", """
SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d_%H%M%S') AS run_ts, substring(strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S'), 1, 10) AS run_date
FROM orders""")
def q_run_stamp(spark, sf_dir):
    from tabrisk.sources.tables import table
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", F.date_format("o_orderdate", "yyyyMMdd_HHmmss").alias("run_ts"),
                    F.substring(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), 1, 10).alias("run_date"))
