"""Profiling queries (G*, C8–C12) on the bound order table and the driver tables."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tabrisk.operators import clean, profile
from tabrisk.plans.common import CAT, ID, LABEL, NUM, PREPARED_SQL, bound, prepared, r, rs, sql_with
from tabrisk.plans.registry import register
from tabrisk.sources.tables import BASE_SQL, base, table

BASE_COLS = [ID, LABEL, "o_orderpriority", "c_mktsegment", *NUM, "is_train"]


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# --- C9 missing report -------------------------------------------------------
_MISSING_SQL = sql_with(BASE_SQL) + f""",
t AS (SELECT count(*) AS n, {', '.join(f'count(*) - count({c}) AS {c}' for c in BASE_COLS)} FROM base),
l AS ({_union([f"SELECT '{c}' AS column_name, CAST({c} AS BIGINT) AS missing, n FROM t" for c in BASE_COLS])})
SELECT column_name, missing, {rs('missing * 100.0 / n', 2)} AS pct FROM l WHERE missing > 0"""


@register("missing_report", _MISSING_SQL)
def q_missing_report(spark, sf_dir):
    return clean.missing_report(base(spark, sf_dir))


# --- C8 duplicate count (documents without their id) --------------------------
@register("duplicate_count", """
SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(count(*) AS BIGINT) AS distinct_rows,
       CAST(sum(n - 1) AS BIGINT) AS duplicates
FROM (SELECT text, lang, source, n_chars, count(*) AS n FROM documents GROUP BY text, lang, source, n_chars)""")
def q_duplicate_count(spark, sf_dir):
    return clean.duplicate_count(table(spark, sf_dir, "documents").drop("doc_id"))


# --- C10 / G1 quality snapshot: raw vs cleaned -------------------------------
def _snapshot_sql(rel: str, name: str, cols: list[str]) -> str:
    nulls = " + ".join(f"(count(*) - count({c}))" for c in cols)
    return (f"SELECT '{name}' AS table_name, CAST(count(*) AS BIGINT) AS rows, {len(cols)} AS n_columns, "
            f"CAST({nulls} AS BIGINT) AS missing_cells, "
            f"CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(cols)} FROM {rel})) AS BIGINT) AS duplicates "
            f"FROM {rel}")


_SNAP_COLS = [c for c in BASE_COLS if c != ID]


@register("quality_snapshot", sql_with(PREPARED_SQL) + "\n" + _union(
    [_snapshot_sql("base", "raw", _SNAP_COLS), _snapshot_sql("prepared", "clean", _SNAP_COLS)]))
def q_quality_snapshot(spark, sf_dir):
    b = bound(spark, sf_dir)
    raw = clean.quality_snapshot(b.select(*_SNAP_COLS), "raw")
    cl = clean.quality_snapshot(prepared(spark, sf_dir, b).select(*_SNAP_COLS), "clean")
    return raw.unionByName(cl).withColumn("n_columns", F.col("n_columns").cast("int"))


# --- C11 zero-null expectation: violations on the raw table -------------------
@register("expect_no_nulls", sql_with(BASE_SQL) + f""",
t AS (SELECT {', '.join(f'count(*) - count({c}) AS {c}' for c in BASE_COLS)} FROM base)
SELECT column_name, n_null FROM ({_union([f"SELECT '{c}' AS column_name, CAST({c} AS BIGINT) AS n_null FROM t" for c in BASE_COLS])})
WHERE n_null > 0""")
def q_expect_no_nulls(spark, sf_dir):
    return clean.expect_no_nulls(base(spark, sf_dir))


# --- C12 null pattern ---------------------------------------------------------
_PATTERN_COLS = ["o_orderpriority", "n_lines", "sum_qty", "avg_price"]


@register("missing_pattern", sql_with(BASE_SQL) + f"""
SELECT {' || '.join(f'CAST(CAST({c} IS NULL AS INTEGER) AS VARCHAR)' for c in _PATTERN_COLS)} AS pattern,
       CAST(count(*) AS BIGINT) AS n
FROM base GROUP BY 1""")
def q_missing_pattern(spark, sf_dir):
    return clean.missing_pattern(base(spark, sf_dir), _PATTERN_COLS)


# --- G2 / G7 numeric describe -------------------------------------------------
@register("describe_numeric", sql_with(BASE_SQL) + "\n" + _union([f"""
SELECT '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS count, {rs(f'avg({c})')} AS mean,
       {rs(f'stddev_samp({c})')} AS std, {rs(f'CAST(min({c}) AS DOUBLE)')} AS min,
       {rs(f'CAST(max({c}) AS DOUBLE)')} AS max,
       {rs(f'quantile_cont({c}, 0.25)')} AS p25, {rs(f'quantile_cont({c}, 0.5)')} AS p50,
       {rs(f'quantile_cont({c}, 0.75)')} AS p75
FROM base""" for c in NUM]))
def q_describe_numeric(spark, sf_dir):
    d = profile.describe_numeric(base(spark, sf_dir), NUM)
    return d.select("column_name", F.col("count").cast("long"),
                    *[r(c).alias(c) for c in ["mean", "std", "min", "max", "p25", "p50", "p75"]])


# --- NaN is missing -----------------------------------------------------------
_NAN_SQL = """
WITH s AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_totalprice END AS price,
                  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_custkey AS DOUBLE) END AS cust FROM orders),
q AS (SELECT quantile_cont(price, 0.25) AS p1, quantile_cont(price, 0.75) AS p3, quantile_cont(cust, 0.25) AS c1, quantile_cont(cust, 0.75) AS c3 FROM s)
""" + _union([f"""
SELECT '{c}' AS column_name, CAST(count(*) - count({c}) AS BIGINT) AS missing, CAST(count({c}) AS BIGINT) AS count, {rs(f'avg({c})', 2)} AS mean,
       {rs(f'max({c})', 2)} AS max, {rs(f'quantile_cont({c}, 0.5)', 2)} AS p50,
       CAST(count(*) FILTER (WHERE {c} < {k}1 - 1.5 * ({k}3 - {k}1) OR {c} > {k}3 + 1.5 * ({k}3 - {k}1)) AS BIGINT) AS n_outliers
FROM s, q""" for c, k in (("price", "p"), ("cust", "c"))])


@register("nan_profile", _NAN_SQL)
def q_nan_profile(spark, sf_dir):
    """Missing counts, describe and outliers of columns with NaN put in by key."""
    nan = F.lit(float("nan"))
    s = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 11 == 0, nan).otherwise(F.col("o_totalprice")).alias("price"),
        F.when(F.col("o_orderkey") % 4 == 0, nan).otherwise(F.col("o_custkey").cast("double")).alias("cust"))
    d = profile.describe_numeric(s, ["price", "cust"])
    out = profile.iqr_outliers(s, ["price", "cust"]).select("column_name", "n_outliers")
    miss = clean.null_counts(s).select("column_name", F.col("n_null").cast("long").alias("missing"))
    return (d.join(out, "column_name").join(miss, "column_name")
            .select("column_name", "missing", F.col("count").cast("long"), r("mean", 2).alias("mean"), r("max", 2).alias("max"), r("p50", 2).alias("p50"), "n_outliers"))


# --- G3 categorical describe --------------------------------------------------
_DESC_CAT = ["o_orderpriority", "c_mktsegment", LABEL]


@register("describe_categorical", sql_with(BASE_SQL) + "\n" + _union([f"""
SELECT '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS count, CAST(count(DISTINCT {c}) AS BIGINT) AS "unique",
       (SELECT {c} FROM base WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS top,
       (SELECT CAST(count(*) AS BIGINT) FROM base WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS freq
FROM base""" for c in _DESC_CAT]))
def q_describe_categorical(spark, sf_dir):
    d = profile.describe_categorical(base(spark, sf_dir), _DESC_CAT)
    return d.select("column_name", F.col("count").cast("long"), F.col("unique").cast("long"), "top",
                    F.col("freq").cast("long"))


# --- G4 / G5 / G6 / D23 class distribution -----------------------------------
@register("class_distribution", sql_with(BASE_SQL) + f"""
SELECT o_orderstatus,
       CAST(CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 WHEN 'P' THEN 2 END AS INTEGER) AS label_code,
       CAST(count(*) AS BIGINT) AS n, {rs('count(*) * 100.0 / sum(count(*)) OVER ()', 2)} AS pct
FROM base WHERE o_orderstatus IS NOT NULL GROUP BY o_orderstatus""")
def q_class_distribution(spark, sf_dir):
    from tabrisk.sources.tables import CLASSES
    vc = profile.value_counts(base(spark, sf_dir), LABEL)
    code = F.array_position(F.array(*[F.lit(c) for c in CLASSES]), F.col(LABEL)) - 1
    return vc.select(LABEL, code.cast("int").alias("label_code"), F.col("n").cast("long"),
                     r("pct", 2).alias("pct"))


# --- G9 / G10 / B5 IQR outliers ----------------------------------------------
_IQR_COLS = NUM


@register("iqr_outliers", sql_with(BASE_SQL) + ",\n" + ",\n".join(f"""
q_{c} AS (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM base)""" for c in _IQR_COLS)
    + "\n" + _union([f"""
SELECT '{c}' AS column_name, {rs('q.q1')} AS q1, {rs('q.q3')} AS q3, {rs('q.q3 - q.q1')} AS iqr,
       {rs('q.q1 - 1.5 * (q.q3 - q.q1)')} AS lower, {rs('q.q3 + 1.5 * (q.q3 - q.q1)')} AS upper,
       CAST(count(*) FILTER (WHERE b.{c} < q.q1 - 1.5 * (q.q3 - q.q1) OR b.{c} > q.q3 + 1.5 * (q.q3 - q.q1)) AS BIGINT) AS n_outliers,
       {rs(f'count(*) FILTER (WHERE b.{c} < q.q1 - 1.5 * (q.q3 - q.q1) OR b.{c} > q.q3 + 1.5 * (q.q3 - q.q1)) * 100.0 / count(*)')} AS pct,
       CAST(count(*) FILTER (WHERE b.{c} < q.q1 - 1.5 * (q.q3 - q.q1) OR b.{c} > q.q3 + 1.5 * (q.q3 - q.q1)) * 100.0 / count(*) > 5 AS INTEGER) AS is_flagged
FROM base b, q_{c} q GROUP BY q.q1, q.q3""" for c in _IQR_COLS]))
def q_iqr_outliers(spark, sf_dir):
    d = profile.iqr_outliers(base(spark, sf_dir), _IQR_COLS)
    return d.select("column_name", *[r(c).alias(c) for c in ["q1", "q3", "iqr", "lower", "upper"]],
                    "n_outliers", r("pct").alias("pct"), F.col("is_flagged").cast("int"))


# --- G11 histogram (events.value, 40 bins) -----------------------------------
@register("histogram_bins", """
WITH rg AS (SELECT min(value) AS mn, max(value) AS mx FROM events WHERE value IS NOT NULL AND NOT isnan(value)),
b AS (SELECT CAST(CASE WHEN rg.mx = rg.mn THEN 1
                  ELSE least(CAST(floor((e.value - rg.mn) * 40 / (rg.mx - rg.mn)) AS BIGINT) + 1, 40) END AS INTEGER) AS bin
      FROM events e, rg WHERE e.value IS NOT NULL AND NOT isnan(e.value)),
c AS (SELECT bin, count(*) AS n FROM b GROUP BY bin),
g AS (SELECT CAST(range AS INTEGER) AS bin FROM range(1, 41))
SELECT g.bin, """ + rs("rg.mn + (g.bin - 1) * ((rg.mx - rg.mn) / 40)") + """ AS bin_lo,
       """ + rs("rg.mn + g.bin * ((rg.mx - rg.mn) / 40)") + """ AS bin_hi,
       CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM g CROSS JOIN rg LEFT JOIN c ON c.bin = g.bin""")
def q_histogram_bins(spark, sf_dir):
    h = profile.histogram_bins(table(spark, sf_dir, "events"), "value", bins=40)
    return h.select("bin", r("bin_lo").alias("bin_lo"), r("bin_hi").alias("bin_hi"), "n")


# --- G17 per-class histogram (o_totalprice by status, 20 bins) ---------------
@register("histogram_by_class", sql_with(BASE_SQL) + """,
rg AS (SELECT min(o_totalprice) AS mn, max(o_totalprice) AS mx FROM base WHERE o_totalprice IS NOT NULL),
b AS (SELECT o_orderstatus, CAST(CASE WHEN rg.mx = rg.mn THEN 1
                  ELSE least(CAST(floor((x.o_totalprice - rg.mn) * 20 / (rg.mx - rg.mn)) AS BIGINT) + 1, 20) END AS INTEGER) AS bin
      FROM base x, rg WHERE x.o_totalprice IS NOT NULL),
c AS (SELECT o_orderstatus, bin, count(*) AS n FROM b GROUP BY o_orderstatus, bin),
g AS (SELECT s.o_orderstatus, CAST(range AS INTEGER) AS bin FROM (SELECT DISTINCT o_orderstatus FROM b) s, range(1, 21))
SELECT g.o_orderstatus, g.bin, """ + rs("rg.mn + (g.bin - 1) * ((rg.mx - rg.mn) / 20)") + """ AS bin_lo,
       """ + rs("rg.mn + g.bin * ((rg.mx - rg.mn) / 20)") + """ AS bin_hi,
       CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM g CROSS JOIN rg LEFT JOIN c ON c.bin = g.bin AND c.o_orderstatus IS NOT DISTINCT FROM g.o_orderstatus""")
def q_histogram_by_class(spark, sf_dir):
    h = profile.histogram_bins(base(spark, sf_dir), "o_totalprice", bins=20, by=LABEL)
    return h.select(LABEL, "bin", r("bin_lo").alias("bin_lo"), r("bin_hi").alias("bin_hi"), "n")


# --- G12 box-plot statistics per class ---------------------------------------
@register("boxplot_stats", sql_with(BASE_SQL) + """,
q AS (SELECT o_orderstatus, min(o_totalprice) AS mn, quantile_cont(o_totalprice, 0.25) AS q1,
             quantile_cont(o_totalprice, 0.5) AS med, quantile_cont(o_totalprice, 0.75) AS q3,
             max(o_totalprice) AS mx
      FROM base WHERE o_totalprice IS NOT NULL GROUP BY o_orderstatus)
SELECT q.o_orderstatus, """ + ", ".join(rs(e) + f" AS {a}" for e, a in [
    ("q.mn", "min"), ("q.q1", "q1"), ("q.med", "median"), ("q.q3", "q3"), ("q.mx", "max"), ("q.q3 - q.q1", "iqr")]) + """,
       CAST(count(*) AS BIGINT) AS n,
       """ + rs("min(b.o_totalprice) FILTER (WHERE b.o_totalprice >= q.q1 - 1.5 * (q.q3 - q.q1))") + """ AS whisker_lo,
       """ + rs("max(b.o_totalprice) FILTER (WHERE b.o_totalprice <= q.q3 + 1.5 * (q.q3 - q.q1))") + """ AS whisker_hi,
       CAST(count(*) FILTER (WHERE b.o_totalprice < q.q1 - 1.5 * (q.q3 - q.q1)
                              OR b.o_totalprice > q.q3 + 1.5 * (q.q3 - q.q1)) AS BIGINT) AS n_outliers
FROM base b JOIN q ON b.o_orderstatus = q.o_orderstatus
WHERE b.o_totalprice IS NOT NULL
GROUP BY q.o_orderstatus, q.mn, q.q1, q.med, q.q3, q.mx""")
def q_boxplot_stats(spark, sf_dir):
    d = profile.boxplot_stats(base(spark, sf_dir), "o_totalprice", LABEL)
    return d.select(LABEL, *[r(c).alias(c) for c in ["min", "q1", "median", "q3", "max", "iqr"]],
                    F.col("n").cast("long"), r("whisker_lo").alias("whisker_lo"),
                    r("whisker_hi").alias("whisker_hi"), F.col("n_outliers").cast("long"))


# --- G13 contingency ----------------------------------------------------------
@register("contingency", sql_with(BASE_SQL) + """
SELECT c_mktsegment, o_orderstatus, CAST(count(*) AS BIGINT) AS n FROM base GROUP BY c_mktsegment, o_orderstatus""")
def q_contingency(spark, sf_dir):
    return profile.contingency(base(spark, sf_dir), "c_mktsegment", LABEL)


# --- G14 / G15 correlation ----------------------------------------------------
def _corr_sql() -> str:
    parts = []
    for a, b in combinations(NUM, 2):
        parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, {rs(f'corr({a}, {b})')} AS r FROM base")
        parts.append(f"SELECT '{b}' AS col_a, '{a}' AS col_b, {rs(f'corr({a}, {b})')} AS r FROM base")
    parts += [f"SELECT '{c}' AS col_a, '{c}' AS col_b, CAST(1.0 AS DOUBLE) AS r" for c in NUM]
    return sql_with(BASE_SQL) + "\n" + _union(parts)


@register("correlation_matrix", _corr_sql())
def q_correlation_matrix(spark, sf_dir):
    cm = profile.correlation_matrix(base(spark, sf_dir), NUM)
    return cm.select("col_a", "col_b", r("r").alias("r"))


def _high_corr_sql() -> str:
    parts = [f"SELECT '{b}' AS col_a, '{a}' AS col_b, corr({a}, {b}) AS r FROM base" for a, b in combinations(NUM, 2)]
    return sql_with(BASE_SQL) + f"\nSELECT col_a, col_b, {rs('r', 3)} AS r FROM ({_union(parts)}) WHERE abs(r) > 0.7"


@register("high_correlation_pairs", _high_corr_sql())
def q_high_correlation_pairs(spark, sf_dir):
    hc = profile.high_correlation_pairs(base(spark, sf_dir), NUM, 0.7)
    return hc.select("col_a", "col_b", r("r", 3).alias("r"))


# --- G18 pair-grid counts -----------------------------------------------------
_PAIR_COLS = ["o_totalprice", "sum_qty", "avg_price", "c_acctbal"]


def _pair_sql() -> str:
    rg = ", ".join(f"min({c}) AS mn_{c}, max({c}) AS mx_{c}" for c in _PAIR_COLS)
    def b(c):
        return (f"CAST(CASE WHEN rg.mx_{c} = rg.mn_{c} THEN 1 ELSE least(CAST(floor((s.{c} - rg.mn_{c}) * 10 / "
                f"(rg.mx_{c} - rg.mn_{c})) AS BIGINT) + 1, 10) END AS INTEGER)")
    parts = [f"SELECT '{a}' AS col_a, '{c}' AS col_b, {b(a)} AS bin_a, {b(c)} AS bin_b FROM s, rg"
             for a, c in combinations(_PAIR_COLS, 2)]
    return sql_with(BASE_SQL) + f""",
s AS (SELECT * FROM base WHERE {' AND '.join(f'{c} IS NOT NULL' for c in _PAIR_COLS)}),
rg AS (SELECT {rg} FROM s)
SELECT col_a, col_b, bin_a, bin_b, CAST(count(*) AS BIGINT) AS n FROM ({_union(parts)}) GROUP BY ALL"""


@register("pair_grid_counts", _pair_sql())
def q_pair_grid_counts(spark, sf_dir):
    return profile.pair_grid_counts(base(spark, sf_dir), _PAIR_COLS, bins=10)


# --- B10 / G19 distinct values ------------------------------------------------
_DIST = ["o_orderpriority", "c_mktsegment", LABEL]


@register("distinct_values", sql_with(BASE_SQL) + "\n" + _union([f"""
SELECT '{c}' AS column_name, v AS value, CAST(count(*) OVER () AS BIGINT) AS n_distinct
FROM (SELECT DISTINCT {c} AS v FROM base WHERE {c} IS NOT NULL)""" for c in _DIST]))
def q_distinct_values(spark, sf_dir):
    b = base(spark, sf_dir)
    parts = []
    for c in _DIST:
        d = b.select(F.col(c).alias("value")).where(F.col("value").isNotNull()).distinct()
        parts.append(d.select(F.lit(c).alias("column_name"), "value"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    counts = out.groupBy("column_name").agg(F.count(F.lit(1)).cast("long").alias("n_distinct"))
    return out.join(F.broadcast(counts), "column_name")  # one row per listed column
