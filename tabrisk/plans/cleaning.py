"""Cleaning, projection and schema queries (B*, C1–C7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabrisk.functions.columns import coerce_double
from tabrisk.operators import clean
from tabrisk.operators.encode import align_columns
from tabrisk.operators.ranking import exact_row_number
from tabrisk.spec import numeric_columns
from tabrisk.plans.common import CAT, ID, LABEL, NUM, PREPARED_SQL, prepared, r, rs, sql_with
from tabrisk.plans.registry import register
from tabrisk.sources.tables import BASE_SQL, base, table

_STRIP = "regexp_replace({}, '^\\s+|\\s+$', '', 'g')"


def _strip(c: str) -> str:
    return _STRIP.format(c)


@register("normalize_script", sql_with(BASE_SQL) + f"""
SELECT o_orderkey, coalesce(lower({_strip('o_orderpriority')}), 'nan') AS o_orderpriority,
       coalesce(lower({_strip('c_mktsegment')}), 'nan') AS c_mktsegment FROM base""")
def q_normalize_script(spark, sf_dir):
    return clean.normalize_script(base(spark, sf_dir), CAT).select(ID, *CAT)


@register("normalize_notebook", sql_with(PREPARED_SQL) + """
SELECT o_orderkey, o_orderpriority, c_mktsegment FROM prepared""")
def q_normalize_notebook(spark, sf_dir):
    return prepared(spark, sf_dir).select(ID, *CAT)


_IMP = ["n_lines", "sum_qty", "avg_price", "avg_disc", "avg_tax"]


def _impute_sql(where: str) -> str:
    med = ", ".join(f"median({c}) AS {c}" for c in _IMP)
    sel = ", ".join(rs(f"coalesce(b.{c}, m.{c})") + f" AS {c}" for c in _IMP)
    return sql_with(BASE_SQL) + f""",
m AS (SELECT {med} FROM base {where})
SELECT b.o_orderkey, b.is_train, {sel} FROM base b, m"""


def _impute_spark(spark, sf_dir, train_only: bool):
    df = base(spark, sf_dir)
    imp = clean.fit_imputer(df, _IMP, where=(F.col("is_train") == 1) if train_only else None)
    return imp.apply(df).select(ID, "is_train", *[r(c).alias(c) for c in _IMP])


@register("impute_median_fit_apply", _impute_sql("WHERE is_train = 1"))
def q_impute_median_fit_apply(spark, sf_dir):
    return _impute_spark(spark, sf_dir, True)


@register("impute_median_stacked", _impute_sql(""))
def q_impute_median_stacked(spark, sf_dir):
    return _impute_spark(spark, sf_dir, False)


@register("impute_mode", sql_with(BASE_SQL) + """,
m AS (SELECT o_orderpriority AS mode_value, count(*) AS freq FROM base
      WHERE is_train = 1 AND o_orderpriority IS NOT NULL
      GROUP BY o_orderpriority ORDER BY count(*) DESC, o_orderpriority LIMIT 1)
SELECT b.o_orderkey, coalesce(b.o_orderpriority, m.mode_value) AS o_orderpriority,
       CAST(b.o_orderpriority IS NULL AS INTEGER) AS was_null
FROM base b, m""")
def q_impute_mode(spark, sf_dir):
    df = base(spark, sf_dir)
    imp = clean.fit_imputer(df, [], ["o_orderpriority"], where=F.col("is_train") == 1)
    return imp.apply(df.withColumn("was_null", F.col("o_orderpriority").isNull().cast("int"))).select(
        ID, "o_orderpriority", "was_null")


@register("dedup_rows", "SELECT DISTINCT text, lang, source FROM documents")
def q_dedup_rows(spark, sf_dir):
    return clean.dedup_rows(table(spark, sf_dir, "documents").select("text", "lang", "source"))


@register("dedup_keep_first", """
SELECT d.doc_id, d.text, d.lang, d.source
FROM documents d JOIN (SELECT text, min(doc_id) AS doc_id FROM documents GROUP BY text) f ON d.doc_id = f.doc_id""")
def q_dedup_keep_first(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return clean.dedup_keep_first(docs, ["text"], "doc_id").select("doc_id", "text", "lang", "source")


@register("coerce_numeric", """
SELECT p_partkey,
       coalesce(CASE WHEN isnan(TRY_CAST(p_name AS DOUBLE)) THEN NULL ELSE TRY_CAST(p_name AS DOUBLE) END, 0.0) AS name_num,
       coalesce(CASE WHEN isnan(TRY_CAST(substring(p_brand, 7) AS DOUBLE)) THEN NULL
                     ELSE TRY_CAST(substring(p_brand, 7) AS DOUBLE) END, 0.0) AS brand_num,
       coalesce(TRY_CAST(CAST(p_size AS VARCHAR) AS DOUBLE), 0.0) AS size_num,
       coalesce(TRY_CAST(CAST(p_retailprice AS VARCHAR) AS DOUBLE), 0.0) AS price_num
FROM part""")
def q_coerce_numeric(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", coerce_double("p_name").alias("name_num"),
                    coerce_double(F.expr("substring(p_brand, 7)")).alias("brand_num"),
                    coerce_double("p_size").alias("size_num"), coerce_double("p_retailprice").alias("price_num"))


@register("coerce_numeric_json", """
SELECT event_id, coalesce(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE), 0.0) AS k_num,
       coalesce(TRY_CAST(props AS DOUBLE), 0.0) AS props_num
FROM events""")
def q_coerce_numeric_json(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select("event_id", coerce_double(F.get_json_object("props", "$.k")).alias("k_num"),
                    coerce_double("props").alias("props_num"))


_TYPED = [c for c in NUM] + ["is_train"]


@register("select_by_type", sql_with(BASE_SQL) + f"""
SELECT {', '.join(rs(c) + f' AS {c}' for c in NUM)}, is_train FROM base""")
def q_select_by_type(spark, sf_dir):
    df = base(spark, sf_dir).drop(ID, LABEL)  # drop ignores absent names, like errors='ignore'
    cols = numeric_columns(df)
    return df.select(*[r(c).alias(c) if c != "is_train" else F.col(c) for c in cols])


@register("stack_train_test", sql_with(BASE_SQL) + """
SELECT o_orderkey, o_orderstatus, o_totalprice, 1 AS is_train FROM base WHERE is_train = 1
UNION ALL
SELECT o_orderkey, CAST(NULL AS VARCHAR) AS o_orderstatus, o_totalprice, 0 AS is_train FROM base WHERE is_train = 0""")
def q_stack_train_test(spark, sf_dir):
    b = base(spark, sf_dir)
    train = b.where(F.col("is_train") == 1).select(ID, LABEL, "o_totalprice")
    test = b.where(F.col("is_train") == 0).select(ID, "o_totalprice")
    stacked = (train.withColumn("is_train", F.lit(1))
               .unionByName(test.withColumn("is_train", F.lit(0)), allowMissingColumns=True))
    return stacked.select(ID, LABEL, "o_totalprice", "is_train")


_ALIGN = ["o_totalprice", "c_acctbal", "missing_feature_a", "sum_qty", "missing_feature_b"]


@register("align_columns", sql_with(BASE_SQL) + """
SELECT o_orderkey, o_totalprice, c_acctbal, CAST(0.0 AS DOUBLE) AS missing_feature_a,
       """ + rs("sum_qty") + """ AS sum_qty, CAST(0.0 AS DOUBLE) AS missing_feature_b FROM base""")
def q_align_columns(spark, sf_dir):
    a = align_columns(base(spark, sf_dir), _ALIGN, keep=[ID])
    return a.withColumn("sum_qty", r("sum_qty"))


@register("head_tail", sql_with(BASE_SQL) + """
SELECT * FROM (SELECT 'head' AS part, o_orderkey, o_orderstatus FROM base ORDER BY o_orderkey LIMIT 5)
UNION ALL
SELECT * FROM (SELECT 'tail' AS part, o_orderkey, o_orderstatus FROM base ORDER BY o_orderkey DESC LIMIT 5)""")
def q_head_tail(spark, sf_dir):
    b = base(spark, sf_dir).select(ID, LABEL)
    head = b.orderBy(ID).limit(5).select(F.lit("head").alias("part"), ID, LABEL)
    tail = b.orderBy(F.desc(ID)).limit(5).select(F.lit("tail").alias("part"), ID, LABEL)
    return head.unionByName(tail)


@register("fallback_row_id", """
SELECT CAST(row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 AS BIGINT) AS row_id,
       l_orderkey, l_linenumber, l_partkey, l_suppkey
FROM lineitem""")
def q_fallback_row_id(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    numbered = exact_row_number(li, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], name="rn")
    return numbered.select((F.col("rn") - 1).alias("row_id"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@register("dropna_subset", sql_with(BASE_SQL) + """
SELECT o_orderkey, o_orderpriority, n_lines FROM base WHERE o_orderpriority IS NOT NULL AND n_lines IS NOT NULL""")
def q_dropna_subset(spark, sf_dir):
    return base(spark, sf_dir).na.drop(subset=["o_orderpriority", "n_lines"]).select(ID, "o_orderpriority", "n_lines")


_ENGINEERED = {"price_per_line": ("o_totalprice", "n_lines", 1.0), "qty_per_line": ("sum_qty", "n_lines", 1.0)}


@register("feature_catalog", sql_with(BASE_SQL) + """
SELECT column_name, origin, CAST(non_null AS BIGINT) AS non_null FROM (
""" + "\nUNION ALL\n".join(
    [f"SELECT '{c}' AS column_name, 'raw' AS origin, count({c}) AS non_null FROM base" for c in
     [ID, LABEL, "o_orderpriority", "c_mktsegment", *NUM, "is_train"]]
    + [f"SELECT '{n}' AS column_name, 'engineered' AS origin, count({a} / ({b} + 1.0)) AS non_null FROM base"
       for n, (a, b, _) in _ENGINEERED.items()]) + ")")
def q_feature_catalog(spark, sf_dir):
    from tabrisk.functions.columns import guarded_ratio
    b = base(spark, sf_dir)
    raw_cols = b.columns
    f = b.withColumns({n: guarded_ratio(a, d, eps) for n, (a, d, eps) in _ENGINEERED.items()})
    cols = f.columns
    wide = f.agg(*[F.count(c).alias(c) for c in cols])
    origin = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit("raw" if c in raw_cols else "engineered"))])
    long = wide.unpivot([], cols, "column_name", "non_null")
    return long.select("column_name", origin[F.col("column_name")].alias("origin"), F.col("non_null").cast("long"))
