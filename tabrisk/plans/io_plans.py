"""Scan / sink queries (A1–A3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabrisk.plans.registry import register
from tabrisk.session import scratch_path
from tabrisk.sources import files, quoted_csv
from tabrisk.sources.tables import table


@register("scan_csv_roundtrip", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def q_scan_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "nation_csv")
    files.write_csv(table(spark, sf_dir, "nation"), path)
    return files.read_csv(spark, path, "n_nationkey int, n_name string, n_regionkey int")


@register("scan_csv_customer", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def q_scan_csv_customer(spark, sf_dir):
    path = scratch_path(spark, "customer_csv")
    files.write_csv(table(spark, sf_dir, "customer"), path)
    return files.read_csv(spark, path, "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                                       "c_mktsegment string")


_NA = ["", "NA", "NaN", "null", "n/a", "-nan", "<NA>", "None"]


@register("csv_quoted_na", """
WITH s AS (SELECT doc_id, 'say "' || text || '", ok' || chr(10) || 'line 2, ' || coalesce(lang, '') AS note,
  CASE WHEN doc_id % 9 = 0 THEN NULL ELSE 'v' || doc_id END AS tag, CASE WHEN doc_id % 7 < 3 THEN NULL ELSE n_chars * 0.5 END AS half FROM documents)
SELECT doc_id, note, tag, half FROM s""")
def q_csv_quoted_na(spark, sf_dir):
    """Cells with quotes, commas and newlines, and NA tokens in text and number columns, written and read back."""
    path = scratch_path(spark, "quoted_csv")
    tokens = F.array(*[F.lit(t) for t in _NA])
    na = F.element_at(tokens, (F.col("doc_id") % len(_NA) + 1).cast("int"))
    note = F.concat(F.lit('say "'), F.col("text"), F.lit('", ok\nline 2, '), F.coalesce("lang", F.lit("")))
    files.write_csv(table(spark, sf_dir, "documents").select(
        "doc_id", note.alias("note"), F.when(F.col("doc_id") % 9 == 0, na).otherwise(F.concat(F.lit("v"), F.col("doc_id").cast("string"))).alias("tag"),
        F.when(F.col("doc_id") % 7 < 3, na).otherwise((F.col("n_chars") * 0.5).cast("string")).alias("half")), path)
    return files.read_csv(spark, path, "doc_id bigint, note string, tag string, half double")


_NA_SQL = ", ".join(f"'{t}'" for t in files.NA_TOKENS)


@register("csv_quoted_text", f"""
SELECT doc_id, CASE WHEN text NOT IN ({_NA_SQL}) THEN text END AS text, 'say "' || text || '", ok' || chr(10) || 'line 2, ' || coalesce(lang, '') AS note
FROM documents""")
def q_csv_quoted_text(spark, sf_dir):
    """Every text whole, as a cell of its own and between quotes, commas and newlines, written and read back."""
    path = scratch_path(spark, "quoted_text_csv")
    note = F.concat(F.lit('say "'), "text", F.lit('", ok\nline 2, '), F.coalesce("lang", F.lit("")))
    files.write_csv(table(spark, sf_dir, "documents").select("doc_id", "text", note.alias("note")), path)
    return files.read_csv(spark, path, "doc_id bigint, text string, note string")


@register("csv_quoted_split", f"""
SELECT doc_id, CASE WHEN text NOT IN ({_NA_SQL}) THEN text END AS text, 'say "' || text || '", ok' || chr(10) || 'line 2, ' || coalesce(lang, '') AS note
FROM documents""")
def q_csv_quoted_split(spark, sf_dir):
    """The same cells, read by as many tasks as the files have splits."""
    path = scratch_path(spark, "quoted_split_csv")
    note = F.concat(F.lit('say "'), "text", F.lit('", ok\nline 2, '), F.coalesce("lang", F.lit("")))
    files.write_csv(table(spark, sf_dir, "documents").select("doc_id", "text", note.alias("note")), path)
    return quoted_csv.read_quoted(spark, path, "doc_id bigint, text string, note string")


@register("scan_csv_inferred", """
SELECT o_orderkey::BIGINT AS o_orderkey, o_orderstatus, o_totalprice::DOUBLE AS o_totalprice,
  (CASE WHEN o_orderkey % 3 > 0 THEN o_custkey END)::DOUBLE AS some_key, o_totalprice > 100000 AS high, NULL::DOUBLE AS nothing,
  CASE WHEN o_orderkey % 5 > 0 THEN CAST(o_orderkey AS VARCHAR) ELSE 'no key' END AS mixed FROM orders""")
def q_scan_csv_inferred(spark, sf_dir):
    """Columns of every kind, written as text and typed from their cells: whole numbers, numbers, missing cells, truth values, text."""
    path = scratch_path(spark, "inferred_csv")
    key = F.col("o_orderkey")
    files.write_csv(table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", F.when(key % 3 > 0, F.col("o_custkey")).alias("some_key"),
        F.when(F.col("o_totalprice") > 100000, "True").otherwise("False").alias("high"), F.lit(None).cast("string").alias("nothing"),
        F.when(key % 5 > 0, key.cast("string")).otherwise("no key").alias("mixed")), path)
    return quoted_csv.read_inferred(spark, path)


@register("scan_ids", "SELECT o_orderkey FROM orders")
def q_scan_ids(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey")
