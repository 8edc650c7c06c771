"""File sources and sinks: CSV with pandas-style NA tokens, stage tables, stamped outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The default missing-value tokens of the pandas CSV reader.
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
             "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType, multi_line: bool = True) -> DataFrame:
    """Header CSV with a declared schema; cells equal to an NA token become NULL in any column.

    RFC 4180 quoting: a quote inside a quoted cell is doubled, cells may hold newlines. Every cell
    is read as text first, so only NA tokens turn into NULL: a row with the wrong number of
    cells, or a cell that isn't of the declared type, fails the read. ``multi_line=False`` lets
    Spark split files that have no newlines inside cells."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    raw = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    df = (spark.read.schema(raw).option("header", True).option("mode", "FAILFAST").option("quote", '"').option("escape", '"')
          .option("multiLine", multi_line).csv(path))
    return df.select(*[F.when(~F.col(f.name).isin(NA_TOKENS), F.col(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields])


def write_csv(df: DataFrame, path: str) -> None:
    """``to_csv(index=False)``: header row, no index, quotes doubled inside quoted cells, white space kept, overwrite."""
    (df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def write_stage(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Parquet stage hand-off (replaces .npy / CSV files between steps)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_stamped(df: DataFrame, base_path: str, stamp_col: str = "run_ts") -> None:
    """Prediction file under ``base_path/run_ts=<yyyyMMdd_HHmmss>/`` for the current run."""
    (df.withColumn(stamp_col, F.date_format(F.current_timestamp(), "yyyyMMdd_HHmmss"))
     .write.mode("append").partitionBy(stamp_col).option("header", True).option("escape", '"').csv(base_path))
