"""Exact positions and exact quantiles without funnelling a group into one task.

``Window.partitionBy(k).orderBy(o)`` puts every row of a key into one task; with a
class or a category holding a third of all rows that is a third of the table on one
core. ``exact_row_number`` instead range-partitions on ``(k, o)`` so a hot key is
spread over many partitions, counts rows per (partition, key) (a table with at most
``partitions + keys`` rows), turns the counts into per-partition offsets, and adds a
partition-local row number. The result equals ``row_number()`` over the window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabrisk.operators.joins import join_small
from tabrisk.session import checkpoint_dir


def _order_col(o: str | Column) -> Column:
    return F.col(o).asc() if isinstance(o, str) else o


def exact_row_number(df: DataFrame, order: Sequence[str | Column], by: Sequence[str] = (),
                     name: str = "rn", total: str | None = None,
                     num_partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 1-based row number within ``by`` ordered by ``order``.

    ``order`` should end in a unique tie-breaker for a deterministic result.
    ``total`` (optional) adds the group size as a column.
    """
    spark = df.sparkSession
    by = list(by)
    order_cols = [_order_col(o) for o in order]
    # The partition id must be identical for the counting pass and the numbering pass;
    # range bounds come from a sample, so the assignment is frozen by a reliable
    # checkpoint (written to spark.checkpoint.dir, survives executor loss).
    checkpoint_dir(spark)
    # The range bounds are sampled from the input in a separate job; keep the input
    # persisted for that job and the shuffle so it is computed once.
    src = df.persist()
    cols = [*[F.col(b).asc() for b in by], *order_cols]
    # Without a number, Spark sizes the partitions from the data.
    ranged = ((src.repartitionByRange(num_partitions, *cols) if num_partitions else src.repartitionByRange(*cols))
              .withColumn("_pid", F.spark_partition_id())
              .checkpoint(eager=True))
    src.unpersist()
    counts = ranged.groupBy("_pid", *by).agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
    keep = ["_pid", *by, "_off"]
    if total:
        offsets = offsets.withColumn("_tot", F.sum("_cnt").over(Window.partitionBy(*by)))
        keep.append("_tot")
    offsets = offsets.select(*keep)
    local = Window.partitionBy("_pid", *by).orderBy(*order_cols)
    numbered = ranged.withColumn("_lrn", F.row_number().over(local))
    out = join_small(numbered, offsets, ["_pid", *by], how="inner", null_safe=bool(by))
    out = out.withColumn(name, (F.col("_off") + F.col("_lrn")).cast("long"))
    if total:
        out = out.withColumnRenamed("_tot", total)
    return out.drop("_pid", "_off", "_lrn")


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    by: Sequence[str] = (), method: str = "exact") -> DataFrame:
    """Linear-interpolated quantiles (pandas ``quantile`` / DuckDB ``quantile_cont``).

    Returns long rows ``(*by, column, p, value)``; NULL and NaN are skipped.
    ``method='exact'``: distinct values are counted, then sorted and numbered by range. ``method='approx'``: ``percentile_approx`` (bounded memory, one pass).
    """
    by = list(by)
    long = (df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols])
            .unpivot(by, list(cols), "column_name", "value"))
    long = long.where(F.col("value").isNotNull() & ~F.isnan("value"))
    keys = [*by, "column_name"]
    plist = [float(p) for p in probs]
    if method == "approx":
        agg = long.groupBy(*keys).agg(
            F.percentile_approx("value", F.array(*[F.lit(p) for p in plist]), 100000).alias("_q"))
        return (agg.select(*keys, F.posexplode("_q").alias("_i", "value"))
                .withColumn("p", F.element_at(F.array(*[F.lit(p) for p in plist]), F.col("_i") + 1))
                .select(*keys, "p", "value"))
    # Copies of a value are counted before anything is sorted: a frequent value is one row.
    counts = long.groupBy(*keys, F.when(F.col("value") == 0, 0.0).otherwise(F.col("value")).alias("value")).agg(F.count(F.lit(1)).alias("_c"))
    checkpoint_dir(df.sparkSession)
    ranged = (counts.repartitionByRange(*[F.col(k).asc() for k in keys], F.col("value").asc())
              .withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True))
    per_part = ranged.groupBy("_pid", *keys).agg(F.sum("_c").alias("_cnt"))
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select("_pid", *keys, F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"),
                              F.sum("_cnt").over(Window.partitionBy(*keys)).alias("_n"))
    inside = Window.partitionBy("_pid", *keys).orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = join_small(ranged.withColumn("_upto", F.sum("_c").over(inside)), offsets, ["_pid", *keys], how="inner", null_safe=True)
    # The value holds the positions first..last of its key's sorted rows.
    last = F.col("_off") + F.col("_upto")
    first = last - F.col("_c") + 1
    parr = F.array(*[F.lit(p) for p in plist])
    h = lambda p: (F.col("_n") - 1).cast("double") * p
    holds = lambda pos: (first <= pos) & (pos <= last)
    pick = F.filter(parr, lambda p: holds(F.floor(h(p)) + 1) | holds(F.ceil(h(p)) + 1))
    sel = (ranked.withColumn("_first", first).withColumn("_last", last).withColumn("_sel", pick).where(F.size("_sel") > 0)
           .select(*keys, "_first", "_last", "_n", "value", F.explode("_sel").alias("p")))
    hp = (F.col("_n") - 1).cast("double") * F.col("p")
    at = lambda pos: F.max(F.when((F.col("_first") <= pos) & (pos <= F.col("_last")), F.col("value")))
    agg = sel.groupBy(*keys, "p").agg(F.first(hp).alias("_h"), at(F.floor(hp) + 1).alias("_lo"), at(F.ceil(hp) + 1).alias("_hi"))
    frac = F.col("_h") - F.floor("_h")
    return agg.select(*keys, "p", (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * frac).alias("value"))


def quantile_wide(q_long: DataFrame, keys: Sequence[str], names: dict[float, str]) -> DataFrame:
    """Pivot ``(keys, p, value)`` into one column per probability (names: p → column)."""
    return q_long.groupBy(*keys).agg(
        *[F.max(F.when(F.col("p") == F.lit(float(p)), F.col("value"))).alias(n) for p, n in names.items()])
