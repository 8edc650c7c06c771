"""Quoted CSV read by many tasks from one file, and column types inferred from cells.

A newline ends a record only outside quotes, so a byte range alone can't tell whether it starts
inside a cell. Files are read as lines, which Spark splits. A first pass counts quotes per split; by their
parity, summed in file order, every split's state at its start is known. A second pass joins the lines of
records inside a split. Only a record that crosses a split's border is put together by a
shuffle: at most two pieces a split.

The state at the start is one flag per split (128 MB of input each), fetched to the driver and sent to the
tasks. Quotes must be as in RFC 4180: only around cells, doubled inside them. Records end
with LF or CR LF; empty records are skipped; each file starts with a header.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabrisk.sources.files import NA_TOKENS

_PIECES = pa.schema([("file", pa.string()), ("start", pa.int64()), ("seq", pa.int64()), ("text", pa.string()), ("after", pa.bool_()), ("open", pa.bool_())])


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.option("lineSep", "\n").text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value"))


def split_states(lines: DataFrame) -> dict[tuple[str, int], bool]:
    """Per (file, split start): does the split start inside quotes?"""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    odd = lines.groupBy("file", "start").agg((F.sum(quotes) % 2 == 1).alias("odd")).collect()
    state, inside = {}, defaultdict(bool)
    for r in sorted(odd, key=lambda r: (r["file"], r["start"])):
        state[r["file"], r["start"]] = inside[r["file"]]
        inside[r["file"]] ^= r["odd"]
    return state


def _segments(b: pa.RecordBatch):
    """Runs of a batch's lines that lie in one split."""
    at = np.asarray(b.column("start"))
    file = b.column("file").dictionary_encode().indices.to_numpy(zero_copy_only=False)
    cut = np.flatnonzero((at[1:] != at[:-1]) | (file[1:] != file[:-1])) + 1
    for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), b.num_rows]):
        yield (b.column("file")[lo].as_py(), int(at[lo])), b.column("value").slice(lo, hi - lo)


def pieces(lines: DataFrame) -> DataFrame:
    """Records and, at split borders, parts of records: (file, start, seq, text, after, open).

    ``after``: the piece goes on from the split before; ``open``: it goes on in the next."""
    state = lines.sparkSession.sparkContext.broadcast(split_states(lines))

    def made(key, seq, texts, after, is_open):
        n = len(texts)
        return pa.RecordBatch.from_arrays([pa.array([key[0]] * n, pa.string()), pa.array([key[1]] * n, pa.int64()), pa.array(np.arange(seq, seq + n)), texts,
                                           pa.array([after] + [False] * (n - 1), pa.bool_()), pa.array([False] * (n - 1) + [is_open], pa.bool_())], schema=_PIECES)

    def run(batches):
        key, held, odd, seq = None, [], False, 0
        for b in batches:
            if not b.num_rows:
                continue
            for here, value in _segments(b):
                if here != key:
                    if held:
                        yield made(key, seq, pa.array(["\n".join(held)]), seq == 0 and state.value[key], True)
                    key, held, seq, odd = here, [], 0, state.value[here]
                quotes = pc.count_substring(value, '"').to_numpy(zero_copy_only=False)
                odd_after = (np.cumsum(quotes) + odd) % 2 == 1
                ends = np.flatnonzero(~odd_after)
                odd = bool(odd_after[-1])
                if len(ends):
                    upto = np.concatenate([[0], ends + 1]).astype(np.int32)
                    texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(upto), value.slice(0, int(upto[-1]))), "\n")
                    if held:
                        texts = pa.concat_arrays([pa.array(["\n".join([*held, texts[0].as_py()])]), texts.slice(1)])
                    yield made(key, seq, texts, seq == 0 and state.value[key], False)
                    seq += len(texts)
                    held = []
                held += value.slice(int(ends[-1]) + 1 if len(ends) else 0).to_pylist()
        if held:
            yield made(key, seq, pa.array(["\n".join(held)]), seq == 0 and state.value[key], True)

    return lines.mapInArrow(run, "file string, start bigint, seq bigint, text string, after boolean, open boolean")


def records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the files under ``path``, headers left out: (text)."""
    got = pieces(_lines(spark, path))
    cell = F.regexp_replace("text", r"\r$", "")
    # The first record of a file is its header, also when it reaches into the next split.
    head = (F.col("start") == 0) & (F.col("seq") == 0)
    part = got.where(F.col("after") | F.col("open"))
    # A record's pieces are numbered without their texts: a file has at most two rows a split here.
    order = Window.partitionBy("file").orderBy("start", "seq")
    chain = part.select("file", "start", "seq", F.sum(F.when(F.col("after"), 0).otherwise(1)).over(order).alias("chain"))
    joined = (part.join(chain, ["file", "start", "seq"]).groupBy("file", "chain")
              .agg(F.array_sort(F.collect_list(F.struct("start", "seq", "text"))).alias("all"))
              .where(~((F.col("all")[0]["start"] == 0) & (F.col("all")[0]["seq"] == 0)))
              .select(F.array_join(F.col("all.text"), "\n").alias("text")))
    whole = got.where(~F.col("after") & ~F.col("open") & ~head).select("text")
    return whole.unionByName(joined).select(cell.alias("text")).where(F.col("text") != "")


def header(spark: SparkSession, path: str) -> list[str]:
    """Column names of the first file that has any, by Spark's own reader."""
    return spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True).csv(path).columns


def _parsed(recs: DataFrame, names: list[str], bad: str) -> DataFrame:
    schema = T.StructType([*[T.StructField(n, T.StringType()) for n in names], T.StructField(bad, T.StringType())])
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad, "maxCharsPerColumn": "-1"}
    return recs.select(F.from_csv("text", schema.toDDL(), options).alias("r")).select("r.*")


def read_quoted(spark: SparkSession, path: str, schema: str | T.StructType, bad: str | None = None) -> DataFrame:
    """CSV with a declared schema, every file read by as many tasks as it has splits.

    NA tokens become NULL. A record with another number of cells, or a cell that isn't of its type, fails the
    read; with ``bad`` such records are kept, and that column holds why: the record's text for a wrong number
    of cells, else the cell."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    mark = "_bad_record"
    rows = _parsed(records(spark, path), [f.name for f in schema.fields], mark)
    value = {f.name: F.when(~F.col(f"`{f.name}`").isin(NA_TOKENS), F.col(f"`{f.name}`")) for f in schema.fields}
    if bad is None:
        ok = F.when(F.col(mark).isNull(), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("malformed record: "), mark)).cast("boolean"))
        return rows.where(ok).select(*[value[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
    typed = {f.name: value[f.name].try_cast(f.dataType) for f in schema.fields}
    wrong = [F.when(value[n].isNotNull() & typed[n].isNull(), value[n]) for n in value]
    return rows.select(*[c.alias(n) for n, c in typed.items()], F.coalesce(mark, *wrong).alias(bad))


# Kinds of cells as bits; a column's kinds are the OR over its cells, so tasks' results merge in any order.
_NA, _INT, _DOUBLE, _BOOL, _TEXT = 1, 2, 4, 8, 16


def _kind(cell: F.Column) -> F.Column:
    whole = cell.rlike(r"^[+-]?[0-9]+$") & cell.try_cast("bigint").isNotNull()
    real = cell.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$") | F.lower(cell).rlike(r"^[+-]?inf(inity)?$")
    truth = cell.isin("True", "TRUE", "true", "False", "FALSE", "false")
    return (F.when(cell.isNull() | cell.isin(NA_TOKENS), _NA).when(whole, _INT).when(real, _DOUBLE).when(truth, _BOOL).otherwise(_TEXT)).cast("int")


def _type_of(kinds: int) -> T.DataType:
    """As pandas types a column: whole numbers with missing cells, and nothing but missing cells, are doubles."""
    if kinds == _INT:
        return T.LongType()
    if not kinds & (_BOOL | _TEXT):
        return T.DoubleType()
    return T.BooleanType() if kinds == _BOOL else T.StringType()


def infer_schema(spark: SparkSession, path: str) -> T.StructType:
    """Types of all columns from all cells, one row of bits per task and one in the end."""
    names = header(spark, path)
    rows = _parsed(records(spark, path), names, "_bad_record")
    kinds = rows.agg(*[F.coalesce(F.bit_or(_kind(F.col(f"`{n}`"))), F.lit(0)).alias(f"k{i}") for i, n in enumerate(names)]).first()
    # A column of a file without records has no kind of cell: text, as in pandas.
    return T.StructType([T.StructField(n, _type_of(kinds[i]) if kinds[i] else T.StringType()) for i, n in enumerate(names)])


def read_inferred(spark: SparkSession, path: str) -> DataFrame:
    return read_quoted(spark, path, infer_schema(spark, path))
