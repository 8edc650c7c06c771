"""Helpers shared by the operators: table access, folds, batch slicing, bounded array sums, Bloom filters."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabrisk.session import checkpoint_dir, scratch_path

# Texts are handled this many bytes at a time inside a task, whatever the Arrow batch holds.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; 0 for a null key's empty text."""
    return (F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % F.lit(folds)).cast("int")


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of rows whose ``column`` holds about ``limit`` bytes (one row at least)."""
    for b in batches:
        if not b.num_rows:
            continue
        size = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False), np.int64))
        lo = 0
        while lo < b.num_rows:
            base = size[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(size, base + limit, side="right")))
            yield b.slice(lo, hi - lo)
            lo = hi


def map_slices(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, column: str = "text") -> DataFrame:
    """``mapInArrow`` with batches bounded by the bytes of one text column."""
    def run(batches):
        for b in slices(batches, column):
            out = fn(b)
            if out is not None and out.num_rows:
                yield out
    return df.mapInArrow(run, schema)


def texts(b: pa.RecordBatch, column: str = "text") -> list[str]:
    """The text column as Python strings, null as empty."""
    return pc.fill_null(b.column(column), "").to_pylist()


def raw_texts(b: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The text column as UTF-8 bytes, null as empty."""
    return pc.fill_null(b.column(column), "").cast(pa.binary()).to_pylist()


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text or binary column (null as empty) in one array, and where each row starts (one more than rows)."""
    col = pc.fill_null(column.cast(pa.binary()), b"")
    if not len(col) or col.buffers()[2] is None:
        return np.empty(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    off = np.frombuffer(col.buffers()[1], np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    return np.frombuffer(col.buffers()[2], np.uint8)[off[0]:off[-1]], off - off[0]


def cut_chunks(data: np.ndarray, off: np.ndarray, begins: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Rows cut before every byte that ``begins`` marks: distinct chunks with each chunk's code, and where each row's chunks start.

    ``data`` and ``off`` are as ``flat_bytes`` gives them; a row's first byte always begins a chunk, so chunks
    join up to the rows and only an empty row has none."""
    begins[off[:-1][off[:-1] < off[1:]]] = True
    starts = np.flatnonzero(begins)
    at = np.append(starts, len(data)).astype(np.int32)
    chunks = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(data))])
    return chunks.dictionary_encode(), np.searchsorted(starts, off).astype(np.int32)


WHITE = np.zeros(256, bool)  # ASCII white space
WHITE[[9, 10, 11, 12, 13, 32]] = True


def word_begins(data: np.ndarray) -> np.ndarray:
    """Marks the first byte of every run without ASCII white space."""
    white = WHITE[data]
    got = ~white
    got[1:] &= white[:-1]
    return got


def join_chunks(codes: pa.Array, first: np.ndarray, values: list[bytes], between: bytes) -> pa.Array:
    """Per row, the values of its chunks' codes joined by ``between``."""
    flat = pa.array(values, pa.binary()).take(codes)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(first, pa.int32()), flat), pa.scalar(between, pa.binary()))


def record(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


def write_stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it back: the lineage ends there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def frozen(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in ``spark.checkpoint.dir``."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def sum_arrays(df: DataFrame) -> dict[int, np.ndarray]:
    """Sum ``(part int, vals array<double>)`` rows per part and fetch the sums.

    For fixed-size sufficient statistics: the number of parts and their length are set by
    the model's parameters, never by the data; each task sends one row per part."""
    def add(p: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": p["part"].iloc[:1], "vals": [np.sum([np.asarray(v) for v in p["vals"]], axis=0)]})

    rows = df.groupBy("part").applyInPandas(add, "part int, vals array<double>").collect()
    return {r["part"]: np.asarray(r["vals"]) for r in rows}


# --- Bloom filter of a key column, of a fixed size -------------------------------------------------

BLOOM_BITS = 1 << 23


def mix64(x: np.ndarray) -> np.ndarray:
    """Mix 64-bit integers so that every input bit reaches every output bit (splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def bloom(df: DataFrame, bit: Column) -> np.ndarray:
    """A Bloom filter (1 MB, one hash) of the positions ``bit``; only its fixed number of words reaches the driver."""
    at = df.select(bit.cast("int").alias("bit"))
    words = (at.select(F.shiftright("bit", 6).alias("w"), F.expr("shiftleft(1L, bit & 63)").alias("v"))
             .groupBy("w").agg(F.bit_or("v").alias("v")).toPandas())
    out = np.zeros(BLOOM_BITS >> 6, np.int64)
    out[words["w"].to_numpy()] = words["v"].to_numpy()
    return out


def bloom_hit(words: np.ndarray, bits: np.ndarray) -> np.ndarray:
    return (words[bits >> 6] >> (bits & 63)) & 1 == 1
