"""Connected components of a distributed edge list.

Each task first replaces its own edges by stars around the smallest node they reach, which
shrinks hot groups to one edge per node; then large-star and small-star rounds follow until
nothing changes. Minima are aggregated before the shuffle, joins on a hub's id are skew joins
that Spark splits, and every round ends in a written table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabrisk.llm.common import record, write_stage

HELD = 1 << 20  # edges that a task contracts at once
_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union-find over a block of edges: (node, smallest node reached) for all nodes but the smallest."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = np.arange(len(nodes))
    x, y = at[:len(a)], at[len(a):]
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        while True:
            jump = new[new]
            if (jump == new).all():
                break
            new = jump
        if (new == root).all():
            break
        root = new
    far = root != np.arange(len(nodes))
    return nodes[far], nodes[root[far]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []
    n = 0
    for batch in batches:
        held.append((np.asarray(batch.column("a")), np.asarray(batch.column("b"))))
        n += batch.num_rows
        if n >= HELD:
            a, b = stars(*map(np.concatenate, zip(*held)))
            if len(a) > n // 2:  # little to gain by holding on
                yield record(_EDGES, [a, b])
                held, n = [], 0
            else:
                held, n = [(a, b)], len(a)
    if n:
        yield record(_EDGES, list(stars(*map(np.concatenate, zip(*held)))))


def _round(e: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges (a > b)."""
    both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
    low = large.groupBy("a").agg(F.min("b").alias("m"))
    return (large.join(low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
            .union(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct())


def _state(e: DataFrame) -> tuple:
    r = e.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h"), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)")).alias("s")).first()
    return (r["n"], r["h"], r["s"])


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that isn't itself the smallest.

    ``edges``: two bigint columns a and b; loops, repeats and either order are fine."""
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    e = write_stage(e.mapInArrow(_contract, "a bigint, b bigint").distinct(), "edges")
    state = _state(e)
    while state[0]:
        e = write_stage(_round(e), "edges")
        new = _state(e)
        if new == state:
            break
        state = new
    return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
