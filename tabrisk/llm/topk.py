"""Exact top-k inner products by the threshold algorithm over sorted lists, one list per dimension.

Components become floor(256 x). Candidates are dealt at random to shards of about ``SHARD`` vectors
and queries to blocks of about ``BLOCK``; a group is one shard with one block. Inside it every dimension has a
list of the shard's vectors sorted by that component. A query reads all lists in step, from the
top where its own component is positive and from the bottom where it is negative, scores every vector
the first time it is met, and stops as soon as the sum of (own component x component last read) is below
its k-th best score: no vector not yet met can score more. Each group sends on k rows a query.

Groups have a bounded size whatever the table holds; copies of a vector are dealt like all other rows.

Defined results: vectors that are null, empty or hold null or non-finite components, and rows with a null id, take no
part. Vectors of different length don't meet. A query never finds rows of its own id; a repeated query row
is answered once, two vectors under one query id are answered apart. Repeated candidate rows are listed
each. Scores beyond a long are given as the nearest long. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabrisk.llm.common import table, write_stage

SCALE = 256
EVERY = 50
TOP = 5
SHARD = 8192  # candidates of a group
BLOCK = 2048  # queries of a group
STEP = 16  # entries read from every list before the first look at the threshold; twice as many before each next look
LONG = (1 << 63) - 1


def scaled(rows: list[np.ndarray]) -> np.ndarray:
    """floor(256 x) of equally long vectors: doubles that are whole, or Python integers where doubles could not add them up."""
    x = np.array([np.asarray(r, np.float64) for r in rows])
    if not x.size or np.abs(x).max() < 2.0 ** 16:
        return np.floor(x * SCALE)
    whole = [[int(e) * SCALE if abs(e) >= 2.0 ** 53 else math.floor(e * SCALE) for e in r] for r in x.tolist()]
    return np.array(whole, dtype=object)


def threshold_search(ids: np.ndarray, x: np.ndarray, order: np.ndarray, query_id: int, q: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(ids, scores, vectors scored) of the ``top`` best vectors for ``q``, ties to the smaller id.

    ``order``: positions of ``x`` sorted by each component, ascending."""
    n = len(x)
    up, down = np.flatnonzero(q > 0), np.flatnonzero(q < 0)
    best_id, best = ids[:0], x[:0, 0]
    seen = np.zeros(n, bool)
    lo, step = 0, STEP
    while lo < n:
        hi = min(n, lo + step)
        met = np.zeros(n, bool)
        if hi == n or not (len(up) or len(down)):
            met[:], hi = True, n
        else:
            met[order[n - hi:n - lo, up].ravel()] = True
            met[order[lo:hi, down].ravel()] = True
        met &= ~seen
        seen |= met
        at = np.flatnonzero(met)
        score = x[at] @ q
        own = ids[at] != query_id
        if len(best) == top:
            own &= score >= best[-1]
        best_id, best = np.concatenate([best_id, ids[at[own]]]), np.concatenate([best, score[own]])
        rank = np.lexsort((best_id, -best))[:top]
        best_id, best = best_id[rank], best[rank]
        if hi < n and len(best) == top:
            last = (q[up] * x[order[n - hi, up], up]).sum() + (q[down] * x[order[hi - 1, down], down]).sum()
            if last < best[-1]:
                break
        lo, step = hi, step * 2
    return best_id, best, int(seen.sum())


def _clamped(v) -> int:
    return max(-LONG - 1, min(LONG, int(v)))


def shard_search(candidates: pd.DataFrame, queries: pd.DataFrame, top: int) -> pd.DataFrame:
    """The ``top`` best candidates of one shard for each query of one block."""
    empty = pd.DataFrame({"qrow": np.empty(0, np.int64), "query_id": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64), "score": np.empty(0, np.int64)})
    if not len(candidates) or not len(queries):
        return empty
    x, q = scaled(candidates["vec"].to_list()), scaled(queries["vec"].to_list())
    if x.dtype == object or q.dtype == object:
        x, q = (a if a.dtype == object else np.array([[int(e) for e in r] for r in a.tolist()], dtype=object) for a in (x, q))
    ids = candidates["id"].to_numpy()
    order = np.argsort(x, axis=0, kind="stable")
    out = []
    for qrow, qid, v in zip(queries["qrow"].tolist(), queries["id"].tolist(), q):
        found, score, _ = threshold_search(ids, x, order, qid, v, top)
        out += [(qrow, qid, int(i), _clamped(s)) for i, s in zip(found, score)]
    return pd.DataFrame(out, columns=list(empty.columns)) if out else empty


def nearest(df: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", top: int = TOP,
            shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``top`` rows of largest integer inner product for every row that ``is_query`` names."""
    src = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    sound = (F.col("id").isNotNull() & (F.size("vec") > 0)
             & F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))))
    rows = write_stage(src.where(sound).withColumn("row", F.monotonically_increasing_id()).withColumn("dim", F.size("vec")), "search-vectors")
    n, n_asks = rows.agg(F.count("*"), F.sum(F.col("asks").cast("long"))).first()
    shards, blocks = max(1, -(-n // shard)), max(1, -(-(n_asks or 0) // block))
    dealt = lambda key, parts: F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    candidates = rows.select("id", "vec", "dim", dealt("row", shards).alias("shard"), every(blocks).alias("block"))
    asked = rows.where("asks").groupBy("id", "vec", "dim").agg(F.min("row").alias("qrow"))
    asked = asked.select("qrow", "id", "vec", "dim", every(shards).alias("shard"), dealt("qrow", blocks).alias("block"))
    group = ["dim", "shard", "block"]

    def one(c: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        return shard_search(c, q, top)

    found = candidates.groupBy(*group).cogroup(asked.groupBy(*group)).applyInPandas(one, "qrow bigint, query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("qrow").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best other vectors for every vector whose id is divisible by 50."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)


OP13_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
