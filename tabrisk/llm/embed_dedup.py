"""Near duplicates among embeddings: random-hyperplane sign hashing, exact cosine, components.

Every vector gets a bucket in each of ``TABLES`` tables: the signs of its projections on
``BITS`` random directions. Vectors of one label that share a bucket are compared exactly. Two
vectors at cosine 0.98 share a given bucket with probability 0.35, so all 32 tables miss such a
pair about once in a million; closer pairs are missed far less.

Equal vectors are one row with a weight from the start. A bucket is compared in blocks of at most
``BLOCK`` x ``BLOCK`` vectors, each a matrix product in a task of its own; a block sends on one
row per vector (its weight of links, and the smallest vector reached), never its pairs. A
pair counts in the first table that holds it only.

Defined results: rows whose vector or label is null, or whose vector is empty, zero or has
null or non-finite components, link with nothing and keep their own id as component. Rows
with a null id link with nothing, too; their component is null and they aren't kept. Repeated
ids are separate rows. Vectors of different length don't link. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabrisk.llm.common import record, table, write_stage
from tabrisk.llm.components import components, stars

COSINE = 0.98
BITS = 16
TABLES = 32
BLOCK = 1024


def hyperplanes(dim: int, tables: int, bits: int) -> np.ndarray:
    return np.random.default_rng(17).standard_normal((dim, tables * bits))


def buckets(x: np.ndarray, tables: int, bits: int) -> np.ndarray:
    sign = (x @ hyperplanes(x.shape[1], tables, bits) > 0).reshape(len(x), tables, bits)
    return (sign @ (1 << np.arange(bits))).astype(np.int32)


def hashed(df: DataFrame, tables: int, bits: int) -> DataFrame:
    """(id, label, key, vec, slots) per row; key (of equal label and vector) is null if it can't link."""
    schema = pa.schema([("id", pa.int64()), ("label", pa.int64()), ("key", pa.binary()), ("vec", pa.list_(pa.float64())), ("slots", pa.list_(pa.int32()))])

    def run(batches):
        for b in batches:
            label = b.column("label").to_pylist()
            ids = b.column("id").to_pylist()
            key, vec, slots = [None] * len(ids), [None] * len(ids), [None] * len(ids)
            by_dim: dict[int, list[tuple[int, np.ndarray]]] = {}
            for i, (lab, own, v) in enumerate(zip(label, ids, b.column("vec").to_pylist())):
                if lab is None or own is None or not v or None in v:
                    continue
                a = np.array(v, np.float64) + 0.0
                with np.errstate(over="ignore"):
                    if np.isfinite(a).all() and a.any():
                        by_dim.setdefault(len(a), []).append((i, a))
            for dim, rows in by_dim.items():
                x = np.stack([a for _, a in rows])
                x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the norm
                slot = buckets(x, tables, bits)
                for (i, a), s in zip(rows, slot):
                    key[i] = hashlib.blake2b(f"{label[i]}:{dim}:".encode() + a.tobytes(), digest_size=16).digest()
                    vec[i], slots[i] = a, s
            yield record(schema, [ids, label, key, vec, slots])

    return df.mapInArrow(run, "id bigint, label bigint, key binary, vec array<double>, slots array<int>")


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def block_links(table_no: int, ids: np.ndarray, weight: np.ndarray, x: np.ndarray, slots: np.ndarray, left: np.ndarray, right: np.ndarray, same: bool, least: float):
    """Links between two chunks of a bucket (or inside one): (ids, weight of new links, smallest id reached)."""
    u = unit(x)
    linked = u[left] @ u[right].T >= least
    if same:
        linked = np.triu(linked, 1)
    i, j = np.nonzero(linked)
    if not len(i):
        return None
    i, j = left[i], right[j]
    new = np.ones(len(i), bool)
    if table_no:
        for k in range(0, len(i), 65536):
            part = slice(k, k + 65536)
            new[part] = ~(slots[i[part], :table_no] == slots[j[part], :table_no]).any(axis=1)
    add = np.bincount(i[new], weights=weight[j[new]], minlength=len(ids)) + np.bincount(j[new], weights=weight[i[new]], minlength=len(ids))
    low = ids.copy()
    node, root = stars(ids[i], ids[j])
    low[np.searchsorted(ids, node)] = root
    keep = (add > 0) | (low != ids)
    return ids[keep], add[keep].astype(np.int64), low[keep]


def links(reps: DataFrame, least: float, block: int) -> DataFrame:
    """(id, add, low) rows of all blocks, from (id, label, weight, vec, slots)."""
    slot = reps.select("id", "label", F.size("vec").alias("dim"), F.posexplode("slots").alias("t", "slot"))
    by = ["label", "dim", "t", "slot"]
    shared = slot.groupBy(*by).agg(F.count("*").alias("n")).where("n > 1").withColumn("chunks", F.ceil(F.col("n") / block).cast("int"))
    chunk = F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")
    # A row of chunk c meets all chunks: as the lower one in (c, d), as the upper one in (d, c).
    rows = (slot.join(shared, by).withColumn("c", chunk)
            .select("id", *by, "c", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("d"))
            .select("id", *by, F.least("c", "d").alias("lo"), F.greatest("c", "d").alias("hi"), "c"))
    blocks = [*by, "lo", "hi"]
    rows = rows.join(reps.select("id", "weight", "vec", "slots"), "id").select(*blocks, "c", "id", "weight", "vec", "slots")
    rows = rows.repartition(*blocks).sortWithinPartitions(*blocks, "id")
    schema = pa.schema([("id", pa.int64()), ("add", pa.int64()), ("low", pa.int64())])

    def one(p: pd.DataFrame):
        first = p.iloc[0]
        ids, c = p["id"].to_numpy(), p["c"].to_numpy()
        same = first["lo"] == first["hi"]
        left = np.flatnonzero(c == first["lo"])
        right = left if same else np.flatnonzero(c == first["hi"])
        return block_links(int(first["t"]), ids, p["weight"].to_numpy(float), np.stack(p["vec"].to_list()), np.stack(p["slots"].to_list()), left, right, same, least)

    def run(batches):
        held = None
        for b in batches:
            p = b.to_pandas()
            p = p if held is None else pd.concat([held, p], ignore_index=True)
            names = p[blocks].to_numpy()
            edge = np.flatnonzero((names[1:] != names[:-1]).any(axis=1)) + 1
            cuts = [0, *edge.tolist()]
            got = [one(p.iloc[s:e]) for s, e in zip(cuts, cuts[1:])]
            held = p.iloc[cuts[-1]:]
            if got := [g for g in got if g is not None]:
                yield record(schema, [np.concatenate(c) for c in zip(*got)])
        if held is not None and len(held) and (g := one(held)) is not None:
            yield record(schema, list(g))

    return rows.mapInArrow(run, "id bigint, add bigint, low bigint")


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                    least: float = COSINE, tables: int = TABLES, bits: int = BITS, block: int = BLOCK) -> DataFrame:
    """(id, n_links, component_id, kept) per row of ``df``."""
    src = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"), F.col(label_col).cast("bigint").alias("label"))
    rows = write_stage(hashed(src, tables, bits), "vectors")
    # Inside, a distinct vector is known by 64 bits of its key: ids may repeat.
    reps = write_stage(rows.where("key is not null").groupBy("key").agg(
        F.min("id").alias("least_id"), F.first("label").alias("label"), F.count("*").alias("weight"), F.first("vec").alias("vec"), F.first("slots").alias("slots"))
        .withColumn("id", F.xxhash64("key")), "distinct-vectors")
    found = write_stage(links(reps, least, block), "links")
    comp = components(found.select(F.col("id").alias("a"), F.col("low").alias("b"))).withColumnRenamed("node", "id")
    add = found.groupBy("id").agg(F.sum("add").alias("add"))
    mine = (reps.select("key", "id", "least_id", "weight").join(add, "id", "left").join(comp, "id", "left")
            .withColumn("root", F.coalesce("component", "id")))
    known = (mine.join(mine.groupBy("root").agg(F.min("least_id").alias("component_id")), "root")
             .select("key", (F.coalesce("add", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id"))
    out = rows.select("id", "key").join(known, "key", "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings with equal labels."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))


OP1_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (
  SELECT * FROM v WHERE vec_id IS NOT NULL AND label IS NOT NULL AND e IS NOT NULL
    AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_inner_product(e, e) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_inner_product(a.e, b.e) / (sqrt(list_inner_product(a.e, a.e)) * sqrt(list_inner_product(b.e, b.e))) >= 0.98),
reach AS (
  SELECT a AS vec_id, a AS other FROM (SELECT DISTINCT a FROM link)
  UNION
  SELECT r.vec_id, l.b FROM reach r JOIN link l ON r.other = l.a),
comp AS (SELECT vec_id, min(other) AS c FROM reach GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n FROM link GROUP BY a)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, coalesce(comp.c, v.vec_id) AS component_id, v.vec_id = coalesce(comp.c, v.vec_id) AS kept
FROM v LEFT JOIN n USING (vec_id) LEFT JOIN comp USING (vec_id)
"""
