"""Exact ranked lexical search over posting lists that are cut into geometric blocks.

Queries come in batches of bounded size. One pass turns every document into its counts of the batch's
terms; document frequencies and lengths follow from that table. Documents are then searched in shards of
bounded size, in the tasks that read them. In a shard every term's posting list is clustered by the
similarity of its documents (random projections of their term weights, nearest of evenly spaced
representatives) into blocks, and a block's summary holds the largest weight of each of the batch's
terms in any of its documents. The score of any document of a block is at most
the summary's score, so a block is skipped if that is below a query's tenth best score so far, and its
documents are scored in full otherwise. Terms go by falling weight; a query is through with the lists
once the best that all terms still to come can add up to is below its tenth best score. Ten
documents per query and task go on to the final ranking. Both bounds are exact whole numbers.

Defined results: terms are the longest matches of ASCII letters and digits and all other characters from U+0080 on, of
the whole text, with only A-Z lower-cased. Null texts and texts without terms aren't counted and never found.
Repeated documents are separate rows. Rows with a null id are searched like all others; among equal scores they
come last. Every row of the queries is answered by itself, so repeated rows repeat their
answers; queries without terms, or whose terms occur nowhere, have no answers. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabrisk.llm.common import raw_texts, record, slices, table, write_stage

TOP = 10
BATCH_BYTES = 8 << 20  # of query text handled at once
CELLS = 1 << 23  # documents x terms of a shard
SHARD = 8192  # documents of a shard at most
BLOCK = 64  # documents of a block, on average
ENTRIES = 1 << 18  # entries of documents summarised at once
SKETCH = 32  # random projections of a document
_FOLD = bytes(c if chr(c).isdigit() and c < 128 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def forward_rows(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, term, tf) of every document with a term: its length, and the numbers and counts of the vocabulary's terms."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("term", pa.list_(pa.int32())), ("tf", pa.list_(pa.int64()))])
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # the terms of at most one batch of queries

    def run(batches):
        known = shared.value
        for b in slices(batches, "text"):
            ids, rows = b.column("doc_id").to_pylist(), []
            for i, t in zip(ids, raw_texts(b)):
                words = terms(t)
                if not words:
                    continue
                found = np.array([k for w in words if (k := known.get(w)) is not None], np.int64)
                k, c = np.unique(found, return_counts=True)
                rows.append((i, len(words), k.astype(np.int32), c))
            if rows:
                yield record(schema, [list(c) for c in zip(*rows)])

    src = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id bigint, n bigint, term array<int>, tf array<bigint>")


class Shard:
    """Documents of one shard: weights by document and term, posting lists, projections."""

    def __init__(self, ids: np.ndarray, n: np.ndarray, sizes: np.ndarray, term: np.ndarray, tf: np.ndarray, n_terms: int, total_docs: int, total_terms: int):
        """``ids`` ascending (nulls last, as the largest); ``term`` and ``tf``: all documents' entries, ``sizes`` of them each."""
        self.ids, doc = ids, np.repeat(np.arange(len(ids)), sizes)
        m = 100 - 90 + (90 * n * total_docs) // total_terms
        self.x = np.zeros((len(ids), n_terms), np.int32)  # at most 10^6 each
        self.value = ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc])).astype(np.int32)  # by entry
        self.x[doc, term] = self.value
        order = np.argsort(term, kind="stable")
        self.posted = doc[order]
        self.cuts = np.searchsorted(term[order], np.arange(n_terms + 1))
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        self.term = term
        directions = np.random.default_rng(23).standard_normal((n_terms, SKETCH)).astype(np.float32)
        near = np.zeros((len(ids), SKETCH), np.float32)
        full = np.flatnonzero(sizes)
        if len(full):
            weighted = directions[term] * self.value[:, None]
            near[full] = np.add.reduceat(weighted, self.first[full])
        self.near = near / np.maximum(np.linalg.norm(near, axis=1, keepdims=True), 1e-9)

    def postings(self, t: int) -> np.ndarray:
        return self.posted[self.cuts[t]:self.cuts[t + 1]]

    def blocks(self, t: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(documents by block, starts of blocks, summaries) of a term's list."""
        docs = self.postings(t)
        k = -(-len(docs) // BLOCK)
        if k > 1:
            leaders = self.near[docs[np.linspace(0, len(docs) - 1, k).astype(np.int64)]]
            own = (self.near[docs] @ leaders.T).argmax(axis=1)
            order = np.argsort(own, kind="stable")
            docs = docs[order]
            start = np.concatenate([[0], np.flatnonzero(np.diff(own[order])) + 1])
        else:
            start = np.zeros(1, np.int64)
        summary = np.zeros((len(start), self.x.shape[1]), np.int32)
        block = np.repeat(np.arange(len(start)), np.diff(np.concatenate([start, [len(docs)]])))
        count = self.first[docs + 1] - self.first[docs]
        part = (np.cumsum(count) - 1) // ENTRIES
        for at in np.split(np.arange(len(docs)), np.flatnonzero(np.diff(part)) + 1):
            d, c = docs[at], count[at]
            where = np.repeat(self.first[d] - (np.cumsum(c) - c), c) + np.arange(int(c.sum()))
            cell = np.repeat(block[at] * self.x.shape[1], c) + self.term[where]
            np.maximum.at(summary.reshape(-1), cell, self.value[where])
        return docs, start, summary


class Best:
    """The highest-scoring documents met so far, per query."""

    def __init__(self, n_queries: int, top: int):
        self.top = top
        self.score = [np.empty(0, np.int64) for _ in range(n_queries)]
        self.ids = [np.empty(0, np.int64) for _ in range(n_queries)]
        self.floor = np.ones(n_queries, np.int64)  # scores below this can't enter; only scores above 0 count

    def add(self, q: int, score: np.ndarray, ids: np.ndarray) -> None:
        keep = score >= self.floor[q]
        if not keep.any():
            return
        score, ids = np.concatenate([self.score[q], score[keep]]), np.concatenate([self.ids[q], ids[keep]])
        rank = np.lexsort((ids, -score))[:self.top]
        self.score[q], self.ids[q] = score[rank], ids[rank]
        if len(rank) == self.top:
            self.floor[q] = max(1, int(score[rank[-1]]))


def search_shard(shard: Shard, queries: list[np.ndarray], weight: np.ndarray, best: Best) -> int:
    """Add a shard's documents to ``best``; returns how many (document, query) pairs were scored.

    ``queries``: the term numbers of each, by falling weight."""
    most = shard.x.max(axis=0).astype(np.int64) * weight  # the best that a term can add in this shard
    asks: dict[int, list[int]] = {}
    rest = []
    for q, own in enumerate(queries):
        rest.append(dict(zip(own.tolist(), np.cumsum(most[own][::-1])[::-1].tolist())))  # from this term on
        for t in own.tolist():
            if shard.cuts[t] < shard.cuts[t + 1]:
                asks.setdefault(t, []).append(q)
    seen = np.zeros((len(queries), len(shard.ids)), bool)
    scored = 0
    for t in sorted(asks, key=lambda t: (-weight[t], t)):
        active = [q for q in asks[t] if rest[q][t] >= best.floor[q]]
        if not active:
            continue
        docs, start, summary = shard.blocks(t)
        end = np.concatenate([start[1:], [len(docs)]])
        for q in active:
            own = queries[q]
            bound = summary[:, own].astype(np.int64) @ weight[own]
            for b in np.flatnonzero(bound >= best.floor[q])[np.argsort(-bound[bound >= best.floor[q]], kind="stable")].tolist():
                if bound[b] < best.floor[q]:
                    break
                d = docs[start[b]:end[b]]
                d = d[~seen[q, d]]
                if len(d):
                    seen[q, d] = True
                    scored += len(d)
                    best.add(q, shard.x[np.ix_(d, own)].astype(np.int64) @ weight[own], shard.ids[d])
    return scored


_NULL_ID = np.iinfo(np.int64).max


def ranked(rows: DataFrame, queries: list[np.ndarray], weight: np.ndarray, total_docs: int, total_terms: int, top: int) -> DataFrame:
    """(query, doc_id, score): the best documents of every task for each query."""
    schema = pa.schema([("query", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])
    by_weight = [own[np.lexsort((own, -weight[own]))] for own in queries]
    shared = rows.sparkSession.sparkContext.broadcast((by_weight, weight))  # of one batch of queries
    limit = max(1, min(SHARD, CELLS // max(1, len(weight))))

    def run(batches):
        by_weight, weight = shared.value
        best = Best(len(by_weight), top)
        for batch in batches:
            for lo in range(0, batch.num_rows, limit):
                b = batch.slice(lo, limit)
                ids = b.column("doc_id").fill_null(_NULL_ID).to_numpy()
                term, tf = (b.column(c).flatten().to_numpy() for c in ("term", "tf"))
                sizes = np.diff(b.column("term").offsets.to_numpy())
                shard = Shard(ids, b.column("n").to_numpy(), sizes, term, tf, len(weight), total_docs, total_terms)
                search_shard(shard, by_weight, weight, best)
        out = [(q, None if i == _NULL_ID else i, s) for q in range(len(by_weight)) for i, s in zip(best.ids[q].tolist(), best.score[q].tolist())]
        if out:
            yield record(schema, [list(c) for c in zip(*out)])

    return rows.mapInArrow(run, "query int, doc_id bigint, score bigint")


def search_batch(docs: DataFrame, ids: list, texts: list[str | None], top: int) -> DataFrame:
    """(item_id, rank, doc_id, score) for one batch of queries."""
    vocabulary: dict[bytes, int] = {}
    queries = [np.unique(np.array([vocabulary.setdefault(w, len(vocabulary)) for w in terms((t or "").encode())], np.int64)) for t in texts]
    rows = write_stage(forward_rows(docs, vocabulary), "search-forward")
    total_docs, total_terms = rows.agg(F.count("*"), F.sum("n")).first()
    df = np.zeros(len(vocabulary), np.int64)
    for t, c in rows.select(F.explode("term").alias("t")).groupBy("t").agg(F.count("*")).collect():  # a number per term of the batch
        df[t] = c
    weight = np.array([math.floor(1000 * math.log((2 * total_docs + 2) / (2 * int(c) + 1))) for c in df], np.int64)
    got = ranked(rows, queries, weight, total_docs, total_terms or 1, top)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    got = got.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    names = docs.sparkSession.createDataFrame(list(enumerate(ids)), "query int, item_id bigint")
    return got.join(names, "query").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, id_col: str = "item_id", top: int = TOP, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of every item with a text."""
    asked = items.select(F.col(id_col).cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    batches = -(-size // batch_bytes) or 1
    if batches > 1:
        asked = write_stage(asked.withColumn("batch", F.pmod(F.xxhash64("item_id", "text"), F.lit(batches)).cast("int")), "search-items")
    out = None
    for k in range(batches):
        part = (asked.where(F.col("batch") == k) if batches > 1 else asked).select("item_id", "text").orderBy("item_id", "text").collect()
        got = search_batch(docs, [r[0] for r in part], [r[1] for r in part], top)
        out = got if out is None else out.unionByName(got)
    return out


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws
  FROM documents),
p AS (SELECT r, doc_id, CAST(len(ws) AS BIGINT) AS n, ws FROM d WHERE len(ws) > 0),
g AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS l FROM p),
t AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ws) AS term FROM p) GROUP BY r, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * big_n + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM t, g GROUP BY term, big_n),
i AS (
  SELECT k, item_id, unnest(list_distinct(list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> ''))) AS term
  FROM (SELECT row_number() OVER () AS k, item_id, text FROM benchmark)),
m AS (SELECT r, doc_id, 10 + (90 * n * big_n) // l AS m FROM p, g),
s AS (
  SELECT k, item_id, r, doc_id, CAST(sum(w.w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM i JOIN w USING (term) JOIN t USING (term) JOIN m USING (r) GROUP BY k, item_id, r, doc_id),
o AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM o WHERE rank <= 10
"""
