"""Periodic runs, lexical search and top-k search against plain versions."""

import hashlib
import math
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabrisk.llm import lexical, periodic, topk
from tests.llm.conftest import crc


# --- op11 ----------------------------------------------------------------------------------------------

def plain_runs(x):
    n, found = len(x), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and x[j] == x[j + q]:
                j += 1
            if j - i + q >= max(24, 3 * q) and j > i:
                found.append((i, j - i + q, q))
            i = j + 1
    return sorted(r for r in found if not any(z[2] < r[2] and z[0] <= r[0] and z[0] + z[1] >= r[0] + r[1] for z in found))


@pytest.mark.parametrize("block", [8, 16, 64, 128, 256])
def test_transform_gives_exact_products(block):
    rng = np.random.default_rng(block)
    x, y = rng.integers(0, 50_000, (3, block)).astype(np.uint64), rng.integers(0, 50_000, (3, 2 * block)).astype(np.uint64)
    for i, (prime, _) in enumerate(periodic.PRIMES):
        t = periodic.Transform(block, *periodic.PRIMES[i])
        got = t.products(t.forward(x), t.forward(y[:, :block]), t.forward(y[:, block:]))
        for r in range(3):
            want = [2 * block * sum(int(a) * int(b) for a, b in zip(x[r], y[r, lag:])) % prime for lag in range(block)]
            assert got[r].tolist() == want


def test_runs_match_plain_search():
    rng = random.Random(3)
    cases = [[], [0], [0] * 23, [0] * 24, [0] * 700, [0, 1] * 300 + [2] + [0, 1] * 200, [0, 0, 1] * 30 + [0, 0, 0, 1] * 30]
    for _ in range(350):
        x = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randint(0, 250))]
        for _ in range(rng.randint(0, 4)):
            if x:
                a = rng.randrange(len(x))
                p = rng.randint(1, max(1, (len(x) - a) // 3))
                for i in range(a + p, rng.randint(a, len(x))):
                    x[i] = x[i - p]
        cases.append(x)
    assert sum(map(len, map(plain_runs, cases))) > 100
    assert periodic.find_runs([periodic.numbered(x) for x in cases]) == [plain_runs(x) for x in cases]


def test_number_of_primes_covers_the_sum():
    assert periodic.primes_for(8, 1000) == 1 and periodic.primes_for(4096, 20_000) == 2 and periodic.primes_for(1 << 22, 10_000_000) == 3
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.permutation(9000), rng.permutation(9000)])  # two primes from blocks of eight on
    x = np.concatenate([x, np.tile(x[:700], 3)])
    assert periodic.find_runs([periodic.numbered(x.tolist())]) == [plain_runs(x.tolist())] != [[]]


def test_digest_on_awkward_documents(docs, data, no_docs):
    want = Counter()
    for r in data:
        w = (r[1] or "").encode().split()
        h = crc(r[0], 1 << 32)
        n, g = len(w), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i if i < a else a + (i - a) % p] for i in range(n)]
        runs = plain_runs(w) if n < 5000 else [tuple(x) for x in periodic.find_runs([periodic.numbered(w)])[0]]
        best = min(runs, key=lambda z: (-Fraction(z[1], z[2]), z[0], z[2]), default=None)
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        text = b" ".join(x for i, x in enumerate(w) if i not in gone)
        listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        four = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
        want[(r[0], len(runs), *four, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(text).hexdigest())] += 1
    assert Counter(tuple(r) for r in periodic.digest(docs).collect()) == want
    assert sum(r[1] > 0 for r in want) >= 3
    assert periodic.digest(no_docs).count() == 0


def test_runs_and_collapsed_texts(spark):
    df = spark.createDataFrame([(1, "x " + "Ab c " * 20 + "end"), (2, None)], "doc_id bigint, text string")
    assert [tuple(r) for r in periodic.runs(df).collect()] == [(1, 1, 40, 2)]
    assert {r["doc_id"]: r["text"] for r in periodic.collapse(df).collect()} == {1: "x Ab c end", 2: ""}


# --- op12 ----------------------------------------------------------------------------------------------

def plain_terms(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def plain_search(rows, items, top=10):
    bags = [(r[0], plain_terms(r[1])) for r in rows]
    bags = [(i, len(w), Counter(w)) for i, w in bags if w]
    big_n, big_l = len(bags), sum(n for _, n, _ in bags)
    df = Counter(t for _, _, c in bags for t in c)
    out = Counter()
    for item, text in items:
        scores = []
        for i, n, c in bags:
            m = 10 + 90 * n * big_n // big_l
            s = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(plain_terms(text)) if t in c)
            if s:
                scores.append((-s, i is None, i or 0, i))
        for rank, (s, _, _, i) in enumerate(sorted(scores)[:top], 1):
            out[(item, rank, i, -s)] += 1
    return out


ITEMS = [(1, "the river stone house of the table"), (2, "The RIVER stone house of the table"), (3, None), (4, ""), (5, "!?,"), (6, "wordthatoccursnowhere"),
         (7, "être façon était la maison où"), (7, "quickly one"), (8, "no id here at all today"), (None, "edit1 edit2 text"), (9, "x" * 50_000), (10, "é 12345 0123456789abcdef")]


def test_lexical_search_matches_plain_search(spark, docs, data, no_docs, monkeypatch):
    items = spark.createDataFrame([(i, t, 1) for i, t in ITEMS], "item_id bigint, text string, doc_id int")
    want = plain_search(data, ITEMS)
    assert Counter(tuple(r) for r in lexical.search(docs, items).collect()) == want
    # Small shards and blocks, and several batches of queries.
    monkeypatch.setattr(lexical, "SHARD", 40)
    monkeypatch.setattr(lexical, "BLOCK", 3)
    assert Counter(tuple(r) for r in lexical.search(docs, items, batch_bytes=20_000).collect()) == want
    assert lexical.search(no_docs, items).count() == 0 == lexical.search(docs, items.limit(0)).count()


def test_blocks_partition_lists_and_summaries_bound_them():
    rng = np.random.default_rng(4)
    sizes = rng.integers(1, 30, 500)
    term = np.concatenate([np.sort(rng.permutation(40)[:s]) for s in sizes])
    tf = rng.integers(1, 9, len(term))
    s = lexical.Shard(np.arange(500), sizes * 3, sizes, term, tf, 40, 500, int(sizes.sum()) * 3)
    for t in (0, 7, 39):
        docs, start, summary = s.blocks(t)
        assert sorted(docs.tolist()) == s.postings(t).tolist() and len(start) > 2
        for b, part in enumerate(np.split(docs, start[1:])):
            assert (summary[b] == s.x[part].max(axis=0)).all()


def test_blocks_are_skipped_and_answers_stay_exact():
    rng = np.random.default_rng(9)
    topic = rng.integers(0, 20, 2000)  # a document's terms come from one topic, so blocks differ
    rows = [np.sort(np.unique(np.concatenate([t * 20 + rng.permutation(20)[:8], 400 + rng.permutation(20)[:6]]))) for t in topic]
    sizes = np.array([len(r) for r in rows])
    term, tf = np.concatenate(rows), rng.integers(1, 4, int(sizes.sum()))
    s = lexical.Shard(np.arange(2000), sizes * 2, sizes, term, tf, 420, 2000, int(sizes.sum()) * 2)
    df = np.bincount(term, minlength=420)
    weight = np.floor(1000 * np.log((2 * 2000 + 2) / (2 * df + 1))).astype(np.int64)
    queries = [np.concatenate([t * 20 + np.arange(12), 400 + np.arange(10)]) for t in range(20)]
    queries = [q[np.lexsort((q, -weight[q]))] for q in queries]
    best = lexical.Best(20, 10)
    scored = lexical.search_shard(s, queries, weight, best)
    holding = sum(int((s.x[:, q].sum(axis=1) > 0).sum()) for q in queries)
    assert scored < holding / 3
    for k, q in enumerate(queries):
        full = s.x[:, q].astype(np.int64) @ weight[q]
        rank = np.lexsort((np.arange(2000), -full))[:10]
        assert best.ids[k].tolist() == rank.tolist() and best.score[k].tolist() == full[rank].tolist()


# --- op13 ----------------------------------------------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<double>, label int, row string, score string"


def plain_nearest(rows, top=5, every=50):
    ok = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    ok = [(i, tuple(math.floor(Fraction(x) * 256) for x in v)) for i, v in ok]
    out = Counter()
    for i, v in sorted(set(ok)):
        if i % every == 0:
            got = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in ok if j != i and len(w) == len(v))[:top]
            out.update((i, r, j, max(-2**63, min(2**63 - 1, -s))) for r, (s, j) in enumerate(got, 1))
    return out


def test_topk_matches_plain_search(spark):
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(260)]
    rows += [(300 + i, list(rows[3][1])) for i in range(90)]  # copies: ties
    rows += [(400, None), (401, []), (450, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (500, [float("nan")] * 6), (501, [float("inf")] * 6), (None, [1.0] * 6),
             (550, [0.0] * 6), (551, [0.0] * 6), (600, [1.0, 2.0]), (601, [3.0, -1.0]), (50, list(rows[50][1])), (100, [0.5] * 6)]
    df = spark.createDataFrame([(i, v, 1, "r", "s") for i, v in rows], VECTORS)
    want = plain_nearest(rows)
    asks = F.col("vec_id") % 50 == 0
    assert Counter(tuple(r) for r in topk.nearest(df, asks).collect()) == want
    assert Counter(tuple(r) for r in topk.nearest(df, asks, shard=30, block=3).collect()) == want
    assert topk.nearest(df.limit(0), asks).count() == 0


def test_topk_of_huge_components(spark):
    rows = [(0, [1e300, 1.0]), (1, [2.0**55, 1.5]), (2, [1.0, 7.25]), (3, [-1e300, 0.0]), (50, [0.25, -3.0])]
    df = spark.createDataFrame([(i, v, 1, "r", "s") for i, v in rows], VECTORS)
    assert Counter(tuple(r) for r in topk.nearest(df, F.col("vec_id") % 50 == 0).collect()) == plain_nearest(rows)


def test_threshold_stops_before_the_lists_end():
    rng = np.random.default_rng(6)
    x = np.floor(rng.standard_normal((20_000, 3)) * 256)
    order = np.argsort(x, axis=0, kind="stable")
    ids = np.arange(20_000)
    for k in range(30):
        q = x[k]
        found, score, scored = topk.threshold_search(ids, x, order, k, q, 5)
        full = x @ q
        others = np.delete(ids, k)
        rank = others[np.lexsort((others, -full[others]))[:5]]
        assert found.tolist() == rank.tolist() and score.tolist() == full[rank].tolist() and scored < 10_000


def test_block_summaries_hold_the_largest_weight_of_each_term(monkeypatch):
    monkeypatch.setattr(lexical, "ENTRIES", 50)  # the table is summarised in several pieces
    rng = np.random.default_rng(4)
    held = [np.flatnonzero(rng.random(30) < 0.3) for _ in range(300)]
    sizes = np.array([len(h) for h in held])
    term = np.concatenate(held)
    shard = lexical.Shard(np.arange(300), sizes * 3, sizes, term, rng.integers(1, 5, len(term)), 30, 300, int(sizes.sum()) * 3)
    for t in range(30):
        docs, start, summary = shard.blocks(t)
        assert sorted(docs.tolist()) == shard.postings(t).tolist()
        assert (summary == np.maximum.reduceat(shard.x[docs], start, axis=0)).all()
