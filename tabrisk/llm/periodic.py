"""Periodic runs of words, found by block convolution.

A run is a stretch of words with smallest period q that no neighbouring word extends and that
is at least ``LEAST`` words and three periods long. For every scale B = 8, 16, 32, ... a text is cut into
blocks of B words. A run with B <= q < 2B (q < 16 for B = 8) holds a whole block whose
copy one period on lies in the run as well, so it is enough to find, for each block, all
distances below 2B at which the block occurs again.

That is a convolution: with words numbered 0 to V - 1, the sum of squared differences between
block and window is sum x^2 + sum y^2 - 2 sum x y, and is 0 only at equal words. The last sum is a
number-theoretic transform modulo a prime. A sum is below B (V - 1)^2; where one
prime isn't larger than that, two or three are used, and a sum is 0 exactly if it is 0 modulo each of
them. A block is transformed once: the transform of the window after it follows from those of the
next two blocks.

Every distance found is a seed. Seeds are taken by growing distance and extended both ways;
stretches that are long enough and have no smaller period are runs. Seeds inside a known run at
a multiple of its period give nothing new and are passed over.

Defined results: null and empty texts and texts without words have no runs, four nulls and the hash of the
empty text twice. Rows with a null id take h = crc32 of the empty text. Repeated rows are
separate rows; other columns are ignored. Texts are whole; a text is one task's work.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabrisk.llm.common import map_slices, raw_texts, record, table

LEAST = 24  # words of a run
TIMES = 3  # periods of a run
BASE = 8  # smallest block
CHUNK = 1 << 17  # numbers transformed at once
# Primes c 2^k + 1 with a primitive root: fixed values. All transforms up to 2^25 exist for each.
PRIMES = ((469762049, 3), (167772161, 3), (2013265921, 31))


class Transform:
    """Transforms of length 2B over one prime, for rows of B numbers followed by B zeros.

    Results stay in bit-reversed order: position j holds an even frequency if j < B, and frequencies
    k and -k are mirror images inside each span [2^t, 2^(t+1))."""

    def __init__(self, block: int, prime: int, root: int):
        self.block, self.n, self.p = block, 2 * block, np.uint64(prime)
        w = pow(root, (prime - 1) // self.n, prime)
        self.powers = self._table(w)
        self.inverse = self._table(pow(w, prime - 2, prime))
        self.mirror = np.concatenate([[0], *(np.arange(2 << t, 1 << t, -1) - 1 for t in range(self.n.bit_length() - 1))]).astype(np.int64)

    def _table(self, w: int) -> np.ndarray:
        """Powers 0 to B - 1 of w, by doubling."""
        out = np.ones(1, np.uint64)
        while len(out) < self.block:
            out = np.concatenate([out, self.mod(out * np.uint64(pow(w, len(out), int(self.p))))])
        return out

    def mod(self, x: np.ndarray) -> np.ndarray:
        return x - x // self.p * self.p

    def _down(self, t: np.ndarray, axis_last: bool, half: int) -> None:
        """One stage on pairs ``half`` apart, in place; values below 2^32 grow by at most one prime a stage."""
        w = self.powers[::self.block // half]
        a = t.reshape(-1, 2, half) if axis_last else t.reshape(-1, 2, half, t.shape[-1])
        if not axis_last:
            w = w[:, None]
        u, v = a[:, 0].copy(), a[:, 1]
        np.add(u, v, out=a[:, 0])
        u += self.p
        u -= v
        u *= w
        a[:, 1] = self.mod(u)
        a[:, 0] = np.minimum(a[:, 0], a[:, 0] - self.p)  # unsigned: below the prime, the second wraps round to a huge number

    def _up(self, t: np.ndarray, axis_last: bool, half: int) -> None:
        w = self.inverse[::self.block // half]
        a = t.reshape(-1, 2, half) if axis_last else t.reshape(-1, 2, half, t.shape[-1])
        if not axis_last:
            w = w[:, None]
        u, v = a[:, 0], self.mod(a[:, 1] * w)
        low = u + (self.p - v)
        np.minimum(low, low - self.p, out=a[:, 1])
        high = u + v
        np.minimum(high, high - self.p, out=a[:, 0])

    def forward(self, x: np.ndarray) -> np.ndarray:
        """(m, 2B) transforms of (m, B) numbers below the prime."""
        t = np.empty((len(x), self.n), np.uint64)
        t[:, :self.block] = x
        t[:, self.block:] = self.mod(x * self.powers)  # the first stage: the other half is zero
        half = self.block // 2
        while half > 32:
            self._down(t, True, half)
            half //= 2
        if half:
            s = np.ascontiguousarray(t.reshape(-1, 2 * half).T)
            while half:
                self._down(s, False, half)
                half //= 2
            t = np.ascontiguousarray(s.T).reshape(t.shape)
        return t

    def back(self, t: np.ndarray) -> np.ndarray:
        """The first B numbers of the inverse, times 2B."""
        top = min(64, self.block)
        s = np.ascontiguousarray(t.reshape(-1, top).T)
        half = 1
        while half < top:
            self._up(s, False, half)
            half *= 2
        t = np.ascontiguousarray(s.T).reshape(t.shape)
        while half < self.block:
            self._up(t, True, half)
            half *= 2
        out = t[:, :self.block] + self.mod(t[:, self.block:] * self.inverse)
        return np.minimum(out, out - self.p)

    def products(self, block: np.ndarray, near: np.ndarray, far: np.ndarray) -> np.ndarray:
        """2B sum_j x[j] y[l + j] for l < B, from transforms of x and of the two halves of y."""
        half = self.block
        y = np.empty_like(near)
        np.add(near[:, :half], far[:, :half], out=y[:, :half])  # a shift by half the length turns the sign of odd frequencies
        y[:, half:] = near[:, half:] + (self.p - far[:, half:])
        return self.back(self.mod(self.mod(y) * block[:, self.mirror]))


_transforms: dict[tuple[int, int], Transform] = {}


def transform(block: int, i: int) -> Transform:
    if block > 1 << 12:  # large tables aren't kept
        return Transform(block, *PRIMES[i])
    if (block, i) not in _transforms:
        _transforms[block, i] = Transform(block, *PRIMES[i])
    return _transforms[block, i]


def primes_for(block: int, distinct: int) -> int:
    """How many primes make every sum exact."""
    bound, product = block * max(1, distinct - 1) ** 2, 1
    for i, (p, _) in enumerate(PRIMES, 1):
        product *= p
        if bound < product:
            return i
    raise ValueError(f"{distinct} distinct words in blocks of {block}: sums of squares exceed the primes")


def seeds(words: np.ndarray, first: np.ndarray, size: np.ndarray, distinct: np.ndarray, block: int):
    """(text, position, distance) of blocks of ``block`` words that occur again, exactly.

    ``words``: numbers of all texts' words, one text after the other; ``first`` and ``size``: where a text
    starts and how long it is; ``distinct``: its number of distinct words."""
    use = np.flatnonzero(size >= max(LEAST, TIMES * block if block > BASE else LEAST))
    if not len(use):
        return
    n_blocks = -(-size[use] // block)
    ends = np.cumsum(n_blocks)
    text = np.repeat(np.arange(len(use)), n_blocks)
    at = (np.arange(ends[-1]) - np.repeat(ends - n_blocks, n_blocks)) * block  # position in the text
    start, length = first[use][text] + at, size[use][text]
    n_primes = primes_for(block, int(distinct[use].max()))
    fast = [transform(block, i) for i in range(n_primes)]
    squares = np.concatenate([[0], np.cumsum(words * words)])  # exact: below 2^63 up to 10^6 distinct words in 10^6 places, wraps evenly beyond
    rows = max(1, CHUNK // (2 * block))
    lags = np.arange(block)
    steps = (0, 1) if block == BASE else (1,)
    for lo in range(0, len(at), rows):
        hi = min(lo + rows, len(at))
        take = start[lo:min(hi + 2, len(at)), None] + lags
        inside = at[lo:min(hi + 2, len(at)), None] + lags < length[lo:min(hi + 2, len(at)), None]
        x = np.where(inside, words[np.minimum(take, len(words) - 1)], 0).astype(np.uint64)
        if len(x) < hi - lo + 2:
            x = np.concatenate([x, np.zeros((hi - lo + 2 - len(x), block), np.uint64)])
        f = [t.forward(x) for t in fast]
        m = hi - lo
        own = squares[np.minimum(start[lo:hi] + block, len(words))] - squares[start[lo:hi]]
        for step in steps:
            d = step * block + lags
            ok = (at[lo:hi, None] + d + block <= length[lo:hi, None]) & (TIMES * d <= length[lo:hi, None]) & (d > 0)
            if not ok.any():
                continue
            there = np.minimum(start[lo:hi, None] + d, len(words))
            total = own[:, None] + squares[np.minimum(there + block, len(words))] - squares[there]
            for t, g in zip(fast, f):
                p = int(t.p)
                twice = t.products(g[:m], g[step:m + step], g[step + 1:m + step + 1]) * np.uint64(2)
                want = t.mod((total % p).astype(np.uint64) * np.uint64(2 * block % p))
                ok &= np.minimum(twice, twice - t.p) == want
            i, j = np.nonzero(ok)
            if len(i):
                yield use[text[lo + i]], at[lo + i], d[j]


def stretch(x: np.ndarray, s: int, e: int, d: int) -> tuple[int, int]:
    """The largest lo <= s and e <= hi with x[i] == x[i + d] for all i in [lo, hi)."""
    last, step = len(x) - d, 32
    while e < last:
        differ = np.flatnonzero(x[e:min(last, e + step)] != x[e + d:min(last, e + step) + d])
        if len(differ):
            e += int(differ[0])
            break
        e = min(last, e + step)
        step *= 2
    step = 32
    while s > 0:
        a = max(0, s - step)
        differ = np.flatnonzero(x[a:s] != x[a + d:s + d])
        if len(differ):
            s = a + int(differ[-1]) + 1
            break
        s = a
        step *= 2
    return s, e


def primitive(x: np.ndarray, d: int) -> bool:
    """No proper divisor of d is a period of x, two periods or more."""
    k, rest = 2, d
    while rest > 1:
        if k * k > rest:
            k = rest
        if rest % k == 0:
            q = d // k
            if np.array_equal(x[:d], x[q:q + d]):
                return False
            while rest % k == 0:
                rest //= k
        k += 1
    return True


def grow(x: np.ndarray, at: np.ndarray, dist: np.ndarray, block: int, runs: dict[tuple[int, int], int]) -> None:
    """Extend one text's seeds of a scale into runs: {(start, period): length}."""
    order = np.lexsort((at, dist))
    at, dist = at[order], dist[order]
    for (start, q), length in list(runs.items()):
        keep = (dist % q != 0) | (at < start) | (at + dist + block > start + length)
        at, dist = at[keep], dist[keep]
    while len(at):
        s, d = int(at[0]), int(dist[0])
        lo, hi = stretch(x, s, s + block, d)
        gone = (dist == d) & (at >= lo) & (at + block <= hi)
        if hi - lo + d >= max(LEAST, TIMES * d) and primitive(x[lo:lo + 2 * d], d):
            runs[lo, d] = hi - lo + d
            gone |= (dist % d == 0) & (at >= lo) & (at + dist + block <= hi + d)
        at, dist = at[~gone], dist[~gone]


def find_runs(texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of every text, given as numbers of words from 0, by start and period."""
    size = np.array([len(x) for x in texts], np.int64)
    found: list[dict[tuple[int, int], int]] = [{} for _ in texts]
    if size.max(initial=0) >= LEAST:
        words = np.concatenate(texts).astype(np.int64)
        first = np.cumsum(size) - size
        distinct = np.array([int(x.max()) + 1 if len(x) else 0 for x in texts])
        block = BASE
        while TIMES * block <= size.max() or block == BASE:
            parts = list(seeds(words, first, size, distinct, block))
            if parts:
                text, at, dist = (np.concatenate(c) for c in zip(*parts))
                order = np.argsort(text, kind="stable")
                text, at, dist = text[order], at[order], dist[order]
                cuts = [0, *(np.flatnonzero(np.diff(text)) + 1).tolist(), len(text)]
                for a, b in zip(cuts, cuts[1:]):
                    grow(texts[text[a]], at[a:b], dist[a:b], block, found[text[a]])
            block *= 2
    return [sorted((start, length, period) for (start, period), length in f.items()) for f in found]


def repeated(words: list[bytes], h: int) -> list[bytes]:
    """The words, from place a on replaced by their first period, where ``h`` asks for it."""
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (TIMES + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    mark = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        mark[start + period] += 1
        mark[start + length] -= 1
    keep = np.cumsum(mark)[:-1] == 0
    return b" ".join([w for w, k in zip(words, keep.tolist()) if k])


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of greatest length / period, then smallest start, then period."""
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()), ("exponent_milli", pa.int64()),
                     ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())])
_SQL = "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"
_RUNS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def numbered(words: list[bytes]) -> np.ndarray:
    """Words as numbers 0, 1, ... by first occurrence."""
    code: dict[bytes, int] = {}
    return np.array([code.setdefault(w, len(code)) for w in words], np.int64)


def runs(df: DataFrame) -> DataFrame:
    """(doc_id, start, length, period) of every run in the texts of a frame with doc_id and text."""
    def one(b: pa.RecordBatch) -> pa.RecordBatch:
        ids = b.column("doc_id").to_pylist()
        found = find_runs([numbered(t.split()) for t in raw_texts(b)])
        rows = [(i, *r) for i, f in zip(ids, found) for r in f]
        return record(_RUNS, [list(c) for c in zip(*rows)] if rows else [[], [], [], []])

    return map_slices(_source(df), one, "doc_id bigint, start bigint, length bigint, period bigint")


def collapse(df: DataFrame) -> DataFrame:
    """(doc_id, text) with every run cut to its first period, words joined by one space."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def one(b: pa.RecordBatch) -> pa.RecordBatch:
        words = [t.split() for t in raw_texts(b)]
        found = find_runs([numbered(w) for w in words])
        return record(schema, [b.column("doc_id"), [collapsed(w, f).decode() for w, f in zip(words, found)]])

    return map_slices(_source(df), one, "doc_id bigint, text string")


def _source(df: DataFrame) -> DataFrame:
    return df.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def digest(df: DataFrame) -> DataFrame:
    """One row per document: its runs after the replacement that its id asks for, in digests."""
    def one(b: pa.RecordBatch) -> pa.RecordBatch:
        ids = b.column("doc_id").to_pylist()
        words = [repeated(t.split(), zlib.crc32(b"" if i is None else str(i).encode())) for i, t in zip(ids, raw_texts(b))]
        rows = []
        for i, w, f in zip(ids, words, find_runs([numbered(w) for w in words])):
            best = strongest(f)
            four = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
            listed = "".join(f"{s},{n},{p}\n" for s, n, p in f).encode()
            rows.append((i, len(f), *four, hashlib.sha256(listed).hexdigest(), hashlib.sha256(collapsed(w, f)).hexdigest()))
        return record(_SCHEMA, [list(c) for c in zip(*rows)])

    return map_slices(_source(df), one, _SQL)


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of all documents."""
    return digest(table(spark, sf_dir, "documents"))


# The replaced words as the contract defines them; pairs of equal words at every distance up to a third of a text would be too
# many, so distances come from equal shingles of eight words, which a run of 24 words and three periods always has.
OP11_SQL = r"""
WITH w0 AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), ''), ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda acc, c: list_reduce([xor(acc, c), 1, 2, 3, 4, 5, 6, 7, 8], lambda v, k: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)) AS h0
  FROM documents),
w1 AS (SELECT r, doc_id, ws, CAST(len(ws) AS BIGINT) AS n, xor(h0, 4294967295) AS h FROM w0),
w2 AS (SELECT r, doc_id, ws, n, h, CASE WHEN n > 0 THEN (h // 10) % n END AS a FROM w1),
w AS (
  SELECT r, doc_id, n, CASE WHEN n > 0 AND h % 10 = 0
    THEN list_transform(range(0, n), lambda i: ws[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) END]) ELSE ws END AS ws
  FROM w2),
t AS (SELECT r, n, unnest(range(0, n)) AS i, unnest(ws) AS word FROM w WHERE n >= 24),
g AS (
  SELECT r, n, i, hash(word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o, lead(word, 5) OVER o, lead(word, 6) OVER o, lead(word, 7) OVER o) AS k
  FROM t WINDOW o AS (PARTITION BY r ORDER BY i)),
d AS (SELECT DISTINCT x.r, y.i - x.i AS q FROM g x JOIN g y ON x.r = y.r AND x.k = y.k AND x.i < y.i AND 3 * (y.i - x.i) <= x.n AND x.i + 8 <= x.n AND y.i + 8 <= x.n),
e AS (SELECT d.r, d.q, x.i FROM d JOIN t x ON x.r = d.r JOIN t y ON y.r = d.r AND y.i = x.i + d.q AND y.word = x.word),
s AS (SELECT r, q, min(i) AS start, count(*) + q AS length FROM (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS grp FROM e) GROUP BY r, q, grp),
c AS (SELECT * FROM s WHERE length >= greatest(24, 3 * q)),
runs AS (
  SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM c z WHERE z.r = c.r AND z.q < c.q AND z.start <= c.start AND z.start + z.length >= c.start + c.length)),
best AS (
  SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS listed,
    first({'s': start, 'l': length, 'p': q} ORDER BY CAST(length AS DOUBLE) / q DESC, start, q) AS b
  FROM runs GROUP BY r),
gone AS (SELECT DISTINCT r, unnest(range(start + q, start + length)) AS i FROM runs),
kept AS (SELECT t.r, string_agg(t.word, ' ' ORDER BY t.i) AS txt FROM t JOIN best USING (r) LEFT JOIN gone ON gone.r = t.r AND gone.i = t.i WHERE gone.i IS NULL GROUP BY t.r)
SELECT w.doc_id, coalesce(n_runs, 0) AS n_runs, b.s AS start, b.l AS length, b.p AS period, CAST(1000 * b.l // b.p AS BIGINT) AS exponent_milli,
  sha256(coalesce(listed, '')) AS runs_sha256, sha256(CASE WHEN best.r IS NULL THEN array_to_string(ws, ' ') ELSE kept.txt END) AS collapsed_sha256
FROM w LEFT JOIN best USING (r) LEFT JOIN kept USING (r)
"""
