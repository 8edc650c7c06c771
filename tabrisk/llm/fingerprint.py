"""Document fingerprints by consistent weighted sampling.

A text's terms are its white-space separated words, weighted by how often they occur. For
each of ``SAMPLES`` independent draws, every term has its own gamma variables r and c and a
uniform b, made from the term's hash alone; the draw takes the term (and weight level t) with
the least ln c - r (t - b + 1), t = floor(ln weight / r + b). Two texts take the same draw
with a probability equal to their generalised Jaccard similarity, sum of minima over sum of
maxima of weights. A fingerprint lists 16 bits of each draw in hex; likeness is the share of
equal draws.

Texts without words (null, empty, white space) share the all-zero fingerprint. Equal texts
have equal fingerprints. Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabrisk.llm.common import mix64, record, table

SAMPLES = 128
KEEP = 150_000  # (term, weight) rows that a worker remembers, 512 bytes each
SPELL = 16 << 20  # characters of the words that it remembers
PIECE = 1 << 19  # characters handled at once

_SEEDS = mix64(np.arange(1, 2 * SAMPLES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _unit(x: np.ndarray, shift: int) -> np.ndarray:
    """Uniform in (0, 1) from 23 bits: they become the fraction of a float in [1, 2)."""
    bits = (x >> np.uint64(shift)).astype(np.uint32)
    bits &= np.uint32(0x7FFFFF)
    bits |= np.uint32(0x3F800000)
    return bits.view(np.float32) - np.float32(1 - 2.0**-24)


def _r_and_b(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gamma(2, 1) and uniform variables; b takes the high bits of both that r and c leave."""
    return -np.log(_unit(one, 0) * _unit(one, 23)), _unit(one >> np.uint64(46) | (two >> np.uint64(59)) << np.uint64(18), 0)


def keys(terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Per term hash and weight: the keys whose minimum decides each draw."""
    h = terms[:, None]
    one, two = mix64(h ^ _SEEDS[:SAMPLES]), mix64(h ^ _SEEDS[SAMPLES:])
    r, b = _r_and_b(one, two)
    log_c = np.log(-np.log(_unit(two, 0) * _unit(two, 23)))
    many = np.flatnonzero(weights > 1)  # the level of weight 1 is 0
    b[many] -= np.floor(np.log(weights[many])[:, None] / r[many] + b[many])
    return log_c - r * (1 - b)


def codes(terms: np.ndarray, weights: np.ndarray, draw: np.ndarray) -> np.ndarray:
    """16 bits of (term, level) for each term hash and weight taken by a draw."""
    level = np.zeros(len(terms), np.int64)
    many = np.flatnonzero(weights > 1)
    h, d = terms[many], draw[many]
    r, b = _r_and_b(mix64(h ^ _SEEDS[d]), mix64(h ^ _SEEDS[SAMPLES + d]))
    level[many] = np.floor(np.log(weights[many]) / r + b)
    return (mix64(terms + level.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.uint16)


class Sampler:
    """Signatures of texts, with the keys of recent terms kept in arrays of a fixed size."""

    def __init__(self, keep: int = KEEP):
        # A word itself stands for its weight 1.
        self.rows: dict[str | tuple[str, int], int] = {}
        self.bytes = 0
        self._room(keep)

    def _room(self, size: int) -> None:
        self.key, self.hash, self.weight = np.empty((size, SAMPLES), np.float32), np.empty(size, np.uint64), np.empty(size)

    def _add(self, terms: list[str | tuple[str, int]]) -> None:
        n = len(self.rows)
        for k in range(0, len(terms), 512):
            part = terms[k:k + 512]
            at = slice(n + k, n + k + len(part))
            self.hash[at] = np.fromiter((xxhash.xxh64_intdigest(x if type(x) is str else x[0]) for x in part), np.uint64, len(part))
            self.weight[at] = np.fromiter((1 if type(x) is str else x[1] for x in part), np.float64, len(part))
            self.key[at] = keys(self.hash[at], self.weight[at])
        self.rows.update(zip(terms, range(n, n + len(terms))))
        self.bytes += sum([len(x if type(x) is str else x[0]) for x in terms])

    def signatures(self, texts: list[str]) -> np.ndarray:
        """One row of 16-bit draws per text; zeros for a text without words."""
        # Words are numbered once; sorting (text, word) and then (word, weight) pairs counts and tells them apart.
        words = [t.split() for t in texts]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        named = pa.array([w for ws in words for w in ws], pa.string()).dictionary_encode()
        spell = named.dictionary.to_pylist()
        pair, weight = np.unique(np.repeat(np.arange(len(texts)), sizes) * max(len(spell), 1) + np.asarray(named.indices), return_counts=True)
        text_of, word = np.divmod(pair, max(len(spell), 1))
        most = int(weight.max(initial=0)) + 1
        kinds, which = np.unique(word * most + weight, return_inverse=True)
        every = [spell[k] if n == 1 else (spell[k], n) for k, n in zip((kinds // most).tolist(), (kinds % most).tolist())]
        del words, named, pair
        missing = [x for x in every if x not in self.rows]
        if len(self.rows) + len(missing) > len(self.key) or self.bytes > SPELL:
            # Full: start again with the terms of these texts.
            self.rows, self.bytes = {}, 0
            missing = every
            if max(len(missing), KEEP) != len(self.key):
                self._room(max(len(missing), KEEP))
        if missing:
            self._add(missing)
        rows, draw = np.array([self.rows[x] for x in every], np.int64)[which], np.arange(SAMPLES)
        out = np.zeros((len(texts), SAMPLES), np.uint16)
        border = np.searchsorted(text_of, np.arange(len(texts) + 1))
        full = np.flatnonzero(border[1:] > border[:-1]).tolist()
        taken = np.empty((len(full), SAMPLES), np.int64)
        for n, i in enumerate(full):
            at = rows[border[i]:border[i + 1]]
            best = None
            for k in range(0, len(at), 4096):
                part = at[k:k + 4096]
                own = part[self.key.take(part, axis=0).argmin(axis=0)]
                best = own if best is None else np.where(self.key[own, draw] < self.key[best, draw], own, best)
            taken[n] = best
        if len(full):
            flat = taken.ravel()
            out[full] = codes(self.hash[flat], self.weight[flat], np.tile(draw, len(full))).reshape(-1, SAMPLES)
        return out


_sampler: Sampler | None = None


def sampler() -> Sampler:
    global _sampler
    if _sampler is None:
        _sampler = Sampler()
    return _sampler


def as_text(signature: np.ndarray) -> str:
    return signature.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(axis=-1)


LOWEST = -(1 << 63)


def with_next(df: DataFrame, parts: int | None = None) -> DataFrame:
    """Rows laid out so that each partition's sorted rows are followed by the row that comes next.

    Order: ``doc_id`` descending (null last, repeated ids by text), around to the first again.
    Split points come from approximate quantiles of the ids, so every part has about as many
    rows; each part's first row is sent to the part before it, too. Texts are shuffled once, every part to a task of its own.
    Columns: part, foreign (1: belongs to the following part), doc_id, text."""
    src = df.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    key = F.coalesce(F.col("doc_id"), F.lit(LOWEST))
    parts = parts or 2 * max(src.rdd.getNumPartitions(), src.sparkSession.sparkContext.defaultParallelism)
    ids = src.select(key.alias("k"))
    cuts = ids.approxQuantile("k", [i / parts for i in range(1, parts)], 0.25 / parts) if parts > 1 else []
    cuts = np.unique(np.array(cuts, np.float64).clip(-2.0**63, 2.0**63 - 1024).astype(np.int64))

    @F.pandas_udf("int")
    def part_of(k: pd.Series) -> pd.Series:
        return pd.Series((len(cuts) - np.searchsorted(cuts, k.to_numpy(), side="right")).astype(np.int32))

    # One row per part: at most twice the number of input splits.
    heads = ids.select(part_of("k").alias("p"), "k").groupBy("p").agg(F.max("k").alias("k")).orderBy("p").collect()
    first = np.array([r["k"] for r in heads], np.int64)
    names = np.array([r["p"] for r in heads], np.int32)
    before = {int(p): int(names[i - 1]) for i, p in enumerate(names)}
    head = dict(zip(names.tolist(), first.tolist()))

    @F.pandas_udf("array<int>")
    def places(k: pd.Series) -> pd.Series:
        k = k.to_numpy()
        p = (len(cuts) - np.searchsorted(cuts, k, side="right")).tolist()
        return pd.Series([[x, before[x]] if head[x] == i else [x] for x, i in zip(p, k.tolist())])

    return (src.select("doc_id", "text", places(key).alias("to")).select("doc_id", "text", F.posexplode("to").alias("foreign", "part"))
            .select("part", "foreign", "doc_id", "text").repartitionById(len(cuts) + 1, "part")
            .sortWithinPartitions("part", "foreign", F.desc_nulls_last("doc_id"), "text"))


def edited(text: str, following: str) -> str:
    """``text`` with its last half (rounded down) replaced by as much of the start of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_OUT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                  ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def compare_with_next(df: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness."""
    def rows(batches):
        for b in batches:
            yield from zip(*(b.column(c).to_pylist() for c in ("part", "foreign", "doc_id", "text")))

    def flush(run):
        """run: consecutive rows; all but the last have their next in the run."""
        texts = [x[3] for x in run]
        new = [edited(a, b) for a, b in zip(texts, texts[1:])]
        sig = sampler().signatures(texts + new)
        own, other, after = sig[:len(new)], sig[len(texts):], sig[1:len(texts)]
        return record(_OUT, [[x[2] for x in run[:-1]], [len(t) for t in texts[:-1]], [hashlib.sha256(t.encode()).hexdigest() for t in new],
                             [as_text(s) for s in own], [as_text(s) for s in other], likeness(own, other), likeness(own, after)])

    def run(batches):
        held: list[tuple] = []
        size = 0
        for row in rows(batches):
            if held and (held[-1][0] != row[0] or held[-1][1]):
                # The run ended with the first row of the following part; more such rows are ties.
                if held[-1][0] == row[0]:
                    continue
                if len(held) > 1:
                    yield flush(held)
                held, size = [], 0
            held.append(row)
            size += len(row[3])
            if size > PIECE and len(held) > 1:
                yield flush(held)
                held, size = [row], len(row[3])
        if len(held) > 1:
            yield flush(held)

    return with_next(df).mapInArrow(run, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return compare_with_next(table(spark, sf_dir, "documents"))
