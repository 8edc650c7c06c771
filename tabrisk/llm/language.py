"""Language identification by rank-order profiles.

A profile lists a language's most frequent character 1- to 3-grams by rank. A text's own
most frequent n-grams are compared to each profile by the out-of-place distance (sum of rank
differences; an absent n-gram costs the profile length); the nearest language wins.

Letters are lower-cased; every other character is a word boundary. N-grams are packed exactly
into 63 bits (three code points), so nothing is hashed. Ties go to the smaller n-gram and the
smaller language name. Null texts and texts without a letter are ``und`` with score 0; so is
everything when no row has a language to learn from.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabrisk.llm.common import crc_fold, map_slices, record, slices, table, texts

PROFILE = 400  # n-grams in a profile
BOUNDARY = 1  # stands for what isn't a letter; not 0, so that n-grams of different length differ
PIECE = 1 << 20  # bytes of text counted at once
FLUSH = 1 << 20  # distinct n-grams that a task holds per language before it hands them on

_letter = None


def letters() -> np.ndarray:
    global _letter
    if _letter is None:
        _letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letter


def ngrams(text: str) -> np.ndarray:
    """All 1- to 3-grams of the lower-cased text, with one boundary at each end of a word."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    c = np.concatenate([[BOUNDARY], np.where(letters()[c], c, BOUNDARY), [BOUNDARY]])
    keep = np.ones(len(c), bool)
    keep[1:] = (c[1:] != BOUNDARY) | (c[:-1] != BOUNDARY)
    c = c[keep]
    if len(c) < 3:
        return np.empty(0, np.int64)
    two = (c[:-1] << 21) | c[1:]
    three = (two[:-1] << 21) | c[2:]
    return np.concatenate([c[c != BOUNDARY], two, three[c[1:-1] != BOUNDARY]])


def ranked(grams: np.ndarray, top: int) -> np.ndarray:
    """The most frequent n-grams in order of rank."""
    u, n = np.unique(grams, return_counts=True)
    if len(u) > top:
        least = np.partition(n, len(n) - top)[len(n) - top]
        keep = n >= least
        u, n = u[keep], n[keep]
    return u[np.argsort(-n, kind="stable")[:top]]


def gram_counts(df: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows of a frame with text and lang; summed in each task first."""
    schema = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])

    def run(batches):
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for b in slices(batches, "text", PIECE):
            own: dict[str, list] = {}
            for lang, t in zip(b.column("lang").to_pylist(), texts(b)):
                own.setdefault(lang, []).append(t)
            for lang, parts in own.items():
                u, n = np.unique(np.concatenate([ngrams(t) for t in parts]), return_counts=True)
                if lang in held:
                    hu, hn = held[lang]
                    u, back = np.unique(np.concatenate([hu, u]), return_inverse=True)
                    n = np.bincount(back, weights=np.concatenate([hn, n]), minlength=len(u)).astype(np.int64)
                if len(u) > FLUSH:
                    yield record(schema, [[lang] * len(u), u, n])
                    held.pop(lang, None)
                else:
                    held[lang] = (u, n)
        for lang, (u, n) in held.items():
            if len(u):
                yield record(schema, [[lang] * len(u), u, n])

    return df.mapInArrow(run, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit(df: DataFrame, top: int = PROFILE) -> dict[str, np.ndarray]:
    """Profiles of all languages of a frame (text, lang): at most ``top`` n-grams each."""
    w = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    src = df.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where("text is not null and lang is not null")
    rows = gram_counts(src).withColumn("r", F.row_number().over(w)).where(F.col("r") <= top).select("lang", "gram", "r").toPandas()
    return {lang: g.sort_values("r")["gram"].to_numpy() for lang, g in sorted(rows.groupby("lang"))}


class Ranker:
    """Distances of a text to all profiles."""

    def __init__(self, profiles: dict[str, np.ndarray], top: int = PROFILE):
        self.langs, self.top = sorted(profiles), top
        self.grams = np.unique(np.concatenate([np.empty(0, np.int64), *profiles.values()]).astype(np.int64))
        # Last row: an n-gram in no profile.
        self.ranks = np.full((len(self.grams) + 1, len(self.langs)), -1, np.int32)
        for j, lang in enumerate(self.langs):
            self.ranks[np.searchsorted(self.grams, profiles[lang]), j] = np.arange(len(profiles[lang]))

    def predict(self, text: str) -> tuple[str, float]:
        own = ranked(ngrams(text), self.top) if text else np.empty(0, np.int64)
        if not len(own) or not self.langs:
            return "und", 0.0
        at = np.searchsorted(self.grams, own)
        at[(at == len(self.grams)) | (self.grams[np.minimum(at, len(self.grams) - 1)] != own)] = len(self.grams)
        r = self.ranks[at]
        d = np.where(r < 0, self.top, np.abs(r - np.arange(len(own), dtype=np.int32)[:, None])).sum(axis=0)
        best = int(d.argmin())
        return self.langs[best], float(1.0 - d[best] / (self.top * len(own)))


def predict(df: DataFrame, profiles: dict[str, np.ndarray], top: int = PROFILE) -> DataFrame:
    """``df`` (with a text column) plus lang_pred and score; other columns are kept, columns of these two names
    replaced. Repeated rows each give a row."""
    df = df.drop("lang_pred", "score")
    names = df.columns
    ranker = df.sparkSession.sparkContext.broadcast(Ranker(profiles, top))  # at most languages x top entries

    def run(b):
        got = [ranker.value.predict(t) for t in texts(b)]
        return pa.RecordBatch.from_arrays([*b.columns, pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                                          names=[*b.schema.names, "lang_pred", "score"])

    schema = df.select(*names, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    return map_slices(df, run, schema)


def held_out(key: str = "doc_id"):
    return crc_fold(F.col(key), 4) == 2


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from the rows outside fold 2 of 4."""
    docs = table(spark, sf_dir, "documents")
    profiles = fit(docs.where(~held_out()))
    src = docs.select(F.col("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    return predict(src, profiles).select("doc_id", "held_out", "lang_pred", "score")
