"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

Every text becomes a vector of document statistics (lengths, character classes, repetition,
word shape). Random Fourier features approximate a Gaussian kernel over the standardised
vectors; each task sums its own part of the normal equations, only those sums (of a size set
by the number of features) reach the driver. The ridge scores are calibrated on rows that the
ridge has not seen: pooled-adjacent-violators over score bins, linear between block centres,
so scores stay strictly ordered inside (0, 1).

All labelled rows are used, however many. Null texts count as empty; empty texts get a score
like any other. Null labels are ignored; repeated labels count as often as they occur. With
no labels, or one class only, every score is the (smoothed) share of label 1.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabrisk.llm.common import crc_fold, record, slices, sum_arrays, table, texts, write_stage

FEATURES = 256  # random Fourier features
RIDGE = 1e-3  # times the number of rows
BINS = 2048  # score bins of the calibration
CUT = 0.3  # predicted = 1 from this score

STATS = ["log_chars", "log_words", "word_len", "word_len_sd", "upper", "lower", "digit", "space", "stop", "comma", "bang", "symbol", "pipe", "high",
         "line_len", "line_repeat", "word_repeat", "top_word", "caps_words", "title_words", "short_words", "symbol_words", "entropy", "sentence_len", "pair_repeat"]

_B = np.zeros((256, 9), np.float64)
for _j, _chars in enumerate([b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t\r\n", b".", b",", b"!", b"#$%&*+<=>@\\^_`~/{}[]()", b"|"]):
    _B[list(_chars), _j] = 1
_SYMBOLS = frozenset("#$%&*+<=>@\\^_`~|{}[]!")


def stats(text: str) -> list[float]:
    """Document statistics; every ratio is 0 where its base is empty."""
    if not text:
        return [0.0] * len(STATS)
    data = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256)
    n = int(data.sum())
    upper, lower, digit, space, stop, comma, bang, symbol, pipe = (data @ _B) / n
    high = data[128:].sum() / n
    p = data[data > 0] / n
    entropy = -float(p @ np.log2(p))
    words = text.split()
    k = len(words)
    if not k:
        return [math.log1p(len(text)), 0.0, 0.0, 0.0, upper, lower, digit, space, stop, comma, bang, symbol, pipe, high, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, entropy, 0.0, 0.0]
    sizes = np.fromiter(map(len, words), np.int64, k)
    seen: dict[str, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    lines = [x for x in text.split("\n") if x]
    caps = sum(map(str.isupper, words)) / k
    title = sum(map(str.istitle, words)) / k
    marked = sum(w[-1] in _SYMBOLS for w in words) / k
    pairs = len(set(zip(words, words[1:])))
    return [math.log1p(len(text)), math.log1p(k), float(sizes.mean()), float(sizes.std()), upper, lower, digit, space, stop, comma, bang, symbol, pipe, high,
            math.log1p(len(text) / max(1, len(lines))), 1 - len(set(lines)) / max(1, len(lines)), 1 - len(seen) / k, max(seen.values()) / k,
            caps, title, float((sizes <= 3).mean()), marked, entropy, math.log1p(k / (1 + data[46])), 1 - pairs / max(1, k - 1)]


def with_stats(df: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns plus ``_x``, the statistics of the text."""
    src = df.select(*keep, F.col("text").cast("string").alias("_text"))
    schema = df.select(*keep, F.array(F.lit(0.0)).alias("_x")).schema

    def run(batches):
        for b in slices(batches, "_text"):
            x = np.array([stats(t) for t in texts(b, "_text")], np.float64).ravel()
            arr = pa.ListArray.from_arrays(np.arange(0, len(x) + 1, len(STATS), dtype=np.int32), pa.array(x))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], arr], names=[*b.schema.names[:-1], "_x"])

    return src.mapInArrow(run, schema)


def _matrix(col: pa.Array) -> np.ndarray:
    return np.asarray(col.flatten(), np.float64).reshape(len(col), -1)


_PART = pa.schema([("part", pa.int32()), ("vals", pa.list_(pa.float64()))])


class Model:
    """Standardiser, Fourier frequencies, ridge weights and calibration: a few thousand numbers."""

    def __init__(self, mean, sd, seed: int = 7):
        rng = np.random.default_rng(seed)
        d = len(mean)
        self.mean, self.sd = mean, sd
        self.w = rng.standard_normal((d, FEATURES)) / math.sqrt(d)
        self.b = rng.uniform(0, 2 * math.pi, FEATURES)
        self.beta = np.zeros(FEATURES + 1)
        self.at, self.p = np.array([0.0, 1.0]), np.array([0.5, 0.5])

    def lift(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.sd, -8, 8)
        return np.hstack([math.sqrt(2 / FEATURES) * np.cos(z @ self.w + self.b), np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.lift(x) @ self.beta

    def score(self, x: np.ndarray) -> np.ndarray:
        r = np.clip(self.raw(x), -1.0, 2.0)
        # Linear between centres; beyond the ends, drawn towards 0 and 1.
        at, p = np.concatenate([[-1.0], self.at, [2.0]]), np.concatenate([[self.p[0] / 2], self.p, [(1 + self.p[-1]) / 2]])
        return np.interp(r, at, p)


def isotonic(y: np.ndarray, n: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over bins (sums y, counts n, centres x): block centres and smoothed means."""
    blocks: list[list[float]] = []
    for s, c, at in zip(y, n, x):
        if c <= 0:
            continue
        blocks.append([s, c, at * c])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s2, c2, a2 = blocks.pop()
            for j, v in enumerate((s2, c2, a2)):
                blocks[-1][j] += v
    s, c, a = np.array(blocks).T
    prior = y.sum() / n.sum()
    return a / c, np.maximum.accumulate((s + prior) / (c + 1))


def fit(x: DataFrame) -> Model | None:
    """Fit on rows of (fit boolean, _x, y): ``fit`` rows feed the ridge, the others the calibration."""
    def moments(batches):
        total = np.zeros((3, len(STATS)))
        for b in batches:
            m = _matrix(b.column("_x"))[np.asarray(b.column("fit"))]
            total += np.stack([np.full(len(STATS), len(m)), m.sum(0), (m * m).sum(0)])
        yield record(_PART, [[0], [total.ravel()]])

    x = x.select("fit", "_x", "y")
    got = sum_arrays(x.mapInArrow(moments, "part int, vals array<double>"))
    if not got or got[0][0] == 0:
        return None
    n, s, q = got[0].reshape(3, -1)
    mean = s / n
    model = Model(mean, np.sqrt(np.maximum(q / n - mean**2, 0)) + 1e-6)

    def normal(batches):
        # One part per row of the matrix, so that sums of different rows run in different tasks.
        a = np.zeros((FEATURES + 1, FEATURES + 2))
        for b in batches:
            use = np.asarray(b.column("fit"))
            z = model.lift(_matrix(b.column("_x"))[use])
            a[:, :-1] += z.T @ z
            a[:, -1] += z.T @ np.asarray(b.column("y"), np.float64)[use]
        yield record(_PART, [np.arange(16), [r.ravel() for r in np.array_split(a, 16)]])

    sums = sum_arrays(x.mapInArrow(normal, "part int, vals array<double>"))
    a = np.concatenate([sums[k] for k in range(16)]).reshape(FEATURES + 1, FEATURES + 2)
    ridge = RIDGE * n[0] * np.eye(FEATURES + 1)
    ridge[-1, -1] = 1e-9
    model.beta = np.linalg.solve(a[:, :-1] + ridge, a[:, -1])

    def bins(batches):
        total = np.zeros((2, BINS))
        for b in batches:
            use = ~np.asarray(b.column("fit"))
            r = np.clip((model.raw(_matrix(b.column("_x"))[use]) + 1) / 3, 0, 1 - 1e-9)
            at = (r * BINS).astype(np.int64)
            total += np.stack([np.bincount(at, weights=np.asarray(b.column("y"), np.float64)[use], minlength=BINS), np.bincount(at, minlength=BINS)])
        yield record(_PART, [[0], [total.ravel()]])

    y, c = sum_arrays(x.mapInArrow(bins, "part int, vals array<double>"))[0].reshape(2, -1)
    if c.sum() == 0:
        y, c = np.array([a[-1, -1]]), np.array([a[-1, -2]])
        model.at, model.p = np.array([0.5]), (y + 0.5) / (c + 1)
    else:
        model.at, model.p = isotonic(y, c, (np.arange(BINS) + 0.5) / BINS * 3 - 1)
    return model


def apply(df: DataFrame, model: Model | None, keep: list[str]) -> DataFrame:
    """``keep`` columns plus score and predicted, from the statistics in ``_x``."""
    schema = df.select(*keep, F.lit(0.0).alias("score"), F.lit(0).alias("predicted")).schema
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            x = _matrix(b.column("_x")) if b.num_rows else np.zeros((0, len(STATS)))
            s = shared.value.score(x) if shared.value is not None else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(s), pa.array((s >= CUT).astype(np.int32))], names=[*b.schema.names[:-1], "score", "predicted"])

    return df.select(*keep, "_x").mapInArrow(run, schema)


def training_rows(stat: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled rows outside fold 0 of 5; of them, fold 4 calibrates and the rest fit the ridge."""
    y = labels.select("doc_id", F.col("quality").cast("double").alias("y")).where("y is not null")
    fold = crc_fold(F.col("doc_id"), 5)
    return stat.select("doc_id", "_x").join(y, "doc_id").where(fold != 0).select((fold != 4).alias("fit"), "_x", "y")


def learned(docs: DataFrame, labels: DataFrame) -> Model | None:
    """A model of the labelled rows among ``docs``; their statistics are written once."""
    return fit(write_stage(training_rows(with_stats(docs, ["doc_id"]), labels), "quality-training"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that a model of its labelled rows predicts as good."""
    shared = docs.sparkSession.sparkContext.broadcast(learned(docs, labels))

    def run(batches):
        # Statistics, score and choice in one pass, so that a task keeps one Python worker.
        for b in slices(batches, "text", 1 << 20):
            x = np.array([stats(t) for t in texts(b)], np.float64)
            good = shared.value.score(x) >= CUT if shared.value is not None else np.ones(len(x), bool)
            yield b.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from labels outside fold 0 of 5."""
    stat = write_stage(with_stats(table(spark, sf_dir, "documents"), ["doc_id"]), "quality-stats")
    model = fit(training_rows(stat, table(spark, sf_dir, "labels")))
    return apply(stat, model, ["doc_id"]).select("doc_id", (crc_fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")
