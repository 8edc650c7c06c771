"""Language-model scores by a log-bilinear model trained with noise-contrastive estimation.

Tokens are lower-cased words and one end per text. The model knows the most frequent words and
classes for all others (by the last letters); it predicts a token's vector as a weighted sum
of the vectors of the two tokens before it. Training contrasts each token with noise words drawn
from the unigram distribution. Every training text is used once: in each of ``ROUNDS``
rounds all tasks start from the same parameters, run stochastic gradient steps over their own
texts, and the parameters are averaged by tokens seen.

The score of a token needs the sum over the vocabulary for its context. It factors: with
A = exp of the nearer token's part and B = exp of the farther one's, one matrix product A B'
gives the normaliser of every pair of context tokens, so token log-probabilities are exact and cost
three look-ups. A word outside the model vocabulary has its class's probability times its share of
the class, (c + 1) / (n + v + 1), with one share for all unseen words together.

Word counts cover all training texts. Counts of the ``LEXICON`` most frequent words go to the
tasks; all other words are joined with the counts by word.

Null texts are empty: one end. With nothing to learn from, the model is uniform over what it
has. Repeated ids are separate rows. Other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabrisk.llm.common import crc_fold, cut_chunks, flat_bytes, record, slices, sum_arrays, table, word_begins, write_stage

WORDS = 1024  # words that the model predicts one by one
CLASSES = 1024  # classes of other words
DIM = 32
NOISE = 128  # noise words per batch, shared by its tokens
BATCH = 512
RATE = 0.2
ROUNDS = 3
LEXICON = 200_000  # words whose counts every task knows
HELD = 400_000  # words that a task counts before it hands them on
END = b"\n"  # no word holds white space
PARTS = 64


def words_of(column: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct words of a slice of texts, and for every word in order its number among them and its row."""
    data, off = flat_bytes(column)
    data = np.frombuffer(data.tobytes().lower(), np.uint8)
    cut, first = cut_chunks(data, off, word_begins(data))
    words: dict[bytes, int] = {}
    number = np.array([words.setdefault(c.strip(), len(words)) for c in cut.dictionary.to_pylist()], np.int64).reshape(-1)
    own, row = number[np.asarray(cut.indices)], np.repeat(np.arange(len(column)), np.diff(first))
    blank = words.get(b"")
    if blank is not None:
        # White space before a row's first word.
        real = own != blank
        own, row = own[real], row[real]
    return list(words), own, row


def class_of(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % CLASSES


def word_counts(df: DataFrame) -> DataFrame:
    """(word binary, c) over all texts of ``df``, summed in each task first."""
    schema = pa.schema([("word", pa.binary()), ("c", pa.int64())])

    def run(batches):
        held: Counter = Counter()
        for b in slices(batches, "text"):
            words, own, _ = words_of(b.column("text"))
            for w, n in zip(words, np.bincount(own, minlength=len(words)).tolist()):
                if n:
                    held[w] += n
            held[END] += b.num_rows
            if len(held) > HELD:
                yield record(schema, [list(held), list(held.values())])
                held = Counter()
        if held:
            yield record(schema, [list(held), list(held.values())])

    return df.select("text").mapInArrow(run, "word binary, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


# --- the model ---------------------------------------------------------------------------------------------

class Model:
    """Vectors of targets and contexts, weights of the two context places, biases."""

    def __init__(self, unigram: np.ndarray, seed: int = 11):
        rng = np.random.default_rng(seed)
        v = len(unigram)
        self.noise = unigram / unigram.sum()
        self.target = rng.standard_normal((v, DIM)).astype(np.float32) * 0.1
        self.context = rng.standard_normal((v, DIM)).astype(np.float32) * 0.1
        self.near, self.far = np.ones(DIM, np.float32), np.full(DIM, 0.7, np.float32)
        self.bias = np.log(self.noise).astype(np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.target, self.context, self.near, self.far, self.bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parameters()]).astype(np.float64)

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for p in self.parameters():
            p[...] = flat[at:at + p.size].reshape(p.shape)
            at += p.size

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores by (nearer, word) and (farther, word), and log normalisers by (nearer, farther); made once per worker."""
        if hasattr(self, "_tables"):
            return self._tables
        a = (self.context * self.near) @ self.target.T
        b = (self.context * self.far) @ self.target.T + self.bias
        top_a, top_b = a.max(axis=1, keepdims=True), b.max(axis=1, keepdims=True)
        z = np.log(np.exp(a - top_a) @ np.exp(b - top_b).T) + top_a + top_b.T
        self._tables = a, b, z
        return self._tables


def contexts(ids: np.ndarray, first: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The two tokens before each token; ends stand before a text. ``first``: where texts start."""
    near = np.concatenate([[end], ids[:-1]])
    far = np.concatenate([[end, end], ids[:-2]])[:len(ids)]
    near[first] = end
    far[first] = end
    second = first + 1
    second = second[second < len(ids)]
    far[second[~np.isin(second, first)]] = end
    return near, far


class Trainer:
    """Stochastic noise-contrastive steps with AdaGrad rates."""

    def __init__(self, model: Model, seed: int):
        self.m = model
        self.rng = np.random.default_rng(seed)
        self.cdf = np.cumsum(model.noise)
        self.log_noise = np.log(NOISE * model.noise).astype(np.float32)
        self.sum = [np.full(p.shape, 1e-6, np.float32) for p in model.parameters()]

    def _ascend(self, k: int, rows: np.ndarray, grad: np.ndarray, n: int) -> None:
        """AdaGrad step of the rows of parameter ``k`` that a batch of ``n`` tokens touches."""
        width = grad.shape[1]
        p, s = self.m.parameters()[k].reshape(-1, width), self.sum[k].reshape(-1, width)
        if len(rows) == 1:
            own, g = rows, (grad / n).astype(np.float32)
        else:
            own, at = np.unique(rows, return_inverse=True)
            flat = (at[:, None] * width + np.arange(width)).ravel()
            g = (np.bincount(flat, weights=grad.ravel(), minlength=len(own) * width) / n).astype(np.float32).reshape(-1, width)
        seen = s[own] + g * g
        s[own] = seen
        p[own] += RATE * g / np.sqrt(seen)

    def step(self, word: np.ndarray, near: np.ndarray, far: np.ndarray) -> None:
        m, n, v = self.m, len(word), len(self.m.bias)
        noise = np.minimum(np.searchsorted(self.cdf, self.rng.random(NOISE)), v - 1)
        qn, qf = m.context[near], m.context[far]
        h = qn * m.near + qf * m.far
        rw, rn = m.target[word], m.target[noise]
        true = np.einsum("ij,ij->i", h, rw) + m.bias[word] - self.log_noise[word]
        false = h @ rn.T + (m.bias[noise] - self.log_noise[noise])
        up = 1 / (1 + np.exp(np.clip(true, -30, 30)))  # 1 - P(true is data)
        down = -1 / (1 + np.exp(-np.clip(false, -30, 30)))
        dh = up[:, None] * rw + down @ rn
        both = np.concatenate([word, noise])
        self._ascend(0, both, np.concatenate([up[:, None] * h, down.T @ h]), n)
        self._ascend(4, both, np.concatenate([up, down.sum(axis=0)])[:, None], n)
        self._ascend(1, np.concatenate([near, far]), np.concatenate([dh * m.near, dh * m.far]), n)
        self._ascend(2, np.zeros(1, np.int64), (dh * qn).sum(axis=0, keepdims=True), n)
        self._ascend(3, np.zeros(1, np.int64), (dh * qf).sum(axis=0, keepdims=True), n)


class Prepared:
    """What tasks need to turn words into ids and known scores; its size is set by the parameters."""

    def __init__(self, words: list[bytes], counts: np.ndarray, n: int, v: int, class_n: np.ndarray, class_v: np.ndarray):
        self.words, self.counts, self.n, self.v = words, counts, n, v
        self.class_log = np.log10(class_n + class_v + 1)
        self.model_words = min(WORDS, len(words))
        known = np.arange(len(words)) < self.model_words
        cls = np.array([class_of(w) for w in words], np.int64).reshape(-1)
        self.ids = np.where(known, np.arange(len(words)), self.model_words + cls).astype(np.int16)
        self.base = np.log10(counts + 1) - math.log10(n + v + 1)
        self.share = np.where(known, 0.0, np.log10(counts + 1) - self.class_log[cls])
        # One more than counted, so that everything can be drawn as noise.
        self.unigram = np.concatenate([counts[:self.model_words], class_n]).astype(np.float64) + 1

    @property
    def end(self) -> int:
        return self.words.index(END)

    def index(self) -> dict[bytes, int]:
        """Positions of the words; made once per worker."""
        if not hasattr(self, "_index"):
            self._index = {w: i for i, w in enumerate(self.words)}
        return self._index


def prepare(counts: DataFrame) -> Prepared:
    total = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    n, v = int(total["n"] or 0), int(total["v"])
    # The least count whose words, with those of all higher counts, are LEXICON at most. Counts are
    # compared in steps of a sixteenth of a power of two, so the histogram has a thousand rows at most.
    step = F.floor(F.log2("c") * 16).cast("int")
    sizes = counts.groupBy(step.alias("s")).agg(F.count("*").alias("k")).toPandas().sort_values("s", ascending=False)
    fits = sizes["s"][sizes["k"].cumsum() < LEXICON]
    top = counts.where((step >= int(fits.min() if len(fits) else 1 << 20)) | (F.col("word") == F.lit(END))).toPandas()
    order = sorted(zip(top["word"].map(bytes), top["c"]), key=lambda x: (x[0] != END, -x[1], x[0]))
    words, c = [w for w, _ in order], np.array([n for _, n in order], np.int64)
    if not words:
        words, c = [END], np.zeros(1, np.int64)
    own = frozenset(words[:WORDS])

    def classes(batches):
        s = np.zeros((2, CLASSES))
        for b in batches:
            w = b.column("word").to_pylist()
            k = np.array([class_of(x) if x not in own else CLASSES for x in w], np.int64)
            s += np.stack([np.bincount(k, weights=np.asarray(b.column("c")), minlength=CLASSES + 1)[:CLASSES], np.bincount(k, minlength=CLASSES + 1)[:CLASSES]])
        yield record(_PART, [[0], [s.ravel()]])

    got = sum_arrays(counts.mapInArrow(classes, "part int, vals array<double>"))
    class_n, class_v = got[0].reshape(2, -1) if got else np.zeros((2, CLASSES))
    return Prepared(words, c, n, v, class_n, class_v)


_PART = pa.schema([("part", pa.int32()), ("vals", pa.list_(pa.float64()))])


def tokenized(df: DataFrame, p: Prepared) -> DataFrame:
    """Per row: ids, the sums that need no model, and the words whose counts must be joined."""
    shared = df.sparkSession.sparkContext.broadcast(p)  # LEXICON words at most
    rare = pa.struct([("word", pa.binary()), ("tf", pa.int32()), ("cls", pa.int32())])
    schema = pa.schema([("uid", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("known", pa.int64()),
                        ("base", pa.float64()), ("share", pa.float64()), ("ids", pa.list_(pa.int16())), ("rare", pa.list_(rare))])

    def run(batches):
        p = shared.value
        index, classes = p.index().get, p.model_words
        for b in slices(batches, "text"):
            words, own, row = words_of(b.column("text"))
            rows, words = b.num_rows, [*words, END]
            at = np.array([index(w, -1) for w in words], np.int64)
            cls = np.array([0 if k >= 0 else class_of(w) for w, k in zip(words, at.tolist())], np.int64)
            # Every row's words, then its end.
            size = np.bincount(row, minlength=rows) + 1
            upto = np.concatenate([[0], np.cumsum(size)])
            token, owner = np.full(upto[-1], len(words) - 1), np.repeat(np.arange(rows), size)
            token[np.arange(len(own)) + row] = own
            out = at < 0
            ids = np.where(out, classes + cls, p.ids[at])[token]
            known, base, share = (np.bincount(owner, weights=np.where(out, 0, x[at])[token], minlength=rows) for x in (p.counts > 0, p.base, p.share))
            rare_row = owner[out[token]]
            pair, tf = np.unique(rare_row * len(words) + token[out[token]], return_counts=True)
            pair_row, word = np.divmod(pair, len(words))
            flat = pa.ListArray.from_arrays(upto.astype(np.int32), pa.array(ids, pa.int16()))
            found = pa.ListArray.from_arrays(pa.array(np.searchsorted(pair_row, np.arange(rows + 1)), pa.int32()), pa.StructArray.from_arrays(
                [pa.array(words, pa.binary()).take(pa.array(word)), pa.array(tf, pa.int32()), pa.array(cls[word], pa.int32())], fields=list(rare)))
            known = known.astype(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("uid"), b.column("doc_id"), b.column("held_out"), *[pa.array(x, t) for x, t in
                                             ((size, pa.int64()), (known, pa.int64()), (base, pa.float64()), (share, pa.float64()))], flat, found], schema=schema)

    return df.mapInArrow(run, "uid bigint, doc_id bigint, held_out boolean, n_tokens bigint, known bigint, base double, share double, ids array<smallint>, "
                              "rare array<struct<word:binary,tf:int,cls:int>>")


def _flat_ids(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a batch and where each row starts (every row holds its end at least)."""
    col = b.column("ids")
    size = np.diff(np.asarray(col.offsets))
    return np.asarray(col.flatten()).astype(np.int64), np.concatenate([[0], np.cumsum(size)[:-1]])


def train(rows: DataFrame, p: Prepared) -> Model:
    """Rounds of parallel training over all rows, with averaged parameters in between."""
    model = Model(p.unigram)
    end, sc = p.end, rows.sparkSession.sparkContext
    for r in range(ROUNDS):
        start = sc.broadcast(model)

        def run(batches, r=r, start=start):
            from copy import deepcopy

            from pyspark import TaskContext

            t = Trainer(deepcopy(start.value), 1000 * r + TaskContext.get().partitionId())
            seen = 0
            rest = [np.empty(0, np.int64)] * 3
            for b in batches:
                if not b.num_rows:
                    continue
                ids, first = _flat_ids(b)
                all_ = [np.concatenate(x) for x in zip(rest, (ids, *contexts(ids, first, end)))]
                # Steps draw their tokens from the whole batch of rows, not from one text.
                order = t.rng.permutation(len(all_[0]))
                cut = len(order) // BATCH * BATCH
                for k in range(0, cut, BATCH):
                    t.step(*[x[order[k:k + BATCH]] for x in all_])
                rest = [x[order[cut:]] for x in all_]
                seen += len(ids)
            if len(rest[0]):
                t.step(*rest)
            if seen:
                flat = np.concatenate([t.m.flat() * seen, [seen]])
                parts = np.array_split(flat, PARTS)
                yield record(_PART, [np.arange(PARTS), parts])

        mine = rows.where(F.pmod(F.xxhash64("uid"), F.lit(ROUNDS)) == r).select("ids")
        got = sum_arrays(mine.mapInArrow(run, "part int, vals array<double>"))
        if got:
            flat = np.concatenate([got[k] for k in range(PARTS)])
            model.load(flat[:-1] / flat[-1])
    return model


def context_scores(rows: DataFrame, model: Model, end: int) -> DataFrame:
    """Rows without ids, but with ctx: log10 probability of the ids."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    kept = ["uid", "doc_id", "held_out", "n_tokens", "known", "base", "share"]
    types = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
    schema = pa.schema([*zip(kept, types), ("ctx", pa.float64())])

    def run(batches):
        a = None
        for b in batches:
            if not b.num_rows:
                continue
            if a is None:
                a, far_part, z = shared.value.tables()
            ids, first = _flat_ids(b)
            near, far = contexts(ids, first, end)
            logp = (a[near, ids] + far_part[far, ids] - z[near, far]).astype(np.float64) / math.log(10)
            yield record(schema, [*map(b.column, kept), pa.array(np.add.reduceat(logp, first))])

    return rows.select(*kept, "ids").mapInArrow(run, "uid bigint, doc_id bigint, held_out boolean, n_tokens bigint, known bigint, base double, share double, ctx double")


def rare_scores(rows: DataFrame, counts: DataFrame, p: Prepared) -> DataFrame:
    """(uid, known, base, share) sums over the words that aren't in the lexicon."""
    r = rows.select("uid", F.explode("rare").alias("r")).select("uid", "r.word", "r.tf", "r.cls").join(counts, "word", "left")
    c1 = F.log10(F.coalesce("c", F.lit(0)) + 1)
    of_class = F.element_at(F.array(*[F.lit(float(x)) for x in p.class_log]), F.col("cls") + 1)
    return r.groupBy("uid").agg(F.sum(F.when(F.col("c") > 0, F.col("tf")).otherwise(0)).alias("known2"),
                                F.sum(F.col("tf") * (c1 - math.log10(p.n + p.v + 1))).alias("base2"), F.sum(F.col("tf") * (c1 - of_class)).alias("share2"))


def score(df: DataFrame, held_out) -> DataFrame:
    """Scores of all rows (doc_id, text) by a model of those that ``held_out`` doesn't mark."""
    src = df.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out.alias("held_out"))
    counts = write_stage(word_counts(src.where(~F.col("held_out"))), "word-counts")
    p = prepare(counts)
    rows = write_stage(tokenized(src.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "held_out", "text"), p), "token-ids")
    model = train(rows.where(~F.col("held_out")), p)
    zero = F.lit(0.0)
    return (context_scores(rows, model, p.end).join(rare_scores(rows, counts, p), "uid", "left")
            .select("doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("known2", F.lit(0))).cast("long").alias("n_known"), F.lit(p.n).cast("long").alias("train_tokens"),
                    (F.col("base") + F.coalesce("base2", zero)).alias("base_score"), (F.col("ctx") + F.col("share") + F.coalesce("share2", zero)).alias("score")))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents, learned from the rows outside fold 2 of 7."""
    return score(table(spark, sf_dir, "documents"), crc_fold(F.col("doc_id"), 7) == 2)
