"""Best-fit packing of tokenized documents by linear grouping.

Pieces longer than ``SMALL`` are sorted by length and cut into groups of equal cardinality;
each group's lengths are rounded up to its largest. For these few sizes a configuration
program (how many sequences hold which multiset of sizes) is solved by column generation.
Whole configurations are used; actual pieces take the rounded slots, and what is left over,
large or small, is placed best fit in decreasing order into the room that really remains.

Lengths are whole numbers up to the capacity, so a histogram of at most ``capacity`` counts
says all about the input: the plan is made on the driver from it, as runs (length, first
rank, count, first sequence, offset), whose number depends on the capacity and not on the
rows. Tasks number pieces per length; a run gives every piece its place. No document
travels.

Null and empty texts are one piece with the end id alone. Repeated rows are packed as often
as they occur. Nothing is dropped or cut but documents longer than the capacity.
"""

from __future__ import annotations

import bisect
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabrisk.llm.bpe import byte_symbols
from tabrisk.llm.common import cut_chunks, flat_bytes, join_chunks, record, slices, table, word_begins, write_stage

CAPACITY = 2048
GROUPS = (160, 60, 20)
SMALL = 900  # pieces up to here are best fitted only
END_ID = 0
KEEP = 32 << 20  # estimated bytes of the words in each of two memo generations
SEPARATOR = "<|startoftext|>"  # a special token of the vocabulary: its id marks borders in one long call


# --- tokenizing -----------------------------------------------------------------------------------

class WordTokenizer:
    """Ids of texts by the tokenizers library, word by word with a bounded memo.

    The vocabulary's normaliser (which lower-cases) and pre-tokenizer never reach across white
    space, so the ids of a text are those of its words in turn. Words not in the memo go
    through the library in one call, with a special token between them; ASCII marks at the
    end of a word are separate pre-tokens there and are looked up apart."""

    TAIL = b".,;:!?%$&#*|"
    PLAIN = re.compile("[a-zß-öø-ÿ]+")  # letters that normalising leaves alone

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.bytes = {b: c for c, b in byte_symbols().items()}

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.mark = self.tok.token_to_id(SEPARATOR)
        self.special = [t.content.encode() for t in self.tok.get_added_tokens_decoder().values()]
        self.memo: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.size = 0

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4")

    def _library(self, words: list[bytes]) -> None:
        memo, model = self.memo, self.tok.model
        rest = []
        for w in words:
            if self.PLAIN.fullmatch(w.decode()):
                # One lower-case word as it stands: straight to the library's model.
                memo[w] = array("I", [t.id for t in model.tokenize(w.decode("latin-1").translate(self.bytes))]).tobytes()
            else:
                rest.append(w)
        for k in range(0, len(rest), 2000):
            part = rest[k:k + 2000]
            ids = self._encode(SEPARATOR.join(w.decode() for w in part))
            cut = [-4, *(np.flatnonzero(ids == self.mark) * 4).tolist(), 4 * len(ids)]
            data = ids.tobytes()
            for w, a, b in zip(part, cut, cut[1:]):
                memo[w] = data[a + 4:b]

    def _learn(self, words: set[bytes]) -> None:
        """Put words that aren't in the memo there."""
        memo, old = self.memo, self.old
        need: set[bytes] = set()
        split = []
        for w in words:
            if (known := old.get(w)) is not None:
                memo[w] = known
                continue
            stem = w.rstrip(self.TAIL)
            if len(stem) < len(w) and stem[-1:].isalnum():
                tail = w[len(stem):]
                split.append((w, stem, tail))
                need.add(stem)
                need.add(tail)
            elif SEPARATOR.encode() in w:
                memo[w] = self._encode(w.decode()).tobytes()
            else:
                need.add(w)
        rest = []
        for w in need:
            if w not in memo:
                if (known := old.get(w)) is not None:
                    memo[w] = known
                elif SEPARATOR.encode() in w:
                    memo[w] = self._encode(w.decode()).tobytes()
                else:
                    rest.append(w)
        self._library(rest)
        for w, stem, tail in split:
            memo[w] = memo[stem] + memo[tail]

    def encode(self, column: pa.Array) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text. Distinct words are looked up once, rows are put together by number."""
        data, off = flat_bytes(column)
        raw = data.tobytes()
        lower = raw.lower()
        data = np.frombuffer(lower, np.uint8)
        if any(s in lower for s in self.special):
            # Special tokens are matched before lower-casing.
            data = data.copy()
            for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
                if any(s in lower[a:b] for s in self.special):
                    data[a:b] = np.frombuffer(raw[a:b], np.uint8)
        cut, first = cut_chunks(data, off, word_begins(data))
        words = [c.strip() for c in cut.dictionary.to_pylist()]
        if self.size > KEEP:
            self.old, self.memo, self.size = self.memo, {}, 0
        missing = set(words) - self.memo.keys()
        self._learn(missing)
        memo = self.memo
        self.size += sum([200 + len(w) + len(memo[w]) for w in missing])
        return join_chunks(cut.indices, first, [memo[w] for w in words], b"").to_pylist()


_tokenizers: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def pieces(df: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, task, rank): rank counts a task's pieces of a length."""
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                        ("task", pa.int32()), ("rank", pa.int64())])

    def run(batches):
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        end = np.array([END_ID], "<u4").tobytes()
        for b in slices(batches, "text"):
            rows = []
            for doc, data in zip(b.column("doc_id").to_pylist(), tokenizer(path).encode(b.column("text"))):
                data += end
                for k, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at:at + 4 * capacity]
                    n = len(part) // 4
                    rows.append((doc, k, at // 4, n, zlib.crc32(part), task, int(seen[n])))
                    seen[n] += 1
            yield record(schema, list(map(list, zip(*rows))))

    src = df.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, task int, rank bigint")


# --- planning, on the histogram of lengths -------------------------------------------------------------

def best_pattern(sizes: np.ndarray, value: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The multiset of sizes that fits the capacity and has the largest value (unbounded knapsack)."""
    best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    order = np.argsort(sizes)
    s, v = sizes[order], value[order]
    for c in range(int(s[0]), capacity + 1):
        k = int(np.searchsorted(s, c, side="right"))
        total = best[c - s[:k]] + v[:k]
        j = int(total.argmax())
        best[c], pick[c] = (total[j], j) if total[j] > best[c - 1] else (best[c - 1], -1)
    counts, c = np.zeros(len(sizes)), capacity
    while c >= s[0]:
        if pick[c] < 0:
            c -= 1
        else:
            counts[order[pick[c]]] += 1
            c -= int(s[pick[c]])
    return float(best[capacity]), counts


def configurations(sizes: np.ndarray, need: np.ndarray, capacity: int, rounds: int = 2000) -> list[tuple[np.ndarray, int]]:
    """Configurations and how many whole sequences use each, from the linear program's optimum.

    Revised simplex with columns generated by ``best_pattern``; stops at the optimum or after
    ``rounds`` pivots (any basis on the way is a valid, if weaker, plan)."""
    g = len(sizes)
    basis = np.zeros((g, g))
    np.fill_diagonal(basis, capacity // sizes)
    x = need / np.diag(basis)
    inverse = np.diag(1 / np.diag(basis))
    for step in range(rounds):
        dual = inverse.sum(axis=0)
        value, column = best_pattern(sizes, np.maximum(dual, 0), capacity)
        if value <= 1 + 1e-7:
            break
        d = inverse @ column
        up = d > 1e-9
        if not up.any():
            break
        ratio = np.where(up, x / np.where(up, d, 1), np.inf)
        out = int(ratio.argmin())
        t = ratio[out]
        x -= t * d
        x[out] = t
        basis[:, out] = column
        inverse[out] /= d[out]
        for r in range(g):
            if r != out:
                inverse[r] -= d[r] * inverse[out]
        if step % 100 == 99:
            inverse = np.linalg.inv(basis)
            x = np.maximum(inverse @ need, 0)
    return [(basis[:, j].astype(int), int(x[j] + 1e-9)) for j in range(g) if x[j] >= 1]


class Plan:
    """Runs of equal pieces in consecutive sequences, made from a histogram of lengths."""

    def __init__(self, histogram: np.ndarray, capacity: int = CAPACITY, groups: int = GROUPS[0], small: int = SMALL):
        self.capacity = capacity
        self.left = histogram.astype(np.int64).copy()  # pieces to place, by length
        self.taken = np.zeros(len(histogram), np.int64)
        self.runs: list[tuple[int, int, int, int, int]] = []
        self.bins = 0
        self.room: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # residual room -> (first sequence, count)
        self.open: list[int] = []  # residuals in use, sorted
        if groups:
            self._grouped(groups, small)
        self._best_fit()

    def _place(self, length: int, count: int, first: int, offset: int) -> None:
        self.runs.append((length, int(self.taken[length]), count, first, offset))
        self.taken[length] += count
        self.left[length] -= count

    def _add_room(self, room: int, first: int, count: int) -> None:
        if not self.room[room]:
            bisect.insort(self.open, room)
        self.room[room].append((first, count))

    def _grouped(self, groups: int, small: int) -> None:
        lengths = np.arange(len(self.left))
        large = (lengths > small) & (self.left > 0)
        total = int(self.left[large].sum())
        if not total:
            return
        # Group of a length: by the cardinality above it; equal lengths stay together.
        desc = lengths[large][::-1]
        group = (np.cumsum(self.left[desc]) - self.left[desc]) * groups // total
        names = np.unique(group)
        members = [desc[group == k] for k in names]
        sizes = np.array([m[0] for m in members])
        need = np.array([self.left[m].sum() for m in members], float)
        queues = [[int(v) for v in m] for m in members]  # lengths of a group, longest first

        def draw(k: int, count: int) -> list[tuple[int, int]]:
            got = []
            while count and queues[k]:
                v = queues[k][0]
                n = min(count, int(self.left[v]) - drawn.get(v, 0))
                if n:
                    got.append((v, n))
                    drawn[v] = drawn.get(v, 0) + n
                    count -= n
                if drawn.get(v, 0) == self.left[v]:
                    queues[k].pop(0)
            return got

        drawn: dict[int, int] = {}
        for column, uses in configurations(sizes, need, self.capacity):
            first, self.bins = self.bins, self.bins + uses
            slots = [draw(k, uses) for k in np.flatnonzero(column) for _ in range(column[k])]
            # Cut the configuration's sequences where the actual length of some slot changes.
            cuts = sorted({0, uses, *(int(c) for s in slots for c in np.cumsum([n for _, n in s]))})
            at, used = [0] * len(slots), [0] * len(slots)
            for lo, hi in zip(cuts, cuts[1:]):
                offset = 0
                for j, s in enumerate(slots):
                    if at[j] >= len(s):
                        continue
                    v, n = s[at[j]]
                    self.runs.append((v, int(self.taken[v]), hi - lo, first + lo, offset))
                    self.taken[v] += hi - lo
                    offset += v
                    used[j] += hi - lo
                    if used[j] == n:
                        at[j], used[j] = at[j] + 1, 0
                self._add_room(self.capacity - offset, first + lo, hi - lo)
        for v, n in drawn.items():
            self.left[v] -= n

    def _best_fit(self) -> None:
        for length in range(len(self.left) - 1, 0, -1):
            while self.left[length]:
                k = bisect.bisect_left(self.open, length)
                if k == len(self.open):
                    n = -(-int(self.left[length]) // (self.capacity // length))
                    self._add_room(self.capacity, self.bins, n)
                    self.bins += n
                    continue
                room = self.open[k]
                first, count = self.room[room].pop()
                n = min(count, int(self.left[length]))
                if n < count:
                    self.room[room].append((first + n, count - n))
                if not self.room[room]:
                    self.open.pop(k)
                self._place(length, n, first, self.capacity - room)
                if room > length:
                    self._add_room(room - length, first, n)

    def table(self) -> np.ndarray:
        """Runs sorted by length, then first rank: columns length, rank, count, sequence, offset."""
        out = np.array(self.runs, np.int64).reshape(-1, 5)
        return out[np.lexsort((out[:, 1], out[:, 0]))]


def plan(histogram: np.ndarray, capacity: int = CAPACITY) -> Plan:
    """The plan with fewest sequences over a few numbers of groups."""
    return min((Plan(histogram, capacity, g, SMALL * capacity // CAPACITY) for g in GROUPS), key=lambda p: p.bins)


def pack(df: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Every piece of every document (doc_id, text) with its sequence and its place there."""
    rows = write_stage(pieces(df, path, capacity), "pieces")
    counts = rows.groupBy("task", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    histogram = np.zeros(capacity + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``capacity`` rows
        histogram[r["length"]] = r["n"]
    runs = df.sparkSession.sparkContext.broadcast(plan(histogram, capacity).table())  # bounded by the capacity
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                        ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def place(batches):
        t = runs.value
        key = (t[:, 0] << 40) | t[:, 1]
        for b in batches:
            length, rank = np.asarray(b.column("length")), np.asarray(b.column("rank"))
            at = np.searchsorted(key, (length << 40) | rank, side="right") - 1
            yield record(schema, [*[b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")], t[at, 3] + rank - t[at, 1], t[at, 4]])

    ranked = rows.join(offsets, ["task", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank"))
    return ranked.mapInArrow(place, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
