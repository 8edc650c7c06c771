"""Byte-level BPE by dynamic programming over prefixes, exact to the last id.

For every prefix of a pre-token there is one token that its encoding ends with: the
vocabulary token that ends there (found by an automaton over all vocabulary entries) and is
compatible with the last token of what stands before it. Two tokens are compatible if no
merge across their border would have come before the merges that built them. Following the
stored last tokens back from the end gives the ids.

The vocabulary file is a parameter. Texts are cut at single spaces into chunks that the
pre-tokenizer can't match across. The chunks of a slice of rows are numbered, each distinct one
is encoded once, and rows are put together again by number; results are kept in a memo of a
bounded number of bytes.
Null texts count as empty (no ids); special tokens' strings in a text become their ids, as
the tokenizers library does by default. Repeated rows each give a row.
"""

from __future__ import annotations

import hashlib
import json
import re

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabrisk.llm.common import WHITE, cut_chunks, flat_bytes, join_chunks, map_slices, record, table

# White space (Unicode property) and the pre-tokenizer's pattern.
WS = r"\t-\r \x85\xa0  -     　"
PRETOKEN = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WS}\p{{L}}\p{{N}}]+|[{WS}]+(?![^{WS}])|[{WS}]+")
# A chunk starts at a space between two characters that aren't white space.
CHUNK = re.compile(rf"(?<=[^{WS}])(?= [^{WS}])")
ODD = re.compile(rf"[{WS}][{WS}]|^ | $")
NEVER = 1 << 30
KEEP = 48 << 20  # estimated bytes of a memo in each of two generations

# First bytes of all wide white space that Unicode has.
_WIDE = np.zeros(256, bool)
_WIDE[[0xE1, 0xE2, 0xE3]] = True
_NEXT = WHITE | _WIDE
_NEXT[0xC2] = True


def byte_symbols() -> dict[str, int]:
    """The printable stand-in of every byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def chunk_begins(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Marks single spaces between two characters of a row that aren't white space. A space beside a
    character that might be wide white space, judged by its first byte, isn't marked, which is as right."""
    got = data == 32
    prev, after = np.zeros(len(data), bool), np.ones(len(data), bool)
    prev[1:] = WHITE[data[:-1]]
    prev[2:] |= data[:-2] == 0xC2
    prev[3:] |= _WIDE[data[:-3]]
    after[:-1] = _NEXT[data[1:]]
    got &= ~(prev | after)
    got[off[1:][off[1:] > 0] - 1] = False  # a row's last byte
    return got


class Memo(dict):
    """A dict that computes missing values and forgets what a whole generation didn't use; bounded by bytes."""

    def __init__(self, compute, keep: int = KEEP):
        super().__init__()
        self.compute, self.keep, self.old, self.size = compute, keep, {}, 0

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        cost = 280 + 10 * len(key)
        if cost > self.keep >> 4:
            return value
        if self.size + cost > self.keep:
            self.old, self.size = dict(self), 0
            self.clear()
        self.size += cost
        self[key] = value
        return value


class Encoder:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = byte_symbols()
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        raw = {i: bytes(to_byte[c] for c in s) for s, i in vocab.items() if s not in self.special}
        self.raw = raw | {i: s.encode() for s, i in self.special.items()}
        self.special_split = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))) if self.special else None
        n = max(self.raw) + 1
        # The merge that makes a token (rank -1: a byte), and the two parts it joins.
        self.rank, self.left, self.right = [-1] * n, [-1] * n, [-1] * n
        self.merge: dict[int, int] = {}
        for r, m in enumerate(spec["model"]["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            ia, ib, made = vocab[a], vocab[b], vocab[a + b]
            self.merge[ia << 20 | ib] = r
            if self.rank[made] < 0:
                self.rank[made], self.left[made], self.right[made] = r, ia, ib
        self.good: set[int] = set()  # pairs of tokens that are compatible, and that are not
        self.bad: set[int] = set()
        auto = ahocorasick.Automaton()
        self.whole: dict[str, int] = {}
        sound: dict[int, bool] = {}
        for i in sorted(raw, key=self.rank.__getitem__):
            # A token counts if BPE of its own bytes gives it: its parts do, and nothing crosses their border earlier.
            sound[i] = len(raw[i]) == 1 or self.rank[i] >= 0 and sound[self.left[i]] and sound[self.right[i]] and self.uncrossed(self.left[i], self.right[i], True)
            if sound[i]:
                s = raw[i].decode("latin-1")
                auto.add_word(s, (len(s), i))
                self.whole[s] = i
        auto.make_automaton()
        self.auto = auto
        self.chunks, self.pieces = Memo(self.chunk), Memo(self.piece)

    def uncrossed(self, a: int, b: int, own: bool = False) -> bool:
        """Would BPE leave the border between tokens a and b alone? Walks back in time: the part
        built last falls into the two it was made of; at each moment the parts at the border could merge.
        ``own``: the merge of a and b themselves doesn't count."""
        rank, merge = self.rank, self.merge
        a_ends = b_ends = NEVER  # ranks of the merges that swallow the present parts
        while True:
            m = merge.get(a << 20 | b)
            # Equal ranks merge from the left.
            if m is not None and m < a_ends and m <= b_ends and not own:
                return False
            own = False
            ra, rb = rank[a], rank[b]
            if ra > rb:
                a_ends, a = ra, self.right[a]
            elif rb >= 0:
                b_ends, b = rb, self.left[b]
            else:
                return True

    def pretoken(self, s: str) -> list[int]:
        """Ids of one pre-token, given as bytes in latin-1."""
        one = self.whole.get(s)
        if one is not None:
            return [one]
        good, bad = self.good, self.bad
        # By a prefix's last character: its last token (moved left, so that a pair is one number), and where the prefix before it ends.
        n = len(s) - 1
        last, before = [-1] * (n + 1), [0] * (n + 1)
        for end, (size, tok) in self.auto.iter(s):
            if last[end] < 0:
                at = end - size
                if at >= 0:
                    key = last[at] | tok
                    if key not in good:
                        if key in bad:
                            continue
                        if len(good) + len(bad) > 2_000_000:
                            good.clear()
                            bad.clear()
                        if not self.uncrossed(last[at] >> 20, tok):
                            bad.add(key)
                            continue
                        good.add(key)
                last[end], before[end] = tok << 20, at
        ids: list[int] = []
        while n >= 0:
            ids.append(last[n] >> 20)
            n = before[n]
        ids.reverse()
        return ids

    def chunk(self, text: str) -> tuple[str, bytes]:
        """Ids as decimal text, and the bytes that they decode to."""
        if text.isascii() and text.removeprefix(" ").isalpha():
            return self.pieces[text]
        parts = PRETOKEN.findall(text)
        if len(parts) == 1:
            return self.pieces[parts[0]]
        got = [self.pieces[p] for p in parts]
        return ",".join([g[0] for g in got]), b"".join([g[1] for g in got])

    def piece(self, pretoken: str) -> tuple[str, bytes]:
        ids = self.pretoken(pretoken if pretoken.isascii() else pretoken.encode().decode("latin-1"))
        return ",".join(map(str, ids)), b"".join(map(self.raw.__getitem__, ids))

    def _plain(self, text: str) -> list[tuple[str, bytes]]:
        if not text:
            return []
        if ODD.search(text):
            parts = CHUNK.split(text)
        else:
            first, *rest = text.split(" ")
            parts = [first, *[" " + w for w in rest]]
        return list(map(self.chunks.__getitem__, parts))

    def encode(self, text: str) -> tuple[str, str]:
        """Ids joined by commas, and the decoded text."""
        if self.special_split is None or not self.special_split.search(text):
            got = self._plain(text)
        else:
            got, at = [], 0
            for m in self.special_split.finditer(text):
                got += self._plain(text[at:m.start()])
                i = self.special[m[0]]
                got.append((str(i), self.raw[i]))
                at = m.end()
            got += self._plain(text[at:])
        return ",".join([g[0] for g in got]), b"".join([g[1] for g in got]).decode("utf-8", "replace")


    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, list[bytes], list[bytes]]:
        """Per row: number of ids, ids joined by commas, the bytes that they decode to."""
        data, off = flat_bytes(column)
        cut, first = cut_chunks(data, off, chunk_begins(data, off))
        got = [self.chunks[c.decode()] for c in cut.dictionary.to_pylist()]
        ids = [g[0].encode() for g in got]
        # Every chunk holds a byte, so it has an id.
        size = np.array([x.count(b",") + 1 for x in ids], np.int64).reshape(-1)
        upto = np.concatenate([[0], np.cumsum(size[np.asarray(cut.indices)])])
        n = upto[first[1:]] - upto[first[:-1]]
        ids, raw = (join_chunks(cut.indices, first, x, sep).to_pylist() for x, sep in ((ids, b","), ([g[1] for g in got], b"")))
        if self.special:
            whole = pc.fill_null(column, "")
            for i in np.flatnonzero(np.any([pc.match_substring(whole, s).to_numpy(zero_copy_only=False) for s in self.special], axis=0)).tolist():
                text, back = self.encode(whole[i].as_py())
                n[i], ids[i], raw[i] = text.count(",") + 1 if text else 0, text.encode(), back.encode()
        return n, ids, raw


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker and vocabulary."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ids (decimal, joined by commas) and the text they decode to."""
    schema = pa.schema([("id", pa.int64()), ("ids", pa.string()), ("decoded", pa.string())])

    def run(b):
        _, ids, raw = encoder(path).encode_column(b.column("text"))
        return record(schema, [b.column("id"), [x.decode() for x in ids], [x.decode("utf-8", "replace") for x in raw]])

    src = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_slices(src, run, "id bigint, ids string, decoded string").withColumnRenamed("id", id_col)


def digests(df: DataFrame, path: str) -> DataFrame:
    """Counts and digests of ids and decoded text, made where the text is encoded."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(b):
        n, ids, raw = encoder(path).encode_column(b.column("text"))
        return record(schema, [b.column("doc_id"), n, [hashlib.sha256(x).hexdigest() for x in ids],
                               [hashlib.sha256(x.decode("utf-8", "replace").encode()).hexdigest() for x in raw]])

    return map_slices(df.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")), run,
                      "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    import public_tokenizers

    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
