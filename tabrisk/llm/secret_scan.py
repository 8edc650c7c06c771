"""Secret scanner: keyword automaton, anchored expressions at its hits, checksum validation.

An Aho-Corasick automaton over the lower-cased bytes finds every place where a secret can
start; an anchored expression runs only there. Hex runs have no keyword: the text is mapped
to two classes and the run of 24 class bytes is the "keyword". Tokens with an embedded
checksum (GitHub, npm) count only when the CRC-32 in their last six characters fits.

Input: any frame with an id and a text column; other columns are ignored. Null and empty
texts have no spans. Repeated rows each give a row. Offsets are code points, end exclusive.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabrisk.llm.common import map_slices, record, table, texts

# Kinds in reporting order, keywords, expressions and smallest lengths.
KINDS = ["assign", "access", "hex", "github", "npm"]
BASE = KINDS[:3]
KEYWORDS = {"password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "apikey": "assign", "api_key": "assign",
            "akia": "access", "ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github", "npm_": "npm"}
ANCHORED = {
    "assign": re.compile(rb"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    "access": re.compile(rb"(AKIA[A-Z0-9]+)"),
    "github": re.compile(rb"gh[pousr]_([0-9A-Za-z]{36})(?![0-9A-Za-z])"),
    "npm": re.compile(rb"npm_([0-9A-Za-z]{36})(?![0-9A-Za-z])"),
}
SHORTEST = {"assign": 6, "access": 20, "hex": 24, "github": 36, "npm": 36}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
HEX_CLASS = bytes(ord("h") if c in b"0123456789abcdef" else ord(".") for c in range(256))

_automaton = None


def automaton():
    global _automaton
    if _automaton is None:
        a = ahocorasick.Automaton()
        for word, kind in KEYWORDS.items():
            a.add_word(word, (len(word), kind))
        a.make_automaton()
        _automaton = a
    return _automaton


def checksum_fits(body: bytes) -> bool:
    """Last six characters: CRC-32 of the rest in base 62, padded with zeros."""
    n, digits = zlib.crc32(body[:-6]), ""
    while n:
        n, d = divmod(n, 62)
        digits = BASE62[d] + digits
    return digits.rjust(6, "0") == body[-6:].decode()


def byte_spans(data: bytes) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of all spans in bytes, by start, then kind."""
    found = []
    hits = sorted((end + 1 - n, kind) for end, (n, kind) in automaton().iter(data.lower().decode("latin-1")))
    over = dict.fromkeys(KINDS, 0)
    for start, kind in hits:
        if start < over[kind]:
            continue
        if m := ANCHORED[kind].match(data, start):
            over[kind] = m.end()
            if len(m[1]) >= SHORTEST[kind] and (kind in BASE or checksum_fits(m[1])):
                found.append((start, KINDS.index(kind), m.end()))
    classes, run = data.translate(HEX_CLASS), b"h" * SHORTEST["hex"]
    start = classes.find(run)
    while start >= 0:
        end = classes.find(b".", start)
        end = len(data) if end < 0 else end
        found.append((start, KINDS.index("hex"), end))
        start = classes.find(run, end)
    return sorted(found)


def spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of all spans in code points, by start, then kind."""
    data = text.encode()
    found = byte_spans(data)
    if found and len(data) != len(text):
        first = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
        at = np.concatenate([[0], np.cumsum(first)])
        found = [(int(at[s]), k, int(at[e])) for s, k, e in found]
    return found


def described(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in found)


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``spans`` array of (kind, start, end_)."""
    schema = pa.schema([("id", pa.int64()), ("spans", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end_", pa.int64())])))])

    def run(b):
        return record(schema, [b.column("id").cast(pa.int64()), [[{"kind": KINDS[k], "start": s, "end_": e} for s, k, e in spans(t)] for t in texts(b)]])

    src = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_slices(src, run, "id bigint, spans array<struct<kind:string,start:bigint,end_:bigint>>").withColumnRenamed("id", id_col)


MASK = "[SECRET]"


def masked(text: str | None) -> str | None:
    """The text with every span (overlapping ones joined) replaced by a fixed mark."""
    if not text:
        return text
    out, at = [], 0
    for s, _, e in spans(text):
        if s >= at:
            out += [text[at:s], MASK]
        at = max(at, e)
    return "".join([*out, text[at:]])


def mask(df: DataFrame) -> DataFrame:
    """The rows of ``df`` with the secrets in text masked, and n_chars counted anew where that was done."""
    def run(b):
        old = b.column("text").to_pylist()
        new = [masked(t) for t in old]
        out = dict(zip(b.schema.names, b.columns))
        out["text"] = pa.array(new, b.schema.field("text").type)
        if "n_chars" in out:
            n = [len(t) if t != was else c for t, was, c in zip(new, old, out["n_chars"].to_pylist())]
            out["n_chars"] = pa.array(n, b.schema.field("n_chars").type)
        return pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    return map_slices(df, run, df.schema)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, digest and list of the secrets of every document."""
    docs = scan(table(spark, sf_dir, "documents"))
    text = lambda arr: F.array_join(F.transform(arr, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end_"].cast("string"))), ",")
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"].isin(BASE))
    return docs.select("doc_id", *[of(k).alias(f"n_{k}") for k in BASE], F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))
