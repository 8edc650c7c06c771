"""Exact Jaccard self-join on word shingles with adaptive multi-match prefixes.

A document's set holds its distinct shingles of five words, as 64-bit hashes. All sets share
one order of shingles, rare ones first, where rarity is estimated by a count sketch of fixed
size over the whole corpus. If two sets of n shingles overlap in at least t = ceil(0.8 n), their
prefixes of n - t + k shingles share at least k, for every k. Each document picks the k
(``match``) with the least estimated cost: a longer prefix is scanned, but a candidate then needs
more shared prefix shingles before it is verified. How many a pair needs follows from both
sizes and both prefix lengths, by the same rule with the overlap that the pair itself needs.

Only components are asked for, so pairs inside a component that is already known are never
made. Equal sets are one node. A first round verifies every node against one leader per
minimum hash, the node whose shingles are the most shared, which joins large groups of copies in
linear work. The prefix join then makes pairs across components only, and of these only pairs that could
link by size and by parity bits: 256 bits a node, each the parity of the shingles that fall there, so that
two nodes' bits never differ in more places than their sets differ in shingles. A shingle that very many nodes share is split: its rows are dealt
to chunks, and only rows outside its most common component visit all chunks.

Defined results: a text with 1 to 4 words has one shingle, the whole; null texts and texts
without words have an empty set, link with nothing and are their own component. Rows with a
null id are kept, join sets like others, but never name a component unless alone in it (null).
Repeated ids are separate rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabrisk.llm.common import BLOOM_BITS, bloom, bloom_hit, mix64, raw_texts, record, slices, table, write_stage
from tabrisk.llm.components import components

WORDS = 5
PERCENT = 80
CELLS = 1 << 20  # of the count sketch
SKETCH_PARTS = 1024
SEEDS = 4  # minimum hashes per node for the first round
RUN = 512  # nodes that share a shingle and are paired in one go
PIECE = 1 << 18  # bytes hashed at once
PAIRS = 200_000  # looked at in one go
PARITY = 256  # bits that hold the parity of a set's shingles
_BITS = [f"b{i}" for i in range(PARITY // 64)]
MATCHES = np.array([1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128, 192, 256])

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_ODD = mix64(np.arange(1, 65, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_powers = np.ones(1, np.uint64)


def _power_table(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        _powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(n, 1024) - 1, _ODD[60], np.uint64)]))
    return _powers


def word_hashes(datas: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash and text number of every word of the lower-cased texts."""
    joined = np.frombuffer(b"\n".join(datas).lower() + b"\n", np.uint8)
    space = _SPACE[joined]
    edge = np.flatnonzero(np.diff(space, prepend=True))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    size = ends - starts
    inside = np.flatnonzero(~space)
    first = np.concatenate([[0], np.cumsum(size)[:-1]])
    offset = np.arange(len(inside)) - np.repeat(first, size)
    terms = (joined[inside].astype(np.uint64) + np.uint64(1)) * _power_table(int(size.max()))[offset]
    h = mix64(np.add.reduceat(terms, first) + size.astype(np.uint64) * _ODD[61])
    bounds = np.cumsum(np.fromiter(map(len, datas), np.int64, len(datas)) + 1)
    return h, np.searchsorted(bounds, starts, side="right")


def shingle_sets(datas: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text (int64)."""
    h, doc = word_hashes(datas)
    lo = np.searchsorted(doc, np.arange(len(datas)))
    hi = np.searchsorted(doc, np.arange(len(datas)), side="right")
    rolled = sum((h[j:len(h) - words + 1 + j] * _ODD[j] for j in range(words)), np.zeros(max(0, len(h) - words + 1), np.uint64)) if len(h) >= words else np.empty(0, np.uint64)
    rolled = mix64(rolled + _ODD[62]).view(np.int64)
    out = []
    for a, b in zip(lo, hi):
        if b - a >= words:
            out.append(np.unique(rolled[a:b - words + 1]))
        elif b > a:
            # The number of words takes part, so a short whole never equals a shingle of five.
            parts = np.concatenate([h[a:b], [np.uint64(b - a)]]) * np.concatenate([_ODD[:b - a], _ODD[63:]])
            out.append(mix64(parts.sum(keepdims=True)).view(np.int64))
        else:
            out.append(np.empty(0, np.int64))
    return out


def node_of(s: np.ndarray) -> int:
    """64 bits that stand for a set."""
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def sketch(df: DataFrame) -> np.ndarray:
    """Estimated number of distinct sets that hold a shingle, by the hash's low bits, less the cells' background."""
    schema = pa.schema([("part", pa.int32()), ("vals", pa.list_(pa.int32()))])

    def run(batches):
        cells = np.zeros(CELLS, np.int32)
        seen: set[int] = set()
        for b in slices(batches, "text", PIECE):
            new = []
            for s in shingle_sets(raw_texts(b)):
                if len(s) and (k := node_of(s)) not in seen:
                    seen.add(k)
                    new.append(s)
            if new:
                np.add.at(cells, np.concatenate(new) & (CELLS - 1), 1)
        parts = cells.reshape(SKETCH_PARTS, -1)
        used = np.flatnonzero(parts.any(axis=1))
        if len(used):
            yield record(schema, [used, list(parts[used])])

    def add(p: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": p["part"].iloc[:1], "vals": [np.sum([np.asarray(v, np.int64) for v in p["vals"]], axis=0)]})

    got = df.mapInArrow(run, "part int, vals array<int>").groupBy("part").applyInPandas(add, "part int, vals array<bigint>").toPandas()
    cells = np.zeros((SKETCH_PARTS, CELLS // SKETCH_PARTS), np.int64)
    for part, vals in zip(got["part"], got["vals"]):
        cells[part] = vals
    cells = cells.ravel()
    load = cells.mean()
    return np.minimum(np.maximum(cells - load - 3 * np.sqrt(load), 0), 2**31 - 2).astype(np.int32) + 1


def needed(n: int | np.ndarray, percent: int = PERCENT):
    """Least overlap of a set of n shingles with any partner: ceil(percent n / 100)."""
    return -(-n * percent // 100)


def prefix(s: np.ndarray, counts: np.ndarray, percent: int = PERCENT) -> tuple[int, np.ndarray]:
    """The match number of least estimated cost, and the prefix in the common order."""
    n = len(s)
    t = int(needed(n, percent))
    est = counts[s & (CELLS - 1)]
    options = MATCHES[MATCHES <= t]
    longest = min(n, n - t + int(options[-1]))
    if longest < n:
        kth = np.partition(est, longest - 1)[longest - 1]
        keep = est <= kth
        s, est = s[keep], est[keep]
    order = np.argsort(est, kind="stable")[:longest]  # equal estimates stay in order of the hash
    s, est = s[order], est[order]
    others = np.cumsum(est - 1, dtype=np.float64)
    size = n - t + options
    # Scanning a shingle's nodes, and verifying those that could share enough of them.
    cost = size + others[size - 1] * (1 + (20 + n / 50) / options)
    best = int(options[cost.argmin()])
    return best, s[:n - t + best]


def parity(s: np.ndarray) -> list[int]:
    """Bit by bit whether an odd number of shingles falls there. Two sets' bits differ in no more places than the sets differ in shingles."""
    odd = np.bincount((s.view(np.uint64) >> np.uint64(32)).astype(np.int64) & (PARITY - 1), minlength=PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def base_rows(df: DataFrame) -> DataFrame:
    """(doc_id, node, n) per row; node is null for an empty set."""
    schema = pa.schema([("doc_id", pa.int64()), ("node", pa.int64()), ("n", pa.int64())])

    def run(b):
        sets = shingle_sets(raw_texts(b))
        return record(schema, [b.column("doc_id"), [node_of(s) if len(s) else None for s in sets], [len(s) for s in sets]])

    return _cut(df, run, "doc_id bigint, node bigint, n bigint")


def _cut(df: DataFrame, fn, schema: str) -> DataFrame:
    def run(batches):
        for b in slices(batches, "text", PIECE):
            yield fn(b)
    return df.mapInArrow(run, schema)


def nodes(df: DataFrame, counts: np.ndarray) -> DataFrame:
    """(node, n, match, central, parity bits, mins, prefix) of every distinct set.

    ``central``: how many sets share one of its shingles, by the sketch, on average."""
    schema = pa.schema([("node", pa.int64()), ("n", pa.int32()), ("match", pa.int32()), ("central", pa.float64()), *[(c, pa.int64()) for c in _BITS],
                        ("mins", pa.list_(pa.int64())), ("prefix", pa.list_(pa.int64()))])
    shared = df.sparkSession.sparkContext.broadcast(counts)  # 4 MB whatever the corpus

    def run(batches):
        seen: set[int] = set()
        for b in slices(batches, "text", PIECE):
            rows = []
            for s in shingle_sets(raw_texts(b)):
                if len(s) and (k := node_of(s)) not in seen:
                    seen.add(k)
                    mins = [int(mix64(s.view(np.uint64) ^ _ODD[20 + j]).min().view(np.int64)) for j in range(SEEDS)]
                    match, p = prefix(s, shared.value)
                    rows.append((k, len(s), match, float(shared.value[s & (CELLS - 1)].mean()), *parity(s), mins, p))
            if rows:
                yield record(schema, list(map(list, zip(*rows))))

    got = df.select("text").mapInArrow(run, f"node bigint, n int, match int, central double, {', '.join(f'{c} bigint' for c in _BITS)}, mins array<bigint>, prefix array<bigint>")
    return got.groupBy("node").agg(*[F.first(c).alias(c) for c in ("n", "match", "central", *_BITS, "mins", "prefix")])


def sets_of(df: DataFrame, wanted: np.ndarray) -> DataFrame:
    """(node, s): the sets of nodes that a Bloom filter names (and a few more)."""
    schema = pa.schema([("node", pa.int64()), ("s", pa.list_(pa.int64()))])
    shared = df.sparkSession.sparkContext.broadcast(wanted)  # 1 MB

    def run(batches):
        seen: set[int] = set()
        for b in slices(batches, "text", PIECE):
            sets = [s for s in shingle_sets(raw_texts(b)) if len(s)]
            if not sets:
                continue
            ids = np.array([node_of(s) for s in sets], np.int64)
            hit = bloom_hit(shared.value, node_bits(ids))
            rows = []
            for i in np.flatnonzero(hit).tolist():
                if (k := int(ids[i])) not in seen:
                    seen.add(k)
                    rows.append((k, sets[i]))
            if rows:
                yield record(schema, list(map(list, zip(*rows))))

    return df.select("text").mapInArrow(run, "node bigint, s array<bigint>").groupBy("node").agg(F.first("s").alias("s"))


def node_bits(ids: np.ndarray) -> np.ndarray:
    """Bloom filter positions of nodes: their low bits, as nodes are hashes already."""
    return (ids & (BLOOM_BITS - 1)).astype(np.int64)


def node_bloom(pairs: DataFrame) -> np.ndarray:
    ids = pairs.select(F.col("a").alias("i")).union(pairs.select(F.col("b").alias("i")))
    return bloom(ids, F.col("i").bitwiseAND(F.lit(BLOOM_BITS - 1)))


def verified(df: DataFrame, pairs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Those pairs (a, b) whose sets overlap enough, counted exactly."""
    sets = sets_of(df, node_bloom(pairs))
    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("s").alias("sa")), "a")
    both = left.join(sets.select(F.col("node").alias("b"), F.col("s").alias("sb")), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return (both.select("a", "b", common.alias("c"), (F.size("sa") + F.size("sb")).alias("total"))
            .where(F.lit(100) * F.col("c") >= F.lit(percent) * (F.col("total") - F.col("c"))).select("a", "b"))


def leader_pairs(known: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Every node with the most central node of equal minimum hash, where sizes and parity bits allow a link."""
    mins = known.select("node", "n", "central", *_BITS, F.explode(F.arrays_zip(F.sequence(F.lit(0), F.lit(SEEDS - 1)).alias("seed"), F.col("mins").alias("h"))).alias("m"))
    mins = mins.select("node", "n", "central", *_BITS, "m.seed", "m.h")
    lead = mins.groupBy("seed", "h").agg(F.max(F.struct("central", "node", "n", *_BITS)).alias("lead"), F.count("*").alias("c")).where("c > 1").drop("c")
    differ = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"lead.{c}"))) for c in _BITS), F.lit(0))
    total = F.col("n") + F.col("lead.n")
    return (mins.join(lead, ["seed", "h"]).where("node <> lead.node")
            .where(f"100 * least(n, lead.n) >= {percent} * greatest(n, lead.n)")
            .where(differ <= total - 2 * F.ceil(total * percent / (100.0 + percent)))
            .select(F.col("node").alias("a"), F.col("lead.node").alias("b")).distinct())


_CARRIED = ("token", "node", "meta", "comp", *_BITS)
_ROWS = pa.schema([*[(c, pa.int64()) for c in _CARRIED], ("a", pa.int64()), ("b", pa.int64()), ("match", pa.int32())])
_ROWS_SQL = ", ".join(f"{c} bigint" for c in _CARRIED) + ", a bigint, b bigint, match int"


def _pairs(i: np.ndarray, j: np.ndarray, node: np.ndarray, meta: np.ndarray, comp: np.ndarray, bits: list[np.ndarray], percent: int):
    """(a, b, match) of index pairs that cross components and fit in size and parity bits.

    Both prefixes are long enough for more than the chosen numbers: sets of sizes n and m need an
    overlap of at least o = ceil(percent (n + m) / (100 + percent)), so prefixes of n - o + k and
    m - o + k share k or more; k is the largest that both emitted prefixes cover."""
    n, spare = meta >> 12, meta & 4095  # size, match number
    left_out = needed(n, percent) - spare  # shingles behind the prefix
    x, y = n[i], n[j]
    ok = (comp[i] != comp[j]) & (100 * np.minimum(x, y) >= percent * np.maximum(x, y))
    i, j = i[ok], j[ok]
    overlap = -(-(n[i] + n[j]) * percent // (100 + percent))
    # Of signed numbers numpy would count the bits of the absolute value.
    differ = sum(np.bitwise_count((c[i] ^ c[j]).view(np.uint64)).astype(np.int64) for c in bits)
    ok = differ <= n[i] + n[j] - 2 * overlap
    i, j, overlap = i[ok], j[ok], overlap[ok]
    k = overlap - np.maximum(left_out[i], left_out[j])
    a, b = node[i], node[j]
    return np.minimum(a, b), np.maximum(a, b), k.astype(np.int32)


def _out_pairs(a, b, match) -> pa.RecordBatch:
    none = pa.nulls(len(a), pa.int64())
    return record(_ROWS, [none] * len(_CARRIED) + [a, b, match])


def shared_shingles(known: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs of nodes per shared prefix shingle, and the rows of shingles that too many share (a is null)."""
    rows = known.select(F.explode("prefix").alias("token"), "node", F.expr("shiftleft(cast(n as bigint), 12) | cast(match as bigint)").alias("meta"), "comp", *_BITS)
    rows = rows.repartition("token").sortWithinPartitions("token")

    def pass_on(*cols):
        none = pa.nulls(len(cols[0]), pa.int64())
        return record(_ROWS, [*cols, none, none, pa.nulls(len(cols[0]), pa.int32())])

    def settle(token, node, meta, comp, *bits):
        """Whole runs of equal shingles; the arrays are sorted by shingle."""
        start = np.concatenate([[0], np.flatnonzero(np.diff(token)) + 1])
        size = np.diff(np.concatenate([start, [len(token)]]))
        start, size = start[size > 1], size[size > 1]
        if not len(start):
            return
        # A stretch from one start to the next may take in single rows; at worst a run is looked at in vain.
        mixed = np.minimum.reduceat(comp, start) != np.maximum.reduceat(comp, start)
        start, size = start[mixed], size[mixed]
        for s in np.unique(size).tolist():
            at = start[size == s]
            if s > RUN:
                for x in at.tolist():
                    yield pass_on(*[v[x:x + s] for v in (token, node, meta, comp, *bits)])
                continue
            u, v = np.triu_indices(s, 1)
            step = max(1, PAIRS // len(u))
            for k in range(0, len(at), step):
                base = at[k:k + step, None]
                a, b, match = _pairs((base + u).ravel(), (base + v).ravel(), node, meta, comp, list(bits), percent)
                if len(a):
                    yield _out_pairs(a, b, match)

    def run(batches):
        held, common = None, None
        for batch in batches:
            new = [np.asarray(batch.column(c)) for c in _CARRIED]
            if common is not None:  # the rest of a shingle whose rows are being passed on
                end = int(np.searchsorted(new[0], common, side="right"))
                if end:
                    yield pass_on(*[x[:end] for x in new])
                    new = [x[end:] for x in new]
                if not len(new[0]):
                    continue
                common = None
            if held is not None:
                new = [np.concatenate(x) for x in zip(held, new)]
            last = int(np.searchsorted(new[0], new[0][-1]))
            if last:
                yield from settle(*[x[:last] for x in new])
            held = [x[last:] for x in new]
            if len(held[0]) > 64 * RUN:
                yield pass_on(*held)
                held, common = None, held[0][0]
        if held is not None:
            yield from settle(*held)

    return rows.mapInArrow(run, _ROWS_SQL)


def split_shingles(rows: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs for shingles that many nodes share, in chunks of about ``RUN`` rows."""
    by_comp = rows.groupBy("token", "comp").agg(F.count("*").alias("c"))
    main = (by_comp.groupBy("token").agg(F.max(F.struct("c", "comp")).alias("m"), F.sum("c").alias("total"), F.count("*").alias("comps")).where("comps > 1")
            .select("token", F.col("m.comp").alias("main"), F.ceil(F.col("total") / RUN).cast("int").alias("chunks")))
    dealt = rows.select(*_CARRIED).join(main, "token")
    own = dealt.select("token", F.pmod(F.xxhash64("node"), "chunks").cast("int").alias("chunk"), F.lit(0).alias("probe"), "node", "meta", "comp", "main", *_BITS)
    visit = (dealt.where("comp <> main").select("token", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(1).alias("probe"), "node", "meta", "comp", "main", *_BITS))
    blocks = own.union(visit).repartition("token", "chunk").sortWithinPartitions("token", "chunk", "probe")

    def settle(cols):
        _, _, probe, node, meta, comp, main, *bits = cols
        base, visitors = np.flatnonzero(probe == 0), np.flatnonzero(probe == 1)
        for k in range(0, len(visitors), max(1, PAIRS // max(1, len(base)))):
            v = visitors[k:k + max(1, PAIRS // max(1, len(base)))]
            i, j = np.repeat(v, len(base)), np.tile(base, len(v))
            # Two rows that both visit meet twice: keep one.
            keep = (comp[j] == main[j]) | (node[i] < node[j])
            a, b, match = _pairs(i[keep], j[keep], node, meta, comp, bits, percent)
            if len(a):
                yield _out_pairs(a, b, match)

    def run(batches):
        held = None
        for batch in batches:
            new = [np.asarray(batch.column(c)) for c in ("token", "chunk", "probe", "node", "meta", "comp", "main", *_BITS)]
            if held is not None:
                new = [np.concatenate(x) for x in zip(held, new)]
            cuts = [0, *(np.flatnonzero((np.diff(new[0]) != 0) | (np.diff(new[1]) != 0)) + 1).tolist()]
            for s, e in zip(cuts, cuts[1:]):
                yield from settle([x[s:e] for x in new])
            held = [x[cuts[-1]:] for x in new]
        if held is not None and len(held[0]):
            yield from settle(held)

    return blocks.mapInArrow(run, _ROWS_SQL)


def classes(df: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, node, n, root) per row of a frame with doc_id and text; rows of one root are one class.

    Node and root are null for an empty set."""
    src = df.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    base = write_stage(base_rows(src), "shingle-rows")
    known = write_stage(nodes(src, sketch(src)), "shingle-nodes")
    first = write_stage(verified(src, leader_pairs(known, percent), percent), "leader-links")
    comp = components(first)
    known = known.join(comp, "node", "left").withColumn("comp", F.coalesce("component", "node")).drop("component")
    found = write_stage(shared_shingles(known, percent), "shared-shingles")
    hot = split_shingles(found.where("a is null"), percent)
    pairs = found.where("a is not null").union(hot).groupBy("a", "b").agg(F.count("*").alias("c"), F.first("match").alias("match")).where("c >= match").select("a", "b")
    pairs = write_stage(pairs, "candidates")
    links = first.union(write_stage(verified(src, pairs, percent), "links"))
    return base.join(components(links), "node", "left").select("doc_id", "node", "n", F.coalesce("component", "node").alias("root"))


def join(df: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of a frame with doc_id and text."""
    rooted = classes(df, percent)
    low = rooted.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"))
    return (rooted.join(low, "root", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id")))


def one_per_class(df: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``df`` with one row of each class: the one with the smallest doc_id.

    Rows without shingles and rows with a null id stay. Only rows whose id is to go, or occurs
    more than once, are joined with the decision; a Bloom filter of those ids (of fixed size) lets
    the texts of all others pass without a shuffle."""
    rooted = write_stage(classes(df, percent), "classes")
    keeper = rooted.where("root is not null and doc_id is not null").groupBy("root").agg(F.min(F.struct("doc_id", "node")).alias("k"))
    judged = (rooted.where("root is not null and doc_id is not null").join(keeper, "root")
              .groupBy("doc_id", "node").agg(F.max(F.struct("doc_id", "node") == F.col("k")).alias("stays"), F.count("*").alias("c")))
    judged = write_stage(judged, "judged")
    twice = judged.groupBy("doc_id").agg(F.sum("c").alias("c"), F.min("stays").alias("all")).where("c > 1 or not all").select("doc_id")
    special = df.sparkSession.sparkContext.broadcast(bloom(twice, _id_bit("doc_id")))  # 1 MB

    names = df.columns
    marked = df.withColumn("_bit", _id_bit("doc_id"))

    def clear_rows(batches):
        for b in batches:
            hit = bloom_hit(special.value, np.asarray(b.column("_bit")))
            yield b.select(names).filter(pa.array(~hit))

    def with_node(batches):
        for b in batches:
            b = b.filter(pa.array(bloom_hit(special.value, np.asarray(b.column("_bit"))))).select(names)
            for part in slices([b], "text", PIECE):
                sets = shingle_sets(raw_texts(part))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([node_of(s) if len(s) else None for s in sets], pa.int64())], names=[*names, "_node"])

    clear = marked.mapInArrow(clear_rows, df.schema)
    rest = marked.mapInArrow(with_node, df.select(*names, F.lit(None).cast("bigint").alias("_node")).schema)
    verdict = judged.select(F.col("doc_id").alias("_id"), F.col("node").alias("_n"), "stays", F.col("c").alias("_c"))
    rest = rest.join(verdict, (F.col("doc_id").cast("bigint") == F.col("_id")) & (F.col("_node") == F.col("_n")), "left")
    stays = rest.where(F.coalesce("stays", F.lit(True)))
    # Repeated rows of the row that stays: one of them.
    single = stays.where(F.coalesce("_c", F.lit(1)) == 1).select(*names)
    repeated = stays.where("_c > 1").dropDuplicates(["_id", "_n"]).select(*names)
    return clear.unionByName(single).unionByName(repeated)


def _id_bit(column: str):
    return F.when(F.col(column).isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(F.col(column).cast("bigint")), F.lit(BLOOM_BITS))).cast("int")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle counts and components of all documents."""
    return join(table(spark, sf_dir, "documents"))


OP4_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')) END) AS sh
  FROM w),
t AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, x.n AS na, y.n AS nb, count(*) AS c
  FROM t x JOIN t y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM common WHERE 100 * c >= 80 * (na + nb - c)),
reach AS (
  SELECT a AS doc_id, a AS other FROM (SELECT DISTINCT a FROM link)
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN link l ON r.other = l.a),
comp AS (SELECT doc_id, min(other) AS c FROM reach GROUP BY doc_id)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, coalesce(comp.c, s.doc_id) AS component_id
FROM s LEFT JOIN comp USING (doc_id)
"""
