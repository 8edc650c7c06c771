"""Histogram boosting and forests over Spark tables.

Features are binned once: one byte a feature and row, cut points from one mergeable quantile sketch.
A fit is made in one of three ways:

* Alone: a table that fits a task (``GROUP_BYTES``, and ``ALONE_BYTES`` for boosting) is packed into files once; every fit, or some
  trees of a forest, is a task that reads them all and works in the JVM (``jvm_trees``): hundreds of fits are one job.
* Together: boosting on a larger table is one job of tasks that run at the same time. Each keeps its share of the rows for all rounds,
  and they sum the histograms of a level by files in the shared folder.
* By level: what fits neither stays where it is. Every level of the trees in work is one job: tasks send histograms of their rows,
  summed by node in the shuffle, and only the chosen split of each node reaches the driver. A forest's nodes leave this way once
  their rows fit a task: these rows go to one group per node, which grows the whole subtree. Boosting
  writes the raw scores every ``WRITE_EVERY`` rounds, so that lineage stays short.

All give the same trees (see ``trees``).
"""

from __future__ import annotations

import pickle
import threading
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabrisk.operators import jvm_trees, trees
from tabrisk.operators.trees import BINS, Boosting, Forest, Tree
from tabrisk.session import scratch_path

GROUP_BYTES = 512 << 20  # binned rows that one task may hold, packed
ALONE_BYTES = 128 << 20  # of them in a boosting fit of one task, and in tasks that hold them as pandas columns
TOGETHER_ROWS = 200_000  # from which a few boosting fits of a query are made one after the other by all cores
TOGETHER_BYTES = 180  # of a row besides its bins, for a boosting fit of many tasks
SUBTREE_ROWS = 1_400_000  # at most, of a subtree that is grown in one task
TREES_PER_GROUP = 10
OUT_ROWS = 1 << 16  # predictions sent on at once
WRITE_EVERY = 10
ROW_BYTES = 40  # of a binned row besides its bins
TREES_AT_ONCE = 20  # of a forest on a large table, at most
HIST_BYTES = 64 << 20  # their histograms that a task may hold
DEALT = 1 << 16  # rows that are dealt to their nodes at once


@dataclass(frozen=True)
class Fit:
    """One model to fit: rows of fold ``held`` (-1: none) are left out and predicted, and so are rows outside training."""
    name: str
    setting: Boosting | Forest
    held: int = -1
    seed: int = 42


def cut_points(train: DataFrame, features: str = "x", accuracy: int = 10_000) -> np.ndarray:
    """(features, 255) ascending cut points halfway between neighbouring quantiles; infinity beyond the last."""
    n = len(train.select(features).first()[0])
    share = [i / BINS for i in range(BINS + 1)]
    got = train.agg(*[F.percentile_approx(F.col(features)[i], share, accuracy).alias(f"q{i}") for i in range(n)]).first()
    out = np.full((n, BINS - 1), np.inf)
    for i in range(n):
        v = np.unique(np.array([q for q in got[i] or [] if q is not None and np.isfinite(q)], float))
        mid = (v[1:] + v[:-1]) / 2
        out[i, :min(len(mid), BINS - 1)] = mid[:BINS - 1]
    return out


def binned(df: DataFrame, id_col: str, edges: np.ndarray, features: str = "features") -> DataFrame:
    """(id, bins, y, w, fold, learn) of a frame with id, features, label, weight, fold and is_train; written once.

    NaN and null features go to the last bin. ``learn``: the row is used for training."""
    x = F.col(features) if isinstance(df.schema[features].dataType, T.ArrayType) else vector_to_array(features)
    src = df.select(F.col(id_col).cast("bigint").alias("id"), x.alias("x"), F.coalesce(F.col("label").cast("int"), F.lit(-1)).alias("y"),
                    F.col("weight").cast("double").alias("w"), F.coalesce(F.col("fold").cast("int"), F.lit(-1)).alias("fold"), (F.col("is_train") == 1).alias("learn"))

    def run(batches):
        for b in batches:
            if b.num_rows:
                x = np.array([[np.nan if v is None else v for v in row] for row in b.column("x").to_pylist()], float)
                bins = np.stack([np.searchsorted(e, np.where(np.isnan(c), np.inf, c)) for e, c in zip(edges, x.T)], axis=1).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([r.tobytes() for r in bins], pa.binary()), *(b.column(c) for c in ("y", "w", "fold", "learn"))],
                                                 names=["id", "bins", "y", "w", "fold", "learn"])

    path = scratch_path(df.sparkSession, "binned")
    schema = "id bigint, bins binary, y int, w double, fold int, learn boolean"
    src.mapInArrow(run, schema).write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def unpack(p: pd.DataFrame, n_features: int) -> np.ndarray:
    return np.frombuffer(b"".join(p["bins"]), np.uint8).reshape(len(p), n_features)


def fits_one_task(rows: DataFrame, n_features: int) -> bool:
    return rows.count() * (n_features + ROW_BYTES) <= min(GROUP_BYTES, ALONE_BYTES)


def alike(rows: DataFrame) -> DataFrame:
    """Rows alike in bins, label, weight, fold and use as one row with their number ``n``; written once.

    Rounded gradients of equal rows are equal whole numbers, so that trees don't change. A table whose features take few
    values shrinks to their combinations; any other stays as long as it was."""
    path = scratch_path(rows.sparkSession, "alike")
    got = rows.groupBy("bins", "y", "w", "fold", "learn").agg(F.min("id").alias("id"), F.count("*").alias("n"))
    got.write.parquet(path)
    return rows.sparkSession.read.schema(got.schema).parquet(path)


# --- fits in the JVM -----------------------------------------------------------------------------------

_OUT = "fit int, stop int, depth int, id bigint, proba array<double>"
_one_at_a_time = threading.Lock()  # a fit of many tasks needs all cores


def _spread(rows: DataFrame, keys: Sequence[int]) -> DataFrame:
    """A copy of the rows for every key, each key in a partition of its own as far as hashing allows."""
    copies = rows.withColumn("fit", F.explode(F.array(*[F.lit(k) for k in keys])))
    return copies.repartition(4 * len(keys), "fit")


def _tasks(spark: SparkSession) -> int:
    """Tasks that run at the same time; 0 if Spark may take executors away."""
    return 0 if spark.conf.get("spark.dynamicAllocation.enabled", "false") == "true" else spark.sparkContext.defaultParallelism


def _way(spark: SparkSession, setting: Boosting | Forest, n_rows: int, n_features: int, k: int, few: bool = False) -> str:
    size, g = n_rows * (n_features + ROW_BYTES), setting.growth
    if k > 127 or (g.symmetric if isinstance(setting, Forest) else g.per_node or g.random_cuts):
        return "level"
    if isinstance(setting, Forest):
        return "alone" if size <= GROUP_BYTES else "level"
    tasks, alone = _tasks(spark), size <= min(GROUP_BYTES, ALONE_BYTES)
    together = tasks > 0 and n_rows // tasks * (n_features + TOGETHER_BYTES) <= GROUP_BYTES
    if together and (not alone or few and tasks > 1 and n_rows >= TOGETHER_ROWS):
        return "together"
    return "alone" if alone else "level"


def fit_predict(rows: DataFrame, fits: Sequence[Fit], k: int, edges: np.ndarray, stops: Sequence[int] = (), depths: Sequence[int] = (0,),
                only_held: bool = False, per_group: int = 0, packed: Sequence[tuple[int, str]] = ()) -> DataFrame:
    """(fit, name, held, part, stop, depth, id, y, fold, proba) of the rows that each fit predicts.

    ``part`` is "oof" for the rows of the fold left out and "new" for rows outside training. ``stops``: also the
    predictions after so many rounds or trees; ``depths``: those of a forest cut off at these
    depths (0: whole). One fit serves them all. ``only_held``: without the part "new". ``per_group``: trees of a forest in a task,
    where other fits are made at the same time. ``packed``: the rows as ``jvm_trees.pack`` wrote them."""
    spark, n_features, stops = rows.sparkSession, len(edges), tuple(stops)
    depths = tuple(sorted(d for d in depths if d)) + ((0,) if 0 in depths else ())
    n_rows = rows.count()
    few = not per_group and 2 * len(fits) <= _tasks(spark)
    ways = [_way(spark, f.setting, n_rows, n_features, k, few) for f in fits]
    path = scratch_path(spark, "fits")
    jobs: list[tuple[int, int, tuple[int, ...], tuple[int, ...]]] = []  # fit, first tree, stops, depths
    for i, f in enumerate(fits):
        if ways[i] == "level":
            continue
        if isinstance(f.setting, Boosting):
            jobs.append((i, 0, (*sorted({s for s in stops if s < f.setting.rounds}), f.setting.rounds), (0,)))
        else:
            ends = _ends(f.setting.trees, stops, per_group or TREES_PER_GROUP)
            jobs += [(i, a, (b,), depths) for a, b in zip([0, *ends], ends)]
    files = packed or (jvm_trees.pack(rows, n_features) if jobs else [])
    specs = [jvm_trees.spec(fits[i].setting, fits[i].held, fits[i].seed, k, edges, first, at[-1], at, deep, only_held) for i, first, at, deep in jobs]

    def read(which: list[int]):
        def run(batches):
            for b in batches:
                for job, answer in zip(b.column("job").to_pylist(), b.column("answer")):
                    i, _, at, deep = jobs[which[job]]
                    ids, parts = jvm_trees.read_answer(answer.as_buffer(), k)
                    for (stop, d), numbers in zip([(s, d) for s in at for d in deep], parts):
                        for lo in range(0, len(ids), OUT_ROWS):
                            some = numbers[lo:lo + OUT_ROWS]
                            yield _predicted(i, ids[lo:lo + OUT_ROWS], stop, d, trees.softmax(some) if isinstance(fits[i].setting, Boosting) else some)
        return run

    if alone := [j for j, job in enumerate(jobs) if ways[job[0]] == "alone"]:
        jvm_trees.fitted(spark, files, [specs[j] for j in alone]).mapInArrow(read(alone), _OUT).write.mode("append").parquet(path)
    for j in (j for j, job in enumerate(jobs) if ways[job[0]] == "together"):
        with _one_at_a_time:
            jvm_trees.fitted_together(spark, files, specs[j], _tasks(spark)).mapInArrow(read([j]), _OUT).write.mode("append").parquet(path)
    if by_level := [i for i, way in enumerate(ways) if way == "level"]:
        _fit_predict_by_level(rows, fits, by_level, k, edges, stops, depths, path)
    got = _labelled(rows, _summed(spark.read.schema(_OUT).parquet(path), fits, k, stops), fits)
    return got.where("part = 'oof'") if only_held else got


def _summed(got: DataFrame, fits: Sequence[Fit], k: int, stops: tuple[int, ...]) -> DataFrame:
    """Votes of a forest's groups added up to every number of trees asked for, as probabilities."""
    forests = {i: f.setting.trees for i, f in enumerate(fits) if isinstance(f.setting, Forest)}
    if not forests:
        return got
    ends = F.create_map(*[x for i, n in forests.items() for x in (F.lit(i), F.array(*[F.lit(s) for s in sorted({*[s for s in stops if s < n], n})]))])
    wide = got.where(F.col("fit").isin(list(forests))).withColumn("end", F.explode(F.filter(ends[F.col("fit")], lambda e: e >= F.col("stop"))))
    votes = wide.groupBy("fit", F.col("end").alias("stop"), "depth", "id").agg(*[F.sum(F.col("proba")[c]).alias(f"v{c}") for c in range(k)])
    votes = votes.select("fit", "stop", "depth", "id", F.array(*[F.col(f"v{c}") / F.col("stop") for c in range(k)]).alias("proba"))
    return got.where(~F.col("fit").isin(list(forests))).unionByName(votes)


def _labelled(rows: DataFrame, got: DataFrame, fits: Sequence[Fit]) -> DataFrame:
    names = F.array(*[F.lit(f.name) for f in fits])
    held = F.array(*[F.lit(f.held) for f in fits])
    out = got.withColumn("name", F.element_at(names, F.col("fit") + 1)).withColumn("held", F.element_at(held, F.col("fit") + 1))
    return out.join(rows.select("id", "learn", "y", "fold"), "id").select(
        "fit", "name", "held", F.when(F.col("learn"), "oof").otherwise("new").alias("part"), "stop", "depth", "id", "y", "fold", "proba")


# --- one job per level ---------------------------------------------------------------------------------

_HIST = pa.schema([("tree", pa.int32()), ("node", pa.int32()), ("hist", pa.binary())])
_SPLIT = "tree int, node int, gain double, feature int, cut int, lt array<double>, rt array<double>"


@dataclass
class Growing:
    """A tree in work: its rules, which rows and channels it reads, and the nodes that wait for a split."""
    fit: int
    number: int  # class of a boosting round, or number of a forest's tree
    growth: trees.Growth
    gini: bool
    columns: np.ndarray
    run: object
    tree: Tree | None = None
    front: np.ndarray | None = None  # nodes that a level's job splits
    open: np.ndarray | None = None  # all nodes that wait for a split
    waiting: list[int] = field(default_factory=list)  # nodes whose rows go to one task


def _subtree_rows(n_features: int) -> int:
    """Rows of a node, at most, whose subtree is grown in one task."""
    return min(GROUP_BYTES // (n_features + ROW_BYTES) // 2, SUBTREE_ROWS)


def _advance(w: Growing, answer: dict[str, np.ndarray] | None, limit: int) -> None:
    """Send the splits of ``front``. Nodes of at most ``limit`` rows are put on the waiting list, and stay leaves until then."""
    limit = limit if w.gini and not w.growth.symmetric and not w.growth.leaves else 0
    try:
        w.tree, w.open = next(w.run) if answer is None else w.run.send(answer)
        while True:
            few = (w.tree.total[w.open, -1] <= limit) & (limit > 0)
            w.waiting += w.open[few].tolist()
            w.front = w.open[~few]
            if len(w.front):
                return
            n, zero = len(w.open), np.zeros((len(w.open), w.tree.total.shape[1]))
            w.tree, w.open = w.run.send({"gain": np.zeros(n), "feature": np.zeros(n, np.int32), "cut": np.zeros(n, np.int32), "left": zero, "right": zero})
    except StopIteration as end:
        w.tree, w.front = end.value, None


def _rows_of(b: pa.RecordBatch, n_features: int):
    p = b.select([c for c in b.schema.names if c != "bins"]).to_pandas()
    packed = b.column("bins")  # every value has n_features bytes
    first = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset]
    bins = np.frombuffer(packed.buffers()[2], np.uint8)[first:first + len(p) * n_features].reshape(len(p), n_features)
    return bins, p["y"].to_numpy(), p["w"].fillna(0.0).to_numpy(), p["id"].to_numpy(), p["fold"].to_numpy(), p["learn"].to_numpy().astype(bool), p


def _learns(f: Fit, y: np.ndarray, fold: np.ndarray, learn: np.ndarray) -> np.ndarray:
    return learn & (y >= 0) & ((fold != f.held) if f.held >= 0 else True)


def _channels(f: Fit, number: int, round_no: int, raw: np.ndarray | None, y: np.ndarray, w: np.ndarray, ids: np.ndarray, use: np.ndarray, k: int) -> list[np.ndarray]:
    """The channels of a tree for the rows at hand; all zero where ``use`` is false."""
    w = w if f.setting.balanced else np.ones(len(y))
    y = np.maximum(y, 0)
    if isinstance(f.setting, Forest):
        times = trees.draws(ids, f.setting, f.seed, number) * use
        return [np.where(y == c, np.rint(w * trees.UNIT) * times, 0.0) for c in range(k)] + [times]
    g, h = trees.gradients(raw, y, w, k)
    use = use * trees.rows_of_round(ids, f.setting, f.seed, round_no)
    return [g[:, number] * use, h[:, number] * use, use.astype(float)]


def _raw(p: pd.DataFrame, bins: np.ndarray, slot: int, k: int, since: list, setting: Boosting) -> np.ndarray:
    """Raw scores of a fit: as written, plus the trees since then."""
    raw = np.stack(p["raw"].to_list())[:, slot * k:(slot + 1) * k].copy()
    for round_trees in since:
        for c, t in enumerate(round_trees):
            raw[:, c] += trees.leaf_scores(t, setting)[t.descend(bins)]
    return raw


def _level(rows: DataFrame, fits: Sequence[Fit], work: list[Growing], k: int, edges: np.ndarray, round_no: int, slots: dict[int, int], since: dict[int, list]) -> None:
    """Send every tree in work the best splits of its open nodes; finished trees lose their front."""
    n_features = len(edges)
    state = rows.sparkSession.sparkContext.broadcast(pickle.dumps(
        [(w.fit, w.number, w.growth, w.gini, w.columns, w.tree, w.front) for w in work] + [since]))  # of the trees in work: bounded by rounds and leaves

    def count(batches):
        *now, grown = pickle.loads(state.value)
        held: dict[int, np.ndarray] = {}
        for b in batches:
            if not b.num_rows:
                continue
            bins, y, w, ids, fold, learn, p = _rows_of(b, n_features)
            raws: dict[int, np.ndarray] = {}
            for i, (fit, number, growth, gini, columns, tree, front) in enumerate(now):
                f = fits[fit]
                if not gini and fit not in raws:
                    raws[fit] = _raw(p, bins, slots[fit], k, grown[fit], f.setting)
                where = np.full(len(tree), -1, np.int32)
                where[front] = np.arange(len(front))
                slot = where[tree.descend(bins)]
                here = np.flatnonzero((slot >= 0) & _learns(f, y, fold, learn))
                raw = None if gini else raws[fit][here]
                channels = _channels(f, number, round_no, raw, y[here], w[here], ids[here], np.ones(len(here), bool), k)
                source = trees.LocalRows(bins[here], channels, growth, gini, edges)
                take = np.flatnonzero(channels[-1] > 0)
                hist = source.histograms(slot[here[take]], take, trees.candidates(growth, columns, tree.path[front]))
                held[i] = held[i] + hist if i in held else hist
        for i, h in held.items():
            used = np.flatnonzero(h[:, :, -1].any(axis=(1, 2)))
            for lo in range(0, len(used), 64):
                part = used[lo:lo + 64]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), i), pa.int32()), pa.array(now[i][6][part], pa.int32()), pa.array([h[s].tobytes() for s in part], pa.binary())], schema=_HIST)

    def total(p: pd.DataFrame) -> np.ndarray:
        out = np.frombuffer(p["hist"].iloc[0]).copy()
        for h in p["hist"].iloc[1:]:
            out += np.frombuffer(h)
        return out

    def choose(key: tuple, p: pd.DataFrame) -> pd.DataFrame:
        *now, _ = pickle.loads(state.value)
        _, _, growth, gini, columns, tree, front = now[key[0]]
        nodes = np.sort(p["node"].unique())
        cand = trees.candidates(growth, columns, tree.path[nodes])
        by_node = dict(tuple(p.groupby("node")))
        hist = np.stack([total(by_node[n]) for n in nodes]).reshape(len(nodes), cand.shape[1], -1, BINS)
        got = trees.best_splits(hist, cand, tree.path[nodes], growth, gini, edges)
        return pd.DataFrame({"tree": key[0], "node": nodes, "gain": got["gain"], "feature": got["feature"], "cut": got["cut"], "lt": list(got["left"]), "rt": list(got["right"])})

    def add(p: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"tree": p["tree"].iloc[:1], "node": p["node"].iloc[:1], "hist": [total(p).tobytes()]})

    sent = rows.mapInArrow(count, "tree int, node int, hist binary")
    one_split = any(w.growth.symmetric for w in work)
    if one_split:  # nodes are summed apart first: a tree's level then is at most 2^depth rows
        sent = sent.groupBy("tree", "node").applyInPandas(add, "tree int, node int, hist binary")
    keys = ["tree"] if one_split else ["tree", "node"]
    got: dict[int, dict[int, tuple]] = {}
    for r in sent.groupBy(*keys).applyInPandas(choose, _SPLIT).collect():  # one row per open node
        got.setdefault(r["tree"], {})[r["node"]] = r
    for i, w in enumerate(work):
        mine = got.get(i, {})
        channels = w.tree.total.shape[1]
        zero = [0.0] * channels
        pick = [mine.get(n) for n in w.front.tolist()]
        answer = {"gain": np.array([r["gain"] if r else 0.0 for r in pick]), "feature": np.array([r["feature"] if r else 0 for r in pick], np.int32),
                  "cut": np.array([r["cut"] if r else 0 for r in pick], np.int32), "left": np.array([r["lt"] if r else zero for r in pick], float),
                  "right": np.array([r["rt"] if r else zero for r in pick], float)}
        if w.growth.symmetric and any(pick):  # rows of a level share one split, also where a node has no row
            some = next(r for r in pick if r)
            answer["gain"][:], answer["feature"][:], answer["cut"][:] = some["gain"], some["feature"], some["cut"]
        if len(w.front) < len(w.open):
            at, part = np.flatnonzero(np.isin(w.open, w.front)), answer
            answer = {name: np.zeros((len(w.open), *v.shape[1:]), v.dtype) for name, v in part.items()}
            for name, v in part.items():
                answer[name][at] = v
        _advance(w, answer, _subtree_rows(n_features))
    state.unpersist()


_DEALT = pa.schema([("tree", pa.int32()), ("node", pa.int32()), ("bins", pa.binary()), ("y", pa.binary()), ("w", pa.binary()), ("times", pa.binary())])


def _subtrees(rows: DataFrame, fits: Sequence[Fit], work: list[Growing], k: int, edges: np.ndarray) -> None:
    """Grow what hangs from the waiting nodes: the rows of each go to one group, many rows as one value."""
    n_features = len(edges)
    state = rows.sparkSession.sparkContext.broadcast(pickle.dumps([(w.fit, w.number, w.growth, w.tree, np.array(w.waiting)) for w in work]))

    def dealt(held: list[tuple], now: list[tuple]):
        bins, y, w, ids, fold, learn = (np.concatenate(c) for c in zip(*held))
        for i, (fit, number, _, tree, waiting) in enumerate(now):
            f = fits[fit]
            use = np.flatnonzero(_learns(f, y, fold, learn))
            times = trees.draws(ids[use], f.setting, f.seed, number)
            use, times = use[times > 0], times[times > 0].astype(np.uint8)
            where = np.full(len(tree), len(waiting), np.int32)
            where[waiting] = np.arange(len(waiting))
            slot = where[tree.descend(bins[use])]
            order = np.argsort(slot, kind="stable")
            cuts = np.searchsorted(slot[order], np.arange(len(waiting) + 1))
            out = []
            for s in np.flatnonzero(np.diff(cuts)).tolist():
                own = order[cuts[s]:cuts[s + 1]]
                r = use[own]
                out.append((i, int(waiting[s]), bins[r].tobytes(), y[r].astype(np.int32).tobytes(), w[r].tobytes(), times[own].tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t.type) for c, t in zip(zip(*out), _DEALT)], schema=_DEALT)

    def deal(batches):
        now, held, n = pickle.loads(state.value), [], 0
        for b in batches:
            if b.num_rows:
                held.append(_rows_of(b, n_features)[:6])
                n += b.num_rows
            if n >= DEALT:
                yield from dealt(held, now)
                held, n = [], 0
        if held:
            yield from dealt(held, now)

    def one(key: tuple, p: pd.DataFrame) -> pd.DataFrame:
        fit, number, growth, tree, _ = pickle.loads(state.value)[key[0]]
        f, node = fits[fit], key[1]
        bins, y, w, times = (np.frombuffer(b"".join(p[c]), t) for c, t in (("bins", np.uint8), ("y", np.int32), ("w", np.float64), ("times", np.uint8)))
        times = times.astype(float)
        weight = np.rint((w if f.setting.balanced else np.ones(len(w))) * trees.UNIT) * times
        source = trees.LocalRows(bins.reshape(len(y), n_features), [np.where(y == c, weight, 0.0) for c in range(k)] + [times], growth, True, edges)
        sub = source.grow(tree.seed, (tree.path[node], int(tree.depth[node])))
        return pd.DataFrame({"tree": key[0], "node": node, "sub": [pickle.dumps((sub.feature.astype(np.int16), sub.cut.astype(np.int16), sub.left, sub.gain, sub.total))]})

    groups = rows.mapInArrow(deal, "tree int, node int, bins binary, y binary, w binary, times binary").groupBy("tree", "node")
    path = scratch_path(rows.sparkSession, "subtrees")
    schema = "tree int, node int, sub binary"
    groups.applyInPandas(one, schema).write.parquet(path)
    for r in rows.sparkSession.read.schema(schema).parquet(path).toLocalIterator():  # the nodes of at most TREES_AT_ONCE trees
        work[r["tree"]].tree.graft(r["node"], *pickle.loads(r["sub"]))
    state.unpersist()


def _start(fits: Sequence[Fit], which: Iterable[tuple[int, int, int]], totals: dict[tuple[int, int], np.ndarray], n_features: int) -> list[Growing]:
    """Trees to grow: (fit, number, seed), with the totals of their rows."""
    out = []
    for fit, number, seed in which:
        s = fits[fit].setting
        gini = isinstance(s, Forest)
        growth = trees.forest_growth(s, n_features) if gini else trees.scaled(s)
        w = Growing(fit, number, growth, gini, trees.tree_columns(growth, n_features, seed), None)
        w.run = trees.grow(growth, seed, totals[fit, number], gini)
        _advance(w, None, _subtree_rows(n_features))
        out.append(w)
    return out


def _totals(rows: DataFrame, fits: Sequence[Fit], which: list[tuple[int, int]], k: int, n_features: int, round_no: int, slots: dict[int, int], since: dict[int, list]) -> dict[tuple[int, int], np.ndarray]:
    """Sums of the channels of the trees (fit, number) over all their rows."""
    state = rows.sparkSession.sparkContext.broadcast(pickle.dumps(since))

    def run(batches):
        grown = pickle.loads(state.value)
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            if not b.num_rows:
                continue
            bins, y, w, ids, fold, learn, p = _rows_of(b, n_features)
            raws: dict[int, np.ndarray] = {}
            for i, (fit, number) in enumerate(which):
                f = fits[fit]
                if isinstance(f.setting, Boosting) and fit not in raws:
                    raws[fit] = _raw(p, bins, slots[fit], k, grown[fit], f.setting)
                c = np.array([v.sum() for v in _channels(f, number, round_no, raws.get(fit), y, w, ids, _learns(f, y, fold, learn), k)])
                sums[i] = sums[i] + c if i in sums else c
        for i, c in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(c), i), pa.int32()), pa.array(np.arange(len(c)), pa.int32()), pa.array(c)], names=["tree", "channel", "v"])

    got = rows.mapInArrow(run, "tree int, channel int, v double").groupBy("tree", "channel").agg(F.sum("v").alias("v")).collect()
    out: dict[tuple[int, int], np.ndarray] = {}
    for i, key in enumerate(which):
        v = {r["channel"]: r["v"] for r in got if r["tree"] == i}
        out[key] = np.array([v.get(c, 0.0) for c in range(k + 1 if isinstance(fits[key[0]].setting, Forest) else 3)])
    return out


def _finish(rows: DataFrame, fits: Sequence[Fit], work: list[Growing], k: int, edges: np.ndarray, round_no: int, slots: dict, since: dict) -> list[Tree]:
    plain = [w for w in work if w.front is not None and not w.growth.symmetric]
    one_split = [w for w in work if w.front is not None and w.growth.symmetric]
    while plain or one_split:
        for group in (plain, one_split):
            if group:
                _level(rows, fits, group, k, edges, round_no, slots, since)
        plain, one_split = ([w for w in g if w.front is not None] for g in (plain, one_split))
    if waiting := [w for w in work if w.waiting]:
        _subtrees(rows, fits, waiting, k, edges)
    return [w.tree for w in work]


def _ends(n: int, stops: Iterable[int], step: int) -> list[int]:
    """Where the groups of a forest's trees end."""
    return sorted({*[s for s in stops if s < n], n, *range(step, n, step)})


def _forest_by_level(rows: DataFrame, fits: Sequence[Fit], i: int, k: int, edges: np.ndarray, stops: Sequence[int] = ()) -> Iterable[tuple[int, list[Tree]]]:
    """(last, trees) of a forest, some trees at a time: as many as have room for a level's histograms."""
    f, n_features = fits[i], len(edges)
    node_bytes = trees.forest_growth(f.setting, n_features).per_node * (k + 1) * BINS * 8
    nodes = rows.count() // max(_subtree_rows(n_features), 1) + 1
    ends = _ends(f.setting.trees, stops, max(1, min(TREES_AT_ONCE, HIST_BYTES // (nodes * node_bytes))))
    for lo, hi in zip([0, *ends], ends):
        which = [(i, t) for t in range(lo, hi)]
        totals = _totals(rows, fits, which, k, n_features, 0, {}, {})
        yield hi, _finish(rows, fits, _start(fits, [(i, t, trees.tree_seed(f.seed, t, 0)) for _, t in which], totals, n_features), k, edges, 0, {}, {})


def _fit_predict_by_level(rows: DataFrame, fits: Sequence[Fit], which: Sequence[int], k: int, edges: np.ndarray, stops: tuple[int, ...], depths: tuple[int, ...], path: str) -> None:
    """Append what some of the fits predict to ``path``."""
    models, starts = _grow_by_level(rows, fits, which, k, edges)
    for i in which:
        f = fits[i]
        if isinstance(f.setting, Boosting):
            _apply(rows, i, f, models[i], starts[i], k, len(edges), stops).write.mode("append").parquet(path)
        else:
            for last, grown in _forest_by_level(rows, fits, i, k, edges, stops):
                _votes(rows, i, f, grown, last, len(edges), depths).write.mode("append").parquet(path)


def _grow_by_level(rows: DataFrame, fits: Sequence[Fit], which: Sequence[int], k: int, edges: np.ndarray) -> tuple[dict[int, list], dict[int, np.ndarray]]:
    """The boosting fits' trees, by round and class, and starting scores."""
    n_features = len(edges)
    boosted = [i for i in which if isinstance(fits[i].setting, Boosting)]
    slots = {i: s for s, i in enumerate(boosted)}
    models: dict[int, list] = {i: [] for i in boosted}
    starts: dict[int, np.ndarray] = {}
    if boosted:
        starts = _priors(rows, fits, boosted, k)
        first = np.concatenate([starts[i] for i in boosted]).tolist()
        state = rows.withColumn("raw", F.array(*[F.lit(v) for v in first]))
        since: dict[int, list] = {i: [] for i in boosted}
        for r in range(max(fits[i].setting.rounds for i in boosted)):
            now = [i for i in boosted if r < fits[i].setting.rounds]
            grown_now = [(i, c) for i in now for c in range(k)]
            totals = _totals(state, fits, grown_now, k, n_features, r, slots, since)
            work = _start(fits, [(i, c, trees.tree_seed(fits[i].seed, r, c)) for i, c in grown_now], totals, n_features)
            grown = _finish(state, fits, work, k, edges, r, slots, since)
            for j, i in enumerate(now):
                models[i].append(grown[j * k:(j + 1) * k])
                since[i].append(models[i][-1])
            if (r + 1) % WRITE_EVERY == 0:
                state, since = _advanced(state, fits, boosted, k, n_features, slots, since), {i: [] for i in boosted}
    return models, starts


def _priors(rows: DataFrame, fits: Sequence[Fit], which: Sequence[int], k: int) -> dict[int, np.ndarray]:
    """Starting scores: log shares of the classes among the rows that a fit learns from."""
    share = [((F.col("fold") != fits[i].held) if fits[i].held >= 0 else F.lit(True), F.coalesce("w", F.lit(0.0)) if fits[i].setting.balanced else F.lit(1.0)) for i in which]
    got = rows.where("learn and y >= 0").agg(*[F.coalesce(F.sum(F.when(ok & (F.col("y") == c), w)), F.lit(0.0)).alias(f"s{j}_{c}") for j, (ok, w) in enumerate(share) for c in range(k)]).first()
    return {i: trees.prior(np.arange(k), np.array([got[f"s{j}_{c}"] for c in range(k)], float), k) for j, i in enumerate(which)}


def _advanced(state: DataFrame, fits: Sequence[Fit], boosted: Sequence[int], k: int, n_features: int, slots: dict[int, int], since: dict[int, list]) -> DataFrame:
    """The table with raw scores brought up to date, written."""
    grown = state.sparkSession.sparkContext.broadcast(pickle.dumps(since))

    def run(batches):
        new = pickle.loads(grown.value)
        for b in batches:
            if b.num_rows:
                bins, *_, p = _rows_of(b, n_features)
                raw = np.concatenate([_raw(p, bins, slots[i], k, new[i], fits[i].setting) for i in boosted], axis=1)
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in b.schema.names if c != "raw"), pa.array(list(raw), pa.list_(pa.float64()))], names=[c for c in b.schema.names if c != "raw"] + ["raw"])

    path = scratch_path(state.sparkSession, "boosting-scores")
    state.mapInArrow(run, state.schema).write.parquet(path)
    return state.sparkSession.read.schema(state.schema).parquet(path)


def _asked(rows: DataFrame, f: Fit) -> DataFrame:
    return rows.where(f"not learn or y < 0 or fold = {f.held}" if f.held >= 0 else "not learn or y < 0")


def _predicted(i: int, ids: np.ndarray, stop: int, depth: int, proba: np.ndarray) -> pa.RecordBatch:
    n = len(ids)
    lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * proba.shape[1], pa.int32()), pa.array(np.ascontiguousarray(proba).ravel()))
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, i), pa.int32()), pa.array(np.full(n, stop), pa.int32()), pa.array(np.full(n, depth), pa.int32()),
                                       pa.array(ids), lists], names=["fit", "stop", "depth", "id", "proba"])


def _apply(rows: DataFrame, i: int, f: Fit, model: list, start: np.ndarray, k: int, n_features: int, stops: tuple[int, ...]) -> DataFrame:
    """Predictions of a boosting fit for the rows it hasn't learnt from, in the form that groups give them."""
    shared = rows.sparkSession.sparkContext.broadcast(pickle.dumps(model))

    def run(batches):
        fitted = pickle.loads(shared.value)
        for b in batches:
            if not b.num_rows:
                continue
            bins, _, _, ids, *_ = _rows_of(b, n_features)
            raw = np.tile(start, (len(ids), 1))
            for r, by_class in enumerate(fitted, 1):
                for c, t in enumerate(by_class):
                    raw[:, c] += trees.leaf_scores(t, f.setting)[t.descend(bins)]
                if r in stops or r == len(fitted):
                    yield _predicted(i, ids, r, 0, trees.softmax(raw))

    return _asked(rows, f).mapInArrow(run, _OUT)


def _votes(rows: DataFrame, i: int, f: Fit, grown: list[Tree], last: int, n_features: int, depths: tuple[int, ...]) -> DataFrame:
    """Summed votes of some of a forest's trees, for the rows it hasn't learnt from."""
    shared = rows.sparkSession.sparkContext.broadcast(pickle.dumps(grown))

    def run(batches):
        fitted = pickle.loads(shared.value)
        for b in batches:
            if b.num_rows:
                bins, _, _, ids, *_ = _rows_of(b, n_features)
                for d, proba in zip(depths, [sum(v) for v in zip(*[trees.forest_votes(t, bins, depths) for t in fitted])]):
                    yield _predicted(i, ids, last, d, proba)

    return _asked(rows, f).mapInArrow(run, _OUT)


# --- models that are kept --------------------------------------------------------------------------------

TREE_ROWS = "round int, class int, feature array<int>, cut array<int>, left array<int>, value array<double>"


def _tree_row(t: Tree, setting: Boosting, round_no: int, c: int) -> dict:
    return {"round": round_no, "class": c, "feature": t.feature.tolist(), "cut": t.cut.tolist(), "left": t.left.tolist(),
            "value": trees.leaf_scores(t, setting).tolist()}


def fit_boosting(rows: DataFrame, fit: Fit, k: int, edges: np.ndarray) -> tuple[DataFrame, list[float]]:
    """A boosting model as a written table of trees (``TREE_ROWS``, a row per round and class) and its starting scores.

    The table's size depends on the setting only."""
    spark, s, n_features = rows.sparkSession, fit.setting, len(edges)
    path = scratch_path(spark, "trees")
    held = rows if fits_one_task(rows, n_features) else alike(rows) if s.rows >= 1 else None
    if held is not None and (held is rows or fits_one_task(held, n_features)):
        def one(key: tuple, p: pd.DataFrame) -> pd.DataFrame:
            p = p.sort_values("id", kind="stable")
            bins, y, ids = unpack(p, n_features), p["y"].to_numpy(), p["id"].to_numpy()
            w = p["w"].fillna(0.0).to_numpy() if s.balanced else np.ones(len(p))
            learn = _learns(fit, y, p["fold"].to_numpy(), p["learn"].to_numpy().astype(bool))
            times = p["n"].to_numpy(float) if "n" in p else None
            _, rounds, _ = trees.boost(bins, np.maximum(y, 0), w, ids, learn, k, s, fit.seed, edges, times=times)
            return pd.DataFrame([_tree_row(t, s, r, c) for r, by_class in enumerate(rounds) for c, t in enumerate(by_class)])

        start = _priors(rows, [fit], [0], k)[0]
        _spread(held, [0]).groupBy("fit").applyInPandas(one, TREE_ROWS).write.parquet(path)
    else:
        models, starts = _grow_by_level(rows, [fit], [0], k, edges)
        start = starts[0]
        grown = [_tree_row(t, s, r, c) for r, by_class in enumerate(models[0]) for c, t in enumerate(by_class)]
        spark.createDataFrame(grown, TREE_ROWS).write.parquet(path)
    return spark.read.schema(TREE_ROWS).parquet(path), [float(v) for v in start]


@dataclass(frozen=True)
class BoostedModel:
    """Kept boosting: cut points, starting scores and a table of trees; scores batches and streams alike."""
    edges: np.ndarray
    start: list
    trees: DataFrame

    def proba(self, features: Column) -> Column:
        """Class probabilities of an array of features (null and NaN: last bin). The trees are collected and
        broadcast once: rounds x classes of them, whatever the number of rows."""
        rows = self.trees.orderBy("round", "class").collect()
        made = [(r["class"], *(np.array(r[n]) for n in ("feature", "cut", "left", "value"))) for r in rows]
        shared = self.trees.sparkSession.sparkContext.broadcast((made, self.edges, np.array(self.start)))

        @F.pandas_udf("array<double>")
        def run(x: pd.Series) -> pd.Series:
            made, edges, start = shared.value
            wide = np.array([[np.nan] * len(edges) if v is None else v for v in x], float).reshape(len(x), len(edges))
            bins = np.stack([np.searchsorted(e, np.where(np.isnan(c), np.inf, c)) for e, c in zip(edges, wide.T)], axis=1)
            raw = np.tile(start, (len(x), 1))
            for c, feature, cut, left, value in made:
                t = Tree(np.zeros(1), 0)
                t.feature, t.cut, t.left = feature, cut, left
                raw[:, c] += value[t.descend(bins)]
            return pd.Series(list(trees.softmax(raw)))

        return run(features)


def mean_importances(rows: DataFrame, fit: Fit, k: int, edges: np.ndarray) -> list[float]:
    """Each feature's share of the gain of a forest, averaged over its trees."""
    s, n_features, spark = fit.setting, len(edges), rows.sparkSession
    if _way(spark, s, rows.count(), n_features, k) == "level":
        shares = [(len(grown), np.array(trees.importances(grown, n_features))) for _, grown in _forest_by_level(rows, [fit], 0, k, edges)]
        return (sum(n * share for n, share in shares) / s.trees).tolist()
    ends = _ends(s.trees, (), TREES_PER_GROUP)
    specs = [jvm_trees.spec(s, -1, fit.seed, k, edges, a, b, (), (), importances=True) for a, b in zip([0, *ends], ends)]
    got = jvm_trees.fitted(spark, jvm_trees.pack(rows, n_features), specs).collect()  # a row per group of trees
    total = np.zeros(n_features)
    for r in sorted(got, key=lambda r: r["job"]):
        brought, n = np.frombuffer(r["answer"], "<f8"), ends[r["job"]] - ([0] + ends)[r["job"]]
        total += n * brought / max(brought.sum(), 1e-300)
    return (total / s.trees).tolist()
