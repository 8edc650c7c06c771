"""Histogram trees on binned rows: what a task does with its rows, and how a tree grows from splits.

A feature is one byte a row (its bin). A tree grows level by level: a *source of splits* is asked for the best split of
every open node, and may be the rows of one task (``LocalRows``) or a Spark job over all rows (``tree_models``).
Both give the same answer: gradients are rounded to multiples of 2^-20, so that sums don't depend on
their order, and random choices are hashes of the seed and the path to a node, never draws in turn. A forest of few trees is thus
a prefix of one with more, and a shallow tree is a deep one cut off.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Generator, Sequence
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np

BINS = 256
UNIT = 2.0 ** 20  # gradients are whole multiples of 1 / UNIT
CELLS = 1 << 22  # histogram cells held at once
FEW = 256  # a forest's nodes with fewer rows are split by sorting them, not by histograms
CHUNK = 1 << 16  # their rows handled at once
BUNDLE = 1024  # combinations of bins that features counted together take, at most


@dataclass(frozen=True)
class Growth:
    """How a tree grows; 0 means no limit."""
    depth: int = 0
    leaves: int = 0
    least: int = 1  # rows of a leaf
    split: int = 2  # rows of a node that may be split
    l2: float = 0.0
    hessian: float = 0.0  # least sum of hessians of a leaf
    columns: float = 1.0  # share of the features that a tree may use
    per_node: int = 0  # features tried at a node, other ones at each
    random_cuts: bool = False
    symmetric: bool = False  # one split for all nodes of a level


@dataclass(frozen=True)
class Boosting:
    """Softmax boosting: one tree per class and round."""
    rounds: int
    step: float
    growth: Growth
    rows: float = 1.0  # share of the rows that a round uses
    balanced: bool = True


@dataclass(frozen=True)
class Forest:
    trees: int
    growth: Growth
    bootstrap: bool = True
    balanced: bool = True


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = np.asarray(x, np.uint64) + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
        return x ^ (x >> np.uint64(33))


def uniform(x: np.ndarray, *salt: int) -> np.ndarray:
    """Numbers in [0, 1) that depend on ``x`` and the salts only."""
    x = np.asarray(x, np.uint64)
    for s in salt:
        x = mix(x ^ mix(np.uint64(s % (1 << 64))))
    return (mix(x) >> np.uint64(11)) * 2.0 ** -53


class Tree:
    """Arrays by node: the feature it splits on (-1: leaf), bins up to ``cut`` go to ``left``, others to ``left`` + 1."""

    def __init__(self, total: np.ndarray, seed: int):
        self.feature, self.cut, self.left = np.array([-1], np.int32), np.zeros(1, np.int32), np.full(1, -1, np.int32)
        self.gain, self.total = np.zeros(1), total[None].astype(float)
        self.depth, self.path = np.zeros(1, np.int32), mix(np.array([seed % (1 << 64)], np.uint64))
        self.seed = seed

    def __len__(self) -> int:
        return len(self.feature)

    def split(self, nodes: np.ndarray, feature: np.ndarray, cut: np.ndarray, gain: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Give ``nodes`` two children each; returns the children's numbers."""
        n = len(self)
        first = n + 2 * np.arange(len(nodes))
        self.feature[nodes], self.cut[nodes], self.left[nodes], self.gain[nodes] = feature, cut, first, gain
        children = n + np.arange(2 * len(nodes))
        side = np.tile(np.array([1, 2], np.uint64), len(nodes))
        self.path = np.concatenate([self.path, mix(np.repeat(self.path[nodes], 2) ^ mix(side))])
        self.depth = np.concatenate([self.depth, np.repeat(self.depth[nodes] + 1, 2)])
        self.total = np.concatenate([self.total, np.stack([left, right], axis=1).reshape(2 * len(nodes), -1)])
        for name, empty in (("feature", -1), ("cut", 0), ("left", -1), ("gain", 0.0)):
            old = getattr(self, name)
            setattr(self, name, np.concatenate([old, np.full(2 * len(nodes), empty, old.dtype)]))
        return children

    def graft(self, node: int, feature: np.ndarray, cut: np.ndarray, left: np.ndarray, gain: np.ndarray, total: np.ndarray) -> None:
        """Hang a subtree's arrays below a leaf; new nodes have no path, so they can't be split any further."""
        n = len(self)
        self.feature[node], self.cut[node], self.gain[node] = feature[0], cut[0], gain[0]
        left = np.where(left >= 0, left + n - 1, -1)
        self.left[node] = left[0]
        for name, new in (("feature", feature), ("cut", cut), ("left", left), ("gain", gain), ("total", total)):
            old = getattr(self, name)
            setattr(self, name, np.concatenate([old, new[1:].astype(old.dtype)]))

    def best_first(self, leaves: int) -> set[int]:
        """The nodes that are split if the largest gain goes first, up to ``leaves`` leaves."""
        heap, chosen = [(-self.gain[0], 0)] if self.feature[0] >= 0 else [], set()
        while heap and len(chosen) + 1 < leaves:
            _, node = heapq.heappop(heap)
            chosen.add(node)
            for child in (int(self.left[node]), int(self.left[node]) + 1):
                if self.feature[child] >= 0:
                    heapq.heappush(heap, (-self.gain[child], child))
        return chosen

    def prune(self, keep: set[int]) -> None:
        drop = np.ones(len(self), bool)
        drop[list(keep)] = False
        self.feature[drop] = -1

    def descend(self, bins: np.ndarray, start: np.ndarray | None = None, steps: int | None = None) -> np.ndarray:
        """The node that each row ends in (after ``steps`` levels)."""
        node = np.zeros(len(bins), np.int32) if start is None else start
        rows = np.flatnonzero(self.feature[node] >= 0)
        while len(rows) and steps != 0:
            at = node[rows]
            at = self.left[at] + (bins[rows, self.feature[at]] > self.cut[at])
            node[rows] = at
            rows = rows[self.feature[at] >= 0]
            steps = None if steps is None else steps - 1
        return node

    def settle(self, columns: list[np.ndarray], rows: np.ndarray, out: np.ndarray) -> None:
        """Put the node that each of ``rows`` ends in into ``out``, as ``descend`` finds it: node by node where they are many."""
        if len(rows) < 128 * len(self):
            out[rows] = self.descend(np.stack([c.take(rows) for c in columns], axis=1))
            return
        todo = [(0, rows)]
        while todo:
            node, rows = todo.pop()
            if self.feature[node] < 0:
                out[rows] = node
            elif len(rows):
                right = columns[self.feature[node]].take(rows) > self.cut[node]
                todo += [(self.left[node], rows[np.flatnonzero(~right)]), (self.left[node] + 1, rows[np.flatnonzero(right)])]


# --- choosing splits -----------------------------------------------------------------------------------

def worth(s: np.ndarray, growth: Growth, gini: bool) -> np.ndarray:
    """What totals (..., channel, bin) are worth: channels are class weights and rows, or gradient, hessian and rows."""
    if gini:
        top, low = s[..., 0, :] ** 2, s[..., 0, :].copy()
        for c in range(1, s.shape[-2] - 1):
            top += s[..., c, :] ** 2
            low += s[..., c, :]
    else:
        top, low = s[..., 0, :] ** 2, s[..., 1, :] + growth.l2
    return top / np.maximum(low, 1e-300)  # without hessian or weight the numerator is 0


def tree_columns(growth: Growth, n_features: int, seed: int) -> np.ndarray:
    m = max(1, math.ceil(growth.columns * n_features)) if growth.columns < 1 else n_features
    return np.sort(np.argsort(uniform(np.arange(n_features), seed, 3), kind="stable")[:m])


def candidates(growth: Growth, columns: np.ndarray, paths: np.ndarray) -> np.ndarray:
    """(nodes, m) features to try at each node."""
    if not growth.per_node or growth.per_node >= len(columns):
        return np.broadcast_to(columns, (len(paths), len(columns)))
    rank = np.stack([uniform(paths, int(f), 5) for f in columns], axis=1)
    return columns[np.sort(np.argsort(rank, axis=1, kind="stable")[:, :growth.per_node], axis=1)]


def drawn_cuts(feature: np.ndarray, lo: np.ndarray, hi: np.ndarray, paths: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """A random cut between the lowest and highest bin of each node and feature."""
    out = np.empty(len(feature), np.int64)
    for f in np.unique(feature):
        at = np.flatnonzero(feature == f)
        a, b = lo[at], hi[at]
        draw = edges[f, a] + uniform(paths[at], int(f), 7) * (edges[f, b - 1] - edges[f, a])
        out[at] = np.clip(np.searchsorted(edges[f], draw), a, b - 1)
    return out


def best_splits(hist: np.ndarray, cand: np.ndarray, paths: np.ndarray, growth: Growth, gini: bool, edges: np.ndarray) -> dict[str, np.ndarray]:
    """The best split of every node from histograms (node, candidate, channel, bin); gain 0 where there is none."""
    n, m = hist.shape[:2]
    left = np.cumsum(hist, axis=-1)
    total = left[:, :, :, -1:]
    left = left[..., :-1]
    right = total - left
    gain = worth(left, growth, gini)
    gain += worth(right, growth, gini)
    gain -= worth(total, growth, gini)
    least = max(growth.least, 1)
    ok = (left[:, :, -1] >= least) & (right[:, :, -1] >= least)
    if not gini and growth.hessian:
        ok &= (left[:, :, 1] >= growth.hessian) & (right[:, :, 1] >= growth.hessian)
    if growth.random_cuts:
        used = hist[:, :, -1] > 0
        lo, hi = used.argmax(axis=2), BINS - 1 - used[:, :, ::-1].argmax(axis=2)
        at = np.zeros((n, m), np.int64)
        i, j = np.nonzero(lo < hi)
        at[i, j] = drawn_cuts(cand[i, j], lo[i, j], hi[i, j], paths[i], edges)
        drawn = np.zeros(ok.shape, bool)
        np.put_along_axis(drawn, at[..., None], True, axis=2)
        ok &= drawn & (lo < hi)[..., None]
    if growth.symmetric:
        gain = np.broadcast_to(np.where(ok, gain, 0.0).sum(axis=0, keepdims=True), gain.shape)
        ok = np.ones(ok.shape, bool)
    flat = np.where(ok, gain, 0.0).reshape(n, -1)
    best = flat.argmax(axis=1)
    j, cut = np.divmod(best, BINS - 1)
    rows = np.arange(n)
    return {"gain": flat[rows, best], "feature": cand[rows, j], "cut": cut, "left": left[rows, j, :, cut], "right": right[rows, j, :, cut]}


def grow(growth: Growth, seed: int, total: np.ndarray, gini: bool) -> Generator[tuple[Tree, np.ndarray], dict[str, np.ndarray], Tree]:
    """Grow one tree: yields (tree so far, open nodes) and is sent their best splits."""
    tree = Tree(total, seed)
    front, depth = np.array([0]), 0
    while len(front) and not (growth.depth and depth >= growth.depth):
        got = yield tree, front
        use = got["gain"] > 1e-7 * (1.0 if gini else UNIT)
        if use.any():
            children = tree.split(front[use], got["feature"][use], got["cut"][use], got["gain"][use], got["left"][use], got["right"][use])
            if growth.leaves:  # a node that doesn't rank among the largest gains now will not do so later
                chosen = tree.best_first(growth.leaves)
                open_parent = np.isin(front[use], list(chosen))
                children = children[np.repeat(open_parent, 2)]
        else:
            children = front[:0]
        n = tree.total[children, -1]
        front = children[(n >= max(growth.split, 2 * growth.least)) | growth.symmetric]
        if gini and len(front):
            front = front[(tree.total[front, :-1] > 0).sum(axis=1) > 1]
        depth += 1
    if growth.leaves:
        tree.prune(tree.best_first(growth.leaves))
    return tree


def bundles(bins: np.ndarray) -> tuple[list[tuple[list[int], list[np.ndarray]]], list[np.ndarray]]:
    """Features that are counted together: (features, the bins that each takes), and each row's combinations of their bins,
    eight of two bytes as one number, so that they are read at once.

    One histogram over the combinations holds that of every feature, as its sums over the others."""
    used = [np.flatnonzero(np.bincount(c, minlength=BINS)) for c in bins.T]
    groups: list[list[int]] = []
    for f in sorted(range(len(used)), key=lambda f: -len(used[f])):
        room = (g for g in groups if math.prod(len(used[i]) for i in g) * len(used[f]) <= BUNDLE)
        if (group := next(room, None)) is None:
            groups.append([f])
        else:
            group.append(f)
    codes = []
    for lo in range(0, len(groups), 8):
        eight = np.zeros((len(bins), 8), np.uint16)
        for j, features in enumerate(groups[lo:lo + 8]):
            for f in features:
                number = np.zeros(BINS, np.uint16)
                number[used[f]] = np.arange(len(used[f]))
                eight[:, j] = eight[:, j] * np.uint16(len(used[f])) + number[bins[:, f]]
        codes.append(eight.view(np.complex128).ravel())
    return [(features, [used[f] for f in features]) for features in groups], codes


class LocalRows:
    """Splits from one task's rows. ``channels``: gradient, hessian (or a weight per class) and row counts, which are 0 or 1
    if ``single``, as in boosting."""

    def __init__(self, bins: np.ndarray, channels: list[np.ndarray], growth: Growth, gini: bool, edges: np.ndarray, single: bool = False):
        self.bins, self.columns = bins, [np.ascontiguousarray(bins[:, f]) for f in range(bins.shape[1])]
        self.channels, self.growth, self.gini, self.edges, self.single = channels, growth, gini, edges, single
        self.flat = np.ascontiguousarray(bins).ravel()
        self.bundles = bundles(bins) if single and len(bins) >= BUNDLE else None

    def total(self) -> np.ndarray:
        return np.array([c.sum() for c in self.channels])

    def start(self) -> None:
        self.rows = np.flatnonzero(self.channels[-1] > 0)  # with other features at each node: by node, in the order of the front
        self.front, self.sizes = np.zeros(1, np.int64), np.array([len(self.rows)])
        self.held = {0: self.rows}  # rows by node, in ascending order, where all nodes try the same features
        self.kept: tuple[np.ndarray, np.ndarray] | None = None

    def _move_all(self, tree: Tree, front: np.ndarray) -> None:
        """The rows of the last front go to the nodes of the new one, or are through."""
        split = tree.feature[self.front] >= 0
        rows, nodes, sizes = self.rows[np.repeat(split, self.sizes)], self.front[split], self.sizes[split]
        seg, first = np.repeat(np.arange(len(nodes)), sizes), np.cumsum(sizes) - sizes
        right = self._bins(rows, tree.feature[nodes].take(seg)) > tree.cut[nodes].take(seg)
        lefts = np.concatenate([[0], np.cumsum(~right)])  # rows to the left before each row
        n_left = lefts[first + sizes] - lefts[first]
        at = np.arange(len(rows))
        before = lefts[:-1] - lefts[first].take(seg)
        to = np.where(right, n_left.take(seg) + at - before, first.take(seg) + before)
        moved = np.empty_like(rows)
        moved[to] = rows
        child = np.stack([tree.left[nodes], tree.left[nodes] + 1], axis=1).ravel()
        size = np.stack([n_left, sizes - n_left], axis=1).ravel()
        is_open = np.isin(child, front)
        self.rows, self.front, self.sizes = moved[np.repeat(is_open, size)], child[is_open], size[is_open]

    def _bins(self, rows: np.ndarray, feature: np.ndarray) -> np.ndarray:
        """The bin of each row in a feature of its own."""
        return self.flat.take(rows * self.bins.shape[1] + feature)

    def _move(self, tree: Tree, nodes: Sequence[int]) -> None:
        """The rows of split nodes go to their children."""
        for node in nodes:
            rows = self.held.pop(node)
            right = self.columns[tree.feature[node]][rows] > tree.cut[node]
            left = int(tree.left[node])
            self.held[left], self.held[left + 1] = rows[np.flatnonzero(~right)], rows[np.flatnonzero(right)]

    def ends(self, tree: Tree) -> np.ndarray:
        """The leaf of every row, once the tree is grown; -1 for rows that it didn't use."""
        up = np.arange(len(tree))
        for node in np.flatnonzero(tree.left >= 0).tolist():  # parents come before their children
            if tree.feature[node] < 0 or up[node] != node:  # pruned here or above
                up[tree.left[node]:tree.left[node] + 2] = up[node]
        while nodes := [n for n in self.held if tree.feature[n] >= 0]:
            self._move(tree, nodes)
        out = np.full(len(self.bins), -1, np.int32)
        for node, rows in self.held.items():
            out[rows] = up[node]
        return out

    def histograms(self, slot: np.ndarray, rows: np.ndarray, cand: np.ndarray) -> np.ndarray:
        n, m = cand.shape
        same = bool((cand == cand[:1]).all())
        if self.bundles and same and len(rows) >= n * BUNDLE and (h := self.channels[1].take(rows)).min() >= 0:
            return self._bundled(slot, rows, h, cand)
        out = np.empty((n, m, len(self.channels), BINS))
        base = slot.astype(np.int64) * BINS
        values = [c.take(rows) for c in (self.channels[:-1] if self.single else self.channels)]
        for j in range(m):
            b = self.columns[cand[0, j]].take(rows) if same else self._bins(rows, cand[:, j].take(slot))
            at = base + b
            for k, v in enumerate(values):
                out[:, j, k, :] = np.bincount(at, weights=v, minlength=n * BINS).reshape(n, BINS)
            if self.single:
                out[:, j, -1, :] = np.bincount(at, minlength=n * BINS).reshape(n, BINS)
        return out

    def _bundled(self, slot: np.ndarray, rows: np.ndarray, h: np.ndarray, cand: np.ndarray) -> np.ndarray:
        """``histograms`` of features that all nodes share; ``h``: the rows' hessians.

        A row is one complex number: its gradient, and its hessian plus a unit larger than all hessians of a slice, which counts
        the rows. All are whole numbers below 2^53: exact in any order."""
        n, m = cand.shape
        out = np.zeros((n, m, 3, BINS))
        place = {f: j for j, f in enumerate(cand[0].tolist())}
        step = len(rows)
        while (most := np.add.reduceat(h, np.arange(0, len(h), step)).max() + 1) * step > 2.0 ** 51 and step > 1:
            step = -(-step // 2)
        unit = 2.0 ** math.ceil(math.log2(most))
        value = np.empty(len(rows), complex)
        value.real = self.channels[0].take(rows)
        value.imag = h + unit
        groups, codes = self.bundles
        for i, (features, used) in enumerate(groups):
            if i % 8 == 0:
                picked = codes[i // 8].take(rows).view(np.uint16).reshape(-1, 8)
            if place.keys().isdisjoint(features):
                continue
            sizes = [len(u) for u in used]
            cells = math.prod(sizes)
            at = slot * cells
            at += picked[:, i % 8]
            sums = np.zeros((3, n * cells))
            for lo in range(0, len(at), step):
                got = np.zeros(n * cells, complex)
                np.add.at(got, at[lo:lo + step], value[lo:lo + step])
                count = np.floor(got.imag / unit)
                sums[0] += got.real
                sums[1] += got.imag - count * unit
                sums[2] += count
            sums = sums.reshape(3, n, *sizes)
            for axis, f in enumerate(features, 2):
                if f in place:
                    one = sums.sum(axis=tuple(a for a in range(2, sums.ndim) if a != axis))
                    out[:, place[f], :, used[axis - 2]] = one.transpose(2, 1, 0)
        return out

    def _own_features(self, cand: np.ndarray, paths: np.ndarray) -> dict[str, np.ndarray]:
        """The best splits of the open nodes, each among its own candidates.

        Nodes of few rows are split by cuts between rows: a histogram would be mostly empty."""
        n, width, first = len(cand), len(self.channels), np.cumsum(self.sizes) - self.sizes
        out = {"gain": np.zeros(n), "feature": np.zeros(n, np.int32), "cut": np.zeros(n, np.int64), "left": np.zeros((n, width)), "right": np.zeros((n, width))}
        few = np.zeros(n, bool) if self.growth.symmetric else (self.sizes < FEW) | self.growth.random_cuts
        step = max(1, CELLS // (cand.shape[1] * BINS * width))
        many = np.flatnonzero(~few)
        parts = [(many[lo:lo + step], False) for lo in range(0, len(many), step)]
        some = np.flatnonzero(few)
        chunk = (np.cumsum(self.sizes[some]) - 1) // CHUNK
        parts += [(p, True) for p in np.split(some, np.flatnonzero(np.diff(chunk)) + 1) if len(p)]
        for nodes, sparse in parts:
            size = self.sizes[nodes]
            slot = np.repeat(np.arange(len(nodes)), size)
            rows = self.rows[np.arange(len(slot)) + np.repeat(first[nodes] - (np.cumsum(size) - size), size)]
            if sparse:
                got = self._between_rows(slot, size, rows, cand[nodes], paths[nodes])
            else:
                got = best_splits(self.histograms(slot, rows, cand[nodes]), cand[nodes], paths[nodes], self.growth, self.gini, self.edges)
            for name, v in got.items():
                out[name][nodes] = v
        return out

    def _between_rows(self, slot: np.ndarray, size: np.ndarray, rows: np.ndarray, cand: np.ndarray, paths: np.ndarray) -> dict[str, np.ndarray]:
        """What ``best_splits`` finds from histograms, from rows that are in the order of their nodes."""
        n, (first, last) = len(size), (np.cumsum(size) - size, np.cumsum(size) - 1)
        values = np.stack([c.take(rows) for c in self.channels])
        total = np.add.reduceat(values, first, axis=1)
        out = {"gain": np.zeros(n), "feature": cand[:, 0].astype(np.int32), "cut": np.zeros(n, np.int64), "left": np.zeros_like(total.T), "right": total.T.copy()}
        for j in range(cand.shape[1]):
            b = self._bins(rows, cand[:, j].take(slot))
            if self.growth.random_cuts:
                lo, hi = np.minimum.reduceat(b, first).astype(np.int64), np.maximum.reduceat(b, first).astype(np.int64)
                at = np.flatnonzero(lo < hi)
                cut = drawn_cuts(cand[at, j], lo[at], hi[at], paths[at], self.edges)
                upto = np.full(n, -1)
                upto[at] = cut
                left = np.add.reduceat(values * (b <= upto.take(slot)), first, axis=1)[:, at]
            else:
                order = np.sort(((slot << 8) + b << 20) + np.arange(len(b)))  # by node and bin
                key, place = order >> 20, order & (1 << 20) - 1
                end = np.flatnonzero(key[1:] != key[:-1])  # the last row of a bin
                end = end[key[end] >> 8 == key[end + 1] >> 8]  # not of a node
                at, cut = key[end] >> 8, key[end] & 255
                sums = np.cumsum(values.take(place, axis=1), axis=1)  # whole numbers: exact
                left = sums.take(end, axis=1) - (sums[:, last] - total).take(at, axis=1)
            if not len(at):
                continue
            own = total.take(at, axis=1)
            right = own - left
            gain = worth(left, self.growth, self.gini)
            gain += worth(right, self.growth, self.gini)
            gain -= worth(own, self.growth, self.gini)
            least = max(self.growth.least, 1)
            ok = (left[-1] >= least) & (right[-1] >= least)
            if not self.gini and self.growth.hessian:
                ok &= (left[1] >= self.growth.hessian) & (right[1] >= self.growth.hessian)
            gain = np.where(ok, gain, 0.0)
            begin = np.concatenate([[0], np.flatnonzero(np.diff(at)) + 1])
            most = np.maximum.reduceat(gain, begin)
            is_most = np.flatnonzero(gain == np.repeat(most, np.diff(np.append(begin, len(at)))))
            pick = is_most[np.concatenate([[True], at[is_most[1:]] != at[is_most[:-1]]])]  # the first of equal ones
            pick = pick[gain[pick] > out["gain"][at[pick]]]
            node = at[pick]
            cut = cut[pick]
            out["gain"][node], out["feature"][node], out["cut"][node] = gain[pick], cand[node, j], cut
            out["left"][node], out["right"][node] = left[:, pick].T, right[:, pick].T
        return out

    def splits(self, tree: Tree, front: np.ndarray, columns: np.ndarray) -> dict[str, np.ndarray]:
        if len(tree) > 1 and self.growth.per_node:
            self._move_all(tree, front)
        elif len(tree) > 1:  # only to nodes that are open
            to = set(front.tolist())
            self._move(tree, [n for n in self.held if tree.left[n] >= 0 and not to.isdisjoint((int(tree.left[n]), int(tree.left[n]) + 1))])
        where = np.full(len(tree), -1, np.int32)
        where[front] = np.arange(len(front))
        cand = candidates(self.growth, columns, tree.path[front])
        if self.growth.per_node:
            return self._own_features(cand, tree.path[front])
        # Of two open children, count the one with fewer rows and subtract it from the parent.
        hist = np.empty((len(front), cand.shape[1], len(self.channels), BINS))
        counted = np.ones(len(front), bool)
        if self.kept is not None and len(front):
            parents, old = self.kept
            left = tree.left[parents]
            a, b = where[left], where[left + 1]
            pair = (a >= 0) & (b >= 0)
            a, b, old = a[pair], b[pair], old[pair]
            fewer = tree.total[front[a], -1] <= tree.total[front[b], -1]
            small, large = np.where(fewer, a, b), np.where(fewer, b, a)
            counted[large] = False
        rows = [self.held[n] for n in front[counted].tolist()]
        slot = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        hist[counted] = self.histograms(slot, np.concatenate(rows or [self.rows[:0]]), cand[counted])
        if not counted.all():
            hist[large] = old - hist[small]
        self.kept = (front, hist)
        return best_splits(hist, cand, tree.path[front], self.growth, self.gini, self.edges)

    def grow(self, seed: int, below: tuple[int, int] | None = None) -> Tree:
        """``below``: path and depth of the node of a larger tree that the rows belong to, whose subtree is grown."""
        self.start()
        columns = tree_columns(self.growth, self.bins.shape[1], seed)
        growth = replace(self.growth, depth=self.growth.depth - below[1]) if below and self.growth.depth else self.growth
        run = grow(growth, seed, self.total(), self.gini)
        try:
            tree, front = next(run)
            if below:
                tree.path[0] = below[0]
            while True:
                got = self.splits(tree, front, columns)
                if self.kept is not None:  # only nodes that were split have children to subtract from
                    split = got["gain"] > 1e-7 * (1.0 if self.gini else UNIT)
                    self.kept = (self.kept[0][split], self.kept[1][split])
                tree, front = run.send(got)
        except StopIteration as end:
            return end.value


# --- models --------------------------------------------------------------------------------------------

def softmax(raw: np.ndarray) -> np.ndarray:
    k = raw.shape[1]
    if not 2 <= k < 8:
        e = np.exp(raw - raw.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)
    # Column by column, which is faster for few classes, in the order in which numpy adds up a row.
    e = np.exp(raw - reduce(np.maximum, [raw[:, c] for c in range(k)])[:, None])
    return e / reduce(np.add, [e[:, c] for c in range(k)])[:, None]


def prior(y: np.ndarray, w: np.ndarray, k: int) -> np.ndarray:
    """Log shares of the classes, rounded so that the order of summing doesn't show."""
    share = np.bincount(y, weights=w, minlength=k)
    return np.round(np.log(np.maximum(share / max(share.sum(), 1e-300), 1e-12)), 8)


def gradients(raw: np.ndarray, y: np.ndarray, w: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Softmax gradients and hessians by class, as whole numbers of 1 / UNIT."""
    p = softmax(raw)
    g = p.copy()
    g[np.arange(len(y)), y] -= 1
    return np.rint(g * w[:, None] * UNIT), np.rint(p * (1 - p) * w[:, None] * UNIT)


def leaf_scores(tree: Tree, setting: Boosting) -> np.ndarray:
    """What each node adds to the raw score of its class."""
    with np.errstate(divide="ignore", invalid="ignore"):
        v = -setting.step * tree.total[:, 0] / (tree.total[:, 1] + setting.growth.l2 * UNIT)
    return np.where(np.isfinite(v), v, 0.0)


def scaled(setting: Boosting) -> Growth:
    """The growth rules in units of the rounded gradients."""
    g = setting.growth
    return Growth(**{**g.__dict__, "l2": g.l2 * UNIT, "hessian": g.hessian * UNIT})


def tree_seed(seed: int, round_no: int, k: int) -> int:
    return int(mix(np.array([(seed * 1_000_003 + round_no) * 64 + k], np.uint64))[0] >> np.uint64(1))


def rows_of_round(ids: np.ndarray, setting: Boosting, seed: int, round_no: int) -> np.ndarray:
    return np.ones(len(ids)) if setting.rows >= 1 else (uniform(ids, seed, round_no, 11) < setting.rows).astype(float)


def boost(bins: np.ndarray, y: np.ndarray, w: np.ndarray, ids: np.ndarray, learn: np.ndarray, k: int, setting: Boosting, seed: int,
          edges: np.ndarray, stops: tuple[int, ...] = (), times: np.ndarray | None = None) -> tuple[dict[int, np.ndarray], list[list[Tree]], np.ndarray]:
    """Fit on the rows that ``learn`` names. Returns the raw scores of all rows after each of ``stops`` rounds
    (and the last), the trees by round and class, and the starting scores. ``times``: how many rows each row stands for
    (only without row shares, which go by id)."""
    start = prior(y[learn], (w if times is None else w * times)[learn], k)
    rest = ~learn
    lb, ly, lw, li, ob = bins[learn], y[learn], w[learn], ids[learn], bins[rest]
    raw, others = np.tile(start, (len(lb), 1)), np.tile(start, (len(ob), 1))
    other_columns, all_others, ends = [np.ascontiguousarray(c) for c in ob.T], np.arange(len(ob)), np.empty(len(ob), np.int32)

    def whole() -> np.ndarray:
        out = np.empty((len(y), k))
        out[learn], out[rest] = raw, others
        return out

    source = LocalRows(lb, [], scaled(setting), False, edges, single=times is None)
    rounds, scores = [], {}
    for r in range(setting.rounds):
        g, h = gradients(raw, ly, lw, k)
        use = rows_of_round(li, setting, seed, r) if times is None else times[learn]
        unused = np.flatnonzero(use == 0)
        trees = []
        for c in range(k):
            source.channels = [g[:, c] * use, h[:, c] * use, use]
            t = source.grow(tree_seed(seed, r, c))
            leaf, value = source.ends(t), leaf_scores(t, setting)
            t.settle(source.columns, unused, leaf)
            t.settle(other_columns, all_others, ends)
            raw[:, c] += value[leaf]
            others[:, c] += value[ends]
            trees.append(t)
        rounds.append(trees)
        if r + 1 in stops:
            scores[r + 1] = whole()
    scores[setting.rounds] = whole()
    return scores, rounds, start


_POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(16)])


def draws(ids: np.ndarray, forest: Forest, seed: int, number: int) -> np.ndarray:
    """How often tree ``number`` takes each row: Poisson(1) by the row's id, or once."""
    if not forest.bootstrap:
        return np.ones(len(ids))
    return np.searchsorted(_POISSON, uniform(ids, seed, number, 13)).astype(float)


def forest_growth(forest: Forest, n_features: int) -> Growth:
    g = forest.growth
    return g if g.per_node else Growth(**{**g.__dict__, "per_node": max(1, int(math.sqrt(n_features)))})


def class_shares(tree: Tree) -> np.ndarray:
    """Class probabilities of every node."""
    w = tree.total[:, :-1]
    return w / np.maximum(w.sum(axis=1, keepdims=True), 1e-300)


def forest_tree(bins: np.ndarray, y: np.ndarray, w: np.ndarray, ids: np.ndarray, k: int, forest: Forest, seed: int, number: int, edges: np.ndarray) -> Tree:
    times = draws(ids, forest, seed, number)
    weight = np.rint(w * UNIT) * times
    source = LocalRows(bins, [np.where(y == c, weight, 0.0) for c in range(k)] + [times], forest_growth(forest, bins.shape[1]), True, edges)
    return source.grow(tree_seed(seed, number, 0))


def forest_votes(tree: Tree, bins: np.ndarray, depths: tuple[int, ...]) -> list[np.ndarray]:
    """Class probabilities of the rows by the tree cut off at each of ``depths`` (ascending, 0 for the whole tree last)."""
    share, node, done, out = class_shares(tree), np.zeros(len(bins), np.int32), 0, []
    for d in depths:
        node = tree.descend(bins, node, None if d == 0 else d - done)
        out.append(share[node])
        done = d
    return out


def importances(trees: list[Tree], n_features: int) -> np.ndarray:
    """Share of the gain that each feature has brought."""
    total = np.zeros(n_features)
    for t in trees:
        own = np.zeros(n_features)
        split = t.feature >= 0
        np.add.at(own, t.feature[split], t.gain[split])
        total += own / max(own.sum(), 1e-300)
    return total / max(total.sum(), 1e-300)
