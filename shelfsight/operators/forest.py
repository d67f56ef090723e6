"""A random forest whose trees have class weights of their own and a least size of a split.

Every tree sees each row a Poisson(1) number of times; the draws are arithmetic on a hash of
the row's key, so they are the same whenever a row is read again. The two class weights of a
tree balance its own sample. As long as a task can hold a tree's sample, the binned rows go once
to each group of trees, and a task draws and grows one tree of its group after the other. Beyond
that, nodes with more rows than a task should hold are split by summed histograms, a level at a
time; the rows of smaller nodes meet under (tree, node) and the rest of the subtree is grown
there. Which features a node may try depends on the seed, the tree and the way to the node, so
all kinds of growth make the same tree.

Numbers of rows are kept as integers until a gain is computed: a forest does not depend on the
order in which rows arrive.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from math import exp, factorial, isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfsight.operators.staging import discard, importable, stage

PRIME = 2**31 - 1
#: A row is in a sample as often as this many of these bounds are reached: Poisson(1).
POISSON = tuple(int(PRIME * sum(exp(-1) / factorial(j) for j in range(k + 1))) for k in range(9))
BINS = 256
#: Histograms summed in one pass, which bounds what a task holds (30 KB each).
_NODES_A_PASS = 2000

#: Rows whose sums share one float: rows below 2 ** 15, draws and draws of label 1 below 2 ** 18.
_CHUNK = 28_000
_ROWS, _DRAWS = 15, 33
#: Copies of a bin that take turns, so that equal bins in a row do not wait for each other.
_LANES = 4
_LANE = np.arange(_CHUNK) % _LANES * BINS
#: Nodes of fewer rows are grown together, level by level.
_SMALL = 4000
#: Groups of trees that are grown in one task each, for every core.
_GROUPS_A_CORE = 2
#: Rows whose values are counted at once, and how many ranks stand for their values.
_STRETCH, _RANKS = 1 << 18, 10_000
#: Rows in less than this share of what they are picked from get a table of their own.
_SPARSE = 8

_BLOCK = "x binary, y binary, a binary, b binary"
#: What is kept of a node; the right child follows the left one.
_NODE = {"feature": np.int16, "bin": np.int16, "left": np.int32, "zeros": np.int32, "ones": np.int32, "rows": np.int32}
_SUBTREE = "tree int, node int, " + ", ".join(f"{c} binary" for c in _NODE)


def draw_numbers(key: Column) -> tuple[Column, Column]:
    """Two numbers below PRIME from the key; tree t (from 1) draws (a * t + b) mod PRIME."""
    digest = F.md5(key.cast("string").cast("binary"))

    def part(first: int) -> Column:
        return F.conv(F.substr(digest, F.lit(first), F.lit(15)), 16, 10).cast("long") % PRIME

    return part(1), part(17)


def _drawn(a: np.ndarray, b: np.ndarray, tree: int) -> np.ndarray:
    """How often rows are in a tree's sample. No division: 2 ** 31 leaves 1 by PRIME."""
    out = np.empty(len(a), np.uint8)
    for low in range(0, len(a), _CHUNK):
        part = slice(low, low + _CHUNK)
        number = a[part].astype(np.uint64) * np.uint64(tree + 1) + b[part].astype(np.uint64)
        number = ((number & np.uint64(PRIME)) + (number >> np.uint64(31))).astype(np.uint32)
        number = np.minimum(number, number - np.uint32(PRIME))  # what is below PRIME wraps to more
        times = out[part]
        times[:] = number >= np.uint32(POISSON[0])
        for bound in POISSON[1:]:
            times += number >= np.uint32(bound)
    return out


def _packed(y: np.ndarray, drawn: np.ndarray) -> np.ndarray:
    """1, draws and draws of label 1 of each row as one number; other labels weigh nothing."""
    times = np.arange(len(POISSON) + 1)
    table = np.ones((3, len(times)))
    table[:2] += times * float(1 << _ROWS)
    table[1] += times * float(1 << _DRAWS)
    kind = np.minimum(y, 2).astype(np.int64) * len(times) + drawn
    return table.ravel().take(kind)


def _unpacked_sums(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Zeros, ones and rows of packed sums over ``_CHUNK`` rows at most."""
    sums = sums.astype(np.int64)
    ones = sums >> _DRAWS
    return ((sums >> _ROWS) & ((1 << (_DRAWS - _ROWS)) - 1)) - ones, ones, sums & ((1 << _ROWS) - 1)


def _add_draws(sums: np.ndarray, kind: int | None, a: np.ndarray, b: np.ndarray) -> None:
    """Add to ``sums``, a column per tree, how many rows are drawn and how often.

    The next tree's numbers are the last ones plus ``a``, so no product or remainder is taken.
    """
    prime = np.uint32(PRIME)
    a, number = a.astype(np.uint32), b.astype(np.uint32)
    for tree in range(sums.shape[1]):
        number = number + a  # below 2 ** 32, as both are below PRIME
        number = np.minimum(number, number - prime)  # what is below PRIME wraps to more
        times = [np.count_nonzero(number >= np.uint32(bound)) for bound in POISSON]
        sums[0, tree] += times[0]
        if kind is not None:
            sums[kind, tree] += sum(times)


def _mix(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def _child(way: np.ndarray, side: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mix(way * np.uint64(2) + np.uint64(side + 1))


def _root_way(seed: int, tree: int) -> np.ndarray:
    return _mix(np.array([(seed << 32) + tree + 1], np.uint64))


def _feature_order(way: np.ndarray, features: int) -> np.ndarray:
    """Per node all features in the order in which they are tried."""
    with np.errstate(over="ignore"):
        keys = way[:, None] * np.uint64(0x9E3779B97F4A7C15) + np.arange(features, dtype=np.uint64)
    return np.argsort(_mix(keys), axis=1, kind="stable")


@dataclass(frozen=True)
class Settings:
    trees: int
    depth: int
    split: int  # a node of fewer rows is a leaf
    leaf: int  # rows on each side of a split, at least
    tried: int  # features tried at once
    seed: int


def _gain(zeros, ones, all_zeros, all_ones, weights) -> np.ndarray:
    """Weighted Gini, up to constants of the node: larger is better, and a side without weight the worst."""
    left0, left1 = zeros * weights[0], ones * weights[1]
    right0, right1 = (all_zeros - zeros) * weights[0], (all_ones - ones) * weights[1]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (left0**2 + left1**2) / (left0 + left1) + (right0**2 + right1**2) / (right0 + right1)
    return np.where(np.isnan(gain), -np.inf, gain)


def _is_leaf(zeros, ones, rows, depth: int, settings: Settings):
    """Rows count once here however often they were drawn."""
    small = (rows < settings.split) | (rows < 2 * settings.leaf)
    return small | (zeros == 0) | (ones == 0) | (depth >= settings.depth)


def _by_node_and_bin(node: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The stable order by node, then bin: numpy counts digits to sort numbers of up to 16 bits."""
    by = np.argsort(value.astype(np.uint8), kind="stable")
    small = np.uint16 if not len(node) or node.max() < 1 << 16 else node.dtype
    return by[np.argsort(node.astype(small)[by], kind="stable")]


class _Nodes:
    """The nodes of a subtree as they are made; children lie side by side."""

    def __init__(self):
        self.made = 1
        self.parts = []

    def children(self, pairs: int) -> int:
        self.made += 2 * pairs
        return self.made - 2 * pairs

    def put(self, number, feature, at, left, zeros, ones, rows) -> None:
        self.parts.append((number, feature, at, left, zeros, ones, rows))

    def columns(self) -> dict[str, np.ndarray]:
        number, *values = (np.concatenate([np.atleast_1d(v) for v in c]) for c in zip(*self.parts, strict=True))
        out = {}
        for (name, kind), value in zip(_NODE.items(), values, strict=True):
            out[name] = np.empty(len(number), kind)
            out[name][number] = value
        return out


@dataclass
class _Rows:
    """Rows of a node: columns ``at`` of ``x`` (all without it), and what they weigh."""

    x: np.ndarray
    at: np.ndarray | None
    w: np.ndarray
    number: int
    way: np.ndarray
    depth: int

    def values(self, feature: int, part: slice = slice(None)) -> np.ndarray:
        if self.at is None:
            return self.x[feature, part]
        return self.x[feature].take(self.at[part], mode="clip")

    def own(self) -> np.ndarray:
        return self.x if self.at is None else self.x.take(self.at, axis=1, mode="clip")

    def sums(self) -> tuple[int, int, int]:
        parts = [self.w[i : i + _CHUNK].sum() for i in range(0, len(self.w), _CHUNK)]
        return tuple(int(v.sum()) for v in _unpacked_sums(np.array(parts)))


def grow(
    x: np.ndarray, at: np.ndarray | None, w: np.ndarray, weights: Sequence[float], way: np.ndarray,
    depth: int, settings: Settings,
) -> dict[str, np.ndarray]:
    """The subtree over rows ``at`` of the binned features ``x``, a line per feature.

    Large nodes are split one at a time, small ones together; ``w`` is what ``_packed`` gives.
    """
    nodes, waiting, small = _Nodes(), [_Rows(x, at, w, 0, way, depth)], []
    held = 0
    while waiting:
        rows = waiting.pop()
        if len(rows.w) < _SMALL:
            if held + len(rows.w) > _CHUNK:
                _grow_together(small, nodes, weights, settings)
                small, held = [], 0
            rows.x, rows.at = rows.own(), None
            small.append(rows)
            held += len(rows.w)
            continue
        sums = rows.sums()
        if _is_leaf(*sums, rows.depth, settings):
            nodes.put(rows.number, -1, -1, -1, *sums)
            continue
        if len(rows.w) * _SPARSE < rows.x.shape[1]:
            rows.x, rows.at = rows.own(), None
        feature, cut = _best_split(rows, sums, weights, settings)
        if feature < 0:
            nodes.put(rows.number, -1, -1, -1, *sums)
            continue
        left = nodes.children(1)
        nodes.put(rows.number, feature, cut, left, *sums)
        right = rows.values(feature) > cut
        for side, mine in enumerate((np.flatnonzero(~right), np.flatnonzero(right))):
            own = mine if rows.at is None else rows.at.take(mine, mode="clip")
            waiting.append(
                _Rows(rows.x, own, rows.w.take(mine, mode="clip"), left + side, _child(rows.way, side), rows.depth + 1)
            )
    if small:
        _grow_together(small, nodes, weights, settings)
    return nodes.columns()


def _best_split(rows: _Rows, sums, weights: Sequence[float], settings: Settings) -> tuple[int, int]:
    """Feature and bin of a node's split, by a histogram of each feature tried; -1 without one."""
    order = _feature_order(rows.way, rows.x.shape[0])[0].tolist()
    for first in range(0, len(order), settings.tried):
        tried = order[first : first + settings.tried]
        total = np.zeros((3, len(tried), BINS), np.int64)
        for low in range(0, len(rows.w), _CHUNK):
            part = slice(low, low + _CHUNK)
            w = rows.w[part]
            packed = np.stack([
                np.bincount(rows.values(f, part) + _LANE[: len(w)], w, _LANES * BINS).reshape(_LANES, BINS).sum(axis=0)
                for f in tried
            ])
            total += _unpacked_sums(packed)
        zeros, ones, left = np.cumsum(total, axis=2)
        # a bin without rows gains what the one before it does, and the first of equal ones is taken
        fits = (left >= max(settings.leaf, 1)) & (sums[2] - left >= max(settings.leaf, 1))
        if not fits.any():
            continue
        gain = np.full(fits.shape, -np.inf)
        gain[fits] = _gain(zeros[fits], ones[fits], sums[0], sums[1], weights)
        best = int(np.argmax(gain))
        if gain.flat[best] > -np.inf:
            return tried[best // BINS], best % BINS
    return -1, -1


def _grow_together(small: list[_Rows], nodes: _Nodes, weights: Sequence[float], settings: Settings) -> None:
    """The subtrees under some small nodes, all level by level: ``_CHUNK`` rows in all, at most."""
    x = np.concatenate([r.x for r in small], axis=1)
    w = np.concatenate([r.w for r in small])
    p, n = x.shape
    bins = x.max(axis=1).astype(np.int64) + 1
    x, row = x.ravel(), np.arange(n)
    size = np.array([len(r.w) for r in small])
    number = np.array([r.number for r in small])
    depth = np.array([r.depth for r in small])
    way = np.concatenate([r.way for r in small])
    while len(number):
        zeros, ones, rows = _unpacked_sums(np.add.reduceat(w, np.cumsum(size) - size))
        leaf = _is_leaf(zeros, ones, rows, depth, settings)
        nodes.put(number[leaf], *(np.full(leaf.sum(), -1) for _ in range(3)), zeros[leaf], ones[leaf], rows[leaf])
        stays = ~leaf
        keep = np.repeat(stays, size)
        row, w = row[keep], w[keep]
        number, depth, way, size = number[stays], depth[stays], way[stays], size[stays]
        zeros, ones, rows = zeros[stays], ones[stays], rows[stays]
        feature, cut = np.full(len(number), -1), np.full(len(number), -1)
        best = np.full(len(number), -np.inf)
        order = _feature_order(way, p)
        todo = np.arange(len(number))
        for first in range(0, p, settings.tried):
            if not len(todo):
                break
            some = len(todo) < len(number)
            inside = np.flatnonzero(np.repeat(feature < 0, size)) if some else None
            its_row, its_w = (v.take(inside) if some else v for v in (row, w))
            its_size = size[todo]
            for slot in range(first, min(first + settings.tried, p)):
                tried = order[todo, slot]
                end = np.cumsum(bins[tried])
                begin = end - bins[tried]
                value = x.take(its_row + np.repeat(tried * n, its_size), mode="clip")
                sums = np.bincount(value + np.repeat(begin, its_size), its_w, end[-1])
                cell = np.flatnonzero(sums > 0)  # every row counts, so no bin with rows is 0
                before = np.searchsorted(cell, begin)
                own = np.diff(np.append(before, len(cell)))
                owner = np.repeat(np.arange(len(todo)), own)
                upto = np.cumsum(sums.take(cell))
                upto -= np.repeat(np.where(before > 0, upto[before - 1], 0.0), own)
                zero, one, left = _unpacked_sums(upto)
                node = todo[owner]
                fits = np.flatnonzero((left >= max(settings.leaf, 1)) & (rows[node] - left >= max(settings.leaf, 1)))
                if not len(fits):
                    continue
                owner, node, zero, one = owner[fits], node[fits], zero[fits], one[fits]
                gain = _gain(zero, one, zeros[node], ones[node], weights)
                starts = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
                most = np.maximum.reduceat(gain, starts)
                top = np.flatnonzero(gain == np.repeat(most, np.diff(np.append(starts, len(node)))))
                top = top[np.append(True, node[top][1:] != node[top][:-1])]
                top = top[gain[top] > best[node[top]]]
                holder = node[top]
                best[holder] = gain[top]
                cut[holder] = cell[fits[top]] - begin[owner[top]]
                feature[holder] = tried[owner[top]]
            todo = np.flatnonzero(feature < 0)
        splits = np.flatnonzero(feature >= 0)
        left = np.full(len(number), -1)
        left[splits] = nodes.children(len(splits)) + 2 * np.arange(len(splits))
        nodes.put(number, feature, cut, left, zeros, ones, rows)
        keep = np.repeat(feature >= 0, size)
        row, w, size = row[keep], w[keep], size[splits]
        goes_right = x.take(row + np.repeat(feature[splits] * n, size), mode="clip") > np.repeat(cut[splits], size)
        child = 2 * np.repeat(np.arange(len(splits)), size) + goes_right
        by = np.argsort(child.astype(np.uint16), kind="stable")
        row, w, size = row.take(by), w.take(by), np.bincount(child, minlength=2 * len(splits))
        number = (left[splits][:, None] + np.arange(2)).ravel()
        depth = np.repeat(depth[splits] + 1, 2)
        way = np.stack((_child(way[splits], 0), _child(way[splits], 1)), axis=1).ravel()


@dataclass
class _Top:
    """The nodes of one tree that are not grown in a task: splits and what is still open."""

    weights: tuple[float, float]
    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    zeros: list[int] = field(default_factory=list)
    ones: list[int] = field(default_factory=list)
    rows: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    way: list[int] = field(default_factory=list)
    tried: list[int] = field(default_factory=list)  # features tried without a split

    def add(self, zeros: int, ones: int, rows: int, depth: int, way: int) -> int:
        for name, value in (("feature", -1), ("bin", -1), ("left", -1), ("right", -1), ("zeros", zeros),
                            ("ones", ones), ("rows", rows), ("depth", depth), ("way", way), ("tried", 0)):
            getattr(self, name).append(value)
        return len(self.feature) - 1

    def route(self, x: np.ndarray) -> np.ndarray:
        return _route(x, *(np.array(c) for c in (self.feature, self.bin, self.left, self.right)))


def _route(x, feature, bins, left, right) -> np.ndarray:
    """The last node of each row. Right children follow left ones."""
    inner = feature >= 0
    # a leaf leads to itself: no bin is larger than the last one
    feature, bins = np.where(inner, feature, 0).astype(np.int64), np.where(inner, bins, BINS - 1).astype(np.int16)
    left = np.where(inner, left, np.arange(len(feature))).astype(np.int64)
    flat, out = np.ascontiguousarray(x).ravel(), np.empty(len(x), np.int64)
    for low in range(0, len(x), _CHUNK):
        node = out[low : low + _CHUNK]
        node[:] = 0
        first = (low + np.arange(len(node))) * x.shape[1]
        while True:
            value = flat.take(first + feature.take(node))
            then = left.take(node) + (value > bins.take(node))
            if (then == node).all():
                break
            node[:] = then
    return out


@dataclass(frozen=True)
class Forest:
    """Trees as one list of nodes; ``start`` tells where each tree begins."""

    features: tuple[str, ...]
    edges: tuple[np.ndarray, ...]
    start: np.ndarray
    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    right: np.ndarray
    zeros: np.ndarray
    ones: np.ndarray
    rows: np.ndarray
    weights: np.ndarray  # per tree, of labels 0 and 1

    def scores(self, columns: Sequence[np.ndarray]) -> np.ndarray:
        """The mean over the trees of the weighted share of label 1 in a row's leaf."""
        x = _binned(columns, self.edges)
        total = np.zeros(len(x))
        for tree, (low, high) in enumerate(zip(self.start[:-1], self.start[1:], strict=True)):
            part = slice(low, high)
            zeros, ones = self.zeros[part] * self.weights[tree, 0], self.ones[part] * self.weights[tree, 1]
            share = ones / np.maximum(zeros + ones, np.finfo(float).tiny)
            total += share[_route(x, self.feature[part], self.bin[part], self.left[part], self.right[part])]
        return total / len(self.weights)


def score(forest: Forest, df: DataFrame, name: str = "score") -> DataFrame:
    """``df`` with the forest's probability of label 1. Features must not be null."""
    spark = df.sparkSession
    importable(spark)
    shared = spark.sparkContext.broadcast(forest)

    @F.pandas_udf("double")
    def predict(*columns: pd.Series) -> pd.Series:
        return pd.Series(shared.value.scores([c.to_numpy(float) for c in columns]))

    return df.withColumn(name, predict(*(F.col(c).cast("double") for c in forest.features)))


def _binned(columns: Sequence[np.ndarray], edges: Sequence[np.ndarray]) -> np.ndarray:
    return np.stack(
        [np.searchsorted(e, c, "left").astype(np.uint8) for c, e in zip(columns, edges, strict=True)], axis=1
    )


def _edges(rows: DataFrame, features: Sequence[str]) -> tuple[np.ndarray, ...]:
    """Where each feature may be cut: at most 255 of its values, its largest left out.

    Stretches of rows send the counts of their values, or of some ten thousand evenly spaced
    ranks, so a quantile's rank is wrong by a 10,000th of all rows at most.
    """
    importable(rows.sparkSession)
    picked = rows.select(*(F.col(f).cast("double").alias(f"f{i}") for i, f in enumerate(features)))

    def counted(stretch: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(stretch)
        parts = [_counts(table.column(i).drop_null().to_numpy()) for i in range(len(features))]
        columns = [pa.array(np.arange(len(parts), dtype=np.int32))]
        columns += [pa.array([part[i].tobytes() for part in parts], pa.binary()) for i in range(2)]
        return pa.RecordBatch.from_arrays(columns, ["feature", "value", "times"])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= _STRETCH:
                yield counted(held)
                held, size = [], 0
        if size:
            yield counted(held)

    def cut(key: tuple, table: pa.Table) -> pa.Table:
        value, times = (
            np.concatenate([np.frombuffer(v, kind) for v in table.column(c).to_pylist()])
            for c, kind in (("value", np.float64), ("times", np.int64))
        )
        by = np.argsort(value, kind="stable")
        value, upto = value[by], np.cumsum(times[by])
        if len(value):
            ranks = np.ceil(np.arange(1, BINS) / BINS * upto[-1]).astype(np.int64)
            found = np.unique(value[np.searchsorted(upto, ranks)])
            value = found[found < value[-1]]
        return pa.table({"feature": pa.array([key[0].as_py()], pa.int32()), "cuts": pa.array([value.tobytes()], pa.binary())})

    counts = picked.mapInArrow(summed, "feature int, value binary, times binary")
    cuts = counts.groupBy("feature").applyInArrow(cut, "feature int, cuts binary").collect()
    found = {row.feature: np.frombuffer(row.cuts, np.float64) for row in cuts}
    return tuple(found.get(i, np.empty(0)) for i in range(len(features)))


def _counts(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values and how often they occur; of too many, ranks stand for those from the last rank on."""
    values = np.sort(values)
    last = np.flatnonzero(values[1:] != values[:-1])
    if len(last) >= _RANKS:
        last = np.arange(1, _RANKS) * len(values) // _RANKS - 1
    last = np.append(last, len(values) - 1) if len(values) else last
    return values[last], np.diff(last, prepend=-1)


def _blocks(rows: DataFrame, features: Sequence[str], label: str, key: Column, edges) -> DataFrame:
    a, b = draw_numbers(key)
    shared = rows.sparkSession.sparkContext.broadcast(edges)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(batch.num_columns)]
            numbers = (c.astype(np.uint32) for c in columns[-2:])
            parts = (_binned(columns[:-3], shared.value), columns[-3].astype(np.uint8), *numbers)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part.tobytes()], pa.binary()) for part in parts], ["x", "y", "a", "b"]
            )

    picked = rows.select(
        *(F.col(f).cast("double").alias(f"f{i}") for i, f in enumerate(features)),
        F.col(label).cast("int").alias("y"), a.alias("a"), b.alias("b"),
    )
    return picked.mapInArrow(pack, _BLOCK)


def _unpacked(batches: Iterator[pa.RecordBatch], features: int):
    for batch in batches:
        for x, y, a, b in zip(*(batch.column(c).to_pylist() for c in ("x", "y", "a", "b")), strict=True):
            y = np.frombuffer(y, np.uint8)
            yield np.frombuffer(x, np.uint8).reshape(len(y), features), y, np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32)


def tree_weights(rows: DataFrame, trees: int, label: str, key: Column) -> DataFrame:
    """``tree, rows, zeros, ones, weight_0, weight_1``: each tree's sample and what balances it.

    A label that a sample lacks has no weight.
    """
    importable(rows.sparkSession)
    a, b = draw_numbers(key)

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((3, trees), np.int64)  # rows, zeros, ones
        for batch in batches:
            y, a, b = (batch.column(c) for c in ("y", "a", "b"))
            label = y.fill_null(-1).to_numpy()
            for kind, mine in ((1, label == 0), (2, label == 1), (None, (label != 0) & (label != 1))):
                if mine.any():
                    _add_draws(sums, kind, a.to_numpy()[mine], b.to_numpy()[mine])
        seen = np.flatnonzero(sums[0])
        columns = [pa.array(seen, pa.int32()), *(pa.array(v[seen], pa.int64()) for v in sums)]
        yield pa.RecordBatch.from_arrays(columns, ["tree", "rows", "zeros", "ones"])

    drawn_from = rows.select(F.col(label).cast("int").alias("y"), a.alias("a"), b.alias("b"))
    counts = drawn_from.where("a IS NOT NULL").mapInArrow(sample, "tree int, rows long, zeros long, ones long")
    names = ("rows", "zeros", "ones")
    # a tree whose sample is empty has its line, if there are rows at all
    listed = (
        rows.limit(1).select(F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
        .select("tree", *(F.lit(0).cast("long").alias(c) for c in names))
    )
    sums = counts.unionByName(listed).groupBy("tree").agg(*(F.sum(c).alias(c) for c in names))
    total = F.col("zeros") + F.col("ones")
    return sums.select(
        "tree", "rows", "zeros", "ones",
        *(F.when(F.col(c) > 0, total / (2 * F.col(c))).otherwise(0.0).alias(f"weight_{i}")
          for i, c in enumerate(("zeros", "ones"))),
    )


def _by_node(x: np.ndarray, inside: np.ndarray, drawn: np.ndarray, top: _Top) -> Iterator[tuple[int, np.ndarray]]:
    """The rows ``inside`` by the node of ``top`` that they are in."""
    node = top.route(x[inside])
    by = _by_node_and_bin(node, drawn[inside])
    node, inside = node[by], inside[by]
    starts = np.flatnonzero(np.append(True, node[1:] != node[:-1])) if len(node) else []
    for n, mine in zip(node[starts].tolist() if len(node) else [], np.split(inside, starts[1:]) if len(node) else []):
        yield n, mine


def _split_large(blocks: DataFrame, tops: dict[int, _Top], open_: list[tuple[int, int]], p: int, settings: Settings):
    """The best splits of nodes by histograms summed over all rows; None where nothing fits."""
    spark = blocks.sparkSession
    shared = spark.sparkContext.broadcast((tops, open_))

    def tried(top: _Top, node: int) -> np.ndarray:
        way = np.array([top.way[node]], np.uint64)
        return _feature_order(way, p)[0, top.tried[node] : top.tried[node] + settings.tried]

    def histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops, open_ = shared.value
        shape = (settings.tried, BINS, 3)
        sums = {pair: np.zeros(shape, np.int64) for pair in open_}
        of_tree = {t: {n: tried(tops[t], n).tolist() for tree, n in open_ if tree == t} for t in {t for t, _ in open_}}
        for x, y, a, b in _unpacked(batches, p):
            for tree, wanted in of_tree.items():
                drawn = _drawn(a, b, tree)
                w = _packed(y, drawn)
                for n, mine in _by_node(x, np.flatnonzero(drawn), drawn, tops[tree]):
                    if n not in wanted:
                        continue
                    for low in range(0, len(mine), _CHUNK):
                        part = mine[low : low + _CHUNK]
                        for slot, f in enumerate(wanted[n]):
                            found = _unpacked_sums(np.bincount(x[part, f], w[part], BINS))
                            sums[tree, n][slot] += np.stack(found, axis=1)
        yield pa.RecordBatch.from_arrays(
            [pa.array([t for t, _ in open_], pa.int32()), pa.array([n for _, n in open_], pa.int32()),
             pa.array([sums[pair].tobytes() for pair in open_], pa.binary())],
            ["tree", "node", "sums"],
        )

    def choose(key: tuple, table: pa.Table) -> pa.Table:
        tops, _ = shared.value
        tree, node = (k.as_py() for k in key)
        top = tops[tree]
        sums = sum(np.frombuffer(s, np.int64) for s in table.column("sums").to_pylist())
        sums = np.cumsum(sums.reshape(-1, BINS, 3), axis=1)
        found = dict(tree=tree, node=node, feature=-1, bin=-1, zeros=0, ones=0, rows=0)
        best = -np.inf
        for slot, f in enumerate(tried(top, node)):
            zeros, ones, rows = sums[slot].T
            own = np.append(True, rows[1:] != rows[:-1])  # a cut stands at a bin that has rows
            fits = own & (rows >= settings.leaf) & (top.rows[node] - rows >= settings.leaf)
            if not fits.any():
                continue
            at = np.flatnonzero(fits)
            gain = _gain(zeros[at], ones[at], top.zeros[node], top.ones[node], top.weights)
            i = int(np.argmax(gain))
            if gain[i] > best:
                best, cut = gain[i], at[i]
                found |= dict(feature=int(f), bin=int(cut), zeros=int(zeros[cut]), ones=int(ones[cut]), rows=int(rows[cut]))
        return pa.Table.from_pylist([found], _CHOICE)

    parts = blocks.mapInArrow(histograms, "tree int, node int, sums binary")
    kinds = "tree int, node int, feature int, bin int, zeros long, ones long, rows long"
    return parts.groupBy("tree", "node").applyInArrow(choose, kinds).collect()


_CHOICE = pa.schema(
    [("tree", pa.int32()), ("node", pa.int32()), ("feature", pa.int32()), ("bin", pa.int32()),
     ("zeros", pa.int64()), ("ones", pa.int64()), ("rows", pa.int64())]
)


def _grow_large(blocks: DataFrame, tops: dict[int, _Top], p: int, local: int, settings: Settings) -> None:
    """Split nodes of more than ``local`` rows, some thousand in a pass, until none is left."""

    def waiting(top: _Top) -> list[int]:
        return [
            n for n in range(len(top.feature))
            if top.feature[n] < 0 and top.rows[n] > local and top.tried[n] < p
            and not _is_leaf(top.zeros[n], top.ones[n], top.rows[n], top.depth[n], settings)
        ]

    while open_ := [(t, n) for t, top in tops.items() for n in waiting(top)]:
        for row in _split_large(blocks, tops, open_[:_NODES_A_PASS], p, settings):
            top, n = tops[row.tree], row.node
            if row.feature < 0:
                top.tried[n] += settings.tried
                continue
            way = np.array([top.way[n]], np.uint64)
            rest = (top.zeros[n] - row.zeros, top.ones[n] - row.ones, top.rows[n] - row.rows)
            depth = top.depth[n] + 1
            top.feature[n], top.bin[n] = row.feature, row.bin
            top.left[n] = top.add(row.zeros, row.ones, row.rows, depth, int(_child(way, 0)[0]))
            top.right[n] = top.add(*rest, depth, int(_child(way, 1)[0]))


def _grow_small(blocks: DataFrame, tops: dict[int, _Top], p: int, local: int, settings: Settings) -> DataFrame:
    """The subtrees under the open nodes of at most ``local`` rows, each grown in one task."""
    shared = blocks.sparkSession.sparkContext.broadcast(tops)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, y, a, b in _unpacked(batches, p):
            for tree, top in shared.value.items():
                drawn = _drawn(a, b, tree)
                rows = []
                for n, mine in _by_node(x, np.flatnonzero(drawn), drawn, top):
                    if top.rows[n] > local:
                        continue
                    parts = (x[mine], y[mine], drawn[mine])
                    rows.append((tree, n, *(part.tobytes() for part in parts)))
                if rows:
                    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
                    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, ["tree", "node", "x", "y", "drawn"])

    def subtree(key: tuple, table: pa.Table) -> pa.Table:
        tree, node = (k.as_py() for k in key)
        top = shared.value[tree]
        x, y, drawn = (
            np.frombuffer(b"".join(table.column(c).to_pylist()), np.uint8) for c in ("x", "y", "drawn")
        )
        way = np.array([top.way[node]], np.uint64)
        x = np.ascontiguousarray(x.reshape(len(y), p).T)
        grown = grow(x, None, _packed(y, drawn), top.weights, way, top.depth[node], settings)
        return pa.Table.from_batches([_subtree_row(tree, node, grown)])

    dealt = blocks.mapInArrow(deal, "tree int, node int, x binary, y binary, drawn binary")
    return dealt.groupBy("tree", "node").applyInArrow(subtree, _SUBTREE)


def _subtree_row(tree: int, node: int, grown: dict[str, np.ndarray]) -> pa.RecordBatch:
    places = [pa.array([v], pa.int32()) for v in (tree, node)]
    return pa.RecordBatch.from_arrays(
        [*places, *(pa.array([v.tobytes()], pa.binary()) for v in grown.values())], ["tree", "node", *grown]
    )


def _grow_whole(blocks: DataFrame, tops: dict[int, _Top], p: int, settings: Settings) -> DataFrame:
    """Whole trees, each in one task. Trees are dealt to groups, and the rows go once to each group.

    Drawing a tree's rows where it is grown moves a row once a group and not once a tree.
    """
    spark = blocks.sparkSession
    groups = max(1, min(len(tops), _GROUPS_A_CORE * spark.sparkContext.defaultParallelism))
    total = blocks.agg(F.sum(F.length("y"))).first()[0]
    shared = spark.sparkContext.broadcast({t: top for t, top in tops.items() if top.rows[0] > 0})

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, y, a, b = np.empty((p, 0), np.uint8), None, None, None
        at, group = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if group is None:
                group = batch.column("to")[0].as_py()
                x, y = np.empty((p, total), np.uint8), np.empty(total, np.uint8)
                a, b = np.empty(total, np.uint32), np.empty(total, np.uint32)
            for parts in _unpacked([batch], p):
                here = slice(at, at + len(parts[1]))
                x[:, here] = parts[0].T
                y[here], a[here], b[here] = parts[1:]
                at = here.stop
        if group is None:
            return
        for tree, top in shared.value.items():
            if tree % groups == group:
                drawn = _drawn(a, b, tree)
                inside = np.flatnonzero(drawn)
                w = _packed(y.take(inside), drawn.take(inside))
                way = np.array([top.way[0]], np.uint64)
                yield _subtree_row(tree, 0, grow(x, inside, w, top.weights, way, 0, settings))

    dealt = blocks.select("*", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("to"))
    return dealt.repartitionById(groups, F.col("to")).mapInArrow(trees, _SUBTREE)


def fit_forest(
    rows: DataFrame,
    features: Sequence[str],
    key: Column,
    label: str = "label",
    num_trees: int = 400,
    max_depth: int = 15,
    min_split: int = 5,
    min_leaf: int = 2,
    seed: int = 42,
    local_rows: int = 1 << 24,
) -> Forest:
    """Fit on ``rows``, which are read several times (runs jobs).

    ``key`` tells rows apart: rows of one key are drawn alike. A node tries features a square
    root of their number at a time, until one splits it. A feature is cut at 255 of its
    quantiles at most. A node of up to ``local_rows`` rows (or a 1,024th of all rows, if that
    is more, so that the part grown by histograms stays small enough for the driver) is grown
    in one task. If these are all rows of a tree, its task holds the binned rows of all trees. The forest has at most ``num_trees * 2 ** (max_depth + 1)`` nodes; it is
    gathered in the driver and sent to the tasks that score.
    """
    importable(rows.sparkSession)
    p = len(features)
    settings = Settings(num_trees, max_depth, min_split, min_leaf, max(1, isqrt(p)), seed)
    edges = _edges(rows, features)
    blocks = stage(_blocks(rows, features, label, key, edges))
    tops = {}
    for row in tree_weights(rows, num_trees, label, key).collect():
        tops[row.tree] = _Top((row.weight_0, row.weight_1))
        tops[row.tree].add(row.zeros, row.ones, row.rows, 0, int(_root_way(seed, row.tree)[0]))
    most = max((top.rows[0] for top in tops.values()), default=0)
    local = max(local_rows, most // 1024)
    if most <= local:
        grown = _grow_whole(blocks, tops, p, settings) if tops else None
    else:
        _grow_large(blocks, tops, p, local, settings)
        grown = _grow_small(blocks, tops, p, local, settings)
    subtrees = {
        (r.tree, r.node): {c: np.frombuffer(r[c], kind) for c, kind in _NODE.items()}
        for r in (grown.collect() if grown is not None else [])
    }
    discard(blocks)
    return _assembled(tuple(features), edges, tops, subtrees)


def _assembled(features, edges, tops: dict[int, _Top], subtrees: dict) -> Forest:
    columns = {name: [] for name in _NODE}
    start = [0]
    for tree in sorted(tops):
        top = tops[tree]
        own = {name: [np.array(getattr(top, name), np.int64).astype(kind)] for name, kind in _NODE.items()}
        made = len(top.feature)
        for node in range(len(top.feature)):
            grown = subtrees.get((tree, node))
            if top.feature[node] >= 0 or grown is None:
                continue
            shift = made - 1  # the subtree's first node takes the place of this one
            made += len(grown["feature"]) - 1
            for name, values in grown.items():
                if name == "left":
                    values = np.where(values >= 0, values + shift, values).astype(values.dtype)
                own[name][0][node] = values[0]
                own[name].append(values[1:])
        for name in _NODE:
            columns[name] += own[name]
        start.append(start[-1] + made)
    nodes = {name: np.concatenate([np.empty(0, kind), *columns[name]]) for name, kind in _NODE.items()}
    nodes["right"] = np.where(nodes["left"] >= 0, nodes["left"] + 1, -1).astype(nodes["left"].dtype)
    weights = np.array([tops[t].weights for t in sorted(tops)], float).reshape(-1, 2)
    names = ("feature", "bin", "left", "right", "zeros", "ones", "rows")
    return Forest(features, edges, np.array(start), *(nodes[n] for n in names), weights)
