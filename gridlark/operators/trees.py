"""Tree ensembles for regression, grown from binned rows.

Spark's own trees stop at depth 30, grow level by level, boost without second-order gain
and can't require rows for a split. Here every feature is cut into bins once, a row keeps
only the bins other than that of zero, and trees are grown in two ways with equal results:

* Nodes with many rows are split by histograms: every task counts its rows, Spark sums the
  cells, and one histogram per open node is read back (columns and bins set its size, not
  rows).
* A node whose rows fit one task is finished there. All such nodes of all trees, and of all
  points of a search grid, are one grouped pass. A node that isn't split further has its value
  from its histogram, so no node of more rows than fit a task is ever brought together.
* Rows that share all bins can't be told apart by any split. Where many rows have few kinds
  of bins, and no tree draws rows, kinds with their counts and sums take the place of rows.

Forests grow to any depth. Boosting grows best-first by gain, up to a number of leaves, or
level by level; the smaller child is counted and its sibling is the difference. Rows and
columns are drawn once per tree. Draws depend on a row's place in the stored bins, so a
task that runs again draws alike.
"""

from __future__ import annotations

import heapq
import math
import threading
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlark.functions.domain import SEED
from gridlark.sources.shared import materialize

MAX_BINS = 255
# Rows of a node that are finished in one task, and trees that are counted in one pass.
SMALL = 1 << 17
TREES_A_PASS = 16
# Cells of histograms that a task of such a pass holds at once.
CELLS_A_PASS = 1 << 22
# Stored scores lag behind by at most so many trees, which every pass applies again.
LAG = 8
# Cells of a rows-by-features matrix that may be held at once.
DENSE = 1 << 24


@dataclass(frozen=True)
class Bins:
    """Cuts of each feature. Bin ``k`` of a feature is code ``offset + k`` and holds values up to its cut."""

    offset: np.ndarray
    cuts: np.ndarray

    @property
    def size(self) -> int:
        return int(self.offset[-1])

    @property
    def features(self) -> int:
        return len(self.offset) - 1

    def __post_init__(self) -> None:
        feature = np.repeat(np.arange(self.features), np.diff(self.offset))
        object.__setattr__(self, "feature", feature)
        # A cut is infinite in a feature's last bin, so the bin of zero is the first whose cut isn't below it.
        below = np.concatenate([[0], np.cumsum(self.cuts < 0)])
        object.__setattr__(self, "zero", self.offset[:-1] + below[self.offset[1:]] - below[self.offset[:-1]])
        last = np.zeros(self.size, dtype=bool)
        last[self.offset[1:] - 1] = True
        object.__setattr__(self, "last", last)

    @staticmethod
    def of(cuts: Sequence[np.ndarray]) -> Bins:
        offset = np.cumsum([0, *(len(c) + 1 for c in cuts)])
        flat = [x for c in cuts for x in (*c, math.inf)]
        return Bins(offset.astype(np.int64), np.array(flat, dtype=np.float64))

    def encode(self, starts: np.ndarray, places: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sparse rows (row starts, places, values) as sparse rows of codes beside that of zero."""
        codes = self.offset[places]
        sizes = np.diff(self.offset)[places]
        two = sizes == 2
        codes[two] += values[two] > self.cuts[codes[two]]
        for f in np.unique(places[sizes > 2]):
            at = np.flatnonzero(places == f)
            codes[at] += np.searchsorted(self.cuts[self.offset[f] : self.offset[f + 1] - 1], values[at], side="left")
        keep = codes != self.zero[places]
        passed = np.concatenate([[0], np.cumsum(keep)])
        return passed[starts], codes[keep].astype(np.int32)


def fit_bins(vectors: DataFrame, size: int, most: int = MAX_BINS) -> Bins:
    """Cuts of every place of sparse vectors ``places, values``.

    A place with up to ``most`` values is cut between any two of them, another one at its
    quantiles. What is read back are the cuts: at most ``most`` numbers a place.
    """
    cells = vectors.select(F.inline(F.arrays_zip("places", "values"))).toDF("place", "value").where("value <> 0")
    total = vectors.count()
    ends = cells.groupBy("place").agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")).toArrow()
    place, count, low, high = (c.to_numpy() for c in ends.columns)
    n = dict(zip(place.tolist(), count.tolist()))
    # Most places are indicators: only those of several values are looked at further.
    exact: dict[int, list[float]] = {p: [x] for p, x in zip(place[low == high].tolist(), low[low == high].tolist())}
    cells = _of(cells, place[low != high].tolist())
    shares = [(k + 1) / most for k in range(most - 1)]
    facts = cells.groupBy("place").agg(F.approx_count_distinct("value").alias("values"), F.percentile_approx("value", shares, 20 * most).alias("quantiles"))
    many, few = {}, []
    for row in facts.collect():
        many[row["place"]] = row["quantiles"]
        if row["values"] <= 2 * most:
            few.append(row["place"])
    if few:
        # The places are columns, so their number doesn't grow with the rows.
        for row in _of(cells, few).distinct().toLocalIterator():
            exact.setdefault(row["place"], []).append(row["value"])
    cuts = []
    for place in range(size):
        found = np.array(sorted(set(exact.get(place, []))))
        zero = n.get(place, 0) < total
        if len(found) and len(found) <= most:
            values = np.unique(np.append(found, 0.0)) if zero else found
            cuts.append((values[1:] + values[:-1]) / 2)
        elif place in many:
            values = np.unique([*many[place], *([0.0] if zero else [])])
            cuts.append(values)
        else:
            cuts.append(np.zeros(0))
    return Bins.of(cuts)


def _of(cells: DataFrame, places: list[int]) -> DataFrame:
    """The cells of some places."""
    wanted = cells.sparkSession.createDataFrame([(p,) for p in places], "place int")
    return cells.join(F.broadcast(wanted), "place")


def _sparse(features: str = "features") -> tuple:
    """Places and values of a vector column, dense or sparse."""
    vector = F.unwrap_udt(F.col(features))
    every = F.sequence(F.lit(0), F.size(vector["values"]) - 1)
    return F.when(vector["type"] == 1, every).otherwise(vector["indices"]), vector["values"]


def _lists(column: pa.ListArray, kind) -> tuple[np.ndarray, np.ndarray]:
    """Row starts and flat values of a list column."""
    starts = column.offsets.to_numpy().astype(np.int64)
    return starts - starts[0], column.flatten().to_numpy(zero_copy_only=False).astype(kind)


def _codes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row starts and flat codes of a column that ``bin_rows`` made."""
    _, ends, data = column.cast(pa.binary()).buffers()
    starts = np.frombuffer(ends, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    flat = np.frombuffer(data or b"", np.uint8)[starts[0] : starts[-1]].view(np.int32)
    return (starts - starts[0]) // 4, flat


def bin_rows(rows: DataFrame, bins: Bins) -> DataFrame:
    """``row, label, codes`` of ``features, label``, written once; ``row`` numbers the stored rows.

    Codes are bytes of 32-bit numbers, which every later pass reads without a step per code.
    """
    shared = rows.sparkSession.sparkContext.broadcast(bins)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, places = _lists(batch.column(2), np.int64)
            starts, codes = shared.value.encode(starts, places, _lists(batch.column(3), np.float64)[1])
            ends = pa.py_buffer((4 * starts).astype(np.int32).tobytes())
            codes = pa.Array.from_buffers(pa.binary(), len(batch), [None, ends, pa.py_buffer(codes.astype(np.int32).tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), codes], names=["row", "label", "codes"])

    places, values = _sparse()
    label = F.col("label").cast("double").alias("label")
    sparse = rows.select(F.monotonically_increasing_id().alias("row"), label, places.alias("places"), values.alias("values"))
    return materialize(sparse.mapInArrow(run, "row long, label double, codes binary"))


class Rows:
    """Rows of codes, each padded to the longest one by the code beyond all others."""

    def __init__(self, starts: np.ndarray, codes: np.ndarray, bins: Bins) -> None:
        self.bins = bins
        counts = np.diff(starts)
        self.width = int(counts.max(initial=0))
        self.codes = np.full((len(counts), max(self.width, 1)), bins.size, np.int32)
        self.codes[np.arange(self.codes.shape[1]) < counts[:, None]] = codes
        self.table = None
        # The table's column of each feature, or -1.
        self.column = np.full(bins.features, -1)
        if len(counts) * bins.features <= DENSE:
            self._tabulate(np.arange(bins.features))

    def __len__(self) -> int:
        return len(self.codes)

    def _tabulate(self, features: np.ndarray) -> None:
        bins = self.bins
        self.column[features] = np.arange(len(features))
        self.table = np.broadcast_to(bins.zero[features].astype(np.int32), (len(self), len(features))).copy()
        row, place = np.nonzero(self.codes != bins.size)
        codes = self.codes[row, place]
        column = self.column[bins.feature[codes]]
        there = column >= 0
        self.table[row[there], column[there]] = codes[there]

    def focus(self, *cuts: np.ndarray) -> Rows:
        """The same rows, which answer faster for the features of these cuts (those below zero are none)."""
        if self.table is None:
            cut = np.concatenate(cuts)
            features = np.unique(self.bins.feature[cut[cut >= 0]])
            if len(self) * len(features) <= DENSE:
                self._tabulate(features)
        return self

    def goes_left(self, at: np.ndarray, cut: np.ndarray) -> np.ndarray:
        """Whether each row's code of the cut's feature is up to the cut."""
        feature = self.bins.feature[cut]
        if self.table is not None and (column := self.column[feature]).min(initial=0) >= 0:
            return self.table[at, column] <= cut
        codes = self.codes[at]
        own = (codes >= self.bins.offset[feature][:, None]) & (codes < self.bins.offset[feature + 1][:, None])
        code = np.where(own.any(axis=1), np.where(own, codes, 0).max(axis=1), self.bins.zero[feature])
        return code <= cut

    def reach(self, cut: np.ndarray, left: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
        """The node of a tree that each row ends in."""
        at = np.arange(len(self)) if at is None else at
        node = np.zeros(len(at), np.int64)
        going = np.flatnonzero(cut[node] >= 0)
        while len(going):
            here = cut[node[going]]
            node[going] = left[node[going]] + ~self.goes_left(at[going], here)
            going = going[cut[node[going]] >= 0]
        return node


def uniform(row: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """A number in [0, 1) for each row and tree."""
    x = row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((tree * 0xD1B54A32D192ED03 + seed * 0x2545F4914F6CDD1D) % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / 2**53


_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(18)])


def row_weights(row: np.ndarray, tree: int, seed: int, bootstrap: bool) -> np.ndarray:
    """How often each row is in a tree's sample: Poisson with mean one, or always once."""
    if not bootstrap:
        return np.ones(len(row))
    return np.searchsorted(_POISSON, uniform(row, tree, seed), side="right").astype(np.float64)


# Cells of histograms: rows, weight, weighted target.
def _totals(node: np.ndarray, n: np.ndarray, w: np.ndarray, y: np.ndarray, nodes: int) -> np.ndarray:
    return np.stack([np.bincount(node, n, nodes), np.bincount(node, w, nodes), np.bincount(node, w * y, nodes)], axis=1)


def histogram(rows: Rows, at: np.ndarray, w: np.ndarray, y: np.ndarray) -> np.ndarray:
    """``(codes, 3)`` of the rows ``at``, each ``w`` times; the cells of zero bins are filled from the totals."""
    size = rows.bins.size
    codes = rows.codes[at].ravel()
    width = rows.codes.shape[1]
    s = np.bincount(codes, np.repeat(w[at] * y[at], width), size + 1)[:size]
    plain = (w[at] == 1).all()
    n = (np.bincount(codes, minlength=size + 1) if plain else np.bincount(codes, np.repeat(w[at], width), size + 1))[:size].astype(np.float64)
    return _with_zero_bins(np.stack([n, n, s], axis=1), np.array([w[at].sum(), w[at].sum(), (w[at] * y[at]).sum()]), rows.bins)


def _with_zero_bins(cells: np.ndarray, totals: np.ndarray, bins: Bins) -> np.ndarray:
    cells[bins.zero] = totals - np.add.reduceat(cells, bins.offset[:-1], axis=0)
    return cells


@dataclass(frozen=True)
class Kinds:
    """How many rows each of the kinds has, and their least and greatest label."""

    n: np.ndarray
    low: np.ndarray
    high: np.ndarray


@dataclass(frozen=True)
class Rules:
    """What a split must keep to. ``depth`` None is unlimited; ``ridge`` is added to a node's weight."""

    depth: int | None = None
    split_rows: int = 2
    leaf_rows: int = 1
    leaf_weight: float = 0.0
    ridge: float = 0.0


def _gains(left: np.ndarray, total: np.ndarray, rules: Rules) -> np.ndarray:
    """Second-order gain of each candidate, or minus infinity where a rule forbids it."""
    right = total - left
    good = (np.minimum(left[:, 0], right[:, 0]) >= max(rules.leaf_rows, 1)) & (np.minimum(left[:, 1], right[:, 1]) >= rules.leaf_weight)

    if not rules.ridge:
        # Around the node's mean, where nothing cancels.
        apart = left[:, 2] - total[:, 2] * left[:, 1] / np.maximum(total[:, 1], 1e-300)
        return np.where(good, apart**2 * total[:, 1] / np.maximum(left[:, 1] * right[:, 1], 1e-300), -np.inf)

    def value(x):
        return x[:, 2] ** 2 / np.maximum(x[:, 1] + rules.ridge, 1e-300)

    return np.where(good, value(left) + value(right) - value(total), -np.inf)


def _nearly(best, total: np.ndarray):
    """The gain from which on a split counts as good as the best: sums in another order differ by less."""
    weight = np.maximum(total[..., 1], 1e-300)
    return best - 1e-9 * np.abs(best) - 1e-12 * total[..., 2] ** 2 / weight


def best_split(cells: np.ndarray, bins: Bins, rules: Rules, allowed: np.ndarray | None = None) -> tuple[float, int, np.ndarray, np.ndarray]:
    """Gain, code, and the cells left and right of the best split of one node; ties go to the least code."""
    total = cells[bins.offset[0] : bins.offset[1]].sum(axis=0)
    running = np.cumsum(cells, axis=0)
    before = np.concatenate([np.zeros((1, 3)), running])[bins.offset[:-1]]
    left = running - before[bins.feature]
    gain = _gains(left, np.broadcast_to(total, left.shape), rules)
    gain[bins.last] = -np.inf
    if allowed is not None:
        gain[~allowed[bins.feature]] = -np.inf
    at = int((gain >= _nearly(gain.max(), total)).argmax())
    return float(gain[at]), at, left[at], total - left[at]


@dataclass
class Tree:
    """Nodes as arrays: the code of the cut (or -1), the left child (the right one follows it), the value."""

    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    def importance(self, bins: Bins) -> np.ndarray:
        inner = self.cut >= 0
        total = np.bincount(bins.feature[self.cut[inner]], np.maximum(self.gain[inner], 0), bins.features)
        return total / total.sum() if total.sum() > 0 else total


class _Nodes:
    """A growing tree."""

    def __init__(self) -> None:
        self.cut, self.left, self.value, self.gain = [-1], [0], [0.0], [0.0]

    def split(self, node: int, code: int, gain: float) -> int:
        first = len(self.cut)
        self.cut[node], self.left[node], self.gain[node] = code, first, gain
        for of, empty in ((self.cut, -1), (self.left, 0), (self.value, 0.0), (self.gain, 0.0)):
            of += [empty, empty]
        return first

    def tree(self) -> Tree:
        return Tree(np.array(self.cut, np.int32), np.array(self.left, np.int32), np.array(self.value), np.array(self.gain))


def grow(rows: Rows, w: np.ndarray, y: np.ndarray, rules: Rules, depth: int = 0, kinds: Kinds | None = None) -> Tree:
    """A tree over rows in memory, all nodes of a level at once, until nodes are pure.

    Cells are kept sparse: sorted (node, code) pairs, so deep levels cost what their rows do.
    The pairs are sorted once; a level deals those of each node to its children in their order.
    With ``kinds`` a row stands for several, of which ``y`` is the mean.
    """
    bins = rows.bins
    n, low, high = (kinds.n, kinds.low, kinds.high) if kinds else (np.ones(len(rows)), y, y)
    at, node = np.arange(len(rows)), np.zeros(len(rows), np.int64)
    real = rows.codes != bins.size
    code = rows.codes[real]
    order = np.argsort(code, kind="stable")
    row, code = np.repeat(np.arange(len(rows), dtype=np.int32), real.sum(axis=1))[order], code[order]
    # By row: its node in this level, or -1.
    node_of = np.empty(len(rows), np.int32)
    count, cuts, lefts, values, gains = 1, [], [], [], []
    made = 1
    while True:
        totals = _totals(node, n[at], w[at], y[at], count)
        mean = totals[:, 2] / np.maximum(totals[:, 1], 1e-300)
        order = np.argsort(node, kind="stable")
        start = np.flatnonzero(np.diff(node[order], prepend=-1))
        impure = np.maximum.reduceat(high[at][order], start) > np.minimum.reduceat(low[at][order], start)
        cut = np.full(count, -1, np.int64)
        gain = np.zeros(count)
        tried = impure & (totals[:, 0] >= max(rules.split_rows, 2)) & (rules.depth is None or depth < rules.depth)
        keep = tried[node]
        at, node = at[keep], node[keep]
        if len(at):
            # Each node's targets around their mean, where sums lose nothing.
            target = np.zeros(len(rows))
            target[at] = w[at] * (y[at] - mean[node])
            totals[:, 2] = np.bincount(node, target[at], count)
            node_of.fill(-1)
            node_of[at] = node
            row, code, pairs = _dealt(row, code, node_of)
            found, best, value = _level_splits(row, code, pairs, n if kinds else None, w, target, totals, bins, rules)
            cut[found], gain[found] = best, value
        left = np.zeros(count, np.int64)
        inner = cut >= 0
        left[inner] = made + 2 * np.arange(inner.sum())
        cuts.append(cut), lefts.append(left), values.append(mean), gains.append(gain)
        if not inner.any():
            break
        keep = inner[node]
        at, node = at[keep], node[keep]
        node = left[node] - made + ~rows.goes_left(at, cut[node])
        count = 2 * int(inner.sum())
        made += count
        depth += 1
    return Tree(*(np.concatenate(x) for x in (cuts, lefts, values, gains)))


def _dealt(row: np.ndarray, code: np.ndarray, node_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs by (node, code) from those by (parent, code), and the pairs of each node.

    Nodes ``2k`` and ``2k + 1`` are one parent's; pairs of rows without a node go.
    """
    node = node_of[row]
    odd = (node & 1).astype(bool)
    first, second = np.flatnonzero(~odd), np.flatnonzero(odd & (node > 0))
    parents = int(node.max(initial=-1)) // 2 + 1
    firsts, seconds = (np.bincount(node[x] >> 1, minlength=parents) for x in (first, second))
    order = np.empty(len(first) + len(second), np.int64)
    order[np.arange(len(first)) + np.repeat(np.cumsum(seconds) - seconds, firsts)] = first
    order[np.arange(len(second)) + np.repeat(np.cumsum(firsts), seconds)] = second
    return row[order], code[order], np.stack([firsts, seconds], axis=1).ravel()


def _level_splits(row, code, pairs, n, w, target, totals, bins, rules) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes that can be split, and the code and gain of their best splits; each has so many ``pairs``, by code.

    ``n``, ``w`` and ``target`` go by row; ``n`` None is one each.
    """
    if not len(row):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    size = bins.size + 1
    key = np.repeat(np.arange(len(pairs)) * size, pairs) + code
    first = np.flatnonzero(np.diff(key, prepend=-1))
    key = key[first]
    sums = [np.diff(first, append=len(row)).astype(np.float64) if n is None else np.add.reduceat(n[row], first)]
    cells = np.stack([*sums, *(np.add.reduceat(x[row], first) for x in (w, target))])
    totals = np.ascontiguousarray(totals.T)
    # The zero bin of every feature that a node has other bins of.
    of = key // size
    group = of * bins.features + bins.feature[key - of * size]
    first = np.flatnonzero(np.diff(group, prepend=-1))
    zero = totals[:, of[first]] - np.add.reduceat(cells, first, axis=1)
    there = zero[0] > 0.5
    where = of[first[there]]
    extra = where * size + bins.zero[group[first[there]] - where * bins.features]
    # Both are sorted, and no code is in both.
    before = np.searchsorted(key, extra)
    at = before + np.arange(len(extra))
    own = np.ones(len(key) + len(extra), dtype=bool)
    own[at] = False
    merged = np.empty((3, len(own)))
    merged[:, own], merged[:, at] = cells, zero[:, there]
    full = np.empty(len(own), np.int64)
    full[own], full[at] = key, extra
    key, cells = full, merged
    of = key // size
    group = of * bins.features + bins.feature[key - of * size]
    start = np.flatnonzero(np.diff(group, prepend=-1))
    running = np.cumsum(cells, axis=1)
    base = np.where(start > 0, running[:, start - 1], 0.0)
    left = running - np.repeat(base, np.diff(start, append=len(key)), axis=1)
    gain = _gains(left.T, totals[:, of].T, rules)
    gain[np.append(start[1:], len(key)) - 1] = -np.inf
    start = np.flatnonzero(np.diff(of, prepend=-1))
    best = _nearly(np.maximum.reduceat(gain, start), totals[:, of[start]].T)
    sizes = np.diff(start, append=len(key))
    hits = np.flatnonzero((gain >= np.repeat(best, sizes)) & np.isfinite(gain))
    found, one = np.unique(of[hits], return_index=True)
    return found, key[hits[one]] % size, gain[hits[one]]


class _Local:
    """Histograms over rows in memory, each ``n`` times; one asked for at a time."""

    def __init__(self, rows: Rows, target: np.ndarray, sampled: np.ndarray, n: np.ndarray | None = None) -> None:
        self.rows, self.y, self.w = rows, target, np.ones(len(target)) if n is None else n
        self.at = {0: sampled}

    def root(self) -> np.ndarray:
        return histogram(self.rows, self.at[0], self.w, self.y)

    def smaller(self, wanted: list[tuple[int, int, int, bool]], nodes: _Nodes) -> dict[int, np.ndarray]:
        """Histogram of the smaller child of the first leaf ``(node, first child, code, left is smaller)``."""
        node, first, code, is_left = wanted[0]
        at = self.at.pop(node)
        left = self.rows.goes_left(at, np.full(len(at), code))
        self.at[first], self.at[first + 1] = at[left], at[~left]
        return {node: histogram(self.rows, self.at[first + (not is_left)], self.w, self.y)}


def boost_tree(counts, bins: Bins, rules: Rules, leaves: int | None, rate: float, allowed: np.ndarray | None) -> Tree:
    """One tree of second-order boosting, over whatever ``counts`` gives histograms of.

    With a number of leaves the leaf of the largest gain is split next, as long as a gain is
    positive; without, all leaves are, level by level. A leaf's value is its weighted target
    over its weight and the ridge, times the rate.
    """
    nodes = _Nodes()
    cells = counts.root()
    queue: list[tuple] = []
    ready: dict[int, np.ndarray] = {}

    def open_leaf(node: int, cells: np.ndarray, depth: int) -> None:
        total = cells[bins.offset[0] : bins.offset[1]].sum(axis=0)
        nodes.value[node] = rate * total[2] / max(total[1] + rules.ridge, 1e-300)
        if total[0] < max(rules.split_rows, 2) or (rules.depth is not None and depth >= rules.depth):
            return
        gain, code, left, right = best_split(cells, bins, rules, allowed)
        if gain > 1e-9 * max(1.0, abs(total[2])):
            heapq.heappush(queue, (-gain if leaves else depth, node, gain, code, bool(left[0] <= right[0]), cells, depth))

    open_leaf(0, cells, 0)
    used = 1
    while queue and (leaves is None or used < leaves):
        _, node, gain, code, is_left, cells, depth = heapq.heappop(queue)
        first = nodes.split(node, code, gain)
        if node not in ready:
            # Ask for the other open leaves too: a distributed pass counts them all at once.
            others = [(q[1], -1, q[3], q[4]) for q in queue if q[1] not in ready]
            ready.update(counts.smaller([(node, first, code, is_left), *others], nodes))
        less = ready.pop(node)
        more = cells - less
        open_leaf(first, less if is_left else more, depth + 1)
        open_leaf(first + 1, more if is_left else less, depth + 1)
        used += 1
    return nodes.tree()


@dataclass(frozen=True)
class Boost:
    """Settings of a boosting run."""

    rounds: int = 100
    rate: float = 0.3
    leaves: int | None = None
    rules: Rules = Rules(6, 2, 1, 1.0, 1.0)
    rows: float = 1.0
    columns: float = 1.0
    seed: int = SEED

    def sampled(self, row: np.ndarray, tree: int) -> np.ndarray:
        return uniform(row, tree, self.seed) < self.rows if self.rows < 1 else np.ones(len(row), dtype=bool)

    def allowed(self, tree: int, features: int) -> np.ndarray | None:
        if self.columns >= 1:
            return None
        draw = uniform(np.arange(features), -1 - tree, self.seed)
        out = np.zeros(features, dtype=bool)
        out[np.argsort(draw, kind="stable")[: max(1, math.ceil(self.columns * features))]] = True
        return out


def boost(rows: Rows, row: np.ndarray, y: np.ndarray, base: float, how: Boost, kinds: Kinds | None = None) -> list[Tree]:
    """All trees over rows in memory. With ``kinds`` a row stands for several, of which ``y`` is the mean."""
    score, trees = np.full(len(y), base), []
    for tree in range(how.rounds):
        sampled = np.flatnonzero(how.sampled(row, tree))
        counts = _Local(rows, y - score, sampled, kinds.n if kinds else None)
        grown = boost_tree(counts, rows.bins, how.rules, how.leaves, how.rate, how.allowed(tree, rows.bins.features))
        trees.append(grown)
        if len(sampled) == len(y):
            for node, at in counts.at.items():
                score[at] += grown.value[node]
        else:
            score += grown.value[rows.reach(grown.cut, grown.left)]
    return trees


# Distributed counting


def _batch_rows(batch: pa.RecordBatch, column: int, bins: Bins) -> Rows:
    return Rows(*_codes(batch.column(column)), bins)


def _summed(table: DataFrame, count, bins: Bins, slots: int) -> np.ndarray:
    """``(slots, codes, 3)``: cells that ``count(batch, cells)`` adds up in every task, summed by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros((3, slots, bins.size + 1))
        for batch in batches:
            count(batch, cells)
        slot, code = np.nonzero(cells[0])
        if len(slot):
            columns = [pa.array(slot, pa.int32()), pa.array(code, pa.int32()), *(pa.array(cells[k, slot, code]) for k in range(3))]
            yield pa.RecordBatch.from_arrays(columns, names=["slot", "code", "n", "w", "s"])

    found = table.mapInArrow(run, "slot int, code int, n double, w double, s double")
    found = found.groupBy("slot", "code").agg(F.sum("n").alias("n"), F.sum("w").alias("w"), F.sum("s").alias("s")).toArrow()
    out = np.zeros((slots, bins.size + 1, 3))
    slot, code, *values = (c.to_numpy() for c in found.columns)
    if len(slot):
        out[slot, code] = np.stack(values, axis=1)
    for k in range(slots):
        _with_zero_bins(out[k, : bins.size], out[k, bins.size], bins)
    return out[:, : bins.size]


def _add(cells: np.ndarray, slot: np.ndarray, rows: Rows, at: np.ndarray, w: np.ndarray, y: np.ndarray) -> None:
    """Add the rows ``at`` to the cells ``(3, slots, codes)`` of their slots; totals go as one more code."""
    size = rows.bins.size
    first = slot.astype(np.int64) * (size + 1)
    codes = rows.codes[at]
    real = codes != size
    key = (first[:, None] + codes)[real]
    held = real.sum(axis=1)
    plain = (w[at] == 1).all()
    for k, x in enumerate((None, None if plain else w[at], w[at] * y[at])):
        flat = cells[k].reshape(-1)
        if len(flat) <= 4 * len(key):
            flat += np.bincount(key, None if x is None else np.repeat(x, held), len(flat))
        else:
            np.add.at(flat, key, 1.0 if x is None else np.repeat(x, held))
        np.add.at(flat, first + size, 1.0 if x is None else x)


class _Spread:
    """Histograms of one boosting tree over a stored table ``row, label, codes, score``."""

    def __init__(self, table: DataFrame, bins, how: Boost, tree: int, late: list[Tree]) -> None:
        self.table, self.bins, self.how, self.tree = table, bins, how, tree
        self.late = late

    def _counted(self, cut: np.ndarray, left: np.ndarray, wanted: dict[int, tuple[int, int, bool]]) -> np.ndarray:
        """Slots of rows that reach a wanted node and lie on the wanted side of its code."""
        shared = self.table.sparkSession.sparkContext.broadcast((self.bins, self.late, self.how, cut, left, wanted))
        tree = self.tree

        def count(batch, cells):
            bins, late, how, cut, left, wanted = shared.value
            rows = _batch_rows(batch, 2, bins).focus(*(t.cut for t in late), cut, np.array([code for _, code, _ in wanted.values()]))
            score = batch.column(3).to_numpy().copy()
            for t in late:
                score += t.value[rows.reach(t.cut, t.left)]
            y, w = batch.column(1).to_numpy() - score, np.ones(len(rows))
            at = np.flatnonzero(how.sampled(batch.column(0).to_numpy(), tree))
            node = rows.reach(cut, left, at)
            # By node: its slot, the code that parts it, and the side that is counted.
            slots, codes, sides = np.full(len(cut), -1), np.full(len(cut), -1), np.ones(len(cut), dtype=bool)
            for leaf, found in wanted.items():
                slots[leaf], codes[leaf], sides[leaf] = found
            keep = slots[node] >= 0
            at, node = at[keep], node[keep]
            parted = np.flatnonzero(codes[node] >= 0)
            keep = np.ones(len(at), dtype=bool)
            keep[parted] = rows.goes_left(at[parted], codes[node[parted]]) == sides[node[parted]]
            _add(cells, slots[node[keep]], rows, at[keep], w, y)

        found = _summed(self.table.select("row", "label", "codes", "score"), count, self.bins, len(wanted))
        shared.destroy()
        return found

    def root(self) -> np.ndarray:
        return self._counted(np.array([-1]), np.array([0]), {0: (0, -1, True)})[0]

    def smaller(self, wanted: list[tuple[int, int, int, bool]], nodes: _Nodes) -> dict[int, np.ndarray]:
        cut, left = np.array(nodes.cut), np.array(nodes.left)
        # The first leaf is split already; it is routed to as a leaf again.
        cut[wanted[0][0]] = -1
        slots = {node: (k, code, is_left) for k, (node, _, code, is_left) in enumerate(wanted)}
        cells = self._counted(cut, left, slots)
        return {node: cells[k] for node, (k, _, _) in slots.items()}


def _boost_spread(table: DataFrame, bins: Bins, base: float, how: Boost) -> list[Tree]:
    trees: list[Tree] = []
    late: list[Tree] = []
    table = table.withColumn("score", F.lit(base))
    for tree in range(how.rounds):
        counts = _Spread(table, bins, how, tree, list(late))
        late.append(boost_tree(counts, bins, how.rules, how.leaves, how.rate, how.allowed(tree, bins.features)))
        trees.append(late[-1])
        if len(late) == LAG and tree + 1 < how.rounds:
            table, late = materialize(_scored(table, bins, late)), []
    return trees


def _scored(table: DataFrame, bins: Bins, late: list[Tree]) -> DataFrame:
    shared = table.sparkSession.sparkContext.broadcast((bins, late))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, late = shared.value
        for batch in batches:
            rows = _batch_rows(batch, 2, bins).focus(*(t.cut for t in late))
            score = batch.column(3).to_numpy().copy()
            for t in late:
                score += t.value[rows.reach(t.cut, t.left)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(score)], names=["row", "label", "codes", "score"])

    return table.select("row", "label", "codes", "score").mapInArrow(run, "row long, label double, codes binary, score double")


@dataclass(frozen=True)
class Bag:
    """Settings of one forest."""

    trees: int = 100
    bootstrap: bool = True
    rules: Rules = Rules()
    seed: int = SEED


def _tops(table: DataFrame, bins: Bins, bags: list[Bag], members: list[tuple[int, int]], total: int, small: int) -> tuple[list[Tree], list[set[int]]]:
    """The top of each tree ``(forest, number)``, split by histograms while a node has more than ``small`` rows.

    Beside it the leaves that are final: no split is left or allowed, and the value is known.
    """
    tops = [_Nodes() for _ in members]
    final: list[set[int]] = [set() for _ in members]
    if total <= small:
        return [t.tree() for t in tops], final
    context = table.sparkSession.sparkContext
    waiting = [(m, 0, 0) for m in range(len(members))]
    while waiting:
        # The trees of a pass, and the nodes that its cells have room for.
        some = sorted({m for m, _, _ in waiting})[:TREES_A_PASS]
        asked = [x for x in waiting if x[0] in some][: max(1, CELLS_A_PASS // (bins.size + 1))]
        waiting = [x for x in waiting if x not in set(asked)]
        slots = {(m, node): k for k, (m, node, _) in enumerate(asked)}
        trees = {m: tops[m].tree() for m in sorted({m for m, _, _ in asked})}
        shared = context.broadcast((bins, bags, members, trees, slots))

        def count(batch, cells, shared=shared):
            bins, bags, members, trees, slots = shared.value
            rows, row, y = _batch_rows(batch, 2, bins).focus(*(t.cut for t in trees.values())), batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for m, tree in trees.items():
                bag = bags[members[m][0]]
                w = row_weights(row, members[m][1], bag.seed, bag.bootstrap)
                at = np.flatnonzero(w)
                node = rows.reach(tree.cut, tree.left, at)
                slot = np.full(len(tree.cut), -1)
                for (of, leaf), k in slots.items():
                    if of == m:
                        slot[leaf] = k
                keep = slot[node] >= 0
                _add(cells, slot[node[keep]], rows, at[keep], w, y)

        found = _summed(table.select("row", "label", "codes"), count, bins, len(slots))
        shared.destroy()
        for m, node, depth in asked:
            rules, top = bags[members[m][0]].rules, tops[m]
            gain, code, left, right = best_split(found[slots[m, node]], bins, rules)
            total = left + right
            top.value[node] = total[2] / max(total[1], 1e-300)
            # Equal labels leave only what rounding does.
            if (rules.depth is not None and depth >= rules.depth) or not gain > 1e-24 * total[2] ** 2 / max(total[1], 1e-300):
                final[m].add(node)
                continue
            first = top.split(node, code, gain)
            for child, side in ((first, left), (first + 1, right)):
                top.value[child] = side[2] / max(side[1], 1e-300)
                if side[0] < max(rules.split_rows, 2) or (rules.depth is not None and depth + 1 >= rules.depth):
                    final[m].add(child)
                elif side[0] > small:
                    waiting.append((m, child, depth + 1))
    return [t.tree() for t in tops], final


def _depths(tree: Tree) -> np.ndarray:
    out = np.zeros(len(tree.cut), np.int64)
    for node in np.flatnonzero(tree.cut >= 0):
        out[tree.left[node] : tree.left[node] + 2] = out[node] + 1
    return out


def grow_forests(table: DataFrame, bins: Bins, bags: list[Bag], small: int = SMALL) -> list[list[Tree]]:
    """The trees of every forest, from one stored table of binned rows and one grouped pass.

    Rows of a node that isn't small go on through histograms; every other node's rows meet
    in one task, as blocks of arrays, and its subtree is finished there. Rows of leaves whose
    value the histograms have given aren't sent.
    """
    members = [(f, t) for f, bag in enumerate(bags) for t in range(bag.trees)]
    tops, final = _tops(table, bins, bags, members, table.count(), small)
    if all(len(f) == np.sum(t.cut < 0) for t, f in zip(tops, final)):
        trees = iter(tops)
        return [[next(trees) for _ in range(bag.trees)] for bag in bags]
    context = table.sparkSession.sparkContext
    shared = context.broadcast((bins, bags, members, tops, final))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, bags, members, tops, final = shared.value
        for batch in batches:
            rows, row, y = _batch_rows(batch, 2, bins).focus(*(t.cut for t in tops)), batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for m, (forest, number) in enumerate(members):
                w = row_weights(row, number, bags[forest].seed, bags[forest].bootstrap)
                at = np.flatnonzero(w)
                node = rows.reach(tops[m].cut, tops[m].left, at)
                out: dict[str, list] = {k: [] for k in ("member", "node", "width", "codes", "rows", "labels", "weights")}
                for leaf in np.unique(node).tolist():
                    if leaf in final[m]:
                        continue
                    mine = at[node == leaf]
                    values = (m, leaf, rows.codes.shape[1], rows.codes[mine].tobytes(), row[mine].tobytes(), y[mine].tobytes(), w[mine].astype(np.uint8).tobytes())
                    for k, v in zip(out, values):
                        out[k].append(v)
                yield pa.RecordBatch.from_pydict(out, schema=sent)

    sent = pa.schema([("member", pa.int32()), ("node", pa.int32()), ("width", pa.int32()), ("codes", pa.binary()), ("rows", pa.binary()), ("labels", pa.binary()), ("weights", pa.binary())])

    def finish(group: pa.Table) -> pa.Table:
        bins, bags, members, tops, _ = shared.value
        m, node = group.column("member")[0].as_py(), group.column("node")[0].as_py()
        widths = group.column("width").to_pylist()
        parts = [np.frombuffer(c, np.int32).reshape(-1, k) for c, k in zip(group.column("codes").to_pylist(), widths)]
        flat = np.concatenate([np.pad(p, ((0, 0), (0, max(widths) - p.shape[1])), constant_values=bins.size) for p in parts])
        row, y, w = (
            np.concatenate([np.frombuffer(x, t) for x in group.column(c).to_pylist()]) for c, t in (("rows", np.int64), ("labels", np.float64), ("weights", np.uint8))
        )
        # Blocks come in any order; sorted, so that sums don't depend on it.
        order = np.argsort(row)
        flat, y, w = flat[order], y[order], w[order]
        real = flat != bins.size
        rows = Rows(np.concatenate([[0], np.cumsum(real.sum(axis=1))]), flat[real], bins)
        tree = grow(rows, w.astype(np.float64), y, bags[members[m][0]].rules, int(_depths(tops[m])[node]))
        made = {"member": [m], "node": [node], "cut": [tree.cut.astype(np.int32).tobytes()], "left": [tree.left.astype(np.int32).tobytes()],
                "value": [tree.value.tobytes()], "gain": [tree.gain.tobytes()]}
        return pa.Table.from_pydict(made, schema=grown)

    grown = pa.schema([("member", pa.int32()), ("node", pa.int32()), ("cut", pa.binary()), ("left", pa.binary()), ("value", pa.binary()), ("gain", pa.binary())])
    sent_rows = table.select("row", "label", "codes").mapInArrow(blocks, "member int, node int, width int, codes binary, rows binary, labels binary, weights binary")
    subtrees = sent_rows.groupBy("member", "node").applyInArrow(finish, "member int, node int, cut binary, left binary, value binary, gain binary")
    found: dict[int, dict[int, Tree]] = {}
    for r in materialize(subtrees).toLocalIterator():
        tree = Tree(*(np.frombuffer(r[k], t) for k, t in (("cut", np.int32), ("left", np.int32), ("value", np.float64), ("gain", np.float64))))
        found.setdefault(r["member"], {})[r["node"]] = tree
    shared.destroy()
    out: list[list[Tree]] = [[] for _ in bags]
    for m, (forest, _) in enumerate(members):
        out[forest].append(_joined(tops[m], found.get(m, {})))
    return out


def _joined(top: Tree, subtrees: dict[int, Tree]) -> Tree:
    """A tree's top with its subtrees in place of the leaves they grew from."""
    if len(top.cut) == 1:
        return subtrees.get(0, top)
    cut, left, value, gain = ([x] for x in (top.cut.copy(), top.left.copy(), top.value.copy(), top.gain.copy()))
    size = len(top.cut)
    for node, sub in subtrees.items():
        # A subtree's root takes the leaf's place; its other nodes go to the end.
        shift = size - 1
        cut[0][node], value[0][node], gain[0][node] = sub.cut[0], sub.value[0], sub.gain[0]
        left[0][node] = sub.left[0] + shift
        cut.append(sub.cut[1:]), left.append(sub.left[1:] + shift), value.append(sub.value[1:]), gain.append(sub.gain[1:])
        size += len(sub.cut) - 1
    return Tree(*(np.concatenate(x) for x in (cut, left, value, gain)))


def boost_all(table: DataFrame, bins: Bins, runs: list[Boost], small: int = SMALL) -> list[tuple[float, list[Tree]]]:
    """Base score and trees of every boosting run; runs over few rows are one grouped pass, a run a task."""
    facts = table.agg(F.count("*").alias("n"), F.avg("label").alias("mean")).first()
    base = float(facts["mean"] or 0.0)
    if facts["n"] > small:
        return [(base, _boost_spread(table, bins, base, how)) for how in runs]
    shared = table.sparkSession.sparkContext.broadcast((bins, runs))
    every = F.explode(F.sequence(F.lit(0), F.lit(len(runs) - 1))).alias("run")

    def finish(group: pa.Table) -> pa.Table:
        bins, runs = shared.value
        k = group.column("run")[0].as_py()
        group = group.sort_by("row").combine_chunks()
        rows = Rows(*_codes(group.column("codes").combine_chunks()), bins)
        trees = boost(rows, group.column("row").to_numpy(), group.column("label").to_numpy(), base, runs[k])
        made = {"run": [k] * len(trees), "tree": range(len(trees)), "cut": [t.cut.tobytes() for t in trees], "left": [t.left.tobytes() for t in trees],
                "value": [t.value.tobytes() for t in trees], "gain": [t.gain.tobytes() for t in trees]}
        return pa.Table.from_pydict(made, schema=grown)

    grown = pa.schema([("run", pa.int32()), ("tree", pa.int32()), ("cut", pa.binary()), ("left", pa.binary()), ("value", pa.binary()), ("gain", pa.binary())])
    spread = table.select("row", "label", "codes", every).groupBy("run")
    found = spread.applyInArrow(finish, "run int, tree int, cut binary, left binary, value binary, gain binary").orderBy("run", "tree").collect()
    shared.destroy()
    out: list[tuple[float, list[Tree]]] = [(base, []) for _ in runs]
    for r in found:
        out[r["run"]][1].append(Tree(*(np.frombuffer(r[k], t) for k, t in (("cut", np.int32), ("left", np.int32), ("value", np.float64), ("gain", np.float64)))))
    return out


def merge_equal(table: DataFrame, small: int) -> DataFrame | None:
    """Rows of equal codes as one: ``row, label, codes, n, low, high`` with the mean label.

    None where that leaves more than a task should hold, or where all rows fit one anyway.
    """
    facts = table.agg(F.count("*").alias("n"), F.approx_count_distinct(F.xxhash64("codes"), 0.02).alias("kinds")).first()
    if facts["n"] <= small or facts["kinds"] > small // 2:
        return None
    kinds = table.groupBy("codes").agg(
        F.min("row").alias("row"), F.avg("label").alias("label"), F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high")
    )
    return materialize(kinds.select("row", "label", "codes", "n", "low", "high"))


def grow_merged(kinds: DataFrame, bins: Bins, settings: list[Bag | Boost], base: float = 0.0) -> list[list[Tree]]:
    """Trees of forests without draws, or of boosting runs that take all rows, over merged rows; one a task."""
    shared = kinds.sparkSession.sparkContext.broadcast((bins, settings, base))
    every = F.explode(F.sequence(F.lit(0), F.lit(len(settings) - 1))).alias("run")
    schema = pa.schema([("run", pa.int32()), ("tree", pa.int32()), ("cut", pa.binary()), ("left", pa.binary()), ("value", pa.binary()), ("gain", pa.binary())])

    def finish(group: pa.Table) -> pa.Table:
        bins, settings, base = shared.value
        k = group.column("run")[0].as_py()
        group = group.sort_by("row").combine_chunks()
        rows = Rows(*_codes(group.column("codes").combine_chunks()), bins)
        row, y, n, low, high = (group.column(c).to_numpy() for c in ("row", "label", "n", "low", "high"))
        merged = Kinds(n.astype(np.float64), low, high)
        how = settings[k]
        if isinstance(how, Bag):
            trees = [grow(rows, merged.n, y, how.rules, kinds=merged)]
        else:
            trees = boost(rows, row, y, base, how, merged)
        made = {"run": [k] * len(trees), "tree": range(len(trees)), "cut": [t.cut.astype(np.int32).tobytes() for t in trees],
                "left": [t.left.astype(np.int32).tobytes() for t in trees], "value": [t.value.tobytes() for t in trees], "gain": [t.gain.tobytes() for t in trees]}
        return pa.Table.from_pydict(made, schema=schema)

    spread = kinds.select("*", every).groupBy("run")
    found = spread.applyInArrow(finish, "run int, tree int, cut binary, left binary, value binary, gain binary").orderBy("run", "tree").collect()
    shared.destroy()
    out: list[list[Tree]] = [[] for _ in settings]
    for r in found:
        out[r["run"]].append(Tree(*(np.frombuffer(r[k], t) for k, t in (("cut", np.int32), ("left", np.int32), ("value", np.float64), ("gain", np.float64)))))
    # Without draws all trees of a forest are equal.
    return [trees * how.trees if isinstance(how, Bag) else trees for trees, how in zip(out, settings)]


class TreeModel(Model, MLWritable, MLReadable):
    """A fitted ensemble: ``base`` plus ``share`` times the sum of its trees' values."""

    featuresCol = Param(Params._dummy(), "featuresCol", "vector column", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "column that is added", TypeConverters.toString)

    def __init__(self, bins: Bins | None = None, trees: list[Tree] | None = None, base: float = 0.0, share: float = 1.0) -> None:
        super().__init__()
        self._setDefault(featuresCol="features", predictionCol="prediction")
        self.bins, self.trees, self.base, self.share = bins, trees or [], base, share

    @property
    def featureImportances(self) -> DenseVector:
        """Shares of the gain, averaged over the trees that split at all."""
        shares = [t.importance(self.bins) for t in self.trees]
        total = np.sum(shares, axis=0) if shares else np.zeros(self.bins.features)
        return DenseVector(total / total.sum() if total.sum() > 0 else total)

    @property
    def depth(self) -> int:
        return max((int(_depths(t).max()) for t in self.trees), default=0)

    def predict(self, rows: Rows) -> np.ndarray:
        out = np.zeros(len(rows))
        for tree in self.trees:
            out += tree.value[rows.reach(tree.cut, tree.left)]
        return self.base + self.share * out

    def _transform(self, df: DataFrame) -> DataFrame:
        light = TreeModel(self.bins, [Tree(t.cut, t.left, t.value, np.zeros(0)) for t in self.trees], self.base, self.share)
        cuts = [np.unique(t.cut) for t in light.trees]
        used = np.unique(np.concatenate(cuts)) if cuts else np.zeros(0, np.int32)
        shared = df.sparkSession.sparkContext.broadcast((light.bins, light.trees, light.base, light.share, used))

        @F.arrow_udf("double")
        def predicted(places: pa.Array, values: pa.Array) -> pa.Array:
            bins, trees, base, share, used = shared.value
            starts, codes = bins.encode(*_lists(places, np.int64), _lists(values, np.float64)[1])
            step = max(1, DENSE // max(len(np.unique(bins.feature[used[used >= 0]])), 1))
            out = np.zeros(len(places))
            for lo in range(0, len(places), step):
                hi = min(lo + step, len(places))
                rows = Rows(starts[lo : hi + 1] - starts[lo], codes[starts[lo] : starts[hi]], bins).focus(used)
                for tree in trees:
                    out[lo:hi] += tree.value[rows.reach(tree.cut, tree.left)]
            return pa.array(base + share * out)

        return df.withColumn(self.getOrDefault(self.predictionCol), predicted(*_sparse(self.getOrDefault(self.featuresCol))))

    def write(self) -> MLWriter:
        return _TreeWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TreeReader()


_STORED = "tree int, cut binary, left binary, value binary, gain binary"


class _TreeWriter(MLWriter):
    def __init__(self, model: TreeModel) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        model, spark = self.model, self.sparkSession
        DefaultParamsWriter.saveMetadata(model, path, spark, extraMetadata={"base": model.base, "share": model.share})
        rows = [(i, t.cut.astype("<i4").tobytes(), t.left.astype("<i4").tobytes(), t.value.astype("<f8").tobytes(), t.gain.astype("<f8").tobytes()) for i, t in enumerate(model.trees)]
        rows.append((-1, model.bins.offset.astype("<i8").tobytes(), b"", model.bins.cuts.astype("<f8").tobytes(), b""))
        spark.createDataFrame(rows, _STORED).write.mode("overwrite").parquet(f"{path}/trees")


class _TreeReader(MLReader):
    def load(self, path: str) -> TreeModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        rows = {r["tree"]: r for r in self.sparkSession.read.schema(_STORED).parquet(f"{path}/trees").collect()}
        head = rows.pop(-1)
        bins = Bins(np.frombuffer(head["cut"], "<i8"), np.frombuffer(head["value"], "<f8"))
        trees = [Tree(*(np.frombuffer(r[k], t) for k, t in (("cut", "<i4"), ("left", "<i4"), ("value", "<f8"), ("gain", "<f8")))) for _, r in sorted(rows.items())]
        model = TreeModel(bins, trees, metadata["base"], metadata["share"])
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


def _number(name: str, doc: str, kind=TypeConverters.toInt) -> Param:
    return Param(Params._dummy(), name, doc, kind)


class Binned:
    """Rows ``features, label`` for several fits: bins, binned rows and merged rows, each made once when asked for."""

    def __init__(self, dataset: DataFrame) -> None:
        self.dataset = dataset
        self.tables: dict[int, tuple[Bins, DataFrame]] = {}
        self.kinds: dict[tuple[int, int], DataFrame | None] = {}

    def rows(self, most: int) -> tuple[Bins, DataFrame]:
        if most not in self.tables:
            places, values = _sparse()
            vectors = self.dataset.select(places.alias("places"), values.alias("values"))
            head = self.dataset.select(F.unwrap_udt("features").alias("v")).select(F.coalesce(F.col("v.size"), F.size("v.values")).alias("n")).first()
            bins = fit_bins(vectors, head["n"] if head else 1, most)
            self.tables[most] = bins, bin_rows(self.dataset.where("label IS NOT NULL"), bins)
        return self.tables[most]

    def merged(self, most: int, small: int) -> DataFrame | None:
        """See ``merge_equal``."""
        if (most, small) not in self.kinds:
            self.kinds[most, small] = merge_equal(self.rows(most)[1], small)
        return self.kinds[most, small]


class TreeEstimator(Estimator):
    """What forests and boosting share: bins and binned rows, once for all points of a search."""

    maxBins = _number("maxBins", "most bins of a feature")
    minSamplesSplit = _number("minSamplesSplit", "least rows of a node that is split")
    minSamplesLeaf = _number("minSamplesLeaf", "least rows of a leaf")
    maxDepth = _number("maxDepth", "greatest depth; negative is unlimited")
    seed = _number("seed", "seed of the draws")
    small = _number("small", "rows that are finished in one task")

    def _depth(self) -> int | None:
        depth = self.getOrDefault(self.maxDepth)
        return None if depth < 0 else depth

    def _models(self, ready: Binned, most: int, settings: list, small: int) -> list[TreeModel]:
        raise NotImplementedError

    def fit_points(self, ready: Binned, points: list[TreeEstimator]) -> list[TreeModel]:
        """Models of all points over rows that are binned once for each number of bins."""
        by_bins: dict[int, list[int]] = {}
        for k, point in enumerate(points):
            by_bins.setdefault(point.getOrDefault(point.maxBins), []).append(k)
        out: list[TreeModel | None] = [None] * len(points)
        for most, own in by_bins.items():
            for k, model in zip(own, self._models(ready, most, [points[k].settings() for k in own], self.getOrDefault(self.small))):
                out[k] = model
        return out

    def _fit_points(self, dataset: DataFrame, points: list[TreeEstimator]) -> list[TreeModel]:
        return self.fit_points(Binned(dataset), points)

    def _fit(self, dataset: DataFrame) -> TreeModel:
        return self._fit_points(dataset, [self])[0]

    def fitMultiple(self, dataset: DataFrame, paramMaps: Sequence[dict]) -> Iterator[tuple[int, TreeModel]]:
        """All points at once: rows are binned once, and trees of all points grow side by side."""
        return _Shared(lambda: self._fit_points(dataset, [self.copy(p) for p in paramMaps]), len(paramMaps))


class _Shared:
    """Models by number, fitted together when the first one is asked for; threads share it."""

    def __init__(self, fit, size: int) -> None:
        self.fit, self.size, self.at, self.models = fit, size, 0, None
        self.lock = threading.Lock()

    def __iter__(self):
        return self

    def __next__(self) -> tuple[int, TreeModel]:
        with self.lock:
            if self.at >= self.size:
                raise StopIteration
            if self.models is None:
                self.models = self.fit()
            self.at += 1
            return self.at - 1, self.models[self.at - 1]


class Forest(TreeEstimator):
    """Bagged regression trees that consider every feature; one tree without bootstrap is a plain tree."""

    numTrees = _number("numTrees", "number of trees")
    bootstrap = _number("bootstrap", "whether each tree draws its rows", TypeConverters.toBoolean)

    def __init__(self, numTrees=100, maxDepth=-1, minSamplesSplit=2, minSamplesLeaf=1, bootstrap=True, maxBins=MAX_BINS, seed=SEED, small=SMALL) -> None:
        super().__init__()
        self._set(numTrees=numTrees, maxDepth=maxDepth, minSamplesSplit=minSamplesSplit, minSamplesLeaf=minSamplesLeaf, bootstrap=bootstrap, maxBins=maxBins, seed=seed, small=small)

    def settings(self) -> Bag:
        rules = Rules(self._depth(), self.getOrDefault(self.minSamplesSplit), self.getOrDefault(self.minSamplesLeaf))
        return Bag(self.getOrDefault(self.numTrees), self.getOrDefault(self.bootstrap), rules, self.getOrDefault(self.seed))

    def _models(self, ready, most, settings, small):
        bins, table = ready.rows(most)
        kinds = None if any(b.bootstrap for b in settings) else ready.merged(most, small)
        forests = grow_forests(table, bins, settings, small) if kinds is None else grow_merged(kinds, bins, settings)
        return [TreeModel(bins, trees, 0.0, 1.0 / max(len(trees), 1)) for trees in forests]


class Boosting(TreeEstimator):
    """Second-order boosting of squared error: level by level, or best-first with ``numLeaves`` above zero."""

    maxIter = _number("maxIter", "number of trees")
    stepSize = _number("stepSize", "factor of each tree", TypeConverters.toFloat)
    numLeaves = _number("numLeaves", "leaves of a tree; zero grows by level")
    ridge = _number("ridge", "added to a leaf's weight", TypeConverters.toFloat)
    minWeight = _number("minWeight", "least second-order weight of a leaf", TypeConverters.toFloat)
    subsample = _number("subsample", "share of rows of each tree", TypeConverters.toFloat)
    colsample = _number("colsample", "share of features of each tree", TypeConverters.toFloat)

    def __init__(
        self, maxIter=100, stepSize=0.3, maxDepth=6, numLeaves=0, ridge=1.0, minWeight=1.0, minSamplesLeaf=1, minSamplesSplit=2,
        subsample=1.0, colsample=1.0, maxBins=MAX_BINS, seed=SEED, small=SMALL,
    ) -> None:
        super().__init__()
        self._set(
            maxIter=maxIter, stepSize=stepSize, maxDepth=maxDepth, numLeaves=numLeaves, ridge=ridge, minWeight=minWeight, minSamplesLeaf=minSamplesLeaf,
            minSamplesSplit=minSamplesSplit, subsample=subsample, colsample=colsample, maxBins=maxBins, seed=seed, small=small,
        )

    def settings(self) -> Boost:
        get = self.getOrDefault
        rules = Rules(self._depth(), get(self.minSamplesSplit), get(self.minSamplesLeaf), get(self.minWeight), get(self.ridge))
        return Boost(get(self.maxIter), get(self.stepSize), get(self.numLeaves) or None, rules, get(self.subsample), get(self.colsample), get(self.seed))

    def _models(self, ready, most, settings, small):
        bins, table = ready.rows(most)
        kinds = None if any(how.rows < 1 for how in settings) else ready.merged(most, small)
        if kinds is None:
            found = boost_all(table, bins, settings, small)
        else:
            base = float(kinds.agg(F.sum(F.col("label") * F.col("n")) / F.sum("n")).first()[0])
            found = [(base, trees) for trees in grow_merged(kinds, bins, settings, base)]
        return [TreeModel(bins, trees, base, 1.0) for base, trees in found]
