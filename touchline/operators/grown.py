"""Boosted trees grown on rows that are kept as bin numbers and scores.

A round of boosting needs a sum over all rows for every level of a tree. Spark's
learner takes a dozen jobs and the conversion of all rows for each tree. Here each
partition is packed once into arrays: a byte per feature, and some numbers per row.
A level is one job that adds up histograms, whose size does not depend on the rows;
the driver adds the parts and picks the splits. The first job of a round also moves
the scores and derives the new slopes. Rows that fill a single partition need no adding
up, so their task grows all trees in one job.

Rows with the same bin numbers, a cell, have the same score and end in the same leaf. Where
cells are far fewer than rows, a round is one job that adds up slopes by cell, and the driver
grows its tree from these sums; rows are sent their scores by cell and move no more. The
quantiles of leaves take a few jobs more, over labels that are sorted within their cell.
Losses whose slopes follow from sums of the labels need no job at all.

Packed partitions are kept in memory, or on disk where memory is short, and written to the
shared folder every ``FOLD_EVERY`` rounds, so what a lost executor takes along is
made again from there.
"""

from __future__ import annotations

import pickle
import sys
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.session import shared_folder

# What runs in Python tasks is sent to them, so they need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of a partition: the least that are worth a task, and the most.
LEAST_ROWS, MOST_ROWS = 100_000, 4_000_000

#: Cells that trees are grown from on the driver, at most; and bytes of their sums that reach it at once.
MOST_CELLS, MOST_BYTES = 1 << 19, 1 << 28

#: Rounds between two copies in the shared folder.
FOLD_EVERY = 10

#: Values that bin edges are taken from.
SAMPLE = 10_000

#: Cells that the interval of a quantile is cut into in each step, and the values from which on they are looked at one by one.
CELLS, FEW = 1024, 8192


@dataclass
class Grower:
    """How trees grow; ``derive`` gives (g, h) of rows, ``alpha`` makes leaf values that quantile of ``label`` less the score.

    ``prepare`` puts the rows of a partition in the order and form that ``derive`` reads.
    ``added`` gives (g, h, sum of g * g / h) of cells from their rows, sums of ``label`` and of its
    square, and their score. ``first_rate`` is the rate of the first round, if it is another.
    """

    derive: Callable[[dict[str, np.ndarray], np.ndarray], tuple[np.ndarray, np.ndarray]]
    rounds: int
    depth: int
    rate: float
    penalty: object
    min_rows: int
    max_bins: int
    arity: dict[int, int]
    settled: float
    seed: int
    alpha: float | None = None
    prepare: Callable[[dict[str, np.ndarray]], tuple[np.ndarray, dict[str, np.ndarray]]] | None = None
    added: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, float]] | None = None
    first_rate: float | None = None
    edges: list[np.ndarray] = field(default_factory=list)

    @property
    def width(self) -> int:
        return max([self.max_bins, *self.arity.values()])

    def rate_of(self, n: int) -> float:
        return self.rate if n or self.first_rate is None else self.first_rate


def edges_of(values: np.ndarray, max_bins: int) -> np.ndarray:
    """Thresholds between the values: all of them, or ``max_bins - 1`` that cut evenly."""
    different, counts = np.unique(values, return_counts=True)
    middles = (different[:-1] + different[1:]) / 2
    if len(middles) < max_bins:
        return middles
    stride = counts.sum() / max_bins
    out, reached, target = [], int(counts[0]), stride
    for i in range(1, len(different)):
        before, reached = reached, reached + int(counts[i])
        if abs(before - target) < abs(reached - target):
            out.append(middles[i - 1])
            target += stride
    return np.array(out)


@dataclass
class Node:
    """A node of a tree being grown."""

    sums: np.ndarray  # rows, h, g, squares
    feature: int = -1
    bins: np.ndarray | None = None  # whether a bin goes left
    threshold: float = 0.0
    left: int = -1
    right: int = -1
    gain: float = 0.0
    value: float = 0.0


def _best(hist: np.ndarray, node: Node, grower: Grower, f: int) -> tuple[float, np.ndarray, int] | None:
    """(gain, order of bins, how many of them go left) of the best split by a feature."""
    n, h, g = hist
    # Categories lie by their mean step; empty ones last.
    order = np.argsort(np.where(h > 0, -g / np.where(h > 0, h, 1), np.inf), kind="stable") if f in grower.arity else np.arange(len(n))
    n, h, g = n[order].cumsum()[:-1], h[order].cumsum()[:-1], g[order].cumsum()[:-1]
    rows, whole_h, whole_g = node.sums[:3]
    fits = (n >= max(1, grower.min_rows)) & (rows - n >= max(1, grower.min_rows)) & (h > 0) & (whole_h - h > 0)
    if not fits.any():
        return None
    gained = np.full(len(n), -np.inf)
    left, right = h[fits], whole_h - h[fits]
    before = whole_g**2 / whole_h
    parts = g[fits] ** 2 / left + (whole_g - g[fits]) ** 2 / right
    gained[fits] = np.where(parts - before > 1e-12 * parts, parts - before, -np.inf)
    at = int(gained.argmax())
    return (gained[at] / whole_h, order, at + 1) if np.isfinite(gained[at]) else None


@dataclass
class Part:
    """A packed partition: bin numbers (features x rows), the numbers that ``derive`` reads, scores, slopes.

    Cells are kept as rows that stand for ``n`` of them, ``squares`` being the sum of their g * g / h.
    """

    bins: np.ndarray
    columns: dict[str, np.ndarray]
    score: np.ndarray
    g: np.ndarray
    h: np.ndarray
    n: np.ndarray | None = None
    squares: float = 0.0
    reached: tuple[int, np.ndarray] | None = None

    def reach(self, splits: list[tuple]) -> np.ndarray:
        """``ends`` while a tree grows: goes on from the splits of the level before."""
        done, at = self.reached or (0, np.zeros(len(self.score), dtype=np.int64))
        self.reached = len(splits), self.ends(splits[done:], at)
        return self.reached[1]

    def ends(self, splits: list[tuple], at: np.ndarray | None = None) -> np.ndarray:
        """The node each row reaches, from the root or ``at``; ``splits`` holds (node, feature, bins that go left, left child), parents first."""
        at = np.zeros(len(self.score), dtype=np.int64) if at is None else at
        for number, feature, left_bins, left in splits:
            here = np.flatnonzero(at == number) if number else np.arange(len(at))
            at[here] = left + ~left_bins[self.bins[feature, here]]
        return at


def _splits(nodes: list[Node]) -> list[tuple]:
    return [(i, n.feature, n.bins, n.left) for i, n in enumerate(nodes) if n.left >= 0]


def _advanced(derive: Callable, splits: list[tuple], values: np.ndarray | None) -> Callable[[Part], Part]:
    """The partition after a tree, with the slopes for the next one."""

    def run(part: Part) -> Part:
        score = part.score if values is None else part.score + values[part.ends(splits)]
        g, h = derive(part.columns, score)
        return Part(part.bins, part.columns, score, g, h)

    return run


def _histogram(splits: list[tuple], nodes: int, level: list[int], width: int) -> Callable[[Part], np.ndarray]:
    """(features, [rows, h, g], nodes of the level, bins). Rows without weight count for nothing."""

    def run(part: Part) -> np.ndarray:
        slot = np.full(nodes, -1)
        slot[level] = np.arange(len(level))
        place = slot[part.reach(splits)]
        mine = np.flatnonzero((part.h > 0) & (place >= 0))
        base, g, h = place[mine] * width, part.g[mine], part.h[mine]
        rows = None if part.n is None else part.n[mine]
        out = np.empty((len(part.bins), 3, len(level) * width))
        for f, bins in enumerate(part.bins):
            cell = base + bins[mine]
            for i, w in enumerate((rows, h, g)):
                out[f, i] = np.bincount(cell, w, len(level) * width)
        return out

    return run


def _totals(part: Part) -> np.ndarray:
    used = part.h > 0
    if part.n is not None:
        return np.array([part.n[used].sum(), part.h[used].sum(), part.g[used].sum(), part.squares])
    g, h = part.g[used], part.h[used]
    return np.array([len(g), h.sum(), g.sum(), (g * g / np.where(h > 0, h, 1.0)).sum()])


def _tree(parts: RDD, grower: Grower) -> list[Node]:
    """A tree, level by level."""
    features, width = len(grower.edges), grower.width
    nodes: list[Node] = []
    level = [0]
    for depth in range(max(1, grower.depth)):
        splits, number = _splits(nodes), max(1, len(nodes))
        look = _histogram(splits, number, level, width)
        found = parts.map(lambda p: (_totals(p) if depth == 0 else None, look(p))).collect()  # noqa: B023
        hist = sum(h for _, h in found).reshape(features, 3, len(level), width)
        if depth == 0:
            nodes = [Node(sum(t for t, _ in found))]
            if grower.depth == 0:
                break
        chosen = []
        for k, number in enumerate(level):
            best = [(b, f) for f in range(features) if (b := _best(hist[f, :, k], nodes[number], grower, f))]
            if best:
                (gain, order, cut), f = max(best, key=lambda b: b[0][0])
                node = nodes[number]
                left = np.zeros(width, dtype=bool)
                left[order[:cut]] = True
                node.feature, node.bins, node.gain = f, left, gain
                if f not in grower.arity:
                    node.threshold = float(grower.edges[f][cut - 1])
                node.left, node.right = len(nodes), len(nodes) + 1
                sums = hist[f, :, k][:, left].sum(axis=1)
                # What a child's steps differ from each other is not summed up: its impurity is left at that of equal steps.
                nodes += [Node(np.append(s, s[2] ** 2 / s[1] if s[1] > 0 else 0.0)) for s in (sums, node.sums[:3] - sums)]
                chosen.append(number)
        if not chosen:
            break
        level = [c for number in chosen for c in (nodes[number].left, nodes[number].right)]
    return nodes


def _pruned(nodes: list[Node], grower: Grower) -> None:
    """Takes back splits that gain too little, from the leaves upwards. Their children stay in the list, reached by nothing."""
    pair = lambda i: (float(nodes[i].sums[2]), float(nodes[i].sums[1]))
    for i in range(len(nodes) - 1, -1, -1):
        node = nodes[i]
        if node.left >= 0 and nodes[node.left].left < 0 and nodes[node.right].left < 0:
            if not grower.penalty.keeps(pair(node.left), pair(node.right)):
                node.left = node.right = node.feature = -1
                node.bins, node.gain = None, 0.0


def quantiles(each: Callable[[Callable], list], leaves: int, alpha: float, known: tuple | None = None) -> np.ndarray:
    """The value at rank ceil(alpha * n) of each leaf: intervals are cut into cells until few values are left.

    ``each`` calls a function with (value, leaf) of every partition and gives the results. A function
    that only looks between two bounds of each leaf has them in ``between``. ``known`` is the least
    and the largest value and the number of values of each leaf, where these are known.
    """

    def ends(value: np.ndarray, leaf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        low, high = np.full(leaves, np.inf), np.full(leaves, -np.inf)
        np.minimum.at(low, leaf, value)
        np.maximum.at(high, leaf, value)
        return low, high, np.bincount(leaf, minlength=leaves)

    if known is None:
        found = each(ends)
        known = np.min([f[0] for f in found], axis=0), np.max([f[1] for f in found], axis=0), np.sum([f[2] for f in found], axis=0)
    low, high, number = known
    rank = np.maximum(np.ceil(alpha * number), 1.0).astype(np.int64)  # among the values that are still looked at
    out, wanted = np.where(np.isfinite(low), low, 0.0), (number > 0) & (low < high)
    while wanted.any():
        few = wanted & (number <= FEW)
        width = np.where(wanted & ~few & (high > low), (high - low) / CELLS, 1.0)

        def look(value: np.ndarray, leaf: np.ndarray) -> tuple:
            inside = wanted[leaf] & (value >= low[leaf]) & (value <= high[leaf])  # noqa: B023
            value, leaf = value[inside], leaf[inside]
            listed = few[leaf]  # noqa: B023
            values = value[listed], leaf[listed]
            value, leaf = value[~listed], leaf[~listed]
            # A cell is (leaf, number); its least and largest value bound the next look.
            cell = leaf * CELLS + np.clip((value - low[leaf]) / width[leaf], 0, CELLS - 1).astype(np.int64)  # noqa: B023
            counts = np.bincount(cell, minlength=leaves * CELLS)
            least, most = np.full(len(counts), np.inf), np.full(len(counts), -np.inf)
            np.minimum.at(least, cell, value)
            np.maximum.at(most, cell, value)
            cells = np.flatnonzero(counts)
            return values, (cells, counts[cells], least[cells], most[cells])

        look.between = np.where(wanted, low, np.inf), np.where(wanted, high, -np.inf)
        found = each(look)
        value, leaf = (np.concatenate([f[0][i] for f in found]) for i in (0, 1))
        for i in np.flatnonzero(few):
            out[i] = np.sort(value[leaf == i])[rank[i] - 1]
        wanted = wanted & ~few
        cells, counts, least, most = (np.concatenate([f[1][i] for f in found]) for i in range(4))
        table = np.bincount(cells, counts, leaves * CELLS).astype(np.int64).reshape(leaves, CELLS)
        bound = np.full((2, leaves * CELLS), np.inf)
        np.minimum.at(bound[0], cells, least)
        np.minimum.at(bound[1], cells, -most)
        reached = table.cumsum(axis=1)
        for i in np.flatnonzero(wanted):
            pick = int((reached[i] < rank[i]).sum())
            rank[i] -= reached[i, pick - 1] if pick else 0
            number[i] = table[i, pick]
            low[i], high[i] = bound[0, i * CELLS + pick], -bound[1, i * CELLS + pick]
            out[i] = low[i]
        wanted = wanted & (low < high)
    return out


def _leaf_quantiles(parts: RDD, nodes: list[Node], alpha: float) -> dict[int, float]:
    ends = np.array([i for i, node in enumerate(nodes) if node.left < 0])
    place = np.full(len(nodes), -1)
    place[ends] = np.arange(len(ends))
    splits = _splits(nodes)

    def each(look: Callable) -> list:
        return parts.map(lambda p: look(p.columns["label"] - p.score, place[p.ends(splits)])).collect()

    return dict(zip(ends.tolist(), quantiles(each, len(ends), alpha).tolist()))


class Here:
    """The only partition, inside a task: what ``_rounds`` needs of an RDD."""

    def __init__(self, items: list):
        self.items = items

    def map(self, f: Callable) -> Here:
        return Here([f(x) for x in self.items])

    def collect(self) -> list:
        return self.items

    def persist(self, *_: object) -> Here:
        return self

    def unpersist(self) -> None:
        """Nothing is kept."""

    def checkpoint(self) -> None:
        """Nothing is kept."""


def _valued(nodes: list[Node], grower: Grower, n: int, leaf_quantiles: Callable[[], dict[int, float]]) -> tuple[list[tuple], np.ndarray, bool]:
    """Gives the leaves of a tree their values; (splits, values, whether the rounds after it would bring nothing)."""
    rate = grower.rate_of(n)
    if grower.alpha is None:
        _pruned(nodes, grower)
        for node in nodes:
            node.value = rate * grower.penalty.value(float(node.sums[2]), float(node.sums[1]))
    else:
        for i, v in leaf_quantiles().items():
            nodes[i].value = rate * v
    return _splits(nodes), np.array([node.value for node in nodes]), nodes[0].left < 0 and abs(nodes[0].value) < grower.settled


def _rounds(parts: RDD | Here, grower: Grower) -> list[list[Node]]:
    """The trees of all rounds; fewer if nothing is left to learn."""
    trees: list[list[Node]] = []
    old, splits, values = None, [], None
    for n in range(grower.rounds):
        parts = parts.map(_advanced(grower.derive, splits, values)).persist(StorageLevel.MEMORY_AND_DISK)
        if n % FOLD_EVERY == 0:
            parts.checkpoint()
        nodes = _tree(parts, grower)
        if old is not None:
            old.unpersist()
        old = parts
        splits, values, settled = _valued(nodes, grower, n, lambda: _leaf_quantiles(parts, nodes, grower.alpha))  # noqa: B023
        trees.append(nodes)
        if settled:
            break
    if old is not None:
        old.unpersist()
    return trees


# ---- cells --------------------------------------------------------------------


def _codes(bins: np.ndarray, sizes: list[int]) -> np.ndarray:
    """A number per row that tells its bin numbers."""
    out = np.zeros(bins.shape[1], dtype=np.int64)
    for row, size in zip(bins, sizes):
        out = out * size + row
    return out


def _collected(parts: RDD, f: Callable, each_bytes: int) -> Iterator:
    """The results of all partitions, of which a bounded number of bytes reach the driver at a time."""
    wave = max(1, MOST_BYTES // max(each_bytes, 1))
    for low in range(0, parts.getNumPartitions(), wave):
        yield from parts.context.runJob(parts, lambda items: [f(p) for p in items], range(low, min(low + wave, parts.getNumPartitions())))


def _cells(parts: RDD, sizes: list[int]) -> np.ndarray | None:
    """The codes of all cells in order; none if they are too many, or not much fewer than the rows."""
    if np.prod([float(s) for s in sizes]) >= 2.0**62:
        return None

    def look(part: Part) -> tuple[int, np.ndarray | None]:
        found = np.unique(_codes(part.bins, sizes))
        return part.bins.shape[1], found if len(found) <= MOST_CELLS else None

    rows, codes = 0, np.zeros(0, dtype=np.int64)
    for number, found in _collected(parts, look, 8 * MOST_CELLS):
        if found is None or len(codes := np.union1d(codes, found)) > MOST_CELLS:
            return None
        rows += number
    return codes if 2 * len(codes) <= rows else None


@dataclass
class Celled:
    """The rows of a partition with the place of their cell."""

    cell: np.ndarray
    columns: dict[str, np.ndarray]

    def slopes(self, derive: Callable, score: np.ndarray) -> tuple:
        """Rows with weight, h and g by cell, and the sum of g * g / h."""
        g, h = derive(self.columns, score[self.cell])
        unused = h <= 0
        if unused.any():
            g[unused] = h[unused] = 0.0
        add = lambda w, cell=self.cell: np.bincount(cell, w, len(score))
        rows = (add(None) - add(None, self.cell[unused])).astype(np.int32)
        squares = np.divide(g * g, h, out=np.zeros(len(h)), where=~unused).sum()
        return rows, add(h), add(g), squares


@dataclass
class Sorted:
    """The labels of a partition, cell by cell and in order there; ``first`` is where the cells begin and end."""

    cell: np.ndarray
    first: np.ndarray
    label: np.ndarray

    @staticmethod
    def of(cell: np.ndarray, label: np.ndarray) -> Sorted:
        order = np.lexsort((label, cell))
        cell = cell[order]
        begin = np.flatnonzero(np.append(True, cell[1:] != cell[:-1])) if len(cell) else np.zeros(0, dtype=np.int64)
        return Sorted(cell[begin], np.append(begin, len(cell)), label[order])

    def extent(self) -> tuple:
        """(cells, their rows, least and largest label)."""
        return self.cell, np.diff(self.first), self.label[self.first[:-1]], self.label[self.first[1:] - 1]

    def until(self, bound: np.ndarray) -> np.ndarray:
        """The place after the labels of each cell that are not above its bound."""
        low, high = self.first[:-1].copy(), self.first[1:].copy()
        for _ in range(int(np.diff(self.first).max(initial=0)).bit_length()):
            middle = (low + high) // 2
            open_ = low < high
            above = open_ & (self.label[np.minimum(middle, len(self.label) - 1)] <= bound)
            low, high = np.where(above, middle + 1, low), np.where(open_ & ~above, middle, high)
        return low

    def seen(self, look: Callable, score: np.ndarray, leaf: np.ndarray) -> tuple:
        """What ``look`` makes of (label less score, leaf), for the rows that may lie between its bounds."""
        score, leaf = score[self.cell], leaf[self.cell]
        low, high = (bound[leaf] for bound in look.between)
        slack = 1e-9 * (np.abs(score) + np.where(np.isfinite(low), np.abs(low), 0.0) + np.where(np.isfinite(high), np.abs(high), 0.0))
        begin, end = self.until(low + score - slack), self.until(high + score + slack)
        size = np.maximum(end - begin, 0)
        if size.sum() == len(self.label):
            label = self.label
        else:
            label = self.label[np.arange(int(size.sum())) + np.repeat(begin - (np.cumsum(size) - size), size)]
        return look(label - np.repeat(score, size), np.repeat(leaf, size))


def _rounds_of_cells(parts: RDD, codes: np.ndarray, sizes: list[int], grower: Grower) -> list[list[Node]]:
    """``_rounds`` with trees from sums by cell; the driver keeps a score per cell."""
    context, count = parts.context, len(codes)
    bins = np.empty((len(sizes), count), dtype=np.uint8 if grower.width <= 256 else np.uint16)
    rest = codes
    for f in range(len(sizes) - 1, -1, -1):
        rest, bins[f] = np.divmod(rest, sizes[f])
    known = context.broadcast(codes)
    cells = lambda part: np.searchsorted(known.value, _codes(part.bins, sizes)).astype(np.int32)

    def added(held: RDD, f: Callable) -> list:
        total = None
        for found in _collected(held, f, 20 * count):
            total = [np.array(x) for x in found] if total is None else [t + x for t, x in zip(total, found)]
        return total

    def sent(job: Callable, *values: np.ndarray) -> list:
        held = context.broadcast(values)
        try:
            return job(held)
        finally:
            held.destroy()

    held = None
    if grower.added is not None:

        def sums(part: Part) -> tuple:
            cell, label = cells(part), part.columns["label"]
            return tuple(np.bincount(cell, w, count) for w in (None, label, label * label))

        whole = added(parts, sums)
    elif grower.alpha is None:
        held = parts.map(lambda part: Celled(cells(part), part.columns))
    else:
        held = parts.map(lambda part: Sorted.of(cells(part), part.columns["label"]))
    if held is not None:
        held.persist(StorageLevel.MEMORY_AND_DISK).checkpoint()
        held.count()
        parts.unpersist()
    if grower.alpha is not None:
        rows, least, most = np.zeros(count), np.full(count, np.inf), np.full(count, -np.inf)
        for cell, number, first, last in _collected(held, Sorted.extent, 28 * count):
            rows[cell] += number
            least[cell], most[cell] = np.minimum(least[cell], first), np.maximum(most[cell], last)

    def slopes(score: np.ndarray) -> tuple:
        """Rows, h, g and the sum of g * g / h."""
        if grower.added is not None:
            g, h, squares = grower.added(*whole, score)
            return whole[0], h, g, squares
        if grower.alpha is None:
            return tuple(sent(lambda b: added(held, lambda p: p.slopes(grower.derive, b.value[0])), score))

        def below(part: Sorted, score: np.ndarray) -> tuple:
            out = np.zeros(count)
            out[part.cell] = part.until(score[part.cell]) - part.first[:-1]
            return (out,)

        # Rows of a cell differ in nothing but whether their label is above the score.
        under = sent(lambda b: added(held, lambda p: below(p, b.value[0])), score)[0]
        sides = grower.derive({"label": np.array([0.0, 1.0])}, np.array([0.0, 0.0]))
        g, h, squares = ([under * s[0] + (rows - under) * s[1]] for s in (*sides, sides[0] ** 2 / sides[1]))
        return rows, h[0], g[0], squares[0].sum()

    def leaf_quantiles(nodes: list[Node], score: np.ndarray, at: np.ndarray) -> dict[int, float]:
        ends = np.array([i for i, node in enumerate(nodes) if node.left < 0])
        place = np.full(len(nodes), -1)
        place[ends] = np.arange(len(ends))
        leaf = place[at]
        low, high = np.full(len(ends), np.inf), np.full(len(ends), -np.inf)
        np.minimum.at(low, leaf, least - score)
        np.maximum.at(high, leaf, most - score)
        extent = low, high, np.bincount(leaf, rows, len(ends)).astype(np.int64)
        each = lambda look: sent(lambda b: held.map(lambda p: p.seen(look, *b.value)).collect(), score, leaf)
        return dict(zip(ends.tolist(), quantiles(each, len(ends), grower.alpha, extent).tolist()))

    trees, score = [], np.zeros(count)
    for n in range(grower.rounds):
        rows_, h, g, squares = slopes(score)
        part = Part(bins, {}, score, g, h, rows_, squares)
        nodes = _tree(Here([part]), grower)
        at = part.ends(_splits(nodes))
        splits, values, settled = _valued(nodes, grower, n, lambda: leaf_quantiles(nodes, score, at))  # noqa: B023
        score = score + values[part.ends(splits)]
        trees.append(nodes)
        if settled:
            break
    if held is not None:
        held.unpersist()
    known.destroy()
    return trees


def _binned(x: np.ndarray, grower: Grower) -> np.ndarray:
    """Bin numbers (features x rows) of rows of values."""
    bins = np.empty((len(grower.edges), len(x)), dtype=np.uint8 if grower.width <= 256 else np.uint16)
    for f in range(len(grower.edges)):
        bins[f] = x[:, f] if f in grower.arity else np.searchsorted(grower.edges[f], x[:, f])
    return bins


def scorer(trees: list[list[Node]], grower: Grower) -> Callable[[np.ndarray], np.ndarray]:
    """Gives the sum of the trees for rows of values."""
    flat = [(_splits(nodes), np.array([node.value for node in nodes])) for nodes in trees]

    def run(x: np.ndarray) -> np.ndarray:
        score = np.zeros(len(x))
        part = Part(_binned(x, grower), {}, score, score, score)
        for splits, values in flat:
            score += values[part.ends(splits)]
        return score

    return run


def _pack(names: list[str], grower: Grower) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = len(grower.edges)
        bins, rest = [np.zeros((features, 0), dtype=np.uint8 if grower.width <= 256 else np.uint16)], []
        for batch in batches:
            x = batch.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, features)
            bins.append(_binned(x, grower))
            rest.append([batch.column(n).to_numpy(zero_copy_only=False) for n in names])
        columns = {n: np.concatenate([np.zeros(0), *[r[i] for r in rest]]) for i, n in enumerate(names)}
        score = np.zeros(sum(b.shape[1] for b in bins))
        yield pa.RecordBatch.from_pydict({"part": [pickle.dumps((np.concatenate(bins, axis=1), columns, score))]})

    return run


def _in_order(part: Part, order: np.ndarray, columns: dict[str, np.ndarray]) -> Part:
    return Part(part.bins[:, order], columns, part.score[order], part.g, part.h)


def dealt(df: DataFrame, *by: str) -> DataFrame:
    """The rows in as many partitions as their number asks for; rows with equal ``by`` in the same one."""
    rows = df.count()
    wanted = max(-(-rows // MOST_ROWS), min(df.sparkSession.sparkContext.defaultParallelism, -(-rows // LEAST_ROWS)), 1)
    return df.repartition(wanted, *by)


def nominal(df: DataFrame, features: str) -> dict[int, int]:
    """The number of categories of each feature that has them, from the vector's attributes."""
    attributes = df.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    out = {a["idx"]: len(a["vals"]) if "vals" in a else int(a["num_vals"]) for a in attributes.get("nominal", [])}
    return out | {a["idx"]: 2 for a in attributes.get("binary", [])}


def sampled_edges(arrays: DataFrame, arity: dict[int, int], max_bins: int, seed: int) -> list[np.ndarray]:
    """Bin edges of each feature, none for categories. ``arrays`` has one column, the features as an array."""
    number = arrays.count()
    share = 1.0 if number <= SAMPLE else SAMPLE / number
    sample = np.array([r[0] for r in arrays.sample(share, seed).collect()])  # about SAMPLE rows
    features = sample.shape[1] if sample.ndim == 2 else 0
    return [np.zeros(0) if f in arity else edges_of(sample[:, f], max_bins) for f in range(features)]


def grow(rows: DataFrame, features: str, grower: Grower) -> tuple[list[list[Node]], int]:
    """(nodes of each tree, number of features). ``rows`` lie as they are dealt (``dealt``); all columns but the vector are numbers."""
    shared_folder(rows.sparkSession)
    names = [c for c in rows.columns if c != features]
    # A constant of its own: fits of the same rows at the same time would share one cache, and the first to end would drop it.
    kept = rows.select(vector_to_array(features).alias("_x"), *[F.col(c).cast("double").alias(c) for c in names], F.lit(uuid.uuid4().hex).alias("_own")).persist()
    flat = kept.drop("_own")
    grower.edges = sampled_edges(flat.select("_x"), grower.arity, grower.max_bins, grower.seed)
    packed = flat.mapInArrow(_pack(names, grower), "part binary").rdd.map(lambda r: Part(*pickle.loads(r[0]), np.zeros(0), np.zeros(0)))
    if grower.prepare is not None:
        packed = packed.map(lambda p: _in_order(p, *grower.prepare(p.columns)))
    if packed.getNumPartitions() == 1:  # few rows: nothing to add up between tasks
        trees = packed.map(lambda p: _rounds(Here([p]), grower)).collect()[0]
    else:
        packed.persist(StorageLevel.MEMORY_AND_DISK).count()
        kept.unpersist()
        sizes = [grower.arity[f] if f in grower.arity else len(e) + 1 for f, e in enumerate(grower.edges)]
        codes = _cells(packed, sizes)
        trees = _rounds(packed, grower) if codes is None else _rounds_of_cells(packed, codes, sizes, grower)
        packed.unpersist()
    kept.unpersist()
    return trees, len(grower.edges)
