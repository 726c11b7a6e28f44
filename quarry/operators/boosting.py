"""Boosted trees of several folds fitted together, a sum of histograms over the cluster for each level.

A fold's trees are those of Spark's ``GBTClassifier``: log loss, the first tree at weight 1, gain by
variance, and for each column the value, with nulls below all others, and whether it is null. Values
become codes once, by the thresholds of all folds, and rows of equal codes and label are one cell
that counts them for each fold, so a pass reads cells, and no rows are kept in memory.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SENTINEL = -1e6
#: Bins of a column, and the rows whose values set thresholds (``GBTClassifier`` takes 10,000 of a fold's).
BINS, SAMPLE = 32, 25_000
#: Residuals are rounded to this unit, so that sums of them are exact and do not depend on the order of parts.
UNIT = 2.0**-24
#: Gains that differ by less than this share are one gain: splits that part the same rows, seen from two columns.
SAME = 1e-9


@dataclass(frozen=True)
class Coding:
    """Thresholds of all folds (``edges``, per column), each fold's own as places in these, columns that a fold uses, and its rows of label 0 and 1."""

    edges: list[np.ndarray]
    own: list[list[np.ndarray]]
    used: list[list[bool]]
    classes: list[tuple[int, int]]

    @property
    def size(self) -> int:
        return 2 + max(map(len, self.edges))

    @property
    def kind(self) -> type:
        return np.uint8 if self.size <= 256 else np.uint16

    def weights(self, fold: int) -> tuple[float, float]:
        """Of a row of label 0 and of label 1; both classes weigh alike."""
        return tuple(sum(self.classes[fold]) / (2 * max(1, n)) for n in self.classes[fold])

    def slots(self, fold: int, column: int) -> np.ndarray:
        """Of each code its place in the fold's histogram: 0 for null, then the fold's bins."""
        codes = np.arange(self.size)
        return np.where(codes == 0, 0, 1 + np.searchsorted(self.own[fold][column], codes - 1))


def thresholds(values: np.ndarray, weights: np.ndarray, bins: int) -> np.ndarray:
    """Midpoints of values that cut them into ``bins`` of about equal weight, all midpoints where there are few values."""
    distinct, place = np.unique(values, return_inverse=True)
    middle = (distinct[:-1] + distinct[1:]) / 2
    if len(middle) < bins:
        return middle
    upto = np.cumsum(np.bincount(place, weights))
    nearer = (upto[:-1] + upto[1:]) / 2  # a target below this is nearer to the weight without the next value
    found, at, stride = [], 0, upto[-1] / bins
    while (at := max(at, int(np.searchsorted(nearer, stride * (len(found) + 1), side="right")))) < len(middle):
        found.append(at)
        at += 1
    return middle[found]


def coding(sample: pa.Table, columns: Sequence[str], train: Sequence[str], label: str, used: list[list[bool]], classes: list[tuple[int, int]]) -> Coding:
    """The coding whose thresholds come from ``sample``, where the columns ``train`` say which fold is trained on a row."""
    weight = np.asarray(sample[label]).astype(int)
    values = [_filled(sample[c]) for c in columns]
    cuts = []
    for m, name in enumerate(train):
        here = np.asarray(sample[name])
        w = np.array([n / (2 * max(1, k)) for n, k in ((sum(classes[m]), k) for k in classes[m])])[weight[here]]
        bins = min(BINS, max(1, sum(classes[m])))
        cuts.append([thresholds(x[here], w, bins) if ok else x[:0] for x, ok in zip(values, used[m])])
    edges = [np.unique(np.concatenate([c[f] for c in cuts])) for f in range(len(columns))]
    return Coding(edges, [[np.searchsorted(e, x) for e, x in zip(edges, c)] for c in cuts], used, classes)


def _filled(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    x = column.fill_null(SENTINEL).to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else column.fill_null(SENTINEL).to_numpy()
    return np.where(np.isnan(x), SENTINEL, x)


def coded(rows: DataFrame, columns: Sequence[str], by: Coding) -> DataFrame:
    """``rows`` with ``codes``, a byte or two for each of ``columns``, instead of these."""
    ids = [c for c in rows.columns if c not in columns]

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = np.zeros((b.num_rows, len(columns)), by.kind)
            for f, c in enumerate(columns):
                x = b.column(c)
                found[:, f] = np.where(x.is_null().to_numpy(zero_copy_only=False), 0, 1 + np.searchsorted(by.edges[f], _filled(x)))
            ends = np.arange(b.num_rows + 1, dtype=np.int32) * found.strides[0]
            codes = pa.Array.from_buffers(pa.binary(), b.num_rows, [None, pa.py_buffer(ends), pa.py_buffer(found)])
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ids), codes], [*ids, "codes"])

    schema = rows.select(*ids, F.lit(b"").alias("codes")).schema
    return rows.select(*ids, *(F.col(c).cast("double").alias(c) for c in columns)).mapInArrow(code, schema)


def _codes(batch: pa.RecordBatch, by: Coding) -> np.ndarray:
    width = len(by.edges) * np.dtype(by.kind).itemsize
    c = batch.column("codes").cast(pa.binary())
    return np.frombuffer(c.buffers()[2], np.uint8, batch.num_rows * width, c.offset * width).view(by.kind).reshape(batch.num_rows, -1)


@dataclass(frozen=True)
class Tree:
    """Nodes as a heap: the column asked (-1: none), the codes that go left, and the mean residual."""

    column: np.ndarray
    left: np.ndarray
    value: np.ndarray

    @staticmethod
    def bare(depth: int, size: int) -> Tree:
        nodes = 2 ** (depth + 1) - 1
        return Tree(np.full(nodes, -1), np.zeros((nodes, size), bool), np.zeros(nodes))

    def nodes(self, codes: np.ndarray) -> np.ndarray:
        """The node at which each row ends."""
        at, rows = np.zeros(len(codes), np.int64), np.arange(len(codes))
        for _ in range(len(self.value).bit_length() - 1):
            asked = self.column[at]
            at = np.where(asked < 0, at, 2 * at + 2 - self.left[at, codes[rows, asked]])
        return at


def margins(trees: Sequence[Tree], codes: np.ndarray, rate: float) -> np.ndarray:
    total = np.zeros(len(codes))
    for k, t in enumerate(trees):
        total += (1.0 if k == 0 else rate) * t.value[t.nodes(codes)]
    return total


def _sums(cells: DataFrame, by: Coding, label: str, train: Sequence[str], done: list[list[Tree]], grown: list[Tree], level: int, rate: float) -> np.ndarray:
    """Rows and their residuals by fold, node of the level, label, column and place in the fold's histogram."""
    first, nodes, size, width = 2**level - 1, 2**level, by.size, len(by.edges)
    shape = (len(train), nodes, 2, width, 2 + max(len(own) for fold in by.own for own in fold))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_ = np.zeros((2, len(train), width, nodes * 2 * size))
        for b in batches:
            codes, y = _codes(b, by), b.column(label).to_numpy(zero_copy_only=False).astype(np.int64)
            for m, name in enumerate(train):
                n = b.column(name).to_numpy(zero_copy_only=False)
                at = grown[m].nodes(codes) - first
                here = np.flatnonzero((n > 0) & (at >= 0))
                n, own, sign = n[here].astype(float), codes[here], 2.0 * y[here] - 1
                residual = 4 * sign / (1 + np.exp(2 * sign * margins(done[m], own, rate))) if done[m] else sign
                residual = np.rint(residual / UNIT) * UNIT * n
                base = (at[here] * 2 + y[here]) * size
                for f in range(width):
                    if by.used[m][f]:
                        place = base + own[:, f]
                        all_[0, m, f] += np.bincount(place, n, nodes * 2 * size)
                        all_[1, m, f] += np.bincount(place, residual, nodes * 2 * size)
        out = np.zeros((2, *shape))
        for m in range(len(train)):
            for f in range(width):
                np.add.at(out, (slice(None), m, slice(None), slice(None), f, by.slots(m, f)), np.moveaxis(all_[:, m, f].reshape(2, nodes, 2, size), -1, 0))
        n, g = out.reshape(2, -1)
        slot = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(n[slot]), pa.array(g[slot])], ["slot", "n", "g"])

    found = cells.select("codes", label, *train).mapInArrow(add, "slot long, n double, g double").groupBy("slot").agg(F.sum("n").alias("n"), F.sum("g").alias("g"))
    rows, sums = found.toArrow(), np.zeros((2, int(np.prod(shape))))  # as many as the histograms have places, however many cells
    sums[:, np.asarray(rows["slot"])] = np.asarray(rows["n"]), np.asarray(rows["g"])
    return sums.reshape(2, *shape)


def _best(sums: np.ndarray, by: Coding, fold: int) -> tuple[int, np.ndarray, float, float] | None:
    """The split of a node that gains most, of equal ones the first: its column, the codes that go left, and the values of both sides."""
    weights = np.array(by.weights(fold))
    n, w, g = sums[0].sum(axis=0), np.tensordot(weights, sums[0], 1), np.tensordot(weights, sums[1], 1)
    best, most = None, 0.0
    for f in (f for f, ok in enumerate(by.used[fold]) if ok):
        own = by.edges[f][by.own[fold][f]]
        sides = []
        for a in (n[f], w[f], g[f]):
            known = a[1 : len(own) + 2].copy()
            total = a.sum()
            known[np.searchsorted(own, SENTINEL)] += a[0]
            left = np.append(np.cumsum(known)[:-1], total - a[0])  # below each threshold, then all that is not null
            sides += [left, total - left]
        ln, rn, lw, rw, lg, rg = sides
        with np.errstate(divide="ignore", invalid="ignore"):
            both = lg**2 / lw + rg**2 / rw
            gain = np.where((ln > 0) & (rn > 0), both - (lg + rg) ** 2 / (lw + rw), -np.inf)
        k = int(np.argmax(gain >= gain.max() * (1 - SAME)))
        if gain[k] > max(most * (1 + SAME), 1e-12 * both[k] if np.isfinite(both[k]) else 0.0):
            most, codes = gain[k], np.arange(by.size)
            goes = codes > 0
            if k < len(own):
                goes = np.where(goes, codes - 1 <= by.own[fold][f][k], own[k] >= SENTINEL)
            best = (f, goes, lg[k] / lw[k], rg[k] / rw[k])
    return best


def fit(cells: DataFrame, by: Coding, label: str, train: Sequence[str], *, trees: int, depth: int, rate: float) -> list[list[Tree]]:
    """The trees of each fold; ``train`` are the columns that count a cell's rows in its training rows."""
    done: list[list[Tree]] = [[] for _ in train]
    for _ in range(trees):
        grown = [Tree.bare(depth, by.size) for _ in train]
        for level in range(depth):
            sums, split = _sums(cells, by, label, train, done, grown, level, rate), False
            for m, tree in enumerate(grown):
                for node in range(2**level):
                    at = 2**level - 1 + node
                    if level and tree.column[(at - 1) // 2] < 0:
                        continue
                    found = _best(sums[:, m, node], by, m)
                    if found:
                        split, (tree.column[at], tree.left[at], tree.value[2 * at + 1], tree.value[2 * at + 2]) = True, found
                    elif level == 0:
                        tree.value[0] = _mean(sums[:, m, 0], by, m)
            if not split:
                break
        for m, tree in enumerate(grown):
            done[m].append(tree)
    return done


def _mean(sums: np.ndarray, by: Coding, fold: int) -> float:
    f = by.used[fold].index(True)
    n, g = (float(np.dot(by.weights(fold), s[:, f].sum(axis=1))) for s in sums)
    return g / n if n else 0.0


def score(rows: DataFrame, by: Coding, models: list[list[Tree]], rate: float) -> DataFrame:
    """``rows`` with ``probability`` instead of ``codes``; ``model`` is the fold's place."""
    ids = [c for c in rows.columns if c != "codes"]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes, model, found = _codes(b, by), b.column("model").to_numpy(zero_copy_only=False), np.zeros(b.num_rows)
            for m in np.unique(model):
                here = np.flatnonzero(model == m)
                found[here] = 1 / (1 + np.exp(-2 * margins(models[m], codes[here], rate)))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ids), pa.array(found)], [*ids, "probability"])

    return rows.select(*ids, "codes").mapInArrow(scored, rows.select(*ids, F.lit(0.0).alias("probability")).schema)
