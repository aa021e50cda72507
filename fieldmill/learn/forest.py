"""Random forests that grow: settings of one search share their trees.

Tree t of a forest follows from the seed, t and the rows alone. So a forest of n trees and
depth d is the first n trees, cut at depth d, of any larger one, and a search grows every
tree once, as deep as some setting asks for. The rules are those of Spark's
``RandomForestClassifier`` for two classes: Poisson(1) bootstrap of all rows, the square root
of the features at each node, at most ``bins`` bins a feature, levels ordered by their share of
class 1, Gini gain, and subtrees that guess one class merged into a leaf.

Rows are held as one byte (two from 257 bins on) a feature, in blocks. Bootstrap weights are
drawn again from (seed, tree, block) in every pass instead of being held for each row and tree.
A pass adds one level: tasks count (bin, class) cells of the open nodes, tree by tree; the cells
of a node meet in one task, which sends its best split, so the driver gets the trees only.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import kept, scratch_path, ship_package, staged
from .model import INDEX_SUFFIX, bins_for, feature_stages, forest_classifier

BLOCK = 1 << 16  # rows that are walked at once
PART_BYTES = 1 << 26  # binned rows that one task holds
CELL_BYTES = 1 << 25  # cells that one task brings together, about
QUANTILE_ERROR = 1e-3  # of the split candidates, as a share of the rows
_BLOCKS = "block long, rows int, x binary, y binary"
_CELLS = "tree int, node int, cells binary"
_SPLITS = "tree int, node int, feature int, gain double, l0 long, l1 long, r0 long, r1 long, right binary"
_OPEN, _LEAF = -2, -1


def _poisson_table() -> np.ndarray:
    """Poisson(1) count of each of 2^16 even draws."""
    ends, share, below = [], math.exp(-1), 0.0
    for k in range(12):
        below += share
        ends.append(round(below * (1 << 16)))
        share /= k + 1
    return np.searchsorted(np.array(ends), np.arange(1 << 16), side="right").astype(np.uint8)


_POISSON = _poisson_table()


def bootstrap(seed: int, tree: int, block: int, rows: int) -> np.ndarray:
    """How often ``tree`` takes each row of a block; the same whenever it is asked for."""
    key = np.array([(seed & 0xFFFFFFFF) << 32 | tree, block], np.uint64)
    draws = np.random.Philox(key=key).random_raw((rows + 3) // 4)
    return _POISSON.take(draws.view(np.uint16)[:rows])


# --- rows ----------------------------------------------------------------------


@dataclass
class Binning:
    """How the inputs become bins: upper ends of numbers, counts of levels."""

    numeric: list[str]
    categorical: list[str]
    cuts: list[np.ndarray]
    levels: list[int]

    @property
    def sizes(self) -> np.ndarray:
        return np.array([*(len(c) + 1 for c in self.cuts), *self.levels], np.int64)

    @property
    def kind(self):
        return np.uint8 if self.sizes.max(initial=1) <= 256 else np.uint16


def _few_values(rows: DataFrame, columns: Sequence[str], most: int) -> dict[str, np.ndarray]:
    """Sorted distinct values of the columns that have at most ``most``."""

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {c: np.empty(0) for c in columns}
        for batch in batches:
            for c in columns:
                if len(held[c]) <= most:
                    held[c] = np.union1d(held[c], batch.column(c).to_numpy(zero_copy_only=False))[: most + 1]
        for c, values in held.items():
            yield pa.RecordBatch.from_pydict({"name": pa.array([c] * len(values), pa.string()), "value": pa.array(values, pa.float64())})

    found = rows.select(*columns).mapInArrow(distinct, "name string, value double").distinct()
    found = found.groupBy("name").agg(F.slice(F.array_sort(F.collect_set("value")), 1, most + 1).alias("v"))
    return {r["name"]: np.array(r["v"]) for r in found.collect() if len(r["v"]) <= most}


def binning(rows: DataFrame, numeric: Sequence[str], categorical: Sequence[str], levels: Sequence[int], bins: int) -> Binning:
    """Split candidates from all rows: between all values if these are few, else quantiles."""
    few = _few_values(rows, numeric, bins) if numeric else {}
    many = [c for c in numeric if c not in few]
    wanted = [k / bins for k in range(1, bins)]
    ends = dict(zip(many, rows.approxQuantile(many, wanted, QUANTILE_ERROR))) if many else {}
    cuts = []
    for c in numeric:
        if c in few:
            cuts.append(few[c][1:] / 2 + few[c][:-1] / 2)
        else:
            cuts.append(np.unique(np.array(ends[c], np.float64)))
    return Binning(list(numeric), list(categorical), cuts, list(levels))


def blocks(rows: DataFrame, b: Binning, label: str) -> DataFrame:
    """(block, rows, x, y): binned features, one feature after the other, and classes.

    Staged, so that a block keeps its number and its rows, and held in a few partitions.
    """
    names, kind = [*b.numeric, *b.categorical], b.kind
    cuts = [*b.cuts, *(None for _ in b.categorical)]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, held, n = TaskContext.get().partitionId() << 32, [], 0

        def packed() -> pa.RecordBatch:
            x = np.concatenate([x for x, _ in held], axis=1)
            y = np.concatenate([y for _, y in held])
            return pa.RecordBatch.from_pydict({
                "block": pa.array([number], pa.int64()), "rows": pa.array([len(y)], pa.int32()),
                "x": pa.array([x.tobytes()], pa.binary()), "y": pa.array([y.tobytes()], pa.binary()),
            })

        for batch in batches:
            if not batch.num_rows:
                continue
            y = batch.column(label).to_numpy(zero_copy_only=False)
            if not np.isin(y, (0.0, 1.0)).all():
                raise ValueError(f"{label} must be 0 or 1")
            x = np.empty((len(names), batch.num_rows), kind)
            for f, (name, at) in enumerate(zip(names, cuts)):
                value = batch.column(name).to_numpy(zero_copy_only=False)
                x[f] = value if at is None else np.searchsorted(at, value)
            while batch.num_rows and len(y):
                take = BLOCK - n
                held.append((x[:, :take], y[:take].astype(np.uint8)))
                n += len(held[-1][1])
                x, y = x[:, take:], y[take:]
                if n == BLOCK:
                    yield packed()
                    number, held, n = number + 1, [], 0
        if n:
            yield packed()

    columns = [F.col(c).cast("double").alias(c) for c in [*names, label]]
    packed_rows = staged(rows.select(*columns).mapInArrow(pack, _BLOCKS))
    size = (packed_rows.agg(F.sum("rows")).first()[0] or 0) * len(names) * np.dtype(kind).itemsize
    parts = max(2 * rows.sparkSession.sparkContext.defaultParallelism, math.ceil(size / PART_BYTES))
    return kept(packed_rows.repartition(parts))


def _opened(batches: Iterable[pa.RecordBatch], features: int, kind) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number, x by feature and row, y) of every block."""
    for batch in batches:
        for number, x, y in zip(batch.column(0), batch.column(2), batch.column(3)):
            y = np.frombuffer(y.as_buffer(), np.uint8)
            yield number.as_py(), np.frombuffer(x.as_buffer(), kind).reshape(features, len(y)), y


# --- trees ---------------------------------------------------------------------


@dataclass
class Tree:
    """Nodes in the order in which they came; the right child follows the left one."""

    left: list[int] = field(default_factory=lambda: [_OPEN])
    feature: list[int] = field(default_factory=lambda: [_LEAF])
    gain: list[float] = field(default_factory=lambda: [-1.0])
    counts: list[tuple[int, int]] = field(default_factory=lambda: [(0, 0)])
    right: list[np.ndarray | None] = field(default_factory=lambda: [None])  # by bin: goes right
    level: list[int] = field(default_factory=lambda: [0])
    depth: int = 0  # levels that were split

    def open(self) -> list[int]:
        return [k for k in range(len(self.left)) if self.left[k] == _OPEN]


@dataclass
class Arrays:
    """Nodes of one tree for walking; ``left`` is negative where a row stays."""

    left: np.ndarray
    feature: np.ndarray
    start: np.ndarray  # of a node's bins in ``right``
    right: np.ndarray
    value: np.ndarray  # share of class 1

    @staticmethod
    def of(left, feature, right, value=()) -> Arrays:
        flags = [r if l >= 0 else np.empty(0, np.uint8) for l, r in zip(left, right)]
        lengths = np.array([len(r) for r in flags], np.int64)
        return Arrays(
            np.array(left, np.int64), np.array(feature, np.int64), lengths.cumsum() - lengths,
            np.concatenate(flags) if flags else np.empty(0, np.uint8), np.array(value, np.float64),
        )

    def step(self, flat: np.ndarray, n: int, rows: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Next nodes of ``rows``, which are at nodes ``at`` that have children."""
        code = flat.take(self.feature.take(at) * n + rows)
        return self.left.take(at) + self.right.take(self.start.take(at) + code)

    def begin(self, x: np.ndarray, on: np.ndarray, drawn: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Rows whose node below the root is one of ``on``, and that node."""
        codes = x[self.feature[0]]
        child = self.left[0] + self.right[: self.start[1]]  # by code
        goes = on.take(child)
        if not goes.all():
            mask = goes.take(codes)
            drawn = mask if drawn is None else np.logical_and(mask, drawn)
        rows = np.arange(len(codes)) if drawn is None else np.flatnonzero(drawn)
        return rows, child.take(codes.take(rows))


@dataclass
class Level:
    """Open nodes of one tree and the features each may be split by."""

    tree: int
    depth: int
    nodes: np.ndarray
    subsets: np.ndarray  # (open node, place)
    arrays: Arrays

    def cells(self, seed: int, opened, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cells of all open nodes one after the other, and where each node starts.

        A node has the numbers of its features, then (bin, class) cells of each of them.
        """
        m, k = self.subsets.shape
        widths = 2 * sizes[self.subsets]
        length = k + widths.sum(axis=1)
        first = length.cumsum() - length
        start = (first[:, None] + k + widths.cumsum(axis=1) - widths).astype(np.int64)
        out = np.zeros(int(length.sum()))
        slot = np.full(len(self.arrays.left), -1, np.int64)
        slot[self.nodes] = np.arange(m)
        on = self.arrays.left != _LEAF
        for number, x, y in opened:
            weight = bootstrap(seed, self.tree, number, len(y))
            if not self.depth:  # the root has all rows, also those that were not drawn
                weights = weight.astype(np.float64)
                for f, at, width in zip(self.subsets[0], start[0], widths[0]):
                    cell = x[f].astype(np.int64)
                    cell *= 2
                    cell += y
                    out[at : at + width] += np.bincount(cell, weights, width)
                continue
            n, flat = len(y), x.reshape(-1)
            rows, at = self.arrays.begin(x, on, weight > 0)
            for _ in range(self.depth - 1):
                at = self.arrays.step(flat, n, rows, at)
                goes = on.take(at)
                if not goes.all():
                    rows, at = rows[goes], at[goes]
            if not len(rows):
                continue
            node, side = slot.take(at), y.take(rows)
            cell = np.empty((k, len(rows)), np.int64)
            for j in range(k):
                if m == 1:
                    cell[j], base = x[self.subsets[0, j]].take(rows), start[0, j]
                else:
                    cell[j], base = flat.take(self.subsets[:, j].take(node) * n + rows), start[:, j].take(node)
                cell[j] *= 2
                cell[j] += side
                cell[j] += base
            weights = np.broadcast_to(weight.take(rows).astype(np.float64), cell.shape).reshape(-1)
            if 4 * cell.size > len(out):
                out += np.bincount(cell.reshape(-1), weights, len(out))
            else:
                np.add.at(out, cell.reshape(-1), weights)
        cells = out.astype(np.int32)
        for j in range(k):
            cells[first + j] = self.subsets[:, j]
        return cells, np.append(first, len(cells))


def _counted(levels: Sequence[Level], seed: int, sizes: np.ndarray, kind):
    """Tasks: cells of the open nodes of all trees over a partition, tree by tree."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = list(_opened(batches, len(sizes), kind))
        if not opened:
            return
        for level in levels:
            cells, first = level.cells(seed, opened, sizes)
            m = len(level.nodes)
            for low in range(0, m, 1024):  # offsets of a batch have 32 bits
                high = min(low + 1024, m)
                ends = ((first[low : high + 1] - first[low]) * 4).astype(np.int32)
                data = cells[first[low] : first[high]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(high - low, level.tree, np.int32)),
                        pa.array(level.nodes[low:high].astype(np.int32)),
                        pa.Array.from_buffers(pa.binary(), high - low, [None, pa.py_buffer(ends), pa.py_buffer(data)]),
                    ],
                    ["tree", "node", "cells"],
                )

    return count


def gini(c0: np.ndarray, c1: np.ndarray) -> np.ndarray:
    n = np.maximum(c0 + c1, 1)
    return 1.0 - (c0 / n) ** 2 - (c1 / n) ** 2


def best_cuts(cells: np.ndarray, by_level: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best cut of each (bin, class) table: its gain, the bins that go right, rows on the left.

    ``cells`` by (table, bin, class). Levels are ordered by their share of class 1, those
    without rows last. A cut that leaves a side empty has no gain.
    """
    tables, bins, _ = cells.shape
    order = np.broadcast_to(np.arange(bins), (tables, bins))
    if by_level:
        n = cells.sum(axis=2)
        share = np.where(n > 0, cells[:, :, 1] / np.maximum(n, 1), np.inf)
        order = np.argsort(share, axis=1, kind="stable")
    upto = np.take_along_axis(cells, order[:, :, None], 1).cumsum(axis=1).astype(np.float64)
    whole = upto[:, -1:, :]
    rest = whole - upto
    n, left, right = whole.sum(axis=2), upto.sum(axis=2), rest.sum(axis=2)
    fall = gini(whole[:, :, 0], whole[:, :, 1]) - (
        left * gini(upto[:, :, 0], upto[:, :, 1]) + right * gini(rest[:, :, 0], rest[:, :, 1])
    ) / np.maximum(n, 1)
    fall = np.where((left > 0) & (right > 0), fall, -np.inf)
    cut = fall.argmax(axis=1)
    flags = np.zeros((tables, bins), np.uint8)
    np.put_along_axis(flags, order, (np.arange(bins) > cut[:, None]).astype(np.uint8), 1)
    at = np.arange(tables)
    return fall[at, cut], flags, upto[at, cut].astype(np.int64)


def _decided(subset: int, sizes: np.ndarray, numbers: int):
    """Tasks: the best split of every node from its cells, which are all in one partition."""

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for tree, node, cells in zip(*(c.to_pylist() for c in batch.columns)):
                cells = np.frombuffer(cells, np.int32)
                sums = held.get((tree, node))
                if sums is None:
                    held[tree, node] = cells.astype(np.int64)
                else:
                    sums[subset:] += cells[subset:]
        tables: dict[int, list[tuple[tuple[int, int], int, np.ndarray]]] = {}
        for key, cells in held.items():
            at = subset
            for place, f in enumerate(cells[:subset]):
                end = at + 2 * sizes[f]
                tables.setdefault(int(f), []).append((key, place, cells[at:end].reshape(-1, 2)))
                at = end
        best: dict[tuple[int, int], tuple] = {}
        for f, some in tables.items():
            for low in range(0, len(some), 1024):
                part = some[low : low + 1024]
                counts = np.stack([c for _, _, c in part])
                gains, flags, lefts = best_cuts(counts, f >= numbers)
                totals = counts.sum(axis=1)
                for (key, place, _), gain, right, l, whole in zip(part, gains, flags, lefts, totals):
                    # the first place among equal gains
                    found = (gain, -place, f, l, whole - l, right)
                    if key not in best or found[:2] > best[key][:2]:
                        best[key] = found
        if best:
            yield pa.RecordBatch.from_pydict({
                "tree": pa.array([t for t, _ in best], pa.int32()),
                "node": pa.array([n for _, n in best], pa.int32()),
                "feature": pa.array([b[2] for b in best.values()], pa.int32()),
                "gain": pa.array([float(b[0]) for b in best.values()], pa.float64()),
                **{
                    name: pa.array([int(b[side][c]) for b in best.values()], pa.int64())
                    for name, side, c in (("l0", 3, 0), ("l1", 3, 1), ("r0", 4, 0), ("r1", 4, 1))
                },
                "right": pa.array([b[5].tobytes() for b in best.values()], pa.binary()),
            })

    return decide


class Forest:
    """Trees of one seed over binned rows, grown as far as they are asked for."""

    def __init__(self, rows: DataFrame, b: Binning, seed: int = 200):
        self.rows, self.binning, self.seed = rows, b, seed
        self.trees: list[Tree] = []
        self.levels_grown = 0  # sum over the trees

    def _level(self, number: int) -> Level:
        tree, features = self.trees[number], len(self.binning.sizes)
        nodes = np.array(tree.open(), np.int64)
        draws = np.random.default_rng([self.seed & 0xFFFFFFFF, number, tree.depth]).random((len(nodes), features))
        subset = draws.argsort(axis=1, kind="stable")[:, : math.ceil(math.sqrt(features))]
        return Level(number, tree.depth, nodes, subset, Arrays.of(tree.left, tree.feature, tree.right))

    def grow(self, wanted: Iterable[tuple[int, int]]) -> None:
        """Grow until a forest of every (trees, depth) can be cut from this one."""
        wanted = list(wanted)
        if min((n for n, _ in wanted), default=2) < 2:
            raise ValueError("a forest has two trees or more")
        while len(self.trees) < max((n for n, _ in wanted), default=0):
            self.trees.append(Tree())
        need = [max((d for n, d in wanted if t < n), default=0) for t in range(len(self.trees))]
        while True:
            due = [t for t, tree in enumerate(self.trees) if tree.depth < need[t]]
            levels = [x for x in map(self._level, due) if len(x.nodes)]
            if levels:
                self._split(levels)
            for t in due:
                self.trees[t].depth += 1
            self.levels_grown += len(levels)
            if not due:
                return

    def _split(self, levels: Sequence[Level]) -> None:
        sizes, numbers = self.binning.sizes, len(self.binning.numeric)
        subset = levels[0].subsets.shape[1]
        cells = sum(int((subset + 2 * sizes[x.subsets].sum(axis=1)).sum()) for x in levels)
        parts = self.rows.sparkSession.sparkContext.defaultParallelism
        counted = self.rows.mapInArrow(_counted(levels, self.seed, sizes, self.binning.kind), _CELLS)
        tasks = max(parts, math.ceil(8 * cells / CELL_BYTES))
        decided = counted.repartition(tasks, "tree", "node").mapInArrow(_decided(subset, sizes, numbers), _SPLITS)
        found = {(r["tree"], r["node"]): r for r in decided.collect()}
        for level in levels:
            tree = self.trees[level.tree]
            for node in level.nodes.tolist():
                split = found.get((level.tree, node))
                tree.left[node] = _LEAF
                if split is None:  # no row was drawn
                    continue
                sides = [(split["l0"], split["l1"]), (split["r0"], split["r1"])]
                tree.counts[node] = tuple(map(sum, zip(*sides)))
                if not split["gain"] > 0:
                    continue
                tree.left[node], tree.feature[node] = len(tree.left), split["feature"]
                tree.gain[node] = split["gain"]
                tree.right[node] = np.frombuffer(split["right"], np.uint8)
                for side in sides:
                    tree.left.append(_OPEN if min(side) else _LEAF)
                    tree.feature.append(_LEAF)
                    tree.gain.append(-1.0)
                    tree.counts.append(side)
                    tree.right.append(None)
                    tree.level.append(tree.level[node] + 1)

    def cut(self, trees: int, depth: int) -> list[Tree]:
        """The first ``trees`` trees at ``depth``; nodes whose leaves guess alike are leaves."""
        return [_cut(t, depth) for t in self.trees[:trees]]


def _cut(tree: Tree, depth: int) -> Tree:
    if tree.depth < depth:
        raise ValueError(f"grown to depth {tree.depth}, not {depth}")
    guess = [int(c1 > c0) for c0, c1 in tree.counts]
    alike = [True] * len(tree.left)
    inner = [l >= 0 and k < depth for l, k in zip(tree.left, tree.level)]
    for k in reversed(range(len(inner))):  # children come after their parents
        if inner[k]:
            l = tree.left[k]
            alike[k] = alike[l] and alike[l + 1] and guess[l] == guess[l + 1]
    out = Tree([], [], [], [], [], [], depth)
    queue, at = [0], 0
    while at < len(queue):  # children side by side, in the order of their parents
        k = queue[at]
        at += 1
        splits = inner[k] and not alike[k]
        out.left.append(len(queue) if splits else _LEAF)
        out.feature.append(tree.feature[k] if splits else _LEAF)
        out.gain.append(tree.gain[k] if splits else -1.0)
        out.right.append(tree.right[k] if splits else None)
        out.counts.append(tree.counts[k])
        out.level.append(tree.level[k])
        if splits:
            queue += [tree.left[k], tree.left[k] + 1]
    return out


def scores(rows: DataFrame, trees: Sequence[Tree], b: Binning, label: str) -> DataFrame:
    """(score, label) of every binned row: the mean share of class 1 over the trees."""
    arrays = [Arrays.of(t.left, t.feature, t.right, [c1 / max(c0 + c1, 1) for c0, c1 in t.counts]) for t in trees]
    features, kind = len(b.sizes), b.kind

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, x, y in _opened(batches, features, kind):
            total, n, flat = np.zeros(len(y)), len(y), x.reshape(-1)
            for tree in arrays:
                if tree.left[0] < 0:
                    total += tree.value[0]
                    continue
                on = tree.left >= 0
                child = tree.left[0] + tree.right[: tree.start[1]]
                ends = np.where(on.take(child), 0.0, tree.value.take(child))
                total += ends.take(x[tree.feature[0]])
                rows, at = tree.begin(x, on)
                while len(rows):
                    at = tree.step(flat, n, rows, at)
                    goes = on.take(at)
                    total[rows[~goes]] += tree.value.take(at[~goes])
                    rows, at = rows[goes], at[goes]
            yield pa.RecordBatch.from_pydict({"score": pa.array(total / len(arrays)), label: pa.array(y.astype(np.int32))})

    return rows.mapInArrow(score, f"score double, `{label}` int")


# --- pipelines -----------------------------------------------------------------


@dataclass
class Encoded:
    """Rows with indexed levels, staged, and how they are binned."""

    encoder: PipelineModel
    binning: Binning
    rows: DataFrame


def encoded(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str, seed: int, invalid: str = "skip") -> Encoded:
    """Encoders and split candidates of ``train``, and its binned rows."""
    ship_package(train.sparkSession)  # tasks use the classes below
    encoder = Pipeline(stages=feature_stages(numeric, categorical, invalid)).fit(train)
    indexed = [c + INDEX_SUFFIX for c in categorical]
    levels = [
        len(labels) + (invalid == "keep")
        for stage in encoder.stages
        if isinstance(stage, StringIndexerModel)
        for labels in stage.labelsArray
    ]
    rows = staged(encoder.transform(train).select(*(F.col(c).cast("double").alias(c) for c in numeric), *indexed, label))
    b = binning(rows, numeric, indexed, levels, bins_for(encoder, forest_classifier(label, seed)))
    return Encoded(encoder, b, blocks(rows, b, label))


def forest_model(spark: SparkSession, trees: Sequence[Tree], b: Binning, learner) -> RandomForestClassificationModel:
    """``trees`` as the model that ``learner`` would give, made in its saved form."""
    path = scratch_path(spark, "forest")
    plain = _plain_model(spark, b, learner, f"{path}/plain")
    about = json.loads(spark.read.text(f"{plain}/metadata").first()[0])
    about["numTrees"] = about["paramMap"]["numTrees"] = len(trees)
    one = spark.read.parquet(f"{plain}/treesMetadata").first()
    uids = json.loads(one[1])
    metadata = [
        (t, json.dumps({**uids, "uid": f"{uids['uid']}_{t}"}), 1.0) for t in range(len(trees))
    ]
    schema = spark.read.parquet(f"{plain}/data").schema
    names = spark.read.parquet(f"{plain}/treesMetadata").columns
    made = f"{path}/model"
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{made}/metadata")
    spark.createDataFrame(metadata, f"`{names[0]}` int, `{names[1]}` string, `{names[2]}` double").coalesce(1).write.parquet(f"{made}/treesMetadata")
    nodes = [row for t, tree in enumerate(trees) for row in _saved_nodes(t, tree, b)]
    spark.createDataFrame(nodes, schema).coalesce(1).write.parquet(f"{made}/data")
    return RandomForestClassificationModel.load(made)


def _plain_model(spark: SparkSession, b: Binning, learner, path: str) -> str:
    """A model of one tree from four rows, saved: it has the parameters of ``learner``."""
    from pyspark.ml.linalg import Vectors

    rows = [(Vectors.dense([float(k)] * len(b.sizes)), float(k % 2)) for k in range(4)]
    tiny = spark.createDataFrame(rows, ["__x", learner.getLabelCol()]).withColumnRenamed("__x", learner.getFeaturesCol())
    learner.copy({learner.numTrees: 1}).fit(tiny).write().overwrite().save(path)
    return path


def _saved_nodes(number: int, tree: Tree, b: Binning) -> Iterator[tuple]:
    """Rows of the saved form, numbered in preorder."""
    place, stack, order = {}, [0], []
    while stack:
        k = stack.pop()
        place[k] = len(order)
        order.append(k)
        if tree.left[k] >= 0:
            stack += [tree.left[k] + 1, tree.left[k]]
    for k in order:
        c0, c1 = map(float, tree.counts[k])
        children, split = (-1, -1), (-1, [], -1)
        if tree.left[k] >= 0:
            children, f = (place[tree.left[k]], place[tree.left[k] + 1]), tree.feature[k]
            to_left = np.flatnonzero(tree.right[k] == 0)
            if f < len(b.numeric):
                split = (f, [float(b.cuts[f][to_left[-1]])], -1)
            else:
                split = (f, to_left.astype(float).tolist(), int(b.sizes[f]))
        impurity = float(gini(np.array(c0), np.array(c1)))
        yield number, (place[k], float(c1 > c0), impurity, [c0, c1], int(c0 + c1), float(tree.gain[k]), *children, split)


def fit_forest(
    train: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    label: str,
    seed: int = 200,
    invalid: str = "skip",
    *,
    numTrees: int,
    maxDepth: int,
) -> PipelineModel:
    """Encoders and a grown forest as a pipeline of Spark's own models."""
    e = encoded(train, numeric, categorical, label, seed, invalid)
    forest = Forest(e.rows, e.binning, seed)
    try:
        forest.grow([(numTrees, maxDepth)])
    finally:
        e.rows.unpersist()
    learner = forest_classifier(label, seed, numTrees=numTrees, maxDepth=maxDepth)
    model = forest_model(train.sparkSession, forest.cut(numTrees, maxDepth), e.binning, learner)
    return PipelineModel(stages=[*e.encoder.stages, model])
