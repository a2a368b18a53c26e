"""Random forest with the settings and the model of Spark's ``RandomForestClassifier``, whose fit keeps one small binned
row for all trees.

Spark's own fit persists each row with its count in every tree and each row's node in every tree (two numbers a row and
tree), and each of its partitions sends the sums of a whole level.  Here a row is written once: label, one bin per
feature and an id.  How often a tree draws a row is a function of the row's id, the tree and the seed, so it is taken
anew in each pass, and rows walk the trees grown so far.  Each pass sums class counts by (tree, node, feature, bin) in at
most one task a core; the sums of a node meet in the shuffle, where its best split is chosen, and the driver sees one row
per node.  All sums are whole numbers: the same rows and ids give the same forest whatever their partitions and order.

As in Spark: a node tries a random subset of the features, small categorical features in all subsets of their
categories and larger ones in the order of the categories' impurity (two classes: rows of class 1); leaves of a pair that
say the same are merged.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowscore.operators.boosting import _delete
from flowscore.session import fresh_dir

#: Bytes of one kind in a block of rows (Arrow sends up to 10,000 blocks at once).
BLOCK_BYTES = 2048
#: Rows that walk the trees at once: what they need fits a core's cache.
SLICE = 1 << 15
#: Sums a task holds in one pass.
SUMS_BYTES = 64 << 20
#: Nodes whose splits one task chooses, where there are cores enough.
NODES_A_TASK = 64
#: Bits of a value's order that make the first cells of the quantiles, and those each further pass adds.
FIRST_BITS, MORE_BITS = 20, 6
#: An edge between bins is known up to one row in this many.
EXACT = 10_000
#: Deeper trees are left to Spark's fit: a pass sends every node's place and the way of each of its bins to all tasks.
DEEPEST = 10
#: Draws of one row and tree are looked up by 16 random bits.
DRAWS = 1 << 16
CONTINUOUS, SUBSETS, ORDERED = range(3)

_BLOCKS = T.StructType([T.StructField(c, T.BinaryType()) for c in ("label", "bins", "id")])
_CELLS = T.StructType([T.StructField("feature", T.IntegerType()), T.StructField("n", T.LongType()),
                       *[T.StructField(c, T.BinaryType()) for c in ("few", "number", "rows", "low", "high", "below")]])
_SUMS = T.StructType([T.StructField("node", T.IntegerType()), T.StructField("sums", T.BinaryType())])
_SPLITS = T.StructType([T.StructField("node", T.IntegerType()), T.StructField("feature", T.IntegerType()),
                        T.StructField("goes_left", T.BinaryType()), T.StructField("gain", T.DoubleType()),
                        T.StructField("left", T.BinaryType()), T.StructField("right", T.BinaryType())])


class Forest(RandomForestClassifier):
    """Estimator of Spark's ``RandomForestClassificationModel``.  ``row_key``: column that tells rows apart; without it a
    row's id is its place in its partition.  Weighted rows and trees deeper than ``DEEPEST`` are left to Spark's own fit."""

    row_key: str | None = None

    def _fit(self, dataset: DataFrame) -> RandomForestClassificationModel:
        if self.isSet("weightCol") or self.getMinWeightFractionPerNode() > 0 or self.getMaxDepth() > DEEPEST:
            return super()._fit(dataset)
        plan = _plan(dataset, self)
        trees = fit_forest(_rows(dataset, self), plan)
        model = RandomForestClassificationModel(_java_forest(dataset.sparkSession, self.uid, trees, plan))
        model = self._copyValues(model)
        model._transfer_params_to_java()
        return model


@dataclass
class ForestPlan:
    """Everything a pass needs beside the rows and the trees."""
    classes: int
    arity: list[int]                    # categories of each feature, 0: continuous
    trees: int
    depth: int
    max_bins: int
    subset: int                         # features a node tries
    rate: float
    with_replacement: bool
    entropy: bool
    least_rows: int
    least_gain: float
    seed: int
    cuts: list[np.ndarray] = field(default_factory=list)

    @property
    def features(self) -> int:
        return len(self.arity)

    def bins(self, feature: int) -> int:
        return self.arity[feature] or len(self.cuts[feature]) + 1

    def kind(self, feature: int) -> int:
        k = self.arity[feature]
        if not k:
            return CONTINUOUS
        most = math.floor(math.log2(self.max_bins // 2 + 1) + 1)
        return SUBSETS if self.classes > 2 and k <= most else ORDERED

    def row_type(self, most: int):
        return np.dtype("u1" if most <= 256 else "<u2")

    def tried(self, tree: int, node: int) -> np.ndarray:
        """Features a node tries."""
        if self.subset == self.features:
            return np.arange(self.features)
        return np.sort(np.random.default_rng((self.seed & (1 << 64) - 1, tree, node)).permutation(self.features)[:self.subset])

    def draws(self) -> np.ndarray:
        """How often a tree draws a row, by 16 random bits."""
        if not self.with_replacement:
            return (np.arange(DRAWS) < round(self.rate * DRAWS)).astype(np.uint8)
        p, below, out = math.exp(-self.rate), 0.0, np.zeros(DRAWS, dtype=np.uint8)
        for k in range(1, 256):
            below += p
            out[min(DRAWS, round(below * DRAWS)):] = k
            p *= self.rate / k
        return out


@dataclass
class Tree:
    """Nodes in heap order."""
    feature: np.ndarray                 # -1: a leaf (or no node)
    goes_left: dict[int, np.ndarray]    # by node that splits: for each bin
    gain: dict[int, float]
    stats: dict[int, np.ndarray]        # rows of each class, by node

    @staticmethod
    def empty(depth: int) -> Tree:
        return Tree(np.full((1 << depth + 1) - 1, -1, dtype=np.int64), {}, {}, {})


def _subset_size(strategy: str, features: int, trees: int) -> int:
    if strategy == "auto":
        strategy = "all" if trees == 1 else "sqrt"
    sizes = {"all": features, "sqrt": math.ceil(math.sqrt(features)), "log2": max(1, math.ceil(math.log2(features))),
             "onethird": math.ceil(features / 3)}
    if strategy in sizes:
        return sizes[strategy]
    if strategy.isdigit() and int(strategy) > 0:
        return min(int(strategy), features)
    return max(1, math.ceil(float(strategy) * features))


def _attributes(dataset: DataFrame, column: str) -> dict:
    return dataset.schema[column].metadata.get("ml_attr", {})


def _values(attribute: dict) -> int:
    return len(attribute["vals"]) if "vals" in attribute else int(attribute.get("num_vals", 0))


def _plan(dataset: DataFrame, est: RandomForestClassifier) -> ForestPlan:
    label, x = est.getLabelCol(), est.getFeaturesCol()
    attributes = _attributes(dataset, x)
    width = attributes.get("num_attrs")
    if width is None:
        one = dataset.select(F.size(vector_to_array(F.col(x)))).first()
        if one is None:
            raise ValueError("no training rows")
        width = one[0]
    arity = [0] * width
    for kind, found in attributes.get("attrs", {}).items():
        for a in found:
            n = 2 if kind == "binary" else _values(a) if kind == "nominal" else 0
            arity[a["idx"]] = n if n > 1 else 0
    if max(arity, default=0) > est.getMaxBins():
        raise ValueError(f"a feature has {max(arity)} categories, maxBins is {est.getMaxBins()}")
    classes = _values(_attributes(dataset, label))
    if not classes:
        most = dataset.agg(F.max(F.col(label).cast("double"))).first()[0]
        classes = int(most) + 1 if most is not None else 0
    return ForestPlan(classes, arity, est.getNumTrees(), est.getMaxDepth(), est.getMaxBins(),
                      _subset_size(est.getFeatureSubsetStrategy(), max(width, 1), est.getNumTrees()),
                      est.getSubsamplingRate(), est.getBootstrap(), est.getImpurity() == "entropy",
                      est.getMinInstancesPerNode(), est.getMinInfoGain(), est.getSeed())


def _rows(dataset: DataFrame, est: Forest) -> DataFrame:
    """label, x (array) and, with a key, the row's id."""
    x = vector_to_array(F.col(est.getFeaturesCol()))
    ids = [F.xxhash64(F.col(est.row_key)).alias("id")] if est.row_key else []
    return dataset.select(F.col(est.getLabelCol()).cast("double").alias("label"), x.alias("x"), *ids)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = np.asarray(column.flatten())
    if len(column) * width != len(flat):
        raise ValueError(f"rows of other than {width} features")
    return flat.reshape(len(column), width)


def _binary(column: pa.Array, kind) -> np.ndarray:
    """The bytes of all values of a binary column, one after the other."""
    place = np.dtype(np.int64 if pa.types.is_large_binary(column.type) else np.int32)
    ends = np.frombuffer(column.buffers()[1], place, len(column) + 1, place.itemsize * column.offset)
    size = np.dtype(kind).itemsize
    return np.frombuffer(column.buffers()[2], kind, (int(ends[-1]) - int(ends[0])) // size, int(ends[0]))


def _order(values: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the values (none is NaN)."""
    bits = (values + 0.0).view(np.uint64)
    return np.where(bits >> np.uint64(63) > 0, ~bits, bits | np.uint64(1 << 63))


def _value(order: np.ndarray) -> np.ndarray:
    top = np.uint64(1 << 63)
    return np.where(order >= top, order ^ top, ~order).view(np.float64)


@dataclass
class _Cells:
    """Ranges of a feature's values (those whose order shares its first bits), the rows in each and the ends of what they hold."""
    number: np.ndarray
    rows: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @staticmethod
    def of(order: np.ndarray, rows: np.ndarray, shift: int) -> _Cells:
        """``order`` is sorted."""
        number, at = np.unique(order >> np.uint64(shift), return_index=True)
        ends = np.append(at[1:], len(order)) - 1
        return _Cells(number, np.add.reduceat(rows, at) if len(at) else rows[:0], order[at], order[ends] if len(at) else order)

    @staticmethod
    def joined(parts: list[_Cells]) -> _Cells:
        number, at = np.unique(np.concatenate([p.number for p in parts]), return_inverse=True)
        rows, low, high = np.zeros(len(number), np.int64), np.full(len(number), np.iinfo(np.uint64).max), np.zeros(len(number), np.uint64)
        np.add.at(rows, at, np.concatenate([p.rows for p in parts]))
        np.minimum.at(low, at, np.concatenate([p.low for p in parts]))
        np.maximum.at(high, at, np.concatenate([p.high for p in parts]))
        return _Cells(number, rows, low, high)

    def take(self, at: np.ndarray) -> _Cells:
        return _Cells(self.number[at], self.rows[at], self.low[at], self.high[at])


def _cells_batch(rows: list[tuple]) -> pa.RecordBatch:
    """Of (feature, all rows, its values if they are few, cells, rows below each)."""
    flat = [(f, n, *(None if v is None else v.tobytes() for v in (few, c.number, c.rows, c.low, c.high, below)))
            for f, n, few, c, below in rows]
    columns = list(zip(*flat, strict=True)) or [[]] * len(_CELLS)
    kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 6]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=_CELLS.names)


def _cells_read(row) -> _Cells:
    return _Cells(*(np.frombuffer(v, k) for v, k in zip(row, (np.uint64, np.int64, np.uint64, np.uint64), strict=True)))


def find_cuts(rows: DataFrame, plan: ForestPlan) -> list[np.ndarray]:
    """Upper edges of the bins of each continuous feature: between its values if a bin for each will do, else quantiles.

    Quantiles come from counts of all rows by cell; a cell that holds an edge, several values and more than one in
    ``EXACT`` rows is counted again in finer ones.  Counts don't depend on partitions, nor do the edges."""
    most, width = plan.max_bins, plan.features
    cores = rows.sparkSession.sparkContext.defaultParallelism
    cuts = [np.empty(0)] * width
    edges: dict[int, list] = {}
    total: dict[int, int] = {}
    # By feature: cells to count again, and the rows below each.
    pending = {f: (np.zeros(1, np.uint64), np.zeros(1, np.int64)) for f in range(width) if not plan.arity[f]}
    shift, step = 64, FIRST_BITS
    while pending:
        finer = shift - step

        def count(batches, pending=pending, shift=shift, finer=finer):
            few: dict[int, np.ndarray | None] = {f: np.empty(0) if shift == 64 else None for f in pending}
            found: dict[int, list[_Cells]] = {f: [] for f in pending}
            for batch in batches:
                x = _matrix(batch.column(0), width)
                for f, (parents, _) in pending.items():
                    v, n = np.unique(x[~np.isnan(x[:, f]), f], return_counts=True)
                    if few[f] is not None:
                        both = np.union1d(few[f], v)
                        few[f] = both if len(both) <= most else None
                    order = _order(v)
                    if shift < 64:
                        on = np.isin(order >> np.uint64(shift), parents)
                        order, n = order[on], n[on]
                    found[f].append(_Cells.of(order, n, finer))
                    if len(found[f]) > 32:
                        found[f] = [_Cells.joined(found[f])]
            yield _cells_batch([(f, 0, few[f], _Cells.joined(c), None) for f, c in found.items() if c])

        def merge(batches, pending=pending, shift=shift, step=step, total=dict(total)):
            few: dict[int, np.ndarray | None] = {}
            found: dict[int, list[_Cells]] = {}
            for batch in batches:
                for f, _, v, *cells in zip(*(c.to_pylist() for c in batch.columns[:7]), strict=True):
                    old = few.get(f, np.empty(0))
                    new = None if v is None or old is None else np.union1d(old, np.frombuffer(v))
                    few[f] = new if new is not None and len(new) <= most else None
                    found.setdefault(f, []).append(_cells_read(cells))
            out = []
            for f, parts in found.items():
                c = _Cells.joined(parts)
                n = total.get(f, int(c.rows.sum()))
                parents, before = pending[f]
                parent = np.searchsorted(parents, c.number >> np.uint64(step))
                so_far = c.rows.cumsum() - c.rows
                below = before[parent] + so_far - so_far[np.searchsorted(parent, parent)]
                wanted = -(-n * np.arange(1, most) // most)
                at = np.searchsorted(below + c.rows, wanted)
                wanted, at = wanted[at < len(below)], at[at < len(below)]
                at = np.unique(at[below[at] < wanted])
                out.append((f, n, few[f], c.take(at), below[at]))
            yield _cells_batch(out)

        told = rows.select("x").coalesce(cores).mapInArrow(count, _CELLS)
        again = {}
        for r in told.repartition(min(cores, len(pending)), "feature").mapInArrow(merge, _CELLS).collect():
            if r.few is not None:
                v = np.frombuffer(r.few)
                cuts[r.feature] = (v[:-1] + v[1:]) / 2
                continue
            c, below, total[r.feature] = _cells_read(r[3:7]), np.frombuffer(r.below, np.int64), r.n
            done = (c.rows * EXACT <= r.n) | (c.low == c.high)
            edges.setdefault(r.feature, []).append(c.high[done])
            if not done.all():
                again[r.feature] = c.number[~done], below[~done]
        pending, shift, step = again, finer, min(MORE_BITS, finer)
    for f, found in edges.items():
        cuts[f] = _value(np.unique(np.concatenate(found)))
    return cuts


def _write_blocks(rows: DataFrame, plan: ForestPlan) -> str:
    """Rows as blocks of labels, bins and ids; where they lie."""
    width, kept_label = plan.features, plan.row_type(plan.classes)
    kept_bin = plan.row_type(max(plan.bins(f) for f in range(width)))
    step = max(1, BLOCK_BYTES // max(8, width * kept_bin.itemsize))

    def blocks(batches):
        seen = np.int64(TaskContext.get().partitionId()) << 40
        for batch in batches:
            n = batch.num_rows
            label = batch.column(0).to_numpy(zero_copy_only=False)
            if not ((label >= 0) & (label < plan.classes) & (label % 1 == 0)).all():
                raise ValueError(f"a label is no whole number from 0 to {plan.classes - 1}")
            x = _matrix(batch.column(1), width)
            bins = np.empty((n, width), dtype=kept_bin)
            for f in range(width):
                if plan.arity[f]:
                    if not ((x[:, f] >= 0) & (x[:, f] < plan.arity[f])).all():
                        raise ValueError(f"feature {f}: a category is no number from 0 to {plan.arity[f] - 1}")
                    bins[:, f] = x[:, f]
                else:
                    bins[:, f] = np.searchsorted(plan.cuts[f], x[:, f], side="left")
            ids = batch.column(2).to_numpy() if batch.num_columns > 2 else seen + np.arange(n, dtype=np.int64)
            seen += n
            columns = label.astype(kept_label), bins, np.ascontiguousarray(ids, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([c[i:i + step].tobytes() for i in range(0, n, step)], pa.binary()) for c in columns],
                names=_BLOCKS.names)

    path = fresh_dir(rows.sparkSession, "forest")
    rows.mapInArrow(blocks, _BLOCKS).write.parquet(path)
    return path


def _mixed(ids: np.ndarray, turn: int, seed: int) -> np.ndarray:
    """64 random bits for each id (splitmix64)."""
    z = ids + np.uint64((seed * 0x9E3779B97F4A7C15 + (turn + 1) * 0xD1B54A32D192ED03) & (1 << 64) - 1)
    z ^= z >> np.uint64(30)
    z *= np.uint64(0xBF58476D1CE4E5B9)
    z ^= z >> np.uint64(27)
    z *= np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    return z


@dataclass
class _Walk:
    """A tree as far as a pass needs it: where rows go, and where the counts of its open nodes are."""
    tree: int
    feature: np.ndarray                 # by node
    goes_right: np.ndarray              # node x bin, flat
    place: np.ndarray                   # by node of the level: which open node of the tree, or -1
    tried: np.ndarray                   # open node x feature tried
    start: np.ndarray                   # open node x feature tried: first cell of the tree's counts
    cells: int
    first: int                          # of the tree's counts among those of the pass


def _walks(trees: list[Tree], open_: list[tuple[int, int]], level: int, plan: ForestPlan, wide: int) -> list[_Walk]:
    walks, at, first = [], 0, (1 << level) - 1
    for t in sorted({t for t, _ in open_}):
        tree, nodes = trees[t], [n for k, n in open_ if k == t]
        right = np.zeros((max(first, 1), wide), dtype=np.uint8)
        for node, goes_left in tree.goes_left.items():
            if node < first:
                right[node, :len(goes_left)] = ~goes_left
        place = np.full(1 << level, -1, dtype=np.int64)
        place[np.array(nodes) - first] = np.arange(len(nodes))
        tried = np.array([plan.tried(t, n) for n in nodes])
        size = np.array([[plan.bins(f) * plan.classes for f in row] for row in tried.tolist()])
        start = np.concatenate([[0], size.ravel().cumsum()])
        walks.append(_Walk(t, np.maximum(tree.feature[:max(first, 1)], 0), right.ravel(), place, tried,
                           start[:-1].reshape(size.shape), int(start[-1]), at))
        at += int(start[-1])
    return walks


def _count(total: np.ndarray, label: np.ndarray, bins: np.ndarray, ids: np.ndarray, walks: list[_Walk], level: int,
           plan: ForestPlan, table: np.ndarray, wide: int) -> None:
    """Adds the rows of a slice to the counts of the pass."""
    n = len(label)
    by_feature = np.ascontiguousarray(bins.T)
    flat = by_feature.ravel()
    cell = (by_feature.astype(np.int64) * plan.classes + label).ravel()
    sure = not plan.with_replacement and plan.rate >= 1
    turn, bits = -1, None
    for w in walks:
        if sure:
            row, often = np.arange(n), None
        else:
            if w.tree // 4 != turn:
                turn = w.tree // 4
                bits = _mixed(ids, turn, plan.seed).view("<u2").reshape(n, 4)
            drawn = table.take(bits[:, w.tree % 4])
            row = np.flatnonzero(drawn)
            often = drawn.take(row)
        node = np.zeros(len(row), dtype=np.int64)
        offset = w.feature * n
        for _ in range(level):
            at = offset.take(node)
            at += row
            side = node * wide
            side += flat.take(at)
            node += node
            node += 1
            node += w.goes_right.take(side)
        node -= (1 << level) - 1
        node = w.place.take(node)
        if (w.place < 0).any():
            on = np.flatnonzero(node >= 0)
            if len(on) < len(row):
                node, row = node.take(on), row.take(on)
                often = often if often is None else often.take(on)
        if not len(row):
            continue
        often = often if often is None else often.astype(np.float64)
        own = total[w.first:w.first + w.cells]
        for j in range(w.tried.shape[1]):
            at = (w.tried[:, j] * n).take(node)
            at += row
            at = cell.take(at)
            at += w.start[:, j].take(node)
            counts = np.bincount(at, often)
            own[:len(counts)] += counts


def _packed(counts: np.ndarray) -> bytes:
    """Whole numbers, most of them 0: a bit for each cell that isn't, and those in as few bytes as the largest needs."""
    used = counts > 0
    numbers = counts[used]
    kind = next(k for k in ("<u1", "<u2", "<u4", "<u8") if numbers.max(initial=0) <= np.iinfo(k).max)
    return kind[-1:].encode() + np.packbits(used).tobytes() + numbers.astype(kind).tobytes()


def _unpack_into(total: np.ndarray, data: bytes) -> None:
    marks = -(-len(total) // 8)
    used = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, marks, 1), count=len(total)))
    total[used] += np.frombuffer(data, "<u" + data[:1].decode(), offset=1 + marks).astype(np.int64)


def impurity(counts: np.ndarray, entropy: bool) -> np.ndarray:
    """Of the rows of each class (last axis)."""
    n = counts.sum(axis=-1, keepdims=True)
    p = np.divide(counts, n, out=np.zeros(counts.shape), where=n > 0)
    if entropy:
        return -(p * np.log2(p, out=np.zeros(p.shape), where=p > 0)).sum(axis=-1)
    return np.where(n[..., 0] > 0, 1 - (p * p).sum(axis=-1), 0.0)


def best_split(counts: dict[int, np.ndarray], plan: ForestPlan):
    """(feature or -1, bins that go left, gain, left counts, right counts) of the best split, the first of equal ones;
    ``counts``: bin x class of each feature tried."""
    total = next(iter(counts.values())).sum(axis=0)
    n, own = total.sum(), impurity(total, plan.entropy)
    best = (-1, None, 0.0, total, None)
    for f, c in counts.items():
        order, kind = np.arange(len(c)), plan.kind(f)
        if kind == ORDERED:
            rows = c.sum(axis=1)
            centre = impurity(c, plan.entropy) if plan.classes > 2 else c[:, 1]
            order = np.argsort(np.where(rows > 0, centre, np.inf), kind="stable")
        if kind == SUBSETS:
            ways = np.arange(1, 1 << len(c) - 1)[:, None] >> np.arange(len(c)) & 1
            left = ways @ c
        else:
            left = c[order].cumsum(axis=0)[:-1]
        if not len(left):
            continue
        right = total - left
        nl, nr = left.sum(axis=1), right.sum(axis=1)
        gain = own - nl / max(n, 1) * impurity(left, plan.entropy) - nr / max(n, 1) * impurity(right, plan.entropy)
        gain[(nl < plan.least_rows) | (nr < plan.least_rows) | (gain < plan.least_gain)] = -np.inf
        at = int(gain.argmax())
        if gain[at] > best[2]:
            goes_left = ways[at] > 0 if kind == SUBSETS else np.isin(np.arange(len(c)), order[:at + 1])
            best = (f, goes_left, float(gain[at]), left[at], right[at])
    return best


def _pass(blocks: DataFrame, plan: ForestPlan, trees: list[Tree], open_: list[tuple[int, int]], level: int) -> list:
    """Best split of each of the open nodes (tree, node) of a level."""
    most_bins = max(plan.bins(f) for f in range(plan.features))
    kept_label, kept_bin = plan.row_type(plan.classes), plan.row_type(most_bins)
    walks = _walks(trees, open_, level, plan, most_bins)
    table, cells, size = plan.draws(), sum(w.cells for w in walks), 1 << plan.depth + 1
    first = (1 << level) - 1

    def sums(batches):
        total = np.zeros(cells)
        for batch in batches:
            if not batch.num_rows:
                continue
            label = _binary(batch.column(0), kept_label)
            bins = _binary(batch.column(1), kept_bin).reshape(len(label), plan.features)
            ids = _binary(batch.column(2), np.uint64)
            for i in range(0, len(label), SLICE):
                s = slice(i, i + SLICE)
                _count(total, label[s], bins[s], ids[s], walks, level, plan, table, most_bins)
        for w in walks:
            own = total[w.first:w.first + w.cells].astype(np.int64)
            for node in np.flatnonzero(w.place >= 0).tolist():
                p = int(w.place[node])
                of_node = own[w.start[p, 0]:w.start[p + 1, 0] if p + 1 < len(w.start) else w.cells]
                if of_node.any():
                    yield pa.RecordBatch.from_arrays([pa.array([w.tree * size + first + node], pa.int32()),
                                                      pa.array([_packed(of_node)], pa.binary())], names=_SUMS.names)

    def best(batches):
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for node, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if node not in found:
                    tried = plan.tried(*divmod(node, size))
                    found[node] = np.zeros(sum(plan.bins(f) for f in tried.tolist()) * plan.classes, dtype=np.int64)
                _unpack_into(found[node], data)
        rows = []
        for node, counts in found.items():
            tried = plan.tried(*divmod(node, size)).tolist()
            ends = np.cumsum([plan.bins(f) * plan.classes for f in tried])
            parts = {f: part.reshape(-1, plan.classes) for f, part in zip(tried, np.split(counts, ends[:-1]), strict=True)}
            f, goes_left, gain, left, right = best_split(parts, plan)
            rows.append((node, f, None if goes_left is None else goes_left.tobytes(), gain, left.tobytes(),
                         None if right is None else right.tobytes()))
        columns = list(zip(*rows, strict=True)) or [[]] * len(_SPLITS)
        kinds = [pa.int32(), pa.int32(), pa.binary(), pa.float64(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=_SPLITS.names)

    cores = blocks.sparkSession.sparkContext.defaultParallelism
    found = blocks.coalesce(cores).mapInArrow(sums, _SUMS)
    return found.repartition(min(cores, -(-len(open_) // NODES_A_TASK)), "node").mapInArrow(best, _SPLITS).collect()


def _groups(open_: list[tuple[int, int]], plan: ForestPlan) -> list[list[tuple[int, int]]]:
    """Nodes in order, as many at once as their sums may take."""
    groups, held = [[]], 0
    for t, n in open_:
        need = 8 * plan.classes * sum(plan.bins(f) for f in plan.tried(t, n).tolist())
        if groups[-1] and held + need > SUMS_BYTES:
            groups.append([])
            held = 0
        groups[-1].append((t, n))
        held += need
    return groups


def fit_forest(rows: DataFrame, plan: ForestPlan) -> list[Tree]:
    """Trees learned from ``rows`` (label, x, and an id if there is a key); sets the plan's cuts."""
    plan.cuts = find_cuts(rows, plan)
    trees = [Tree.empty(plan.depth) for _ in range(plan.trees)]
    path = _write_blocks(rows, plan)
    try:
        blocks = rows.sparkSession.read.schema(_BLOCKS).parquet(path)
        open_ = [(t, 0) for t in range(plan.trees)]
        for level in range(max(plan.depth, 1)):
            found = [r for group in _groups(open_, plan) for r in _pass(blocks, plan, trees, group, level)] if open_ else []
            open_ = []
            for r in found:
                t, node = divmod(r.node, 1 << plan.depth + 1)
                left = np.frombuffer(r.left, np.int64)
                if r.feature < 0 or not plan.depth:
                    # Without a split the left counts are all of the node's.
                    trees[t].stats.setdefault(node, left if r.right is None else left + np.frombuffer(r.right, np.int64))
                    continue
                right = np.frombuffer(r.right, np.int64)
                tree = trees[t]
                tree.feature[node], tree.gain[node] = r.feature, r.gain
                tree.goes_left[node] = np.frombuffer(r.goes_left, bool)
                tree.stats[node] = left + right
                for child, counts in ((2 * node + 1, left), (2 * node + 2, right)):
                    tree.stats[child] = counts
                    if level + 1 < plan.depth and impurity(counts, plan.entropy) > np.finfo(float).eps:
                        open_.append((t, child))
            open_.sort()
        if not any(0 in tree.stats for tree in trees) and blocks.isEmpty():
            raise ValueError("no training rows")
    finally:
        _delete(rows.sparkSession, path)
    return trees


def _java_forest(spark, uid: str, trees: list[Tree], plan: ForestPlan):
    """The trees as Spark's own model."""
    sc = spark.sparkContext
    jvm, gateway = sc._jvm, sc._gateway
    ml, old = jvm.org.apache.spark.ml, jvm.org.apache.spark.mllib
    one_tree, a_forest = ml.classification.DecisionTreeClassificationModel, ml.classification.RandomForestClassificationModel
    leaf, inner = ml.tree.LeafNode, ml.tree.InternalNode
    by_value, by_category = ml.tree.ContinuousSplit, ml.tree.CategoricalSplit
    kind = old.tree.impurity.EntropyAggregator if plan.entropy else old.tree.impurity.GiniAggregator
    calculator = kind(plan.classes).getCalculator
    parse = old.linalg.Vectors.parse

    def doubles(numbers):
        return parse("[" + ",".join(map(repr, map(float, numbers))) + "]").toArray()

    def split(f: int, goes_left: np.ndarray):
        if plan.arity[f]:
            return by_category(f, doubles(np.flatnonzero(goes_left)), plan.arity[f])
        return by_value(f, float(plan.cuts[f][int(goes_left.sum()) - 1]))

    def build(tree: Tree, node: int, at: dict, numbers):
        counts = tree.stats[node]
        said, own = float(counts.argmax()), float(impurity(counts, plan.entropy))
        if _says(tree, node) is not None:
            return leaf(said, own, calculator(numbers, at[node]))
        left, right = (build(tree, child, at, numbers) for child in (2 * node + 1, 2 * node + 2))
        return inner(said, own, tree.gain[node], left, right, split(int(tree.feature[node]), tree.goes_left[node]),
                     calculator(numbers, at[node]))

    out = gateway.new_array(one_tree, len(trees))
    for t, tree in enumerate(trees):
        tree.stats.setdefault(0, np.zeros(plan.classes, dtype=np.int64))  # a tree that drew no row
        # Each node's counts by class and in all, one after the other.
        at = {node: i * (plan.classes + 1) for i, node in enumerate(tree.stats)}
        numbers = doubles([c for counts in tree.stats.values() for c in (*counts.tolist(), int(counts.sum()))])
        out[t] = one_tree(f"{uid}_tree_{t}", build(tree, 0, at, numbers), plan.features, plan.classes)
    return a_forest(uid, out, plan.features, plan.classes)


def _says(tree: Tree, node: int) -> float | None:
    """The one class all leaves below a node say, if they do: the node is a leaf then."""
    if tree.feature[node] < 0:
        return float(tree.stats[node].argmax())
    left = _says(tree, 2 * node + 1)
    return left if left is not None and left == _says(tree, 2 * node + 2) else None
