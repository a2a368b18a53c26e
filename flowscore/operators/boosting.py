"""Boosted trees for several classes: one softmax loss, one tree per class and round, grown level by level.

Features are cut into quantile bins once.  Each level of a round is one pass over the binned rows for all classes: tasks
sum gradients and hessians by (class, node, feature, bin), the sums are added up by (class, node) in the shuffle, and the
best split of each node is chosen where its sums meet, so the driver sees one row per class and node.  Sums are fixed-point
integers: the same rows give the same model whatever their partitions and order.  Of the two children of a split only the
one of less hessian is summed over the rows; the other is what it leaves of its parent's sums, which come back from the
level before.  Sums travel in as few bytes as they need, from at most one task per core.  Margins of the rows are written with
the binned features every few rounds, which cuts the lineage; between two writes the rounds since are walked again.
A task holds the sums of one level: open nodes of all classes x features x bins x 16 bytes.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowscore.session import fresh_dir

#: Bins of a feature (a bin is one byte).
BINS = 256
#: Rank error of the quantile sketch is one part in this many.
SKETCH_ACCURACY = 10_000
#: Rounds between two writes of the rows' margins.
ROUNDS_PER_WRITE = 10
#: Fixed-point unit of gradients and hessians.
UNIT = 1 << 24
#: Splits chosen by one task, where there are cores enough.
FAMILIES = 16
_ROWS = T.StructType([T.StructField("label", T.IntegerType()), T.StructField("bins", T.BinaryType()),
                      T.StructField("margin", T.BinaryType())])
_SUMS = T.StructType([T.StructField("family", T.IntegerType()), T.StructField("parent", T.BooleanType()),
                      T.StructField("sums", T.BinaryType())])
_SPLITS = T.StructType([T.StructField("key", T.IntegerType()), T.StructField("feature", T.IntegerType()),
                        T.StructField("cut", T.IntegerType()),
                        *[T.StructField(c, T.LongType()) for c in ("g", "h", "g_left", "h_left")],
                        T.StructField("sums", T.BinaryType())])


@dataclass
class BoostSettings:
    rounds: int = 100
    depth: int = 6
    rate: float = 0.3
    l2: float = 1.0
    least_hessian: float = 1.0


@dataclass
class Round:
    """One tree per class in heap order: feature (-1: a leaf), last bin that goes left, and value of each node."""
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    @staticmethod
    def empty(classes: int, depth: int) -> Round:
        size = (1 << depth + 1) - 1
        return Round(np.full((classes, size), -1, dtype=np.int32), np.zeros((classes, size), dtype=np.int32),
                     np.zeros((classes, size)))

    def walk(self, bins: np.ndarray, depth: int) -> np.ndarray:
        """The node each row ends in, by class."""
        classes = np.arange(len(self.feature))
        node = np.zeros((len(bins), len(classes)), dtype=np.int32)
        for _ in range(depth):
            feature = self.feature[classes, node]
            if (feature < 0).all():
                break
            right = np.take_along_axis(bins, np.maximum(feature, 0), 1) > self.cut[classes, node]
            node = np.where(feature < 0, node, 2 * node + 1 + right)
        return node

    def add_to(self, margin: np.ndarray, bins: np.ndarray, depth: int) -> None:
        margin += self.value[np.arange(len(self.feature)), self.walk(bins, depth)]


def quantile_cuts(rows: DataFrame, features: int) -> list[np.ndarray]:
    """Upper edges of the bins of each feature (one pass): a value's bin is the number of edges below it."""
    at = [(i + 1) / BINS for i in range(BINS - 1)]
    found = rows.agg(*[F.percentile_approx(F.col("x")[i], at, SKETCH_ACCURACY).alias(f"q{i}") for i in range(features)]).first()
    return [np.unique(np.array(q or [], dtype=np.float64)) for q in found]


def binned(values: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Bins of a matrix of features; not-a-number goes to the last bin."""
    out = np.empty(values.shape, dtype=np.uint8)
    for i, edges in enumerate(cuts):
        out[:, i] = np.searchsorted(edges, values[:, i], side="left")
    return out


def softmax(margin: np.ndarray) -> np.ndarray:
    e = np.exp(margin - margin.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _matrix(column: pa.Array, rows: int, kind, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(rows, width)


def _state(batch: pa.RecordBatch, features: int, classes: int, since: list[Round], depth: int):
    """(labels, bins, margins) of a batch, with the rounds since the last write added."""
    n = batch.num_rows
    bins = _matrix(batch.column(1), n, np.uint8, features)
    margin = _matrix(batch.column(2), n, np.float64, classes).copy()
    for r in since:
        r.add_to(margin, bins, depth)
    return batch.column(0).to_numpy(), bins, margin


def _packed(sums: np.ndarray) -> bytes:
    """Whole numbers (gradients, hessians) of the cells that are not 0, in as few bytes as the largest needs; cells are
    marked by a bit each."""
    used = sums.any(axis=0)
    numbers = sums[:, used]
    most = int(np.abs(numbers).max(initial=0))
    kind = next(k for k in ("<i2", "<i4", "<i8") if most <= np.iinfo(k).max)
    return kind[-1:].encode() + np.packbits(used).tobytes() + numbers.astype(kind).tobytes()


def _unpacked(data: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells that are not 0 of ``size``, and their gradients and hessians."""
    marks = -(-size // 8)
    at = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, marks, 1), count=size))
    return at, np.frombuffer(data, "<i" + data[:1].decode(), offset=1 + marks).reshape(2, len(at))


def _level_splits(table: DataFrame, features: int, classes: int, since: list[Round], tree: Round, level: int,
                  s: BoostSettings, counted: np.ndarray, before: DataFrame | None) -> DataFrame:
    """Best split and sums of each (class, node) of a level that has rows; key: class x nodes of the level + node.

    ``counted`` are the nodes to sum over the rows, ``before`` the splits and sums of the level before."""
    nodes, first = 1 << level, (1 << level) - 1
    size = features * BINS
    # Nodes to sum, numbered: of those that a split of the level before has made, one of two.
    open_ = counted[:, first:first + nodes]
    number = np.where(open_, np.cumsum(open_).reshape(open_.shape) - 1, -1)
    keys = np.flatnonzero(open_).astype(np.int32)
    # The two children of a split meet.
    child_of = {key // 2 if level else key: key for key in keys.tolist()}

    def sums(batches):
        total = np.zeros((2, len(keys) * size), dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            label, bins, margin = _state(batch, features, classes, since, s.depth)
            p = softmax(margin)
            here = tree.walk(bins, level) - first
            here = np.where(here >= 0, number[np.arange(classes), np.maximum(here, 0)], -1)
            places = np.arange(features) * BINS + bins
            for k in np.flatnonzero(open_.any(axis=1)).tolist():
                on = here[:, k] >= 0
                q, low = p[on, k], int(number[k].max(initial=-1, where=open_[k])) + 1 - int(open_[k].sum())
                flat = ((here[on, k, None].astype(np.int64) - low) * size + places[on]).ravel()
                span = int(open_[k].sum()) * size
                for i, part in enumerate((q - (label[on] == k), 2 * q * (1 - q))):
                    total[i, low * size:low * size + span] += np.bincount(
                        flat, np.repeat(np.rint(part * UNIT), features), span).astype(np.int64)
        by_node = total.reshape(2, len(keys), size)
        used = [i for i in range(len(keys)) if by_node[:, i].any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([int(keys[i]) // 2 if level else int(keys[i]) for i in used], pa.int32()),
             pa.array([False] * len(used), pa.bool_()), pa.array([_packed(by_node[:, i]) for i in used], pa.binary())],
            names=_SUMS.names)

    def best(batches):
        own: dict[int, np.ndarray] = {}
        parents: dict[int, np.ndarray] = {}
        for batch in batches:
            for family, parent, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at, part = _unpacked(data, size)
                both = (parents if parent else own).setdefault(family, np.zeros((2, size), dtype=np.int64))
                if len(at) < size:
                    both[:, at] += part
                else:
                    both += part
        rows = []
        for family in sorted(own.keys() | parents.keys()):
            key, both = child_of[family], own.get(family, np.zeros((2, size), dtype=np.int64))
            for child, of_child in ((key, both), (key ^ 1, parents[family] - both)) if family in parents else ((key, both),):
                split = best_split(of_child.reshape(2, features, BINS), s)
                rows.append((child, *split, _packed(of_child) if split[0] >= 0 and level + 1 < s.depth else None))
        columns = list(zip(*rows, strict=True)) or [[]] * len(_SPLITS)
        kinds = [pa.int32()] * 3 + [pa.int64()] * 4 + [pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=_SPLITS.names)

    cores = table.sparkSession.sparkContext.defaultParallelism
    found = table.coalesce(cores).mapInArrow(sums, _SUMS)
    if before is not None:
        found = found.union(before.filter("sums is not null").select(F.col("key").alias("family"), F.lit(True), "sums"))
    return found.repartition(min(cores, -(-len(child_of) // FAMILIES)), "family").mapInArrow(best, _SPLITS)


def best_split(sums: np.ndarray, s: BoostSettings) -> tuple[int, int, int, int, int, int]:
    """(feature or -1, cut, g, h, g_left, h_left) of the split of largest gain, the first of equal ones."""
    left = sums.cumsum(axis=2)
    g, h = (int(x) for x in left[:, 0, -1])
    gl, hl = left / UNIT
    gr, hr = g / UNIT - gl, h / UNIT - hl
    gain = gl ** 2 / (hl + s.l2) + gr ** 2 / (hr + s.l2) - (g / UNIT) ** 2 / (h / UNIT + s.l2)
    gain[(hl < s.least_hessian) | (hr < s.least_hessian)] = 0
    gain[:, -1] = 0
    at = int(gain.argmax())
    feature, cut = divmod(at, BINS)
    if not gain[feature, cut] > 1e-9:
        return -1, 0, g, h, 0, 0
    return feature, cut, g, h, int(left[0, feature, cut]), int(left[1, feature, cut])


def _grow(table, features, classes, since, s) -> Round:
    tree, worth = Round.empty(classes, s.depth), lambda g, h: -s.rate * (g / UNIT) / (h / UNIT + s.l2)
    counted = np.zeros(tree.feature.shape, dtype=bool)
    counted[:, 0] = True
    levels: list[DataFrame] = []
    for level in range(s.depth):
        first, split = (1 << level) - 1, False
        found = _level_splits(table, features, classes, since, tree, level, s, counted.copy(),
                              levels[-1] if levels else None)
        if level + 1 < s.depth:
            levels.append(found.persist(StorageLevel.MEMORY_AND_DISK))
        for row in found.drop("sums").collect():
            k, node = divmod(row.key, 1 << level)
            node += first
            tree.value[k, node] = worth(row.g, row.h)
            if row.feature >= 0:
                split = True
                tree.feature[k, node], tree.cut[k, node] = row.feature, row.cut
                tree.value[k, 2 * node + 1] = worth(row.g_left, row.h_left)
                tree.value[k, 2 * node + 2] = worth(row.g - row.g_left, row.h - row.h_left)
                if level + 1 < s.depth:
                    counted[k, 2 * node + (1 if 2 * row.h_left <= row.h else 2)] = True
        if not split:
            break
    for done in levels:
        done.unpersist()
    return tree


def fit_softmax(rows: DataFrame, classes: int, features: int, settings: BoostSettings) -> tuple[list, list[Round]]:
    """(cuts, rounds) learned from ``rows`` (x: array of double, label: int from 0)."""
    spark = rows.sparkSession
    cuts = quantile_cuts(rows, features)
    none = np.zeros(classes).tobytes()

    def to_bins(batches):
        for batch in batches:
            n = batch.num_rows
            x = np.array(batch.column(1).to_pylist(), dtype=np.float64).reshape(n, features)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([b.tobytes() for b in binned(x, cuts)], pa.binary()),
                 pa.array([none] * n, pa.binary())], names=_ROWS.names)

    def write(df):
        path = fresh_dir(spark, "boosting")
        df.write.parquet(path)
        return path, spark.read.schema(_ROWS).parquet(path).persist(StorageLevel.MEMORY_AND_DISK)

    # Files of the advisory size, whatever the input's partitions; later ones have the rows of those before them.
    path, table = write(rows.select("label", "x").mapInArrow(to_bins, _ROWS).hint("rebalance"))
    rounds: list[Round] = []
    written = 0
    try:
        while len(rounds) < settings.rounds:
            rounds.append(_grow(table, features, classes, rounds[written:], settings))
            if len(rounds) - written == ROUNDS_PER_WRITE and len(rounds) < settings.rounds:
                since, depth = rounds[written:], settings.depth

                def add(batches, since=since, depth=depth):
                    for batch in batches:
                        margin = _state(batch, features, classes, since, depth)[2]
                        yield pa.RecordBatch.from_arrays(
                            [*batch.columns[:2], pa.array([m.tobytes() for m in margin], pa.binary())], names=_ROWS.names)

                old_path, old, (path, table) = path, table, write(table.mapInArrow(add, _ROWS))
                old.unpersist()
                _delete(spark, old_path)
                written = len(rounds)
    finally:
        table.unpersist()
        _delete(spark, path)
    return cuts, rounds


def _delete(spark, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


class _Columns(HasFeaturesCol, HasLabelCol):
    settings = Param(Params._dummy(), "settings", "boosting settings as JSON", TypeConverters.toString)
    classes = Param(Params._dummy(), "classes", "number of classes", TypeConverters.toInt)


class SoftmaxBoost(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Estimator of ``SoftmaxBoostModel``; labels are class numbers from 0 (rows of other numbers are left out)."""

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", classes=2, settings=None):
        super().__init__()
        self._setDefault(settings=json.dumps(asdict(BoostSettings())))
        self._set(featuresCol=featuresCol, labelCol=labelCol, classes=classes)
        if settings:
            self._set(settings=json.dumps(settings))

    def _fit(self, dataset: DataFrame) -> SoftmaxBoostModel:
        settings = BoostSettings(**json.loads(self.getOrDefault("settings")))
        classes = self.getOrDefault("classes")
        rows = dataset.select(F.col(self.getLabelCol()).cast("int").alias("label"),
                              vector_to_array(F.col(self.getFeaturesCol())).alias("x"))
        rows = rows.filter((F.col("label") >= 0) & (F.col("label") < classes))
        one = rows.select(F.size("x")).first()
        cuts, rounds = fit_softmax(rows, classes, one[0], settings) if one else ([], [])
        model = SoftmaxBoostModel(featuresCol=self.getFeaturesCol(), labelCol=self.getLabelCol(), classes=classes,
                                  settings=asdict(settings))
        return model._set(trees=json.dumps({"cuts": [c.tolist() for c in cuts], "rounds": [
            [r.feature.tolist(), r.cut.tolist(), r.value.tolist()] for r in rounds]}))


class SoftmaxBoostModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``probability`` (vector) and ``prediction`` (class number) to rows with a feature vector."""

    trees = Param(Params._dummy(), "trees", "cuts and rounds as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", classes=2, settings=None):
        super().__init__()
        self._setDefault(settings=json.dumps(asdict(BoostSettings())), trees='{"cuts": [], "rounds": []}')
        self._set(featuresCol=featuresCol, labelCol=labelCol, classes=classes)
        if settings:
            self._set(settings=json.dumps(settings))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        text, classes = self.getOrDefault("trees"), self.getOrDefault("classes")
        depth = json.loads(self.getOrDefault("settings"))["depth"]
        shared = dataset.sparkSession.sparkContext.broadcast(text)  # the model

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def probabilities(batches: pd.Series) -> pd.Series:
            cuts, rounds = _loaded(shared.value)
            margin = np.zeros((len(batches), classes))
            if len(batches) and rounds:
                bins = binned(np.stack(batches.to_numpy()), cuts)
                for r in rounds:
                    r.add_to(margin, bins, depth)
            return pd.Series(list(softmax(margin)))

        out = dataset.withColumn("probability", probabilities(vector_to_array(F.col(self.getFeaturesCol()))))
        likeliest = F.array_position("probability", F.array_max("probability")) - 1
        return out.withColumn("prediction", likeliest.cast("double")).withColumn(
            "probability", array_to_vector(F.col("probability")))


_LOADED: dict[str, tuple] = {}


def _loaded(text: str) -> tuple[list[np.ndarray], list[Round]]:
    """The worker's copy of a model; one at a time."""
    if text not in _LOADED:
        raw = json.loads(text)
        _LOADED.clear()
        _LOADED[text] = ([np.array(c) for c in raw["cuts"]], [
            Round(np.array(f, dtype=np.int32), np.array(c, dtype=np.int32), np.array(v)) for f, c, v in raw["rounds"]])
    return _LOADED[text]
