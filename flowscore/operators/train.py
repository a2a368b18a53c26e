"""Classification pipelines: random forest, logistic regression, boosted trees,
one-vs-rest boosted trees, softmax boosted trees.  Fit, save and load.

Layout of a fitted model (``FlowModel``):
  * the label indexer is kept OUT of the scoring pipeline (the label column is
    absent at scoring time);
  * the scoring pipeline = categorical indexers -> mean imputer -> assembler
    -> classifier;
  * ``labels`` holds the class names in index order plus ``__unknown__`` for
    the extra class that ``handleInvalid="keep"`` creates.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, OneVsRest
from pyspark import StorageLevel
from pyspark.ml.feature import StringIndexerModel, VectorSizeHint
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowscore.operators.boosting import SoftmaxBoost
from flowscore.operators.features import assembler_stage, imputer_stage, index_stage
from flowscore.operators.forest import Forest
from flowscore.schema import UNKNOWN_LABEL
from flowscore.session import shared_dir

LABEL_INDEX = "label_index"

# Reference model settings (random forest).
RF_PARAMS = dict(numTrees=50, maxDepth=6, maxBins=256, featureSubsetStrategy="sqrt",
                 subsamplingRate=0.7, seed=42)
# Execution settings of Spark's own tree learners (same model; ``Forest``
# walks the trees in every pass): deep trees keep each row's node id
# between levels instead of re-walking the trees, the node-id RDD
# checkpointed to the shared checkpoint folder every 10 iterations.  Shallow
# trees (boosting) re-walk: a few comparisons per row cost less than
# persisting and checkpointing a node id for every row.
DEEP_TREE = 5
TREE_EXEC = dict(checkpointInterval=10)
# Split statistics a task aggregates per pass (features x bins x classes per
# node).  It sets how many nodes are split per pass, which also orders the
# forest's random feature draws, so it is one fixed value on every machine;
# executors need this much heap per concurrent task beside the data.
TREE_MEMORY_MB = 16


def _tree_exec(params: dict, default_depth: int = 5) -> dict:
    depth = params.get("maxDepth", default_depth)
    return {**TREE_EXEC, "cacheNodeIds": depth >= DEEP_TREE,
            "maxMemoryInMB": TREE_MEMORY_MB}


@dataclass
class FlowModel:
    pipeline: PipelineModel
    label_col: str
    labels: list[str] | None = None            # None: numeric 0/1 label, no indexer
    label_indexer: StringIndexerModel | None = None
    features: list[str] = field(default_factory=list)
    categorical: list[str] = field(default_factory=list)

    def vocabulary(self, column: str) -> list[str]:
        """Categories of ``column`` seen at fit time, read from the fitted
        indexer (model metadata bounded by the category count, no scan)."""
        for stage in self.pipeline.stages:
            if isinstance(stage, StringIndexerModel):
                inputs = (stage.getInputCols() if stage.isSet("inputCols")
                          else [stage.getInputCol()])
                if column in inputs:
                    return list(stage.labelsArray[inputs.index(column)])
        raise KeyError(f"no fitted indexer for column {column!r}")

    def save(self, path: str) -> None:
        self.pipeline.write().overwrite().save(path + "/pipeline")
        if self.label_indexer is not None:
            self.label_indexer.write().overwrite().save(path + "/label_indexer")
        meta = {"label_col": self.label_col, "labels": self.labels,
                "features": self.features, "categorical": self.categorical}
        _write_text(path + "/flowmodel.json", json.dumps(meta))

    @staticmethod
    def load(path: str) -> "FlowModel":
        meta = json.loads(_read_text(path + "/flowmodel.json"))
        pipe = PipelineModel.load(path + "/pipeline")
        idx = None
        if meta["labels"] is not None:
            idx = StringIndexerModel.load(path + "/label_indexer")
        return FlowModel(pipe, meta["label_col"], meta["labels"], idx,
                         meta["features"], meta["categorical"])


def _write_text(path: str, text: str) -> None:
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def _read_text(path: str) -> str:
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    return "".join(r.value for r in spark.read.text(path).collect())


def _classifier(kind: str, label: str, n_bins: int, params: dict, n_classes: int = 2):
    if kind == "rf":
        p = {**RF_PARAMS, **params}
        p = {**_tree_exec(p), **p}
        p["maxBins"] = max(p["maxBins"], n_bins)
        return Forest(featuresCol="features", labelCol=label, **p)
    if kind == "lr":
        return LogisticRegression(featuresCol="features", labelCol=label, **params)
    if kind == "gbt":
        p = {"seed": 42, "maxBins": max(32, n_bins), **_tree_exec(params), **params}
        return GBTClassifier(featuresCol="features", labelCol=label, **p)
    if kind == "ovr":
        p = {"seed": 42, "maxBins": max(32, n_bins), **_tree_exec(params), **params}
        # Binary models fitted at once; each holds a converted copy of the training rows.
        parallelism = p.pop("parallelism", 1)
        return OneVsRest(classifier=GBTClassifier(**p), featuresCol="features",
                         labelCol=label, parallelism=parallelism)
    if kind == "softmax":
        return SoftmaxBoost(featuresCol="features", labelCol=label, classes=n_classes, settings=params)
    raise ValueError(f"unknown classifier kind: {kind}")


def fit_classifier(train: DataFrame, label_col: str, numeric: list[str],
                   categorical: list[str] = (), kind: str = "rf",
                   index_label: bool = True, params: dict | None = None,
                   vectors: dict[str, int] | None = None, key: str | None = None) -> FlowModel:
    """Fit indexers -> imputer -> assembler -> classifier as one pipeline.

    ``index_label``: string label indexed by frequency (multi-class); when
    False the label column must already be numeric 0/1 (binary).
    ``vectors``: ML vector columns (name -> size) appended to the assembled
    features as-is; the size hint lets the assembler keep invalid rows.
    ``key`` (forest only): column that tells rows apart.  The forest then
    depends neither on partitions nor on order, so the rows need no dealing,
    and none are persisted: the input is read once for each of the label's
    and the categories' vocabulary, means, cuts (twice) and bins."""
    params = dict(params or {})
    categorical = list(categorical)
    # Tree learners checkpoint their node ids every ``checkpointInterval``
    # iterations, but only when a checkpoint folder is set: make sure the
    # shared one is, so a lost executor does not replay the whole fit.
    shared_dir(train.sparkSession)
    if key is not None:
        if kind != "rf":
            raise ValueError(f"a row key is for the forest, not {kind!r}")
        return _fit(train, label_col, numeric, categorical, kind, index_label, params, vectors, key)
    # Every stage fit and every tree level / boosting round scans the input:
    # materialise it once (spills to disk when it does not fit in memory;
    # lost blocks are recomputed from lineage if an executor dies).
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _fit(train, label_col, numeric, categorical, kind, index_label, params, vectors)
    finally:
        train.unpersist()


def _fit(train, label_col, numeric, categorical, kind, index_label, params, vectors, key=None):
    label_indexer = None
    labels = None
    data = train
    target = label_col
    if index_label:
        label_indexer = index_stage(label_col, LABEL_INDEX).fit(train)
        labels = list(label_indexer.labels) + [UNKNOWN_LABEL]
        data = label_indexer.transform(train)
        target = LABEL_INDEX
    else:
        data = train.withColumn(label_col, F.col(label_col).cast("double"))
    stages = []
    indexed = [f"{c}_index" for c in categorical]
    n_bins = 32
    if categorical:
        cat_model = index_stage(categorical, indexed).fit(data)
        n_bins = max(len(lab) for lab in cat_model.labelsArray) + 1
        stages.append(cat_model)
    if numeric:
        stages.append(imputer_stage(list(numeric)))
    vectors = dict(vectors or {})
    for name, size in vectors.items():
        stages.append(VectorSizeHint(inputCol=name, size=int(size), handleInvalid="error"))
    stages.append(assembler_stage(list(numeric) + indexed + list(vectors)))
    classifier = _classifier(kind, target, n_bins, params, max(len(labels) - 1, 1) if labels else 2)
    if key is not None:
        classifier.row_key = key
    stages.append(classifier)
    pipe = Pipeline(stages=stages).fit(data)
    return FlowModel(pipe, label_col, labels, label_indexer, list(numeric), categorical)
