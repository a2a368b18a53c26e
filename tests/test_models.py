"""Training, scoring, persistence, label decoding."""

import pytest
from pyspark.sql import functions as F

from flowscore.operators.evaluate import multiclass_metrics
from flowscore.operators.features import train_test_split
from flowscore.operators.score import decode_labels, score, to_documents
from flowscore.operators.train import FlowModel, fit_classifier
from flowscore.schema import UNKNOWN_LABEL
from flowscore.sources.tables import read_table

SF = "/root/testdata/sf0.001"


def _lineitem(spark):
    return read_table(spark, SF, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_linestatus", "l_returnflag")


FEATS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@pytest.fixture(scope="module")
def rf_model(spark):
    train, _ = train_test_split(_lineitem(spark), "l_orderkey")
    return fit_classifier(train, "l_returnflag", FEATS, ["l_linestatus"], kind="rf",
                          params={"numTrees": 5, "maxDepth": 4})


def test_rf_labels_include_unknown(rf_model):
    assert rf_model.labels[-1] == UNKNOWN_LABEL
    assert sorted(rf_model.labels[:-1]) == ["A", "N", "R"]


def test_score_outputs_label_and_confidence(spark, rf_model):
    _, test = train_test_split(_lineitem(spark), "l_orderkey")
    out = score(test, rf_model)
    r = out.first()
    assert r.prediction_label in rf_model.labels
    assert 0.0 < r.confidence <= 1.0
    m = multiclass_metrics(out.withColumn("y", F.col("l_returnflag")), "y", "prediction_label")
    assert 0.0 <= m["accuracy"] <= 1.0


def test_unseen_category_and_missing_label_column(spark, rf_model):
    rows = [(1, 1, 5.0, 100.0, 0.1, 0.0, "Z")]
    df = spark.createDataFrame(rows, "l_orderkey bigint, l_linenumber int, l_quantity double, "
                                     "l_extendedprice double, l_discount double, l_tax double, "
                                     "l_linestatus string")
    assert score(df, rf_model).count() == 1  # no label column needed, unseen category kept


def test_extra_class_decodes(spark):
    df = spark.createDataFrame([(0.0,), (2.0,)], "prediction double")
    out = [r.prediction_label for r in decode_labels(df, ["a", "b", UNKNOWN_LABEL]).collect()]
    assert out == ["a", UNKNOWN_LABEL]


def test_fixed_seed_gives_equal_forest_and_save_load(spark, tmp_dir):
    train, test = train_test_split(_lineitem(spark), "l_orderkey")
    kw = dict(kind="rf", params={"numTrees": 5, "maxDepth": 4})
    m1 = fit_classifier(train, "l_returnflag", FEATS, ["l_linestatus"], **kw)
    # Same input, same seed -> same forest.  (Bagging samples per input
    # partition, so the forest also depends on how the input is partitioned;
    # the hash split keeps the train/test membership itself stable.)
    m2 = fit_classifier(train, "l_returnflag", FEATS, ["l_linestatus"], **kw)
    p1 = [r.prediction for r in score(test, m1).orderBy("l_orderkey", "l_linenumber").collect()]
    p2 = [r.prediction for r in score(test, m2).orderBy("l_orderkey", "l_linenumber").collect()]
    assert p1 == p2
    m1.save(tmp_dir + "/model")
    m3 = FlowModel.load(tmp_dir + "/model")
    p3 = [r.prediction for r in score(test, m3).orderBy("l_orderkey", "l_linenumber").collect()]
    assert p3 == p1 and m3.labels == m1.labels


def test_fill_modes_differ_only_where_values_are_missing(spark, rf_model):
    rows = [(1, 1, None, 100.0, 0.1, 0.0, "O"), (2, 1, 5.0, 100.0, 0.1, 0.0, "O")]
    df = spark.createDataFrame(rows, "l_orderkey bigint, l_linenumber int, l_quantity double, "
                                     "l_extendedprice double, l_discount double, l_tax double, "
                                     "l_linestatus string")
    a = score(df, rf_model, fill="model").orderBy("l_orderkey").collect()
    b = score(df, rf_model, fill="zero").orderBy("l_orderkey").collect()
    assert a[1].prediction == b[1].prediction
    with pytest.raises(ValueError):
        score(df, rf_model, fill="bad")


def test_binary_lr_and_gbt(spark):
    df = _lineitem(spark).withColumn("y", (F.col("l_returnflag") == "R").cast("int"))
    train, test = train_test_split(df, "l_orderkey")
    for kind in ("lr", "gbt"):
        m = fit_classifier(train, "y", FEATS, ["l_linestatus"], kind=kind, index_label=False,
                           params={"maxIter": 5})
        out = score(test, m)
        assert out.where(F.col("prediction_label").isin("0", "1")).count() == out.count()


def test_documents_layout(spark, rf_model):
    _, test = train_test_split(_lineitem(spark), "l_orderkey")
    env = (test.withColumn("topic", F.lit("demo")).withColumn("partition", F.lit(0))
               .withColumn("offset", F.col("l_orderkey")).withColumn("timestamp", F.current_timestamp()))
    docs = to_documents(score(env, rf_model), keep=["l_orderkey"])
    assert docs.columns == ["l_orderkey", "attack_type", "confidence", "prediction", "timestamp",
                            "event_date", "kafka_metadata"]
    assert docs.select("kafka_metadata.offset").first()[0] is not None


def test_max_bins_grow_with_categories(spark):
    """D15: 300 categories with the reference's 256 bins still fits."""
    rows = [(i, f"c{i % 300}", float(i % 7), "a" if i % 2 else "b") for i in range(1200)]
    df = spark.createDataFrame(rows, "k bigint, cat string, x double, y string")
    m = fit_classifier(df, "y", ["x"], ["cat"], kind="rf", params={"numTrees": 2, "maxDepth": 2})
    assert m.pipeline.stages[-1].getMaxBins() >= 301


def test_binary_features_exclude_row_id(spark, tmp_dir):
    """D8: the row id is never a feature."""
    from flowscore import apps
    from tests.test_apps import _training_csv
    _training_csv(spark, tmp_dir + "/train")
    model, _ = apps.train_binary(spark, tmp_dir + "/train", params={"maxIter": 3})
    assert "id" not in model.features and "label" not in model.features


def test_vocabulary_is_the_fitted_indexer_labels(spark, rf_model):
    train, _ = train_test_split(_lineitem(spark), "l_orderkey")
    seen = sorted(r[0] for r in train.select("l_linestatus").distinct().collect())
    assert sorted(rf_model.vocabulary("l_linestatus")) == seen
    with pytest.raises(KeyError):
        rf_model.vocabulary("l_tax")


def test_node_id_cache_only_for_deep_trees():
    from flowscore.operators.train import _classifier
    assert _classifier("rf", "y", 32, {}).getCacheNodeIds()            # depth 6
    assert _classifier("gbt", "y", 32, {}).getCacheNodeIds()           # default depth 5
    assert not _classifier("gbt", "y", 32, {"maxDepth": 3}).getCacheNodeIds()
    ovr = _classifier("ovr", "y", 32, {"maxDepth": 3})
    assert not ovr.getClassifier().getCacheNodeIds()
    assert _classifier("rf", "y", 32, {"cacheNodeIds": False}).getCacheNodeIds() is False


def test_tree_memory_is_one_fixed_value():
    from flowscore.operators.train import TREE_MEMORY_MB, _tree_exec
    assert _tree_exec({"maxDepth": 6})["maxMemoryInMB"] == TREE_MEMORY_MB
    assert _tree_exec({})["maxMemoryInMB"] == TREE_MEMORY_MB


def test_training_rows_of_a_task_are_bounded(spark):
    from flowscore.sources.tables import FIT_PARTITIONS, FIT_ROWS, for_fit
    assert for_fit(spark.range(1000), "id").rdd.getNumPartitions() == FIT_PARTITIONS
    rows = 3 * FIT_PARTITIONS * FIT_ROWS + 1
    assert for_fit(spark.range(rows), "id").rdd.getNumPartitions() == 3 * FIT_PARTITIONS + 1
