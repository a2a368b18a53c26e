"""Softmax boosting: splits by brute force, one model whatever the partitions, held-out accuracy, save and load."""

import json

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from flowscore.operators import boosting as B
from flowscore.operators.score import score
from flowscore.operators.train import FlowModel, fit_classifier


def rows_of(spark, n, classes=4):
    """Classes by two features, a third that says nothing."""
    x = [F.rand(i) for i in (1, 2, 3)]
    df = spark.range(n).select("id", F.array(*x).alias("x"))
    label = F.when(F.col("x")[0] < 0.5, F.when(F.col("x")[1] < 0.3, 0).otherwise(1)).otherwise(
        F.when(F.col("x")[1] < 0.6, 2).otherwise(classes - 1))
    return df.withColumn("label", label.cast("int"))


def test_best_split_is_the_best_of_all():
    rng = np.random.default_rng(5)
    s = B.BoostSettings()
    for _ in range(20):
        g = rng.normal(0, 3, (3, B.BINS))
        h = rng.random((3, B.BINS))
        g[1:] *= g[0].sum() / g[1:].sum(axis=1, keepdims=True)
        h[1:] *= h[0].sum() / h[1:].sum(axis=1, keepdims=True)
        sums = np.rint(np.stack([g, h]) * B.UNIT).astype(np.int64)
        sums[:, 1:, -1] += sums[:, :1].sum(axis=2) - sums[:, 1:].sum(axis=2)
        feature, cut, *_ = B.best_split(sums, s)
        gains = {}
        for f in range(3):
            for c in range(B.BINS - 1):
                gl, hl = (int(x) / B.UNIT for x in sums[:, f, :c + 1].sum(axis=1))
                gr, hr = (int(x) / B.UNIT for x in sums[:, f, c + 1:].sum(axis=1))
                if hl >= 1 and hr >= 1:
                    gains[f, c] = gl ** 2 / (hl + 1) + gr ** 2 / (hr + 1) - (gl + gr) ** 2 / (hl + hr + 1)
        assert abs(gains[feature, cut] - max(gains.values())) < 1e-6


def test_a_round_is_that_of_one_machine(spark):
    """Two rounds of depth 2 against a plain version on all rows."""
    df = rows_of(spark, 400).persist()
    s = B.BoostSettings(rounds=2, depth=2)
    cuts, rounds = B.fit_softmax(df, 4, 3, s)
    data = df.orderBy("id").collect()
    bins, label = B.binned(np.array([r.x for r in data]), cuts), np.array([r.label for r in data])
    margin = np.zeros((len(data), 4))
    for r in rounds:
        p = B.softmax(margin)
        for k in range(4):
            g, h = p[:, k] - (label == k), 2 * p[:, k] * (1 - p[:, k])
            g, h = np.rint(g * B.UNIT).astype(np.int64), np.rint(h * B.UNIT).astype(np.int64)

            def check(rows, node, level):
                assert abs(r.value[k, node] + s.rate * (g[rows].sum() / B.UNIT) / (h[rows].sum() / B.UNIT + s.l2)) < 1e-9
                if level == s.depth:
                    return
                sums = np.zeros((2, 3, B.BINS), dtype=np.int64)
                for f in range(3):
                    np.add.at(sums[0, f], bins[rows, f], g[rows])
                    np.add.at(sums[1, f], bins[rows, f], h[rows])
                feature, cut, *_ = B.best_split(sums, s)
                assert (feature, cut if feature >= 0 else 0) == (r.feature[k, node], r.cut[k, node])
                if feature >= 0:
                    right = bins[rows, feature] > cut
                    check(rows[~right], 2 * node + 1, level + 1)
                    check(rows[right], 2 * node + 2, level + 1)
            check(np.arange(len(data)), 0, 0)
        r.add_to(margin, bins, s.depth)


def test_one_child_of_a_split_is_summed_over_the_rows(spark, monkeypatch):
    """Its sibling comes from the parent: a level of n splits is n sums a task, from no more tasks than cores."""
    df = rows_of(spark, 600).repartition(40).persist()
    levels, plain = [], B._level_splits

    def seen(table, features, classes, since, tree, level, s, counted, before):
        first = (1 << level) - 1
        split = (tree.feature[:, first // 2:first] >= 0).sum() if level else classes
        levels.append((split, counted[:, first:2 * first + 1].sum()))
        out = plain(table, features, classes, since, tree, level, s, counted, before)
        assert "Coalesce" in out._jdf.queryExecution().toString()
        return out

    monkeypatch.setattr(B, "_level_splits", seen)
    B.fit_softmax(df, 4, 3, B.BoostSettings(rounds=2, depth=4))
    assert len(levels) > 4 and all(split == summed for split, summed in levels)
    for most in (0, 1, 1 << 20, 1 << 40):
        sums = np.array([[0, 1, -1, most, 0], [0, -most, 5, 0, 0]])
        at, numbers = B._unpacked(B._packed(sums), 5)
        back = np.zeros_like(sums)
        back[:, at] = numbers
        assert (back == sums).all()


def test_same_model_whatever_the_partitions(spark, monkeypatch):
    monkeypatch.setattr(B, "ROUNDS_PER_WRITE", 2)
    df = rows_of(spark, 600).persist()
    s = B.BoostSettings(rounds=5, depth=3)
    one, many = (B.fit_softmax(d, 4, 3, s) for d in (df.coalesce(1), df.repartition(7)))
    monkeypatch.setattr(B, "ROUNDS_PER_WRITE", 10)
    unwritten = B.fit_softmax(df, 4, 3, s)
    for other in (many, unwritten):
        for a, b in zip(one[1], other[1], strict=True):
            assert (a.feature == b.feature).all() and (a.cut == b.cut).all() and np.allclose(a.value, b.value, atol=1e-12)


def test_pipeline_accuracy_save_and_load(spark, tmp_dir):
    df = rows_of(spark, 1500).select("id", F.concat(F.lit("c"), F.col("label")).alias("label"), array_to_vector("x").alias("v"),
                                     F.when(F.col("id") % 53 != 0, F.col("x")[0]).alias("n"))
    train, test = df.filter("id % 5 > 0"), df.filter("id % 5 = 0")
    model = fit_classifier(train, "label", ["n"], vectors={"v": 3}, kind="softmax", params={"rounds": 8, "depth": 3})
    out = score(test, model).collect()
    assert sum(r.prediction_label == r.label for r in out) / len(out) > 0.95
    for r in out:
        assert abs(sum(r.probability) - 1) < 1e-9 and r.confidence == max(r.probability)
    model.save(tmp_dir + "/m")
    loaded = FlowModel.load(tmp_dir + "/m")
    assert isinstance(loaded.pipeline, PipelineModel)
    again = {r.id: r.confidence for r in score(test, loaded).collect()}
    assert again == {r.id: r.confidence for r in out}


def test_no_rows_and_one_class(spark):
    none = rows_of(spark, 10).limit(0).withColumn("features", array_to_vector("x"))
    model = B.SoftmaxBoost(classes=3).fit(none)
    assert json.loads(model.getOrDefault("trees"))["rounds"] == []
    same = rows_of(spark, 50).withColumn("label", F.lit(0)).withColumn("features", array_to_vector("x"))
    scored = B.SoftmaxBoost(classes=1, settings={"rounds": 2}).fit(same).transform(same)
    assert scored.filter("prediction = 0").count() == 50
    assert model.transform(same).select("probability").first()[0].toArray().tolist() == [1 / 3] * 3
