"""Profiling, features, evaluation, running totals: Spark vs brute force."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from flowscore.operators import profile as P
from flowscore.operators.evaluate import accuracy_f1, area_under_roc
from flowscore.operators.features import (hash_bucket, imputer_stage, index_stage, train_flag,
                                          train_test_split)
from flowscore.operators.monitor import throughput
from flowscore.operators.retention import retain_newest
from flowscore.operators.windows import running_total


def test_value_counts_and_pairs(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "x string")
    assert [(r.x, r["count"]) for r in P.value_counts(df, "x").collect()] == [("a", 2), ("b", 1)]
    idx = index_stage("x", "i").fit(df).transform(df)
    pairs = [(r.x, r.i, r["count"]) for r in P.label_index_pairs(idx, "x", "i").collect()]
    assert pairs == [("a", 0.0, 2), ("b", 1.0, 1), (None, 2.0, 1)]


def test_null_and_column_profile_one_pass(spark):
    df = spark.createDataFrame([(1, None, "x"), (None, float("nan"), None), (3, 1.0, "y")],
                               "a int, b double, c string")
    nulls = {r.column_name: r.n_missing for r in P.null_profile(df).collect()}
    assert nulls == {"a": 1, "b": 2, "c": 1}
    prof = {r.column_name: (r.data_type, r.non_null) for r in P.column_profile(df).collect()}
    # NaN is missing in both profiles (pandas info() semantics)
    assert prof == {"a": ("int", 2), "b": ("double", 1), "c": ("string", 2)}
    shape = P.dataset_shape(df).first()
    assert (shape.n_rows, shape.n_columns) == (3, 3)
    assert all(prof[c][1] + nulls[c] == shape.n_rows for c in df.columns)


def test_counts_per_source_rollup(spark):
    df = spark.createDataFrame([("f1", 1), ("f1", 0), ("f2", 1)], "src string, y int")
    got = {r.src: (r.n_pos, r.n_neg, r.n_rows) for r in P.counts_per_source(df, "src", "y").collect()}
    assert got == {"f1": (1, 1, 2), "f2": (1, 0, 1), None: (2, 1, 3)}


def test_split_is_exact_disjoint_complete(spark):
    ids = list(range(0, 5000, 7)) + [2**40 + 11, 2**62 + 5]
    df = spark.createDataFrame([(i,) for i in ids], "k bigint")
    got = {r.k: r.h for r in df.select("k", hash_bucket(F.col("k")).alias("h")).collect()}
    for i in ids:
        assert got[i] == (i * 2654435761 + 42) % 2**32
    tr, te = train_test_split(df, "k")
    a, b = {r.k for r in tr.collect()}, {r.k for r in te.collect()}
    assert not a & b and a | b == set(ids)
    frac = len(a) / len(ids)
    assert 0.75 < frac < 0.85
    # independent of partitioning
    again = {r.k for r in df.repartition(7).where(train_flag(F.col("k"))).collect()}
    assert again == a


def test_string_index_orders(spark):
    df = spark.createDataFrame([(v,) for v in "bbaacd"], "x string")
    freq = index_stage("x").fit(df)
    assert list(freq.labels) == ["a", "b", "c", "d"]  # count desc, ties alphabetical
    alpha = index_stage("x", order="alphabetAsc").fit(df)
    assert list(alpha.labels) == ["a", "b", "c", "d"]
    unseen = spark.createDataFrame([("z",), (None,)], "x string")
    assert [r.x_index for r in freq.transform(unseen).collect()] == [4.0, 4.0]


def test_imputer_mean_null_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "v double")
    out = [r.v for r in imputer_stage(["v"]).fit(df).transform(df).collect()]
    assert out == [1.0, 2.0, 2.0, 3.0]


def test_accuracy_f1_matches_brute_force(spark):
    random.seed(3)
    rows = [(random.randint(0, 3), random.randint(0, 3)) for _ in range(300)]
    df = spark.createDataFrame(rows, "y int, z int")
    got = accuracy_f1(df, "y", "z").first()
    n = len(rows)
    acc = sum(y == z for y, z in rows) / n
    f1 = 0.0
    for c in set(y for y, _ in rows):
        tp = sum(1 for y, z in rows if y == c and z == c)
        pred = sum(1 for _, z in rows if z == c)
        sup = sum(1 for y, _ in rows if y == c)
        p = tp / pred if pred else 0.0
        r = tp / sup
        f1 += (2 * p * r / (p + r) if tp else 0.0) * sup / n
    assert got.accuracy == pytest.approx(acc, abs=1e-9)
    assert got.f1 == pytest.approx(f1, abs=1e-9)


def test_auc_exact_with_ties(spark):
    random.seed(5)
    rows = [(random.randint(0, 1), float(random.randint(0, 20))) for _ in range(400)]
    df = spark.createDataFrame(rows, "y int, s double")
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    brute = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert area_under_roc(df, "y", "s") == pytest.approx(brute, abs=1e-12)


@pytest.mark.parametrize("descending", [False, True])
def test_running_total_blocks(spark, descending):
    random.seed(7)
    vals = [(i, random.randint(1, 50)) for i in range(0, 3000, 3)]
    df = spark.createDataFrame(vals, "k bigint, v bigint")
    out = running_total(df, "k", "v", F.floor(F.col("k") / 100), descending=descending)
    got = {r.k: r.running_total for r in out.collect()}
    pdf = pd.DataFrame(vals, columns=["k", "v"]).sort_values("k", ascending=not descending)
    exp = dict(zip(pdf.k, pdf.v.cumsum()))
    assert got == exp


def test_retention_keeps_newest_within_cap(spark):
    sizes = spark.createDataFrame([(b, 10) for b in range(2500)], "batch_id bigint, bytes bigint")
    kept = sorted(r.batch_id for r in retain_newest(sizes, "batch_id", 95, block_batches=4).collect())
    assert kept == list(range(2491, 2500))


def test_throughput_spikes(spark):
    from datetime import datetime, timedelta
    t0 = datetime(2024, 1, 1)
    rows = [(t0 + timedelta(minutes=10 * i),) for i in range(60)]  # 6 per hour
    rows += [(t0 + timedelta(hours=3, seconds=i),) for i in range(20)]  # burst in hour 3
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    out = {r.bucket.hour: (r.n, r.running_total, r.spike) for r in throughput(df, "ts").collect()}
    assert out[3] == (26, 44, True)
    assert out[9] == (6, 80, False)
    assert sum(1 for v in out.values() if v[2]) == 1
