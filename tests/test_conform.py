"""Conform, rename, fill, cast, schema diff, label operators."""

import math

from pyspark.sql import functions as F

from flowscore.functions.columns import lower_names, numeric_columns, rename_exact, schema_diff
from flowscore.functions.labels import bucket_unseen, bucket_unseen_join, clean_label, code_of
from flowscore.operators.conform import (cast_double, conform, derive_label, fill_zero,
                                         shared_columns)
from flowscore.schema import LABEL_CODES, RAW_RENAMES, TRAINING_COLUMNS, training_features


def test_conform_order_missing_extra_and_nan(spark):
    raw = spark.createDataFrame([(1, None, "x", 9)], "ID int, SINTPKT double, Proto string, junk int")
    out = conform(raw, ["id", "sinpkt", "rate", "proto", "dbytes"], RAW_RENAMES,
                  nan_columns=["rate"], drop=["id"])
    assert out.columns == ["sinpkt", "rate", "proto", "dbytes"]
    r = out.first()
    assert r.sinpkt is None            # existing nulls untouched
    assert math.isnan(r.rate)
    assert r.dbytes == 0               # missing column created with 0


def test_conform_is_idempotent(spark):
    raw = spark.createDataFrame([(1, 2.0)], "A int, B double")
    once = conform(raw, ["a", "b", "c"])
    twice = conform(once, ["a", "b", "c"])
    assert once.collect() == twice.collect() and once.columns == twice.columns


def test_rename_is_exact_not_substring(spark):
    df = spark.createDataFrame([(1, 2)], "sintpkt int, sintpkt_extra int")
    assert rename_exact(df, RAW_RENAMES).columns == ["sinpkt", "sintpkt_extra"]
    assert lower_names(spark.createDataFrame([(1,)], "AbC int")).columns == ["abc"]


def test_fill_zero_numeric_only(spark):
    df = spark.createDataFrame([(None, float("nan"), None, 5)], "a int, b double, s string, partition int")
    r = fill_zero(df, ["a", "b", "s"]).first()
    assert (r.a, r.b, r.s, r.partition) == (0, 0.0, None, 5)


def test_cast_double_is_lenient(spark):
    df = spark.createDataFrame([("1.5",), ("n/a",), (None,)], "rate string")
    assert [r.rate for r in cast_double(df, "rate").collect()] == [1.5, None, None]


def test_derive_label_and_numeric_columns(spark):
    df = spark.createDataFrame([(1, "DoS", 1, 2.0)], "id int, attack_cat string, label int, x double")
    out = derive_label(df, "attack_cat")
    assert out.first().label == "DoS"
    assert numeric_columns(out, exclude=["label", "id"]) == ["x"]
    assert shared_columns(out, spark.createDataFrame([(1,)], "X int")).columns == ["x"]


def test_training_feature_list():
    feats = training_features()
    assert len(feats) == 39 and "id" not in feats and "proto" not in feats
    assert len(TRAINING_COLUMNS) == 45


def test_schema_diff(spark):
    a = spark.createDataFrame([(1, 2)], "ID int, x int")
    b = spark.createDataFrame([(1, 2)], "id int, y int")
    got = {(r.column_name, r.side) for r in schema_diff(spark, a, b).collect()}
    assert got == {("id", "both"), ("x", "left"), ("y", "right")}


def test_label_code_cleanup_unknown(spark):
    df = spark.createDataFrame([("DoS",), (" Worms ",), (None,), ("dos",), ("Backdoors",)], "l string")
    out = df.select(clean_label(F.col("l")).alias("c")).select("c", code_of(F.col("c")).alias("k"))
    rows = [(r.c, r.k) for r in out.collect()]
    assert rows == [("DoS", 4), ("Worms", 9), ("Normal", 0), ("__unknown__", None),
                    ("__unknown__", None)]
    assert LABEL_CODES["Normal"] == 0 and len(LABEL_CODES) == 10


def test_label_aliases_fold_spelling_variants(spark):
    df = spark.createDataFrame([(" Backdoors",), ("Backdoor",), ("Backdors",), (None,)], "l string")
    lab = clean_label(F.col("l"), aliases={"Backdoors": "Backdoor"})
    assert [r.c for r in df.select(lab.alias("c")).collect()] == \
        ["Backdoor", "Backdoor", "__unknown__", "Normal"]


def test_unseen_bucket_both_forms(spark):
    df = spark.createDataFrame([("tcp",), ("udp",), ("sctp",)], "proto string")
    small = [r.p for r in df.select(bucket_unseen(F.col("proto"), ["tcp", "udp"]).alias("p")).collect()]
    assert small == ["tcp", "udp", "Unknown"]
    vocab = spark.createDataFrame([("tcp",), ("udp",), ("tcp",)], "proto string")
    big = sorted(r.proto for r in bucket_unseen_join(df, "proto", vocab).collect())
    assert big == ["Unknown", "tcp", "udp"]
