"""The application jobs on a small fixture shaped like the training table, derived from lineitem."""

import json
import math

import pytest
from pyspark.sql import functions as F

from flowscore import apps
from flowscore.schema import TRAINING_COLUMNS, training_schema
from flowscore.sources.tables import read_table

SF = "/root/testdata/sf0.001"
CATS = ["Normal", "Generic", "Exploits", "DoS"]


def _training_csv(spark, path):
    """Rows of lineitem re-shaped into the 45 training columns."""
    li = read_table(spark, SF, "lineitem").limit(600)
    schema = training_schema()
    exprs = []
    for i, f in enumerate(schema.fields):
        n = f.name
        if n == "id":
            e = F.col("l_orderkey") * 8 + F.col("l_linenumber")
        elif n == "proto":
            e = F.when(F.col("l_linestatus") == "O", "tcp").otherwise("udp")
        elif n == "state":
            e = F.col("l_returnflag")
        elif n == "service":
            e = F.when(F.col("l_tax") > 0.04, "http").otherwise("-")
        elif n == "attack_cat":
            e = F.element_at(F.array(*[F.lit(c) for c in CATS]),
                             (F.col("l_partkey") % 4 + 1).cast("int"))
        elif n == "label":
            e = (F.col("l_partkey") % 4 != 0).cast("int")
        elif n == "rate":
            e = F.when(F.col("l_linenumber") == 1, F.lit(None)).otherwise(F.col("l_discount"))
        else:
            e = (F.col("l_quantity") * (i + 1) + F.col("l_partkey") % 4 * 10)
        exprs.append(e.cast(f.dataType).alias(n))
    li.select(*exprs).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def test_train_score_and_binary(spark, tmp_dir):
    _training_csv(spark, tmp_dir + "/train")
    model, m = apps.train_multiclass(spark, tmp_dir + "/train", tmp_dir + "/rf",
                                     params={"numTrees": 5, "maxDepth": 4})
    assert 0.0 <= m["accuracy"] <= 1.0 and 0.0 <= m["f1"] <= 1.0
    assert model.labels[-1] == "__unknown__" and len(model.features) == 39
    _, mb = apps.train_binary(spark, tmp_dir + "/train", tmp_dir + "/lr", params={"maxIter": 10})
    assert 0.0 <= mb["auc"] <= 1.0
    # scoring sample = training columns without id / attack_cat / label, rate empty
    src = spark.read.option("header", True).schema(training_schema()).csv(tmp_dir + "/train")
    sample = src.drop("id", "attack_cat", "label").withColumn("rate", F.lit(None).cast("string"))
    sample.coalesce(1).write.mode("overwrite").option("header", True).csv(tmp_dir + "/sample")
    pred, by_pred, by_label = apps.score_batch(spark, tmp_dir + "/sample", tmp_dir + "/rf")
    assert pred.count() == src.count()
    assert by_label.agg(F.sum("count")).first()[0] == src.count()


def test_conform_raw_and_publish(spark, tmp_dir):
    raw_names = ["srcip", "sport", "Proto", "sintpkt", "smeansz", "res_bdy_len", "attack_cat", "Label"]
    names = spark.createDataFrame([(n,) for n in raw_names], "Name string")
    names.coalesce(1).write.mode("overwrite").option("header", True).csv(tmp_dir + "/names")
    rows = spark.createDataFrame([("1.2.3.4", "80", "tcp", "0.5", "12", "7", "DoS", "1"),
                                  ("1.2.3.5", "81", "udp", "0.6", "13", "8", None, "0")],
                                 ", ".join(f"c{i} string" for i in range(8)))
    rows.coalesce(1).write.mode("overwrite").option("header", False).csv(tmp_dir + "/raw")
    raw = apps.read_raw(spark, tmp_dir + "/raw", tmp_dir + "/names")
    conf = apps.conform_raw(raw)
    assert conf.columns == [c for c in TRAINING_COLUMNS if c not in ("id", "attack_cat", "label")]
    r = conf.orderBy("sinpkt").first()
    assert r.sinpkt == "0.5" and r.smean == "12" and r.response_body_len == "7"
    assert math.isnan(r.rate) and r.dur == 0
    values = apps.publish(spark, tmp_dir + "/raw", tmp_dir + "/names", out_path=tmp_dir + "/json")
    assert values.count() == 2
    sample = apps.make_sample(spark, tmp_dir + "/raw", tmp_dir + "/names", tmp_dir + "/sample", n=1)
    assert sample.count() == 1


def test_score_stream_end_to_end(spark, tmp_dir):
    """Training CSV -> model; conformed records -> JSON envelope files ->
    stream -> decode -> fill -> score -> sink -> serving queries."""
    from flowscore.operators import serve as S
    from flowscore.sources.stream import file_stream
    from flowscore.sources.predictions import read_predictions

    _training_csv(spark, tmp_dir + "/train")
    apps.train_multiclass(spark, tmp_dir + "/train", tmp_dir + "/rf",
                          params={"numTrees": 3, "maxDepth": 3})
    src = spark.read.option("header", True).schema(training_schema()).csv(tmp_dir + "/train")
    env = apps.encode_json(src.drop("id", "attack_cat", "label")).select(
        F.col("value").cast("binary").alias("value"), F.lit("demo").alias("topic"),
        (F.monotonically_increasing_id() % 6).cast("int").alias("partition"),
        F.monotonically_increasing_id().alias("offset"), F.current_timestamp().alias("timestamp"))
    env.write.mode("overwrite").parquet(tmp_dir + "/in/b0")
    stream = file_stream(spark, tmp_dir + "/in/*", env.schema)
    run = apps.score_stream(spark, stream, tmp_dir + "/rf", tmp_dir + "/pred", tmp_dir + "/ckpt",
                            available_now=True, alerts_path=tmp_dir + "/alerts")
    run.query.awaitTermination(300)
    assert run.query.exception() is None
    pred = read_predictions(spark, tmp_dir + "/pred")
    al = read_predictions(spark, tmp_dir + "/alerts")
    assert al.count() == pred.where(F.col("attack_type") != "Normal").count()
    assert apps.retention(spark, tmp_dir + "/pred", cap_bytes=1 << 40) == []
    assert pred.count() == src.count()
    assert {"attack_type", "confidence", "kafka_metadata", "batch_id", "proto"} <= set(pred.columns)
    dist = S.attack_distribution(pred).collect()
    assert sum(r["count"] for r in dist) == src.count()
    top = S.top_confidence(pred, 5).collect()
    assert len(top) == 5 and top[0].confidence >= top[-1].confidence


def test_console_preview_runs(spark, tmp_dir):
    from flowscore.streaming.sinks import console_preview
    from flowscore.sources.stream import file_stream
    spark.range(3).write.mode("overwrite").parquet(tmp_dir + "/in/a")
    df = file_stream(spark, tmp_dir + "/in/*", spark.range(1).schema)
    q = console_preview(df, 5).option("checkpointLocation", tmp_dir + "/ck").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert q.exception() is None


def test_label_counts_per_file_and_drop_stage(spark, tmp_dir):
    from pyspark.ml import Pipeline
    from flowscore.operators.features import drop_stage
    names = spark.createDataFrame([("srcip",), ("Label",)], "Name string")
    names.coalesce(1).write.mode("overwrite").option("header", True).csv(tmp_dir + "/names")
    for i, rows in enumerate([[("a", "1"), ("b", "0"), ("c", "1")], [("d", "0")]]):
        spark.createDataFrame(rows, "x string, y string").coalesce(1).write.mode("overwrite") \
            .option("header", False).csv(f"{tmp_dir}/raw{i}")
    out = apps.label_counts_per_file(spark, [tmp_dir + "/raw0", tmp_dir + "/raw1"], tmp_dir + "/names")
    got = sorted((r.n_pos, r.n_neg, r.n_rows) for r in out.collect())
    assert got == [(0, 1, 1), (2, 1, 3), (2, 2, 4)]
    df = spark.createDataFrame([(1, 2, 3)], "id int, a int, label int")
    p = Pipeline(stages=[drop_stage(df.columns, ["id", "label"])]).fit(df)
    assert p.transform(df).columns == ["a"]


def test_score_stream_publishes_the_whole_row_into_an_owned_folder(spark, tmp_dir):
    """Indexes, features and probabilities are in the document; another checkpoint may not write there."""
    from flowscore.sources.stream import file_stream
    _training_csv(spark, tmp_dir + "/train")
    model, _ = apps.train_multiclass(spark, tmp_dir + "/train", tmp_dir + "/rf", params={"numTrees": 3, "maxDepth": 3})
    src = spark.read.option("header", True).schema(training_schema()).csv(tmp_dir + "/train")
    env = apps.encode_json(src.drop("id", "attack_cat", "label")).select(
        F.col("value").cast("binary").alias("value"), F.lit("demo").alias("topic"), F.lit(0).alias("partition"),
        F.monotonically_increasing_id().alias("offset"), F.current_timestamp().alias("timestamp"))
    env.write.parquet(tmp_dir + "/in/b0")

    def run(checkpoint):
        stream = file_stream(spark, tmp_dir + "/in/*", env.schema)
        found = apps.score_stream(spark, stream, tmp_dir + "/rf", tmp_dir + "/pred", checkpoint, available_now=True,
                                  whole_row=True, committed=True)
        found.query.awaitTermination(300)

    run(tmp_dir + "/c1")
    rows = spark.read.parquet(tmp_dir + "/pred").collect()
    assert len(rows) == src.count()
    for r in rows[:20]:
        assert abs(sum(r.probability) - 1) < 1e-9 and max(r.probability) == r.confidence
        assert len(r.features) == len(model.features) + len(model.categorical) and r.proto_index is not None
    assert json.loads(spark.read.parquet(tmp_dir + "/pred").toJSON().first())["probability"]
    with pytest.raises(Exception, match="another checkpoint"):
        run(tmp_dir + "/c2")


def test_monitor_stream_flags_spikes(spark, tmp_dir):
    from datetime import datetime, timedelta
    from flowscore.sources.stream import file_stream
    from flowscore.streaming.jobs import run_to_end
    t0 = datetime(2024, 1, 1)
    rows = [(t0 + timedelta(milliseconds=100 * i),) for i in range(50)]  # 10 per second
    rows += [(t0 + timedelta(seconds=2, milliseconds=i),) for i in range(20)]  # burst in second 2
    spark.createDataFrame(rows, "ts timestamp").write.mode("overwrite").parquet(tmp_dir + "/in/a")
    stream = file_stream(spark, tmp_dir + "/in/*", spark.createDataFrame([], "ts timestamp").schema)
    run = run_to_end(apps.monitor_stream(stream, "ts", base_per_bucket=10), tmp_dir + "/o",
                     tmp_dir + "/ck", output_mode="update")
    from flowscore.streaming.sinks import latest_per_key
    res = {r.bucket.second: (r.n, r.spike) for r in latest_per_key(spark.read.parquet(run.output), ["bucket"]).collect()}
    assert res[2] == (30, True) and res[0] == (10, False)


def test_stream_job_quarantines_bad_payloads(spark, tmp_dir):
    from flowscore.sources.stream import file_stream
    _training_csv(spark, tmp_dir + "/train")
    apps.train_multiclass(spark, tmp_dir + "/train", tmp_dir + "/rf",
                          params={"numTrees": 3, "maxDepth": 3})
    src = spark.read.option("header", True).schema(training_schema()).csv(tmp_dir + "/train")
    good = apps.encode_json(src.drop("id", "attack_cat", "label").limit(40))
    bad = spark.createDataFrame([("not json",), (None,), ('{"sbytes": 1',)], "value string")
    env = good.unionByName(bad).select(
        F.col("value").cast("binary").alias("value"), F.lit("demo").alias("topic"),
        F.lit(0).alias("partition"), F.monotonically_increasing_id().alias("offset"),
        F.current_timestamp().alias("timestamp"))
    env.write.mode("overwrite").parquet(tmp_dir + "/in/b0")
    run = apps.score_stream_quarantined(
        spark, file_stream(spark, tmp_dir + "/in/*", env.schema), tmp_dir + "/rf",
        tmp_dir + "/pred", tmp_dir + "/quarantine", tmp_dir + "/ckpt",
        alerts_path=tmp_dir + "/alerts", available_now=True)
    run.query.awaitTermination(300)
    assert run.query.exception() is None
    assert spark.read.parquet(tmp_dir + "/pred").count() == 40
    q = spark.read.parquet(tmp_dir + "/quarantine")
    assert q.count() == 3
    assert sorted(str(r._corrupt_record) for r in q.collect()) == ['None', 'not json', '{"sbytes": 1']


def test_first_n_in_file_order_across_splits(spark, tmp_dir):
    """A file cut into many splits (and a second file): the first n rows
    are the first n lines of the files, in path order."""
    import glob
    from pyspark.sql import types as T
    from flowscore.sources.files import first_n_in_file_order, read_headerless_csv
    scrambled = spark.range(10000).select(((F.col("id") * 7919) % 10000).alias("k"))
    scrambled.coalesce(1).write.option("header", False).csv(tmp_dir + "/a")
    scrambled.limit(10).coalesce(1).write.option("header", False).csv(tmp_dir + "/b")
    files = sorted(glob.glob(tmp_dir + "/a/*.csv")) + sorted(glob.glob(tmp_dir + "/b/*.csv"))
    lines = [int(x) for f in files for x in open(f).read().split()]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = read_headerless_csv(spark, [tmp_dir + "/a", tmp_dir + "/b"], ["k"], {"k": T.LongType()})
        assert df.rdd.getNumPartitions() > 5
        for n in (1, 2000, 10005):
            got = [r.k for r in first_n_in_file_order(df, n).collect()]
            assert got == lines[:n]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
