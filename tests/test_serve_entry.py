"""Serving queries, retention eviction, the driver contract, and a fast
oracle comparison of the registered queries on sf0.001."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

from flowscore.operators import serve as S
from flowscore.operators.retention import evict
from flowscore.plans.catalog import QUERIES
from flowscore.sources.tables import TABLES
from flowscore.streaming.sinks import ParquetBatchSink

SF = "/root/testdata/sf0.001"



def _docs(spark):
    from datetime import datetime
    rows = [("DoS", 0.9, datetime(2024, 1, 1, 0, 0, i % 3), ("demo", i % 2, i)) for i in range(10)]
    return spark.createDataFrame(
        rows, "attack_type string, confidence double, timestamp timestamp, "
              "kafka_metadata struct<topic:string,partition:int,offset:bigint>")


def test_topk_ties_are_deterministic(spark):
    d = _docs(spark)
    a = [r.offset for r in S.top_confidence(d, 4).collect()]
    b = [r.offset for r in S.top_confidence(d.repartition(5), 4).collect()]
    assert a == b and len(a) == 4
    assert [r.offset for r in S.by_offset(d, 3).collect()] == [9, 8, 7]
    assert [r.offset for r in S.fetch_first(d, 2).collect()] == [0, 6]


def test_alerts_and_distribution(spark):
    d = _docs(spark).withColumn("attack_type", F.when(F.col("confidence") > 0, "Normal"))
    assert S.alerts(d, "Normal").count() == 0
    assert S.attack_distribution(d).first()["count"] == 10


def test_evict_drops_oldest_batches(spark, tmp_dir):
    sink = ParquetBatchSink(tmp_dir + "/p")
    for b in range(5):
        sink(spark.range(100).withColumn("b", F.lit(b)), b)
    sizes = []
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(tmp_dir + "/p").getFileSystem(
        spark.sparkContext._jsc.hadoopConfiguration())
    for b in range(5):
        sizes.append(fs.getContentSummary(jvm.org.apache.hadoop.fs.Path(f"{tmp_dir}/p/batch_id={b}")).getLength())
    cap = sizes[4] + sizes[3] + 1
    dropped = evict(spark, tmp_dir + "/p", cap_bytes=cap)
    assert sorted(dropped) == [0, 1, 2]
    assert sorted(r.b for r in spark.read.parquet(tmp_dir + "/p").select("b").distinct().collect()) == [3, 4]


def test_contract_shapes():
    from __spark_entry__ import oracle_sql, queries
    q, o = queries(), oracle_sql()
    assert set(o) <= set(q)
    assert set(QUERIES) <= set(o)


def test_entry_runs(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.columns == ["attack_type", "count"]
    assert df.count() > 0


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    return str(v)


FAST = ["decode_kafka_json", "decode_lenient", "quarantine", "encode_json", "fill_missing_zero",
        "conform_schema", "schema_diff", "label_cleanup", "unknown_bucket", "union_by_name",
        "null_profile", "column_profile", "impute_mean", "throughput", "retain_newest_bytes",
        "string_index_multi", "assemble_features", "train_test_split", "accuracy_f1", "auc",
        "top_confidence", "alerts", "counts_per_source", "stream_append"]


# Queries whose results involve event time: they must not depend on the
# session zone, the partition count or adaptive execution (a cluster's
# session may differ from ours).
TIME_QUERIES = ["throughput", "stream_throughput", "latest_predictions", "fetch_first_100",
                "alerts", "first_n_rows"]
OTHER_SESSION = {"spark.sql.session.timeZone": "Asia/Kolkata",
                 "spark.sql.shuffle.partitions": "37",
                 "spark.sql.adaptive.enabled": "false"}


@pytest.mark.parametrize("name", TIME_QUERIES)
def test_query_matches_oracle_in_another_session(spark, name):
    before = {k: spark.conf.get(k) for k in OTHER_SESSION}
    for k, v in OTHER_SESSION.items():
        spark.conf.set(k, v)
    try:
        test_query_matches_oracle(spark, name)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, name):
    from __spark_entry__ import oracle_sql, queries
    df = queries()[name](spark, SF)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    order = sorted(df.columns)
    got = sorted("|".join(_norm(r[c]) for c in order) for r in df.collect())
    exp = sorted("|".join(_norm(row[ocols.index(c)]) for c in order) for row in cur.fetchall())
    assert got == exp


def test_since_prunes_date_folders(spark, tmp_dir):
    from datetime import datetime
    rows = [("DoS", 0.5, datetime(2024, 1, d, 12), ("demo", 0, d)) for d in range(1, 11)]
    df = spark.createDataFrame(
        rows, "attack_type string, confidence double, timestamp timestamp_ntz, "
              "kafka_metadata struct<topic:string,partition:int,offset:bigint>")
    df = df.withColumn("event_date", F.to_date("timestamp"))
    df.write.partitionBy("event_date").parquet(tmp_dir + "/p")
    pred = spark.read.parquet(tmp_dir + "/p")
    q = S.latest(pred, 3, since="2024-01-08 00:00:00")
    assert [r.offset for r in q.collect()] == [10, 9, 8]
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "event_date" in plan
    assert [r.offset for r in S.latest(pred, 3).collect()] == [10, 9, 8]


def test_numeric_looking_attack_types_stay_text(spark, tmp_dir):
    from flowscore.sources.predictions import read_predictions
    df = spark.createDataFrame([("0", 1.0), ("1", 0.5)], "attack_type string, confidence double")
    ParquetBatchSink(tmp_dir + "/p", ["attack_type"])(df, 0)
    pred = read_predictions(spark, tmp_dir + "/p")
    assert dict(pred.dtypes)["attack_type"] == "string"
    assert sorted(r.attack_type for r in pred.collect()) == ["0", "1"]
