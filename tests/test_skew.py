"""A key holding a third of all rows: the join and the partitioned write
split it instead of sending it to one task.  AQE's size thresholds are
scaled down so the small test data counts as skewed."""

import contextlib
import os

from pyspark.sql import functions as F

from flowscore.functions.labels import bucket_unseen_join
from flowscore.streaming.sinks import ParquetBatchSink

SMALL_AQE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.shuffle.partitions": "8",
}


@contextlib.contextmanager
def conf(spark, settings):
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _hot(spark, n=60000):
    """A third of the rows carry key 'hot'; the rest spread over 2,000 keys."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
        F.concat(F.lit("k"), (F.col("id") % 2000).cast("string")))
    return spark.range(n).select("id", key.alias("key"))


def test_hot_key_join_is_split_and_exact(spark):
    with conf(spark, SMALL_AQE):
        probe = _hot(spark)
        seen = probe.where(F.col("id") % 5 != 1)          # 'k1', 'k6', ... never seen
        out = bucket_unseen_join(probe, "key", seen).groupBy("key").count()
        rows = out.collect()
        final = out._jdf.queryExecution().executedPlan().toString()  # after the run
    got = {r.key: r["count"] for r in rows}
    assert got["hot"] == 20000
    assert got["Unknown"] == probe.where(F.col("key").isin(
        [f"k{i}" for i in range(2000) if i % 5 == 1])).count()
    assert sum(got.values()) == 60000
    assert "isFinalPlan=true" in final and "SortMergeJoin(skew=true)" in final, final


def test_hot_folder_is_split_into_files(spark, tmp_dir):
    with conf(spark, SMALL_AQE):
        df = _hot(spark).select("id", F.when(F.col("key") == "hot", "hot")
                                 .otherwise(F.concat(F.lit("t"), (F.col("id") % 4).cast("string")))
                                 .alias("t"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
        ParquetBatchSink(tmp_dir + "/out", ["t"])(df, 0)
    base = tmp_dir + "/out/batch_id=0"
    files = {d: len([f for f in os.listdir(f"{base}/{d}") if f.endswith(".parquet")])
             for d in os.listdir(base) if d.startswith("t=")}
    assert files["t=hot"] > 1
    assert spark.read.parquet(tmp_dir + "/out").count() == 60000
