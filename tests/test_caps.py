"""No cap, switch or stale copy drops data or changes a result."""

import inspect

import pytest
from pyspark.sql import functions as F

from flowscore import apps
from flowscore.operators import profile as P
from flowscore.operators.retention import evict, retain_newest
from flowscore.plans.standins import _input_signature, stored_predictions
from flowscore.sources.files import read_csv, read_names
from flowscore.streaming.jobs import run_to_end, windowed_counts
from flowscore.streaming.sinks import ParquetBatchSink, latest_per_key


def test_streams_have_no_time_limit_of_their_own():
    assert inspect.signature(run_to_end).parameters["timeout_s"].default is None


def test_newest_batch_stays_beyond_the_cap(spark, tmp_dir):
    sizes = spark.createDataFrame([(0, 5), (1, 900), (2, 500)], "batch_id bigint, bytes bigint")
    assert [r.batch_id for r in retain_newest(sizes, "batch_id", 100).collect()] == [2]
    sink = ParquetBatchSink(tmp_dir + "/p")
    for b in range(2):
        sink(spark.range(100), b)
    assert evict(spark, tmp_dir + "/p", cap_bytes=1) == [0]
    assert spark.read.parquet(tmp_dir + "/p").count() == 100


def test_csv_header_in_another_order_is_an_error(spark, tmp_dir):
    spark.sql("select 1 as b, 2 as a").write.option("header", True).csv(tmp_dir + "/c")
    schema = spark.sql("select 1 as a, 2 as b").schema
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, tmp_dir + "/c", schema=schema).collect()


def test_undecodable_bytes_of_a_name_are_ignored(spark, tmp_dir):
    with open(tmp_dir + "/names.csv", "wb") as f:
        f.write(b"No.,Name\n1,du\xffr\n2,rate\n")
    assert read_names(spark, tmp_dir + "/names.csv") == ["dur", "rate"]


def test_null_source_is_not_the_total(spark):
    df = spark.createDataFrame([("a", 1), (None, 0), (None, 1)], "src string, y int")
    got = {(r.src, r.is_total): r.n_rows for r in P.counts_per_source(df, "src", "y").collect()}
    assert got == {("a", 0): 1, (None, 0): 2, (None, 1): 3}


def test_late_files_count_in_a_backfill(spark, tmp_dir):
    schema = "ts timestamp_ntz, v int"

    def arrive(name, *hours):
        spark.createDataFrame([(h,) for h in hours], "h int").select(
            F.expr("timestampadd(HOUR, h, timestamp_ntz'2024-01-01 00:10:00')").alias("ts"), F.lit(1).alias("v")
        ).write.parquet(f"{tmp_dir}/src/{name}")

    def count():
        stream = spark.readStream.schema(schema).parquet(tmp_dir + "/src/*")
        run = run_to_end(windowed_counts(stream, "ts", "1 hour", None), tmp_dir + "/out", tmp_dir + "/ckpt",
                         output_mode="update")
        return {r.bucket.hour: r.n for r in latest_per_key(spark.read.parquet(run.output), ["bucket"]).collect()}

    arrive("one", 10, 10)
    assert count() == {10: 2}
    arrive("two", 1, 10, 2)
    assert count() == {10: 3, 1: 1, 2: 1}


def test_cache_follows_files_inside_a_folder(spark, tmp_dir):
    table = tmp_dir + "/events.parquet"
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.limit(100).coalesce(1).write.parquet(table)
    before = _input_signature(spark, table)
    assert stored_predictions(spark, tmp_dir).count() == 100
    events.limit(300).coalesce(1).write.mode("append").parquet(table)
    assert _input_signature(spark, table) != before
    assert stored_predictions(spark, tmp_dir).count() == 400


def test_fill_mode_reaches_the_stream_job(spark):
    envelope = spark.createDataFrame([('{"rate": null, "dur": 1.5}',)], "v string").select(
        F.col("v").cast("binary").alias("value"), F.lit("demo").alias("topic"), F.lit(0).alias("partition"),
        F.lit(0).cast("bigint").alias("offset"), F.current_timestamp().alias("timestamp"))
    assert apps.decode_records(envelope, fill="model").first().rate is None
    assert apps.decode_records(envelope, fill="zero").first().rate == 0.0
