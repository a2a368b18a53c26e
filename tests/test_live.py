"""Committed sink, live totals, repeats, vocabulary tables and lines with bad bytes."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from flowscore.operators.features import index_stage
from flowscore.operators.vocabulary import encode_by_join, vocabulary
from flowscore.sources.files import read_headerless_lines, without_bad_bytes
from flowscore.streaming.jobs import live_throughput, live_totals, run_to_end, surplus_rows, without_repeats
from flowscore.streaming.sinks import CommittedSink


def land(spark, path, ids, part):
    spark.createDataFrame([(i, f"p{i % 3}") for i in ids], "id bigint, kind string").coalesce(1).write.parquet(f"{path}/arrival={part}")


def run_committed(spark, src, out, ckpt, schema="id bigint, kind string"):
    stream = spark.readStream.schema(schema).parquet(src + "/*")
    query = stream.writeStream.option("checkpointLocation", ckpt).trigger(availableNow=True).foreachBatch(
        CommittedSink(out, ckpt, ["kind"])).start()
    query.awaitTermination()
    return query


def test_another_checkpoint_is_refused(spark, tmp_dir):
    src, out = tmp_dir + "/src", tmp_dir + "/out"
    land(spark, src, range(6), 1)
    run_committed(spark, src, out, tmp_dir + "/c1")
    land(spark, src, range(6, 9), 2)
    run_committed(spark, src, out, tmp_dir + "/c1")
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(9))
    with pytest.raises(Exception, match="another checkpoint"):
        run_committed(spark, src, out, tmp_dir + "/c2")
    assert spark.read.parquet(out).count() == 9


def test_batches_are_committed_once_and_empty_ones_not_written(spark, tmp_dir):
    out, ckpt = tmp_dir + "/out", tmp_dir + "/c"
    os.mkdir(ckpt)
    with open(ckpt + "/metadata", "w") as f:
        json.dump({"id": "mine"}, f)
    sink = CommittedSink(out, ckpt)
    some = spark.range(5)
    sink(some.limit(0), 0)
    assert not os.path.exists(out + "/batch_id=0") and not os.path.exists(out + "/_commits/0")
    sink(some, 1)
    before = sorted(os.listdir(out + "/batch_id=1"))
    sink(some, 1)
    assert sorted(os.listdir(out + "/batch_id=1")) == before
    # Stopped between the move and the mark: what lies there is replaced.
    os.remove(out + "/_commits/1")
    sink(some, 1)
    assert sorted(os.listdir(out + "/batch_id=1")) != before and spark.read.parquet(out).count() == 5
    assert os.listdir(out + "/_staging") == []


def test_live_totals_for_any_order_of_arrival(spark, tmp_dir):
    rng = random.Random(7)
    seconds = [rng.randrange(0, 4 * 86400) // 1800 * 1800 + rng.randrange(1800) for _ in range(400)]
    rng.shuffle(seconds)
    out, ckpt = tmp_dir + "/out", tmp_dir + "/c"
    for part in range(4):
        rows = [(s,) for s in seconds[part * 100:part * 100 + 100]]
        events = spark.createDataFrame(rows, "s bigint").select(F.timestamp_seconds("s").alias("ts"))
        events.coalesce(2).write.parquet(f"{tmp_dir}/src/arrival={part}")
        stream = spark.readStream.schema("ts timestamp").parquet(tmp_dir + "/src/*")
        run_to_end(live_totals(stream, "ts"), out, ckpt, output_mode="update")
        counts = {}
        for s in seconds[:part * 100 + 100]:
            counts[s // 3600] = counts.get(s // 3600, 0) + 1
        total, want, base = 0, [], sum(counts.values()) / len(counts)
        for b in sorted(counts):
            total += counts[b]
            want.append((counts[b], total, counts[b] > 1.5 * base))
        got = live_throughput(spark.read.parquet(out), 1.5).orderBy("bucket").collect()
        assert [(r.n, r.running_total, r.spike) for r in got] == want


def test_repeats_over_a_restart_are_counted(spark, tmp_dir):
    def send(ids, part):
        rows = spark.createDataFrame([(i,) for i in ids], "i bigint").select(
            F.lit("t").alias("topic"), (F.col("i") % 2).alias("partition"), F.col("i").alias("offset"),
            F.timestamp_seconds(F.col("i")).alias("timestamp"))
        rows.coalesce(1).write.parquet(f"{tmp_dir}/src/arrival={part}")

    out, surplus = tmp_dir + "/out", []
    for part, ids in enumerate(([1, 2, 2, 3], [2, 3, 4, 4, 4], [1, 5])):
        send(ids, part)
        stream = spark.readStream.schema("topic string, partition bigint, offset bigint, timestamp timestamp").parquet(tmp_dir + "/src/*")
        run = run_to_end(without_repeats(stream, "timestamp", "1 day"), out, tmp_dir + "/c")
        surplus.append(surplus_rows(run.query))
    assert sorted(r.offset for r in spark.read.parquet(out).collect()) == [1, 2, 3, 4, 5]
    assert surplus == [1, 4, 1]


def test_vocabulary_is_that_of_the_stage(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice([None, "hot", "hot", "hot", *(f"v{j}" for j in range(50))])) for i in range(2000)]
    df = spark.createDataFrame(rows, "id int, v string").repartition(6)
    ours = {r.id: r.v_index for r in encode_by_join(df, "v", vocabulary(df, "v")).collect()}
    theirs = {r.id: r.v_index for r in index_stage("v").fit(df).transform(df).collect()}
    assert ours == theirs
    other = spark.createDataFrame([(1, "hot"), (2, "new"), (3, None)], "id int, v string")
    assert {r.id: r.v_index for r in encode_by_join(other, "v", vocabulary(df, "v")).collect()} == {1: 0.0, 2: 51.0, 3: 51.0}
    assert [r.v_index for r in encode_by_join(other, "v", vocabulary(df.limit(0), "v")).collect()] == [0.0] * 3


BAD = [b"plain", b"a\xffb", b"\xe2\x28z", b"\xc3", "é�中".encode() + b"\xe4\xb8", b"\xed\xa0\x80x", b"\xf0\x9f\x98\x80\xf0\x9f", b"", b"\xc0\xaf!"]


def test_bad_bytes_are_ignored_as_by_a_lenient_decoder(spark):
    df = spark.createDataFrame([(i, bytearray(b)) for i, b in enumerate(BAD)], "i int, b binary").repartition(2)
    got = df.select("i", without_bad_bytes(F.col("b").cast("string")).alias("s")).orderBy("i").collect()
    assert [r.s for r in got] == [b.decode("utf-8", "ignore") for b in BAD]


def test_lines_with_bad_bytes(spark, tmp_dir):
    with open(tmp_dir + "/a.csv", "wb") as f:
        f.write(b'1,"x, \xff1",2.5\n2,\xc3y,\n')
    from pyspark.sql import types as T
    out = read_headerless_lines(spark, tmp_dir + "/a.csv", ["k", "a b", "v"], {"k": T.IntegerType(), "v": T.DoubleType()}, "file")
    assert [tuple(r) for r in out.orderBy("k").collect()] == [(1, "x, 1", 2.5, "a.csv"), (2, "y", None, "a.csv")]
