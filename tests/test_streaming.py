"""Streaming: availableNow over files, restart without duplicates, failing
sink fails the batch, batch and stream scoring agree."""

import pytest
from pyspark.sql import functions as F

from flowscore.functions.json_codec import decode_json_lenient
from flowscore.operators.conform import fill_zero
from flowscore.operators.features import train_test_split
from flowscore.operators.score import score
from flowscore.operators.train import fit_classifier
from flowscore.plans import standins as SI
from flowscore.schema import STANDIN_FIELDS
from flowscore.sources.stream import file_stream, kafka_options
from flowscore.streaming.jobs import run_to_end
from flowscore.streaming.sinks import ParquetBatchSink, kafka_sink_options, latest_per_key
from flowscore.sources.tables import read_table

SF = "/root/testdata/sf0.001"


def _write_part(spark, src, where, path):
    src.where(where).write.mode("overwrite").parquet(path)


def test_restart_picks_up_only_new_files(spark, tmp_dir):
    ev = read_table(spark, SF, "events")
    _write_part(spark, ev, F.col("event_id") < 500, tmp_dir + "/in/part1")
    stream = lambda: file_stream(spark, tmp_dir + "/in/*", ev.schema)
    run_to_end(stream(), tmp_dir + "/out", tmp_dir + "/ckpt")
    assert spark.read.parquet(tmp_dir + "/out").count() == 500
    _write_part(spark, ev, F.col("event_id") >= 500, tmp_dir + "/in/part2")
    run_to_end(stream(), tmp_dir + "/out", tmp_dir + "/ckpt")
    out = spark.read.parquet(tmp_dir + "/out")
    assert out.count() == ev.count()
    assert out.select("event_id").distinct().count() == ev.count()
    assert out.select("batch_id").distinct().count() == 2


def test_sink_is_idempotent_per_batch(spark, tmp_dir):
    df = spark.range(10)
    sink = ParquetBatchSink(tmp_dir + "/t")
    sink(df, 3)
    sink(df, 3)  # re-delivery of the same batch
    assert spark.read.parquet(tmp_dir + "/t").count() == 10


def test_failing_sink_fails_batch_and_is_redelivered(spark, tmp_dir):
    ev = read_table(spark, SF, "events")
    _write_part(spark, ev, F.lit(True), tmp_dir + "/in/p")
    seen = []

    def bad(batch, batch_id):
        seen.append(batch_id)
        raise RuntimeError("store down")

    q = (file_stream(spark, tmp_dir + "/in/*", ev.schema).writeStream
         .option("checkpointLocation", tmp_dir + "/ckpt").foreachBatch(bad)
         .trigger(availableNow=True).start())
    with pytest.raises(Exception):
        q.awaitTermination(120)
    assert seen == [0]
    run = run_to_end(file_stream(spark, tmp_dir + "/in/*", ev.schema), tmp_dir + "/out",
                     tmp_dir + "/ckpt")
    out = spark.read.parquet(run.output)
    assert out.count() == ev.count()
    assert [r.batch_id for r in out.select("batch_id").distinct().collect()] == [0]


def test_batch_and_stream_scoring_agree(spark, tmp_dir):
    rec = SI.records(spark, SF)
    train, _ = train_test_split(rec, "event_id")
    model = fit_classifier(train, "event_type", ["user_id", "value"], kind="rf",
                           params={"numTrees": 3, "maxDepth": 3})
    batch = score(rec, model, fill="zero").select("event_id", "prediction", "confidence")
    env = SI.events_envelope_stream(spark, SF)
    srec = fill_zero(decode_json_lenient(env, STANDIN_FIELDS), SI.RECORD_NUMERIC)
    scored = score(srec, model, fill="zero").select("event_id", "prediction", "confidence")
    run = run_to_end(scored, tmp_dir + "/out", tmp_dir + "/ckpt")
    stream = spark.read.parquet(run.output).drop("batch_id")
    assert stream.count() == batch.count()
    assert stream.exceptAll(batch).count() == 0


def test_update_mode_upsert_view(spark):
    df = spark.createDataFrame([(1, 5, 0), (1, 7, 1), (2, 3, 0)], "k int, n int, batch_id int")
    got = sorted(tuple(r) for r in latest_per_key(df, ["k"]).collect())
    assert got == [(1, 7), (2, 3)]


def test_kafka_options():
    o = kafka_options("b:9092", "demo", max_offsets_per_trigger=1000, min_partitions=12)
    assert o["subscribe"] == "demo" and o["startingOffsets"] == "earliest"
    assert o["maxOffsetsPerTrigger"] == "1000" and o["minPartitions"] == "12"
    s = kafka_sink_options("b:9092", "demo", "/ckpt")
    assert s["kafka.acks"] == "all" and s["kafka.compression.type"] == "lz4"


def _file_store(root, bulk):
    """A document-store stand-in for the writer test: every call is appended
    as a JSON line to a file of its own under ``root`` (executors run in
    other processes, so state must go through files)."""
    import json
    import os
    import uuid

    class Coll:
        def __init__(self):
            self.path = os.path.join(root, uuid.uuid4().hex + ".jsonl")

        def _log(self, kind, ops):
            with open(self.path, "a") as f:
                f.write(json.dumps({"kind": kind, "ops": ops}) + "\n")

        def replace_one(self, key, doc, upsert=False):
            self._log("one", [[key, doc]])

    class BulkColl(Coll):
        def bulk_write(self, ops, ordered=True):
            self._log("bulk", ops)

    class Client:
        def __init__(self):
            self.coll = BulkColl() if bulk else Coll()

        def __getitem__(self, name):
            return self if name == "db" else self.coll

        def close(self):
            pass

    return Client


@pytest.mark.parametrize("bulk", [True, False])
def test_document_writer_upserts_every_row_once(spark, tmp_dir, bulk):
    import glob
    import json
    from flowscore.streaming.sinks import document_writer
    ev = read_table(spark, SF, "events")
    env = SI.envelope(ev).select("topic", "partition", "offset",
                                 F.col("value").cast("string").alias("payload")).repartition(3)
    write = document_writer(_file_store(tmp_dir, bulk), "db", "predictions", chunk_rows=100,
                            replace_op=lambda key, doc: [key, doc])
    write(env, 0)
    calls = [json.loads(line) for p in glob.glob(tmp_dir + "/*.jsonl") for line in open(p)]
    keys = [tuple(k[c] for c in ("topic", "partition", "offset")) for c in calls for k, _ in c["ops"]]
    assert len(keys) == len(set(keys)) == ev.count()
    assert {c["kind"] for c in calls} == ({"bulk"} if bulk else {"one"})
    if bulk:
        assert max(len(c["ops"]) for c in calls) == 100
        assert len(calls) < ev.count() / 50


def test_partitioned_sink_writes_few_files_per_folder(spark, tmp_dir):
    """The rebalance before a partitioned write: tasks x folders files
    without it, one file per folder at this size with it."""
    import os
    ev = read_table(spark, SF, "events").repartition(6)
    for rebalance, out in ((False, tmp_dir + "/plain"), (True, tmp_dir + "/rebalanced")):
        ParquetBatchSink(out, ["event_type"], rebalance=rebalance)(ev, 0)
        base = out + "/batch_id=0"
        files = {d: [f for f in os.listdir(f"{base}/{d}") if f.endswith(".parquet")]
                 for d in os.listdir(base) if d.startswith("event_type=")}
        assert spark.read.parquet(out).count() == ev.count()
        if rebalance:
            assert all(len(f) == 1 for f in files.values())
        else:
            assert max(len(f) for f in files.values()) == 6


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata", "America/New_York"])
def test_windowed_counts_ignore_session_time_zone(spark, tmp_dir, zone):
    """timestamp_ntz buckets equal the hour of the wall time in any session
    zone (a +5:30 zone, a daylight-saving zone)."""
    from flowscore.streaming.jobs import windowed_counts
    ev = read_table(spark, SF, "events")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        stream = file_stream(spark, SF + "/events*.parquet", ev.schema)
        run = run_to_end(windowed_counts(stream, "ts"), tmp_dir + "/out", tmp_dir + "/ckpt",
                         output_mode="update")
        got = latest_per_key(spark.read.parquet(run.output), ["bucket"])
        want = (ev.groupBy(F.window("ts", "1 hour").start.alias("bucket"))
                  .agg(F.count(F.lit(1)).alias("n")))
        assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in want.schema]
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_document_writer_falls_back_without_client_library(spark, tmp_dir):
    """bulk_write available but no operation builder and no client library
    installed: per-row upserts, every row once."""
    import glob
    import importlib.util
    import json
    from flowscore.streaming.sinks import document_writer
    if importlib.util.find_spec("pymongo") is not None:
        pytest.skip("client library installed: the default bulk operation is used")
    ev = read_table(spark, SF, "events")
    env = SI.envelope(ev).select("topic", "partition", "offset")
    document_writer(_file_store(tmp_dir, bulk=True), "db", "predictions")(env, 0)
    calls = [json.loads(line) for p in glob.glob(tmp_dir + "/*.jsonl") for line in open(p)]
    assert {c["kind"] for c in calls} == {"one"} and len(calls) == ev.count()
