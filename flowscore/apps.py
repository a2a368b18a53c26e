"""End-to-end jobs of the application, one function per job.

  train_multiclass   training CSV -> random forest on attack_cat -> accuracy, F1 -> saved model
  train_binary       training CSV -> logistic regression on label -> AUC -> saved model
  score_batch        scoring CSV -> saved model -> predictions + counts per class
  make_sample        raw headerless CSV + names file -> conformed first-n sample CSV
  publish            raw CSV -> conformed JSON records -> Kafka topic (or any sink)
  score_stream       Kafka / file stream -> decode -> fill -> score -> idempotent sink
  score_stream_quarantined   same, bad payloads to a quarantine table (one decode pass)
  label_counts_per_file   positives / negatives per raw file and overall (one scan)
  monitor_stream     live records per bucket with a watermark and the spike flag
  retention          evict the oldest stored micro-batches beyond the size cap
  serve_*            see ``flowscore.operators.serve`` over ``read_predictions``

Run ``python -m flowscore.apps <job> --help``.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowscore.functions.json_codec import (CORRUPT_COLUMN, decode_flagged, decode_json,
                                            decode_json_lenient, encode_json)
from flowscore.operators.conform import cast_double, conform, fill_zero
from flowscore.operators.evaluate import accuracy_f1, area_under_roc
from flowscore.operators.features import train_test_split, vector_as_array
from flowscore.operators.profile import counts_by, counts_per_source
from flowscore.operators.score import score, to_documents
from flowscore.operators.train import FlowModel, fit_classifier
from flowscore.schema import (CATEGORICAL_COLUMNS, DROPPED_ON_WIRE, EXCLUDED_FROM_FEATURES,
                              NORMAL_LABEL, PREDICTIONS_CAP_BYTES, RAW_RENAMES, SPIKE_FACTOR,
                              TRAINING_COLUMNS, WIRE_FIELDS,
                              numeric_wire_columns,
                              training_schema, wire_v1, wire_v2)
from flowscore.sources.files import (first_n_in_file_order, read_csv, read_headerless_csv,
                                     read_names, write_csv)
from flowscore.operators.retention import evict
from flowscore.operators.serve import alerts
from flowscore.streaming.jobs import StreamRun, start_multi_sink, start_sink, windowed_counts


# Stored predictions: batch_id=<b>/event_date=<d>/attack_type=<t>/  (a
# micro-batch usually spans one or two dates, so this adds few folders).
SINK_PARTITIONS = ["event_date", "attack_type"]


def _numeric_features(df: DataFrame, extra_excluded: list[str] = ()) -> list[str]:
    from flowscore.functions.columns import numeric_columns
    return numeric_columns(df, exclude=list(EXCLUDED_FROM_FEATURES) + list(extra_excluded))


def train_multiclass(spark: SparkSession, csv_path: str, model_path: str | None = None,
                     key: str = "id", params: dict | None = None) -> tuple[FlowModel, dict]:
    """Random forest over attack_cat with the reference settings; indexers for
    proto/state/service, mean imputer, 20 % hold-out by a hash of ``key``."""
    df = read_csv(spark, csv_path, schema=training_schema())
    numeric = _numeric_features(df)
    train, test = train_test_split(df, key)
    model = fit_classifier(train, "attack_cat", numeric, CATEGORICAL_COLUMNS, kind="rf",
                           params=params)
    pred = score(test, model).withColumn("y", F.col("attack_cat"))
    m = accuracy_f1(pred, "y", "prediction_label", digits=15).first()
    metrics = {"accuracy": m.accuracy, "f1": m.f1}
    if model_path:
        model.save(model_path)
    return model, metrics


def train_binary(spark: SparkSession, csv_path: str, model_path: str | None = None,
                 key: str = "id", params: dict | None = None) -> tuple[FlowModel, dict]:
    """Logistic regression on the 0/1 label over the numeric features (the row
    id is excluded, unlike the reference's binary job)."""
    df = read_csv(spark, csv_path, schema=training_schema())
    numeric = _numeric_features(df)
    train, test = train_test_split(df, key)
    model = fit_classifier(train, "label", numeric, kind="lr", index_label=False, params=params)
    pred = score(test, model)
    # class-1 margin of the raw prediction, as the binary evaluator reads it
    scored = pred.withColumn("score", vector_as_array("rawPrediction")[1])
    metrics = {"auc": area_under_roc(scored, "label", "score")}
    if model_path:
        model.save(model_path)
    return model, metrics


def scoring_schema():
    """The scoring sample: training columns without id, attack_cat and label."""
    from pyspark.sql import types as T
    full = training_schema()
    return T.StructType([f for f in full.fields if f.name not in DROPPED_ON_WIRE])


def score_batch(spark: SparkSession, csv_path: str, model_path: str,
                fill: str = "model") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Score a CSV; returns (predictions, counts by prediction, counts by label)."""
    df = cast_double(read_csv(spark, csv_path, schema=scoring_schema()), "rate")
    model = FlowModel.load(model_path)
    pred = score(df, model, fill=fill)
    return (pred.select("prediction", "probability", "prediction_label", "confidence"),
            counts_by(pred, "prediction"), counts_by(pred, "prediction_label"))


def conform_raw(raw: DataFrame) -> DataFrame:
    """Raw-file columns -> training layout: lower-case, exact renames, rate as
    NaN, target order with missing columns as 0, then the columns that are
    never sent (attack_cat, label, id) dropped."""
    return conform(raw, TRAINING_COLUMNS, RAW_RENAMES, nan_columns=["rate"], drop=DROPPED_ON_WIRE)


def read_raw(spark: SparkSession, raw_path, names_path: str,
             file_name: str | None = None) -> DataFrame:
    names = [n.strip().lower() for n in read_names(spark, names_path)]
    return read_headerless_csv(spark, raw_path, names, file_name=file_name)


def label_counts_per_file(spark: SparkSession, raw_paths, names_path: str,
                          label: str = "label") -> DataFrame:
    """Positives / negatives of the 0/1 label per raw file and overall, all
    files in one scan (the label is the last raw column)."""
    raw = read_raw(spark, raw_paths, names_path, file_name="file_name")
    y = raw.select("file_name", F.col(label).try_cast("int").alias(label))
    return counts_per_source(y, "file_name", label)


def monitor_stream(stream: DataFrame, ts: str, base_per_bucket: float, bucket: str = "1 second",
                   watermark: str = "10 seconds", factor: float = SPIKE_FACTOR) -> DataFrame:
    """Live throughput: records per bucket (late rows bounded by the
    watermark) with the spike flag against the configured base rate."""
    counts = windowed_counts(stream, ts, bucket, watermark)
    return counts.withColumn("spike", F.col("n") > F.lit(factor * base_per_bucket))


def make_sample(spark: SparkSession, raw_path: str, names_path: str, out_path: str,
                n: int = 2000) -> DataFrame:
    """First ``n`` rows of the raw file(s) in file order, conformed, written
    as CSV with a header.  A top-n on the rows' file positions, not a scan of
    whatever partition arrives first."""
    raw = read_raw(spark, raw_path, names_path)
    sample = conform_raw(first_n_in_file_order(raw, n))
    write_csv(sample.coalesce(1), out_path, header=True)
    return sample


def publish(spark: SparkSession, raw_path: str, names_path: str, bootstrap: str | None = None,
            topic: str = "demo", out_path: str | None = None) -> DataFrame:
    """Raw CSV -> conformed records -> one JSON value per row.

    With ``bootstrap`` the values are written to Kafka (connector jar needed;
    producer settings acks=all, idempotent, lz4); with ``out_path`` they are
    written as JSON lines.  All files are processed in parallel."""
    values = encode_json(conform_raw(read_raw(spark, raw_path, names_path)))
    if bootstrap:
        (values.write.format("kafka").option("kafka.bootstrap.servers", bootstrap)
               .option("topic", topic).option("kafka.acks", "all")
               .option("kafka.enable.idempotence", "true")
               .option("kafka.compression.type", "lz4").save())
    elif out_path:
        values.write.mode("overwrite").text(out_path)
    return values


def decode_records(envelope: DataFrame, lenient: bool = True, fill: str = "zero") -> DataFrame:
    """Kafka envelope -> flat record + envelope columns; numerics zero-filled
    with ``fill="zero"``, left missing for the fitted imputer with ``"model"``."""
    rec = (decode_json_lenient(envelope, WIRE_FIELDS) if lenient
           else decode_json(envelope, wire_v1()))
    return fill_zero(rec, numeric_wire_columns()) if fill == "zero" else rec


def score_stream(spark: SparkSession, envelope: DataFrame, model_path: str, out_path: str,
                 checkpoint: str, fill: str = "model", trigger: str | None = None,
                 available_now: bool = False, lenient: bool = True,
                 alerts_path: str | None = None, normal_label: str = NORMAL_LABEL,
                 whole_row: bool = False, committed: bool = False):
    """The streaming job: decode -> fill -> score -> documents -> Parquet
    sink partitioned by attack type, exactly once per micro-batch.
    ``whole_row`` publishes indexes, features and probabilities too; ``committed``
    writes into a folder that this checkpoint owns, without empty batches.
    ``fill="model"`` (default) leaves missing numerics to the fitted imputer,
    as batch scoring does; ``fill="zero"`` zero-fills first.  With
    ``alerts_path`` the non-normal predictions are also written there (same
    micro-batch, same batch id)."""
    model = FlowModel.load(model_path)
    rec = decode_records(envelope, lenient, fill)
    keep = [c for c, _ in WIRE_FIELDS]
    docs = to_documents(score(rec, model, fill=fill), keep=keep, whole=whole_row)
    if not alerts_path:
        return start_sink(docs, out_path, checkpoint, partition_by=SINK_PARTITIONS,
                          available_now=available_now, processing_time=trigger, committed=committed)
    if committed:
        raise ValueError("a committed sink has one output; write alerts by a job of their own")
    outputs = {out_path: (lambda b: b, SINK_PARTITIONS),
               alerts_path: (lambda b: alerts(b, normal_label), ["attack_type"])}
    query = start_multi_sink(docs, outputs, checkpoint, available_now, trigger)
    return StreamRun(query, out_path, checkpoint)


class ScoringBatchWriter:
    """foreachBatch body of the quarantining stream job.

    The micro-batch (decoded once, rows flagged ``_bad``) is persisted; bad
    rows go to the quarantine folder, good rows are zero-filled / scored and
    written as documents (and alerts).  Every output is idempotent per
    ``batch_id``; an error fails the batch so it is re-delivered."""

    def __init__(self, model: FlowModel, out_path: str, quarantine_path: str,
                 alerts_path: str | None, fill: str, normal_label: str):
        self.model, self.fill, self.normal = model, fill, normal_label
        self.out, self.quarantine, self.alerts = out_path, quarantine_path, alerts_path

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        from flowscore.schema import ENVELOPE_COLUMNS
        from flowscore.streaming.sinks import ParquetBatchSink
        batch = batch.persist()
        try:
            bad = batch.where(F.col("_bad")).select(CORRUPT_COLUMN, *ENVELOPE_COLUMNS)
            ParquetBatchSink(self.quarantine)(bad, batch_id)
            good = batch.where(~F.col("_bad")).drop("_bad", CORRUPT_COLUMN)
            if self.fill == "zero":
                good = fill_zero(good, numeric_wire_columns())
            keep = [c for c, _ in WIRE_FIELDS]
            docs = to_documents(score(good, self.model, fill="model"), keep=keep).persist()
            try:
                ParquetBatchSink(self.out, SINK_PARTITIONS)(docs, batch_id)
                if self.alerts:
                    ParquetBatchSink(self.alerts, ["attack_type"])(alerts(docs, self.normal), batch_id)
            finally:
                docs.unpersist()
        finally:
            batch.unpersist()


def score_stream_quarantined(spark: SparkSession, envelope: DataFrame, model_path: str,
                             out_path: str, quarantine_path: str, checkpoint: str,
                             fill: str = "model", alerts_path: str | None = None,
                             normal_label: str = NORMAL_LABEL, available_now: bool = False,
                             trigger: str | None = None) -> StreamRun:
    """The streaming job with bad payloads routed to a quarantine table
    instead of being scored as rows of zeros (widened wire schema, so an
    int32 overflow is a value, not a bad row)."""
    model = FlowModel.load(model_path)
    flagged = decode_flagged(envelope, wire_v2())
    writer = (flagged.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
                     .foreachBatch(ScoringBatchWriter(model, out_path, quarantine_path,
                                                      alerts_path, fill, normal_label)))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    return StreamRun(writer.start(), out_path, checkpoint)


def retention(spark: SparkSession, predictions_path: str,
              cap_bytes: int = PREDICTIONS_CAP_BYTES) -> list[int]:
    """Evict the oldest micro-batches of the stored predictions beyond the cap."""
    return evict(spark, predictions_path, "batch_id", cap_bytes)


def main(argv: list[str] | None = None) -> None:
    from flowscore.session import get_session
    from flowscore.sources.stream import kafka_stream
    ap = argparse.ArgumentParser(prog="flowscore.apps")
    sub = ap.add_subparsers(dest="job", required=True)
    t = sub.add_parser("train_multiclass"); t.add_argument("csv"); t.add_argument("model")
    b = sub.add_parser("train_binary"); b.add_argument("csv"); b.add_argument("model")
    s = sub.add_parser("score_batch"); s.add_argument("csv"); s.add_argument("model")
    m = sub.add_parser("make_sample"); m.add_argument("raw"); m.add_argument("names"); m.add_argument("out")
    m.add_argument("--n", type=int, default=2000)
    p = sub.add_parser("publish"); p.add_argument("raw"); p.add_argument("names")
    p.add_argument("--bootstrap"); p.add_argument("--topic", default="demo"); p.add_argument("--out")
    st = sub.add_parser("score_stream"); st.add_argument("bootstrap"); st.add_argument("topic")
    st.add_argument("model"); st.add_argument("out"); st.add_argument("checkpoint")
    st.add_argument("--max-offsets", type=int, default=100000)
    st.add_argument("--alerts")
    r = sub.add_parser("retention"); r.add_argument("predictions")
    r.add_argument("--cap-bytes", type=int, default=PREDICTIONS_CAP_BYTES)
    a = ap.parse_args(argv)
    spark = get_session()
    if a.job == "train_multiclass":
        print(json.dumps(train_multiclass(spark, a.csv, a.model)[1]))
    elif a.job == "train_binary":
        print(json.dumps(train_binary(spark, a.csv, a.model)[1]))
    elif a.job == "score_batch":
        _, by_pred, by_label = score_batch(spark, a.csv, a.model)
        by_pred.show(); by_label.show()
    elif a.job == "make_sample":
        make_sample(spark, a.raw, a.names, a.out, a.n)
    elif a.job == "publish":
        publish(spark, a.raw, a.names, a.bootstrap, a.topic, a.out)
    elif a.job == "score_stream":
        env = kafka_stream(spark, a.bootstrap, a.topic, max_offsets_per_trigger=a.max_offsets)
        score_stream(spark, env, a.model, a.out, a.checkpoint,
                     alerts_path=a.alerts).query.awaitTermination()
    elif a.job == "retention":
        print(json.dumps({"evicted_batches": retention(spark, a.predictions, a.cap_bytes)}))


if __name__ == "__main__":
    main()
