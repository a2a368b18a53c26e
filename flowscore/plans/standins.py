"""Stand-in data derived by Spark from the given tables.

The flow records of the application are represented by the ``events`` table:
each event becomes a JSON payload in a Kafka-shaped envelope (value, topic,
partition, offset, timestamp), with an unsent ``id`` and a counter
(``stcpb``) that overflows int32, like the real records.  Everything here is
a projection of the tables, so its size grows with them.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowscore.functions.json_codec import decode_json_lenient, json_column
from flowscore.operators.conform import fill_zero
from flowscore.operators.features import index_stage
from flowscore.operators.score import decode_labels, to_documents
from flowscore.operators.zones import with_blooms, zones_of
from flowscore.schema import (STANDIN_COUNTER_FACTOR, STANDIN_FIELDS, TOPIC,
                              TOPIC_PARTITIONS, UNKNOWN_LABEL, numeric_wire_columns)
from flowscore.session import shared_dir
from flowscore.sources.predictions import read_predictions
from flowscore.sources.tables import read_table, table_path
from flowscore.streaming.sinks import rebalanced

# Stand-in vocabularies for the label operators (the event types play the
# role of attack categories; "view" plays the normal class).
EVENT_TYPE_CODES = {"view": 0, "click": 1, "purchase": 2, "signup": 3}
EVENT_TYPE_VOCAB = {"view": 0, "click": 1, "purchase": 2, "signup": 3, "error": 4}
NORMAL_EVENT = "view"

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

RECORD_NUMERIC = numeric_wire_columns(STANDIN_FIELDS)


def payload_columns() -> list[Column]:
    """Fields sent on the wire for one event (``id`` is never sent)."""
    return [F.col("event_id"), F.col("user_id"), F.col("event_type"), F.col("value"),
            (F.col("event_id") * F.lit(STANDIN_COUNTER_FACTOR)).alias("stcpb")]


def envelope(events: DataFrame, payload: Column | None = None) -> DataFrame:
    """Kafka-shaped envelope of the event stream: binary JSON value, topic,
    partition (event_id mod 6), offset (event_id div 6), timestamp."""
    value = json_column(payload_columns()) if payload is None else payload
    return events.select(
        value.cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"),
        F.pmod(F.col("event_id"), F.lit(TOPIC_PARTITIONS)).cast("int").alias("partition"),
        F.expr(f"event_id div {TOPIC_PARTITIONS}").alias("offset"),
        F.col("ts").alias("timestamp"),
    )


def events_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope(read_table(spark, sf_dir, "events"))


MAX_FILES_PER_TRIGGER = 64
PREDICTION_FOLDERS = ["event_date", "attack_type"]
#: Columns the read side asks by, and positions of a file that point reads may ask for.
ZONE_COLUMNS = ["timestamp", "confidence", "kafka_metadata.offset"]
POSITION_BLOOMS = {"kafka_metadata.offset": 1_000_000}


def events_envelope_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same envelope as a stream over the events file(s); a backlog is
    taken in micro-batches of at most ``MAX_FILES_PER_TRIGGER`` files."""
    glob = table_path(sf_dir, "events").replace("events.parquet", "events*.parquet")
    events = (spark.readStream.schema(EVENTS_SCHEMA)
                   .option("maxFilesPerTrigger", MAX_FILES_PER_TRIGGER).parquet(glob))
    return envelope(events)


def missing_by_rule(events: DataFrame) -> DataFrame:
    """Events with missing values made by rule on event_id mod 10:
    value null (0, 1) or NaN (4); user_id null (2); event_type null (3)."""
    r = F.pmod(F.col("event_id"), F.lit(10))
    return events.select(
        "event_id", "ts",
        F.when(r == 2, F.lit(None).cast("bigint")).otherwise(F.col("user_id")).alias("user_id"),
        F.when(r == 3, F.lit(None).cast("string")).otherwise(F.col("event_type")).alias("event_type"),
        F.when(r < 2, F.lit(None).cast("double"))
         .when(r == 4, F.lit(float("nan")))
         .otherwise(F.col("value")).alias("value"),
    )


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded, widened and zero-filled records beside the envelope."""
    rec = decode_json_lenient(events_envelope(spark, sf_dir), STANDIN_FIELDS)
    return fill_zero(rec, RECORD_NUMERIC)


def standin_score(rec: DataFrame) -> DataFrame:
    """Stand-in scorer with a real fitted stage: the event type indexed by
    frequency is the prediction, decoded back with IndexToString; the
    confidence is value / (1 + value), rounded to 6 digits."""
    model = index_stage("event_type", "prediction").fit(rec)
    scored = model.transform(rec)
    scored = decode_labels(scored, list(model.labels) + [UNKNOWN_LABEL])
    return scored.withColumn(
        "confidence", F.round(F.col("value") / (F.lit(1) + F.col("value")), 6))


def prediction_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction documents as the sink produces them (one per event)."""
    return to_documents(standin_score(records(spark, sf_dir)), keep=["event_id"])


def _input_signature(spark: SparkSession, path: str) -> str:
    """Identity of an input within this session: path, length and modification
    time of every file of the table."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    files = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(p, True)
    raw = [spark.sparkContext.applicationId]
    while files.hasNext():
        st = files.next()
        raw.append(f"{st.getPath()}|{st.getLen()}|{st.getModificationTime()}")
    return hashlib.sha1("\n".join([raw[0], *sorted(raw[1:])]).encode()).hexdigest()[:16]


def _written(spark: SparkSession, path: str) -> bool:
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
    return done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done)


def stored_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored predictions table the read side queries.

    Written once per input and session (keyed by the identity of all events
    files) into the shared checkpoint folder, partitioned by date and attack type like the sink's
    output and sorted by time within a file, with Bloom filters on the source position and a zone map beside it; then
    read back: serving queries scan the stored table (filters on the attack type prune folders) instead of re-scoring
    the stream."""
    src = table_path(sf_dir, "events")
    path = shared_dir(spark, "flowscore", "predictions", _input_signature(spark, src))
    if not _written(spark, path):
        docs = rebalanced(prediction_documents(spark, sf_dir), PREDICTION_FOLDERS).sortWithinPartitions(
            *PREDICTION_FOLDERS, "timestamp")
        with_blooms(docs.write.mode("overwrite").partitionBy(*PREDICTION_FOLDERS), POSITION_BLOOMS).parquet(path)
    return read_predictions(spark, path)


def prediction_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zone map of ``stored_predictions``, written once after it."""
    table = stored_predictions(spark, sf_dir)
    src = table_path(sf_dir, "events")
    path = shared_dir(spark, "flowscore", "prediction-zones", _input_signature(spark, src))
    if not _written(spark, path):
        zones_of(table, ZONE_COLUMNS).hint("rebalance").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
