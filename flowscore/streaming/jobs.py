"""Stream jobs: decode -> fill -> score -> documents -> idempotent sink, and
windowed throughput with a watermark."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from flowscore.streaming.sinks import CommittedSink, MultiParquetSink, ParquetBatchSink


@dataclass
class StreamRun:
    query: StreamingQuery
    output: str
    checkpoint: str


def start_sink(df: DataFrame, output: str, checkpoint: str, partition_by: list[str] = (),
               available_now: bool = False, processing_time: str | None = None,
               output_mode: str = "append", name: str | None = None, committed: bool = False) -> StreamRun:
    """Start ``df`` into an idempotent Parquet sink with a durable checkpoint; ``committed``: into one that this
    checkpoint owns and that marks its batches (``CommittedSink``)."""
    sink = CommittedSink(output, checkpoint, list(partition_by)) if committed else ParquetBatchSink(output, list(partition_by))
    writer = (df.writeStream.outputMode(output_mode)
                .option("checkpointLocation", checkpoint)
                .foreachBatch(sink))
    if name:
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return StreamRun(writer.start(), output, checkpoint)


def start_multi_sink(df: DataFrame, outputs: dict, checkpoint: str, available_now: bool = False,
                     processing_time: str | None = None) -> StreamingQuery:
    """Start ``df`` into several idempotent Parquet outputs (one checkpoint)."""
    writer = (df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
                .foreachBatch(MultiParquetSink(outputs)))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def run_to_end(df: DataFrame, output: str, checkpoint: str, partition_by: list[str] = (),
               output_mode: str = "append", timeout_s: int | None = None) -> StreamRun:
    """Process everything available now, then stop (tests and back-fills).

    Waits however long that takes, unless the caller sets ``timeout_s``."""
    run = start_sink(df, output, checkpoint, partition_by, available_now=True,
                     output_mode=output_mode)
    if timeout_s is None:
        run.query.awaitTermination()
    elif not run.query.awaitTermination(timeout_s):
        run.query.stop()
        raise TimeoutError(f"stream did not finish within {timeout_s}s")
    if run.query.exception() is not None:
        raise RuntimeError(str(run.query.exception()))
    return run


_NTZ_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def ntz_as_utc_instant(c: str) -> F.Column:
    """``timestamp_ntz`` wall time -> the ``timestamp`` instant of that wall
    time in UTC, whatever the session time zone (a plain cast reads it in the
    session zone: hour windows would start at :30 in a +5:30 zone and the
    skipped hour of a daylight-saving change would move)."""
    return F.expr(f"timestamp_micros(timestampdiff(MICROSECOND, {_NTZ_EPOCH}, `{c}`))")


def utc_instant_as_ntz(c: F.Column) -> F.Column:
    """Inverse of ``ntz_as_utc_instant``."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), F.expr(_NTZ_EPOCH))


def windowed_counts(stream: DataFrame, ts: str, bucket: str = "1 hour",
                    watermark: str | None = "1 hour") -> DataFrame:
    """Per-bucket counts on a stream, late data bounded by the watermark.

    Without a watermark (back-fills) every row counts whatever the order of
    arrival, and the state is one row per bucket.  Event time needs a
    ``timestamp``: a ``timestamp_ntz`` column is read as
    UTC wall time (independent of the session zone) and the bucket start is
    returned as ``timestamp_ntz`` again."""
    ntz = isinstance(stream.schema[ts].dataType, T.TimestampNTZType)
    event_time = ntz_as_utc_instant(ts) if ntz else F.col(ts)
    t = stream.withColumn("_ts", event_time)
    t = t.withWatermark("_ts", watermark) if watermark else t
    start = utc_instant_as_ntz(F.col("w.start")) if ntz else F.col("w.start")
    return (t.groupBy(F.window("_ts", bucket).alias("w"))
             .agg(F.count(F.lit(1)).alias("n"))
             .select(start.alias("bucket"), "n"))


_TOTALS = T.StructType([T.StructField(c, T.LongType()) for c in ("block", "bucket", "n", "in_block")])
_HELD = T.StructType([T.StructField(c, T.ArrayType(T.LongType())) for c in ("buckets", "counts")])


def _add_up(key, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """Counts of a block's buckets go on from the state; every bucket from the first changed one on comes out."""
    counts = dict(zip(*state.get, strict=True)) if state.exists else {}
    first = None
    for frame in frames:
        for bucket, n in frame["bucket"].value_counts().items():
            counts[int(bucket)] = counts.get(int(bucket), 0) + int(n)
            first = int(bucket) if first is None else min(first, int(bucket))
    order = sorted(counts)
    state.update((order, [counts[b] for b in order]))
    total, rows = 0, []
    for bucket in order:
        total += counts[bucket]
        if first is not None and bucket >= first:
            rows.append((key[0], bucket, counts[bucket], total))
    yield pd.DataFrame(rows, columns=_TOTALS.names)


def live_totals(stream: DataFrame, ts: str, bucket_seconds: int = 3600, buckets_per_block: int = 24) -> DataFrame:
    """(block, bucket, n, in_block) in update mode: each bucket's count so far and the running total within its block.

    State is kept across batches for each block (so many counts as it has buckets), not for the stream as a whole, so
    blocks are counted apart; arrivals may come in any order, an early bucket that grows sends its block's later ones
    again.  ``bucket`` is seconds since 1970 of the bucket's start."""
    ntz = isinstance(stream.schema[ts].dataType, T.TimestampNTZType)
    seconds = F.unix_micros(ntz_as_utc_instant(ts) if ntz else F.col(ts)) / 1_000_000
    start = (F.floor(seconds / bucket_seconds) * bucket_seconds).cast("bigint")
    block = F.floor(start / (bucket_seconds * buckets_per_block)).cast("bigint")
    timed = stream.filter(F.col(ts).isNotNull()).select(block.alias("block"), start.alias("bucket"))
    return timed.groupBy("block").applyInPandasWithState(_add_up, _TOTALS, _HELD, "update", "NoTimeout")


def live_throughput(emitted: DataFrame, factor: float) -> DataFrame:
    """(bucket, n, running_total, spike) as of now, from the rows ``live_totals`` has sent to a sink with batch numbers.

    The newest row of each bucket counts; totals of earlier blocks are a running sum over one row per block.  A spike is
    more than ``factor`` times the mean count of the buckets so far."""
    from flowscore.operators.positions import stored, with_running_sum
    from flowscore.streaming.sinks import latest_per_key
    now = stored(latest_per_key(emitted, ["block", "bucket"]), "live-totals")
    blocks = now.groupBy("block").agg(F.sum("n").alias("total"))
    before = with_running_sum(blocks, F.col("total"), F.col("block").asc(), out="upto").select(
        "block", (F.col("upto") - F.col("total")).alias("before"))
    base = now.agg(F.avg("n")).scalar()
    return now.join(before, "block").select(
        F.timestamp_add("SECOND", F.col("bucket"), F.expr(_NTZ_EPOCH)).alias("bucket"), "n",
        (F.col("in_block") + F.col("before")).alias("running_total"), (F.col("n") > F.lit(factor) * base).alias("spike"))


def without_repeats(stream: DataFrame, ts: str, watermark: str, position: tuple[str, ...] = ("topic", "partition", "offset")
                    ) -> DataFrame:
    """Rows of an at-least-once source once each, by their position in it.

    Positions are remembered until the watermark has passed their time, also over a restart; a row that comes again
    later than that, or late beyond the watermark, is dropped.  The number of surplus rows is in the progress of the
    query (see ``surplus_rows``)."""
    ntz = isinstance(stream.schema[ts].dataType, T.TimestampNTZType)
    timed = stream.withColumn("__time", ntz_as_utc_instant(ts) if ntz else F.col(ts)).withWatermark("__time", watermark)
    return timed.dropDuplicatesWithinWatermark(list(position)).drop("__time")


def surplus_rows(query: StreamingQuery) -> int:
    """Repeated rows that the batches in the query's progress have dropped."""
    return sum(int(op.get("customMetrics", {}).get("numDroppedDuplicateRows", 0))
               for p in query.recentProgress for op in json.loads(p.json).get("stateOperators", []))
