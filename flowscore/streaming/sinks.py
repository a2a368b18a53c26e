"""Micro-batch sinks.

``ParquetBatchSink`` is exactly-once by construction: batch ``b`` always
lands in folder ``batch_id=b`` and a re-delivered batch overwrites that
folder instead of appending.  Errors propagate, so a failed batch is NOT
committed to the checkpoint and is re-delivered on restart.  Every write
runs on the executors; nothing is collected to the driver.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter


def rebalanced(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """Group rows by the output folder before a partitioned write.

    Without it every task writes one file into every folder it has rows for
    (tasks x folders small files per batch).  The rebalance is planned by
    AQE: small folders are coalesced into one task, and a folder holding a
    large share of the rows (one attack type) is split into files of the
    advisory size instead of landing in a single task."""
    return df.hint("rebalance", *partition_by) if partition_by else df


@dataclass
class ParquetBatchSink:
    path: str
    partition_by: list[str] = field(default_factory=list)
    rebalance: bool = True

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if self.rebalance:
            batch = rebalanced(batch, self.partition_by)
        w = batch.write.mode("overwrite")
        if self.partition_by:
            w = w.partitionBy(*self.partition_by)
        w.parquet(f"{self.path.rstrip('/')}/batch_id={int(batch_id)}")


@dataclass
class MultiParquetSink:
    """Several idempotent outputs from one micro-batch.

    ``outputs`` maps a folder to (derive function, partition columns).  The
    batch is persisted once so the upstream work (decode, scoring) is not
    repeated per output, and every output lands in its own ``batch_id=b``
    folder, overwritten on replay."""
    outputs: dict

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            for path, (derive, partition_by) in self.outputs.items():
                ParquetBatchSink(path, list(partition_by))(derive(batch), batch_id)
        finally:
            batch.unpersist()


@dataclass
class CommittedSink:
    """Documents of a stream, one folder per batch, committed by a marker and owned by one checkpoint.

    A batch is written to a staging folder, moved into place and then marked as committed: a batch that comes again
    after its mark is not written again, one that was stopped before it replaces what lies there.  An empty batch writes
    nothing.  The first batch notes the id of the stream's checkpoint; a stream with another checkpoint, whose batch
    numbers start anew, is refused instead of overwriting the folder."""
    path: str
    checkpoint: str
    partition_by: list[str] = field(default_factory=list)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        root = hadoop(self.path)
        fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._own(spark, fs, hadoop)
        mark = hadoop(root, f"_commits/{int(batch_id)}")
        if fs.exists(mark) or batch.isEmpty():
            return
        staged, place = hadoop(root, f"_staging/{uuid.uuid4().hex}"), hadoop(root, f"batch_id={int(batch_id)}")
        writer = rebalanced(batch, self.partition_by).write
        (writer.partitionBy(*self.partition_by) if self.partition_by else writer).parquet(str(staged))
        fs.delete(place, True)
        if not fs.rename(staged, place):
            raise OSError(f"could not move batch {batch_id} into {place}")
        fs.create(mark, True).close()

    def _own(self, spark, fs, hadoop) -> None:
        metadata = spark.read.text(f"{self.checkpoint.rstrip('/')}/metadata").collect()
        mine = json.loads("".join(r.value for r in metadata))["id"]
        owners = hadoop(self.path, "_owner")
        if not fs.exists(owners):
            fs.mkdirs(hadoop(owners, mine))
        found = [s.getPath().getName() for s in fs.listStatus(owners)]
        if found != [mine]:
            raise ValueError(f"{self.path} belongs to the stream of another checkpoint")


def latest_per_key(df: DataFrame, keys: list[str], batch_col: str = "batch_id") -> DataFrame:
    """Upsert view of an update-mode sink: for every key the row of the
    newest batch, by a grouped maximum that is combined before the shuffle."""
    rest = [c for c in df.columns if c not in (*keys, batch_col)]
    newest = F.max_by(F.struct(*rest), F.col(batch_col)).alias("_newest")
    return df.groupBy(*keys).agg(newest).select(*keys, "_newest.*")


def document_writer(make_client, database: str, collection: str,
                    key_columns: tuple[str, ...] = ("topic", "partition", "offset"),
                    chunk_rows: int = 1000, replace_op=None):
    """foreachBatch function writing JSON documents to a document store from
    the executors (``foreachPartition``), upserting on the source position so
    a replayed batch does not duplicate.  ``make_client`` builds a client on
    the executor (any client with ``[db][collection]`` and ``close``).

    Upserts go out in bulk, ``chunk_rows`` per round trip, when the collection
    has ``bulk_write``: ``replace_op(key, doc)`` builds one operation (by
    default the client library's ``ReplaceOne`` with upsert).  Otherwise one
    ``replace_one`` per row.  A partition holds at most one chunk in memory."""
    def write(batch: DataFrame, batch_id: int) -> None:
        docs = batch.select(*key_columns, F.to_json(F.struct("*")).alias("_doc"))

        def per_partition(rows):
            import json
            client = make_client()
            try:
                coll = client[database][collection]
                op = replace_op
                if op is None and hasattr(coll, "bulk_write"):
                    try:
                        from pymongo import ReplaceOne
                        op = lambda key, doc: ReplaceOne(key, doc, upsert=True)
                    except ImportError:
                        op = None
                bulk = op is not None and hasattr(coll, "bulk_write")
                pending = []
                for r in rows:
                    key = {k: r[k] for k in key_columns}
                    doc = json.loads(r["_doc"])
                    if not bulk:
                        coll.replace_one(key, doc, upsert=True)
                        continue
                    pending.append(op(key, doc))
                    if len(pending) >= chunk_rows:
                        coll.bulk_write(pending, ordered=False)
                        pending = []
                if pending:
                    coll.bulk_write(pending, ordered=False)
            finally:
                client.close()

        docs.foreachPartition(per_partition)
    return write


def kafka_sink_options(bootstrap: str, topic: str, checkpoint: str, **extra: str) -> dict[str, str]:
    """Options of the Kafka sink; the frame must carry a ``value`` column
    (``to_json(struct(*))``).  Producer settings pass as ``kafka.*``."""
    opts = {"kafka.bootstrap.servers": bootstrap, "topic": topic,
            "checkpointLocation": checkpoint,
            "kafka.acks": "all", "kafka.enable.idempotence": "true",
            "kafka.compression.type": "lz4", "kafka.linger.ms": "20"}
    opts.update({k.replace("__", "."): str(v) for k, v in extra.items()})
    return opts


def console_preview(df: DataFrame, rows: int = 20) -> DataStreamWriter:
    """A separate console query for watching the stream (untruncated)."""
    return (df.writeStream.format("console").outputMode("append")
              .option("truncate", False).option("numRows", rows))
