"""Stream sources: Kafka (connector jar needed at run time) and a same-shape
file stream for environments without a broker."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def kafka_options(bootstrap: str, topic: str, starting_offsets: str = "earliest",
                  max_offsets_per_trigger: int | None = None,
                  min_partitions: int | None = None, fail_on_data_loss: bool = True,
                  **extra: str) -> dict[str, str]:
    """Options of the Kafka source.  ``startingOffsets`` applies on the first
    start only; later starts resume from the checkpoint.  The trigger cap
    keeps the first batch after a backlog bounded."""
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic,
            "startingOffsets": starting_offsets,
            "failOnDataLoss": str(fail_on_data_loss).lower()}
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    opts.update({k.replace("__", "."): str(v) for k, v in extra.items()})
    return opts


def kafka_stream(spark: SparkSession, bootstrap: str, topic: str, **kw) -> DataFrame:
    """Kafka envelope stream: key, value (binary), topic, partition, offset,
    timestamp.  Requires the spark-sql-kafka connector on the classpath."""
    return spark.readStream.format("kafka").options(**kafka_options(bootstrap, topic, **kw)).load()


def file_stream(spark: SparkSession, glob: str, schema: T.StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """A directory / glob of files as a stream (the path must be a folder or
    a glob, not a single file); files are picked up in modification order."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(glob)
