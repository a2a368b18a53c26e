"""Read the stored predictions table written by the streaming sink.

The table is partitioned by ``batch_id``, ``event_date`` and ``attack_type``;
filters on any of them prune folders before a file is opened."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Partition columns whose values must stay text even when they look numeric
# (a binary model's labels are "0" / "1").
TEXT_PARTITIONS = ("attack_type",)


def read_predictions(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    if schema is None:
        inferred = spark.read.parquet(path).schema  # footers + folder names only
        schema = T.StructType([
            T.StructField(f.name, T.StringType(), f.nullable) if f.name in TEXT_PARTITIONS else f
            for f in inferred.fields])
    return spark.read.schema(schema).parquet(path)
