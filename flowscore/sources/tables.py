"""Parquet tables by name (column pruning and filters reach the scan)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def read_with_file_name(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Several files as one table, each row tagged with its file name."""
    from pyspark.sql import functions as F
    df = spark.read.parquet(*paths)
    return df.withColumn("file_name", F.col("_metadata.file_name"))


#: Least partitions of a model's training input, and rows of one beyond that (the count follows from the number of
#: rows alone, so the same data and seed give the same model on every cluster, and a task's rows are bounded).
FIT_PARTITIONS = 32
FIT_ROWS = 1 << 17


def for_fit(df: DataFrame, *keys: str, partitions: int | None = None) -> DataFrame:
    """Training rows dealt by a hash of their key and ordered by it, so a fit
    doesn't depend on files, splits or cores."""
    if partitions is None:
        partitions = max(FIT_PARTITIONS, -(-df.count() // FIT_ROWS))
    return df.repartition(partitions, *keys).sortWithinPartitions(*keys)
