"""Tables written to the shared checkpoint folder: they cut lineage and outlive the executors that made them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowscore.session import fresh_dir


def keep(df: DataFrame, kind: str) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back."""
    spark = df.sparkSession
    path = fresh_dir(spark, kind)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def drop(df: DataFrame) -> None:
    """Delete a table made by ``keep`` that no later step reads."""
    delete_path(df.sparkSession, df._scratch_path)


def delete_path(spark: SparkSession, path: str) -> None:
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)
