"""Event throughput per time bucket with running total and spike flag."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowscore.operators.windows import running_total
from flowscore.schema import SPIKE_FACTOR
from flowscore.session import shared_dir


def bucket_counts(df: DataFrame, ts: str, bucket: str = "1 hour") -> DataFrame:
    """Records per time bucket (map-side partial counts, one shuffle)."""
    return (df.groupBy(F.window(F.col(ts), bucket).alias("w"))
              .agg(F.count(F.lit(1)).alias("n"))
              .select(F.col("w.start").alias("bucket"), "n"))


def throughput(df: DataFrame, ts: str, bucket: str = "1 hour", base: float | None = None,
               factor: float = SPIKE_FACTOR, block: str = "1 day") -> DataFrame:
    """(bucket, n, running_total, spike).

    A bucket is a spike when n > factor x base; ``base`` defaults to the mean
    count per non-empty bucket, evaluated as a scalar subquery over the
    bucket counts.  The running total runs over bucket counts, never raw
    rows, block by block (see ``running_total``)."""
    # The bucket counts (one row per bucket) feed three branches: cut their
    # lineage once in the shared checkpoint folder so the raw events are
    # scanned a single time.
    shared_dir(df.sparkSession)
    counts = bucket_counts(df, ts, bucket).checkpoint(eager=True)
    out = running_total(counts, "bucket", "n", F.window(F.col("bucket"), block).start)
    base_col = counts.agg(F.avg("n")).scalar() if base is None else F.lit(float(base))
    spike = F.col("n") > F.lit(factor) * base_col
    return out.select("bucket", "n", "running_total", spike.alias("spike"))
