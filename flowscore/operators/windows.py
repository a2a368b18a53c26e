"""Distributed running totals.

A window with ORDER BY and no PARTITION BY runs in a single task.  To keep a
running total distributed we split the ordered keys into blocks: an in-block
cumulative sum (window partitioned by block) plus the sum of all earlier
blocks (a prefix over the block totals, itself taken range by range), joined
back on the block key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowscore.operators.positions import with_running_sum


def running_total(df: DataFrame, order_col: str, value_col: str, block: Column,
                  out: str = "running_total", descending: bool = False) -> DataFrame:
    """Cumulative sum of ``value_col`` in ``order_col`` order (ties by the
    order column are summed row by row in a stable order of that column).

    ``block`` must be monotone in ``order_col`` (e.g. the day of an hourly
    bucket, or batch_id div 1000)."""
    order = F.col(order_col).desc() if descending else F.col(order_col).asc()
    blocked = df.withColumn("_blk", block)
    in_block = Window.partitionBy("_blk").orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    local = blocked.withColumn("_cum", F.sum(value_col).over(in_block))
    border = F.col("_blk").desc() if descending else F.col("_blk").asc()
    totals = blocked.groupBy("_blk").agg(F.sum(value_col).alias("_bt"))
    # The prefix over the block totals is taken in sorted ranges, so the number of blocks may grow as well.
    prior = with_running_sum(totals, F.col("_bt"), border, out="_upto").select(
        "_blk", (F.col("_upto") - F.col("_bt")).alias("_before"))
    return (local.join(prior, "_blk")
                 .withColumn(out, F.col("_cum") + F.col("_before"))
                 .drop("_blk", "_cum", "_before"))
