"""Places of rows in a total order, without a window over the whole table.

Rows are dealt to ranges of the order and sorted within them; a row's place is the number of rows in the ranges before
its own plus its number in the range.  No task holds more than a range, and only one count per range (so many as there
are shuffle partitions) is summed up.  The sorted rows are written to the shared folder first, so a lost executor can't
deal them differently the second time.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowscore.session import fresh_dir

#: Rows of a partition that monotonically_increasing_id can tell apart.
_IN_PARTITION = (1 << 33) - 1


def stored(df: DataFrame, kind: str) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    path = fresh_dir(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _in_ranges(df: DataFrame, order: list[Column]) -> DataFrame:
    """``df`` in sorted ranges: the range and the number in it beside each row.  Equal rows are told apart by their
    number, so many of them are no single range."""
    numbered = stored(df.withColumn("__row", F.monotonically_increasing_id()), "positions-in")
    order = [*order, F.col("__row").asc()]
    ranged = numbered.repartitionByRange(*order).sortWithinPartitions(*order).drop("__row")
    return stored(ranged.withColumns({
        "__range": F.spark_partition_id(),
        "__nth": F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_PARTITION))}), "positions")


def _with_before(df: DataFrame, sums: DataFrame) -> DataFrame:
    """``__before``: the sum of ``__total`` over all earlier ranges, joined on the range (one row for each range)."""
    rows = sorted(sums.collect())
    totals = [r[1] for r in rows]
    before = [0, *accumulate(totals)][:-1] if rows else []
    kind = sums.schema["__total"].dataType.simpleString()
    pairs = [(r[0], b) for r, b in zip(rows, before, strict=True)]
    table = df.sparkSession.createDataFrame(pairs, f"__range int, __before {kind}")
    return df.join(F.broadcast(table), "__range")


def with_position(df: DataFrame, *order: Column, out: str = "position") -> DataFrame:
    """``df`` with each row's place in the order, from 0 without gaps; equal rows get places of their own."""
    ranged = _in_ranges(df, list(order))
    counts = ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("__total"))
    return _with_before(ranged, counts).withColumn(out, F.col("__before") + F.col("__nth")).drop(
        "__range", "__nth", "__before")


def with_running_sum(df: DataFrame, value: Column, *order: Column, out: str = "running_total") -> DataFrame:
    """``df`` with the sum of ``value`` over all rows up to and including each one in the order.

    Within a range the sum is taken in blocks (a window over one block, then over the block totals), so a task sorts
    one block at a time."""
    from pyspark.sql import Window
    ranged = _in_ranges(df.withColumn("__value", value), list(order)).withColumn("__block", F.expr("__nth div 4096"))
    blocks = ranged.groupBy("__range", "__block").agg(F.sum("__value").alias("__in_block"))
    earlier = Window.partitionBy("__range").orderBy("__block")
    prior = blocks.withColumn("__blocks_before", F.sum("__in_block").over(earlier) - F.col("__in_block"))
    in_block = Window.partitionBy("__range", "__block").orderBy("__nth")
    local = ranged.withColumn("__so_far", F.sum("__value").over(in_block))
    joined = local.join(prior.drop("__in_block"), ["__range", "__block"])
    totals = blocks.groupBy("__range").agg(F.sum("__in_block").alias("__total"))
    return _with_before(joined, totals).withColumn(
        out, F.col("__before") + F.col("__blocks_before") + F.col("__so_far")).drop(
        "__range", "__nth", "__block", "__value", "__blocks_before", "__so_far", "__before")
