"""String index of a vocabulary of any size: ranks by (frequency, text) from a range sort, encoded by a join.

The stage of the library holds the vocabulary in the model, and so on the driver and in every task; here it is a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowscore.operators.positions import with_position


def vocabulary(df: DataFrame, column: str, out: str = "index") -> DataFrame:
    """(value, n, index): dense ranks from 0 of the values of ``column``, most frequent first, ties by text.

    Counts are combined before the shuffle; nulls have no index.  No step brings the values to one task or the driver."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    ranked = with_position(counts, F.col("n").desc(), F.col("value").asc(), out="place")
    return ranked.select("value", "n", F.col("place").cast("double").alias(out))


def encode_by_join(df: DataFrame, column: str, vocab: DataFrame, out: str | None = None) -> DataFrame:
    """``df`` with the index of ``column``; unseen values and nulls get one extra last index.

    The vocabulary is joined on (hash of the value, value), which has it shuffled for this join alone, so a value of a
    third of all rows can be split by the skew join."""
    out = out or f"{column}_index"
    size = vocab.agg(F.max("index")).first()[0]
    extra = 0.0 if size is None else size + 1
    right = vocab.select(F.xxhash64("value").alias("__hash_of_value"), F.col("value").alias("__value"),
                         F.col("index").alias("__index"))
    same = (F.xxhash64(F.col(column)) == F.col("__hash_of_value")) & (F.col(column) == F.col("__value"))
    joined = df.join(right, same, "left")
    return joined.withColumn(out, F.coalesce("__index", F.lit(extra))).select(
        *[c for c in df.columns if c != out], out)
