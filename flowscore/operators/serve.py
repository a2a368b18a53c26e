"""Queries over stored predictions (the read side).

Top-k queries compile to TakeOrderedAndProject: every partition keeps its
own k best rows and only those are merged, so k -- not the table -- bounds
what reaches one task.  Each order has a total tie-break so the top-k set is
deterministic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAGE_SIZE = 100



def _part():
    return F.col("kafka_metadata.partition")


def _off():
    return F.col("kafka_metadata.offset")


def flat(df: DataFrame) -> DataFrame:
    """Prediction documents with the envelope struct flattened for output."""
    cols = [c for c in df.columns if c != "kafka_metadata"]
    return df.select(*cols, _part().alias("partition"), _off().alias("offset"))


def fetch_first(pred: DataFrame, n: int = PAGE_SIZE) -> DataFrame:
    """First ``n`` documents in insertion order (time, partition, offset)."""
    return flat(pred.orderBy(F.col("timestamp").asc(), _part().asc(), _off().asc()).limit(n))


def _since(pred: DataFrame, since) -> DataFrame:
    """Optional time bound: prunes ``event_date`` folders and, through the
    Parquet min/max statistics, row groups of the timestamp column."""
    if since is None:
        return pred
    bound = F.lit(since).cast("timestamp_ntz")
    return pred.where((F.col("event_date") >= F.to_date(bound)) & (F.col("timestamp") >= bound))


def latest(pred: DataFrame, n: int = PAGE_SIZE, since=None) -> DataFrame:
    """Newest ``n`` documents; with ``since`` only recent folders are read."""
    return flat(_since(pred, since).orderBy(F.col("timestamp").desc(), _part().desc(),
                                            _off().desc()).limit(n))


def top_confidence(pred: DataFrame, n: int = PAGE_SIZE, since=None) -> DataFrame:
    return flat(_since(pred, since).orderBy(F.col("confidence").desc_nulls_last(), F.col("timestamp").desc(),
                             _part().desc(), _off().desc()).limit(n))


def by_attack_type(pred: DataFrame, attack_type: str) -> DataFrame:
    """Filter on the partition column of the stored table -> partition pruning."""
    return flat(pred.where(F.col("attack_type") == F.lit(attack_type)))


def by_offset(pred: DataFrame, n: int = PAGE_SIZE, partition: int | None = None) -> DataFrame:
    """Newest offsets first, optionally for one source partition."""
    q = pred if partition is None else pred.where(_part() == F.lit(partition))
    return flat(q.orderBy(_off().desc(), _part().desc()).limit(n))


def alerts(pred: DataFrame, normal_label: str, since=None) -> DataFrame:
    """Every non-normal prediction as an alert row."""
    return _since(pred, since).where(F.col("attack_type") != F.lit(normal_label)).select(
        F.col("timestamp").alias("created_at"), "attack_type", "confidence",
        _part().alias("partition"), _off().alias("offset"))


def attack_distribution(pred: DataFrame) -> DataFrame:
    return (pred.groupBy("attack_type").agg(F.count(F.lit(1)).alias("count"))
                .orderBy(F.desc("count"), F.asc("attack_type")))


def total_predictions(pred: DataFrame) -> DataFrame:
    return pred.agg(F.count(F.lit(1)).alias("total"))
