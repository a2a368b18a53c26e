"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowscore.llm.scratch import drop, keep


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One step: link each vertex's larger (or not larger) neighbours to the least vertex around it.

    The least neighbour is a grouped minimum joined back, so a hub of any degree is pre-aggregated and its edges may
    be split between tasks."""
    if large:
        both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
        rows = both.toDF("u", "v")
    else:
        rows = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = rows.groupBy("u").agg(F.min("v").alias("m"))
    near = rows.join(least.withColumn("m", F.least("m", "u")), "u")
    if large:
        out = near.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = near.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("u").alias("a"), F.least("m", "u").alias("b")))
    return out.filter("a <> b").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(vertex, root) for every vertex of ``edges(a, b)``; the root is the component's least vertex.

    Self-links and nulls are ignored.  The number of rounds grows with the logarithm of the number of vertices; the
    driver sees one count and one checksum a round."""
    now = keep(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
               .distinct(), "edges")
    state = _state(now)
    while state[0]:
        after = keep(_stars(_stars(now, True), False), "edges")
        drop(now)
        now, before, state = after, state, _state(after)
        if state == before:
            break
    roots = now.select(F.col("b").alias("vertex")).distinct()
    return now.select(F.col("a").alias("vertex"), F.col("b").alias("root")).union(
        roots.select("vertex", F.col("vertex").alias("root")))
