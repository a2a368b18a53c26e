"""Label text <-> code mapping, cleanup and unseen-category bucketing."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowscore.schema import LABEL_CODES, NORMAL_LABEL, UNKNOWN_CATEGORY, UNKNOWN_LABEL


def code_of(c: Column, mapping: dict[str, int] = LABEL_CODES) -> Column:
    """Fixed text -> code lookup; unmapped -> null (a literal map, no join)."""
    lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return lookup[c]


def clean_label(c: Column, mapping: dict[str, int] = LABEL_CODES,
                default: str = NORMAL_LABEL, unknown: str = UNKNOWN_LABEL,
                aliases: dict[str, str] | None = None) -> Column:
    """Missing label -> default; trimmed; ``aliases`` (spelling variant ->
    label, after trimming) applied; known label kept, otherwise ``unknown``.

    (The reference maps unmapped labels to class 0; we keep them apart.)"""
    t = F.coalesce(F.trim(c), F.lit(default))
    if aliases:
        lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable(aliases.items())])
        t = F.coalesce(lookup[t], t)
    return F.when(t.isin(list(mapping)), t).otherwise(F.lit(unknown))


def label_report(df: DataFrame, column: str, mapping: dict[str, int] = LABEL_CODES,
                 default: str = NORMAL_LABEL, aliases: dict[str, str] | None = None) -> DataFrame:
    """One row: how many labels ``clean_label`` takes as they are, fills
    because they are missing, and keeps apart because they are unmapped."""
    raw = F.col(column)
    known = clean_label(raw, mapping, default, aliases=aliases) != UNKNOWN_LABEL
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count_if(raw.isNull()).alias("n_missing"),
                  F.count_if(raw.isNotNull() & known).alias("n_mapped"),
                  F.count_if(raw.isNotNull() & ~known).alias("n_unmapped"))


def bucket_unseen(c: Column, vocabulary: list[str], unknown: str = UNKNOWN_CATEGORY) -> Column:
    """Small fixed vocabulary: value kept when seen, else ``unknown``."""
    return F.when(c.isin(vocabulary), c).otherwise(F.lit(unknown))


def bucket_unseen_join(df: DataFrame, column: str, vocabulary: DataFrame,
                       unknown: str = UNKNOWN_CATEGORY, out: str | None = None) -> DataFrame:
    """Large, data-derived vocabulary: left join on the distinct seen values.

    Both sides are shuffled on the category key (no broadcast of a vocabulary
    that grows with the data); AQE turns it into a broadcast when the
    distinct vocabulary is small at run time.

    The vocabulary is deduplicated on (hash of the key, key): still one row
    per key, but hash-partitioned differently from the join, so the join
    shuffles it again (one row per key, cheap).  A plain ``distinct()``
    would be reused as the join's partitioning, and AQE can only split a
    skewed partition -- a key holding a third of the rows of ``df`` -- when
    both join sides come straight from a shuffle."""
    out = out or column
    seen = F.col(column)
    vocab = (vocabulary.select(F.xxhash64(seen).alias("_h"), seen.alias("_seen"))
                       .distinct().select("_seen"))
    joined = df.join(vocab, df[column] == vocab["_seen"], "left")
    return joined.withColumn(
        out, F.when(F.col("_seen").isNotNull(), F.col(column)).otherwise(F.lit(unknown))
    ).drop("_seen")
