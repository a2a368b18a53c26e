"""Profiling: value counts, missing values, column profile, shape, per-source counts.

Every profile is ONE aggregation pass with map-side partial aggregation, so a
hot key costs nothing extra; wide profiles are computed in a single ``agg``
and only then stacked into rows (no per-column scans)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def counts_by(df: DataFrame, *columns: str, name: str = "count") -> DataFrame:
    """Count rows per key (nulls kept as their own group)."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(name))


def value_counts(df: DataFrame, column: str, name: str = "count") -> DataFrame:
    """Counts per distinct value, descending; nulls excluded."""
    return (df.where(F.col(column).isNotNull())
              .groupBy(column).agg(F.count(F.lit(1)).alias(name))
              .orderBy(F.desc(name), F.asc(column)))


def label_index_pairs(df: DataFrame, label: str, index: str) -> DataFrame:
    """Count by (label, index), ordered by index."""
    return counts_by(df, label, index).orderBy(index)


def _missing(field: T.StructField) -> F.Column:
    c = F.col(field.name)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def _stack(agg_row: DataFrame, names: list[str], extra: dict[str, list] | None = None,
           value_name: str = "n") -> DataFrame:
    """Turn a one-row, many-column aggregate into (column_name, [extra...], value) rows."""
    extra = extra or {}
    cols = ["column_name", *extra.keys(), value_name]
    args = []
    for i, n in enumerate(names):
        args.append("'{}'".format(n.replace("'", "\\'")))
        for vals in extra.values():
            args.append("'{}'".format(str(vals[i]).replace("'", "\\'")))
        args.append(f"`_v{i}`")
    expr = "stack({}, {}) as ({})".format(len(names), ", ".join(args), ", ".join(cols))
    return agg_row.selectExpr(expr)


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Missing values (null, or NaN for floating columns) per column, one pass."""
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    aggs = [F.count_if(_missing(f)).alias(f"_v{i}") for i, f in enumerate(fields)]
    return _stack(df.agg(*aggs), [f.name for f in fields], value_name="n_missing")


def column_profile(df: DataFrame) -> DataFrame:
    """Type and non-missing count per column, one pass.  Like a pandas
    ``info()``, NaN in a floating column counts as missing (the same rule
    as ``null_profile``; Spark's ``count(col)`` alone would count it)."""
    fields = df.schema.fields
    aggs = [F.count_if(~_missing(f)).alias(f"_v{i}") for i, f in enumerate(fields)]
    return _stack(df.agg(*aggs), [f.name for f in fields],
                  extra={"data_type": [f.dataType.simpleString() for f in fields]},
                  value_name="non_null")


def dataset_shape(df: DataFrame) -> DataFrame:
    """(rows, columns) as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns)).cast("bigint"))


def counts_per_source(df: DataFrame, source: str, label: str) -> DataFrame:
    """Positives / negatives per source and overall (``is_total`` = 1; a null
    source is a group of its own with ``is_total`` = 0)."""
    return (df.rollup(source)
              .agg(F.grouping(source).cast("bigint").alias("is_total"),
                   F.count_if(F.col(label) == 1).alias("n_pos"),
                   F.count_if(F.col(label) == 0).alias("n_neg"),
                   F.count(F.lit(1)).alias("n_rows")))
