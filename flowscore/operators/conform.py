"""Conform raw tables to a target schema; fill, cast, derive and drop columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowscore.functions.columns import lower_names, numeric_columns, rename_exact


def fill_zero(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Fill null and NaN with 0 in numeric columns only; strings stay null.

    ``columns`` restricts the fill to the declared feature columns (envelope
    columns such as partition / offset are never touched)."""
    cols = numeric_columns(df) if columns is None else [c for c in columns if c in numeric_columns(df)]
    return df.fillna(0, subset=cols) if cols else df


def cast_double(df: DataFrame, column: str) -> DataFrame:
    """Lenient cast to double: bad text gives null instead of failing (ANSI)."""
    return df.withColumn(column, F.col(column).try_cast("double"))


def derive_label(df: DataFrame, source: str, out: str = "label") -> DataFrame:
    """String label column derived from ``source`` (replaces ``out``)."""
    return df.withColumn(out, F.col(source).cast("string"))


def drop_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.drop(*columns)


def add_nan_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.lit(float("nan")).cast(T.DoubleType()) for c in columns})


def conform(df: DataFrame, target: list[str], renames: dict[str, str] | None = None,
            nan_columns: list[str] = (), drop: list[str] = (),
            missing_value=0) -> DataFrame:
    """Make a raw table look like the training table.

    lower-case names -> exact renames -> add NaN columns -> keep the target
    columns in target order (extras dropped, missing ones created with
    ``missing_value``; existing nulls untouched) -> drop listed columns.
    One projection: Catalyst prunes the unused raw columns at the scan."""
    out = lower_names(df)
    if renames:
        out = rename_exact(out, renames)
    have = set(out.columns)
    exprs = []
    for c in target:
        if c in drop:
            continue
        if c in nan_columns:
            exprs.append(F.lit(float("nan")).cast(T.DoubleType()).alias(c))
        elif c in have:
            exprs.append(F.col(c))
        else:
            exprs.append(F.lit(missing_value).alias(c))
    return out.select(*exprs)


def shared_columns(left: DataFrame, right: DataFrame) -> DataFrame:
    """Keep the columns of ``left`` that ``right`` also has (case-insensitive)."""
    keep = {c.lower() for c in right.columns}
    return left.select(*[c for c in left.columns if c.lower() in keep])
