"""Column-name operations: lower-case, rename, choose by type, schema diff."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower() for c in df.columns])


def rename_exact(df: DataFrame, renames: dict[str, str]) -> DataFrame:
    """Exact-name renames (not substring replacement)."""
    present = {k: v for k, v in renames.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def numeric_columns(df: DataFrame, exclude: list[str] = ()) -> list[str]:
    """Names of numeric fields minus an exclusion list, in schema order."""
    skip = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def schema_diff(spark: SparkSession, left: DataFrame, right: DataFrame) -> DataFrame:
    """Columns only in ``left``, only in ``right`` and in both (case-insensitive).

    Works on the two schemas; the result has one row per column name."""
    lnames = {c.lower(): c for c in left.columns}
    rnames = {c.lower(): c for c in right.columns}
    rows = []
    for key in sorted(set(lnames) | set(rnames)):
        side = "both" if key in lnames and key in rnames else ("left" if key in lnames else "right")
        rows.append((key, side))
    return spark.createDataFrame(rows, "column_name string, side string")
