"""JSON encode / decode of flow records (JVM-side, no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowscore.schema import ENVELOPE_COLUMNS

CORRUPT_COLUMN = "_corrupt_record"


def encode_json(df: DataFrame, columns: list[str] | None = None,
                out: str = "value") -> DataFrame:
    """Row -> one JSON object per row (null fields omitted)."""
    cols = columns or df.columns
    return df.select(F.to_json(F.struct(*[F.col(c) for c in cols])).alias(out))


def json_column(columns: list[str | Column]) -> Column:
    return F.to_json(F.struct(*[F.col(c) if isinstance(c, str) else c for c in columns]))


def decode_json(df: DataFrame, schema: T.StructType, value_col: str = "value",
                keep: list[str] | None = None) -> DataFrame:
    """Parse a binary / string JSON payload with a fixed schema and flatten it
    beside the envelope columns.  PERMISSIVE (the default mode): a malformed
    payload gives a row of nulls, a missing field gives null, an extra field
    is ignored.  No options are passed on purpose: Catalyst prunes the parse
    to the one field a query uses only when ``from_json`` has no options."""
    keep = list(ENVELOPE_COLUMNS if keep is None else keep)
    keep = [c for c in keep if c in df.columns]
    parsed = df.select(
        F.from_json(F.col(value_col).cast("string"), schema).alias("data"),
        *keep,
    )
    return parsed.select("data.*", *keep)


def lenient_long(c: Column) -> Column:
    """Text -> bigint that also accepts "7", "0.0" and values above 2^31-1."""
    return F.coalesce(c.try_cast("bigint"), c.try_cast("double").try_cast("bigint"))


def decode_json_lenient(df: DataFrame, fields: list[tuple[str, str]],
                        value_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Decode every field as text, then cast it leniently to its widened type.

    Integers become bigint (no int32 overflow to null), numbers sent as text or
    with a fraction are recovered, floats become double."""
    as_text = T.StructType([T.StructField(n, T.StringType(), True) for n, _ in fields])
    raw = decode_json(df, as_text, value_col, keep)
    out = []
    for name, code in fields:
        c = F.col(name)
        if code == "i":
            out.append(lenient_long(c).alias(name))
        elif code == "f":
            out.append(c.try_cast("double").alias(name))
        else:
            out.append(c.alias(name))
    extra = [c for c in raw.columns if c not in {n for n, _ in fields}]
    return raw.select(*out, *extra)


def decode_flagged(df: DataFrame, schema: T.StructType, value_col: str = "value",
                   keep: list[str] | None = None) -> DataFrame:
    """One decode pass that keeps every row: the record fields, the envelope,
    ``_corrupt_record`` (raw text of a bad payload) and ``_bad`` (payload null
    or not valid for the schema).  Split it later with ``where(_bad)``."""
    keep = list(ENVELOPE_COLUMNS if keep is None else keep)
    keep = [c for c in keep if c in df.columns]
    with_corrupt = T.StructType(schema.fields + [T.StructField(CORRUPT_COLUMN, T.StringType())])
    text = F.col(value_col).cast("string")
    parsed = df.select(
        F.from_json(text, with_corrupt,
                    {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}).alias("data"),
        text.alias("_payload"), *keep)
    bad = F.col("_payload").isNull() | F.col(f"data.{CORRUPT_COLUMN}").isNotNull()
    return parsed.select(
        *[F.col(f"data.{f.name}") for f in schema.fields], *keep,
        F.coalesce(F.col(f"data.{CORRUPT_COLUMN}"), F.col("_payload")).alias(CORRUPT_COLUMN),
        bad.alias("_bad"))


def decode_with_quarantine(df: DataFrame, schema: T.StructType, value_col: str = "value",
                           keep: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Split a decoded stream into (good rows, quarantined rows).

    A row is quarantined when its payload is null or not valid JSON for the
    schema; the raw text is kept in ``_corrupt_record``."""
    flagged = decode_flagged(df, schema, value_col, keep)
    keep = [c for c in (ENVELOPE_COLUMNS if keep is None else keep) if c in df.columns]
    good = flagged.where(~F.col("_bad")).select(*[f.name for f in schema.fields], *keep)
    bad = flagged.where(F.col("_bad")).select(CORRUPT_COLUMN, *keep)
    return good, bad
