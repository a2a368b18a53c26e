"""A computed column beside whatever columns a table has, and rows left out by their text: the row travels as one struct,
so no name can clash."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowscore.llm.held import released

#: Rows computed at once.
SLICE_ROWS = 512


def named(name: str) -> Column:
    """A column by its exact name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_key(text: Column) -> Column:
    """Stands for a text wherever a verdict hangs on the text alone: its SHA-256, null for none."""
    return F.unhex(F.sha2(text.cast("string"), 256))


def without_texts(docs: DataFrame, text_col: str, gone: DataFrame) -> DataFrame:
    """``docs`` but for the rows whose text's key is in column ``key`` of ``gone``; rows without a text stay.

    No copy of the documents is written; few keys are broadcast."""
    rows = docs.select(F.struct(*[named(c).alias(c) for c in docs.columns]).alias("doc"),
                       text_key(named(text_col)).alias("key"))
    return rows.join(gone, "key", "left_anti").select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])


def with_computed(df: DataFrame, inputs: list[Column], out: dict[str, T.DataType],
                  make: Callable[[], Callable[[list[pa.Array]], list[pa.Array]]],
                  columns: list[str] | None = None) -> DataFrame:
    """``columns`` (default: all) of ``df`` with the columns ``out`` added; columns of these names are replaced.

    ``make()`` runs once in each task and gives a function from the arrays of ``inputs`` to the arrays of ``out``, called
    for a few hundred rows at a time."""
    kept = [c for c in (df.columns if columns is None else columns) if c not in out]
    row = F.struct(*[named(c).alias(c) for c in kept]) if kept else F.lit(None).cast("string")
    packed = df.select(row.alias("row"), *[c.alias(f"in{i}") for i, c in enumerate(inputs)])
    schema = T.StructType([packed.schema["row"], *[T.StructField(f"out{i}", t) for i, t in enumerate(out.values())]])

    def run(batches):
        compute = make()
        for batch in released(batches):
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                yield pa.RecordBatch.from_arrays([part.column(0), *compute(part.columns[1:])], names=schema.names)

    done = packed.mapInArrow(run, schema)
    return done.select(*[F.col("row").getField(c).alias(c) for c in kept],
                       *[F.col(f"out{i}").alias(c) for i, c in enumerate(out)])
