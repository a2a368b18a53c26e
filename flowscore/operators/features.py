"""Feature stages: string indexing, mean imputation, vector assembly, split.

The ML stages are Spark ML's own (fitted state = vocabulary / means, both
bounded by the number of distinct categories / columns, never by rows)."""

from __future__ import annotations

from pyspark.ml.feature import Imputer, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Multiplicative hash constant (Knuth) split in 16-bit halves so the product
# mod 2^32 is computed in 64-bit arithmetic without overflow for any id.
_MULT = 2654435761
_MULT_HI, _MULT_LO = _MULT >> 16, _MULT & 0xFFFF
_TWO32 = 1 << 32


def index_stage(inputs: list[str] | str, outputs: list[str] | str | None = None,
                order: str = "frequencyDesc", invalid: str = "keep") -> StringIndexer:
    """StringIndexer; frequency-descending with alphabetical ties by default,
    ``order="alphabetAsc"`` for label encoding.  ``invalid="keep"`` puts
    unseen values and nulls into one extra last index."""
    if isinstance(inputs, str):
        return StringIndexer(inputCol=inputs, outputCol=outputs or f"{inputs}_index",
                             stringOrderType=order, handleInvalid=invalid)
    outputs = outputs or [f"{c}_index" for c in inputs]
    return StringIndexer(inputCols=inputs, outputCols=outputs,
                         stringOrderType=order, handleInvalid=invalid)


def imputer_stage(columns: list[str], outputs: list[str] | None = None,
                  strategy: str = "mean") -> Imputer:
    """Mean imputation in place; null and NaN are both missing."""
    return Imputer(inputCols=columns, outputCols=outputs or columns, strategy=strategy)


def assembler_stage(columns: list[str], out: str = "features",
                    invalid: str = "keep") -> VectorAssembler:
    return VectorAssembler(inputCols=columns, outputCol=out, handleInvalid=invalid)


def drop_stage(input_columns: list[str], drop: list[str]) -> SQLTransformer:
    """Pipeline stage that drops columns (a projection Catalyst prunes)."""
    keep = ", ".join(f"`{c}`" for c in input_columns if c not in set(drop))
    return SQLTransformer(statement=f"SELECT {keep} FROM __THIS__")


def vector_as_array(c: str | Column) -> Column:
    """ML vector -> array<double> (JVM function, no Python per row)."""
    return vector_to_array(F.col(c) if isinstance(c, str) else c)


def hash_bucket(key: Column, seed: int = 42) -> Column:
    """(key * 2654435761 + seed) mod 2^32, exact for any 64-bit key."""
    a = F.pmod(key.cast("bigint"), F.lit(_TWO32))
    prod = a * F.lit(_MULT_LO) + F.pmod(a * F.lit(_MULT_HI), F.lit(1 << 16)) * F.lit(1 << 16)
    return F.pmod(prod + F.lit(seed), F.lit(_TWO32))


def split_threshold(fraction: float) -> int:
    return int(fraction * _TWO32)


def train_flag(key: Column, fraction: float = 0.8, seed: int = 42) -> Column:
    """True for the training part.  Depends only on the key, so the split is
    the same whatever the partitioning (randomSplit is not)."""
    return hash_bucket(key, seed) < F.lit(split_threshold(fraction))


def train_test_split(df: DataFrame, key: str, fraction: float = 0.8,
                     seed: int = 42) -> tuple[DataFrame, DataFrame]:
    flag = train_flag(F.col(key), fraction, seed)
    return df.where(flag), df.where(~flag)
