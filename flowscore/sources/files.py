"""CSV sources and sinks with declared schemas (no type-inference pass)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             header: bool = True, encoding: str = "UTF-8") -> DataFrame:
    """CSV with header.  Pass ``schema`` at scale: inference costs a full
    extra scan.  Without one, every column is read as text.  A header whose
    names don't stand in the schema's order is an error, not swapped columns."""
    reader = spark.read.option("header", header).option("encoding", encoding).option("mode", "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", not header)
    return reader.csv(path)


def read_names(spark: SparkSession, dictionary_path: str, name_column: str = "Name",
               encoding: str = "UTF-8") -> list[str]:
    """Column names from the ``Name`` column of a dictionary CSV, in file order.

    The dictionary has one row per column of the raw table (tens of rows), so
    bringing it to the driver is bounded by the schema width, not the data.
    Undecodable bytes are ignored."""
    d = (spark.read.option("header", True).option("encoding", encoding)
              .csv(dictionary_path)
              .withColumn("_pos", F.monotonically_increasing_id()))
    name = F.regexp_replace(F.col(name_column), "\uFFFD", "")
    return [r[0] for r in d.orderBy("_pos").select(name).collect()]


def read_headerless_csv(spark: SparkSession, path: str | list[str], names: list[str],
                        types: dict[str, T.DataType] | None = None,
                        encoding: str = "UTF-8", file_name: str | None = None) -> DataFrame:
    """Headerless CSV (one path, a glob or a list: several files are read as
    one table, in parallel) with names from a dictionary; undecodable bytes
    are replaced by the decoder instead of failing.  ``file_name`` adds the
    source file of each row under that column name."""
    types = types or {}
    schema = T.StructType([T.StructField(n, types.get(n, T.StringType()), True) for n in names])
    paths = [path] if isinstance(path, str) else list(path)
    df = (spark.read.option("header", False).option("encoding", encoding)
               .option("mode", "PERMISSIVE").schema(schema).csv(paths))
    if file_name:
        df = df.withColumn(file_name, F.col("_metadata.file_name"))
    return df


#: Stands for a replacement character of the data itself while bad bytes are taken out (noncharacters, never in text).
_REAL_MARK = "\ufdd0\ufdd1"


def without_bad_bytes(line: Column) -> Column:
    """Text without the byte sequences that are no UTF-8 (raw bytes in a string column); all else stays."""
    shielded = F.replace(line, F.lit("\ufffd"), F.lit(_REAL_MARK))
    valid = F.replace(F.make_valid_utf8(shielded), F.lit("\ufffd"), F.lit(""))
    return F.replace(valid, F.lit(_REAL_MARK), F.lit("\ufffd"))


def read_headerless_lines(spark: SparkSession, path: str | list[str], names: list[str],
                          types: dict[str, T.DataType] | None = None, file_name: str | None = None) -> DataFrame:
    """Headerless CSV like ``read_headerless_csv``, but bytes that can't be decoded are ignored: lines are read raw, bad
    sequences are taken out, then the fields are parsed.  A record is one line (no line ends within quotes)."""
    types = types or {}
    schema = T.StructType([T.StructField(n, types.get(n, T.StringType()), True) for n in names])
    lines = spark.read.text([path] if isinstance(path, str) else list(path))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    parsed = lines.select(F.from_csv(without_bad_bytes(F.col("value")), ddl, {"mode": "PERMISSIVE"}).alias("record"),
                          F.col("_metadata.file_name").alias("file"))
    extra = [F.col("file").alias(file_name)] if file_name else []
    return parsed.select(*[F.col("record").getField(n).alias(n) for n in names], *extra)


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> None:
    """CSV without an index column (one file per partition)."""
    df.write.mode(mode).option("header", header).csv(path)


def first_n(df: DataFrame, n: int, *order: str) -> DataFrame:
    """Deterministic first-n: top-n by the given key (TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(n)


def with_file_position(df: DataFrame) -> DataFrame:
    """Tag each row of a FILE SCAN with its position in the input files:
    (file path, start of the split, increasing id within the task).  Call it
    directly on the scan, before any shuffle: a task reads each split from
    start to end, so within one (file, split) the id follows the file."""
    return df.withColumns({
        "_file": F.col("_metadata.file_path"),
        "_split": F.col("_metadata.file_block_start"),
        "_row": F.monotonically_increasing_id(),
    })


def first_n_in_file_order(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows of the input files in file order (files by path),
    as a top-n: every task keeps its own first n, only those are merged."""
    return (with_file_position(df).orderBy("_file", "_split", "_row").limit(n)
            .drop("_file", "_split", "_row"))
