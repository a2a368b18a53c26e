"""Access paths of a stored table: a zone map for exact top-k reads, Bloom filters for point reads.

A zone map has one row per file: its rows, and for each indexed column the least and greatest value and the nulls.  It is
kept beside the table, one folder per batch, and written by the job that writes the batch.  A top-k read first opens the
files whose bounds promise the best rows until they hold k, and then exactly those other files whose bound is not worse
than the k-th row found; rows are compared in those files only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: More files than this are not named one by one; the bound is then a filter on the whole table.
NAMED_FILES = 10_000


def zones_of(table: DataFrame, columns: list[str]) -> DataFrame:
    """(file, rows, low_<c>, high_<c>, nulls_<c> ...) of the files a table is read from; only ``columns`` are read.
    Dots of nested columns become underscores."""
    aggs = []
    for c in columns:
        name = c.replace(".", "_")
        aggs += [F.min(c).alias(f"low_{name}"), F.max(c).alias(f"high_{name}"), F.count_if(F.col(c).isNull()).alias(f"nulls_{name}")]
    return table.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"), *aggs)


def write_zones(spark: SparkSession, folder: str, zones_folder: str, columns: list[str]) -> None:
    """The zone map of one batch's folder (or a whole table); written again it replaces the old one."""
    zones_of(spark.read.parquet(folder), columns).hint("rebalance").write.mode("overwrite").parquet(zones_folder)


@dataclass
class TopRead:
    """The rows of a top-k read, and how much of the table was opened for it."""
    rows: DataFrame
    files_read: int
    files: int


def top_k(table: DataFrame, zones: DataFrame, k: int, by: str, descending: bool = True,
          ties: tuple[str, ...] = ()) -> TopRead:
    """The first ``k`` rows by ``by``, then by ``ties`` in the same direction; nulls come last.

    ``table`` is read from Parquet files (all in ``zones``, which must have ``by``).  Exact whatever the order of rows in
    files: the k-th row of the first files bounds what others may hold.  The zone map is sorted as a top-k of at most
    ``k`` files, since every file has a row."""
    name = by.replace(".", "_")
    bound = F.col(f"high_{name}" if descending else f"low_{name}")
    going = (lambda c: F.col(c).desc_nulls_last()) if descending else (lambda c: F.col(c).asc_nulls_last())
    order = [going(c) for c in (by, *ties)]
    files = zones.count()
    if not k:
        return TopRead(table.limit(0), 0, files)
    best = zones.filter(bound.isNotNull()).orderBy(
        bound.desc() if descending else bound.asc(), "file").limit(k).select(
        "file", F.col("rows") - F.col(f"nulls_{name}")).collect()
    first, held = [], 0
    for file, rows in best:
        if held >= k:
            break
        first.append(file)
        held += rows
    if held < k:  # nulls are among the first k, or the table has fewer rows
        return TopRead(table.orderBy(*order).limit(k), files, files)
    there = _of_files(table, first).filter(F.col(by).isNotNull())
    last = there.orderBy(*order).limit(k).agg(F.min(by) if descending else F.max(by)).first()[0]
    reach = bound >= F.lit(last) if descending else bound <= F.lit(last)
    wanted = [r.file for r in zones.filter(reach).select("file").orderBy("file").limit(NAMED_FILES + 1).collect()]
    good = F.col(by) >= F.lit(last) if descending else F.col(by) <= F.lit(last)
    if len(wanted) > NAMED_FILES:
        return TopRead(table.filter(good).orderBy(*order).limit(k), files, files)
    return TopRead(_of_files(table, wanted).filter(good).orderBy(*order).limit(k), len(set(first) | set(wanted)), files)


def _of_files(table: DataFrame, paths: list[str]) -> DataFrame:
    """The same table read from some of its files."""
    spark = table.sparkSession
    return spark.read.option("basePath", _base(table)).schema(table.schema).parquet(*paths)


def _base(table: DataFrame) -> str:
    """The folder a table was read from: what its files' paths share above the partition folders."""
    path = table.select("_metadata.file_path").first()[0]
    parts = path.split("/")
    for i, part in enumerate(parts):
        if "=" in part:
            return "/".join(parts[:i])
    return "/".join(parts[:-1])


def with_blooms(writer, columns: dict[str, int]):
    """A Parquet writer that adds a Bloom filter for each column (name -> distinct values of a file)."""
    for column, distinct in columns.items():
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true").option(
            f"parquet.bloom.filter.expected.ndv#{column}", str(distinct))
    return writer


def lookup(table: DataFrame, **position) -> DataFrame:
    """Rows at one place of the source, by fields of ``kafka_metadata``: equality reaches the scan, so row groups whose
    statistics or Bloom filters rule the value out are skipped."""
    condition: Column = F.lit(True)
    for name, value in position.items():
        condition = condition & (F.col(f"kafka_metadata.{name}") == F.lit(value))
    return table.filter(condition)
