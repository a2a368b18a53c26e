"""A stream over a list of Parquet files, taken in the order of the list.

The file source of Spark takes files by modification time.  This one has its own offsets, (file number, row): a batch
is the rows between two of them, read by one task per row group in chunks of ``chunk_rows``, and a restarted query goes
on at the row where the last batch ended.  The list may grow at its end between two starts.  Every row carries its
place (``file_number``, ``row_number``, both from 0), so its order survives any later shuffle.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

FORMAT = "ordered_files"
CHUNK_ROWS = 1000
PLACE = [T.StructField("file_number", T.IntegerType()), T.StructField("row_number", T.LongType())]


def _open(path: str) -> pq.ParquetFile:
    if "://" in path or path.startswith("file:"):
        from pyarrow.fs import FileSystem
        system, inner = FileSystem.from_uri(path)
        return pq.ParquetFile(inner, filesystem=system)
    return pq.ParquetFile(path)


@dataclass
class GroupRows(InputPartition):
    """Rows ``first`` to ``end`` of a file, all in one row group, which begins at row ``begins``."""
    file: int
    group: int
    begins: int
    first: int
    end: int


class OrderedFilesReader(DataSourceStreamReader):
    def __init__(self, schema: T.StructType, files: list[str], chunk_rows: int):
        self.schema, self.files, self.chunk_rows = schema, files, chunk_rows

    def initialOffset(self) -> dict:
        return {"file": 0, "row": 0}

    def latestOffset(self) -> dict:
        """The end of the last file; only its footer is read."""
        if not self.files:
            return self.initialOffset()
        return {"file": len(self.files) - 1, "row": _open(self.files[-1]).metadata.num_rows}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        """Row groups between two offsets, in list order; only footers are read."""
        out = []
        for file in range(start["file"], min(end["file"] + 1, len(self.files))):
            footer = _open(self.files[file]).metadata
            first = start["row"] if file == start["file"] else 0
            last = end["row"] if file == end["file"] else footer.num_rows
            begins = 0
            for group in range(footer.num_row_groups):
                size = footer.row_group(group).num_rows
                a, b = max(first, begins), min(last, begins + size)
                if a < b:
                    out.append(GroupRows(file=file, group=group, begins=begins, first=a, end=b))
                begins += size
        return out

    def read(self, partition: GroupRows) -> Iterator[pa.RecordBatch]:
        target = to_arrow_schema(self.schema)
        names = [f.name for f in self.schema if f.name not in [p.name for p in PLACE]]
        at = partition.begins
        chunks = _open(self.files[partition.file]).iter_batches(
            batch_size=self.chunk_rows, row_groups=[partition.group], columns=names)
        for chunk in chunks:
            a, b = max(partition.first - at, 0), min(partition.end - at, chunk.num_rows)
            if a < b:
                part = chunk.slice(a, b - a)
                columns = [part.column(part.schema.get_field_index(n)).cast(target.field(n).type) for n in names]
                rows = pa.array(range(at + a, at + b), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array([partition.file] * (b - a), pa.int32()), rows], schema=target)
            at += chunk.num_rows

    def commit(self, end: dict) -> None:
        """Nothing to give back: offsets live in the query's checkpoint."""


class OrderedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return OrderedFilesReader(schema, json.loads(self.options["files"]), int(self.options["chunk_rows"]))


def ordered_stream(spark: SparkSession, files: list[str], schema: T.StructType, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Rows of ``files`` (Parquet) in list order as a stream, with their places.

    The list may be empty, and files may be; columns of ``schema`` that are named like a place are an error.  A file
    must not change once it is listed."""
    taken = [p.name for p in PLACE if p.name in schema.names]
    if taken:
        raise ValueError(f"columns of the place already there: {taken}")
    spark.dataSource.register(OrderedFiles)
    return (spark.readStream.format(FORMAT).schema(T.StructType([*schema.fields, *PLACE]))
            .option("files", json.dumps(list(files))).option("chunk_rows", str(chunk_rows)).load())
