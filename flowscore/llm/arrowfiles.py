"""Token ids as Arrow files of equal-length sequences that can be mapped into memory and read at any place.

A dataset is a folder of parts in ascending document order.  ``part-N.tokens.arrow`` (Arrow's random-access file
format, uncompressed) has record batches of fixed-size lists: ``ids`` (unsigned 16 or 32 bits, by the vocabulary) and
``mask`` (one bit each, false where the last sequence is filled up).  Sequence k of a part is row k, so it is found by
arithmetic and read without copying.  ``part-N.documents.arrow`` has a row per document: id, start in the part, tokens.
A part is written under a name of its attempt and then renamed, so a lost or repeated task leaves one whole part.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowscore.llm import tokens
from flowscore.llm.scratch import keep
from flowscore.session import fresh_dir

END_ID = 2
SEQUENCE = 2048
#: Sequences in a record batch.
BATCH = 128


def _store(path: str):
    """(file system, path in it) of a folder that all executors see: a shared mount, or a store pyarrow opens."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


class PartWriter:
    """Writes one part as ids come, holding one record batch."""

    def __init__(self, folder: str, part: int, attempt: int, id_type: pa.DataType, wide: bool, sequence: int):
        self._fs, base = _store(folder)
        self._fs.create_dir(base, recursive=True)
        self._final = f"{base}/part-{part:06d}"
        self._open = f"{base}/_{part:06d}-{attempt}"
        self._dtype, self._sequence = ("<u4" if wide else "<u2"), sequence
        ids = pa.list_(pa.uint32() if wide else pa.uint16(), sequence)
        self._schema = pa.schema([("ids", ids), ("mask", pa.list_(pa.bool_(), sequence))])
        self._index_schema = pa.schema([("id", id_type), ("start", pa.int64()), ("tokens", pa.int64())])
        self._files = [self._fs.open_output_stream(f"{self._open}.{x}") for x in ("tokens", "documents")]
        self._tokens = pa.ipc.new_file(self._files[0], self._schema)
        self._documents = pa.ipc.new_file(self._files[1], self._index_schema)
        self._held: list[np.ndarray] = []
        self._n = self.written = 0
        self._rows: list[tuple] = []

    def add(self, doc, ids: np.ndarray) -> None:
        ids = ids.astype(self._dtype)
        self._rows.append((doc, self.written, len(ids)))
        self.written += len(ids)
        self._held.append(ids)
        self._n += len(ids)
        if self._n >= BATCH * self._sequence:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        flat = np.concatenate([*self._held, np.empty(0, self._dtype)])
        size = BATCH * self._sequence
        while len(flat) >= size or last and len(flat):
            part, flat = flat[:size], flat[size:]
            filled = -(-len(part) // self._sequence) * self._sequence
            padded = np.zeros(filled, dtype=self._dtype)
            padded[:len(part)] = part
            mask = np.arange(filled) < len(part)
            self._tokens.write_batch(pa.RecordBatch.from_arrays(
                [pa.FixedSizeListArray.from_arrays(pa.array(padded), self._sequence),
                 pa.FixedSizeListArray.from_arrays(pa.array(mask), self._sequence)], schema=self._schema))
        self._held, self._n = [flat], len(flat)
        if self._rows:
            self._documents.write_batch(pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*self._rows, strict=True), self._index_schema.types, strict=True)],
                schema=self._index_schema))
            self._rows = []

    def close(self) -> str:
        self._flush(True)
        for x in (self._tokens, self._documents, *self._files):
            x.close()
        for x in ("tokens", "documents"):
            self._fs.move(f"{self._open}.{x}", f"{self._final}.{x}.arrow")
        return self._final.rpartition("/")[2]


class Part:
    """A part opened for reading; on a local or mounted path the files are mapped and nothing is copied."""

    def __init__(self, folder: str, name: str):
        from pyarrow import fs
        store, base = _store(folder)

        def source(kind):
            path = f"{base}/{name}.{kind}.arrow"
            return pa.memory_map(path) if isinstance(store, fs.LocalFileSystem) else store.open_input_file(path)

        self._tokens = pa.ipc.open_file(source("tokens"))
        self.documents = pa.ipc.open_file(source("documents"))
        self.sequence = self._tokens.schema.field("ids").type.list_size

    def _rows(self, k: int):
        batch = self._tokens.get_batch(k // BATCH)
        return batch, k % BATCH

    def sequence_at(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids (a view of the file) and mask of sequence k."""
        batch, row = self._rows(k)
        ids, mask = batch.column("ids"), batch.column("mask")
        at = slice(row * self.sequence, (row + 1) * self.sequence)
        return (ids.values.to_numpy(zero_copy_only=True)[at],
                mask.values.slice(at.start, self.sequence).to_numpy(zero_copy_only=False))

    def tokens(self, start: int, length: int) -> np.ndarray:
        """``length`` ids from place ``start`` of the part."""
        size, out = BATCH * self.sequence, []
        while length > 0:
            flat = self._tokens.get_batch(start // size).column("ids").values.to_numpy(zero_copy_only=True)
            piece = flat[start % size:start % size + length]
            out.append(piece)
            start, length = start + len(piece), length - len(piece)
        return np.concatenate(out) if len(out) != 1 else out[0]


def write(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
          end_id: int = END_ID, sequence: int = SEQUENCE) -> DataFrame:
    """Write the dataset and return its manifest (part, name, first id's order, tokens, documents).

    Documents stand in ascending order of id (nulls first, equal ids by their text's hash).  A null text counts as
    empty; an empty table writes no part.  Other columns are not read."""
    path = path or tokens.tokenizer_path(tokens.WORD_BPE)

    def run(batches):
        task, encoder, writer, count = TaskContext.get(), tokens.encoder(path), None, 0
        end = np.array([end_id], dtype="<u4")
        for batch in batches:
            if writer is None:
                writer = PartWriter(folder, task.partitionId(), task.taskAttemptId(), batch.schema.field(0).type,
                                    encoder.vocabulary > 1 << 16, sequence)
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                for doc, ids in zip(part.column(0).to_pylist(), encoder.encode_many(part.column(1)), strict=True):
                    writer.add(doc, np.concatenate([ids, end]))
            count += batch.num_rows
        if count:
            yield pa.RecordBatch.from_arrays(
                [pa.array([task.partitionId()], pa.int32()), pa.array([writer.close()]),
                 pa.array([writer.written], pa.int64()), pa.array([count], pa.int64())],
                names=["part", "name", "tokens", "documents"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    return keep(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        run, "part int, name string, tokens bigint, documents bigint"), "arrowfiles")


def read_documents(spark: SparkSession, folder: str, manifest: DataFrame, id_type: str,
                   with_ids: bool = False) -> DataFrame:
    """(id, start, n_tokens, ids_crc32[, ids]) of each document, read from the parts; start counts the ids of all
    documents before it.  The manifest has a row per part: its running total is over parts, not documents."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = manifest.select("part", "name", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("before"))
    names = ["id", "start", "n_tokens", "ids_crc32", "ids"][:5 if with_ids else 4]

    def run(batches):
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = Part(folder, name)
                for i in range(part.documents.num_record_batches):
                    docs = part.documents.get_batch(i)
                    starts, sizes = docs.column("start").to_pylist(), docs.column("tokens").to_pylist()
                    ids = [part.tokens(s, n).astype("<u4").tobytes() for s, n in zip(starts, sizes, strict=True)]
                    columns = [docs.column("id"), pa.array([base + s for s in starts], pa.int64()), docs.column("tokens"),
                               pa.array([zlib.crc32(x) for x in ids], pa.int64()), pa.array(ids, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns[:len(names)], names=names)

    schema = f"id {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    # A task for each few parts: the rows are tiny, the files they name are not.
    return parts.select("name", "before").repartition(max(1, manifest.count()), "name").mapInArrow(run, schema)


def roundtrip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None,
              **parameters) -> DataFrame:
    """Write the documents and read them back: id, start, n_tokens, ids_crc32 of each."""
    spark = docs.sparkSession
    folder = folder or fresh_dir(spark, "arrowfiles")
    manifest = write(docs, folder, id_col, text_col, **parameters)
    out = read_documents(spark, folder, manifest, docs.schema[id_col].dataType.simpleString())
    return out.withColumnRenamed("id", id_col)
