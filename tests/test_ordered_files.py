"""Files of a stream in the order of a list: places, chunks, row groups, restart with a longer list."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import types as T

from flowscore.sources.ordered import OrderedFilesReader, ordered_stream

SCHEMA = T.StructType([T.StructField("n", T.LongType()), T.StructField("s", T.StringType())])


def write(folder, name, start, rows, group=700):
    path = str(folder / name)
    pq.write_table(pa.table({"n": pa.array(range(start, start + rows), pa.int64()),
                             "s": pa.array([f"v{i}" for i in range(start, start + rows)], pa.string())}),
                   path, row_group_size=group)
    return path


def run(spark, files, out, checkpoint, chunk_rows=1000):
    query = (ordered_stream(spark, files, SCHEMA, chunk_rows).writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination(120)
    assert query.exception() is None
    rows = spark.read.parquet(out).orderBy("file_number", "row_number").collect()
    return [(r.file_number, r.row_number, r.n, r.s) for r in rows]


def test_list_order_and_restart(spark, tmp_path):
    # The list is against the order of names and of modification times.
    last, first = write(tmp_path, "a.parquet", 5000, 1500), write(tmp_path, "b.parquet", 0, 2300)
    empty = write(tmp_path, "c.parquet", 0, 0)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    numbers = [*range(0, 2300), *range(5000, 6500)]
    places = [(0, i) for i in range(2300)] + [(2, i) for i in range(1500)]
    want = [(*p, n, f"v{n}") for p, n in zip(places, numbers, strict=True)]
    assert run(spark, [first, empty, last], out, checkpoint) == want
    assert run(spark, [first, empty, last], out, checkpoint) == want  # nothing new, nothing twice
    more = write(tmp_path, "0.parquet", 9000, 10)
    assert run(spark, [first, empty, last, more], out, checkpoint) == want + [(3, i, 9000 + i, f"v{9000 + i}") for i in range(10)]


def test_batches_begin_and_end_within_row_groups(tmp_path):
    files = [write(tmp_path, "a.parquet", 0, 1500), write(tmp_path, "b.parquet", 1500, 900)]
    schema = T.StructType([*SCHEMA.fields, T.StructField("file_number", T.IntegerType()), T.StructField("row_number", T.LongType())])
    reader = OrderedFilesReader(schema, files, 250)
    assert reader.latestOffset() == {"file": 1, "row": 900}
    seen, offsets = [], [reader.initialOffset(), {"file": 0, "row": 333}, {"file": 0, "row": 1500}, {"file": 1, "row": 1}, reader.latestOffset()]
    for a, b in zip(offsets, offsets[1:]):
        for part in reader.partitions(a, b):
            chunks = list(reader.read(part))
            assert all(c.num_rows <= 250 for c in chunks)
            seen += [n for c in chunks for n in c.column(0).to_pylist()]
    assert seen == list(range(2400))
    assert reader.partitions(offsets[-1], offsets[-1]) == []


def test_columns_named_like_a_place(spark):
    with pytest.raises(ValueError):
        ordered_stream(spark, [], T.StructType([T.StructField("row_number", T.LongType())]))
