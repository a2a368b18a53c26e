"""Size-capped retention of stored predictions: keep the newest batches, or the newest documents, whose cumulative size
stays within the cap, and evict the older ones.

Documents: sizes are summed by bucket (batch or time), a running sum over the buckets finds the one at the border, and
only its documents are sorted.  What stays is then a filter on the order's columns, or, in a stored table, whole folders
and one rewritten folder."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowscore.functions.json_codec import json_column
from flowscore.operators.positions import with_running_sum
from flowscore.operators.windows import running_total
from flowscore.schema import PREDICTIONS_CAP_BYTES
from flowscore.session import shared_dir

BLOCK_BATCHES = 1000


def batch_sizes(df: DataFrame, batch_col: str, columns: list[str] | None = None) -> DataFrame:
    """Bytes per batch, measured as the UTF-8 size of each row's JSON document."""
    cols = [c for c in (columns or df.columns) if c != batch_col]
    size = F.octet_length(json_column(cols)).cast("bigint")
    return df.groupBy(batch_col).agg(F.sum(size).alias("bytes"))


def retain_newest(sizes: DataFrame, batch_col: str, cap_bytes: int = PREDICTIONS_CAP_BYTES,
                  block_batches: int = BLOCK_BATCHES) -> DataFrame:
    """Batches to keep: newest first while the cumulative size is <= cap; the
    newest one always, even if it alone exceeds the cap."""
    blk = F.expr(f"`{batch_col}` div {int(block_batches)}")
    shared_dir(sizes.sparkSession)
    sizes = sizes.checkpoint(eager=True)  # one row per batch; read twice below
    cum = running_total(sizes, batch_col, "bytes", blk, out="cum_bytes", descending=True)
    return cum.where((F.col("cum_bytes") <= F.lit(cap_bytes)) | (F.col("cum_bytes") == F.col("bytes")))


def evict(spark: SparkSession, table_path: str, batch_col: str = "batch_id",
          cap_bytes: int = PREDICTIONS_CAP_BYTES) -> list[int]:
    """Delete the partition folders of batches beyond the cap; returns them.

    The newest batch always stays.

    Sizes come from the files themselves (Hadoop file lengths), so this reads
    metadata only.  The list of batch folders is bounded by the number of
    micro-batches kept, not by rows."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(table_path)
    fs = root.getFileSystem(conf)
    sizes = []
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(batch_col + "="):
            total = fs.getContentSummary(st.getPath()).getLength()
            sizes.append((int(name.split("=", 1)[1]), int(total)))
    sizes.sort(reverse=True)
    kept, acc, dropped = True, 0, []
    for bid, size in sizes:
        acc += size
        if kept and (acc <= cap_bytes or bid == sizes[0][0]):
            continue
        kept = False
        dropped.append(bid)
        fs.delete(jvm.org.apache.hadoop.fs.Path(root, f"{batch_col}={bid}"), True)
    return dropped


def document_bytes(columns: list[str]) -> Column:
    """Size of a row as a JSON document in UTF-8."""
    return F.octet_length(json_column(columns)).cast("bigint")


def border(docs: DataFrame, size: Column, order: list[str], bucket: Column, cap_bytes: int):
    """The oldest document that stays, as a row of the ``order`` columns; None if all stay.

    Newest first is by falling ``order`` columns (nulls are oldest); ``bucket`` must not fall where the order rises.  A
    document stays while the bytes of it and all newer ones are within the cap; the newest one always does."""
    rows = docs.select(*order, bucket.alias("_bucket"), size.alias("_bytes"))
    totals = rows.groupBy("_bucket").agg(F.sum("_bytes").alias("_total"))
    newest_first = F.col("_bucket").desc_nulls_last()
    upto = with_running_sum(totals, F.col("_total"), newest_first, out="_upto")
    cut = upto.filter(F.col("_upto") > cap_bytes).orderBy(newest_first).first()
    if cut is None:
        return None
    room = cap_bytes - (cut["_upto"] - cut["_total"])
    inside = rows.filter(F.col("_bucket").eqNullSafe(F.lit(cut["_bucket"]).cast(rows.schema["_bucket"].dataType)))
    falling = [F.col(c).desc_nulls_last() for c in order]
    summed = with_running_sum(inside, F.col("_bytes"), *falling)
    rising = [F.col(c).asc_nulls_first() for c in order]
    last = summed.filter(F.col("running_total") <= room).orderBy(*rising).select(*order).first()
    if last is not None:
        return last
    # Nothing of this bucket stays: the last of the bucket before it, or the newest document of all.
    newer = rows.join(upto.filter(F.col("_upto") <= cap_bytes).select("_bucket"), "_bucket", "left_semi")
    return newer.orderBy(*rising).select(*order).first() or rows.orderBy(*falling).select(*order).first()


def not_older(order: list[str], row) -> Column:
    """Whether a document is the border row or newer, by falling ``order`` columns with nulls oldest."""
    keep = F.lit(True)
    for name in reversed(order):
        value, column = row[name], F.col(name)
        if value is None:
            keep = column.isNotNull() | keep
        else:
            keep = F.coalesce((column > F.lit(value)) | (column == F.lit(value)) & keep, F.lit(False))
    return keep


def retain_newest_documents(docs: DataFrame, size: Column, order: list[str], bucket: Column,
                            cap_bytes: int = PREDICTIONS_CAP_BYTES) -> DataFrame:
    """The newest documents within the cap (see ``border``); equal rows at the border stay together."""
    oldest = border(docs, size, order, bucket, cap_bytes)
    return docs if oldest is None else docs.filter(not_older(order, oldest))


def evict_documents(spark: SparkSession, table_path: str, order: list[str], cap_bytes: int = PREDICTIONS_CAP_BYTES,
                    batch_col: str = "batch_id") -> dict:
    """Remove the oldest documents of a stored table (one folder per batch) beyond the cap; returns what was done.

    Order: by batch, then by ``order`` within it, newest last.  Folders of older batches are deleted, the border batch
    is written anew without its oldest documents and put in place by renaming; a run that stopped in between is
    finished first.  No other file is touched."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    root = hadoop(table_path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    _finish_rewrites(fs, hadoop, root)
    table = spark.read.parquet(table_path)
    size = document_bytes([c for c in table.columns if c != batch_col])
    oldest = border(table, size, [batch_col, *order], F.col(batch_col), cap_bytes)
    done = {"dropped": [], "rewritten": None, "removed": 0}
    if oldest is None:
        return done
    edge = f"{batch_col}={oldest[batch_col]}"
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith(batch_col + "=") and int(name.split("=", 1)[1]) < oldest[batch_col]:
            fs.delete(status.getPath(), True)
            done["dropped"].append(int(name.split("=", 1)[1]))
    old = hadoop(root, edge)
    batch = spark.read.option("basePath", table_path).parquet(str(old))
    parts = _partitions_below(fs, old)
    kept = batch.filter(not_older(order, oldest))
    removed = batch.count() - kept.count()
    if removed:
        fresh = hadoop(root, f"_new-{uuid.uuid4().hex}-{edge}")
        writer = kept.drop(batch_col).write
        (writer.partitionBy(*parts) if parts else writer).parquet(str(fresh))
        aside = hadoop(root, f"_old-{edge}")
        fs.rename(old, aside)
        fs.rename(fresh, old)
        fs.delete(aside, True)
        done |= {"rewritten": oldest[batch_col], "removed": removed}
    done["dropped"].sort()
    return done


def _partitions_below(fs, folder) -> list[str]:
    """Partition columns of the folders below one folder, outermost first."""
    names = []
    while True:
        below = [s.getPath() for s in fs.listStatus(folder) if s.isDirectory() and "=" in s.getPath().getName()]
        if not below:
            return names
        names.append(below[0].getName().split("=", 1)[0])
        folder = below[0]


def _finish_rewrites(fs, hadoop, root) -> None:
    """Put back a batch that a stopped run had set aside, and delete what it left."""
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith("_old-"):
            there = hadoop(root, name.removeprefix("_old-"))
            if fs.exists(there):
                fs.delete(status.getPath(), True)
            else:
                fs.rename(status.getPath(), there)
        elif name.startswith("_new-"):
            fs.delete(status.getPath(), True)
