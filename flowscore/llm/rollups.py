"""Token totals by source, language and tokenizer version, kept up by signed changes.

A batch of changes becomes one small table of additive differences, written to the batch's own folder and committed by
a marker.  Totals are the sum over committed batches, so a batch that is sent again, or written again after a failure,
counts once.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowscore.llm import tokens
from flowscore.llm.rows import named, with_computed

KEYS = ["source", "lang", "tokenizer"]


def token_counts(docs: DataFrame, text_col: str = "text", path: str | None = None,
                 out_col: str = "tokens") -> DataFrame:
    """The other columns of ``docs`` and the number of the text's ids; a null text has none."""
    path = path or tokens.tokenizer_path(tokens.BYTE_BPE)

    def make():
        encoder = tokens.encoder(path)
        return lambda texts: [pa.array([len(ids) for ids in encoder.encode_many(texts[0])], pa.int64())]

    rest = [c for c in docs.columns if c != text_col]
    return with_computed(docs, [named(text_col).cast("string")], {out_col: T.LongType()}, make, rest)


def signed(changes: DataFrame) -> DataFrame:
    """Differences by key of changes (op, source, lang, tokenizer, tokens, old_tokens).

    ``insert`` adds a document and its tokens, ``delete`` takes them away, ``revise`` replaces ``old_tokens`` by
    ``tokens``.  Any other op (or null) is an error.  Null counts are 0; null keys are a group of their own."""
    op, count = F.col("op"), lambda c: F.coalesce(F.col(c).cast("long"), F.lit(0))
    sign = F.when(op == "insert", 1).when(op == "delete", -1).when(op == "revise", 0).otherwise(
        F.raise_error(F.concat(F.lit("unknown op: "), F.coalesce(op, F.lit("null")))).cast("int"))
    change = F.when(op == "revise", count("tokens") - count("old_tokens")).otherwise(sign * count("tokens"))
    return changes.groupBy(*KEYS).agg(F.sum(sign).cast("long").alias("documents"), F.sum(change).alias("tokens"))


class Rollup:
    """Totals kept in ``folder`` (on storage that driver and executors share)."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, *parts: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join([self.folder, *parts]))

    def _fs(self):
        return self._path().getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    @staticmethod
    def _name(batch_id: str) -> str:
        return hashlib.sha256(str(batch_id).encode()).hexdigest()[:32]

    def committed(self) -> list[str]:
        """Folder names of the committed batches."""
        fs, markers = self._fs(), self._path("commits")
        return sorted(x.getPath().getName() for x in fs.listStatus(markers)) if fs.exists(markers) else []

    def apply(self, batch_id: str, changes: DataFrame) -> bool:
        """Commit a batch; False (and nothing changes) if this id was committed before.

        The differences are written whole before the marker is made; a run that dies between the two is written
        over by the next attempt."""
        name = self._name(batch_id)
        if name in self.committed():
            return False
        signed(changes).write.mode("overwrite").parquet(f"{self.folder}/deltas/{name}")
        return bool(self._fs().createNewFile(self._path("commits", name)))

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, documents, tokens); keys whose documents and tokens are both 0 are left out."""
        names = self.committed()
        schema = "source string, lang string, tokenizer string, documents bigint, tokens bigint"
        deltas = self.spark.read.schema(schema).parquet(*[f"{self.folder}/deltas/{n}" for n in names]) if names else \
            self.spark.createDataFrame([], schema)
        return deltas.groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens")).filter(
            "documents <> 0 or tokens <> 0")
