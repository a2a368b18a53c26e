"""Resampling of documents towards a target distribution: importance weights over hashed word runs, Gumbel keys, top k.

Each text becomes an array of feature buckets once; bucket counts of the corpus and the target give a gain for each
bucket, and a document's weight is the sum of its gains, an array lookup.  The k documents of largest noisy weight are
drawn without sorting the table: a quantile sketch brackets the cutoff, exact counts of the rows above and within the
bracket validate it (or widen it), and only the rows within are sorted to find the cutoff.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowscore.llm.rows import named, with_computed
from flowscore.llm.scratch import keep
from flowscore.operators.positions import with_position

BUCKETS = 10_000
SEED = "2024"
#: Relative rank error of the quantile sketch, and the bracket's half-width in ranks to begin with.
SKETCH_ACCURACY = 10_000
HALF_WIDTH = 0.002
#: Distinct features a worker keeps the buckets of.
MEMO_SIZE = 500_000
# Fixed value: a word is digits, a-z, and whatever is not ASCII.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


class Bucketer:
    """Buckets of the features of texts: all runs of 1 to ``runs`` words, joined by a space."""

    def __init__(self, runs: int, buckets: int):
        self.runs, self.buckets, self._memo = runs, buckets, {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = _WORD.findall((text or "").encode().translate(_LOWER))
        features = list(words)
        for n in range(2, self.runs + 1):
            features += [b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)]
        memo = self._memo
        if len(memo) > MEMO_SIZE:
            memo.clear()
        for feature in set(features).difference(memo):
            memo[feature] = zlib.crc32(feature) % self.buckets
        return np.fromiter(map(memo.__getitem__, features), dtype=np.int32, count=len(features))


def with_buckets(docs: DataFrame, text_col: str, out_col: str, runs: int, buckets: int) -> DataFrame:
    """``docs`` with the feature buckets of each whole text (null or without words: none)."""
    def make():
        bucket = Bucketer(runs, buckets)

        def compute(columns):
            found = [bucket(t) for t in columns[0].to_pylist()]
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in found]))).astype(np.int32)
            flat = np.concatenate(found) if found else np.zeros(0, np.int32)
            return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))]
        return compute

    return with_computed(docs, [named(text_col).cast("string")], {out_col: T.ArrayType(T.IntegerType())}, make)


def bucket_counts(df: DataFrame, col: str, buckets: int) -> np.ndarray:
    """Features of all rows by bucket (a vector of fixed size): each task sums its rows, then tasks are summed."""
    schema = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("n", T.LongType())])

    def run(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=buckets)
        here = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(here.astype(np.int32)), pa.array(total[here])], names=["bucket", "n"])

    out = np.zeros(buckets, dtype=np.int64)
    for row in df.select(named(col)).mapInArrow(run, schema).groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> list[int]:
    """Thousandths of the log ratio of the target's and the corpus's smoothed share of each bucket, rounded down."""
    buckets, s, t = len(corpus), int(corpus.sum()), int(target.sum())
    return [math.floor(1000 * math.log(((b + 1) * (s + buckets)) / ((a + 1) * (t + buckets))))
            for a, b in zip(corpus.tolist(), target.tolist(), strict=True)]


def with_weight(df: DataFrame, col: str, out_col: str, gain: list[int]) -> DataFrame:
    """``df`` with the sum of the gains of each row's buckets; the vector of gains goes to the workers once."""
    shared = df.sparkSession.sparkContext.broadcast(np.array(gain, dtype=np.int64))  # one number for each bucket

    def make():
        gain = shared.value

        def compute(columns):
            lists = columns[0]
            ends = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
            total = np.concatenate(([0], np.cumsum(gain[lists.flatten().to_numpy(zero_copy_only=False)])))
            return [pa.array(total[ends[1:]] - total[ends[:-1]])]
        return compute

    return with_computed(df, [named(col)], {out_col: T.LongType()}, make)


def gumbel_key(weight: Column, id_col: Column, seed: str) -> Column:
    """Weight plus thousandths of Gumbel noise that depends on the id alone (null id: as an empty text)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return weight + F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))


def cutoff(rows: DataFrame, score: str, tie: str, k: int, size: int, half_width: float = HALF_WIDTH):
    """(score, tie) of the k-th row by (score descending, tie ascending, nulls last); ``rows`` is a written table.

    A quantile sketch gives a bracket around the k-th score.  Rows above and within it are counted exactly; a bracket
    that misses the k-th row is widened fourfold until it holds it.  Only the rows within are sorted."""
    while True:
        share = 1 - k / size
        at = [max(share - half_width, 0.0), min(share + half_width, 1.0)]
        low, high = rows.select(F.percentile_approx(score, at, SKETCH_ACCURACY)).first()[0]
        # Beyond the sketch's ends nothing is left out.
        low, high = (low if at[0] > 0 else None), (high if at[1] < 1 else None)
        above = F.lit(False) if high is None else F.col(score) > high
        below = F.lit(False) if low is None else F.col(score) < low
        counts = rows.agg(F.count_if(above).alias("above"), F.count_if(~above & ~below).alias("within")).first()
        if counts.above < k <= counts.above + counts.within:
            break
        half_width *= 4
    inside = with_position(rows.filter(~above & ~below).select(score, tie), F.col(score).desc(), F.col(tie).asc_nulls_last())
    return inside.filter(F.col("position") == k - counts.above - 1).select(score, tie).first()


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_text_col: str = "text", percent: int = 10, least_features: int = 20, runs: int = 1,
             buckets: int = BUCKETS, seed: str = SEED, columns: list[str] | None = None) -> DataFrame:
    """``columns`` (default: all) of ``docs`` with n_features, weight, score and rank (1, 2, 3, ... for the drawn, else null).

    Of the documents with at least ``least_features`` features, ``percent`` in a hundred (rounded down) are drawn, by
    falling score, then rising id (null ids last); of rows equal in both, any.  Null texts have no features and
    weight 0.  Repeated rows count and are drawn each for itself.  An empty corpus gives an empty table, an empty target
    smoothed shares alone.  Columns of other names stay; those named like a result are replaced."""
    names = ["n_features", "weight", "score", "rank"]
    kept = [c for c in (docs.columns if columns is None else columns) if c not in names]
    held = with_buckets(docs, text_col, "__buckets", runs, buckets)
    held = keep(held.select(F.struct(F.lit(0).alias("_"), *[named(c).alias(c) for c in kept]).alias("doc"),
                            named(id_col).alias("id"), F.col("__buckets").alias("buckets")), "resampling")
    wanted = with_buckets(target.select(named(target_text_col).alias("text")), "text", "buckets", runs, buckets)
    gain = gains(bucket_counts(held, "buckets", buckets), bucket_counts(wanted, "buckets", buckets))
    weighed = with_weight(held, "buckets", "weight", gain)
    rows = keep(weighed.select("doc", "id", F.size("buckets").cast("bigint").alias("n_features"), "weight",
                               gumbel_key(F.col("weight"), F.col("id"), seed).alias("score"),
                               F.monotonically_increasing_id().alias("row")), "resampling")
    eligible = rows.filter(F.col("n_features") >= least_features).select("score", "id", "row")
    size = eligible.count()
    k = percent * size // 100
    out = rows.drop("row").withColumn("rank", F.lit(None).cast("bigint"))
    if k:
        last = cutoff(eligible, "score", "id", k, size)
        same = F.col("id").eqNullSafe(F.lit(last.id).cast(rows.schema["id"].dataType))
        after = F.lit(False) if last.id is None else F.coalesce(F.col("id") > F.lit(last.id), F.lit(True))
        ahead = (F.col("score") > last.score) | (F.col("score") == last.score) & (same | ~after)
        ranked = with_position(eligible.filter(ahead), F.col("score").desc(), F.col("id").asc_nulls_last())
        # Copies of the last row may reach beyond k.
        ranked = ranked.filter(F.col("position") < k).select("row", (F.col("position") + 1).alias("rank"))
        out = rows.join(ranked, "row", "left")
    return out.select(*[F.col("doc").getField(c).alias(c) for c in kept], *names)
