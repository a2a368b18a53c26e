"""Quality by hierarchical empirical Bayes: a document classifier's evidence on top of site priors.

The classifier is naive Bayes over binned shape features of the whole text (letters, symbols, capitals, repeats),
counted by grouped aggregation.  The prior of a document is its path's share of good labels, shrunk towards its host's,
which is shrunk towards the share of all labels; how strongly is estimated from the spread between groups.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowscore.llm.rows import named, with_computed

#: Upper edges of each feature's bins.
BINS = {
    "words": [5, 20, 80, 320, 1280],
    "word_length": [2, 3, 4, 5, 6, 8, 12],
    "capitals": [0.01, 0.03, 0.1, 0.3, 0.7],
    "digits": [0.001, 0.01, 0.03, 0.1, 0.3],
    "symbols": [0.001, 0.005, 0.02, 0.05, 0.1, 0.2],
    "marks": [0.005, 0.02, 0.04, 0.08, 0.15],
    "distinct_words": [0.02, 0.1, 0.25, 0.5, 0.75],
    "most_common_word": [0.02, 0.05, 0.1, 0.2, 0.5],
    "distinct_lines": [0.1, 0.3, 0.6, 0.9, 0.999],
    "line_words": [3, 8, 20, 60],
}
# Byte classes: 0 letter, 1 capital, 2 digit, 3 white space, 4 sentence mark, 5 other symbol.
_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[[b for b in range(128) if not chr(b).isalnum()]] = 5
_CLASS[[b for b in range(128) if chr(b).isupper()]] = 1
_CLASS[[b for b in range(128) if chr(b).isdigit()]] = 2
_CLASS[list(b" \t\n\r\x0b\x0c")] = 3
_CLASS[list(b".,;:?'\"-")] = 4
#: Log-odds a single feature may add; features depend on each other, so their sum is damped as well.
MOST_EVIDENCE, DAMPING = 4.0, 0.7


def features(text: bytes) -> list[int]:
    """Bin of each feature of BINS for a whole text."""
    count = np.bincount(_CLASS[np.frombuffer(text, dtype=np.uint8)], minlength=6)
    said, words, lines = max(int(count.sum() - count[3]), 1), text.split(), [x for x in text.split(b"\n") if x.strip()]
    kinds = Counter(words)
    values = {
        "words": len(words), "word_length": said / max(len(words), 1), "capitals": count[1] / said,
        "digits": count[2] / said, "symbols": count[5] / said, "marks": count[4] / said,
        "distinct_words": len(kinds) / max(len(words), 1),
        "most_common_word": max(kinds.values(), default=0) / max(len(words), 1),
        "distinct_lines": len(set(lines)) / max(len(lines), 1), "line_words": len(words) / max(len(lines), 1),
    }
    return [int(np.searchsorted(edges, values[name])) for name, edges in BINS.items()]


def with_features(docs: DataFrame, text_col: str = "text", out_col: str = "bins") -> DataFrame:
    """The other columns and the array of feature bins; a null text counts as empty."""

    def make():
        return lambda texts: [pa.array([features(t.as_py() or b"") for t in texts[0].cast(pa.binary())],
                                       pa.list_(pa.int32()))]

    rest = [c for c in docs.columns if c != text_col]
    return with_computed(docs, [named(text_col).cast("string")], {out_col: T.ArrayType(T.IntegerType())}, make, rest)


def evidence_table(labelled: DataFrame) -> list[list[float]]:
    """Log-odds of each feature's bins from (bins, good): one row per feature and bin reaches the driver."""
    rows = labelled.select("good", F.posexplode("bins").alias("feature", "bin")).groupBy("feature", "bin").agg(
        F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("bad")).collect()
    table = [[0.0] * (len(edges) + 1) for edges in BINS.values()]
    total = {f: [0.0, 0.0] for f in range(len(table))}
    for r in rows:
        total[r.feature][0] += r.good
        total[r.feature][1] += r.bad
    for r in rows:
        size = len(table[r.feature])
        good = (r.good + 0.5) / (total[r.feature][0] + 0.5 * size)
        bad = (r.bad + 0.5) / (total[r.feature][1] + 0.5 * size)
        table[r.feature][r.bin] = max(-MOST_EVIDENCE, min(MOST_EVIDENCE, math.log(good / bad)))
    return table


def _strength(groups: DataFrame, towards: str) -> float:
    """Pseudo-labels a group's prior is worth, by the method of moments over (n, good, ``towards``)."""
    p = F.col("good") / F.col("n")
    m = groups.agg(F.sum("n").alias("n"), F.count("*").alias("k"),
                   F.sum(F.col("n") * F.pow(p - F.col(towards), 2)).alias("spread"),
                   F.sum(F.col("n") * F.col(towards) * (1 - F.col(towards))).alias("noise")).first()
    if not m.k or not m.noise:
        return 1.0
    between = (m.spread - m.noise * m.k / m.n) / m.n  # what the spread exceeds that of chance by
    within = m.noise / m.n
    return 1e6 if between <= within * 1e-6 else max(within / between - 1, 1.0)


class SitePriors:
    """Shares of good labels by host and path, from (host, path, good); both tables have a row per group."""

    def __init__(self, labelled: DataFrame):
        top = labelled.agg(F.sum("good"), F.count("good")).first()
        self.share = ((top[0] or 0) + 0.5) / ((top[1] or 0) + 1.0)
        count = [F.count("good").alias("n"), F.sum("good").alias("good")]
        hosts = labelled.groupBy("host").agg(*count).withColumn("towards", F.lit(self.share))
        self.host_strength = _strength(hosts, "towards")
        self.hosts = hosts.select("host", ((F.col("good") + self.host_strength * self.share)
                                           / (F.col("n") + self.host_strength)).alias("host_prior"))
        paths = labelled.groupBy("host", "path").agg(*count)
        near = paths.join(self.hosts.withColumnRenamed("host", "__h"), F.col("host").eqNullSafe(F.col("__h"))).drop("__h")
        self.path_strength = _strength(near, "host_prior")
        self.paths = near.select("host", "path", ((F.col("good") + self.path_strength * F.col("host_prior"))
                                                  / (F.col("n") + self.path_strength)).alias("path_prior"))

    def add_to(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``prior``: the path's, else the host's, else the share of all labels."""
        packed = rows.select(F.struct(*[named(c).alias(c) for c in rows.columns]).alias("row"))
        host, path = F.col("row").getField("host"), F.col("row").getField("path")
        hosts = self.hosts.withColumnRenamed("host", "h")
        paths = self.paths.withColumnsRenamed({"host": "ph", "path": "pp"})
        met = packed.join(hosts, host.eqNullSafe(F.col("h")), "left").join(
            paths, host.eqNullSafe(F.col("ph")) & path.eqNullSafe(F.col("pp")), "left")
        return met.select(*[F.col("row").getField(c).alias(c) for c in rows.columns if c != "prior"],
                          F.coalesce("path_prior", "host_prior", F.lit(self.share)).alias("prior"))


def classify(rows: DataFrame, labelled: DataFrame, keep_from: float = 0.5) -> DataFrame:
    """Rows with host, path and bins (and any other columns) with evidence, prior, quality (posterior of a good label) and keep.

    ``labelled`` is (host, path, bins, good 0 or 1); a document with several labels counts with each.  Without labels
    every posterior is one half.  Null hosts and paths are groups of their own."""
    table = evidence_table(labelled)
    priors = SitePriors(labelled)
    evidence = sum((F.element_at(F.array(*[F.lit(x) for x in of]), F.col("bins")[i] + 1) for i, of in enumerate(table)),
                   F.lit(0.0)) * DAMPING
    logit = F.log(F.col("prior") / (1 - F.col("prior"))) + F.col("evidence")
    return priors.add_to(rows.withColumn("evidence", evidence).drop("bins")).withColumn(
        "quality", 1 / (1 + F.exp(-logit))).withColumn("keep", F.col("quality") >= keep_from)
