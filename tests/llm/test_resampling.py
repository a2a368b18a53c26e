"""Importance resampling against a plain version, and its DuckDB SQL."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from flowscore.llm import queries as Q
from flowscore.llm import resampling

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, score string, id string"


def plain(docs, target, percent=10, least=20, runs=1):
    """{(doc_id, number among its copies): (n_features, weight, score, rank)} of (doc_id, text) rows."""
    def features(text):
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        return [zlib.crc32(" ".join(words[i:i + n]).encode()) % 10_000 for n in range(1, runs + 1)
                for i in range(len(words) - n + 1)]

    of = [features(t) for _, t in docs]
    s, t = Counter(b for x in of for b in x), Counter(b for x in target for b in features(x))
    all_s, all_t = sum(s.values()) + 10_000, sum(t.values()) + 10_000
    gain = [math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in range(10_000)]
    rows = []
    for (doc, _), x in zip(docs, of, strict=True):
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in x)
        rows.append([doc, len(x), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    eligible = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, r in enumerate(eligible[:percent * len(eligible) // 100]):
        r[4] = i + 1
    return sorted(map(tuple, rows), key=str)


def as_rows(df):
    return sorted(((r.doc_id, r.n_features, r.weight, r.score, r.rank) for r in df.collect()), key=str)


def test_query_and_sql(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = Q.op12_resampling(spark, SF)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert as_rows(got) == plain(docs, target)
    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        db.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    assert sorted(db.execute(Q.ORACLE["op12_resampling"]).fetchall(), key=str) == as_rows(got)


@pytest.mark.parametrize("percent,least,runs", [(10, 20, 1), (100, 1, 2), (37, 3, 3), (0, 1, 1), (1, 1, 1)])
def test_odd_rows(spark, percent, least, runs):
    docs = [(1, None), (2, ""), (3, "12 AB c’d É"), (3, "12 AB c’d É"), (None, "one two three four"), (None, None),
            (5, "word " * 5000), (6, "one two three four"), (7, "!?, ."), *((i, f"the {i % 3} of many") for i in range(10, 70))]
    target = ["one two", None, "", "the 1 of"]
    rows = spark.createDataFrame([(*r, "x", "y") for r in docs], SCHEMA)
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    got = resampling.resample(rows, aim, percent=percent, least_features=least, runs=runs)
    assert got.columns == ["doc_id", "text", "id", "n_features", "weight", "score", "rank"]
    assert as_rows(got) == plain(docs, target, percent, least, runs)


def test_many_ties_and_copies(spark):
    docs = [(i % 9, "same words here") for i in range(200)]
    rows = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(6)
    aim = spark.createDataFrame([("here",)], "text string")
    assert as_rows(resampling.resample(rows, aim, least_features=1)) == plain(docs, ["here"], least=1)


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame([(1, "a b", "", "")], SCHEMA)
    assert resampling.resample(none, some).count() == 0
    assert as_rows(resampling.resample(some, none, least_features=1)) == plain([(1, "a b")], [], least=1)


@pytest.mark.parametrize("half_width", [0.0001, 0.01, 1.0])
def test_bracket_widens_to_the_cutoff(spark, tmp_path, half_width):
    spark.range(3000).select((F.col("id") * 7919 % 1009).alias("score"), "id").write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    order = [(r.score, r.id) for r in rows.orderBy(F.desc("score"), "id").collect()]
    for k in (1, 300, 1500, 3000):
        assert tuple(resampling.cutoff(rows, "score", "id", k, 3000, half_width)) == order[k - 1]
