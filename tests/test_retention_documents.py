"""Retention by document against a plain sort, and eviction from a stored table."""

import random

import pytest
from pyspark.sql import functions as F

from flowscore.operators.positions import with_position, with_running_sum
from flowscore.operators.retention import border, evict_documents, retain_newest_documents


def plain(rows, cap):
    """Newest first by (t, k), nulls oldest; rows are (t, k, size)."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]), reverse=True)
    total, kept = 0, []
    for r in order:
        total += r[2]
        if total > cap and kept:
            break
        kept.append(r)
        if total > cap:
            break
    return sorted(kept, key=str)


@pytest.mark.parametrize("cap", [0, 1, 50, 777, 2500, 10**6])
def test_newest_documents(spark, cap):
    rng = random.Random(cap)
    rows = [(rng.choice([None, *range(30)]), i, rng.randint(1, 20)) for i in range(300)]
    df = spark.createDataFrame(rows, "t int, k int, size int").repartition(5)
    got = retain_newest_documents(df, F.col("size").cast("bigint"), ["t", "k"], F.expr("t div 7"), cap)
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows, cap)


def test_border_between_buckets_and_empty(spark):
    df = spark.createDataFrame([(1, 1, 10), (8, 2, 10), (9, 3, 10)], "t int, k int, size bigint")
    for cap, want in ((20, 8), (29, 8), (30, None), (5, 9)):
        found = border(df, F.col("size"), ["t", "k"], F.expr("t div 7"), cap)
        assert (found and found.t) == want
    assert border(df.limit(0), F.col("size"), ["t", "k"], F.expr("t div 7"), 5) is None


def test_places_and_running_sums(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, 1, 2, 2, 2, 2, 3]), rng.randint(-5, 9)) for _ in range(9000)]
    df = spark.createDataFrame(rows, "k int, v int").repartition(7)
    placed = with_position(df, F.col("k").asc_nulls_first()).collect()
    assert sorted(r.position for r in placed) == list(range(9000))
    assert [r.k for r in sorted(placed, key=lambda r: r.position)] == sorted((r[0] for r in rows), key=lambda k: (k is not None, k or 0))
    summed = with_running_sum(df, F.col("v"), F.col("k").asc_nulls_first(), F.col("v").asc()).collect()
    order, total, want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])), 0, []
    for r in order:
        total += r[1]
        want.append((r[0], r[1], total))
    assert sorted(map(tuple, summed), key=str) == sorted(want, key=str)
    assert with_position(df.limit(0), F.col("k").asc()).count() == 0


def stored(spark, path):
    for batch in range(4):
        rows = [(batch * 10 + i, "x" * 20, "ab"[i % 2]) for i in range(10)]
        spark.createDataFrame(rows, "offset bigint, body string, kind string").write.partitionBy("kind").parquet(
            f"{path}/batch_id={batch}")
    return spark.read.parquet(path)


def test_evict_rewrites_one_batch(spark, tmp_dir):
    path = tmp_dir + "/t"
    table = stored(spark, path)
    bytes_of = {r.offset: len('{"offset":%d,"body":"%s","kind":"%s"}' % (r.offset, r.body, r.kind)) for r in table.collect()}
    newest = sorted(bytes_of, reverse=True)
    cap = sum(bytes_of[o] for o in newest[:14]) + 3
    untouched = sorted(r[0] for r in spark.read.parquet(path + "/batch_id=3").select("_metadata.file_path").distinct().collect())
    assert evict_documents(spark, path, ["offset"], cap) == {"dropped": [0, 1], "rewritten": 2, "removed": 6}
    left = spark.read.parquet(path)
    assert sorted(r.offset for r in left.collect()) == sorted(newest[:14])
    assert set(left.columns) == set(table.columns)
    assert untouched == sorted(r[0] for r in spark.read.parquet(path + "/batch_id=3").select("_metadata.file_path").distinct().collect())
    assert evict_documents(spark, path, ["offset"], cap) == {"dropped": [], "rewritten": None, "removed": 0}


def test_a_stopped_rewrite_is_finished(spark, tmp_dir):
    import os
    path = tmp_dir + "/t"
    stored(spark, path)
    os.rename(path + "/batch_id=1", path + "/_old-batch_id=1")
    os.mkdir(path + "/_new-1-batch_id=1")
    assert evict_documents(spark, path, ["offset"], 10**9)["dropped"] == []
    assert spark.read.parquet(path).count() == 40 and not [n for n in os.listdir(path) if n.startswith("_")]
