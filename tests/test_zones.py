"""Zone-mapped top-k reads against a sort of all rows, and row groups skipped by Bloom filters."""

import random

import pytest
from pyspark.sql import functions as F

from flowscore.operators.zones import lookup, top_k, with_blooms, write_zones, zones_of


def table_of(spark, path, rows, files=6, sorted_=True):
    df = spark.createDataFrame(rows, "t int, k int, meta struct<o: int>, day int")
    df = df.repartitionByRange(files, "t") if sorted_ else df.repartition(files, "k")
    df.write.partitionBy("day").parquet(path)
    return spark.read.parquet(path)


def some(n, seed=1, nulls=0.0):
    rng = random.Random(seed)
    return [(None if rng.random() < nulls else rng.randint(0, 400), i, (rng.randint(0, 9),), i % 2) for i in range(n)]


def plain(rows, k, descending):
    key = (lambda r: (r[0] is None, -(r[0] or 0), -r[1])) if descending else (lambda r: (r[0] is None, r[0] or 0, r[1]))
    return [r[:2] for r in sorted(rows, key=key)[:k]]


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("nulls", [0.0, 0.3, 1.0])
@pytest.mark.parametrize("sorted_", [True, False])
def test_top_k_is_exact(spark, tmp_path, descending, nulls, sorted_):
    rows = some(300, nulls=nulls)
    table = table_of(spark, str(tmp_path / "t"), rows, sorted_=sorted_)
    zones = zones_of(table, ["t"])
    for k in (0, 1, 17, 250, 400):
        got = top_k(table, zones, k, "t", descending, ("k",))
        assert [(r.t, r.k) for r in got.rows.collect()] == plain(rows, k, descending)
        assert got.rows.columns == table.columns


def test_few_files_are_read(spark, tmp_path):
    table = table_of(spark, str(tmp_path / "t"), some(4000), files=12)
    write_zones(spark, str(tmp_path / "t"), str(tmp_path / "z"), ["t", "meta.o"])
    zones = spark.read.parquet(str(tmp_path / "z"))
    assert {"low_t", "high_meta_o", "nulls_t"} < set(zones.columns) and zones.count() == 24
    found = top_k(table, zones, 50, "t", True, ("k",))
    assert found.files == 24 and found.files_read <= 6
    assert found.rows.count() == 50
    opened = found.rows.inputFiles()
    assert len(opened) <= found.files_read


def test_ties_at_the_border_and_nested_column(spark, tmp_path):
    rows = some(500)
    table = table_of(spark, str(tmp_path / "t"), rows)
    got = top_k(table, zones_of(table, ["meta.o"]), 40, "meta.o", True, ("k",))
    want = sorted(rows, key=lambda r: (-r[2][0], -r[1]))[:40]
    assert [r.k for r in got.rows.collect()] == [r[1] for r in want]


def test_empty_table(spark, tmp_path):
    table = table_of(spark, str(tmp_path / "t"), some(5)).limit(0)
    table.write.parquet(str(tmp_path / "e"))
    empty = spark.read.parquet(str(tmp_path / "e"))
    assert top_k(empty, zones_of(empty, ["t"]), 5, "t").rows.count() == 0


def test_bloom_filters_skip_row_groups(spark, tmp_path):
    # Offsets of every file span the same range, so only the Bloom filters can rule a file out.
    rows = spark.range(40_000).select(F.struct((F.col("id") * 2).alias("offset"), F.lit(1).alias("partition")).alias("kafka_metadata"),
                                      (F.col("id") % 8).alias("part"), F.repeat(F.lit("x"), 20).alias("body"))
    dealt = rows.repartition(8, "part")
    dealt.write.parquet(str(tmp_path / "plain"))
    with_blooms(dealt.write, {"kafka_metadata.offset": 10_000}).parquet(str(tmp_path / "bloom"))

    def read(name, offset):
        found = lookup(spark.read.parquet(str(tmp_path / name)), partition=1, offset=offset)
        number = len(found.collect())
        leaves = found._jdf.queryExecution().executedPlan().collectLeaves()
        return number, int(leaves.head().metrics().get("numOutputRows").get().value())

    (none, all_rows), (zero, few) = read("plain", 20_001), read("bloom", 20_001)
    assert none == zero == 0 and few < all_rows / 4
    assert read("bloom", 20_002)[0] == 1
