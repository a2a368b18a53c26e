"""Pipeline stages on foreign and random texts, odd and empty tables, and columns of any names."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from flowscore.llm.scratch import keep
from flowscore.llm import decontam, langid, packing, quality, rollups, simhash

SF = "/root/testdata/sf0.01"
STAGES = dict(corpus_pipeline.STAGES)
FOREIGN = [
    "Il gatto nero dorme tranquillamente sul divano mentre fuori piove e il vento soffia forte tra gli alberi del giardino.",
    "De zwarte kat slaapt rustig op de bank terwijl het buiten regent en de wind hard door de bomen waait.",
    "Czarny kot śpi spokojnie na kanapie, podczas gdy na zewnątrz pada deszcz i wiatr mocno wieje między drzewami.",
    "黒い猫は外で雨が降り風が木々の間を強く吹いている間、ソファで静かに眠っています。"]


def test_language_stage_rejects_foreign_and_random_texts(spark):
    rng = random.Random(1)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9)))
    odd = [(10**6 + i, " ".join(word() for _ in range(50 if i % 2 else 500)), None, "odd", 0) for i in range(40)]
    odd += [(2 * 10**6 + i, " ".join([t] * 8), None, "odd", 0) for i, t in enumerate(FOREIGN)]
    odd += [(3 * 10**6, "123 !!", "en", "odd", 0), (3 * 10**6 + 1, None, "en", "odd", 0)]
    kept = STAGES["language_id"](spark, docs.unionByName(spark.createDataFrame(odd, docs.schema)), SF)
    assert kept.columns == docs.columns
    assert kept.filter("source = 'odd'").count() <= 2
    assert kept.filter("source <> 'odd'").count() >= 0.99 * docs.count()


def test_language_stage_keeps_all_where_nothing_is_learned(spark):
    docs = spark.createDataFrame([(1, "some words", None), (2, None, None), (3, "12", None)], "doc_id int, text string, lang string")
    assert langid.in_language(docs).count() == 3
    few = docs.withColumn("lang", F.lit("en"))
    assert sorted(r.doc_id for r in langid.in_language(few).collect()) == [1]
    assert langid.in_language(docs.limit(0)).count() == 0


ODD_ROWS = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "the cat sat on the mat", "en", "a", 22),
            (3, "the cat sat on the mat", "en", "a", 22), (None, "le chat est là", "fr", None, 14), (5, "12 34 !!", "de", "b", 8),
            (6, "word " * 30_000, "en", "a", 150_000)]
NAMES = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.mark.parametrize("name", list(STAGES))
@pytest.mark.parametrize("rows", [ODD_ROWS, []])
def test_stages_on_odd_and_empty_tables(spark, name, rows):
    out = STAGES[name](spark, spark.createDataFrame(rows, NAMES), "/root/testdata/sf0.001")
    if name != "packing":
        assert out.columns == [x.split()[0] for x in NAMES.split(", ")]
    assert out.count() >= (1 if rows else 0)


CLASH = "doc_id bigint, text string, lang string, __row {0}, `a b` struct<`x y`: int>, `t``k` int, __text int, id int, row int, doc int"


@pytest.mark.parametrize("kind,value", [("bigint", 777), ("string", "mine")])
def test_columns_of_any_names(spark, kind, value):
    docs = spark.createDataFrame([(1, "the same words of a text", "en", value, (5,), 1, 2, 3, 4, 5),
                                  (2, "the same words of a text", "en", value, (6,), 1, 2, 3, 4, 5)], CLASH.format(kind))
    one = simhash.keep_one(docs).collect()
    assert len(one) == 1 and one[0]["__row"] == value and one[0]["a b"]["x y"] == 5 and one[0]["row"] == 4
    said = langid.predict(docs.withColumn("text", F.lit(5)), langid.train(docs)).collect()
    assert said[0]["t`k"] == 1 and said[0].lang_pred == "und" and said[0]["__row"] == value
    assert langid.in_language(docs).columns == docs.columns


@pytest.mark.parametrize("kind,value", [("bigint", 777), ("string", "mine")])
def test_columns_of_any_names_beside_items_counts_and_priors(spark, kind, value):
    rows = [(1, "one two three four five six seven", "en", value, (5,), 1, 2, 3, 4, 5),
            (2, "nothing of the kind", "en", value, (6,), 1, 2, 3, 4, 5)]
    docs = spark.createDataFrame(rows, CLASH.format(kind))
    items = spark.createDataFrame([(9, "two three four five six")], "item_id int, text string")
    found = decontam.Decontamination(docs, items)
    assert [(r.doc_id, r.item_id) for r in found.pairs().collect()] == [(1, 9)]
    left = found.clean()
    assert left.columns == docs.columns and [r["__row"] for r in left.collect()] == [value]
    counted = rollups.token_counts(docs, out_col="n `x`").collect()
    assert all(r["n `x`"] > 0 and r["__row"] == value and r["a b"]["x y"] in (5, 6) for r in counted)
    sites = docs.withColumns({"host": F.lit("h"), "path": F.lit("p"), "path_prior": F.lit("mine"), "h": F.lit(1)})
    binned = quality.with_features(sites)
    judged = quality.classify(binned, binned.withColumn("good", F.lit(1)).select("host", "path", "bins", "good")).collect()
    assert all(r["path_prior"] == "mine" and r["h"] == 1 and r["a b"]["x y"] in (5, 6) and r.quality > 0.5 for r in judged)


def test_documents_of_one_term_are_dealt_to_several_parts(spark):
    """A third of all documents are copies: they lie in more than one part, and no document is lost."""
    import numpy as np
    rows = [(i, "the very same words again") if i % 3 == 0 else (i, f"other{i} thing{i % 7} words") for i in range(600)]
    encoded = packing.encode(spark.createDataFrame(rows, "doc_id int, text string").repartition(6), "doc_id", "text",
                             packing.tokens.tokenizer_path(packing.tokens.BYTE_BPE), 1)
    size = packing.tokens.encoder(packing.tokens.tokenizer_path(packing.tokens.BYTE_BPE)).vocabulary
    frequency, documents, mean = packing.corpus_statistics(encoded, size)
    idf = np.maximum(np.log((documents - frequency + 0.5) / (frequency + 0.5)), 0).astype(np.float32)
    idf[frequency == 0] = 0
    dealt = packing.by_content(encoded, spark.sparkContext.broadcast(idf), size, 32, mean, frequency, 200)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = dealt.select("id", F.spark_partition_id().alias("part")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(r.id for r in got) == list(range(600))
    assert len({r.part for r in got if r.id % 3 == 0}) > 3


def test_terms_of():
    import numpy as np
    for kind in ("<u2", "<u4"):
        ids = np.array([5, 1, 5, 40_000, 1, 5], dtype=kind)
        assert [x.tolist() for x in packing.terms_of(ids)] == [[1, 5, 40_000], [2, 3, 1]]
        assert len(packing.terms_of(ids[:0])[0]) == 0


def test_pipeline_keeps_one_stage_of_documents(spark, monkeypatch):
    import os

    import corpus_pipeline
    kept = []

    def noting(df, kind):
        kept.append(keep(df, kind))
        return kept[-1]

    monkeypatch.setattr(corpus_pipeline, "keep", noting)
    monkeypatch.setattr(corpus_pipeline, "STAGES", [(str(i), lambda spark, docs, sf_dir: docs.filter("true")) for i in range(4)])
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert [os.path.exists(df._scratch_path) for df in kept] == [False, False, True]
    assert rows.count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()


@pytest.mark.parametrize("name,copies", [("language_id", 0.3), ("near_duplicates", 1.4), ("decontamination", 0.3)])
def test_stage_leaves_few_copies_of_the_documents(spark, name, copies):
    """The tables that a stage has written hold the documents' texts no more often than it needs."""
    import os

    from flowscore.session import shared_dir
    docs = keep(spark.read.parquet(f"{SF}/documents.parquet"), "stage-test")

    def size(path):
        return sum(os.path.getsize(f"{d}/{f}") for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))

    top = shared_dir(spark, "flowscore").removeprefix("file://")
    before = size(top)
    assert STAGES[name](spark, docs, SF).count() > 0.8 * docs.count()
    assert size(top) - before < copies * size(docs._scratch_path.removeprefix("file://"))


def test_texts_that_go_take_their_repeats_along(spark):
    text = "one two three four five six seven"
    rows = [(1, text, "a"), (1, text, "a"), (2, text, "b"), (3, None, "c"), (4, text + " eight nine ten", "d"), (5, "other", "e")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, key string")
    items = spark.createDataFrame([(9, text)], "item_id int, text string")
    left = decontam.Decontamination(docs, items).clean()
    assert left.columns == docs.columns and sorted(map(tuple, left.collect())) == [(3, None, "c"), (5, "other", "e")]
