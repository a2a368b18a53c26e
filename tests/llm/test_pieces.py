"""Merge rounds give the ids and texts of the sentencepiece library."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowscore.llm import pieces
from flowscore.llm import queries as Q
from flowscore.llm.tokens import tokenizer_path

SF = "/root/testdata/sf0.001"
ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "\n\n", "\ta\x00b", "▁a ▁▁b", "é ﬁ Å", "é", "　x", "𝒳 😀 ␀", "<s> <0x41> <unk>", "中文 字符",
       "==== ---- ....", "1234567", " " * 40 + "x", "a" * 300, "　" * 9, "aaa bbb  ccc   ddd    e"]


@pytest.fixture(scope="module")
def both():
    from sentencepiece import SentencePieceProcessor
    path = tokenizer_path(pieces.MODEL)
    return pieces.PieceModel(path), SentencePieceProcessor(model_file=path)


def same(both, text):
    ours, library = both
    ids = ours.encode_many([text])[0].tolist()
    return ids == library.encode(text) and ours.decode(ids) == library.decode(ids)


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(both, text):
    assert same(both, text) and same(both, f"before {text} after")


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet=st.sampled_from("abtheingçé ▁\n.=-01中😀\x00ИİΣ́"), max_size=40))
def test_any_text(both, text):
    assert same(both, text)


def test_joined_pieces(both):
    rng, library = random.Random(4), both[1]
    names = [library.id_to_piece(rng.randrange(259, library.get_piece_size())) for _ in range(3000)]
    for i in range(0, len(names), 6):
        assert same(both, "".join(names[i:i + 6]).replace("▁", " " if i % 4 else ""))


@settings(max_examples=500, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 2), st.integers(3, 258), st.integers(259, 31999)), max_size=12))
def test_any_ids(both, ids):
    assert both[0].decode(ids) == both[1].decode(ids)


@pytest.mark.parametrize("text", ["a" * 50_000, " " * 20_000, "中" * 30_000, "".join(random.Random(1).choices("abcdefgh", k=40_000))])
def test_long_words(both, text):
    assert same(both, text)


def test_ties_one_by_one(both, monkeypatch):
    monkeypatch.setattr(pieces, "LONG_TIES", 0)
    for n in range(1, 70):
        assert same(both, "x" + " " * n + "y")


def test_memo_is_bounded(both, monkeypatch):
    monkeypatch.setattr(pieces, "MEMO_SIZE", 3)
    for i in range(6):
        assert same(both, f"word{i} the word{i + 1} of things")
    assert len(both[0]._memo) < 20


def test_table(spark, both):
    texts = [None, *ODD, "word " * 30_000, "a b", "a b"]
    rows = spark.createDataFrame([(None if i == 1 else i, t, "x", i, "r") for i, t in enumerate(texts)],
                                 "doc_id int, text string, `in 0` string, row bigint, out0 string")
    out = pieces.decode(pieces.encode(rows), out_col="again", digest_col="sha")
    assert out.columns == [*rows.columns, "ids", "again", "sha"]
    for r in out.collect():
        ids = both[1].encode(r.text or "")
        assert r.ids == ids and r.again == both[1].decode(ids)
        assert r.sha == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert sorted(r.row for r in out.select("row").collect()) == list(range(len(texts)))
    assert pieces.encode(rows.limit(0)).count() == 0
    replaced = pieces.encode(rows.withColumn("ids", F.lit(1)))
    assert replaced.schema["ids"].dataType.simpleString() == "array<int>"
    nulls = spark.createDataFrame([([1, None, 264],), (None,)], "ids array<int>")
    assert [r.text for r in pieces.decode(nulls).collect()] == ["a", None]
    with pytest.raises(Exception, match="vocabulary"):
        pieces.decode(spark.createDataFrame([([40_000],)], "ids array<int>")).collect()


def test_query(spark, both):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = Q.op13_pieces(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = both[1].encode(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(both[1].decode(ids).encode()).hexdigest()
