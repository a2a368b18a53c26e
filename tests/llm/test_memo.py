"""Pieces are kept in arrays: what is found is what was put, in bounded memory, and each word is merged once."""

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from flowscore.llm import memo, tokens


def keyed(texts):
    raw = [t.encode() for t in texts]
    sizes = np.array([len(r) for r in raw], dtype=np.int32)
    data = np.frombuffer(b"".join(raw) + bytes(memo.KEY_BYTES + 1), dtype=np.uint8)
    return memo.keys_of(data, np.cumsum(sizes, dtype=np.int32) - sizes, sizes)


def test_found_is_what_was_put():
    texts = ["a", "a\0", "ab", "\0", "b" * 8, "b" * 9, "é" * 15, "c" * 31, "c" * 30] + [f"word{i}" for i in range(500)]
    sizes = np.array([1 + i % memo.KEY_IDS for i in range(len(texts))], dtype=np.int32)
    flat = np.arange(sizes.sum(), dtype="<u4")
    kept = memo.Memo(4000, np.dtype("<u4"))
    kept.put(*keyed(texts), sizes, flat)
    places = kept.find(*keyed(texts))
    assert len(kept) == len(texts) and (places >= 0).all() and (kept.sizes(places) == sizes).all()
    assert (kept.ids(places) == flat).all()
    assert (kept.find(*keyed(["", "b", "c" * 32, "c" * 31 + "\x1f", "word500", "é" * 14])) == -1).all()
    assert "word7" in kept and "word" not in kept and "c" * 40 not in kept


def test_same_hash_is_not_the_same_string():
    (key, other), hashes = keyed(["one", "two"])
    kept = memo.Memo(8, np.dtype("<u2"))
    kept.put(key[None], hashes[:1], np.array([1], np.int32), np.array([5], "<u4"))
    assert kept.find(np.array([key, other]), hashes[[0, 0]]).tolist()[1] == -1


def test_the_oldest_of_a_row_goes():
    kept = memo.Memo(8, np.dtype("<u2"))
    texts = [f"w{i}" for i in range(1000)]
    for at in range(0, 1000, 50):
        kept.put(*keyed(texts[at:at + 50]), np.ones(50, np.int32), np.arange(at, at + 50, dtype="<u4"))
    places = kept.find(*keyed(texts))
    assert len(kept) <= len(kept._sizes) <= 32 and (places[-4:] >= 0).all()
    assert (kept.ids(places[places >= 0]) == np.flatnonzero(places >= 0)).all()


@pytest.mark.parametrize("name", [tokens.BYTE_BPE, tokens.WORD_BPE])
def test_a_word_is_merged_once_beside_signs_and_in_the_next_slice(name):
    path = tokens.tokenizer_path(name)
    encoder, whole, looked = tokens.Encoder(path), Tokenizer.from_file(path), []
    encoder._pieces = lambda pieces, was=encoder._pieces: looked.extend(pieces) or was(pieces)
    texts = ["x some some, some### some. some&&&& été été, été!! Élan×, ×, ÷. it's, it's&& some" + "#" * 9 + " é́. x_,",
             "x some... some; été; some_ été__ x_ \nsome, \nsome## some , some’,"]
    for text in texts:
        got = encoder.encode_many(pa.array([text]))[0].tolist()
        assert got == whole.encode(text, add_special_tokens=False).ids
    assert looked.count("some") == looked.count("été") == 1 and "some###" not in looked and "été," not in looked


def test_without_signs_apart(monkeypatch):
    path = tokens.tokenizer_path(tokens.BYTE_BPE)
    encoder, whole = tokens.Encoder(path), Tokenizer.from_file(path)
    encoder._apart, encoder._space = False, None
    for text in ["one, two. été&& one", "", "\n", "a\tb  c"]:
        assert encoder.encode_many(pa.array([text]))[0].tolist() == whole.encode(text, add_special_tokens=False).ids
