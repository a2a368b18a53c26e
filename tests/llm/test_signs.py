"""A comma or full stop that ends a piece is laid out beside the word before it, which is merged once."""

import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from flowscore.llm import tokens

TEXTS = ["one, two. one two, two", "\nOne, one.\nOne. x,", "a,, b., c.. d,. ,", "é, été. élan, (one, one), 3, 3.one, one3.",
         "one\t, \tone, one,\n\none.  one,   two.", ".", ",", "a.", "one," * 50, "one&&& two*** It's, it's&'s don't'' x_y_ a--b-- (a) end.'\nOne###\nUno!!\né&&&",
         "one#one# " + " ".join("one" + "#" * i for i in range(12)), "sein. Straße, ΟΔΟΣ. ñandú, é, oné.", "", None]


@pytest.mark.parametrize("name", [tokens.BYTE_BPE, tokens.WORD_BPE])
def test_signs_after_words(name):
    whole, encoder = Tokenizer.from_file(tokens.tokenizer_path(name)), tokens.Encoder(tokens.tokenizer_path(name))
    for _ in range(2):
        got = encoder.encode_many(pa.array(TEXTS, pa.string()))
        assert [x.tolist() for x in got] == [whole.encode(t or "", add_special_tokens=False).ids for t in TEXTS]


def test_a_word_known_is_not_looked_at_again_before_a_sign(monkeypatch):
    encoder, looked = tokens.Encoder(tokens.tokenizer_path(tokens.BYTE_BPE)), []
    encoder.encode_many(pa.array(["some word", "other words"], pa.string()))
    monkeypatch.setattr(encoder, "_piece", lambda piece, was=encoder._piece: looked.append(piece) or was(piece))
    encoder.encode_many(pa.array(["x some, x word. x other, x words."], pa.string()))
    assert [p for p in looked if p[0] != "\n"] == []
