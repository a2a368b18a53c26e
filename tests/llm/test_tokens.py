"""The memoised encoder gives the ids of whole-text encoding."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from flowscore.llm import tokens

NAMES = [tokens.BYTE_BPE, tokens.WORD_BPE]
ODD = ["", " ", "\n", "a", " a", "a ", "a  b", "a\n\nb", "a \n b", "a\tb c", "\ta b", "Don't, stop. Now...", "é́ x",
       "ΑΣ Σ ς", "İstanbul ISTANBUL ı", "<|endoftext|> a<|endoftext|>b", "名前 は 何 ですか", "x y z", "a\r\nb c", "1234 5,6 7.",
       "word, word. Word,word. ,a .b", "\x1c a\x1cb", "straße Ñandú, ÉLAN.", "ªº ²³ Ⅷ", ". .. ... , ,, ,.", "中 中. 中, é. é.. .é", "a" * 300 + " b"]


@pytest.fixture(scope="module", params=NAMES)
def both(request):
    from tokenizers import Tokenizer
    path = tokens.tokenizer_path(request.param)
    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    return tokens.Encoder(path, memo_size=50), whole


def same(both, text):
    ours, whole = both
    want = np.array(whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
    return ours.encode(text) == want and ours.encode(text) == want


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(both, text):
    assert same(both, text)
    assert same(both, f"before {text} after")


def test_words_go_to_the_merge_model(both):
    assert both[0]._space is not None


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet=st.sampled_from("abcé ßÑ\n\t.,'s1 İσΣ́ 中"), max_size=40))
def test_any_text(both, text):
    assert same(both, text)
