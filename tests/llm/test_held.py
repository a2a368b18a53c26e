"""What a Python worker holds between tasks is bounded, however many stages and pieces it has seen."""

import gc
import weakref

import pyarrow as pa
import pytest

from flowscore.llm import held, langid, tokens


@pytest.mark.parametrize("name", [tokens.BYTE_BPE, tokens.WORD_BPE])
def test_pieces_that_come_once_are_not_kept(name):
    encoder = tokens.Encoder(tokens.tokenizer_path(name))
    once = [f"word{i}x" if i % 2 else "".join(chr(97 + i // 26 ** k % 26) for k in range(4)) for i in range(5000)]
    texts = pa.array([" ".join(["often", *once[i:i + 50], "often,", "straße"]) for i in range(0, 5000, 50)], pa.string())
    whole = [encoder._tok.encode(t, add_special_tokens=False).ids for t in texts.to_pylist()]
    for i, t in enumerate(texts.to_pylist()):
        assert encoder.encode_many(pa.array([t]))[0].tolist() == whole[i]
    assert "often" in encoder._memo and "straße" in encoder._memo
    assert len(encoder._memo) + len(encoder._older) < 100
    for _ in range(2):  # each comes again, now its ids are kept
        assert [ids.tolist() for ids in encoder.encode_many(texts)] == whole
    assert sum(w in encoder._memo for w in once) == 5000


def test_hashes_met_start_anew(monkeypatch):
    monkeypatch.setattr(tokens, "MET_PLACES", 64)
    encoder = tokens.Encoder(tokens.tokenizer_path(tokens.BYTE_BPE), memo_size=50)
    for k in range(3):
        texts = [f"a{i}b c{i % 7}d " + "e" * (i % 9) for i in range(k, 400)]
        assert [x.tolist() for x in encoder.encode_many(pa.array(texts))] == [
            encoder._tok.encode(t, add_special_tokens=False).ids for t in texts]
        assert encoder._n_met <= 32 and sum(encoder._met) == encoder._n_met


def test_a_worker_holds_the_tables_of_one_operator():
    """The stages of the pipeline run in the same workers: the encoder goes when the code book comes, and the other way."""
    path = tokens.tokenizer_path(tokens.BYTE_BPE)
    first = weakref.ref(tokens.encoder(path))
    assert tokens.encoder(path) is first()
    book = weakref.ref(langid.codebook(64, 3, 1))
    gc.collect()
    assert first() is None and book() is not None
    tokens.encoder(path)
    gc.collect()
    assert book() is None
    held.let_go()
    assert not held._HELD
