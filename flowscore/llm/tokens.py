"""Encoding of whole texts with the public tokenizers, as little-endian unsigned 32-bit ids.

White space ends a token in both vocabularies, so a text is cut at plain single spaces and line ends, each cut piece is
encoded once by the tokenizers library and its ids are kept (as bytes) for the next time the piece comes up.  The ids
are those of the whole text: a single space or line end between two characters that are not white space always starts a
new pre-token, and merges never cross pre-tokens (``tests/llm/test_tokens.py`` compares with whole-text encoding).
A comma or full stop that ends a piece after a letter is a token of its own, and ASCII signs after western letters
are tokens of theirs: pieces are looked up without them.  Pieces that are one Latin word go to the library's merge model
directly, and so does the word before other signs.
Most distinct pieces of a corpus come once, so a piece enters the memo with its second time; a table of the hashes met
tells.  Pieces that came once wait beside it and make room for newer ones.  The memo holds two generations of
``memo_size`` pieces at most, each in arrays of fixed size, so a worker's memory is bounded.  It is looked up for all
distinct pieces of a slice of text at once (``memo.py``); only those not found become Python strings.
"""

from __future__ import annotations

import codecs
import gc
import os
import re
from array import array
from contextlib import contextmanager
from itertools import chain
from operator import attrgetter
from string import ascii_letters, punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from flowscore.llm.held import held
from flowscore.llm.memo import KEY_BYTES, KEY_IDS, Memo, keys_of, spread

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"
#: Places for the hashes of pieces met, a power of two (a byte each); half of them taken, they start anew.
MET_PLACES = 1 << 21
#: Words merged at once.
MERGED = 2048
#: Bytes of text cut into pieces at once; a longer text is encoded in parts of that size.
SLICE = 2 << 20
# A single space between two characters that are not white space, as a zero-width cut before it.
_CUT = re.compile(r"(?<=\S)(?= \S)")
# Byte-level vocabularies spell each byte as a character: printable ones as themselves, the others from 256 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SPELLED = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTED)}
_SPELLING = "".join(chr(_SPELLED.get(b, b)) for b in range(256))
#: Runs of ASCII signs after words whose ids are kept: so many at most, of so many signs.
SIGN_RUNS, SIGNS = 1 << 12, 8
# What a byte of a text is: a letter, an ASCII sign or anything else.
_LETTER, _SIGN = 1, 2
_BYTES = np.zeros(256, dtype=np.uint8)
_BYTES[list(ascii_letters.encode())], _BYTES[list(punctuation.encode())] = _LETTER, _SIGN
# Letters below this code point are the same in every Unicode version.
_LATIN_END = "\u0250"


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@contextmanager
def no_collection():
    """Without Python's search for reference cycles, for work that makes none but many objects."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


class Encoder:
    """Texts to id bytes.  ``path`` is a tokenizers JSON file; special-token strings in a text are ordinary text."""

    def __init__(self, path: str, memo_size: int = 200_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self._tok = Tokenizer.from_file(path)
        self._tok.encode_special_tokens = True
        self._model = self._tok.model
        self.vocabulary = self._tok.get_vocab_size()
        # Piece -> ids.  A piece is what follows a space (not part of the key) or begins a line ("\n" and the piece).
        self._kind = np.dtype("<u2" if self.vocabulary <= 1 << 16 else "<u4")
        self._memo, self._older = Memo(memo_size, self._kind), Memo(1, self._kind)
        self._once = Memo(memo_size // 2, self._kind)
        self._memo_size = memo_size
        self._met, self._n_met = np.zeros(MET_PLACES, dtype=np.uint8), 0
        self._after: dict[str, bytes] = {"": b""}  # ids of signs after a word
        self._newline, self._comma, self._stop = self._encode(["\n", ",", "."])
        self._lower = self._tok.normalizer is not None
        self._space = self._spelled_space()
        # Whether signs at the end of a piece are ids of their own.
        self._apart = self._space is not None and len(self._comma) == len(self._stop) == 4

    def _encode(self, pieces: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes()
                for e in self._tok.encode_batch_fast(pieces, add_special_tokens=False)]

    def _merge(self, spelled: str) -> bytes:
        return array("I", [t.id for t in self._model.tokenize(spelled)]).tobytes()

    def _spelled_space(self) -> str | None:
        """What the space before a word is to the merge model; None if words can't be handed to it alone."""
        probes = ["the", "Word", "\u00c9lan", "stra\u00dfe", "\u00f1and\u00fa"]
        for space in (chr(_SPELLED[32]), ""):
            self._space = space
            if [self._word(p, space) for p in probes] == self._encode([" " + p for p in probes]) and \
                    self._encode([" the" + x for x in (",", ".", "&&&")]) == [
                        self._word("the", space) + x for x in self._encode([",", ".", "&&&"])]:
                return space
        return None

    def _word(self, word: str, space: str) -> bytes | None:
        """Ids of a Latin word after a space (or none), None if it is not one."""
        spelled = self._spelled(word, space)
        return None if spelled is None else self._merge(spelled)

    def _spelled(self, word: str, space: str) -> str | None:
        """What a Latin word after a space (or none) is to the merge model, None if it is not one."""
        if not word.isalpha():
            return None
        if word.isascii():
            return space + (word.lower() if self._lower else word)
        if max(word) >= _LATIN_END:
            return None
        if self._lower:  # composed letters stay what they are when composed and lower-cased
            word = word.lower()
            if not word.isalpha():
                return None
        return space + codecs.charmap_decode(word.encode(), "strict", _SPELLING)[0]

    def _piece(self, piece: str) -> bytes | None:
        """Ids of a piece that is a word, ASCII signs after it or not; None if it is anything else."""
        space, first = self._space, piece[0] == "\n"
        if space is None:
            return None
        word = piece[first:].rstrip(punctuation)
        signs = piece[first + len(word):]
        if not word.isalpha() or not word.isascii() and max(word) >= _LATIN_END or len(signs) > SIGNS:
            return None  # other signs merge with the last one
        end = self._sign_ids(signs)
        if first:
            ids = self._word(word, "")
            return None if ids is None else self._newline + ids + end
        ids = self._word(word, space)
        return None if ids is None else ids + end

    def _sign_ids(self, signs: str) -> bytes:
        ids = self._after.get(signs)
        if ids is None:
            ids = self._encode([signs])[0]
            if len(self._after) < SIGN_RUNS:
                self._after[signs] = ids
        return ids

    def _remember(self, keys: np.ndarray, hashes: np.ndarray, sizes: np.ndarray, flat: np.ndarray) -> None:
        """Keep the ids of pieces: of those that came before in the memo, of the others beside it."""
        fit = np.flatnonzero((sizes > 0) & (sizes <= KEY_IDS) & (keys[:, -1] >> np.uint64(56) <= KEY_BYTES))
        places = (hashes[fit] >> np.uint64(40)) % np.uint64(len(self._met))
        before = self._met[places] > 0
        first = np.unique(places[~before])
        self._met[first] = 1
        self._n_met += len(first)
        if 2 * self._n_met > len(self._met):
            self._met, self._n_met = np.zeros(len(self._met), dtype=np.uint8), 0
        firsts = np.cumsum(sizes, dtype=np.int32) - sizes
        for memo, put in (self._memo, fit[before]), (self._once, fit[~before]):
            memo.put(keys[put], hashes[put], sizes[put], flat[spread(firsts[put], sizes[put])])

    def _looked_up(self, keys: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of pieces: which are kept, how many ids each of those has, and the ids one after another."""
        if len(self._memo) > self._memo_size:
            self._memo, self._older = Memo(self._memo_size, self._kind), self._memo
        places = self._memo.find(keys, hashes)
        kept, rest = np.flatnonzero(places >= 0), np.flatnonzero(places < 0)
        out = [(kept, self._memo.sizes(places[kept]), self._memo.ids(places[kept]))]
        for memo in self._older, self._once:
            places = memo.find(keys[rest], hashes[rest])
            hit, rest, places = rest[places >= 0], rest[places < 0], places[places >= 0]
            sizes = memo.sizes(places)
            out.append((hit, sizes, memo.ids(places)))
            # Pieces that differ by the signs after them only are one here.
            once = np.unique(places, return_index=True)[1]
            self._memo.put(keys[hit[once]], hashes[hit[once]], sizes[once], memo.ids(places[once]))
        kept, sizes, ids = map(np.concatenate, zip(*out, strict=True))
        return kept, sizes, ids

    def _tails(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Bytes at the end of each piece whose ids are laid out beside those of the rest."""
        if not self._apart:
            return np.zeros(len(sizes), dtype=np.int32)
        kinds, stops = _BYTES[data], starts + sizes
        lead = np.flatnonzero(data[:-1] == 0xC3)  # of the letters from U+00C0 to U+00FF, but for two signs
        lead = lead[~np.isin(data[lead + 1], (0x97, 0xB7))]
        kinds[lead] = kinds[lead + 1] = _LETTER
        ends = np.maximum.accumulate(np.where(kinds == _SIGN, 0, np.arange(1, len(data) + 1, dtype=np.int32)))
        letters = np.concatenate((np.zeros(1, np.int32), np.cumsum(kinds == _LETTER, dtype=np.int32)))
        ends, first = ends[stops - 1], starts + (data[starts] == 10)
        tails = np.where((sizes > 0) & (ends > first) & (ends < stops), stops - ends, 0)
        word = letters[ends] - letters[np.minimum(first, ends)] == ends - first
        one = (tails == 1) & (kinds[ends - 1] == _LETTER) & np.isin(data[stops - 1], (44, 46))
        return np.where((tails <= SIGNS) & word | one, tails, 0).astype(np.int32)

    def _pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """How many ids each distinct piece has, the ids one after another, and which are beside other white space."""
        space, lower, spelled, words, rest = self._space, self._lower, [], [], {}
        odd = np.zeros(len(pieces), dtype=bool)
        for i, piece in enumerate(pieces):
            if space is not None and piece.isalpha():
                word = space + (piece.lower() if lower else piece) if piece.isascii() else self._spelled(piece, space)
                if word is None:
                    rest[i] = None
                else:
                    spelled.append(word)
                    words.append(i)
            elif piece and piece != "\n" and not piece[-1].isspace() and not piece[piece[0] == "\n"].isspace():
                rest[i] = self._piece(piece)
            else:
                odd[i] = True
        unseen = [i for i, ids in rest.items() if ids is None]
        if unseen:
            rest.update(zip(unseen, self._encode([p if p[0] == "\n" else " " + p for p in map(pieces.__getitem__, unseen)]),
                            strict=True))
        sizes, flat = [], []
        for i in range(0, len(spelled), MERGED):
            merged = list(map(self._model.tokenize, spelled[i:i + MERGED]))
            sizes.append(np.fromiter(map(len, merged), dtype=np.int32, count=len(merged)))
            flat.append(np.fromiter(map(attrgetter("id"), chain.from_iterable(merged)), dtype="<u4"))
        sizes.append(np.fromiter(map(len, rest.values()), dtype=np.int32, count=len(rest)) >> 2)
        flat.append(np.frombuffer(b"".join(rest.values()), dtype="<u4"))
        sizes, flat, where = np.concatenate(sizes), np.concatenate(flat), np.array(words + list(rest), dtype=np.int64)
        in_order = np.zeros(len(pieces), dtype=np.int32)
        in_order[where] = sizes
        firsts = np.zeros(len(pieces), dtype=np.int32)
        firsts[where] = np.cumsum(sizes, dtype=np.int32) - sizes
        return in_order, flat[spread(firsts, in_order)], odd

    def _laid_out(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the distinct pieces one after another, how many each has, and which are beside other white space."""
        starts = np.frombuffer(pieces.buffers()[1], dtype=np.int32)[pieces.offset:pieces.offset + len(pieces) + 1]
        bytes_ = np.diff(starts)
        text = pieces.buffers()[2]
        data = np.concatenate((np.frombuffer(text, dtype=np.uint8) if text is not None else np.zeros(0, np.uint8),
                               np.zeros(KEY_BYTES + 1, dtype=np.uint8)))
        tails = self._tails(data, starts[:-1], bytes_)
        keys, hashes = keys_of(data, starts[:-1], bytes_ - tails)
        kept, kept_sizes, kept_ids = self._looked_up(keys, hashes)
        new = np.ones(len(pieces), dtype=bool)
        new[kept] = False
        new = np.flatnonzero(new)
        words = pieces.take(pa.array(new))
        words = pc.if_else(pa.array(tails[new] > 0), pc.utf8_rtrim(words, characters=punctuation),
                           words).dictionary_encode()
        found_sizes, found_ids, beside = self._pieces(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        at = words.indices.to_numpy()
        first = np.zeros(len(found_sizes), dtype=np.int64)
        first[at[::-1]] = new[::-1]
        self._remember(keys[first], hashes[first], found_sizes, found_ids)
        odd = np.zeros(len(pieces), dtype=bool)
        odd[new] = beside[at]
        signed = np.flatnonzero(tails)
        runs, which = np.unique(keys_of(data, starts[1:][signed] - tails[signed], tails[signed])[0][:, 0],
                                return_inverse=True)
        runs = [self._sign_ids(int(r).to_bytes(8, "little").rstrip(b"\0").decode()) for r in runs]
        # The ids of kept words, of new ones and of signs; a piece is a part of the first two and one of the last.
        sizes = [kept_sizes, found_sizes, np.array(list(map(len, runs)), dtype=np.int32) >> 2]
        flat = np.concatenate((kept_ids.astype("<u4"), found_ids, np.frombuffer(b"".join(runs), dtype="<u4")))
        firsts = np.split(np.cumsum(np.concatenate(sizes), dtype=np.int32) - np.concatenate(sizes),
                          np.cumsum([len(kept), len(found_sizes)]))
        lengths, places = np.zeros((len(pieces), 2), dtype=np.int32), np.zeros((len(pieces), 2), dtype=np.int32)
        for rows, part, of, take in (kept, 0, 0, slice(None)), (new, 0, 1, at), (signed, 1, 2, which):
            lengths[rows, part], places[rows, part] = sizes[of][take], firsts[of][take]
        return flat[spread(places.reshape(-1), lengths.reshape(-1))], lengths.sum(axis=1, dtype=np.int32), odd

    def encode_many(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text of a string array (null: none), a few MB of text at a time."""
        texts = texts.cast(pa.string()).fill_null("")
        ends, out = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)), []
        at = 0
        while at < len(texts):
            done = ends[at - 1] if at else 0
            to = max(int(np.searchsorted(ends, done + SLICE, side="right")), at + 1)
            if ends[to - 1] - done > SLICE:
                out.append(np.frombuffer(self._plain(texts[at].as_py()), dtype="<u4"))
            else:
                with no_collection():
                    out += self._slice(texts.slice(at, to - at))
                pa.default_memory_pool().release_unused()  # else Arrow keeps what the slice took for the next one
            at = to
        return out

    def _slice(self, texts: pa.Array) -> list[np.ndarray]:
        """Each distinct piece of the texts is looked up once; ids are then laid out by arithmetic on their lengths."""
        lined = pc.replace_substring(pc.binary_join_element_wise("\n", texts, ""), "\n", " \n")
        split = pc.split_pattern(lined, " ")
        # The text's own start is a space and a line end, so its first piece is empty.
        firsts = split.offsets.to_numpy() - split.offsets[0].as_py()
        coded = split.flatten().dictionary_encode()
        flat, lengths, odd = self._laid_out(coded.dictionary)
        index = coded.indices.to_numpy()
        index_odd = odd[index]
        index_odd[firsts[:-1]] = False
        sizes = lengths[index]
        stops = np.concatenate((np.zeros(1, np.int32), np.cumsum(sizes, dtype=np.int32)))
        ids = flat[spread((np.cumsum(lengths, dtype=np.int32) - lengths)[index], sizes)]
        starts, ends = stops[firsts[:-1]] + (len(self._newline) >> 2), stops[firsts[1:]]
        out = [ids[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        for i in np.unique(np.searchsorted(firsts, np.flatnonzero(index_odd), side="right") - 1).tolist():
            out[i] = np.frombuffer(self._plain(texts[i].as_py()), dtype="<u4")
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_many(pa.array([text], pa.string()))[0].tobytes()

    def _plain(self, text: str) -> bytes:
        """Whole parts of a text, cut at single spaces only where it is very long."""
        out, at = [], 0
        while len(text) - at > SLICE:
            cut = _CUT.search(text, at + SLICE // 2)
            if cut is None:
                break
            out.append(text[at:cut.start()])
            at = cut.start()
        return b"".join(self._encode([*out, text[at:]]))


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file, made once per Python worker."""
    return held(("tokens", path), lambda: Encoder(path))
