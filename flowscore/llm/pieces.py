"""SentencePiece encoding and decoding by vectorised merge rounds.

A text becomes flat numpy symbol arrays: one symbol a character, spaces spelled as the word mark, with a mark in front.
No piece goes on with a mark after another character, so every word (marks and what follows) is merged by itself, and
equal words once.  A round finds the lowest rank of a neighbouring pair in every word, merges its leftmost occurrences
that don't overlap in all words at once, and compacts the arrays; words without a pair leave.  Merging one pair first can
make a pair of lower rank, which one after the other would be merged before the next occurrence: where that happens the
word merges its leftmost occurrence only in that round, so the ids are those of the one-by-one rule.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowscore.llm.rows import named, with_computed
from flowscore.llm.tokens import tokenizer_path

MODEL = "piece_bpe_32k.model"
MARK = "▁"
_WORD = re.compile(" *[^ ]+| +")
#: Longer words are encoded but not kept for the next time.
MEMO_WORD = 64
MEMO_SIZE = 300_000
#: A longer word whose merges depend on each other is merged one by one.
LONG_TIES = 256
GONE = -2
NO_PAIR = np.iinfo(np.int32).max

# Each byte that is no part of a character is shown by itself.
codecs.register_error("flowscore-bytes", lambda e: ("�", e.start + 1))


class PieceModel:
    """Ids of texts and texts of ids.  ``path``: a SentencePiece BPE model with byte pieces, identity normalisation and a
    mark put in front; other models are refused."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        model = SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(self.size)]
        of_byte = {i: int(names[i][3:-1], 16) for i in range(self.size) if model.is_byte(i)}
        silent = {i for i in range(self.size) if model.is_control(i)}
        special = silent | of_byte.keys() | {model.unk_id()}
        probe = "  Á ﬁ\t x "
        if len(of_byte) != 256 or any(model.is_unused(i) for i in range(self.size)) or \
                model.normalize(probe) != MARK + probe.replace(" ", MARK):
            raise ValueError("only BPE models with byte pieces and identity normalisation are supported")
        if any(MARK in x.lstrip(MARK) for i, x in enumerate(names) if i not in special):
            raise ValueError("a piece goes on after a word's end")
        self._byte_ids = np.empty(256, dtype=np.int32)
        self._byte_ids[list(of_byte.values())] = list(of_byte)
        self._tables(names, [model.get_score(i) for i in range(self.size)], special)
        text = {i: x.replace(MARK, " ").encode() for i, x in enumerate(names)}
        text |= {i: b"" for i in silent} | {i: bytes([b]) for i, b in of_byte.items()} | {model.unk_id(): " ⁇ ".encode()}
        self._surface = np.array([text[i] for i in range(self.size)], dtype=object)
        self._silent = np.zeros(self.size, dtype=bool)
        self._silent[list(silent)] = True
        self._marked = np.array([i not in special and x.startswith(MARK) for i, x in enumerate(names)])
        self._memo: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def _tables(self, names: list[str], scores: list[float], special: set[int]) -> None:
        """Symbols: pieces by id, then characters that are only parts of pieces.  Pairs: two symbols that spell a piece."""
        symbol = {x: i for i, x in enumerate(names) if i not in special}
        for char in sorted({c for x in symbol for c in x} - symbol.keys()):
            symbol[char] = self.size + len(symbol)
        ranks = {s: r for r, s in enumerate(sorted({scores[i] for i in symbol.values() if i < self.size}, reverse=True))}
        self._symbols = max(symbol.values()) + 1
        pairs, joined = {}, set()
        for piece, i in symbol.items():
            for cut in range(1, len(piece)):
                joined.add((symbol[piece[cut - 1]], symbol[piece[cut]]))
                left, right = symbol.get(piece[:cut]), symbol.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left * self._symbols + right] = (ranks[scores[i]], i)
        self._pairs = np.array(sorted(pairs), dtype=np.int64)
        self._rank, self._merged = np.array([pairs[k] for k in self._pairs.tolist()], dtype=np.int32).reshape(-1, 2).T
        self._joined = np.sort(np.array([a * self._symbols + b for a, b in joined], dtype=np.int64))
        self._symbol_of = np.full(0x110000, -1, dtype=np.int32)
        chars = [(ord(x), i) for x, i in symbol.items() if len(x) == 1]
        self._symbol_of[[c for c, _ in chars]] = [i for _, i in chars]

    def _found(self, keys: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of pairs of symbols in a sorted list of keys, and whether they are there."""
        if not len(keys):
            return np.zeros(len(left), dtype=np.int64), np.zeros(len(left), dtype=bool)
        wanted = left.astype(np.int64) * self._symbols + right
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return at, (keys[at] == wanted) & (left >= 0) & (right >= 0)

    def _ranks(self, symbols: np.ndarray, last: np.ndarray, where: np.ndarray) -> np.ndarray:
        """Rank of the pair that starts at each place of ``where``; none where a word ends."""
        out = np.full(len(where), NO_PAIR, dtype=np.int32)
        inner = ~last[where]
        left = where[inner]
        at, known = self._found(self._pairs, symbols[left], symbols[left + 1])
        out[inner] = np.where(known, self._rank[at], NO_PAIR) if len(self._pairs) else NO_PAIR
        return out

    def merge(self, words: list[str]) -> list[bytes]:
        """Ids (32-bit) of each word, spelled with marks."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        symbols, places = self._symbol_of[points], np.arange(len(points))
        last = np.zeros(len(points), dtype=bool)
        last[np.cumsum(lengths)[lengths > 0] - 1] = True
        # Two characters that are neighbours in no piece are never merged: a word may be cut there.
        last[:-1] |= ~self._found(self._joined, symbols[:-1], symbols[1:])[1]
        ranks = self._ranks(symbols, last, places)
        done = []
        while len(symbols):
            starts = np.concatenate(([0], np.flatnonzero(last)[:-1] + 1))
            sizes = np.diff(np.append(starts, len(symbols)))
            lowest = np.minimum.reduceat(ranks, starts)
            if (lowest == NO_PAIR).any():
                over = np.repeat(lowest == NO_PAIR, sizes)
                done.append((places[over], symbols[over]))
                symbols, places, last, ranks = symbols[~over], places[~over], last[~over], ranks[~over]
                sizes, lowest = sizes[lowest != NO_PAIR], lowest[lowest != NO_PAIR]
                if not len(symbols):
                    break
            word = np.repeat(np.arange(len(sizes)), sizes)
            hits = np.flatnonzero(ranks == lowest[word])
            # Leftmost occurrences that don't overlap: every second one of those in a row.
            row_start = np.concatenate(([True], np.diff(hits) > 1))
            nth = np.arange(len(hits)) - np.flatnonzero(row_start)[np.cumsum(row_start) - 1]
            hits = hits[nth % 2 == 0]
            merged = self._merge_at(symbols, places, last, ranks, hits)
            several = np.bincount(word[hits], minlength=len(sizes)) > 1
            if several.any():
                new_word = word[merged[4]]
                touched = merged[5]
                early = touched[merged[3][touched] <= lowest[new_word[touched]]]
                again = np.zeros(len(sizes), dtype=bool)
                again[new_word[early]] = True
                again &= several
                long = again & (sizes > LONG_TIES)
                if long.any():  # one merge a round would take a long word too many rounds
                    out = long[word]
                    done += [self._one_by_one(symbols[word == w], places[word == w]) for w in np.flatnonzero(long)]
                    symbols, places, last, ranks = symbols[~out], places[~out], last[~out], ranks[~out]
                    continue
                if again.any():
                    first = np.concatenate(([True], np.diff(word[hits]) > 0))
                    merged = self._merge_at(symbols, places, last, ranks, hits[first | ~again[word[hits]]])
            symbols, places, last, ranks = merged[:4]
        return self._to_ids(done, points, lengths)

    def _merge_at(self, symbols, places, last, ranks, hits):
        """The arrays after merging the pairs that start at ``hits``, what was kept, and where ranks are new."""
        at, _ = self._found(self._pairs, symbols[hits], symbols[hits + 1])
        symbols, last = symbols.copy(), last.copy()
        symbols[hits] = self._merged[at]
        last[hits] = last[hits + 1]
        kept = np.ones(len(symbols), dtype=bool)
        kept[hits + 1] = False
        now_at = np.cumsum(kept) - 1
        symbols, places, last, ranks = symbols[kept], places[kept], last[kept], ranks[kept]
        here = now_at[hits]
        fresh = np.zeros(len(symbols), dtype=bool)
        fresh[here] = fresh[here[here > 0] - 1] = True
        new = np.flatnonzero(fresh)
        ranks[new] = self._ranks(symbols, last, new)
        return symbols, places, last, ranks, np.flatnonzero(kept), new

    def _one_by_one(self, symbols: np.ndarray, places: np.ndarray):
        """What is left of one word's symbols: the pair of lowest rank, leftmost of several, is merged until none is left."""
        symbol, at, size = symbols.tolist(), places.tolist(), len(symbols)
        before, after = list(range(-1, size - 1)), list(range(1, size + 1))
        known: dict[tuple[int, int], tuple[int, int] | None] = {}

        def pair(left):
            right = after[left]
            if left < 0 or right >= size:
                return
            key = symbol[left], symbol[right]
            if key not in known:
                place, there = self._found(self._pairs, *np.array(key, dtype=np.int64)[:, None])
                known[key] = (int(self._rank[place[0]]), int(self._merged[place[0]])) if there[0] else None
            if known[key]:
                heapq.heappush(heap, (known[key][0], left, *key))

        heap: list[tuple[int, int, int, int]] = []
        for i in range(size - 1):
            pair(i)
        while heap:
            _, left, a, b = heapq.heappop(heap)
            right = after[left]
            if symbol[left] != a or right >= size or symbol[right] != b:
                continue
            symbol[left], symbol[right] = known[a, b][1], GONE
            after[left] = after[right]
            if after[left] < size:
                before[after[left]] = left
            pair(left)
            if before[left] >= 0:
                pair(before[left])
        kept = [i for i in range(size) if symbol[i] != GONE]
        return np.array([at[i] for i in kept]), np.array([symbol[i] for i in kept], dtype=np.int32)

    def _to_ids(self, done, points: np.ndarray, lengths: np.ndarray) -> list[bytes]:
        """Symbols in text order; a character that is no piece becomes its bytes."""
        if not done:
            return [b""] * len(lengths)
        places = np.concatenate([p for p, _ in done])
        order = np.argsort(places, kind="stable")
        places, symbols = places[order], np.concatenate([s for _, s in done])[order]
        spelled = (symbols < 0) | (symbols >= self.size)
        counts = np.ones(len(symbols), dtype=np.int64)
        letters = points[places[spelled]]
        counts[spelled] = 1 + (letters > 0x7f) + (letters > 0x7ff) + (letters > 0xffff)
        stops = np.cumsum(counts)
        ids = np.repeat(symbols, counts).astype("<i4")
        if spelled.any():
            raw = np.frombuffer(letters.astype("<u4").tobytes().decode("utf-32-le").encode(), dtype=np.uint8)
            ids[np.repeat(spelled, counts)] = self._byte_ids[raw]
        ends = np.searchsorted(places, np.cumsum(lengths), side="left")
        ends = np.where(ends > 0, stops[ends - 1], 0)
        data = ids.tobytes()
        return [data[4 * a:4 * b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    def encode_many(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text (null: none); words met before are looked up."""
        memo, older = self._memo, self._older
        split = [_WORD.findall(" " + t.replace(MARK, " ")) if t else [] for t in texts]
        wanted = {w for words in split for w in words}
        unseen, long = [], {}
        for word in wanted:
            if word not in memo:
                ids = older.get(word)
                if ids is None:
                    unseen.append(word)
                else:
                    memo[word] = ids
        for word, ids in zip(unseen, self.merge([w.replace(" ", MARK) for w in unseen]), strict=True):
            (memo if len(word) <= MEMO_WORD else long)[word] = ids
        look = (lambda w: memo.get(w) or long[w]) if long else memo.__getitem__
        out = [np.frombuffer(b"".join(map(look, words)), dtype="<i4") for words in split]
        if len(memo) > MEMO_SIZE:
            self._memo, self._older = {}, memo
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: marks as spaces without the one put in front, bytes joined to characters."""
        ids = np.asarray(ids, dtype=np.int64)
        if len(ids) and not (0 <= ids.min() and ids.max() < self.size):
            raise ValueError("an id is outside of the vocabulary")
        silent = np.flatnonzero(self._silent[ids])
        # Bytes on both sides of a begin or end id are not joined.
        parts = [b"".join(self._surface[x].tolist()).decode("utf-8", "flowscore-bytes") for x in np.split(ids, silent)]
        text, first = "".join(parts), np.flatnonzero(~self._silent[ids])[:1]
        return text[1:] if len(first) and self._marked[ids[first[0]]] else text


_MODELS: dict[str, PieceModel] = {}


def piece_model(path: str) -> PieceModel:
    """The worker's model of a file, made once per Python worker."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def encode(docs: DataFrame, text_col: str = "text", out_col: str = "ids", path: str | None = None,
           columns: list[str] | None = None) -> DataFrame:
    """``columns`` (default: all) of ``docs`` with the piece ids (array of int) of each whole text, as the sentencepiece
    library gives them.

    A null or empty text has no ids.  Null ids of documents, repeated rows and other columns (of any name) stay as they
    are; a column ``out_col`` is replaced; an empty table gives an empty table.  Not shuffled: a task holds one slice of
    rows, each text whole."""
    path = path or tokenizer_path(MODEL)

    def make():
        model = piece_model(path)

        def compute(columns):
            ids = model.encode_many(columns[0].to_pylist())
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
            flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))]
        return compute

    return with_computed(docs, [named(text_col).cast("string")], {out_col: T.ArrayType(T.IntegerType())}, make, columns)


def decode(df: DataFrame, ids_col: str = "ids", out_col: str = "text", path: str | None = None,
           columns: list[str] | None = None, digest_col: str | None = None) -> DataFrame:
    """``columns`` (default: all) of ``df`` with the text that an array of piece ids spells (null: null; none: empty),
    and in ``digest_col`` the SHA-256 of the decimal ids joined by commas.

    Bytes that are no character come out as U+FFFD each; begin and end ids as nothing.  Ids outside of the vocabulary
    are an error; null ids in the array are left out.  Columns named like a result are replaced."""
    path = path or tokenizer_path(MODEL)

    def make():
        model = piece_model(path)
        written = np.array([b"%d" % i for i in range(model.size)], dtype=object)

        def compute(columns):
            lists, texts, hashes = columns[0], [], []
            ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            for i, there in enumerate(lists.is_valid().to_pylist()):
                ids = flat[ends[i]:ends[i + 1]]
                texts.append(model.decode(ids) if there else None)
                if digest_col:
                    hashes.append(hashlib.sha256(b",".join(written[ids].tolist())).hexdigest() if there else None)
            return [pa.array(x, pa.string()) for x in ([texts, hashes] if digest_col else [texts])]
        return compute

    ids = F.filter(named(ids_col).cast("array<int>"), lambda x: x.isNotNull())
    out = {out_col: T.StringType()} | ({digest_col: T.StringType()} if digest_col else {})
    return with_computed(df, [ids], out, make, columns)
