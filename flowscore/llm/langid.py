"""Language identification with hyperdimensional profiles.

Every letter has a fixed random vector of +1 and -1.  A letter n-gram is bound by multiplying its letters' vectors,
each permuted (rotated) by its place; a text is the bundle (sum) of its n-gram vectors, a language prototype the bundle
of its training texts at unit length.  A text belongs to the prototype of the largest cosine.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowscore.llm.held import held, released
from flowscore.llm.rows import named, text_key, with_computed, without_texts
from flowscore.llm.scratch import drop, keep

DIMENSIONS = 1024
NGRAM = 3
SEED = 20240
UNKNOWN = "und"
#: Texts that the limit of a length band needs, the quantile of their cosines and the share of their median it is.
LEAST_ROWS = 30
LOW = 0.005
HALF = 0.5
#: Code points looked at together; a longer text is bundled chunk by chunk.
_CHUNK = 1 << 16
#: Bounds of a worker's tables: letters with an index, n-gram vectors held.  Beyond them the tables start anew.
_MOST_LETTERS = 255
_MOST_GRAMS = 30_000


class Codebook:
    """Random letter vectors and bound n-gram vectors, made on demand and the same on every machine.

    The letters met so far have small indices, so an n-gram is a small number and its vector's row is found in a
    table without sorting or hashing."""

    def __init__(self, dimensions: int = DIMENSIONS, n: int = NGRAM, seed: int = SEED):
        self.dimensions, self.n, self.seed = dimensions, n, seed
        self._is_letter = np.array([chr(c).isalpha() for c in range(0x110000)])
        self._start_anew()

    def _start_anew(self):
        self._index = np.where(self._is_letter, -1, 0).astype(np.int32)
        self._letters = [self.letter(32)]
        self._bits = 6
        self._clear_grams()

    def _clear_grams(self):
        self._row = np.full(1 << self._bits * self.n, -1, dtype=np.int32)
        self._held = 0
        self._grams = np.empty((1024, self.dimensions), dtype=np.int8)

    def letter(self, code: int) -> np.ndarray:
        bits = np.random.Generator(np.random.Philox(key=[self.seed, code])).integers(
            0, 2, self.dimensions, dtype=np.int8)
        return 2 * bits - 1

    def bind(self, letters: list[np.ndarray]) -> np.ndarray:
        """The vector of an n-gram: its letters' vectors, rotated by their distance from its end, multiplied."""
        out = np.ones(self.dimensions, dtype=np.int8)
        for place, vector in enumerate(reversed(letters)):
            out = out * np.roll(vector, place)
        return out

    def _indices(self, codes: np.ndarray) -> np.ndarray | None:
        """Small indices of code points, 0 for what is no letter; None if these are too many letters for a table."""
        index = self._index[codes]
        if (index < 0).any():
            new = np.unique(codes[index < 0]).tolist()
            if len(self._letters) + len(new) > _MOST_LETTERS:
                self._start_anew()
                new = np.unique(codes[self._index[codes] < 0]).tolist()
                if len(new) >= _MOST_LETTERS:
                    return None
            for code in new:
                self._index[code] = len(self._letters)
                self._letters.append(self.letter(code))
            if len(self._letters) > 1 << self._bits:
                self._bits = len(self._letters).bit_length()
                self._clear_grams()
            index = self._index[codes]
        return index

    def _hold(self, grams: np.ndarray) -> None:
        for gram in grams.tolist():
            if self._held == len(self._grams):
                self._grams = np.concatenate([self._grams, np.empty_like(self._grams)])
            letters = [self._letters[gram >> self._bits * k & (1 << self._bits) - 1] for k in range(self.n)]
            self._grams[self._held] = self.bind(letters[::-1])
            self._row[gram] = self._held
            self._held += 1

    def _add(self, codes: np.ndarray, out: np.ndarray) -> None:
        """Add the n-grams of one chunk (letters and single 32s) to ``out``."""
        width = len(codes) - self.n + 1
        if width <= 0:
            return
        index = self._indices(codes)
        if index is None:
            windows = np.lib.stride_tricks.sliding_window_view(codes, self.n)
            for letters, count in zip(*np.unique(windows, axis=0, return_counts=True), strict=True):
                out += float(count) * self.bind([self.letter(int(c)) for c in letters])
            return
        grams = np.zeros(width, dtype=np.int32)
        for place in range(self.n):
            grams = grams << self._bits | index[place:place + width]
        rows = self._row[grams]
        if (rows < 0).any():
            new = np.unique(grams[rows < 0])
            if self._held + len(new) > _MOST_GRAMS:
                self._clear_grams()
                new = np.unique(grams)
            self._hold(new)
            rows = self._row[grams]
        counts = np.bincount(rows, minlength=self._held)
        used = np.flatnonzero(counts)
        out += counts[used].astype(np.float32) @ self._grams[used].astype(np.float32)

    def bundle(self, text: str) -> np.ndarray | None:
        """The sum of the text's n-gram vectors; None if it has no letter.  Letters are lower-cased; whatever stands
        between words is one space, also at both ends."""
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
        letters = self._is_letter[codes]
        if not letters.any():
            return None
        codes = np.where(letters, codes, 32)
        after = np.concatenate(([False], letters[:-1]))
        codes = np.concatenate(([32], codes[letters | after], [32] if letters[-1] else []))
        codes = codes.astype(np.int64)
        out = np.zeros(self.dimensions, dtype=np.float64)
        for i in range(0, len(codes), _CHUNK):
            self._add(codes[i:i + _CHUNK + self.n - 1], out)
        return out


def codebook(*parameters) -> Codebook:
    return held(("langid", *parameters), lambda: Codebook(*parameters))


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", dimensions: int = DIMENSIONS,
          n: int = NGRAM, seed: int = SEED) -> dict[str, np.ndarray]:
    """Unit prototype of each language, from all rows with a language and at least one letter.

    Each task bundles its own texts, so a row for each task and language is shuffled; the prototypes (one vector for
    each language) are what the driver holds."""

    def run(batches):
        book, sums = codebook(dimensions, n, seed), {}
        for batch in released(batches):
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                vector = book.bundle(text.as_py() or "")
                norm = np.linalg.norm(vector) if vector is not None else 0
                if norm:
                    key = lang.as_py()
                    sums[key] = sums.get(key, 0) + vector / norm
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))],
                names=["lang", "vector"])

    rows = docs.filter(F.col(lang_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    parts = rows.mapInArrow(run, "lang string, vector array<double>").select("lang", F.posexplode("vector"))
    out: dict[str, np.ndarray] = {}
    for lang, place, value in parts.groupBy("lang", "pos").agg(F.sum("col")).toLocalIterator():
        out.setdefault(lang, np.zeros(dimensions))[place] = value
    return {lang: v / np.linalg.norm(v) for lang, v in sorted(out.items()) if np.linalg.norm(v)}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], text_col: str = "text",
            dimensions: int = DIMENSIONS, n: int = NGRAM, seed: int = SEED,
            pred_col: str = "lang_pred", score_col: str = "score", columns: list[str] | None = None) -> DataFrame:
    """``columns`` (default: all) of ``docs`` with the language of the largest cosine and that cosine (negative ones as 0).

    A null text, one without a letter, or no prototypes at all gives ``und`` and score 0.  Equal cosines go to the
    first language in alphabetical order.  Columns of ``docs`` with the two new names are replaced."""
    names, matrix = list(prototypes), np.array(list(prototypes.values())).reshape(-1, dimensions)

    def make():
        book = codebook(dimensions, n, seed)

        def compute(columns):
            found, scores = [], []
            for text in columns[0]:
                vector = book.bundle(text.as_py() or "") if names else None
                norm = np.linalg.norm(vector) if vector is not None else 0
                if not norm:
                    found.append(UNKNOWN if vector is None else names[0])
                    scores.append(0.0)
                    continue
                cosines = matrix @ vector / norm
                best = int(np.argmax(cosines))
                found.append(names[best])
                scores.append(float(min(max(cosines[best], 0.0), 1.0)))
            return [pa.array(found, pa.string()), pa.array(scores, pa.float64())]
        return compute

    return with_computed(docs, [named(text_col).cast("string")], {pred_col: T.StringType(), score_col: T.DoubleType()},
                         make, columns)


def length_band(text: Column) -> Column:
    """Texts of about one length: each band doubles the code points (null: -1)."""
    return F.when(F.length(text) > 0, F.floor(F.log2(F.length(text).cast("double")))).otherwise(-1).cast("int")


def limits(judged: DataFrame, lang_col: str, pred_col: str, score_col: str, band_col: str) -> dict[tuple[str, int], float]:
    """The least cosine that still counts as a language, by language and length band.

    Counted over all texts that are labelled with a language and predicted as it: the ``LOW`` quantile of their cosines,
    or ``HALF`` of their median if that is less, so a clean corpus loses nothing.  A band of fewer than ``LEAST_ROWS``
    texts of a language takes that of all languages together, in the nearest longer band that has them; texts shorter
    than any band with enough of them have no limit, longer ones that of the longest.  At most (languages + 1) x 32 groups."""
    own = judged.filter(named(lang_col).cast("string") == named(pred_col)).select(
        named(pred_col).alias("lang"), named(band_col).alias("band"), named(score_col).alias("score"))
    quantiles = [F.count(F.lit(1)).alias("n"), F.percentile_approx("score", [LOW, 0.5], 10_000).alias("q")]
    rows = own.groupBy("lang", "band").agg(*quantiles).unionByName(
        own.groupBy("band").agg(*quantiles).withColumn("lang", F.lit(None).cast("string"))).collect()
    known = {(r.lang, r.band): min(r.q[0], HALF * r.q[1]) for r in rows if r.n >= LEAST_ROWS}
    out = {}
    for lang in {r.lang for r in rows if r.lang is not None}:
        for band in range(32):
            found = known.get((lang, band))
            longer = [known[None, b] for b in range(band, 32) if (None, b) in known]
            # Texts shorter than any measured ones stay; the longest ones are judged as the longest measured.
            if found is None and any((None, b) in known for b in range(band + 1)):
                found = longer[0] if longer else known[max((k for k in known if k[0] is None), key=lambda k: k[1])]
            if found is not None:
                out[lang, band] = found
    return out


def in_language(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", **parameters) -> DataFrame:
    """The documents in a language of the corpus.

    A text goes if it has no letter, or if its best cosine is below the limit of that language and length (see
    ``limits``).  Languages with too few labelled texts for a limit let all their texts stay, and where no text has a
    label, nothing is learned and all documents stay, those without a text too.  Columns of any names stay as they are;
    an empty table gives an empty table.  The verdict hangs on the text alone, so only the keys of texts that go are
    written; the documents are read again."""
    text = named(text_col).cast("string")
    plain = docs.select(text_key(text).alias("key"), text.alias("text"), named(lang_col).cast("string").alias("lang"),
                        length_band(text).alias("band"))
    prototypes = train(plain, **parameters)
    if not prototypes:
        return docs
    judged = keep(predict(plain, prototypes, pred_col="pred", columns=["key", "lang", "band"], **parameters), "langid")
    found = limits(judged, "lang", "pred", "score", "band")
    stays = F.col("pred") != UNKNOWN
    if found:
        least = F.create_map(*[x for (lang, band), v in sorted(found.items()) for x in (F.lit(f"{lang}:{band}"), F.lit(v))])
        stays = stays & (F.col("score") >= F.coalesce(least[F.concat_ws(":", "pred", "band")], F.lit(0.0)))
    gone = keep(judged.filter(~stays).select("key").distinct(), "langid")
    drop(judged)
    return without_texts(docs.filter(text.isNotNull()), text_col, gone)
