"""Benchmark decontamination by greedy string tiling.

Seeds are shingles of ``min_match`` words.  A filter of fixed size over the hashes of all benchmark seeds tells which
documents can share one; only those are joined with the benchmark, on the seeds themselves.  For each pair found, the
longest common runs of words are marked as tiles, longest first and never overlapping, so a passage is covered whatever
order its parts come in.  A pair counts if the tiles cover enough of the benchmark item.
"""

from __future__ import annotations

import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowscore.llm.held import let_go, released
from flowscore.llm.rows import named, text_key, without_texts
from flowscore.llm.scratch import keep

MIN_MATCH = 5
COVERAGE = 0.5
#: Bits of the seed filter, a power of two (the driver and each worker hold a byte for each).
FILTER_BITS = 1 << 24
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Scripts written without spaces: Thai, Lao, Burmese, Khmer, kana, Chinese characters.
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_WORD = re.compile(rf"[^\W{_UNSPACED}]+|[{_UNSPACED}]")


def words(text: str) -> np.ndarray:
    """Hashes of the text's words: lower-cased runs of letters, digits and underscores; each letter of a script
    without spaces."""
    from xxhash import xxh64_intdigest
    found = _WORD.findall(text.lower())
    return np.array([xxh64_intdigest(w) for w in found], dtype=np.uint64)


def rolling(hashes: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hash of every run of ``length`` words."""
    n = max(len(hashes) - length + 1, 0)
    out = np.zeros(n, dtype=np.uint64)
    for i in range(length):
        out = out * _BASE + hashes[i:i + n]
    return out ^ out >> np.uint64(29)


def tiles(doc: np.ndarray, item: np.ndarray, min_match: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """(document place, item place, words) of the marked matches, longest first; ties go to the first place in the
    item, then in the document."""
    at: dict[int, list[int]] = {}
    for i, h in enumerate(rolling(item, min_match).tolist()):
        at.setdefault(h, []).append(i)
    seeds = rolling(doc, min_match)
    places = np.flatnonzero(np.isin(seeds, np.array(list(at), dtype=np.uint64)))
    heap, n, m = [], len(doc), len(item)
    for j, h in zip(places.tolist(), seeds[places].tolist(), strict=True):
        for i in at[h]:
            if i and j and item[i - 1] == doc[j - 1]:
                continue  # part of the run that began before
            size = min(n - j, m - i)
            differ = np.flatnonzero(doc[j:j + size] != item[i:i + size])
            size = int(differ[0]) if len(differ) else size
            if size >= min_match:
                heap.append((-size, i, j))
    heapq.heapify(heap)
    doc_marked, item_marked = np.zeros(n, dtype=bool), np.zeros(m, dtype=bool)
    out = []
    while heap:
        size, i, j = heapq.heappop(heap)
        size = -size
        marked = np.flatnonzero(doc_marked[j:j + size] | item_marked[i:i + size])
        if not len(marked):
            doc_marked[j:j + size] = item_marked[i:i + size] = True
            out.append((j, i, size))
            continue
        # Part of it is marked by a longer tile: what is left comes up again by its own length.
        cuts = [-1, *marked.tolist(), size]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b - a - 1 >= min_match:
                heapq.heappush(heap, (-(b - a - 1), i + a + 1, j + a + 1))
    return out


def _seed_rows(table: DataFrame, id_col: str, text_col: str, min_match: int) -> DataFrame:
    """(item, seed, times, words) of every benchmark item: each seed once, how often it has it, the item's words."""

    def run(batches):
        for batch in batches:
            for item, text in zip(batch.column(0), batch.column(1), strict=True):
                hashes = words(text.as_py() or "")
                seeds, times = np.unique(rolling(hashes, min_match), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(item, len(seeds)), pa.array(seeds.view(np.int64), pa.int64()), pa.array(times, pa.int64()),
                     pa.repeat(pa.scalar(len(hashes), pa.int64()), len(seeds))], names=["item", "seed", "times", "words"])

    schema = T.StructType([T.StructField("item", table.schema[id_col].dataType),
                           *[T.StructField(c, T.LongType()) for c in ("seed", "times", "words")]])
    return table.select(named(id_col).alias("item"), named(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def seed_filter(seeds: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """A Bloom filter: two bits for each seed hash; the driver gets ``bits`` / 64 numbers at most."""
    places = F.array(F.pmod("seed", F.lit(bits)), F.pmod(F.shiftrightunsigned("seed", 32), F.lit(bits)))
    rows = seeds.select(F.explode(places).alias("p")).groupBy(F.shiftright("p", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("set"))
    out = np.zeros(bits // 64, dtype=np.uint64)
    for row in rows.toLocalIterator():
        out[row.word] = row.set & 0xFFFFFFFFFFFFFFFF
    return np.unpackbits(out.view(np.uint8), bitorder="little").astype(bool)


def _tagged(docs: DataFrame, shared, text_col: str, min_match: int, bits: int) -> DataFrame:
    """(row, seeds): rows that may share a seed, with those seeds.

    The documents' own columns are kept in a struct, so theirs may have any names."""
    packed = docs.select(F.struct(*[named(c).alias(c) for c in docs.columns]).alias("row"),
                         named(text_col).cast("string").alias("text"))
    schema = T.StructType([packed.schema["row"], T.StructField("seeds", T.ArrayType(T.LongType()))])

    def run(batches):
        let_go()
        for batch in released(batches):
            for k in range(0, batch.num_rows, 512):
                part, chosen, hits = batch.slice(k, 512), [], []
                for row, text in enumerate(part.column(1)):
                    seeds = rolling(words(text.as_py() or ""), min_match)
                    hit = seeds[shared.value[(seeds % np.uint64(bits)).astype(np.int64)]]
                    hit = hit[shared.value[(hit >> np.uint64(32) & np.uint64(bits - 1)).astype(np.int64)]]
                    if len(hit):
                        chosen.append(row)
                        hits.append(np.unique(hit).view(np.int64))
                if chosen:
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(pa.array(chosen)), pa.array(hits, pa.list_(pa.int64()))], names=schema.names)

    return packed.mapInArrow(run, schema)


class Decontamination:
    """Documents against a benchmark.

    ``pairs()`` has a row per document row and item whose tiles cover at least ``coverage`` of the item's words;
    ``clean()`` the documents without such a pair, unchanged.  Items of fewer than ``min_match`` words prove nothing
    and never match; null texts count as empty; a null id stays null in the pairs; repeated rows are each judged;
    with an empty benchmark all documents are clean.  Columns may have any names.  The texts are tokenized once, and only
    the rows that may share a seed are kept; ``clean()`` reads the documents again and leaves out the texts that match."""

    def __init__(self, docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", min_match: int = MIN_MATCH, coverage: float = COVERAGE,
                 filter_bits: int = FILTER_BITS):
        self.docs, self._text_col = docs, text_col
        seeds = keep(_seed_rows(benchmark, item_col, item_text_col, min_match), "decontam")
        shared = docs.sparkSession.sparkContext.broadcast(seed_filter(seeds, filter_bits))
        # The row number is fixed once the table is written.
        self._maybe = keep(_tagged(docs, shared, text_col, min_match, filter_bits).withColumn(
            "n", F.monotonically_increasing_id()), "decontam")
        # A tile of n words has n - min_match + 1 seeds of the item, so no more than min_match words for each of them: what
        # can't reach the coverage by that count is not tiled.
        met = self._maybe.select("n", F.explode("seeds").alias("seed")).join(seeds, "seed").groupBy(
            "n", "item").agg(F.sum("times").alias("times"), F.min("words").alias("words")).filter(
            F.col("times") * min_match >= F.col("words") * coverage - 1e-6).select("n", "item")
        texts = benchmark.select(named(item_col).alias("item"), named(item_text_col).cast("string").alias("item_text"))
        rows = self._maybe.select("n", F.col("row").getField(text_col).cast("string").alias("text")).join(met, "n").join(
            texts.filter("item is not null"), "item").select("n", "item", "text", "item_text")

        def run(batches):
            for batch in batches:
                out = []
                for row, item, text, item_text in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                    target = words(item_text or "")
                    marked = tiles(words(text or ""), target, min_match)
                    covered = sum(x[2] for x in marked) / len(target) if len(target) else 0.0
                    if covered >= coverage:
                        out.append((row, item, covered, [{"doc_word": j, "item_word": i, "words": n}
                                                         for j, i, n in marked]))
                if out:
                    tile = pa.struct([("doc_word", pa.int32()), ("item_word", pa.int32()), ("words", pa.int32())])
                    kinds = [pa.int64(), batch.schema.field(1).type, pa.float64(), pa.list_(tile)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                        names=["n", "item", "coverage", "tiles"])

        found = T.StructType.fromDDL("n bigint, coverage double, tiles array<struct<doc_word:int,item_word:int,words:int>>")
        found = T.StructType([found["n"], T.StructField("item", benchmark.schema[item_col].dataType), *found[1:]])
        self._found = keep(rows.mapInArrow(run, found), "decontam")

    def pairs(self, id_col: str = "doc_id") -> DataFrame:
        ids = self._maybe.select("n", F.col("row").getField(id_col).alias("doc_id"))
        return self._found.join(ids, "n").select("doc_id", F.col("item").alias("item_id"), "coverage", "tiles")

    def clean(self) -> DataFrame:
        texts = self._maybe.select("n", text_key(F.col("row").getField(self._text_col)).alias("key"))
        met = keep(texts.join(self._found.select("n"), "n", "left_semi").select("key").distinct(), "decontam")
        return without_texts(self.docs, self._text_col, met)
