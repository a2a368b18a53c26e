"""Packing of whole documents into fixed windows of token ids, next to lexical neighbours.

Texts are encoded once into a table of ids, with document frequencies counted over all documents in the same pass.
Documents are dealt to tasks by the hash of the least of their terms of highest weight in a random order (a min-hash),
and ordered within them by the two least, so likely neighbours follow each other whatever file they came from; a term of
many documents is dealt to several tasks.  Tasks read them shard by shard (a bounded number of tokens), build an inverted index of BM25 weights over
the shard's documents, and fill one window after the other: a seed document, then its unused neighbours in order of
their BM25 score as far as they fit whole, then the best one left, cut to the room that remains; what is cut off is the
next seed.  So every window is full, and the last tokens of a partition make sequences of power-of-two lengths.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowscore.llm import tokens
from flowscore.llm.held import let_go, released
from flowscore.llm.scratch import keep

WINDOW = 2048
END_ID = 1
#: Tokens a shard's index covers.
SHARD_TOKENS = 1 << 20
#: A seed asks with its terms of highest weight, so many at most.
QUERY_TERMS = 32
K1, B = 1.2, 0.75
SEED = 29
#: Shards' worth of tokens that the documents of one term make in a part, and parts of documents without a telling term.
SHARDS_A_DEAL = 4
LOOSE_PARTS = 1 << 16
#: An odd number that mixes row numbers.
MIX = 2654435761


def encode(docs: DataFrame, id_col: str, text_col: str, path: str, end_id: int) -> DataFrame:
    """(id, ids, document frequencies) as a table: ids are the text's ids (little-endian, 16 bits if the vocabulary
    allows it) and ``end_id``; each task adds one row without ids that holds its documents' term frequencies."""

    def run(batches):
        encoder = tokens.encoder(path)
        width = "<u2" if encoder.vocabulary <= 1 << 16 else "<u4"
        frequency = np.zeros(encoder.vocabulary, dtype=np.int64)
        total, total_tokens = 0, 0
        end, kind = np.array([end_id], dtype=width), None
        for batch in batches:
            kind = batch.schema.field(0).type
            for i in range(0, batch.num_rows, 512):
                part, out = batch.slice(i, 512), []
                for ids in encoder.encode_many(part.column(1)):
                    ids = np.concatenate([ids.astype(width), end])
                    frequency[terms_of(ids)[0]] += 1
                    total, total_tokens = total + 1, total_tokens + len(ids)
                    out.append(ids.tobytes())
                none = pa.nulls(len(out))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(out, pa.binary()), none.cast(pa.list_(pa.int32())),
                     none.cast(pa.list_(pa.int64())), none.cast(pa.int64()), none.cast(pa.int64())],
                    names=["id", "ids", "terms", "counts", "documents", "tokens"])
        if total:
            here = np.flatnonzero(frequency)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, kind), pa.nulls(1, pa.binary()), pa.array([here.tolist()], pa.list_(pa.int32())),
                 pa.array([frequency[here].tolist()], pa.list_(pa.int64())), pa.array([total], pa.int64()),
                 pa.array([total_tokens], pa.int64())],
                names=["id", "ids", "terms", "counts", "documents", "tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return keep(rows.mapInArrow(run, f"id {kind}, ids binary, terms array<int>, counts array<bigint>, "
                                     "documents bigint, tokens bigint"), "packing")


def corpus_statistics(encoded: DataFrame, vocabulary: int) -> tuple[np.ndarray, int, float]:
    """Document frequency of each vocabulary entry (a fixed-size vector), documents, mean tokens of a document."""
    tasks = encoded.filter("ids is null")
    counted = tasks.select(F.explode(F.arrays_zip("terms", "counts")).alias("x")).groupBy("x.terms").agg(
        F.sum("x.counts").alias("n"))
    frequency = np.zeros(vocabulary, dtype=np.int64)
    for row in counted.collect():
        frequency[row.terms] = row.n
    size = tasks.agg(F.sum("documents"), F.sum("tokens")).first()
    return frequency, size[0] or 0, (size[1] or 0) / (size[0] or 1)


def terms_of(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids in order and how often each comes; 16-bit ids are sorted by radix."""
    size = len(ids)
    if not size:
        return ids, np.zeros(0, dtype=np.int64)
    ids = np.sort(ids, kind="stable")
    new = np.empty(size, dtype=bool)
    new[0] = True
    np.not_equal(ids[1:], ids[:-1], out=new[1:])
    starts = new.nonzero()[0]
    counts = np.empty(len(starts), dtype=np.int64)
    np.subtract(starts[1:], starts[:-1], out=counts[:-1])
    counts[-1] = size - starts[-1]
    return ids[starts], counts


def by_content(encoded: DataFrame, shared, vocabulary: int, query_terms: int, mean: float, frequency: np.ndarray,
               deal_tokens: int) -> DataFrame:
    """(id, ids) dealt by the least of a random order of each document's terms of highest weight, sorted by the two least.

    The documents of a term may hold any share of all tokens: as many as its document frequency tells are spread by
    their number over parts of about ``deal_tokens`` tokens."""
    parts = encoded.sparkSession.sparkContext.broadcast(  # one number for each vocabulary entry
        np.ceil(np.maximum(frequency, 1) * max(mean, 1.0) / deal_tokens).astype(np.int64))
    width = "<u2" if vocabulary <= 1 << 16 else "<u4"

    def run(batches):
        idf, order = shared.value, np.random.default_rng(SEED).permutation(vocabulary).astype(np.int64)
        spread, term_at = parts.value, np.argsort(order)
        let_go()
        for batch in released(batches):
            keys, deals = [], []
            for data, row in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
                kinds, counts = terms_of(np.frombuffer(data.as_py(), dtype=width))
                weight = idf[kinds] * counts / (counts + K1)
                if len(kinds) > query_terms:
                    best = np.argpartition(weight, len(weight) - query_terms)[len(weight) - query_terms:]
                    kinds, weight = kinds[best], weight[best]
                told = order[kinds[weight > 0]]
                told.sort()
                least = told[:2].tolist()
                # Documents without a telling term are dealt by their number.
                into = int(spread[term_at[least[0]]]) if least else LOOSE_PARTS
                least += [0, 0]
                keys.append((least[0] << 32) + least[1])
                deals.append((least[0] << 32) + row * MIX % (1 << 31) % into)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.int64()), pa.array(deals, pa.int64())],
                                             names=["id", "ids", "row", "key", "deal"])

    kind = encoded.schema["id"].dataType.simpleString()
    rows = encoded.filter("ids is not null").select("id", "ids", F.monotonically_increasing_id().alias("row"))
    keyed = rows.mapInArrow(run, f"id {kind}, ids binary, row bigint, key bigint, deal bigint")
    # A hash of the deal needs no sampling pass over the keys.
    return keyed.repartition("deal").sortWithinPartitions("key", "row").select("id", "ids")


class Shard:
    """An inverted index over some units (uncut tails of documents) and the windows filled from them."""

    def __init__(self, idf: np.ndarray, mean: float, window: int, query_terms: int):
        self.idf, self.mean, self.window, self.query_terms = idf, mean, window, query_terms
        self.units: list[list] = []  # [row, start, ids]

    def add(self, row: int, start: int, ids: np.ndarray) -> None:
        self.units.append([row, start, ids])

    def _index(self) -> None:
        terms, docs, weights, self.queries = [], [], [], []
        for unit, (_, _, ids) in enumerate(self.units):
            kinds, counts = terms_of(ids)
            told = self.idf[kinds] > 0
            kinds, counts = kinds[told], counts[told]
            weight = self.idf[kinds] * counts * (K1 + 1) / (counts + K1 * (1 - B + B * len(ids) / self.mean))
            terms.append(kinds)
            docs.append(np.full(len(kinds), unit, dtype=np.int32))
            weights.append(weight)
            if len(kinds) > self.query_terms:
                kinds = kinds[np.argpartition(weight, len(weight) - self.query_terms)[len(weight) - self.query_terms:]]
            self.queries.append(kinds)
        terms, docs, weights = np.concatenate(terms), np.concatenate(docs), np.concatenate(weights)
        order = np.argsort(terms, kind="stable")
        self.docs, self.weights = docs[order], weights[order]
        self.first = np.searchsorted(terms[order], np.arange(len(self.idf) + 1))

    def _neighbours(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """Unused units by falling BM25 score for the seed's terms, ties and the rest in their order."""
        spans = [slice(self.first[t], self.first[t + 1]) for t in self.queries[seed].tolist()]
        scores = np.bincount(np.concatenate([self.docs[s] for s in spans]),
                             np.concatenate([self.weights[s] for s in spans]), len(self.units)) if spans else \
            np.zeros(len(self.units))
        open_units = np.flatnonzero(unused)
        return open_units[np.argsort(-scores[open_units], kind="stable")]

    def windows(self, last: bool):
        """Filled sequences, each a list of (row, start, ids).  Units that don't fill a window stay for the next
        shard; with ``last`` they leave as sequences of power-of-two lengths."""
        if self.units:
            self._index()
        unused = np.ones(len(self.units), dtype=bool)
        lengths = np.array([len(u[2]) for u in self.units], dtype=np.int64)
        total, next_seed, low = int(lengths.sum()), None, 0

        def take(unit: int, room: int):
            row, start, ids = self.units[unit]
            piece, rest = ids[:room], ids[room:]
            unused[unit], lengths[unit] = len(rest) > 0, len(rest)
            self.units[unit] = [row, start + len(piece), rest]
            return row, start, piece

        while total >= (1 if last else self.window):
            room = size = self.window if total >= self.window else 1 << total.bit_length() - 1
            total -= size
            while low < len(unused) and not unused[low]:
                low += 1
            seed = next_seed if next_seed is not None and unused[next_seed] else low
            out = [take(seed, room)]
            room -= len(out[0][2])
            if room:
                ranked = self._neighbours(seed, unused)
                fits, at = lengths[ranked], 0
                while room and at < len(ranked):
                    step = int(np.argmax(fits[at:] <= room))
                    if fits[at + step] > room:
                        break
                    out.append(take(int(ranked[at + step]), room))
                    room -= len(out[-1][2])
                    at += step + 1
                if room:
                    seed = int(ranked[np.argmax(unused[ranked])])
                    out.append(take(seed, room))
            next_seed = seed
            yield out
        self.units = [u for u, open_ in zip(self.units, unused, strict=True) if open_]


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
         end_id: int = END_ID, window: int = WINDOW, shard_tokens: int = SHARD_TOKENS,
         query_terms: int = QUERY_TERMS) -> DataFrame:
    """One row per piece: id, start (the document's ids before it), length, ids (binary, unsigned 32-bit), doc_tokens
    (with the end id), sequence_id, offset (in the sequence, gapless from 0).

    Sequences hold ``window`` tokens, the last ones of a partition a smaller power of two.  A null text counts as
    empty (only the end id); null ids and repeated rows are documents of their own; an empty table gives no rows;
    other columns are not read.  A document of any length is cut into whole windows first, so a task holds one
    document and one shard."""
    path = path or tokens.tokenizer_path(tokens.BYTE_BPE)
    encoded = encode(docs, id_col, text_col, path, end_id)
    vocabulary = tokens.encoder(path).vocabulary
    frequency, documents, mean = corpus_statistics(encoded, vocabulary)
    # Terms of more than half of the documents tell nothing: their weight would be below 0.
    idf = np.maximum(np.log((documents - frequency + 0.5) / (frequency + 0.5)), 0.0).astype(np.float32)
    idf[frequency == 0] = 0
    width = "<u2" if vocabulary <= 1 << 16 else "<u4"
    shared = docs.sparkSession.sparkContext.broadcast(idf)  # one number for each vocabulary entry
    names = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def run(batches):
        sequence = TaskContext.get().partitionId() << 40
        shard, known, held, kind = Shard(shared.value, mean, window, query_terms), {}, 0, None
        out: list[tuple] = []
        let_go()

        def put(pieces):
            nonlocal sequence
            offset = 0
            for row, start, ids in pieces:
                doc, length = known[row]
                out.append((doc, start, len(ids), ids.astype("<u4").tobytes(), length, sequence, offset))
                offset += len(ids)
                if start + len(ids) == length:
                    del known[row]
            sequence += 1

        def batch_out():
            columns = list(zip(*out, strict=True))
            out.clear()
            kinds = [kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        row = 0
        for batch in released(batches):
            kind = batch.schema.field(0).type
            for doc, data in zip(batch.column(0), batch.column(1), strict=True):
                ids = np.frombuffer(data.as_py(), dtype=width)
                known[row] = (doc.as_py(), len(ids))
                whole = len(ids) // window * window
                for start in range(0, whole, window):
                    put([(row, start, ids[start:start + window])])
                if whole < len(ids):
                    shard.add(row, whole, ids[whole:])
                    held += len(ids) - whole
                row += 1
                if held >= shard_tokens:
                    for pieces in shard.windows(False):
                        put(pieces)
                    held = sum(len(u[2]) for u in shard.units)
                if len(out) >= 1024:
                    yield batch_out()
        for pieces in shard.windows(True):
            put(pieces)
        if out:
            yield batch_out()

    kind = docs.schema[id_col].dataType.simpleString()
    dealt = by_content(encoded, shared, vocabulary, query_terms, mean, frequency, SHARDS_A_DEAL * shard_tokens)
    return dealt.mapInArrow(
        run, f"id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, "
             "offset bigint").withColumnRenamed("id", id_col)
