"""Near duplicates by SimHash: 64-bit fingerprints of word shingles, linked by multi-index hashing.

A fingerprint is cut into segments.  If two fingerprints differ in at most ``max_distance`` bits, some segment differs
in at most a few of them, so it is enough to enumerate the small Hamming ball of each segment, fetch the fingerprints
that have one of its members in their table for that segment, and verify the whole distance.  Equal fingerprints are
one row before any of this, so copies never meet in pairs.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowscore.llm.components import components
from flowscore.llm.held import let_go, released
from flowscore.llm.rows import named
from flowscore.llm.scratch import drop, keep

SHINGLE_WORDS = 3
MAX_DISTANCE = 3
SEGMENTS = 2
HASH_SEED = 42
#: Shingles whose bits are counted at a time, so a very long text needs no more memory than this many.
_BLOCK = 1 << 16


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """SimHash of one text as an unsigned 64-bit integer: lower-cased A-Z, words between ASCII white space, shingles
    with repeats; a text of fewer words is one shingle, one without words has fingerprint 0."""
    from xxhash import xxh64_intdigest
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle_words:
        starts, ends = [0], [len(joined)]
    else:
        stops = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
        ends = stops[shingle_words - 1:].tolist()
        starts = [0, *(stops[:len(ends) - 1] + 1).tolist()]
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, len(starts), _BLOCK):
        hashes = np.array([xxh64_intdigest(joined[s:e], HASH_SEED)
                           for s, e in zip(starts[i:i + _BLOCK], ends[i:i + _BLOCK], strict=True)], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(id, fingerprint) of every row, the fingerprint as a signed long.  A null text counts as empty."""

    def run(batches):
        let_go()
        for batch in released(batches):
            texts = batch.column(1).cast(pa.binary())
            prints = np.fromiter((fingerprint(t.as_py() or b"", shingle_words) for t in texts), dtype="<u8",
                                 count=len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view("<i8"))],
                                             names=["id", "fingerprint"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"id {kind}, fingerprint long")


def _segments(max_distance: int, segments: int) -> list[tuple[int, int, int]]:
    """(first bit, width, ball radius) of each segment that has to be searched."""
    base, extra = divmod(max_distance, segments)
    cuts = [64 * i // segments for i in range(segments + 1)]
    radii = [base if i <= extra else base - 1 for i in range(segments)]
    return [(a, b - a, r) for a, b, r in zip(cuts, cuts[1:], radii, strict=False) if r >= 0]


def _struct_each(masks, segment: int, value):
    return F.transform(masks, lambda m: F.struct(F.lit(segment).alias("segment"), value.bitwiseXOR(m).alias("value")))


def _keys(bits, max_distance: int, segments: int, ball: bool):
    """Table keys of a fingerprint: for each segment its value, or every value in its Hamming ball."""
    parts = []
    for i, (first, width, radius) in enumerate(_segments(max_distance, segments)):
        value = F.shiftrightunsigned(bits, first).bitwiseAND(F.lit((1 << width) - 1 if width < 64 else -1))
        masks = [sum(1 << b for b in chosen) for r in range(radius + 1) for chosen in combinations(range(width), r)]
        flips = F.array(*[F.lit(m if m < 1 << 63 else m - (1 << 64)).cast("long") for m in masks if ball or not m])
        parts.append(_struct_each(flips, i, value))
    return F.concat(*parts)


def links(distinct: DataFrame, max_distance: int = MAX_DISTANCE, segments: int = SEGMENTS) -> DataFrame:
    """Pairs a < b of the distinct values of ``fingerprint`` that differ in at most ``max_distance`` bits."""
    bits = F.col("fingerprint")
    table = distinct.select(bits.alias("b"), F.explode(_keys(bits, max_distance, segments, False)).alias("key"))
    probe = distinct.select(bits.alias("a"), F.explode(_keys(bits, max_distance, segments, True)).alias("key"))
    split = lambda df, c: df.select(c, "key.segment", "key.value")
    near = F.expr(f"a < b and bit_count(a ^ b) <= {int(max_distance)}")
    return split(probe, "a").join(split(table, "b"), ["segment", "value"]).filter(near).select("a", "b").distinct()


def _rooted(docs: DataFrame, id_col: str, text_col: str, shingle_words: int = SHINGLE_WORDS,
            max_distance: int = MAX_DISTANCE, segments: int = SEGMENTS) -> tuple[DataFrame, DataFrame]:
    """(id, fingerprint) of every document and (fingerprint, least id, root of its component) of every fingerprint."""
    prints = keep(fingerprints(docs, id_col, text_col, shingle_words), "simhash")
    distinct = keep(prints.groupBy("fingerprint").agg(F.min("id").alias("least")), "simhash")
    found = keep(components(links(distinct, max_distance, segments)), "simhash")
    rooted = keep(distinct.join(found.withColumnRenamed("vertex", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")), "simhash")
    drop(found)
    drop(distinct)
    return prints, rooted


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE,
                    segments: int = SEGMENTS) -> DataFrame:
    """One row per document: id, fingerprint (signed long), component_id (least id among all it is linked to).

    Null and empty texts have fingerprint 0 and are linked like any other.  Repeated rows stay rows.  A null id takes
    no part in the minimum; a component of null ids only has a null component_id.  Other columns are not read.  An
    empty table gives no rows."""
    prints, rooted = _rooted(docs, id_col, text_col, shingle_words, max_distance, segments)
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = keep(rooted.join(ids, "root").select("fingerprint", "component_id"), "simhash")
    drop(rooted)
    return prints.join(classes, "fingerprint").select(F.col("id").alias(id_col), "fingerprint", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **parameters) -> DataFrame:
    """The documents with one row left of each component, one of least id.

    Rows that repeat that id within the component leave one row; those in other components are judged there.  Rows
    without an id are not grouped and stay."""
    # The row number is fixed once the table is written.  Rows travel as a struct, so their columns may have any names;
    # the text is read from it.
    known = keep(docs.filter(named(id_col).isNotNull()).select(
        F.struct(*[named(c).alias(c) for c in docs.columns]).alias("doc"),
        F.monotonically_increasing_id().alias("row")), "simhash")
    prints, rooted = _rooted(known.select("row", F.col("doc").getField(text_col).alias("text")), "row", "text", **parameters)
    ids = known.select(F.col("row").alias("id"), F.col("doc").getField(id_col).alias("doc_id"))
    first = prints.join(rooted, "fingerprint").join(ids, "id").groupBy("root").agg(
        F.min(F.struct("doc_id", "id"))["id"].alias("row"))
    chosen = known.join(first.select("row"), "row", "left_semi")
    chosen = chosen.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])
    return chosen.unionByName(docs.filter(named(id_col).isNull()))
