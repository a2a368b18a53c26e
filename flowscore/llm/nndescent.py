"""Approximate nearest neighbours by largest inner product: an NN-descent graph and greedy search on it.

Equal vectors are one node.  The graph links directions (smallest angle), whatever the lengths of the vectors.  It starts
from blocks along random projections; each round, every node compares the neighbours it is met by with each other
(neighbours of neighbours), and better ones replace worse ones.  Queries are put into such blocks of all nodes, of the
longest quarter of them, of the longest sixteenth and so on, and so start both near their direction and at the long
vectors; then they walk the graph by inner product, expanding the best nodes found so far until none of them is left
unexpanded, and what they found is scored exactly.  Vectors travel as bytes (one a component and a scale); those whose
neighbours bytes can't tell apart have 26-bit components behind them, and final scores use the originals.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowscore.llm.scratch import drop, keep

NEIGHBOURS = 20
#: Nodes that name a node as neighbour: about so many of them, dealt by chance each round, join one of its meetings.
REVERSE = 40
#: Pairs a task holds before it merges them by node.
HELD_PAIRS = 1 << 20
ORDERS, BLOCK, PLANES = 6, 256, 24
SETTLED = 0.02
BEAM = 100
SEED = 7
#: Longest nodes are a level of their own if they are longer by this factor than those of the level below.
LONGER = 1.05
#: A node's neighbours are told apart if their similarities lie apart by so many steps of its bytes.
TOLD_STEPS = 10
#: Unit of fine components: products of unit vectors are whole numbers, exact in 64-bit floats.
FINE = 1 << 25
_PAIR = "array<struct<sim:double,id:bigint>>"


def valid(embedding) -> object:
    """Whether a vector takes part: not null, no null or non-finite component, not all zero."""
    finite = F.forall(embedding, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(embedding.isNotNull() & finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def norm_of(embedding):
    """Length of a valid vector, without overflow of its squares."""
    return F.aggregate(embedding, F.lit(0.0), lambda a, x: F.hypot(a, x.cast("double")))


def _unit(column: pa.Array, dimensions: int) -> np.ndarray:
    """Directions of an array of vectors."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimensions)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _signs(unit: np.ndarray) -> pa.Array:
    """Signs along the random planes of each order, as a number each."""
    planes = np.random.default_rng(SEED).standard_normal((ORDERS * PLANES, unit.shape[1]))
    signs = (unit @ planes.T > 0).reshape(len(unit), ORDERS, PLANES)
    return pa.array((signs * (1 << np.arange(PLANES)[::-1])).sum(axis=2).tolist(), pa.list_(pa.int64()))


def _pack(matrix: np.ndarray) -> list[bytes]:
    scale = np.abs(matrix).max(axis=1, keepdims=True).astype("<f4")
    codes = np.rint(matrix / scale * 127).astype(np.int8)
    return [s.tobytes() + c.tobytes() for s, c in zip(scale / 127, codes, strict=True)]


def _unpack(column: pa.Array, dimensions: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Codes (whole numbers) and scales from a non-empty array of binaries without nulls; without ``dimensions`` no row
    has fine components behind them."""
    offsets, data = _bytes(column)
    width = 4 + dimensions if dimensions else int(offsets[1])
    if offsets[-1] == width * len(column):
        data = data.reshape(len(column), width)
    else:
        data = np.concatenate([data[offsets[i:i + 4096, None][:len(column) - i] + np.arange(width)]
                               for i in range(0, len(column), 4096)])
    scale = np.ascontiguousarray(data[:, :4]).view("<f4")
    return data[:, 4:].view(np.int8).astype(np.float32), scale[:, 0]


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets from 0 and the bytes of a binary array."""
    offsets = np.frombuffer(column.buffers()[1], dtype="<i4")[column.offset:column.offset + len(column) + 1]
    return offsets - offsets[0], np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]]


class _Fine:
    """The fine components of those rows of a binary array that have them."""

    def __init__(self, column: pa.Array, dimensions: int | None):
        self.offsets, self.data = _bytes(column)
        self.dimensions = dimensions or 0
        self.has = np.diff(self.offsets) > 4 + self.dimensions if dimensions else np.zeros(len(column), dtype=bool)

    def of(self, rows: np.ndarray) -> np.ndarray:
        places = self.offsets[rows, None] + 4 + self.dimensions + np.arange(4 * self.dimensions)
        return self.data[places].view("<i4").astype(np.float64)

    def sharpen(self, sims: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Similarities of ``rows`` with each other, those of two with fine components from their distance."""
        at = np.flatnonzero(self.has[rows])
        sims = sims.astype(np.float64)
        if len(at) > 1:
            x = self.of(rows[at])
            products = x @ x.T
            squares = np.diag(products)
            sims[np.ix_(at, at)] = 1 - (squares[:, None] + squares[None, :] - 2 * products) / (2.0 * FINE * FINE)
        return sims


def _products(codes: np.ndarray, scales: np.ndarray) -> np.ndarray:
    """All inner products.  Those of codes are whole numbers, exact in 32 bits for up to 1,000 components, so a pair has
    the same value wherever it is met and is one neighbour, not several."""
    return codes @ codes.T * (scales[:, None] * scales[None, :])


def _best(sims: np.ndarray, most: int) -> np.ndarray:
    """Columns of the largest entries of each row."""
    if sims.shape[1] <= most:
        return np.argsort(-sims, axis=1, kind="stable")
    return np.argpartition(-sims, most - 1, axis=1)[:, :most]


def _lists(rows: list[int], sims: np.ndarray, ids: np.ndarray) -> pa.Array:
    """Arrays of (sim, id) structs, ``rows`` entries in each."""
    offsets = np.concatenate(([0], np.cumsum(rows))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(
        [pa.array(sims.astype(np.float64)), pa.array(ids.astype(np.int64))], names=["sim", "id"]))


def _list_parts(column: pa.Array) -> tuple[np.ndarray, pa.StructArray]:
    """Offsets from 0 and the entries of a list array."""
    offsets = column.offsets.to_numpy()
    return offsets - offsets[0], column.flatten()


def _vectors(column: pa.Array, norms: pa.Array, dimensions: int) -> np.ndarray:
    """Vectors in parts of the largest length, from their bytes, or from fine components where there are any."""
    codes, scales = _unpack(column, dimensions)
    x = codes * scales[:, None].astype(np.float64)
    fine = _Fine(column, dimensions)
    at = np.flatnonzero(fine.has)
    if len(at):
        x[at] = fine.of(at) / FINE
    return x * norms.to_numpy()[:, None]


def _better(here: np.ndarray, least: np.ndarray, sims: np.ndarray, most: int) -> tuple[np.ndarray, ...]:
    """(node, sim, id) of every pair of a meeting that is better than the node's worst neighbour.  Where these are
    more than ``most`` a node, the best ``most``: its list holds no more, whatever it holds now."""
    np.fill_diagonal(sims, -np.inf)
    best = _best(sims, most)
    found = np.take_along_axis(sims, best, axis=1)
    better = found > least[:, None]
    return np.repeat(here, better.sum(axis=1)), found[better], here[best][better]


def _best_of_each(nodes: np.ndarray, sims: np.ndarray, ids: np.ndarray, most: int) -> tuple[np.ndarray, pa.Array]:
    """Different nodes and the best distinct (sim, id) of each, ties to the larger id as in ``_merge``."""
    order = np.lexsort((-ids, -sims, nodes))
    nodes, sims, ids = nodes[order], sims[order], ids[order]
    first = np.concatenate(([True], (nodes[1:] != nodes[:-1]) | (ids[1:] != ids[:-1])))[:len(nodes)]
    nodes, sims, ids = nodes[first], sims[first], ids[first]
    here, at, sizes = np.unique(nodes, return_index=True, return_counts=True)
    few = np.arange(len(nodes)) - np.repeat(at, sizes) < most
    return here, _lists(np.minimum(sizes, most).tolist(), sims[few], ids[few])


def _merge(candidates: DataFrame, most: int) -> DataFrame:
    """(node, near): the best distinct neighbours of each node from all its (node, near) rows."""
    return candidates.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")).select(
        "node", F.slice(F.sort_array("near", asc=False), 1, most).alias("near"))


class Index:
    """Nodes (one for each different vector) and their neighbour graph.

    ``vectors`` is (id, embedding); rows with a null id or an invalid vector, or of another length than most, take no
    part.  ``members`` has the least ``copies`` ids of each node, enough for any answer of fewer.  Rounds go on until
    few neighbours change, or for ``rounds`` at most."""

    dimensions: int | None = None

    def __init__(self, vectors: DataFrame, id_col: str = "vec_id", embedding_col: str = "embedding",
                 neighbours: int = NEIGHBOURS, rounds: int | None = None, copies: int = 21):
        self.neighbours = neighbours
        rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(embedding_col).alias("embedding")).filter(
            F.col("id").isNotNull() & valid(F.col("embedding")))
        sizes = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
        self.dimensions = sizes.d if sizes else 0
        rows = rows.filter(F.size("embedding") == self.dimensions)
        self.nodes = keep(rows.groupBy("embedding").agg(F.min("id").alias("node")).select("node", "embedding"), "nn")
        self.rows = keep(rows.join(self.nodes, "embedding").select("id", "node"), "nn")
        first = Window.partitionBy("node").orderBy("id")
        self.members = self.rows.distinct().withColumn("n", F.row_number().over(first)).filter(
            F.col("n") <= copies).select("node", F.col("id").alias("member"))
        top = self.nodes.agg(F.max(norm_of(F.col("embedding"))), F.count("*")).first()
        self.length, self.size = top[0] or 1.0, top[1]
        self.points = keep(self._points(self.nodes.withColumn("fine", F.lit(False))), "nn")
        self.graph = keep(self._start(), "nn")
        close = self.graph.filter(F.size("near") >= neighbours).select(
            "node", (F.col("near")[0]["sim"] - F.element_at("near", -1)["sim"]).alias("range"))
        fine = close.join(self.points, "node").filter(F.col("range") < TOLD_STEPS * F.col("step")).select(
            "node", F.lit(True).alias("told"))
        if fine.limit(1).count():
            points = keep(self._points(self.nodes.join(fine, "node", "left").withColumn(
                "fine", F.coalesce("told", F.lit(False)))), "nn")
            drop(self.points)
            self.points, coarse = points, self.graph
            self.graph = keep(self._start(), "nn")
            drop(coarse)
        # Lists only get better, so rounds come to an end by themselves.
        for number in (itertools.count() if rounds is None else range(rounds)) if self.size > BLOCK else ():
            after = keep(self._round(number), "nn")
            changed = self.graph.withColumnRenamed("near", "was").join(after, "node").agg(F.sum(F.size(F.array_except(
                F.transform("near", lambda x: x["id"]), F.transform("was", lambda x: x["id"]))))).first()[0]
            drop(self.graph)
            self.graph = after
            if changed <= SETTLED * self.size * neighbours:
                break

    def _points(self, nodes: DataFrame) -> DataFrame:
        """(node, vector, codes, step, norm) of nodes; ``fine`` ones have fine components."""
        dimensions = self.dimensions

        def run(batches):
            for batch in batches:
                x = _unit(batch.column(1), dimensions)
                packed = [p + (np.rint(row * FINE).astype("<i4").tobytes() if fine else b"") for p, row, fine in zip(
                    _pack(x), x, batch.column(2).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(packed, pa.binary()), _signs(x), pa.array(np.abs(x).max(axis=1) / 127),
                     batch.column(3)], names=["node", "vector", "codes", "step", "norm"])

        # Lengths are parts of the largest.
        return nodes.select("node", "embedding", "fine", (norm_of(F.col("embedding")) / self.length).alias("norm")).mapInArrow(
            run, "node bigint, vector binary, codes array<bigint>, step double, norm double")

    def _start(self) -> DataFrame:
        """Nearest neighbours within blocks of nodes that follow each other in a random order of signs."""
        most, dimensions = self.neighbours, self.dimensions

        def blocks(batches):
            held: list[pa.RecordBatch] = []
            n = 0
            for batch in batches:
                held.append(batch)
                n += batch.num_rows
                if n >= BLOCK:
                    table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                    for i in range(0, n - BLOCK + 1, BLOCK):
                        yield table.slice(i, BLOCK)
                    held, n = ([table.slice(n - n % BLOCK)], n % BLOCK) if n % BLOCK else ([], 0)
            if n:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

        def run(batches):
            for block in blocks(batches):
                nodes = block.column(0).to_numpy()
                vectors = block.column(1)
                sims = _Fine(vectors, dimensions).sharpen(_products(*_unpack(vectors, dimensions)), np.arange(len(nodes)))
                sims[nodes[:, None] == nodes[None, :]] = -np.inf
                best = _best(sims, most)
                found = np.take_along_axis(sims, best, axis=1)
                real = np.isfinite(found)
                yield pa.RecordBatch.from_arrays(
                    [block.column(0), _lists(real.sum(axis=1).tolist(), found[real], nodes[best][real])],
                    names=["node", "near"])

        # Nodes of one code come in another order in each tree.
        order = ["tree", "code", "mix", "node"]
        rows = self.points.select("node", "vector", F.posexplode("codes").alias("tree", "code")).withColumn(
            "mix", F.xxhash64("node", "tree"))
        return _merge(rows.repartitionByRange(*order).sortWithinPartitions(*order).select("node", "vector").mapInArrow(
            run, f"node bigint, near {_PAIR}"), most)

    def _round(self, number: int) -> DataFrame:
        """One round: neighbours of a node, both ways, are compared with each other at that node.

        All nodes that name it take part: if they are many, they are dealt to several meetings of bounded size, each
        with the node's own neighbours."""
        links = self.graph.select(F.col("node").alias("at"), F.explode("near.id").alias("who"))
        named = links.groupBy(F.col("who").alias("at")).agg(F.ceil(F.count("*") / F.lit(REVERSE)).alias("meetings"))
        back = links.select(F.col("who").alias("at"), F.col("at").alias("who")).join(named, "at").select(
            "at", F.pmod(F.xxhash64("who", F.lit(number)), F.col("meetings")).alias("meeting"), "who")
        # The node's own neighbours come to each of its meetings.
        forth = self.graph.select(F.col("node").alias("at"), "near").join(named, "at", "left").select(
            "at", "near", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("meetings", F.lit(1)) - 1)).alias("meeting"))
        least = F.when(F.size("near") >= self.neighbours, F.element_at("near", -1)["sim"]).otherwise(F.lit(-2.0))
        who = self.points.select(F.col("node").alias("who"), "vector").join(
            self.graph.select(F.col("node").alias("who"), least.cast("double").alias("least")), "who")
        most, dimensions = self.neighbours, self.dimensions
        met = forth.select("at", "meeting", F.explode("near.id").alias("who")).union(back).join(who, "who").groupBy(
            "at", "meeting").agg(F.collect_list(F.struct("who", "vector", "least")).alias("met"))

        def run(batches):
            for batch in batches:
                offsets, entries = _list_parts(batch.column(0))
                nodes, least = entries.field("who").to_numpy(), entries.field("least").to_numpy()
                codes, scales = _unpack(entries.field("vector"), dimensions)
                fine = _Fine(entries.field("vector"), dimensions)
                out, held = [], 0
                for a, b in zip(offsets, offsets[1:], strict=False):
                    here, at = np.unique(nodes[a:b], return_index=True)
                    at = at + a
                    out.append(_better(here, least[at], fine.sharpen(_products(codes[at], scales[at]), at), most))
                    held += len(out[-1][0])
                    # A node that many others name is met at each of them: one row for many meetings, not one a meeting.
                    if held >= HELD_PAIRS or b == offsets[-1]:
                        reached, near = _best_of_each(*map(np.concatenate, zip(*out, strict=True)), most)
                        yield pa.RecordBatch.from_arrays([pa.array(reached), near], names=["node", "near"])
                        out, held = [], 0

        found = met.select("met").mapInArrow(run, f"node bigint, near {_PAIR}")
        return _merge(self.graph.union(found), self.neighbours)

    def _levels(self) -> list[float]:
        """Least lengths of the longest nodes: all, a quarter, a sixteenth and so on, as long as they grow."""
        shares = list(itertools.takewhile(lambda p: p * self.size > BLOCK, (4.0 ** -i for i in itertools.count(1))))
        cuts = self.points.agg(F.percentile_approx("norm", [1 - p for p in shares], 10_000)).first()[0] if shares else []
        levels = [0.0]
        last = self.points.agg(F.percentile_approx("norm", 0.5)).first()[0] if shares else 0.0
        for cut in cuts or []:
            if cut > LONGER * last:
                levels.append(cut)
                last = cut
        return levels

    def _entries(self, asked: DataFrame, kind: str) -> DataFrame:
        """(query_id, near): for each query of (query_id, vector), the nodes of largest product in its blocks."""
        most, dimensions = self.neighbours, self.dimensions

        def signs(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([*batch.columns, _signs(_unit(batch.column(1), dimensions))],
                                                 names=["query_id", "asked", "codes"])

        levels = self._levels()
        queries = asked.select("query_id", F.col("vector").alias("asked")).mapInArrow(
            signs, f"query_id {kind}, asked array<float>, codes array<bigint>").withColumn(
            "level", F.explode(F.array(*[F.lit(i) for i in range(len(levels))]))).select(
            "level", F.posexplode("codes").alias("tree", "code"), F.xxhash64("query_id").alias("mix"), "query_id", "asked",
            F.lit(None).cast("bigint").alias("node"), F.lit(None).cast("binary").alias("vector"),
            F.lit(None).cast("double").alias("norm"))
        of = F.filter(F.array(*[F.when(F.col("norm") >= cut, i) for i, cut in enumerate(levels)]), lambda x: x.isNotNull())
        nodes = self.points.select(F.explode(of).alias("level"), "codes", "node", "vector", "norm").select(
            "level", F.posexplode("codes").alias("tree", "code"), F.xxhash64("node", "tree").alias("mix"),
            F.lit(None).cast(kind).alias("query_id"), F.lit(None).cast("array<float>").alias("asked"), "node", "vector",
            "norm")
        order = ["level", "tree", "code", "mix"]
        names = ["query_id", "asked", "node", "vector", "norm", "group"]
        rows = queries.union(nodes).repartitionByRange(*order).sortWithinPartitions(*order).select(
            *names[:-1], (F.col("level") * ORDERS + F.col("tree")).alias("group"))

        def answers(held: list[pa.RecordBatch], before: pa.RecordBatch | None):
            """Rows for the queries held, from the nodes held and those before them; and these nodes."""
            block = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            is_node = block.column(2).is_valid()
            here, asking = block.filter(is_node), block.filter(pc.invert(is_node))
            seen = [b for b in (before, here) if b is not None and b.num_rows]
            if not seen or not asking.num_rows:
                return None, here if here.num_rows else before
            near = pa.Table.from_batches(seen).combine_chunks().to_batches()[0]
            q = asking.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)
            x = _vectors(near.column(3), near.column(4), dimensions)
            sims = q.astype(np.float64) @ x.T
            sims[asking.column(5).to_numpy()[:, None] != near.column(5).to_numpy()[None, :]] = -np.inf
            best = _best(sims, most)
            found = np.take_along_axis(sims, best, axis=1)
            real = np.isfinite(found)
            out = pa.RecordBatch.from_arrays(
                [asking.column(0), _lists(real.sum(axis=1).tolist(), found[real], near.column(2).to_numpy()[best][real])],
                names=["query_id", "near"])
            return out, here if here.num_rows else before

        def run(batches):
            held, n, before = [], 0, None
            for batch in batches:
                for i in range(0, batch.num_rows, BLOCK):
                    part = batch.slice(i, BLOCK)
                    held.append(part)
                    n += part.num_rows - part.column(2).null_count
                    if n >= BLOCK or len(held) >= 16:
                        out, before = answers(held, before)
                        held, n = [], 0
                        if out is not None:
                            yield out
            if held:
                out, _ = answers(held, before)
                if out is not None:
                    yield out

        return rows.mapInArrow(run, f"query_id {kind}, near {_PAIR}")

    def search(self, queries: DataFrame, k: int = 20, beam: int = BEAM) -> DataFrame:
        """(query_id, rank, id, score) of the ``k`` nearest found, from (query_id, embedding, start).

        ``start`` is a node to start from beside those of the query's blocks, or null.  A row of the index whose
        id is the query's takes no part in its answer.  Scores are inner products in double precision."""
        valid_queries = queries.filter(valid(F.col("embedding")) & (F.size("embedding") == self.dimensions))
        dimensions, kind = self.dimensions, queries.schema["query_id"].dataType.simpleString()
        around = keep(self.graph.select("node", F.explode("near.id").alias("id")).join(
            self.points.select(F.col("node").alias("id"), "vector", "norm"), "id").groupBy("node").agg(
            F.collect_list(F.struct("id", "vector", "norm")).alias("near")), "nn")
        length = norm_of(F.col("embedding"))
        asked = valid_queries.withColumn("length", length).select(
            "query_id", F.transform("embedding", lambda x: (x / F.col("length")).cast("float")).alias("vector"), "start")
        spot = "array<struct<sim:double,id:bigint,open:boolean>>"
        beginning = F.when(F.col("start").isNotNull(), F.array(F.struct(
            F.lit(-math.inf).alias("sim"), F.col("start").cast("bigint").alias("id"), F.lit(True).alias("open")))).otherwise(
            F.array()).cast(spot)

        def score(batches):
            for batch in batches:
                offsets, entries = _list_parts(batch.column(2))
                if not len(entries):
                    continue
                q = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions).astype(np.float64)
                sims = np.empty(len(entries))
                for i in range(0, batch.num_rows, 256):
                    a, b = int(offsets[i]), int(offsets[min(i + 256, batch.num_rows)])
                    x = _vectors(entries.field("vector").slice(a, b - a), entries.field("norm").slice(a, b - a), dimensions)
                    sims[a:b] = np.einsum("ij,ij->i", np.repeat(q[i:i + 256], np.diff(offsets[i:i + 257]), axis=0), x)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), _lists(np.diff(offsets).tolist(), sims, entries.field("id").to_numpy())],
                    names=["query_id", "near"])

        def merged(batches):
            for batch in batches:
                held, found = _list_parts(batch.column(2)), _list_parts(batch.column(3))
                rows, sims, ids, fresh = (np.concatenate(both) for both in zip(*[
                    (np.repeat(np.arange(batch.num_rows), np.diff(offsets)), entries.field("sim").to_numpy(),
                     entries.field("id").to_numpy(), np.full(len(entries), new))
                    for new, (offsets, entries) in enumerate((held, found))], strict=True))
                # A start has no score of its own; if it is met as a neighbour it comes in again with one.
                real = np.flatnonzero(np.isfinite(sims))
                order = real[np.lexsort((-sims[real], fresh[real], ids[real], rows[real]))]
                first = np.ones(len(order), dtype=bool)
                first[1:] = (rows[order][1:] != rows[order][:-1]) | (ids[order][1:] != ids[order][:-1])
                order = order[first]
                order = order[np.lexsort((-ids[order], -sims[order], rows[order]))]
                sizes = np.bincount(rows[order], minlength=batch.num_rows)
                kept = order[np.arange(len(order)) - np.repeat(np.cumsum(sizes) - sizes, sizes) < beam]
                offsets = np.concatenate(([0], np.cumsum(np.minimum(sizes, beam)))).astype(np.int32)
                after = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(
                    [pa.array(sims[kept]), pa.array(ids[kept]), pa.array(fresh[kept] > 0)], names=["sim", "id", "open"]))
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], after], names=["query_id", "vector", "beam"])

        def better(state: DataFrame, found: DataFrame) -> DataFrame:
            """The beams with what was found; only new nodes are open."""
            gathered = found.groupBy("query_id").agg(F.flatten(F.collect_list("near")).alias("near"))
            return state.join(gathered, "query_id", "left").select(
                "query_id", "vector", "beam", F.coalesce("near", F.array().cast(_PAIR)).alias("near")).mapInArrow(
                merged, f"query_id {kind}, vector array<float>, beam {spot}")

        begun = asked.select("query_id", "vector", beginning.alias("beam"))
        entered = better(asked.select("query_id", "vector", F.array().cast(spot).alias("beam")), self._entries(asked, kind))
        # The start comes beside what the blocks hold.
        state = keep(entered.select("query_id", F.col("beam").alias("near")).join(begun, "query_id").select(
            "query_id", "vector", F.concat("near", "beam").alias("beam")), "nn")
        while True:
            front = state.select("query_id", "vector", F.explode(F.filter("beam", lambda b: b["open"])).alias("b"))
            if not front.limit(1).count():
                break
            found = front.select("query_id", "vector", F.col("b.id").alias("node")).join(around, "node").select(
                "query_id", "vector", "near").mapInArrow(score, f"query_id {kind}, near {_PAIR}")
            after = keep(better(state, found), "nn")
            drop(state)
            state = after
        near = state.select("query_id", F.explode("beam.id").alias("node")).union(
            valid_queries.filter("start is not null").select("query_id", "start")).distinct()
        exact = near.join(self.nodes, "node").join(
            valid_queries.select("query_id", F.col("embedding").alias("asked")), "query_id")
        dot = F.aggregate(F.zip_with("asked", "embedding", lambda a, b: a.cast("double") * b.cast("double")),
                          F.lit(0.0), lambda a, x: a + x)
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        drop_self = F.col("member") != F.col("query_id")
        return exact.select("query_id", "node", dot.alias("score")).join(self.members, "node").filter(drop_self).select(
            "query_id", F.col("member").alias("vec_id"), "score").withColumn("rank", rank).filter(
            F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
