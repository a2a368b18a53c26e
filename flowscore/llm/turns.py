"""Repair of conversation structure by Hirschberg's divide and conquer.

A repaired conversation is empty, or an optional system turn and then user and assistant turns in pairs.  Four states
(nothing yet, after the system turn, after a user turn, after an assistant turn) read it; a row is kept, given another
role or deleted, and empty turns may be inserted before it.  What one row can do is a 4 x 4 table of costs with the
order of the edits that reach each state, and tables of neighbours combine like (min, +) matrices: of equal costs the
least in the order of the edits' initials wins, and no two ways to different states share a prefix, so ranks of
states are all that has to be remembered of the edits.

Rows are put into one total order (conversation, turn, role, text) and cut into blocks of equal size.  A block solves the
conversations that lie in it: forward and backward cost vectors meet in the middle, the audit-least optimal crossing
splits the span, and both halves go on, all spans of a block at once.  What a block's border cuts goes up as one
combined table for each piece, into blocks of pieces, until nothing is cut; the states at the pieces' borders then come
down.  So a conversation of any length is repaired in blocks, and no task holds more than one block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowscore.llm.rows import named
from flowscore.llm.scratch import keep
from flowscore.operators.positions import with_position

#: Rows, or pieces of conversations, in a block.
BLOCK = 1024
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {"u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
FAR = 1 << 40
#: Role initials of a row as numbers; 3: any other.
INITIALS = "sua"
#: White space in the sense of blank texts.
SPACE = r"\x20\x09-\x0D"


def _next(state: int) -> tuple[str, int]:
    """The turn that may be inserted in a state, and the state after it."""
    return ("a", ASSISTANT) if state == USER else ("u", USER)


def _moves(initial: int, must_go: bool, truncated: bool):
    """Every (from, to, cost, edits) of one row with the turns inserted before it."""
    for start in range(4):
        state, edits, cost = start, "", 0
        while True:
            yield start, state, cost + DELETE, edits + "D"
            if not must_go:
                due, after = _next(state)
                yield start, after, cost + REROLE + TRUNCATED * truncated, edits + "R"
                if initial < 3 and (INITIALS[initial] == due or INITIALS[initial] == "s" and state == START):
                    kept = SYSTEM if INITIALS[initial] == "s" else after
                    yield start, kept, cost + KEEP + TRUNCATED * truncated, edits + "K"
            state, edits, cost = _next(state)[1], edits + "I", cost + INSERT
            if state == start or len(edits) > 2:
                break


def _tables():
    """For each kind of row: costs, ranks of the edits among states reached from one state, and the edits."""
    costs, ranks, edits = np.full((16, 4, 4), FAR, dtype=np.int64), np.zeros((16, 4, 4), dtype=np.int64), {}
    for kind in range(16):
        best: dict[tuple[int, int], tuple[int, str]] = {}
        for a, b, cost, how in _moves(kind % 4, kind & 4 > 0, kind & 8 > 0):
            best[a, b] = min(best.get((a, b), (FAR, "")), (cost, how))
        for (a, b), (cost, how) in best.items():
            costs[kind, a, b], edits[kind, a, b] = cost, how
        for a in range(4):
            order = sorted(range(4), key=lambda b: edits.get((kind, a, b), "~"))
            ranks[kind, a, order] = range(4)
    return costs, ranks, edits


COSTS, RANKS, EDITS = _tables()
#: Cost and edits from each state to the end of a conversation.
ENDING = [(0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, "")]
#: Kinds: initial + 4 (must be deleted) + 8 (truncated).


def transfer(costs: np.ndarray, ranks: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Combined table of each span [low, high) of a list of tables: (spans, 4, 4) costs and ranks."""
    spans = len(low)
    cost = np.where(np.eye(4, dtype=bool), 0, FAR)[None].repeat(spans, 0)
    rank = np.tile(np.arange(4), (spans, 4, 1))
    for step in range(int((high - low).max(initial=0))):
        on = np.flatnonzero(low + step < high)
        cost[on], rank[on] = _forward(cost[on], rank[on], costs[low[on] + step][:, None], ranks[low[on] + step][:, None])
    return cost, rank


def _forward(cost, rank, step_cost, step_rank):
    """One table further; the last axis is the state, all axes before are independent."""
    through = (cost * 4 + rank)[..., :, None] + 4 * step_cost
    via = through.argmin(axis=-2)
    best = np.take_along_axis(through, via[..., None, :], -2)[..., 0, :]
    shape = best.shape[:-1] + (4, 4)
    within = np.take_along_axis(np.broadcast_to(step_rank, shape), via[..., None, :], -2)[..., 0, :]
    order = np.take_along_axis(rank, via, -1) * 4 + within
    # States that can't be reached come last.
    order = np.where(best // 4 >= FAR, 64 + np.arange(4), order)
    return np.minimum(best // 4, FAR), order.argsort(-1).argsort(-1)


def crossings(costs: np.ndarray, ranks: np.ndarray, low, high, first, last) -> tuple[np.ndarray, np.ndarray]:
    """States before and after each table in the spans [low, high), which begin in ``first`` and end in ``last``.

    Only two vectors a span are held beside the tables; spans halve until they are single tables."""
    before, after = np.zeros(len(costs), dtype=np.int64), np.zeros(len(costs), dtype=np.int64)
    low, high, first, last = (np.asarray(x, dtype=np.int64) for x in (low, high, first, last))
    while len(low):
        single = high - low == 1
        before[low[single]], after[low[single]] = first[single], last[single]
        open_ = high - low > 1
        low, high, first, last = low[open_], high[open_], first[open_], last[open_]
        if not len(low):
            break
        middle = (low + high) // 2
        forward = np.where(np.arange(4) == first[:, None], 0, FAR)
        rank = np.tile(np.arange(4), (len(low), 1))
        for step in range(int((middle - low).max())):
            on = np.flatnonzero(low + step < middle)
            forward[on], rank[on] = _forward(forward[on], rank[on], costs[low[on] + step], ranks[low[on] + step])
        backward = np.where(np.arange(4) == last[:, None], 0, FAR)
        for step in range(1, int((high - middle).max()) + 1):
            on = np.flatnonzero(high - step >= middle)
            ahead = (costs[high[on] - step] + backward[on][:, None, :]).min(-1)
            backward[on] = np.minimum(ahead, FAR)
        crossing = ((forward + backward) * 4 + rank).argmin(-1)
        low, high, first, last = (np.concatenate(x) for x in
                                  ((low, middle), (middle, high), (first, crossing), (crossing, last)))
    return before, after


def best_end(cost: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The state to end in, of the least cost to the end of the conversation, then the least edits; (spans, 4) each."""
    return ((cost + np.array([c for c, _ in ENDING])) * 4 + rank).argmin(-1)


def _runs(keys: list) -> tuple[np.ndarray, np.ndarray]:
    starts = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]]
    return np.array(starts, dtype=np.int64), np.array([*starts[1:], len(keys)], dtype=np.int64)


def _blocks(conv: T.DataType) -> T.StructType:
    """Rows of a level: block and place, conversation, table (rows: their kind), and the states once they are known."""
    long, several = T.LongType(), T.ArrayType(T.LongType())
    return T.StructType([T.StructField("block", long), T.StructField("place", long), T.StructField("conv", conv),
                         T.StructField("kind", T.IntegerType()), T.StructField("cost", several),
                         T.StructField("rank", several), T.StructField("first", T.IntegerType()),
                         T.StructField("last", T.IntegerType())])


def _solve(table: pa.Table, schema: pa.Schema, top: bool, down: bool) -> pa.Table:
    """One block.  Up: the table of each conversation the block's borders may cut.  Down: the states of every element,
    with those of the cut conversations given as rows of negative place."""
    table = table.sort_by([("place", "ascending")])
    block = table.column("block")[0].as_py()
    place = table.column("place").to_numpy()
    given = int((place < 0).sum())
    ends = {r["conv"]: (r["first"], r["last"]) for r in table.slice(0, given).select(["conv", "first", "last"]).to_pylist()}
    table, place = table.slice(given), place[given:]
    conv = table.column("conv").to_pylist()
    if table.column("kind").null_count == 0:
        kind = table.column("kind").to_numpy()
        costs, ranks = COSTS[kind], RANKS[kind]
    else:
        costs = np.array(table.column("cost").to_pylist(), dtype=np.int64).reshape(-1, 4, 4)
        ranks = np.array(table.column("rank").to_pylist(), dtype=np.int64).reshape(-1, 4, 4)
    low, high = _runs(conv)
    cut = np.zeros(len(low), dtype=bool)
    if not top:
        cut[[0, -1]] = True
    if not down:
        low, high = low[cut], high[cut]
        cost, rank = transfer(costs, ranks, low, high)
        # Of one block's two pieces the first comes first above.
        rows = [{"block": block // BLOCK, "place": 2 * block + (a > 0), "conv": conv[a], "kind": None, "cost": c.ravel().tolist(),
                 "rank": r.ravel().tolist(), "first": None, "last": None}
                for a, c, r in zip(low.tolist(), cost, rank, strict=True)]
        return pa.Table.from_pylist(rows, schema=schema)
    first, last = np.zeros(len(low), dtype=np.int64), np.zeros(len(low), dtype=np.int64)
    whole = np.flatnonzero(~cut)
    cost, rank = transfer(costs, ranks, low[whole], high[whole])
    last[whole] = best_end(cost[:, START], rank[:, START])
    for i in np.flatnonzero(cut).tolist():
        first[i], last[i] = ends[conv[low[i]]]
    before, after = crossings(costs, ranks, low, high, first, last)
    # A piece's place tells the block it stands for.
    none = pa.nulls(len(conv))
    columns = [pa.array(place // 2 if table.column("kind").null_count else np.full(len(conv), block)), table.column("place"),
               table.column("conv"), table.column("kind"), none.cast(schema.field("cost").type),
               none.cast(schema.field("rank").type), pa.array(before, pa.int32()), pa.array(after, pa.int32())]
    return pa.Table.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns],
                                schema=schema)


def _levels(rows: DataFrame, conv: T.DataType) -> DataFrame:
    """``rows`` (block, place, conv, kind) with their states ``first`` and ``last``."""
    schema = _blocks(conv)
    fill = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields[4:]]

    def solved(level, top, down):
        def block(table):
            return _solve(table, block_schema(table.schema.field("conv").type), top, down)
        return level.groupBy("block").applyInArrow(block, schema)

    levels = [rows.select("block", "place", "conv", "kind", *fill)]
    while levels[-1].select("block").distinct().limit(2).count() > 1:
        levels.append(keep(solved(levels[-1], False, False), "turns-up"))
    states = solved(levels[-1], True, True)
    for level in reversed(levels[:-1]):
        # The states of a cut piece become rows of negative place in the block it stands for.
        given = keep(states.select("block", F.lit(-1).cast("bigint").alias("place"), "conv",
                                   F.lit(None).cast("int").alias("kind"), "cost", "rank", "first", "last"), "turns-down")
        states = solved(level.unionByName(given), False, True)
    return states


def block_schema(conv: pa.DataType) -> pa.Schema:
    several = pa.list_(pa.int64())
    return pa.schema([("block", pa.int64()), ("place", pa.int64()), ("conv", conv), ("kind", pa.int32()),
                      ("cost", several), ("rank", several), ("first", pa.int32()), ("last", pa.int32())])


def _letters() -> Column:
    """Edits of a row as (edits, roles of the turns that come out), by its kind and states."""
    entries = []
    for (kind, a, b), how in EDITS.items():
        state, roles = a, ""
        for edit in how:
            if edit in "IR":
                due, state = _next(state)
                roles += due
            elif edit == "K":
                roles += "k"
        entries += [F.lit(kind * 16 + a * 4 + b), F.struct(F.lit(how).alias("edits"), F.lit(roles).alias("roles"))]
    return F.element_at(F.create_map(*entries), F.col("kind") * 16 + F.col("first") * 4 + F.col("last"))


class Repair:
    """The cheapest repair of each conversation of ``rows``; edits, faults and repaired turns.

    Rows of a conversation are taken by turn (nulls first), then role and text.  A null role or text counts as one
    space, null conversations are one conversation.  Repeated rows are rows of their own (and duplicates).  Columns
    beside the four named ones are not read.  An empty table has no conversations."""

    def __init__(self, rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text"):
        plain = rows.select(named(conv_col).alias("conv"), named(turn_col).alias("turn"),
                            F.coalesce(named(role_col).cast("string"), F.lit(" ")).alias("role"),
                            F.coalesce(named(text_col).cast("string"), F.lit(" ")).alias("text"))
        self.rows = with_position(plain, F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"),
                                  F.col("text"), out="place")
        light = keep(self._faults(), "turns")
        state = _levels(light.select((F.expr(f"place div {BLOCK}")).alias("block"), "place", "conv", "kind"),
                        light.schema["conv"].dataType)
        self.light = light
        self.edits = keep(state.select("place", "conv", "kind", "first", "last", _letters().alias("done")).select(
            "place", "conv", "kind", "last", "done.edits", "done.roles",
            # What the row costs: its edits, and 1 for a truncated one that stays.
            (F.length(F.translate("done.edits", "KDR", "")) * INSERT + F.when(F.col("done.edits").endswith("D"), DELETE)
             .otherwise(F.when(F.col("done.edits").endswith("R"), REROLE).otherwise(KEEP)
                        + F.when(F.col("kind") >= 8, TRUNCATED).otherwise(0))).cast("bigint").alias("cost")), "turns")

    def _faults(self) -> DataFrame:
        """(place, conv, turn, initial, fault, kind) of each row."""
        key = F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256)
        # The first row of each text is known by its place, so no conversation or text is brought together.
        firsts = self.rows.groupBy("conv", key.alias("said")).agg(F.min("place").alias("place")).select(
            "place", F.lit(True).alias("is_first"))
        last = F.regexp_extract("text", rf"([^{SPACE}])[{SPACE}]*\z", 1)
        blank = ~F.col("text").rlike(rf"[^{SPACE}]")
        initial = F.substring("role", 1, 1)
        flagged = self.rows.select(
            "place", "conv", "turn", initial.alias("initial"), blank.alias("blank"),
            (~blank & ~last.isin(".", "!", "?")).alias("open")).join(firsts, "place", "left")
        fault = F.when(F.col("blank"), "blank").when(F.col("is_first").isNull(), "duplicate").when(F.col("open"), "truncated")
        number = F.when(initial_is("s"), 0).when(initial_is("u"), 1).when(initial_is("a"), 2).otherwise(3)
        return flagged.select("place", "conv", "turn", "initial", fault.alias("fault")).withColumn(
            "kind", (number + F.when(F.col("fault").isin("blank", "duplicate"), 4).when(
                F.col("fault") == "truncated", 8).otherwise(0)).cast("int"))

    def _ends(self) -> DataFrame:
        """(place, conv, ending): the last row of each conversation and the turns inserted after it."""
        last = self.light.groupBy("conv").agg(F.max("place").alias("place")).select("place")
        state = self.edits.join(last, "place")
        after = F.element_at(F.array(*[F.lit(e) for _, e in ENDING]), F.col("last") + 1)
        return state.select("place", "conv", "last", after.alias("ending"))

    def turns(self) -> DataFrame:
        """The repaired turns: conv, place (of the row they come from or stand before or after), nth (there), role, text."""
        edits = self.edits.join(self._ends().select("place", "ending"), "place", "left")
        first_of_end = F.when(F.col("last") == USER, "a").otherwise("ua")
        roles = F.concat("roles", F.when(F.length("ending") > 0, first_of_end).otherwise(""))
        each = edits.select("place", F.posexplode(F.split(roles, "")).alias("nth", "turn_role")).filter("turn_role <> ''")
        origin = F.instr("roles", "k")
        out = each.join(edits.select("place", "edits", F.when(origin > 0, origin - 1).when(
            F.col("edits").endswith("R"), F.length("roles") - 1).otherwise(-1).alias("origin")), "place").join(
            self.rows.select("place", "conv", "role", "text"), "place")
        own = F.col("nth") == F.col("origin")
        role = F.when(F.col("turn_role") == "k", F.col("role")).when(F.col("turn_role") == "u", ROLES["u"]).otherwise(ROLES["a"])
        return out.select("conv", "place", "nth", role.alias("role"), F.when(own, F.col("text")).otherwise("").alias("text"))

    def summary(self) -> DataFrame:
        """One row per conversation: gaps, blank, duplicate, truncated, illegal, cost, audit."""
        light = self.light
        count = lambda x: F.count_if(F.coalesce(x, F.lit(False))).alias
        before = light.select((F.col("place") + 1).alias("place"), F.col("conv").alias("conv_before"),
                              F.col("initial").alias("initial_before"))
        pair = F.concat("initial_before", "initial")
        wrong = F.col("conv").eqNullSafe(F.col("conv_before")) & ~pair.isin("su", "ua", "au")
        # Counts, sums and pieces of the audit by block first, so that a long conversation is a few rows.
        block = F.expr(f"place div {BLOCK}").alias("block")
        wide = light.join(before, "place", "left").join(
            self.edits.select("place", "cost", "edits"), "place")
        parts = wide.groupBy("conv", block).agg(
            F.min("turn").alias("low"), F.max("turn").alias("high"),
            *[count(F.col("fault") == f)(f) for f in ("blank", "duplicate", "truncated")],
            count(wrong)("illegal"),
            F.sum("cost").alias("cost"),
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "edits"))), lambda x: x["edits"]), "")
            .alias("edits"))
        whole = parts.groupBy("conv").agg(
            F.min("low").alias("low"), F.max("high").alias("high"),
            *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "edits"))), lambda x: x["edits"]), "")
            .alias("audit"))
        turns = light.select("conv", "turn").distinct().groupBy("conv").agg(F.count("turn").alias("turns"))
        ends = self._ends().select("conv", "ending", F.element_at(
            F.array(*[F.lit(c) for c, _ in ENDING]), F.col("last") + 1).alias("end_cost"))
        same = lambda a, b: a.join(b.withColumnRenamed("conv", "conv_b"),
                                   F.col("conv").eqNullSafe(F.col("conv_b"))).drop("conv_b")
        span = F.col("high").cast("decimal(38,0)") - F.col("low").cast("decimal(38,0)")
        gaps = F.when(span.isNull(), 0).otherwise((span + 1 - F.col("turns")).try_cast("bigint"))
        return same(same(whole, turns), ends).select(
            "conv", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal",
            (F.col("cost") + F.col("end_cost")).alias("cost"), F.concat("audit", "ending").alias("audit"))


def initial_is(letter: str) -> Column:
    return F.col("initial") == letter


def digests(turns: DataFrame) -> DataFrame:
    """(conv, repaired_sha256): the hash of the repaired turns as ``role:text`` lines.  A hash is taken in one go, so the
    rows of one conversation stream through one task; it holds one batch of them at a time."""
    import hashlib
    conv = T.StructField("conv", turns.schema["conv"].dataType)
    schema = T.StructType([conv, T.StructField("repaired_sha256", T.StringType())])
    lines = turns.select("conv", "place", "nth", F.concat_ws(":", "role", "text").alias("line"))
    dealt = lines.repartition("conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), "place", "nth")

    def run(batches):
        state, at, kind = None, None, None
        for batch in batches:
            kind, out = batch.schema.field("conv").type, []
            for key, line in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if state is None or key != at:
                    if state is not None:
                        out.append((at, state.hexdigest()))
                    state, at = hashlib.sha256(line.encode()), key
                else:
                    state.update(b"\n" + line.encode())
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], kind), pa.array([h for _, h in out], pa.string())],
                                             names=schema.names)
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at], kind), pa.array([state.hexdigest()])], names=schema.names)

    return dealt.mapInArrow(run, schema)
