"""Conversation repair against a plain search over all edits."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from flowscore.llm import queries as Q
from flowscore.llm import turns

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id bigint, turn bigint, role string, text string"
DONE = re.compile("(s?(ua)+)?")


def fault_of(rows):
    out, seen = [], set()
    for _, role, text in rows:
        bare = re.sub(r"[\x20\x09-\x0D]", "", text)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else
                   "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def repaired(rows):
    """Uniform-cost search over (rows done, turns out): (cost, audit) grow in order, so the first end is the least."""
    faults = fault_of(rows)
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, roles, out = heapq.heappop(heap)
        state = (at, "s" if roles == "s" else roles[-1:])
        if at == len(rows) and DONE.fullmatch(roles):
            return cost, audit, out
        if state in seen:
            continue
        seen.add(state)
        due = "a" if roles[-1:] == "u" else "u"
        full = {"u": "user", "a": "assistant"}[due]
        if len(audit) < 3 * len(rows) + 3:
            heapq.heappush(heap, (cost + 2, audit + "I", at, roles + due, (*out, f"{full}:")))
        if at < len(rows):
            _, role, text = rows[at]
            heapq.heappush(heap, (cost + 3, audit + "D", at + 1, roles, out))
            if faults[at] in (None, "truncated"):
                more = cost + (faults[at] == "truncated")
                if role[:1] == due or role[:1] == "s" and not roles:
                    heapq.heappush(heap, (more, audit + "K", at + 1, roles + role[0], (*out, f"{role}:{text}")))
                heapq.heappush(heap, (more + 2, audit + "R", at + 1, roles + due, (*out, f"{full}:{text}")))


def expected(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, hash) of one conversation's rows (turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    faults, known = fault_of(rows), [r[0] for r in rows if r[0] is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    cost, audit, out = repaired(rows)
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest())


def summarised(repair):
    digests = {r.conv: r.repaired_sha256 for r in turns.digests(repair.turns()).collect()}
    return {r.conv: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit,
                     digests.get(r.conv, hashlib.sha256(b"").hexdigest())) for r in repair.summary().collect()}


def by_conversation(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    return {c: expected(r) for c, r in out.items()}


def some_rows(n, conversations, seed=3):
    rng = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "sys"]
    texts = ["Yes.", "No!", "", " \t", "open", "What? ", None, "a\n.", "U", "V.", "W.", "X.", "Y", "Z.\x0b"]
    return [(rng.choice(conversations), rng.choice([None, *range(12)]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.5
             else f"text {rng.random()}.") for _ in range(n)]


@pytest.mark.parametrize("block", [1024, 3])
def test_any_conversations(spark, monkeypatch, block):
    monkeypatch.setattr(turns, "BLOCK", block)
    rows = some_rows(120, [*range(14), None]) + some_rows(25, [100], seed=5)
    repair = turns.Repair(spark.createDataFrame(rows, SCHEMA))
    assert summarised(repair) == by_conversation(rows)


def test_one_block_and_many_agree(spark, monkeypatch):
    rows = spark.createDataFrame(some_rows(1500, [1, 1, 1, 1, 2, 3, 4]), SCHEMA).repartition(5)
    monkeypatch.setattr(turns, "BLOCK", 7)
    small = summarised(turns.Repair(rows))
    monkeypatch.setattr(turns, "BLOCK", 4096)
    assert small == summarised(turns.Repair(rows))


def test_empty_and_deleted(spark):
    assert summarised(turns.Repair(spark.createDataFrame([], SCHEMA))) == {}
    rows = [(1, 0, "user", ""), (1, 1, "user", " "), (2, 0, "system", "Be kind.")]
    assert summarised(turns.Repair(spark.createDataFrame(rows, SCHEMA))) == by_conversation(rows)


def test_other_columns_and_names(spark):
    rows = spark.createDataFrame([(1, 0, "user", "Hi.", "x", 5), (1, 1, "assistant", "Ho.", "y", 6)],
                                 "`conv id` bigint, turn bigint, `who``s` string, text string, place string, kind bigint")
    repair = turns.Repair(rows, conv_col="conv id", role_col="who`s")
    assert [r.audit for r in repair.summary().collect()] == ["KK"]
    assert [(r.role, r.text) for r in repair.turns().orderBy("place", "nth").collect()] == [("user", "Hi."), ("assistant", "Ho.")]


def test_query(spark):
    from corpus_pipeline import read_table
    rows = read_table(spark, SF, "conversations").collect()
    harmed = []
    for r in rows:
        fault = zlib.crc32(f"{r.conv_id}:{r.turn}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", r.text) if fault == 2 else r.text
        harmed += [(r.conv_id, r.turn, "user" if fault == 4 else r.role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    want = by_conversation(harmed)
    got = Q.op11_conversation_repair(spark, SF).collect()
    assert sorted(r.conv_id for r in got) == sorted({r.conv_id for r in rows})
    none = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    for r in got:
        assert tuple(r)[1:] == want.get(r.conv_id, none)


def test_damage_of_nulls(spark):
    rows = spark.createDataFrame([(None, None, None, None), (1, None, "user", "a.")], SCHEMA)
    fault = [zlib.crc32(b" : ") % 20, zlib.crc32(b"1: ") % 20]
    assert Q.damaged(rows).count() == sum(0 if f == 0 else 2 if f == 3 else 1 for f in fault)
    assert Q.damaged(rows).filter(F.col("role").isNull() | F.col("text").isNull()).count() == 0
