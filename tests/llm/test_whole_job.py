"""What an earlier version cut short."""

import random

import numpy as np
import pyarrow as pa

from flowscore.llm import decontam, nndescent, packing, secrets, simhash


def one_round(spark, x, lists, neighbours):
    """Ids of each node's neighbours after one round from the given lists."""
    packed = nndescent._pack(np.array(x))
    sims = nndescent._products(*nndescent._unpack(pa.array(packed, pa.binary())))
    index = object.__new__(nndescent.Index)
    index.neighbours = neighbours
    index.points = spark.createDataFrame(list(enumerate(map(bytearray, packed))), "node bigint, vector binary")
    index.graph = spark.createDataFrame(
        [(a, sorted(((float(sims[a, b]), b) for b in near), reverse=True)) for a, near in lists.items()],
        f"node bigint, near {nndescent._PAIR}")
    return {r.node: [e.id for e in r.near] for r in index._round(0).collect()}, sims


def circle(angles):
    return np.stack([np.cos(angles), np.sin(angles)], axis=1)


def test_known_neighbours_leave_room_for_new_ones(spark):
    # Node 1 knows the eight nearest of node 0's list and a far one, but not the ninth.
    x = circle(np.array([0.5, 0.0, *(0.01 * np.arange(1, 10)), 3.0]))
    lists = {0: list(range(1, 11)), 1: [*range(2, 10), 11], **{i: [0] for i in range(2, 12)}}
    got, _ = one_round(spark, x, lists, 9)
    assert got[1] == list(range(2, 11))


def test_all_nodes_that_name_a_hub_meet(spark):
    rng = np.random.default_rng(3)
    x = circle(rng.uniform(0, 6.28, 300))
    got, _ = one_round(spark, x, {0: [1], **{i: [0] for i in range(1, 300)}}, 5)
    assert all(len(near) == 5 for node, near in got.items() if node)


def test_keys_after_a_name_and_at_the_end_of_a_path(spark):
    rng = random.Random(5)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    plain, signed = "".join(rng.choices(letters, k=40)), "".join(rng.choices(letters + "+/", k=42)) + "+="
    cases = [("DB_KEY=", plain, ""), ("run with sig=", signed, " now"), ("at srv/app_data/", plain, ""),
             ("at my-files/", signed, ""), ("/a_b/", plain, "_x/y"), ("A=", plain, "=b_c/d")]
    docs = spark.createDataFrame([(i, "".join(c)) for i, c in enumerate(cases)], "doc_id int, text string")
    for r in secrets.redact(docs).collect():
        assert cases[r.doc_id][1].rstrip("=") not in r.text and "[SECRET]" in r.text
    names = spark.createDataFrame([(1, "some_file_name_with_words/and_more/parts_of_an_ordinary_path=yes")], docs.schema)
    assert [r.spans for r in secrets.find(names).collect()] == [""]


def test_rows_of_one_id_with_different_texts_are_kept(spark):
    a, b = (" ".join(f"{w}{i}" for i in range(60)) for w in ("alpha", "stone"))
    rows = [(1, a), (5, b), (5, a), (5, b), (7, b), (None, a)]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    assert sorted(map(tuple, simhash.keep_one(docs).collect()), key=str) == sorted([(1, a), (5, b), (None, a)], key=str)
    docs = spark.createDataFrame([(5, a), (5, b)], docs.schema)
    assert simhash.keep_one(docs).count() == 2


def test_packing_finds_neighbours_in_other_partitions_and_shards(spark):
    rng = random.Random(1)
    topics = [[f"{a}{b}word{i}" for i in range(40)] for a in ("red", "blue", "green", "grey", "pink") for b in "klmnprst"]
    rows = [(i, " ".join(rng.choices(topics[i % 40], k=120))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id int, text string").repartition(20, "doc_id")
    pieces = packing.pack(docs, shard_tokens=1 << 14).collect()
    together = {}
    for p in pieces:
        together.setdefault(p.sequence_id, set()).add(p.doc_id % 40)
    assert {p.doc_id for p in pieces} == set(range(400))
    assert np.mean([len(t) for t in together.values()]) < 2.5


def test_items_in_scripts_without_spaces_are_found(spark):
    items = ["日本の首都は東京であり人口が多い", "ประเทศไทยมีเมืองหลวงคือกรุงเทพ"]
    rows = [(1, "昨日は" + items[0] + "と聞いた"), (2, "ว่า" + items[1] + "และ"), (3, "今日は良い天気です"), (4, "snake_case 1a é")]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id int, text string")
    assert [r.doc_id for r in decontam.Decontamination(docs, bench).clean().orderBy("doc_id").collect()] == [3, 4]
    assert len(decontam.words("snake_case 1a é")) == 3
