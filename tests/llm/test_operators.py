"""Each operator against a brute-force version, and on nulls, empty tables, repeated rows, ties and long texts."""

import json
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from flowscore.llm import (arrowfiles, decontam, langid, nndescent, packing, quality, rollups, secrets, simhash, tokens,
                           urlfilter)
from flowscore.llm import queries as Q

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string"
ODD = [(1, None, None, None), (2, "", "en", "a"), (3, "the cat sat on the mat", "en", "a"), (3, "the cat sat on the mat", "en", "a"),
       (None, "le chat est là", "fr", None), (5, "12 34 !!", "de", "b"), (6, "word " * 30_000, "en", "a"),
       (7, "\tx\n\n y  z ", "fr", "b")]


@pytest.fixture(scope="module")
def odd(spark):
    # Columns that clash with names used inside the operators.
    return spark.createDataFrame([(*r, i, "x") for i, r in enumerate(ODD)], DOCS + ", id int, text_item string")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer
    out = {}
    for name in (tokens.BYTE_BPE, tokens.WORD_BPE):
        out[name] = Tokenizer.from_file(tokens.tokenizer_path(name))
        out[name].encode_special_tokens = True
    return out


def ids_of(tokenizer, text, end):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]


def docs_of(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# 1 packing

def check_packed(pieces, texts, tokenizer):
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert set(by_doc) == set(texts)
    for doc, of in by_doc.items():
        ids = ids_of(tokenizer, texts[doc], 1)
        copies = Counter((p.start, p.length) for p in of)
        assert len(set(copies.values())) <= 1 or doc == 3
        if doc != 3:
            at = 0
            for p in sorted(of, key=lambda p: p.start):
                assert p.start == at and p.doc_tokens == len(ids)
                assert bytes(p.ids) == np.array(ids[at:at + p.length], dtype="<u4").tobytes()
                at += p.length
            assert at == len(ids)
    for of in by_sequence.values():
        at = 0
        for p in sorted(of, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == 2048 or at < 2048 and at & (at - 1) == 0


def test_packing_roundtrip(spark, whole):
    docs = docs_of(spark)
    check_packed(packing.pack(docs).collect(), {r.doc_id: r.text for r in docs.collect()}, whole[tokens.BYTE_BPE])


def test_packing_odd_and_empty(spark, odd, empty, whole):
    texts = {r[0]: r[1] for r in ODD}
    check_packed(packing.pack(odd).collect(), texts, whole[tokens.BYTE_BPE])
    assert packing.pack(empty).count() == 0


def test_packing_puts_neighbours_together(spark):
    rng = random.Random(1)
    topics = [[f"{t}word{i}" for i in range(40)] for t in ("red", "blue", "green", "grey")]
    rows = [(i, " ".join(rng.choices(topics[i % 4], k=120)), "en", "a") for i in range(80)]
    pieces = packing.pack(spark.createDataFrame(rows, DOCS).coalesce(1)).collect()
    together = [len({p.doc_id % 4 for p in pieces if p.sequence_id == s}) for s in {p.sequence_id for p in pieces}]
    assert np.mean(together) < 2.5


# 2 language

def test_language_id_held_out(spark):
    docs = docs_of(spark)
    got = Q.op2_language_id(spark, SF).collect()
    lang = {r.doc_id: r.lang for r in docs.collect()}
    assert len(got) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in got if r.held_out]) > 0.95
    assert all(0 <= r.score <= 1 for r in got)


def test_language_vectors_are_bound_and_bundled():
    book = langid.Codebook(256, 3, 5)
    text = "Abc ab!"
    want = sum(book.bind([book.letter(ord(c)) for c in g]).astype(float)
               for g in (" ab", "abc", "bc ", "c a", " ab", "ab "))
    assert np.array_equal(book.bundle(text), want)
    assert book.bundle("12 !") is None
    many = "".join(chr(0x4E00 + i) for i in range(600))  # more letters than a table holds
    assert np.isfinite(book.bundle(many)).all() and np.array_equal(book.bundle(text), want)


def test_language_odd(spark, odd, empty):
    found = {(r.doc_id, r.id): r for r in langid.predict(odd, langid.train(odd)).collect()}
    assert len(found) == len(ODD)
    assert found[1, 0].lang_pred == found[2, 1].lang_pred == found[5, 5].lang_pred == "und"
    assert langid.predict(odd, langid.train(empty)).filter("lang_pred <> 'und'").count() == 0
    assert langid.predict(empty, langid.train(odd)).count() == 0


# 3 decontamination

def greedy_tiles(doc, item, least):
    """Quadratic greedy string tiling."""
    out, dm, im = [], [False] * len(doc), [False] * len(item)
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                k = 0
                while i + k < len(item) and j + k < len(doc) and item[i + k] == doc[j + k] and not im[i + k] and not dm[j + k]:
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        if best[0] < least:
            return out
        k, i, j = best
        im[i:i + k] = dm[j:j + k] = [True] * k
        out.append((j, i, k))


def test_tiles_are_greedy():
    rng = random.Random(3)
    for _ in range(60):
        item = [rng.randrange(4) for _ in range(rng.randrange(1, 25))]
        doc = [rng.randrange(4) for _ in range(rng.randrange(0, 40))]
        for _ in range(2):
            a = rng.randrange(len(item))
            at = rng.randrange(len(doc) + 1)
            doc[at:at] = item[a:a + rng.randrange(3, 12)]
        got = decontam.tiles(np.array(doc, dtype=np.uint64), np.array(item, dtype=np.uint64), 3)
        assert got == greedy_tiles(doc, item, 3)


def test_decontamination(spark, odd, empty):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
    w = item.split()
    rows = [(1, "x " + item.upper() + ".", "en", "a"), (2, " ".join(w[10:] + ["so", "what"] + w[:10]), "en", "a"),
            (3, " ".join(w[:7]), "en", "a"), (4, "clean text", "en", "a"), (5, None, "en", "a")]
    docs = spark.createDataFrame(rows, DOCS).unionByName(odd.select("doc_id", "text", "lang", "source"))
    bench = spark.createDataFrame([(1, item), (2, "the cat sat on the mat"), (3, "clean"), (4, None), (5, item)],
                                  "item_id bigint, text string")
    d = decontam.Decontamination(docs, bench)
    pairs = Counter((r.doc_id, r.item_id) for r in d.pairs().collect())
    assert pairs == {(1, 1): 1, (1, 5): 1, (2, 1): 1, (2, 5): 1, (3, 2): 2}
    clean = d.clean()
    assert clean.columns == docs.columns
    assert Counter(r.doc_id for r in clean.collect()) == Counter({3: 1, 4: 1, 5: 2, 1: 1, 2: 1, None: 1, 6: 1, 7: 1})
    assert decontam.Decontamination(docs, bench.limit(0)).clean().count() == docs.count()
    assert decontam.Decontamination(empty, bench).pairs().count() == 0


def test_pairs_that_cannot_reach_the_coverage_are_not_tiled(spark):
    """The count of shared seeds only spares work: pairs are those of tiling every document with every item."""
    rng = random.Random(8)
    item = lambda: " ".join(rng.choice("abcd") for _ in range(rng.randrange(5, 30)))
    items = [item() for _ in range(15)]
    texts = [item() + " " + " ".join(rng.choice(items).split()[rng.randrange(4):]) for _ in range(60)]
    found = decontam.Decontamination(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"),
                                     spark.createDataFrame(list(enumerate(items)), "item_id int, text string"))
    want = set()
    for d, text in enumerate(texts):
        for i, x in enumerate(items):
            marked = greedy_tiles(text.split(), x.split(), decontam.MIN_MATCH)
            if sum(t[2] for t in marked) >= decontam.COVERAGE * len(x.split()):
                want.add((d, i))
    assert {(r.doc_id, r.item_id) for r in found.pairs().collect()} == want


# 4 rollups

def test_rollup(spark, tmp_dir, empty):
    def changes(*rows):
        return spark.createDataFrame(rows, "op string, source string, lang string, tokenizer string, tokens bigint, old_tokens bigint")

    state = rollups.Rollup(spark, "file://" + tmp_dir + "/r")
    assert state.totals().count() == 0
    first = changes(("insert", "a", "en", "v1", 10, None), ("insert", "a", "en", "v1", 5, None),
                    ("insert", None, "en", "v1", 7, None), ("insert", "b", "en", "v1", None, None))
    assert state.apply("1", first) and not state.apply("1", first)
    assert state.apply("2", changes(("revise", "a", "en", "v1", 12, 10), ("delete", None, "en", "v1", 7, None)))
    got = {(r.source, r.documents, r.tokens) for r in state.totals().collect()}
    assert got == {("a", 2, 17), ("b", 1, 0)}
    with pytest.raises(Exception, match="unknown op"):
        state.apply("3", changes(("upsert", "a", "en", "v1", 1, None)))
    assert {(r.source, r.documents, r.tokens) for r in state.totals().collect()} == got
    # A batch that died before its marker is written over.
    first.write.parquet(state.folder + "/deltas/" + state._name("4"))
    assert state.apply("4", changes(("insert", "c", "en", "v1", 3, None)))
    assert {(r.source, r.tokens) for r in state.totals().collect()} == {("a", 17), ("b", 0), ("c", 3)}


def test_token_counts_query(spark, whole):
    want = Counter()
    for r in docs_of(spark).collect():
        if r.text:
            want[r.source, r.lang] += len(ids_of(whole[tokens.BYTE_BPE], r.text, 0)) - 1
    assert {(r.source, r.lang): r.tokens for r in Q.op4_token_counts(spark, SF).collect()} == dict(want)


# 5 Arrow files

@pytest.mark.parametrize("which", ["table", "odd"])
def test_arrow_files(spark, odd, tmp_dir, whole, which):
    docs = docs_of(spark) if which == "table" else odd
    folder = "file://" + tmp_dir + "/arrow"
    manifest = arrowfiles.write(docs, folder)
    got = arrowfiles.read_documents(spark, folder, manifest, "bigint").collect()
    rows = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    at, want = 0, Counter()
    for doc, text in rows:
        ids = ids_of(whole[tokens.WORD_BPE], text, 2)
        want[doc, at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())] += 1
        at += len(ids)
    assert Counter((r.id, r.start, r.n_tokens, r.ids_crc32) for r in got) == want
    for row in manifest.collect():
        part = arrowfiles.Part(folder, row.name)
        flat = [part.sequence_at(k) for k in range(-(-row.tokens // 2048))]
        assert all(len(i) == len(m) == 2048 for i, m in flat) and sum(int(m.sum()) for _, m in flat) == row.tokens
        assert not flat[0][0].flags.owndata  # a view of the mapped file


def test_arrow_files_empty(empty):
    assert arrowfiles.roundtrip(empty).count() == 0


# 6 secrets

def base_spans(text):
    out = []
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    for k, (pattern, group, least) in enumerate([(assign, 2, 6), (re.compile("AKIA[A-Z0-9]+"), 0, 20), (re.compile("[0-9a-f]+"), 0, 24)]):
        out += [(m.start(), k, m.end()) for m in pattern.finditer(text) if len(m[group]) >= least]
    return sorted(out)


DRAWN = "".join(random.Random(11).choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", k=32))
SECRETS = ["é password=hunter22 Token: 'abc' SECRET = \"x.y-z/9==\"", "secret: token: abcdefgh", "AKIA" + "A1" * 8 + " AKIAX",
           "0123456789abcdef01234567 zz 0123456789abcdef", f"key {DRAWN} end", "😀 apikey:abcdef\napi_key:abcde",
           "some_file_name_with_words/and/parts, a normal sentence with Donaudampfschifffahrtsgesellschaft and 4415692656188278"]


def test_secrets(spark, odd, empty):
    docs = spark.createDataFrame([(100 + i, t, "en", "a") for i, t in enumerate(SECRETS)], DOCS).unionByName(
        odd.select("doc_id", "text", "lang", "source"))
    got = secrets.find(docs).collect()
    texts = {100 + i: t for i, t in enumerate(SECRETS)} | {r[0]: r[1] for r in ODD}
    assert len(got) == len(SECRETS) + len(ODD)
    for r in got:
        want = base_spans(texts[r.doc_id] or "")
        base = ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in want)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == i for _, k, _ in want) for i in range(3))
        import hashlib
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert ",".join(x for x in r.spans.split(",") if not x.startswith("random")) == base
    spans = {r.doc_id: r.spans for r in got}
    assert spans[104] == "random:4:36" and spans[106] == ""
    text = {r.doc_id: r.text for r in secrets.redact(docs).filter("doc_id >= 100 or doc_id = 1").collect()}
    assert text[104] == "key [SECRET] end" and text[106] == SECRETS[6] and text[1] is None
    assert text[100] == "é [SECRET] Token: 'abc' [SECRET]\""
    assert secrets.find(empty).count() == 0 and secrets.redact(empty).count() == 0


# 7 URL rules

def test_url_rules(spark):
    rng = random.Random(5)
    hosts = ["com", "org", "example.org", "a.example.org", "b.a.example.org", "xexample.org", "net", "EXAMPLE.org", ""]
    paths = ["", "/", "/es", "/es/", "/es/1", "/en/1", "/en/12", "/en/2", "/fr/x", "/de/", "/\U0001F600"]
    urls = [f"http://{h}{p}{x}" for h in hosts for p in paths for x in ("", "?q=/es/", "#/es/")]
    urls += [None, "", "no scheme", "x://", "a://b://c/d", "http://" + "a." * 3000 + "org/es/", "http://org/" + "y" * 50_000]
    rows = [(i, u) for i, u in enumerate(urls + urls[:40])] + [(None, "http://org/")]
    rules = list(Q.URL_RULES) + [("", "", "allow"), ("org", "/es/1", "block"), ("a.example.org", "/", "block"),
                                 ("com", "/fr/", "block"), ("net", "/" + "z" * 3, "block")]
    for some in (Q.URL_RULES, rules, [(rng.choice(hosts), rng.choice(paths), "block") for _ in range(30)], []):
        table = spark.createDataFrame(some, "host string, path string, verdict string")
        got = urlfilter.judge(spark.createDataFrame(rows, "page_id int, url string"), table).collect()
        assert len(got) == len(rows)
        by = {r.page_id: r for r in got}
        for page, url in rows:
            cut = url.split("://", 1)[1] if url and "://" in url else ""
            host = re.match(r"[^/?#]*", cut)[0]
            path = re.match(r"[^?#]*", cut[len(host):])[0]
            host = host.lower()
            fits = [(len(h) + len(p), len(h), v, h + p) for h, p, v in ((h.lower(), p, v) for h, p, v in some)
                    if (host == h or host.endswith("." + h)) and path.startswith(p)]
            best = max(fits, default=None)
            r = by[page]
            assert (r.host, r.path) == (host, path)
            assert (r.rule, r.verdict) == ((best[3], best[2]) if best else (None, "allow")), (url, some)


def test_url_rules_open_across_ranges(spark):
    """Nested rules that begin before a range of keys and end after it, with all ranges kept apart."""
    deep = ["/" + "a/" * n for n in range(40)]
    rules = [("org", p, "block" if n % 3 else "allow") for n, p in enumerate(deep)] + [("x.org", deep[7], "block")]
    urls = [f"http://{h}{p}{t}" for h in ("org", "x.org", "y.x.org", "com") for p in deep for t in ("", "b", "a", "~")]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = urlfilter.judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(got) == len(urls)
    for r in got:
        fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules
                if (r.host == h or r.host.endswith("." + h)) and r.path.startswith(p)]
        best = max(fits, default=(0, 0, None, "allow"))
        assert (r.rule, r.verdict) == best[2:]


def test_url_oracle(spark):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{SF}/pages.parquet'")
    want = Counter(con.execute(f"select page_id, host, path, rule, verdict from ({Q.ORACLE['op7_url_filter']})").fetchall())
    assert Counter(tuple(r) for r in Q.op7_url_filter(spark, SF).collect()) == want


# 8 quality

def test_quality(spark, odd):
    found = {r.doc_id: r for r in Q.op8_quality(spark, SF).collect()}
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()]
    assert len(found) == docs_of(spark).count()
    assert np.mean([found[d].keep == (q == 1) for d, q in labels]) > 0.9
    rows = quality.with_features(odd.select("doc_id", F.col("source").alias("host"), F.col("lang").alias("path"), "text"))
    none = rows.limit(0).withColumn("good", F.lit(1)).select("host", "path", "bins", "good")
    assert {r.quality for r in quality.classify(rows, none).collect()} == {0.5}


def test_sparse_sites_are_shrunk(spark):
    rows = [("big", "p", 1)] * 60 + [("big", "p", 0)] * 40 + [("bad", "p", 0)] * 50 + [("tiny", "p", 0)] + [(None, "p", 1)]
    priors = quality.SitePriors(spark.createDataFrame(rows, "host string, path string, good int"))
    ask = spark.createDataFrame([("big", "p"), ("bad", "p"), ("tiny", "p"), ("new", "p"), (None, "p")], "host string, path string")
    got = {r.host: r.prior for r in priors.add_to(ask).collect()}
    assert got["bad"] < got["tiny"] < got["new"] == pytest.approx(priors.share)
    assert got["big"] > got["new"] and got[None] > got["new"]


# 9 SimHash

def brute_components(prints):
    at = {}
    for doc, f in prints:
        at.setdefault(f, []).append(doc)
    keys, root = list(at), {f: f for f in at}

    def top(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(keys):
        for b in keys[:i]:
            if (a ^ b).bit_count() <= 3:
                root[top(a)] = top(b)
    least = {}
    for f, docs in at.items():
        known = [d for d in docs if d is not None]
        if known:
            least[top(f)] = min([least.get(top(f), min(known)), *known])
    return Counter((d, least.get(top(f))) for f, docs in at.items() for d in docs)


@pytest.mark.parametrize("which", ["table", "odd"])
def test_simhash(spark, odd, which):
    docs = docs_of(spark) if which == "table" else odd
    got = simhash.near_duplicates(docs).collect()
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    prints = [(d, simhash.fingerprint((t or "").encode())) for d, t in texts]
    assert Counter((r.doc_id, r.fingerprint % (1 << 64)) for r in got) == Counter(prints)
    assert Counter((r.doc_id, r.component_id) for r in got) == brute_components(prints)


def test_simhash_links_and_spark_hash(spark):
    rng = random.Random(9)
    base = [rng.getrandbits(64) for _ in range(6)]
    prints = sorted({b ^ sum(1 << k for k in rng.sample(range(64), rng.randrange(6))) for b in base for _ in range(40)})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    table = spark.createDataFrame([(s,) for s in signed], "fingerprint bigint")
    want = {(min(a, b), max(a, b)) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) % (1 << 64)).bit_count() <= 3}
    for segments in (2, 3, 4):
        assert {(r.a, r.b) for r in simhash.links(table, 3, segments).collect()} == want
    one = spark.sql("select xxhash64('a bc é') as h").first().h % (1 << 64)
    assert simhash.fingerprint("A  bc\té".encode()) == one


def test_keep_one(spark, odd, empty):
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 3, 5, 6, 7, None])
    assert simhash.keep_one(empty).count() == 0


# 10 nearest neighbours

def test_nearest_recall(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=np.float64)
    got = {}
    for r in Q.op10_nearest(spark, SF).collect():
        got.setdefault(r.query_id, []).append(r)
    hits = 0
    for q in ids[ids % 20 == 0]:
        scores = x @ x[ids == q][0]
        scores[ids == q] = -np.inf
        best = ids[np.lexsort((ids, -scores))[:20]]
        of = sorted(got[q], key=lambda r: r.rank)
        assert [r.rank for r in of] == list(range(1, 21))
        assert [(-r.score, r.vec_id) for r in of] == sorted((-r.score, r.vec_id) for r in of)
        assert all(abs(r.score - scores[ids == r.vec_id][0]) < 1e-12 for r in of)
        hits += len({r.vec_id for r in of} & set(best.tolist()))
    assert hits / (20 * len(got)) >= 0.9


def test_nearest_recall_of_uneven_lengths_and_tight_groups(spark, tmp_dir):
    rng = np.random.default_rng(4)
    even = rng.standard_normal((1500, 24))
    even *= np.exp(rng.standard_normal(1500))[:, None] / np.linalg.norm(even, axis=1, keepdims=True)
    tight = rng.standard_normal((2, 24))[rng.integers(0, 2, 900)] + 0.003 * rng.standard_normal((900, 24))
    for x in (even, tight):
        x = x.astype(np.float32)
        folder = f"{tmp_dir}/{len(x)}"
        spark.createDataFrame(list(enumerate(x.tolist())), "vec_id bigint, embedding array<float>").write.parquet(
            f"{folder}/embeddings.parquet")
        got = {}
        for r in Q.op10_nearest(spark, folder).collect():
            got.setdefault(r.query_id, set()).add(r.vec_id)
        hits = 0
        for q in range(0, len(x), 20):
            scores = x.astype(float) @ x[q].astype(float)
            scores[q] = -np.inf
            hits += len(got[q] & set(np.argsort(-scores, kind="stable")[:20].tolist()))
        assert hits / (20 * len(got)) >= 0.9, (len(x), hits / (20 * len(got)))


def test_reports_of_a_batch_are_merged_by_node():
    rng = np.random.default_rng(1)
    for n in (0, 1, 500):
        nodes, ids = rng.integers(0, 9, n), rng.integers(0, 40, n)
        sims = (nodes * ids * 7 % 13 / 13).astype(np.float32)
        want = {}
        for node, sim, i in zip(nodes.tolist(), sims.tolist(), ids.tolist(), strict=True):
            want.setdefault(node, set()).add((sim, i))
        here, near = nndescent._best_of_each(nodes, sims, ids, 5)
        got = {a: [(x["sim"], x["id"]) for x in b] for a, b in zip(here.tolist(), near.to_pylist(), strict=True)}
        assert got == {a: sorted(b, reverse=True)[:5] for a, b in want.items()}


def test_nearest_odd_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(4).tolist()) for i in range(30)] + [(100 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(40)]
    rows += [(200, None), (201, [0.0] * 4), (202, [1.0, None, 0.0, 0.0]), (203, [float("nan"), 1.0, 1.0, 1.0]),
             (204, [float("inf"), 1.0, 1.0, 1.0]), (205, [1.0]), (None, [1.0, 1.0, 1.0, 1.0]), (0, rows[0][1])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    index = nndescent.Index(table)
    asked = table.filter("vec_id in (0, 100, 200, 201)").join(
        index.rows.distinct().select(F.col("id").alias("vec_id"), F.col("node").alias("start")), "vec_id", "left").select(
        F.col("vec_id").alias("query_id"), "embedding", "start").dropDuplicates(["query_id"])
    got = {}
    for r in index.search(asked, 20).orderBy("rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert set(got) == {0, 100}
    assert got[100] == list(range(101, 121))
    good = {i: np.array(v, dtype=np.float32).astype(float) for i, v in rows if i is not None and i < 200}
    want = sorted((-float(good[i] @ good[0]), i) for i in good if i)[:20]
    assert got[0] == [i for _, i in want]
    nothing = nndescent.Index(table.limit(0))
    assert nothing.search(asked.limit(0), 20).count() == 0


# pipeline

def test_pipeline(spark, whole):
    import corpus_pipeline
    docs = docs_of(spark)
    table = {r.doc_id: r.text for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    first = stages["language_id"](spark, docs, SF)
    # All documents are of its languages; what goes is junk that no text of that length and language looks like.
    assert first.columns == docs.columns and docs.count() - first.count() <= 0.01 * docs.count()
    second = stages["near_duplicates"](spark, first, SF)
    stayed = {r.doc_id for r in first.select("doc_id").collect()}
    prints = [(d, simhash.fingerprint((t or "").encode())) for d, t in table.items() if d in stayed]
    assert {r.doc_id for r in second.collect()} == {c for _, c in brute_components(prints)}
    third = stages["decontamination"](spark, second, SF)
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = {r.doc_id: r.text for r in third.collect()}
    assert all(not any(i in t for i in items) for t in left.values())
    assert all(any(i in table[r.doc_id] for i in items) for r in second.collect() if r.doc_id not in left)
    fourth = stages["secret_scan"](spark, third, SF)
    fixed = {r.doc_id: r.text for r in fourth.collect()}
    assert set(fixed) == set(left) and not any(base_spans(t) for t in fixed.values())
    assert fourth.columns == docs.columns
    check_packed(stages["packing"](spark, fourth, SF).collect(), fixed, whole[tokens.BYTE_BPE])


def test_registered(spark):
    from __spark_entry__ import oracle_sql, queries
    assert set(Q.QUERIES) | {"pipeline"} <= set(queries()) and set(Q.ORACLE) <= set(oracle_sql())
    assert json.dumps(sorted(Q.QUERIES))
