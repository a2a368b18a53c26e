"""The quality model against a plain recomputation of its formulas from the same bins, and sparse sites on held-out rows."""

import math
import random
from collections import defaultdict

import pytest

from flowscore.llm import quality

SHARES = {"good.org": 0.95, "bad.net": 0.05}


def planted(spark, n=1500):
    """Rows of sites whose share of good labels differs; the text alone says little.  Every tenth site is sparse."""
    rng = random.Random(8)
    rows = []
    for i in range(n):
        host = rng.choice(list(SHARES))
        path = f"{host}/{rng.randrange(150)}"
        good = int(rng.random() < SHARES[host])
        text = " ".join(rng.choice(["alpha", "beta,", "Gamma", "delta.", "7"]) for _ in range(rng.randint(3, 30) + 3 * good))
        rows.append((i, host, path, text, good, i % 4 == 2))
    table = spark.createDataFrame(rows, "doc_id int, host string, path string, text string, good int, held_out boolean")
    return quality.with_features(table)


def by_hand(learned, asked):
    """Posterior of a good label by the definition: damped log-odds of bins, moments of the spread, two levels."""
    edges = list(quality.BINS.values())
    counts = [[[0, 0] for _ in range(len(e) + 1)] for e in edges]
    for r in learned:
        for f, b in enumerate(r.bins):
            counts[f][b][1 - r.good] += 1
    odds = []
    for of in counts:
        total = [sum(c[k] for c in of) + 0.5 * len(of) for k in (0, 1)]
        odds.append([max(-4.0, min(4.0, math.log((c[0] + 0.5) / total[0] / ((c[1] + 0.5) / total[1])))) if sum(c) else 0.0
                     for c in of])
    share = (sum(r.good for r in learned) + 0.5) / (len(learned) + 1.0)

    def strength(groups):
        total = sum(n for n, _, _ in groups)
        noise = sum(n * t * (1 - t) for n, _, t in groups)
        spread = sum(n * (g / n - t) ** 2 for n, g, t in groups)
        between, within = (spread - noise * len(groups) / total) / total, noise / total
        return 1e6 if between <= within * 1e-6 else max(within / between - 1, 1.0)

    hosts, paths = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
    for r in learned:
        for table, key in ((hosts, r.host), (paths, (r.host, r.path))):
            table[key][0] += 1
            table[key][1] += r.good
    k = strength([(n, g, share) for n, g in hosts.values()])
    host_prior = {h: (g + k * share) / (n + k) for h, (n, g) in hosts.items()}
    k = strength([(n, g, host_prior[h]) for (h, _), (n, g) in paths.items()])
    path_prior = {p: (g + k * host_prior[p[0]]) / (n + k) for p, (n, g) in paths.items()}
    out = {}
    for r in asked:
        prior = path_prior.get((r.host, r.path), host_prior.get(r.host, share))
        evidence = 0.7 * sum(odds[f][b] for f, b in enumerate(r.bins))
        out[r.doc_id] = (prior, 1 / (1 + math.exp(-math.log(prior / (1 - prior)) - evidence)))
    return out


def test_posteriors_by_definition_and_sparse_sites_gain(spark):
    rows = planted(spark).cache()
    got = {r.doc_id: r for r in quality.classify(
        rows, rows.filter("not held_out").select("host", "path", "bins", "good")).collect()}
    table = rows.collect()
    learned, asked = [r for r in table if not r.held_out], table
    want = by_hand(learned, asked)
    assert got.keys() == want.keys()
    for doc, (prior, posterior) in want.items():
        assert got[doc].prior == pytest.approx(prior, abs=1e-9)
        assert got[doc].quality == pytest.approx(posterior, abs=1e-9)
    # Held-out rows of sites with at most three labels: the priors of the levels above decide better than the text alone.
    labels = defaultdict(int)
    for r in learned:
        labels[(r.host, r.path)] += 1
    sparse = [r for r in table if r.held_out and labels[(r.host, r.path)] <= 3]
    right = lambda choose: sum(choose(got[r.doc_id]) == bool(r.good) for r in sparse) / len(sparse)
    assert len(sparse) > 50
    assert right(lambda g: g.keep) > 0.9 > right(lambda g: g.evidence >= 0)
    rows.unpersist()
