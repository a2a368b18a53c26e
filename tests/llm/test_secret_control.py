"""The battery's p-values and thresholds against a plain recomputation, and false discoveries on planted runs."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from flowscore.llm import secrets

LETTERS = secrets.ALPHABETS["base62"]


def identifier(rng):
    """Joined words of invented syllables, some with a number: none of them is a fixed word of the null."""
    words = ["".join(rng.choice("bcdfglmnprstv") + rng.choice("aeiou") + rng.choice(["", "n", "r", "s", "t"])
                     for _ in range(rng.randint(2, 3))) for _ in range(rng.randint(4, 6))]
    words = [w.capitalize() for w in words]
    if rng.random() < 0.3:
        words[rng.randrange(len(words))] += str(rng.randrange(100))
    return words[0].lower() + "".join(words[1:])


def deviate_tail(z):
    x = abs(z) / 2 ** 0.5
    return min(max(math.erfc(x), 1e-12), 1.0)


def log_p(value):
    """-log of the joint p-value of one run, from the definition of the tests."""
    name = next(n for n, p in secrets.PATTERNS.items() if re.match(p, value))
    alphabet, value = secrets.ALPHABETS[name], value.rstrip("=")
    x, n = [alphabet.index(c) for c in value], len(value)
    sets = [*secrets.CLASSES, "".join(c for c in alphabet if not any(c in k for k in secrets.CLASSES))]
    shares = [sum(c in k for c in alphabet) / len(alphabet) for k in sets]
    chi = sum((sum(c in k for c in value) - n * w) ** 2 / (n * w) for k, w in zip(sets, shares) if w)
    free = sum(w > 0 for w in shares) - 1
    z = ((chi / free) ** (1 / 3) - (1 - 2 / (9 * free))) / (2 / (9 * free)) ** 0.5
    p_chi = deviate_tail(z) / 2 if z > 0 else 1 - deviate_tail(z) / 2
    above = [2 * v >= len(alphabet) for v in x]
    n1, runs = sum(above), 1 + sum(a != b for a, b in zip(above, above[1:]))
    mean = 2 * n1 * (n - n1) / n + 1
    variance = (mean - 1) * (mean - 2) / (n - 1)
    p_runs = deviate_tail((runs - mean) / variance ** 0.5) if 0 < n1 < n and variance > 0 else 1e-12
    middle = sum(x) / n
    var = sum((v - middle) ** 2 for v in x)
    cov = sum((a - middle) * (b - middle) for a, b in zip(x, x[1:]))
    p_serial = deviate_tail((cov / var + 1 / n) * n ** 0.5) if var > 0 else 1e-12
    half = -math.log(p_chi) - math.log(p_runs) - math.log(p_serial)
    return half - math.log(1 + half + half * half / 2)


def test_p_values_by_definition(spark):
    rng = random.Random(3)
    alphabets = [a for n, a in secrets.ALPHABETS.items() if n not in secrets.NEVER]
    values = [identifier(rng) for _ in range(40)] + ["A" * 30 + "1", "ab" * 20 + "3"]
    values += ["".join(rng.choices(a, k=rng.randint(20, 80))) for a in alphabets for _ in range(10)]
    got = spark.createDataFrame([(v,) for v in values], "value string").select("value", F.explode(secrets.battery(F.array(
        F.struct(F.lit(0).alias("start"), F.length("value").alias("end"), "value")))).alias("c")).select("value", "c.*").collect()
    tested = [v for v in values if next((n for n, p in secrets.PATTERNS.items() if re.match(p, v)), None)
              not in [None, *secrets.NEVER]]
    assert sorted(r.value for r in got) == sorted(tested)
    for r in got:
        want = min(log_p(r.value), -math.log(1e-12)) * 20
        # The normal tail is approximated to 1.5e-7, which shows where p is far below any threshold.
        assert abs(r.bin - want) <= 1.01 + 0.02 * max(want - 200, 0), r
        assert r.band == sum(len(r.value) >= b for b in secrets.LENGTH_BANDS)


def test_thresholds_by_definition(spark):
    rng = random.Random(4)
    table = lambda bins: spark.createDataFrame([([("base62", 0, b)],) for b in bins],
                                               "candidates array<struct<encoding:string,band:int,bin:int>>")
    seen = [rng.randrange(0, 40) for _ in range(60)] + [rng.randrange(60, 400) for _ in range(90)]
    plain = [rng.randrange(30, 500) for _ in range(700)]
    p = sorted((1 + sum(c <= b for c in plain)) / (1 + len(plain)) for b in seen)
    passed = max(k for k, x in enumerate(p, 1) if x <= 0.05 * k / len(seen))
    greatest = secrets.thresholds(table(seen), table(plain))[("base62", 0)]
    assert sum(b <= greatest for b in seen) == passed
    assert secrets.thresholds(table(seen), table([]))[("base62", 0)] == -1


@pytest.mark.parametrize("keys,names", [(200, 2000), (200, 200), (0, 2000)])
def test_false_discoveries_are_bounded(spark, keys, names):
    rng = random.Random(keys + names)
    rows = [(i, "see " + "".join(rng.choices(LETTERS, k=rng.randint(32, 44))) + " here") for i in range(keys)]
    rows += [(10_000 + i, "call " + identifier(rng) + " there") for i in range(names)]
    got = secrets.find(spark.createDataFrame(rows, "doc_id int, text string")).filter("spans <> ''").collect()
    found, false = sum(r.doc_id < 10_000 for r in got), sum(r.doc_id >= 10_000 for r in got)
    print("keys", keys, "identifiers", names, "found", found, "false", false)
    assert found >= 0.9 * keys
    assert false <= 0.05 * len(got) + 3 * (0.05 * len(got)) ** 0.5 + (2 if not keys else 0)


def test_rest_of_a_key_that_holds_a_base_span(spark):
    rng = random.Random(6)
    first, last = ["".join(rng.choices(LETTERS, k=25)) for _ in range(2)]
    key = first + "Z" + "0a1b2c3d4e5f60718293a4b5c6" + "Z" + last
    docs = spark.createDataFrame([(1, f"key {key} end")], "doc_id int, text string")
    assert [r.text.replace("[SECRET]", "#") for r in secrets.redact(docs).collect()] in (["key ### end"], ["key # end"])
