"""Secret scan with DataFrame functions only: fixed patterns, and a battery of randomness tests.

A candidate is a long run of key characters.  Its encoding (the smallest alphabet that holds all its characters) turns
it into numbers, which three tests compare with independent uniform draws: chi-squared over classes of the
alphabet, the number of runs above and below its middle, and the serial correlation of neighbours.  Fisher's method
joins them into a measure of how random a run looks.

Whether that is more than an ordinary run shows is judged against ordinary runs: words of the corpus (those that occur
at least twice) and a few fixed ones are joined as identifiers and paths are, and go through the same battery.  The
p-value of a candidate is the share of the ordinary runs of its encoding and length band that look at least as random.
Within each encoding and length band the Benjamini-Hochberg rule then bounds the share of ordinary runs among those
reported, whatever their number and however little power short strings have.

Positions are code points, ends are exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowscore.llm.scratch import keep

# The base patterns, by kind in order of rank.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
KINDS = ["assign", "access", "hex", "random"]
LEAST = {"assign": 6, "access": 20, "hex": 24}

LEAST_RANDOM = 20
CANDIDATE = f"[A-Za-z0-9+/=_-]{{{LEAST_RANDOM},}}"
#: Parts of a run that fits no alphabet: what stands between '=', then what stands between signs of one alphabet or both.
#: Shorter ones, the '=' that may follow counted, are no candidates.
_LONG = f"{{{LEAST_RANDOM - 2},}}"
BETWEEN_EQUALS = [f"[A-Za-z0-9+/_-]{_LONG}(?:={{1,2}}$)?"]
BETWEEN_SIGNS = [f"[A-Za-z0-9_-]{_LONG}(?:={{1,2}}$)?", f"[A-Za-z0-9+/]{_LONG}(?:={{1,2}}$)?", f"[A-Za-z0-9]{_LONG}"]
LENGTH_BANDS = [32, 64]
#: Share of ordinary runs tolerated among those reported.
FALSE_DISCOVERY = 0.05
# Letters frequent in prose, and words of which ordinary runs are made beside those of the corpus.
FREQUENT = "etaoinsrhldu"
WORDS = """
about access account action active address after alert array average backup balance bank before between block body
buffer button cache call center change channel check child class client close cluster code color column command
comment common config connect content context copy count create current customer data date debug default delete depth
detail device display document domain download driver element email enable entry error event example export factory
field file filter final first folder format frame function general global graph group handler header height history
image import index inner input instance internal item kernel label language last layer layout length level limit line
"""
HEX_WORDS = "add bad bed bee beef cab cafe dad dead deaf decade deed facade face fade feed"
WORD = "^[A-Za-z][a-z]{2,11}$"
#: Words of an ordinary run, one length for each band, and words dealt together.
RUN_WORDS, GROUP_WORDS = [4, 7, 13], 12
GROUPS_A_TASK = 200
# Alphabets by inferred encoding, smallest first; the place of a character is its number.
ALPHABETS = {
    "decimal": "0123456789",
    "word": "abcdefghijklmnopqrstuvwxyz",
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "BASE36": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base62": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
PATTERNS = {
    "decimal": "^[0-9]+$", "word": "^([A-Z]?[a-z]+|[A-Z]+)$", "hex": "^[0-9a-f]+$", "HEX": "^[0-9A-F]+$", "base32": "^[A-Z2-7]+$",
    "base36": "^[0-9a-z]+$", "BASE36": "^[0-9A-Z]+$", "base62": "^[A-Za-z0-9]+$", "base64": "^[A-Za-z0-9+/]+={0,2}$",
    "base64url": "^[A-Za-z0-9_-]+={0,2}$",
}
#: Numbers alone are identifiers and letters of one case are words: of 20 drawn from 36, all are letters once in 670.
NEVER = ["decimal", "word"]
#: Classes of characters compared by chi-squared; all other characters are the last class.
CLASSES = [FREQUENT, "".join(c for c in ALPHABETS["word"] if c not in FREQUENT)]
CLASSES += [c.upper() for c in CLASSES]
_P_STEPS = 20.0  # p-values are binned by this many steps of their negative logarithm
_P_LEAST = 1e-12


def _found(text: Column, pattern: str, group: int) -> Column:
    """Matches of a pattern from left to right as (start, end, value of the group)."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    rows = F.zip_with(F.arrays_zip(whole.alias("whole"), value.alias("value")), F.split(text, pattern, -1), lambda m, gap: F.struct(
        m["value"].alias("value"), F.length(m["whole"]).alias("size"),
        (F.length(gap) + F.length(m["whole"])).alias("step")))
    # The piece after the last match has no match beside it.
    return _with(F.filter(rows, lambda r: r["size"].isNotNull()), lambda rows: F.zip_with(
        rows, _running(F.transform(rows, lambda r: r["step"]), lambda a, b: a + b), lambda r, end: F.struct(
            (end - r["size"]).alias("start"), end.alias("end"), r["value"].alias("value"))))


def _parts_of(run: Column, pattern: str) -> Column:
    """Matches of a pattern in one run as (start, end, value), by a plain fold: at most one match in 18 characters."""
    found = F.regexp_extract_all(run["value"], F.lit(pattern), F.lit(0))
    rows = F.arrays_zip(found.alias("value"), F.slice(F.split(run["value"], pattern, -1), 1, F.size(found)).alias("gap"))
    empty = F.expr("cast(array() as array<struct<start:int,end:int,value:string>>)")

    def step(state, row):
        start = state["at"] + F.length(row["gap"])
        end = start + F.length(row["value"])
        return F.struct(end.alias("at"), F.array_append(state["out"], F.struct(
            start.alias("start"), end.alias("end"), row["value"].alias("value"))).alias("out"))

    return F.aggregate(rows, F.struct(run["start"].alias("at"), empty.alias("out")), step, lambda s: s["out"])


def _with(value: Column, f) -> Column:
    """f of a value that is computed once, also where f uses it in a lambda."""
    return F.element_at(F.transform(F.array(value), f), 1)


def _running(values: Column, f) -> Column:
    """Running totals of an array of int by ``f``.

    Appending copies an array, so totals are taken in blocks of the root of its size: n^1.5 steps, not n^2."""
    empty = F.expr("cast(array() as array<int>)")
    state = lambda last, out: F.struct(last.alias("last"), out.alias("out"))
    total = lambda last, v: F.when(last.isNull(), v).otherwise(f(last, v))

    def block(begun, part):
        return F.aggregate(part, state(begun, empty), lambda s, v: _with(total(s["last"], v), lambda t: state(
            t, F.array_append(s["out"], t))), lambda s: s["out"])

    def blocks(v):
        parts = F.transform(F.sequence(F.lit(1), v["n"], v["size"]), lambda i: F.slice(v["values"], i, v["size"]))
        return F.flatten(F.aggregate(
            parts, state(F.lit(None).cast("int"), F.expr("cast(array() as array<array<int>>)")),
            lambda s, part: _with(block(s["last"], part), lambda done: state(
                F.element_at(done, -1), F.array_append(s["out"], done))), lambda s: s["out"]))

    return _with(values, lambda a: F.when(F.size(a) > 0, _with(F.struct(
        a.alias("values"), F.size(a).alias("n"), F.ceil(F.sqrt(F.size(a))).cast("int").alias("size")), blocks)).otherwise(empty))


def _matches(text: Column, kind: str) -> Column:
    """Base spans of one kind; a cheap necessary condition spares most texts the search."""
    pattern, group, may = {
        "assign": (ASSIGN, 2, text.contains("=") | text.contains(":")),
        "access": (ACCESS, 0, text.contains("AKIA")),
        "hex": (f"[0-9a-f]{{{LEAST['hex']},}}", 0, text.rlike(f"[0-9a-f]{{{LEAST['hex']}}}")),
    }[kind]
    none = F.expr("cast(array() as array<struct<start:int,end:int,value:string>>)")
    return F.filter(F.when(may, _found(text, pattern, group)).otherwise(none),
                    lambda m: F.length(m["value"]) >= LEAST[kind])


def _tail(z: Column) -> Column:
    """Two-sided p-value of a normal deviate (Abramowitz and Stegun 7.1.26)."""
    x = F.abs(z) / 2 ** 0.5
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return F.least(F.greatest(poly * F.exp(-x * x), F.lit(_P_LEAST)), F.lit(1.0))


def class_weights(alphabet: str) -> list[float]:
    """Shares of the classes of characters in an alphabet."""
    shares = [sum(c in letters for c in alphabet) / len(alphabet) for letters in CLASSES]
    return [*shares, sum(all(c not in letters for letters in CLASSES) for c in alphabet) / len(alphabet)]


def encoding(value: Column) -> Column:
    out = F.lit(None).cast("string")
    for name in reversed(list(PATTERNS)):
        out = F.when(value.rlike(PATTERNS[name]), F.lit(name)).otherwise(out)
    return out


def _add(rows: Column, name: str, f) -> Column:
    return F.transform(rows, lambda r: r.withField(name, f(r)))


def _parted(runs: Column, patterns: list[str]) -> Column:
    """Runs (start, end, value) that fit an alphabet; of the others, all different matches that are long enough."""

    def parts(run, pattern):
        return F.filter(_parts_of(run, pattern), lambda m: F.length(m["value"]) >= LEAST_RANDOM)

    return F.flatten(F.transform(runs, lambda r: F.when(encoding(r["value"]).isNotNull(), F.array(r)).otherwise(
        F.array_distinct(F.concat(*[parts(r, p) for p in patterns])))))


def battery(candidates: Column) -> Column:
    """Candidates (start, end, value) with their encoding and the joint p-value of the three tests.

    A run that fits no alphabet as a whole (NAME=key, a path that ends in a key) is tested in parts."""
    rows = _parted(_parted(candidates, BETWEEN_EQUALS), BETWEEN_SIGNS)
    rows = _add(rows, "encoding", lambda r: encoding(r["value"]))
    rows = F.filter(rows, _testable)
    for name, f in _tests():
        rows = _add(rows, name, f)
    return F.transform(rows, lambda r: F.struct(
        r["start"].alias("start"), r["end"].alias("end"), r["encoding"].alias("encoding"),
        _band(r["end"] - r["start"]).alias("band"), _bin(r).alias("bin")))


class _Columns:
    """The columns of a row by name, as the fields of a struct are."""

    def __getitem__(self, name: str) -> Column:
        return F.col(name)


def battery_rows(values: DataFrame) -> DataFrame:
    """The same for runs that fit an alphabet, one a row (column ``value``): their encoding, length band and bin.

    Plain columns, so a step copies no arrays; this is the way for a large number of runs."""
    rows = values.select("value", encoding(F.col("value")).alias("encoding")).filter(_testable(_Columns()))
    for name, f in _tests():
        rows = rows.withColumn(name, f(_Columns()))
    return rows.select("encoding", _band(F.length("value")).alias("band"), _bin(_Columns()).alias("bin"))


def _testable(r) -> Column:
    return r["encoding"].isNotNull() & ~r["encoding"].isin(NEVER)


def _band(length: Column) -> Column:
    return sum(((length >= b).cast("int") for b in LENGTH_BANDS[1:]), (length >= LENGTH_BANDS[0]).cast("int"))


def _bin(r) -> Column:
    """Fisher's joint p-value of the three tests by steps of its negative logarithm."""
    p = F.exp(-r["half"]) * (1 + r["half"] + r["half"] * r["half"] / 2)
    return F.floor(-F.log(F.greatest(p, F.lit(_P_LEAST))) * _P_STEPS).cast("int")


def _tests() -> list:
    """Steps of the battery, each a name and a function of the fields before it (value, encoding first)."""
    spelled = F.create_map(*[F.lit(x) for pair in ALPHABETS.items() for x in pair])
    weights = F.create_map(*[x for name, a in ALPHABETS.items()
                             for x in (F.lit(name), F.array(*[F.lit(w) for w in class_weights(a)]))])
    steps = []
    add = lambda name, f: steps.append((name, f))
    add("alphabet", lambda r: spelled[r["encoding"]])
    # What all characters are compared with is repeated beside them: in a lambda the optimizer may compute it for each.
    beside = lambda values, one, f: F.zip_with(values, F.array_repeat(one, F.size(values)), f)
    add("chars", lambda r: F.filter(F.split(F.rtrim(r["value"], F.lit("=")), "(?!^)"), lambda c: c != ""))
    add("x", lambda r: beside(r["chars"], r["alphabet"], lambda c, a: F.position(c, a) - 1))
    add("n", lambda r: F.size(r["x"]).cast("double"))
    add("size", lambda r: F.length(r["alphabet"]).cast("double"))
    add("weights", lambda r: weights[r["encoding"]])
    add("classes", lambda r: F.array(*[
        r["n"] - F.length(F.translate(F.rtrim(r["value"], F.lit("=")), c, "")) for c in CLASSES]))
    add("classes", lambda r: F.concat(r["classes"], F.array(
        r["n"] - F.aggregate(r["classes"], F.lit(0.0), lambda a, c: a + c))))
    add("chi", lambda r: F.aggregate(F.zip_with(r["classes"], r["weights"], lambda c, w: F.when(
        w > 0, F.pow(c - r["n"] * w, 2) / (r["n"] * w)).otherwise(F.lit(0.0))), F.lit(0.0), lambda a, v: a + v))
    add("free", lambda r: F.size(F.filter(r["weights"], lambda w: w > 0)) - 1)
    # Chi-squared as a one-sided normal deviate (Wilson and Hilferty).
    add("p_chi", lambda r: _one_sided((F.pow(r["chi"] / r["free"], 1 / 3) - (1 - 2 / (9 * r["free"])))
                                      / F.sqrt(2 / (9 * r["free"]))))
    add("above", lambda r: beside(r["x"], r["size"], lambda v, size: (v * 2 >= size).cast("int")))
    add("n1", lambda r: F.aggregate(r["above"], F.lit(0), lambda a, v: a + v).cast("double"))
    add("changes", lambda r: F.aggregate(
        F.zip_with(F.slice(r["above"], 1, F.size(r["above"]) - 1), F.slice(r["above"], 2, F.size(r["above"])),
                   lambda a, b: F.abs(a - b)), F.lit(0), lambda a, v: a + v).cast("double"))
    add("p_runs", lambda r: _runs(r["n"], r["n1"], r["changes"] + 1))
    add("mean", lambda r: F.aggregate(r["x"], F.lit(0.0), lambda a, v: a + v) / r["n"])
    add("d", lambda r: beside(r["x"], r["mean"], lambda v, mean: v - mean))
    add("var", lambda r: F.aggregate(r["d"], F.lit(0.0), lambda a, v: a + v * v))
    add("cov", lambda r: F.aggregate(
        F.zip_with(F.slice(r["d"], 1, F.size(r["d"]) - 1), F.slice(r["d"], 2, F.size(r["d"])), lambda a, b: a * b),
        F.lit(0.0), lambda a, v: a + v))
    add("p_serial", lambda r: F.when(r["var"] > 0, _tail(
        (r["cov"] / r["var"] + 1 / r["n"]) * F.sqrt(r["n"]))).otherwise(F.lit(_P_LEAST)))
    add("half", lambda r: -F.log(r["p_chi"]) - F.log(r["p_runs"]) - F.log(r["p_serial"]))
    return steps


def _one_sided(z: Column) -> Column:
    return F.when(z > 0, _tail(z) / 2).otherwise(1 - _tail(z) / 2)


def _runs(n: Column, n1: Column, runs: Column) -> Column:
    n2 = n - n1
    mean = 2 * n1 * n2 / n + 1
    variance = (mean - 1) * (mean - 2) / (n - 1)
    return F.when((n1 > 0) & (n2 > 0) & (variance > 0), _tail((runs - mean) / F.sqrt(variance))).otherwise(
        F.lit(_P_LEAST))


def scan(docs: DataFrame, text_col: str, *columns: Column) -> DataFrame:
    """``columns`` of the documents, their base spans by kind and their tested candidates (null text: empty)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    none = F.expr("cast(array() as array<struct<start:int,end:int,value:string>>)")
    runs = F.when(text.rlike(CANDIDATE), _found(text, CANDIDATE, 0)).otherwise(none)
    return docs.select(*columns, *[_matches(text, kind).alias(kind) for kind in KINDS[:3]], runs.alias("candidates")).withColumn(
        "candidates", battery(F.col("candidates")))


def ordinary(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Ordinary runs with their encoding, length band and bin, in column ``candidates``.

    Words that occur at least twice in the corpus are dealt to groups by a hash; in every length and style the words of a
    group are joined to runs one after another, so that each is in a run.  Each of the fixed words begins a run of every
    length and style, which goes on with the words after it: a small corpus has ordinary runs enough, too."""
    spark = docs.sparkSession
    listed = lambda words: spark.range(1).select(
        F.explode(F.split(F.lit(" ".join(words.split())), " ")).alias("word")).agg(F.collect_list("word").alias("words"))
    words = keep(docs.select(F.explode(F.split(F.col(text_col).cast("string"), r"[\s\p{Punct}]+")).alias("word")).filter(
        F.col("word").rlike(WORD)).groupBy(F.lower("word").alias("word")).count().filter("count > 1").select("word"), "secrets")
    groups = max(words.count() // GROUP_WORDS, 1)
    # A number of partitions of its own: words are few bytes but much work, and would be merged into one task by size.
    dealt = words.withColumn("g", F.pmod(F.xxhash64("word"), F.lit(groups))).repartition(groups // GROUPS_A_TASK + 1, "g")
    grouped = dealt.groupBy("g").agg(F.sort_array(F.collect_list("word")).alias("words"))
    runs = _runs_of(grouped, _styles()).union(_runs_of(listed(WORDS), _styles(), every=True)).union(
        _runs_of(listed(HEX_WORDS), _hex_styles(), every=True))
    return battery_rows(runs.filter(F.length("value") >= LEAST_RANDOM)).select(
        F.array(F.struct("encoding", "band", "bin")).alias("candidates"))


def _runs_of(groups: DataFrame, styles: list, every: bool = False) -> DataFrame:
    """Runs of words made from each group, in all styles, as ``value``: one after another, or beginning at every word."""
    ring = F.flatten(F.array_repeat("words", max(RUN_WORDS) + 1))
    runs_of = lambda n: F.transform(
        F.sequence(F.lit(1), F.size("words"), F.lit(1 if every else n)), lambda i: F.slice("ring", i, n))
    begun = F.concat(*[runs_of(n) for n in RUN_WORDS])
    runs = groups.filter(F.size("words") > 0).withColumn("ring", ring).select(F.explode_outer(begun).alias("run"))
    return runs.select(F.explode_outer(F.array(*[style(F.col("run")) for style in styles])).alias("value"))


def _number(word: Column, salt: int = 0) -> Column:
    return F.pmod(F.hash(word, F.lit(salt)), F.lit(100)).cast("string")


def _styles() -> list:
    """Ways to join words: camel case, the same with numbers, with signs, paths, one case with numbers."""
    every_other = lambda w, i: F.concat(w, F.when(i % 2 == 1, _number(w)).otherwise(F.lit("")))
    join = lambda run, f, between="": F.array_join(F.transform(run, f), between)
    return [
        lambda run: join(run, lambda w, i: F.when(i > 0, F.initcap(w)).otherwise(w)),
        lambda run: join(run, lambda w, i: every_other(F.initcap(w), i)),
        lambda run: join(run, lambda w, i: w, "_"),
        lambda run: join(run, lambda w, i: every_other(F.initcap(w), i), "-"),
        lambda run: join(run, lambda w, i: every_other(w, i), "/"),
        lambda run: join(run, lambda w, i: F.initcap(w), "/"),
        lambda run: join(run, lambda w, i: every_other(w, i)),
        lambda run: join(run, lambda w, i: F.upper(every_other(w, i))),
        # Numbers of the digits that base 32 has.
        lambda run: F.upper(F.translate(join(run, lambda w, i: every_other(w, i)), "0189", "2345")),
    ]


def _hex_styles() -> list:
    """Words of a to f with numbers, in either case."""
    join = lambda run, salt: F.array_join(F.transform(run, lambda w: F.concat(w, _number(w, salt))), "")
    styles = [lambda run, salt=salt: join(run, salt) for salt in range(8)]
    return styles + [lambda run, salt=salt: F.upper(join(run, salt)) for salt in range(8)]


def thresholds(tested: DataFrame, plain: DataFrame, level: float = FALSE_DISCOVERY) -> dict[tuple[str, int], int]:
    """Benjamini-Hochberg over (encoding, band) groups of ``candidates``: the greatest bin of -log p that is reported.

    A candidate's p-value is the share of ``plain`` runs of its group whose bin is no greater, itself counted with
    them; a group without plain runs reports nothing.  The groups are histograms (at most 10 encodings x 3 bands x 553
    bins), whatever the number of candidates."""
    seen, null = _histograms(tested), _histograms(plain)
    out = {}
    for key, bins in seen.items():
        total, rank, greatest = sum(bins.values()), 0, -1
        usual = null.get(key, {})
        runs = sum(usual.values())
        for b in sorted(bins):
            rank += bins[b]
            p = (1 + sum(n for c, n in usual.items() if c <= b)) / (1 + runs)
            if p <= level * rank / total:
                greatest = b
        out[key] = greatest
    return out


def _histograms(tested: DataFrame) -> dict[tuple[str, int], dict[int, int]]:
    # An outer explode: before a plain one the optimizer filters by the array's size, which runs the battery again.
    rows = tested.select(F.explode_outer("candidates").alias("c")).filter("c is not null").groupBy(
        "c.encoding", "c.band", "c.bin").count().collect()
    out: dict[tuple[str, int], dict[int, int]] = {}
    for r in rows:
        out.setdefault((r.encoding, r.band), {})[r.bin] = r["count"]
    return out


def spans(scanned: DataFrame, greatest: dict[tuple[str, int], int]) -> Column:
    """All spans of a row, in order: (start, rank of the kind, end).

    Of a reported candidate that meets base spans what they leave of it is a span."""
    limit = F.create_map(*[x for (name, band), b in sorted(greatest.items())
                           for x in (F.lit(f"{name}:{band}"), F.lit(b))]) if greatest else None
    base = F.concat(*[_ranked(F.col(kind), i) for i, kind in enumerate(KINDS[:3])])
    if limit is None:
        return F.array_sort(base)
    kept = F.filter("candidates", lambda c: c["bin"] <= limit[F.concat_ws(":", c["encoding"], c["band"])])
    left = F.when(F.size(kept) > 0, _with(_joined(base), lambda taken: F.flatten(F.transform(
        _joined(kept), lambda c: _without(c, F.filter(
            taken, lambda s: (s["start"] < c["end"]) & (c["start"] < s["end"])))))))
    left = F.coalesce(left, F.expr("cast(array() as array<struct<start:int,end:int>>)"))
    return F.array_sort(F.concat(base, _ranked(left, 3)))


def _without(span: Column, taken: Column) -> Column:
    """Parts of a span outside the spans ``taken``, which are in order and don't overlap."""
    starts = F.concat(F.array(span["start"]), F.transform(taken, lambda s: s["end"]))
    ends = F.concat(F.transform(taken, lambda s: s["start"]), F.array(span["end"]))
    return F.filter(F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("start"), b.alias("end"))),
                    lambda s: s["start"] < s["end"])


def _joined(found: Column) -> Column:
    """Spans with those that overlap made one: parts of a run may."""
    rows = F.array_sort(F.transform(found, lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"))))

    def join(v):
        # Places whose span begins where or after all before it have ended, and one place after the last.
        first = F.filter(F.sequence(F.lit(1), F.size(v["rows"])), lambda i: (i == 1) | (
            F.element_at(v["rows"], i)["start"] >= F.element_at(v["ends"], F.greatest(i - 1, F.lit(1)))))
        return _with(F.concat(first, F.array(F.size(v["rows"]) + 1)), lambda at: F.zip_with(
            F.slice(at, 1, F.size(at) - 1), F.slice(at, 2, F.size(at) - 1), lambda a, b: F.struct(
                F.element_at(v["rows"], a)["start"].alias("start"), F.element_at(v["ends"], b - 1).alias("end"))))

    return _with(rows, lambda r: F.when(F.size(r) > 0, _with(F.struct(r.alias("rows"), _running(
        F.transform(r, lambda s: s["end"]), F.greatest).alias("ends")), join)).otherwise(
        F.expr("cast(array() as array<struct<start:int,end:int>>)")))


def _ranked(found: Column, rank: int) -> Column:
    return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"),
                                                 m["end"].alias("end")))


def _written(found: Column) -> Column:
    kind = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", F.element_at(kind, s["rank"] + 1), s["start"], s["end"])), ",")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         level: float = FALSE_DISCOVERY) -> DataFrame:
    """One row per document: id, n_assign, n_access, n_hex, base_sha256, spans (as text), found (as array).

    The battery only adds spans (kind ``random``), beside the base spans.  Null and empty texts have none, and the
    hash of the empty string; null ids and repeated rows stay rows; other columns are not read."""
    tested = keep(scan(docs, text_col, F.col(id_col).alias("id")).withColumns(
        {k: F.transform(k, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"))) for k in KINDS[:3]}),
        "secrets")
    found = tested.withColumn("found", spans(tested, thresholds(tested, ordinary(docs, text_col), level)))
    base = F.filter("found", lambda s: s["rank"] < 3)
    return found.select(
        F.col("id").alias(id_col), *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(_written(base), 256).alias("base_sha256"), _written(F.col("found")).alias("spans"), "found")


def redact(docs: DataFrame, text_col: str = "text", level: float = FALSE_DISCOVERY,
           mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span replaced by ``mark`` (overlapping spans by one); a null text stays null.

    Thresholds come from all rows; the second pass finds the spans again, so no text is shuffled."""
    greatest = thresholds(scan(docs, text_col).select("candidates"), ordinary(docs, text_col), level)
    # The documents' own columns are kept in a struct, so theirs may have any names.
    scanned = scan(docs, text_col, F.struct(*docs.columns).alias("__row"))
    found = scanned.withColumn("__found", spans(scanned, greatest))
    text = F.col("__row")[text_col]

    def step(state, s):
        start = F.greatest(s["start"], state["at"])
        piece = F.concat(state["out"], F.substring(text, state["at"] + 1, start - state["at"]),
                         F.when(s["start"] >= state["at"], F.lit(mark)).otherwise(F.lit("")))
        return F.struct(F.greatest(s["end"], state["at"]).alias("at"), piece.alias("out"))

    cut = F.aggregate("__found", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda s: F.concat(
        s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    fixed = F.when(F.size("__found") > 0, cut).otherwise(text)
    return found.withColumn("__row", F.col("__row").withField(f"`{text_col}`", fixed)).select("__row.*")
