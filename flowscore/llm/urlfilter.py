"""URL rules by a sort-merge range join, with DataFrame functions only.

A rule (host, path) fits its host and all subdomains where the URL's path starts with the rule's.  The canonical key of
a rule is its host's labels reversed, a gap, and its path; a URL has one key for each of its host's suffixes that
could be a rule's host.  The URLs a rule fits are then those with a key in the interval of keys that begin with the
rule's key.  Such intervals are nested or apart.  Rule ends and URL keys are sorted together and dealt to ranges; a range
begins with the rules that are open at its first key.  The sweep over a range keeps a stack of open rules as two running
columns: its height, and for each height the last rule opened at it, which is the innermost open one.  So neither rules
nor keys are held in one row or task.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowscore.llm.scratch import keep

DEFAULT_VERDICT = "allow"
# Bytes that UTF-8 never has: between host and path of a key, and after all keys that begin alike.
_GAP, _AFTER = "X'FE'", "X'FF'"
# Order of events at one key.
_CLOSE, _OPEN, _ASK = 0, 1, 2
_RULE = "struct<size:int,deep:int,text:string,verdict:string>"


def parts(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased) and path (from there up to
    ``?``, ``#`` or the end); both empty for a null URL or one without ``://``."""
    at = F.position(F.lit("://"), url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    tail = F.substring(rest, F.length(host) + 1, F.length(rest))
    path = F.regexp_extract(tail, r"^[^?#]*", 0)
    lower = F.translate(host, string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def _key(labels: Column, path: Column) -> Column:
    return F.concat(F.array_join(F.reverse(labels), ".").cast("binary"), F.expr(_GAP), path.cast("binary"))


def _events(rules: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, turn, rule, near, start, range): where rules open and close and what is asked, dealt to ranges of keys."""
    null = lambda kind, name: F.lit(None).cast(kind).alias(name)
    asks = [null("string", "near"), null("string", "start")]
    opened = rules.select("key", F.lit(_OPEN).alias("turn"), F.col("rule").cast(_RULE).alias("rule"), *asks)
    closed = rules.select(F.concat("key", F.expr(_AFTER)), F.lit(_CLOSE), null(_RULE, "rule"), *asks)
    asked = keys.select("key", F.lit(_ASK), null(_RULE, "rule"), "near", "start")
    # Near and start split the rows of a key that many hosts share.
    order = ["key", "turn", "near", "start"]
    return opened.union(closed).union(asked).repartitionByRange(*order).withColumn("range", F.spark_partition_id())


def _carried(events: DataFrame) -> DataFrame:
    """Rules opened in an earlier range that are still open where a range begins: their keys begin its first key."""
    firsts = events.groupBy("range").agg(F.min("key").alias("first")).select("range", F.explode(F.transform(
        F.sequence(F.lit(1), F.length("first")), lambda n: F.substring("first", F.lit(1), n))).alias("key"))
    opened = events.filter(F.col("turn") == _OPEN).withColumnRenamed("range", "__opened")
    return opened.join(firsts, "key").filter("__opened < range").select(*events.columns)


def _sweep(events: DataFrame) -> DataFrame:
    """(near, start, rule) of all that is asked, with the innermost rule open at each key."""
    rows = events.union(_carried(events))
    change = F.when(F.col("turn") == _OPEN, 1).when(F.col("turn") == _CLOSE, -1).otherwise(0)
    order = Window.partitionBy("range").orderBy("key", "turn").rowsBetween(Window.unboundedPreceding, 0)
    height = Window.partitionBy("range", "height").orderBy("key", "turn").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("height", F.sum(change).over(order)).withColumn(
        "rule", F.last("rule", ignorenulls=True).over(height)).filter(F.col("turn") == _ASK).select(
        "near", "start", "rule")


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
          default: str = DEFAULT_VERDICT) -> DataFrame:
    """One row per page: id, host, path, rule (text, null if none fits), verdict.

    ``rules`` is (host, path, verdict).  Of the rules that fit, the longest (host and path together) wins, then the one
    of the longer host; of equal rules ``block`` does.  Rules with a null in host, path or verdict are left out.  Null
    ids and repeated rows stay rows, other columns are not read, an empty table gives no rows; without rules every
    page gets ``default``."""
    known = rules.filter("host is not null and path is not null and verdict is not null").select(
        F.translate("host", string.ascii_uppercase, string.ascii_lowercase).alias("host"), "path", "verdict").groupBy(
        "host", "path").agg(F.max("verdict").alias("verdict"))  # "block" is after "allow"
    bounds = known.agg(F.max(F.size(F.split("host", r"\."))).alias("labels"), F.max(F.length("path")).alias("path")).first()
    host, path = parts(F.col(url_col).cast("string"))
    split = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    # What decides is the last labels of the host and the first characters of the path, as many as any rule has.
    labels = F.split("host", r"\.")
    some, deep = bounds.labels or 1, bounds.path or 0
    signed = split.withColumn("near", F.array_join(F.slice(
        labels, F.greatest(F.size(labels) - some + 1, F.lit(1)), some), ".")).withColumn(
        "start", F.substring("path", 1, deep))
    near = F.split("near", r"\.")
    keys = signed.select("near", "start").distinct().select("near", "start", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(near)), lambda k: _key(F.slice(near, -k, k), F.col("start")))).alias("key"))
    text = F.concat("host", "path")
    ruled = known.select(_key(F.split("host", r"\."), F.col("path")).alias("key"), F.struct(
        F.length(text).alias("size"), F.length("host").alias("deep"), text.alias("text"), "verdict").alias("rule"))
    swept = _sweep(keep(_events(ruled, keys), "urlfilter"))
    best = swept.groupBy("near", "start").agg(F.max("rule").alias("best"))
    return signed.join(best, ["near", "start"]).select(
        F.col("id").alias(id_col), "host", "path", F.col("best.text").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
