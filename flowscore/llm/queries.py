"""One registered query for each operator, over its whole table, and DuckDB SQL where that can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowscore.llm import (arrowfiles, decontam, langid, nndescent, packing, pieces, quality, resampling, rollups,
                           secrets, simhash, turns, urlfilter)
from flowscore.llm.scratch import keep
from flowscore.session import fresh_dir
from flowscore.sources.tables import read_table

# The rules of the URL query.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]
HELD_OUT_FOLD = 2
FOLDS = 4


def held_out(id_col: str = "doc_id"):
    """Whether crc32 of the id as text falls into the held-out fold; a null id does not."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % FOLDS == HELD_OUT_FOLD, F.lit(False))


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(read_table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    prototypes = langid.train(docs.filter(~held_out()))
    return langid.predict(docs.select("doc_id", "text", held_out().alias("held_out")), prototypes,
                          columns=["doc_id", "held_out"])


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.Decontamination(read_table(spark, sf_dir, "documents").select("doc_id", "text"),
                                     read_table(spark, sf_dir, "benchmark"))
    return found.pairs().select("doc_id", "item_id", "coverage", F.size("tiles").alias("n_tiles"),
                                F.to_json("tiles").alias("tiles"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after three batches over all documents: estimates go in, exact counts replace them, documents without
    text go out; the second batch is sent twice."""
    docs = read_table(spark, sf_dir, "documents").select(
        "source", "lang", "text", F.floor(F.octet_length("text") / 4).alias("estimate"),
        (F.coalesce(F.length("text"), F.lit(0)) == 0).alias("no_text"))
    counted = keep(rollups.token_counts(docs, out_col="exact"), "rollups")
    base = ["source", "lang", F.lit("byte_bpe_50k").alias("tokenizer")]
    change = lambda op, new, old, rows=counted: rows.select(
        F.lit(op).alias("op"), *base, F.col(new).alias("tokens"), old.alias("old_tokens"))
    none = F.lit(0)
    state = rollups.Rollup(spark, fresh_dir(spark, "rollup"))
    state.apply("load", change("insert", "estimate", none))
    state.apply("recount", change("revise", "exact", F.col("estimate")))
    state.apply("recount", change("revise", "exact", F.col("estimate")))
    state.apply("drop empty", change("delete", "exact", none, counted.filter("no_text")))
    return state.totals()


def op5_arrow_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrowfiles.roundtrip(read_table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find(read_table(spark, sf_dir, "documents")).drop("found")


def url_rules(spark: SparkSession) -> DataFrame:
    return spark.sql("select * from values " + ", ".join(map(str, URL_RULES)) + " as rules(host, path, verdict)")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(read_table(spark, sf_dir, "pages"), url_rules(spark))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by source (host) and language within it (path), learned from the labels outside the held-out fold."""
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", F.col("source").alias("host"), F.col("lang").alias("path"), held_out().alias("held_out"), "text")
    rows = keep(quality.with_features(docs), "quality")
    labels = read_table(spark, sf_dir, "labels").filter("quality in (0, 1)").select(
        "doc_id", F.col("quality").alias("good"))
    learned = keep(rows.filter(~F.col("held_out")).join(labels, "doc_id").select("host", "path", "bins", "good"), "quality")
    return quality.classify(rows, learned).withColumnsRenamed({"host": "source", "path": "lang"})


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every row whose id is divisible by 20, starting at the row's own node."""
    vectors = read_table(spark, sf_dir, "embeddings")
    index = nndescent.Index(vectors)
    asked = vectors.filter("vec_id % 20 = 0").join(
        index.rows.select(F.col("id").alias("vec_id"), F.col("node").alias("start")), "vec_id").select(
        F.col("vec_id").alias("query_id"), "embedding", "start").dropDuplicates(["query_id"])
    return index.search(asked, 20)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows of conversations with faults by a rule of their id and turn; a null counts as one space."""
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn"))) % 20
    rows = conversations.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(filled("role")).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(filled("text"), ".!?", "")).otherwise(filled("text")).alias("text"),
        fault.alias("fault")).filter("fault <> 0")
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1)))).drop(
        "fault", "copy")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read_table(spark, sf_dir, "conversations")
    repair = turns.Repair(damaged(conversations))
    out = conversations.select("conv_id").distinct()
    for part in (repair.summary(), turns.digests(repair.turns())):
        out = out.join(part, F.col("conv_id").eqNullSafe(F.col("conv")), "left").drop("conv")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select("conv_id", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"),
                               columns=["doc_id"])


def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = pieces.encode(read_table(spark, sf_dir, "documents"), columns=["doc_id"]).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids")
    decoded = pieces.decode(encoded, columns=["doc_id", "n_tokens"], digest_col="ids_sha256")
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("text", 256).alias("decoded_sha256"))


QUERIES = {f.__name__: f for f in (op1_packing, op2_language_id, op3_decontamination, op4_token_counts, op5_arrow_files,
                                   op6_secret_scan, op7_url_filter, op8_quality, op9_simhash, op10_nearest, op11_conversation_repair,
                                   op12_resampling, op13_pieces)}

_RULES_SQL = ", ".join(map(str, URL_RULES))
ORACLE = {
    "op7_url_filter": f"""
        WITH cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0
                                          THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
        hosts AS (SELECT page_id, coalesce(regexp_extract(rest, '^[^/?#]*'), '') AS raw, rest FROM cut),
        parts AS (SELECT row_number() OVER () AS n, page_id,
                         translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                         coalesce(regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*'), '') AS path FROM hosts),
        rules(rule_host, rule_path, rule_verdict) AS (VALUES {_RULES_SQL}),
        best AS (SELECT n, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
                        max_by(rule_verdict, length(rule_host || rule_path)) AS verdict
                 FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host))
                                      AND starts_with(path, rule_path) GROUP BY n)
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN best USING (n)""",
    # Distinct words are hashed once: crc32 by its table, which comes from the polynomial.
    "op12_resampling": f"""
        WITH crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]),
                            lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS steps),
        texts AS (SELECT 's' AS side, row_number() OVER () AS n, doc_id, text FROM documents
                  UNION ALL SELECT 't', NULL, NULL, text FROM benchmark),
        words AS (SELECT side, n, unnest(regexp_extract_all(
                      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                      '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word FROM texts),
        hashed AS (SELECT word, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(
                       range(1, length(hex(word)) + 1, 2), lambda i: ('0x' || substr(hex(word), i, 2))::BIGINT)),
                       lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]))) % {resampling.BUCKETS} AS bucket
                   FROM (SELECT DISTINCT word FROM words), crc),
        counted AS (SELECT bucket, count(*) FILTER (side = 's') AS s, count(*) FILTER (side = 't') AS t
                    FROM words JOIN hashed USING (word) GROUP BY bucket),
        gains AS (SELECT bucket, floor(1000 * ln(((t + 1) * (sum(s) OVER () + {resampling.BUCKETS}))::DOUBLE
                         / ((s + 1) * (sum(t) OVER () + {resampling.BUCKETS}))::DOUBLE))::BIGINT AS gain FROM counted),
        weights AS (SELECT n, count(*) AS n_features, sum(gain)::BIGINT AS weight
                    FROM words JOIN hashed USING (word) JOIN gains USING (bucket) WHERE side = 's' GROUP BY n),
        scored AS (SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
                          coalesce(weight, 0) + floor(-1000 * ln(-ln(
                              (('0x' || substr(sha256('{resampling.SEED}:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE)
                              / 4294967296::DOUBLE)))::BIGINT AS score
                   FROM texts LEFT JOIN weights USING (n) WHERE side = 's'),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
                          count(*) FILTER (n_features >= 20) OVER () AS eligible FROM scored)
        SELECT doc_id, n_features, weight, score,
               CASE WHEN n_features >= 20 AND place <= 10 * eligible // 100 THEN place END AS rank FROM ranked""",
}
