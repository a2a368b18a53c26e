"""The registered queries: one per operator of the inventory, each a
``(spark, sf_dir) -> DataFrame`` over the given tables (or data Spark derives
from them), so the work grows with the tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowscore.functions.columns import numeric_columns, schema_diff
from flowscore.functions.json_codec import (decode_json, decode_json_lenient,
                                            decode_with_quarantine, json_column)
from flowscore.functions.labels import (bucket_unseen, bucket_unseen_join, clean_label, code_of,
                                         label_report)
from flowscore.operators import conform as C
from flowscore.operators import profile as P
from flowscore.operators import serve as S
from flowscore.operators.evaluate import accuracy_f1, auc_frame
from flowscore.operators.features import (assembler_stage, drop_stage, imputer_stage, index_stage,
                                          train_flag, train_test_split, vector_as_array)
from flowscore.operators.monitor import throughput
from flowscore.operators.retention import (batch_sizes, document_bytes, retain_newest,
                                           retain_newest_documents)
from flowscore.operators.score import decode_labels, score, to_documents
from flowscore.operators.train import FlowModel, fit_classifier
from flowscore.operators.vocabulary import encode_by_join, vocabulary
from flowscore.operators.zones import lookup, top_k
from flowscore.plans import standins as SI
from flowscore.schema import SPIKE_FACTOR, STANDIN_FIELDS, UNKNOWN_LABEL, wire_v1, wire_v2
from flowscore.session import fresh_dir
from flowscore.sources.files import (first_n, read_csv, read_headerless_csv, read_headerless_lines, read_names,
                                     write_csv)
from flowscore.sources.ordered import ordered_stream
from flowscore.sources.tables import for_fit, read_table, table_path
from flowscore.streaming.jobs import (live_throughput, live_totals, run_to_end, windowed_counts,
                                      without_repeats)
from flowscore.streaming.sinks import CommittedSink, latest_per_key

Query = Callable[[SparkSession, str], DataFrame]

# Query parameters (fixed here, the same in the oracle SQL).
FIRST_N = 2000
PAGE = 100
RETENTION_CAP = 262144           # bytes kept by the retention query
RETENTION_BATCH_ROWS = 100       # events per stand-in micro-batch
ALERT_TYPE = "error"             # attack type looked up by by_attack_type
ORDERED_PARTS = 16               # files of stream_ordered_files
ONCE_WATERMARK = "36500 days"    # the arrivals of stream_once may lie any time apart
LOOKUP_PARTITION, LOOKUP_OFFSET = 3, 100   # source position asked for by lookup_offset
UNSEEN_TYPE = "click"            # category left out of the fit by index_unseen


def _t(spark, sf_dir, name):
    return read_table(spark, sf_dir, name)


# ---------------------------------------------------------------------------
# Sources, decode, encode
# ---------------------------------------------------------------------------

def decode_kafka_json(spark, sf_dir):
    """Envelope -> JSON decode with the faithful int32 schema -> flatten ->
    zero-fill of the record's numeric fields (an int32 overflow becomes 0)."""
    rec = decode_json(SI.events_envelope(spark, sf_dir), wire_v1(STANDIN_FIELDS))
    return C.fill_zero(rec, SI.RECORD_NUMERIC)


def decode_lenient(spark, sf_dir):
    """Widened decode: counters as bigint, text / fractional numbers recovered."""
    rec = decode_json_lenient(SI.events_envelope(spark, sf_dir), STANDIN_FIELDS)
    return C.fill_zero(rec, SI.RECORD_NUMERIC)


def _partly_bad(spark, sf_dir):
    """(good, bad) records where event_id mod 10 = 7 is malformed and 8 null."""
    ev = _t(spark, sf_dir, "events")
    r = F.pmod(F.col("event_id"), F.lit(10))
    payload = (F.when(r == 7, F.lit("not json {"))
                .when(r == 8, F.lit(None).cast("string"))
                .otherwise(json_column(SI.payload_columns())))
    return decode_with_quarantine(SI.envelope(ev, payload), wire_v2(STANDIN_FIELDS))


def quarantine(spark, sf_dir):
    """Malformed and null payloads are routed apart."""
    return _partly_bad(spark, sf_dir)[1]


def quarantine_good(spark, sf_dir):
    """The other half: every valid payload, decoded."""
    return _partly_bad(spark, sf_dir)[0]


def decode_props(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    parsed = F.from_json(F.col("props"), T.StructType([T.StructField("k", T.LongType())]))
    return ev.select("event_id", parsed.getField("k").alias("k"))


def encode_json(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    return ev.select("event_id", json_column(["event_id", "user_id", "event_type"]).alias("value"))


def first_n_rows(spark, sf_dir):
    return first_n(_t(spark, sf_dir, "lineitem"), FIRST_N, "l_orderkey", "l_linenumber")


def csv_roundtrip(spark, sf_dir):
    """Write with header, read back with a declared schema (no inference pass)."""
    li = _t(spark, sf_dir, "lineitem")
    path = fresh_dir(spark, "csv")
    write_csv(li, path, header=True)
    return read_csv(spark, path, schema=li.schema, header=True)


def headerless_csv(spark, sf_dir):
    """Headerless CSV + a names dictionary (raw upper-case names) -> lower-case
    names, declared types."""
    li = _t(spark, sf_dir, "lineitem")
    base = fresh_dir(spark, "rawcsv")
    write_csv(li, base + "/data", header=False)
    names = spark.createDataFrame([(c.upper(),) for c in li.columns], "Name string")
    write_csv(names.coalesce(1), base + "/names", header=True)
    raw_names = read_names(spark, base + "/names")
    types = {f.name.upper(): f.dataType for f in li.schema.fields}
    raw = read_headerless_csv(spark, base + "/data", raw_names, types)
    return C.conform(raw, li.columns)


# ---------------------------------------------------------------------------
# Cleaning and conforming
# ---------------------------------------------------------------------------

def fill_missing_zero(spark, sf_dir):
    ev = SI.missing_by_rule(_t(spark, sf_dir, "events"))
    return C.fill_zero(ev.select("event_id", "user_id", "value", "event_type"))


def cast_rate(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    r = F.pmod(F.col("event_id"), F.lit(10))
    text = (F.when(r == 3, F.lit("n/a")).when(r == 5, F.lit(None).cast("string"))
             .otherwise(F.col("value").cast("string")))
    return C.cast_double(ev.select("event_id", text.alias("rate")), "rate")


def derive_label(spark, sf_dir):
    return C.derive_label(_t(spark, sf_dir, "labels"), "quality").select("doc_id", "label")


LINEITEM_RAW_RENAMES = {"l_qtysz": "l_quantity"}
LINEITEM_TARGET = ["l_orderkey", "l_linenumber", "l_quantity", "rate", "l_extendedprice",
                   "l_discount", "l_returnflag", "l_comment"]


def raw_lineitem(li: DataFrame) -> DataFrame:
    """Raw-file look of lineitem: upper-case names, one old name."""
    names = ["L_QTYSZ" if c == "l_quantity" else c.upper() for c in li.columns]
    return li.toDF(*names)


def conform_schema(spark, sf_dir):
    raw = raw_lineitem(_t(spark, sf_dir, "lineitem"))
    return C.conform(raw, LINEITEM_TARGET, LINEITEM_RAW_RENAMES, nan_columns=["rate"],
                     drop=["l_linenumber"])


def numeric_columns_q(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return li.select(*numeric_columns(li, exclude=["l_orderkey"]))


def drop_columns(spark, sf_dir):
    return C.drop_columns(_t(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus", "l_shipdate"])


def schema_diff_q(spark, sf_dir):
    return schema_diff(spark, _t(spark, sf_dir, "documents"), _t(spark, sf_dir, "labels"))


def label_code_map(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    return ev.select("event_id", "event_type",
                     code_of(F.col("event_type"), SI.EVENT_TYPE_CODES).alias("code"))


def _messy_event_type(ev: DataFrame) -> DataFrame:
    r = F.pmod(F.col("event_id"), F.lit(10))
    raw = (F.when(r == 3, F.lit(None).cast("string"))
            .when(r == 6, F.concat(F.lit("  "), F.col("event_type"), F.lit(" ")))
            .when(r == 9, F.upper(F.col("event_type")))
            .otherwise(F.col("event_type")))
    return ev.select("event_id", raw.alias("raw_label"))


def label_cleanup(spark, sf_dir):
    ev = _messy_event_type(_t(spark, sf_dir, "events"))
    lab = clean_label(F.col("raw_label"), SI.EVENT_TYPE_VOCAB, default=SI.NORMAL_EVENT)
    out = ev.select("event_id", lab.alias("label"))
    return out.withColumn("code", code_of(F.col("label"), SI.EVENT_TYPE_VOCAB))


def label_missing_counts(spark, sf_dir):
    return label_report(_messy_event_type(_t(spark, sf_dir, "events")), "raw_label",
                        SI.EVENT_TYPE_VOCAB, SI.NORMAL_EVENT)


def shared_columns(spark, sf_dir):
    """The columns of lineitem that its conformed form has too."""
    return C.shared_columns(_t(spark, sf_dir, "lineitem"), conform_schema(spark, sf_dir))


def unknown_bucket(spark, sf_dir):
    """Customers never seen in the training split become 'Unknown' at test time."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("customer"))
    train, test = train_test_split(o, "o_orderkey")
    return bucket_unseen_join(test, "customer", train).select("o_orderkey", "customer")


def union_by_name(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    train, test = train_test_split(o, "o_orderkey")
    test = test.select("o_totalprice", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    return train.unionByName(test, allowMissingColumns=True)


def headerless_bad_bytes(spark, sf_dir):
    """Headerless CSV with bytes that are no UTF-8 in every line: they are ignored, the rest is as without them."""
    li = _t(spark, sf_dir, "lineitem")
    base = fresh_dir(spark, "badcsv")
    text = [F.col(c).cast("string") for c in li.columns]
    at = li.columns.index("l_returnflag")
    head, tail = (F.to_binary(F.concat_ws(",", *part), F.lit("utf-8")) for part in (text[:at + 1], text[at + 1:]))
    line = F.concat(head, F.unhex(F.lit("FFC3")), F.to_binary(F.lit(","), F.lit("utf-8")), F.unhex(F.lit("E282")), tail)
    li.select(line.cast("string").alias("value")).write.text(base)
    return read_headerless_lines(spark, base, li.columns, {f.name: f.dataType for f in li.schema.fields})


# ---------------------------------------------------------------------------
# Profiling and counts
# ---------------------------------------------------------------------------

def value_counts(spark, sf_dir):
    return P.value_counts(_t(spark, sf_dir, "events"), "event_type")


def label_index_pairs(spark, sf_dir):
    ev = _t(spark, sf_dir, "events").select(F.col("event_type").alias("label"))
    idx = index_stage("label", "label_index").fit(ev).transform(ev)
    return P.label_index_pairs(idx, "label", "label_index")


def counts_per_source(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents").select("doc_id", "source")
    lab = _t(spark, sf_dir, "labels").select("doc_id", "toxic")
    return P.counts_per_source(docs.join(lab, "doc_id"), "source", "toxic")


def counts_per_file(spark, sf_dir):
    """Per input file (``_metadata.file_name``) and overall."""
    from flowscore.sources.tables import read_with_file_name, table_path
    docs = read_with_file_name(spark, [table_path(sf_dir, "documents")]).select("doc_id", "file_name")
    lab = _t(spark, sf_dir, "labels").select("doc_id", "toxic")
    return P.counts_per_source(docs.join(lab, "doc_id"), "file_name", "toxic")


def null_profile(spark, sf_dir):
    return P.null_profile(SI.missing_by_rule(_t(spark, sf_dir, "events")))


def dataset_shape(spark, sf_dir):
    return P.dataset_shape(_t(spark, sf_dir, "lineitem"))


def column_profile(spark, sf_dir):
    return P.column_profile(_t(spark, sf_dir, "lineitem"))


def impute_mean(spark, sf_dir):
    ev = SI.missing_by_rule(_t(spark, sf_dir, "events")).select("event_id", "value")
    out = imputer_stage(["value"]).fit(ev).transform(ev)
    return out.select("event_id", F.round("value", 6).alias("value"))


def throughput_q(spark, sf_dir):
    return throughput(_t(spark, sf_dir, "events"), "ts", "1 hour")


def retain_newest_bytes(spark, sf_dir):
    ev = _t(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type",
        F.expr(f"event_id div {RETENTION_BATCH_ROWS}").alias("batch_id"))
    sizes = batch_sizes(ev, "batch_id", ["event_id", "user_id", "event_type"])
    return retain_newest(sizes, "batch_id", RETENTION_CAP)


def retain_newest_documents_q(spark, sf_dir):
    """The newest documents within the cap: the border lies inside an hour."""
    ev = _t(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    size = document_bytes(["event_id", "user_id", "event_type"])
    kept = retain_newest_documents(ev, size, ["ts", "event_id"], F.window("ts", "1 hour").start, RETENTION_CAP)
    return kept.select("event_id", "ts", size.alias("bytes"))


# ---------------------------------------------------------------------------
# Features
# ---------------------------------------------------------------------------

def string_index(spark, sf_dir):
    ev = _t(spark, sf_dir, "events").select("event_id", "event_type")
    return index_stage("event_type").fit(ev).transform(ev).select("event_id", "event_type_index")


def string_index_multi(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    m = index_stage(["l_returnflag", "l_linestatus"]).fit(li)
    return m.transform(li).select("l_orderkey", "l_linenumber", "l_returnflag_index", "l_linestatus_index")


def string_index_join(spark, sf_dir):
    """An index of a vocabulary that grows with the table, as a table."""
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("part"))
    return encode_by_join(li, "part", vocabulary(li, "part")).select("l_orderkey", "l_linenumber", "part_index")


def alphabetical_index(spark, sf_dir):
    ev = _t(spark, sf_dir, "events").select("event_id", "event_type")
    m = index_stage("event_type", order="alphabetAsc").fit(ev)
    return m.transform(ev).select("event_id", "event_type_index")


def index_unseen(spark, sf_dir):
    """Alphabetical index fitted without one category, which then gets the extra index."""
    ev = _t(spark, sf_dir, "events").select("event_id", "event_type")
    m = index_stage("event_type", order="alphabetAsc").fit(ev.where(F.col("event_type") != UNSEEN_TYPE))
    return m.transform(ev).select("event_id", "event_type_index")


def drop_stage_q(spark, sf_dir):
    """A fitted pipeline of an index stage and a drop-columns stage."""
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate")
    drop = drop_stage([*li.columns, "l_returnflag_index"], ["l_returnflag", "l_shipdate"])
    return Pipeline(stages=[index_stage("l_returnflag"), drop]).fit(li).transform(li)


def assemble_features(spark, sf_dir):
    ev = SI.missing_by_rule(_t(spark, sf_dir, "events")).select(
        "event_id", "value", F.col("user_id").cast("double").alias("user"),
        F.col("event_id").cast("double").alias("eid"))
    v = assembler_stage(["value", "user", "eid"]).transform(ev)
    arr = vector_as_array("features")
    return v.select("event_id", arr[0].alias("f0"), arr[1].alias("f1"), arr[2].alias("f2"),
                    F.size(arr).cast("bigint").alias("n_features"))


def train_test_split_q(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    return ev.select("event_id", train_flag(F.col("event_id")).alias("is_train"))


def index_to_label(spark, sf_dir):
    ev = _t(spark, sf_dir, "events").select("event_id", "event_type")
    m = index_stage("event_type").fit(ev)
    out = decode_labels(m.transform(ev), list(m.labels) + [UNKNOWN_LABEL],
                        prediction="event_type_index", out="label")
    return out.select("event_id", "event_type_index", "label")


# ---------------------------------------------------------------------------
# Evaluation
# ---------------------------------------------------------------------------

def accuracy_f1_q(spark, sf_dir):
    return accuracy_f1(_t(spark, sf_dir, "labels"), "quality", "toxic")


def auc(spark, sf_dir):
    lab = _t(spark, sf_dir, "labels").select("doc_id", "quality")
    docs = _t(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return auc_frame(spark, lab.join(docs, "doc_id"), "quality", "n_chars")


# ---------------------------------------------------------------------------
# Models: learned on labels that are a rule of the features, so a right fit
# is nearly exact on unseen rows and a wrong one is not.  A query returns each
# scored row's key and label, whether its prediction and confidence are ones
# the model may give, and whether the accuracy over all rows meets the bound.
# ---------------------------------------------------------------------------

EMBEDDING_DIM = 64


# Bands of the label rules (upper edges of all but the last band).
EMBEDDING_BANDS = (-0.05, 0.05)
# Ten classes within these three: every edge above is one of theirs.
EMBEDDING_CLASSES = (-0.16, -0.11, -0.08, -0.05, 0.0, 0.05, 0.08, 0.11, 0.16)
QUANTITY_BANDS = (17, 34)
VALUE_BANDS = (20, 55)
LONG_DOCUMENT = 1500
LEAST_ACCURACY = 0.9
# Reference model settings (boosted trees).
GBT_PARAMS = {"maxIter": 100, "maxDepth": 6}
BOOST_PARAMS = {"rounds": 100, "depth": 6}


def _band(c, edges, names):
    low, high = edges
    return F.when(c < low, names[0]).when(c < high, names[1]).otherwise(names[2])


BANDS = ("low", "mid", "high")


def _embeddings(spark, sf_dir):
    e = for_fit(_t(spark, sf_dir, "embeddings"), "vec_id")
    return e.select("vec_id", _band(F.col("embedding")[2], EMBEDDING_BANDS, BANDS).alias("label"),
                    array_to_vector(F.col("embedding")).alias("vec"))


_VEC = {"vec": EMBEDDING_DIM}


def _labelled_docs(spark, sf_dir):
    lab = _t(spark, sf_dir, "labels").select("doc_id")
    docs = _t(spark, sf_dir, "documents").select(
        "doc_id", "n_chars", "lang", "source", (F.col("n_chars") >= LONG_DOCUMENT).cast("int").alias("quality"))
    joined = lab.join(docs, "doc_id").withColumn("n_chars", F.col("n_chars").cast("double"))
    return for_fit(joined, "doc_id")


def _model_output(scored: DataFrame, keys: list[str], label: str, names: list[str]) -> DataFrame:
    said = F.col("prediction_label")
    right = scored.agg(F.avg((said == F.col(label).cast("string")).cast("double"))).first()[0] or 0.0
    confidence = F.col("confidence")
    return scored.select(*keys, F.col(label).alias("label"), said.isin(names).alias("in_vocabulary"),
                         # one-vs-rest models give no probability
                         (confidence.isNull() | (confidence >= 0) & (confidence <= 1)).alias("confidence_ok"),
                         F.lit(right >= LEAST_ACCURACY).alias("accurate"))


def train_rf(spark, sf_dir):
    """Random forest with the reference settings; test-split predictions."""
    train, test = train_test_split(_embeddings(spark, sf_dir), "vec_id")
    model = fit_classifier(train, "label", [], vectors=_VEC, kind="rf")
    return _model_output(score(test, model), ["vec_id"], "label", list(BANDS))


def batch_score(spark, sf_dir):
    """Fit once, score the whole table in batch: label text + confidence."""
    emb = _embeddings(spark, sf_dir)
    train, _ = train_test_split(emb, "vec_id")
    model = fit_classifier(train, "label", [], vectors=_VEC, kind="rf")
    return _model_output(score(emb, model), ["vec_id"], "label", list(BANDS))


def _embedding_classes(spark, sf_dir):
    """Vectors with a class of ten, ``class_0`` to ``class_9``, by ranges of one component."""
    below = [F.when(F.col("embedding")[2] >= edge, 1).otherwise(0) for edge in EMBEDDING_CLASSES]
    e = for_fit(_t(spark, sf_dir, "embeddings"), "vec_id")
    return e.select("vec_id", F.concat(F.lit("class_"), sum(below, F.lit(0)).cast("string")).alias("label"),
                    array_to_vector(F.col("embedding")).alias("vec"))


def train_gbt_ovr(spark, sf_dir):
    """Boosted trees for ten classes with the reference settings: each class, whether the probability of the predicted
    one is there, and an accuracy over the ten."""
    train, test = train_test_split(_embedding_classes(spark, sf_dir), "vec_id")
    model = fit_classifier(train, "label", [], vectors=_VEC, kind="softmax", params=BOOST_PARAMS)
    names = [f"class_{i}" for i in range(len(EMBEDDING_CLASSES) + 1)]
    scored = score(test, model)
    return _model_output(scored.withColumn("has_confidence", F.col("confidence").isNotNull()),
                         ["vec_id", "has_confidence"], "label", names)


def train_lr(spark, sf_dir):
    train, test = train_test_split(_labelled_docs(spark, sf_dir), "doc_id")
    model = fit_classifier(train, "quality", ["n_chars"], ["lang", "source"], kind="lr",
                           index_label=False)
    return _model_output(score(test, model), ["doc_id"], "quality", ["0", "1"])


def model_roundtrip(spark, sf_dir):
    """Fit, save, load and score: a loaded model says what the fitted one does."""
    train, test = train_test_split(_labelled_docs(spark, sf_dir), "doc_id")
    model = fit_classifier(train, "quality", ["n_chars"], ["lang", "source"], kind="lr",
                           index_label=False)
    folder = fresh_dir(spark, "model")
    model.save(folder)
    # Both models score the same rows one after the other, so no join is needed.
    fitted = score(test, model).select(
        *test.columns, F.col("prediction").alias("was"), F.col("confidence").alias("was_confidence"))
    loaded = score(fitted, FlowModel.load(folder))
    same = (F.col("prediction") == F.col("was")) & (F.col("confidence") == F.col("was_confidence"))
    out = _model_output(loaded.withColumn("same", same), ["doc_id", "same"], "quality", ["0", "1"])
    return out.withColumnRenamed("same", "same_after_load")


def scored_columns(spark, sf_dir):
    """The columns of a scored row fit each other: the probabilities sum to 1, the prediction is the class of
    the largest one, and that is the confidence."""
    train, test = train_test_split(_labelled_docs(spark, sf_dir), "doc_id")
    model = fit_classifier(train, "quality", ["n_chars"], ["lang", "source"], kind="lr",
                           index_label=False)
    p = vector_as_array("probability")
    total = F.aggregate(p, F.lit(0.0), lambda a, x: a + x)
    return score(test, model).select(
        "doc_id", F.size(vector_as_array("features")).alias("n_features"), F.size(p).alias("n_classes"),
        (F.abs(total - 1) < 1e-9).alias("sums_to_one"), (F.array_max(p) == F.col("confidence")).alias("confidence_is_max"),
        (F.element_at(p, F.col("prediction").cast("int") + 1) == F.col("confidence")).alias("prediction_is_likeliest"))


def train_gbt(spark, sf_dir):
    train, test = train_test_split(_labelled_docs(spark, sf_dir), "doc_id")
    model = fit_classifier(train, "quality", ["n_chars"], ["lang", "source"], kind="gbt",
                           index_label=False, params=GBT_PARAMS)
    return _model_output(score(test, model), ["doc_id"], "quality", ["0", "1"])


def score_conformed(spark, sf_dir):
    """Train on the curated table, evaluate on the raw-file look of the test
    split after conforming and bucketing unseen categories."""
    li = _t(spark, sf_dir, "lineitem")
    feats = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    cols = ["l_orderkey", "l_linenumber", *feats, "l_linestatus", "l_returnflag"]
    key = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    li = li.withColumn("l_returnflag", _band(F.col("l_quantity"), QUANTITY_BANDS, ("A", "N", "R")))
    curated = li.select(*cols).withColumn("_k", key)
    train = curated.where(train_flag(F.col("_k")))
    model = fit_classifier(train, "l_returnflag", feats, ["l_linestatus"], kind="rf", key="_k")
    raw_test = raw_lineitem(li.where(~train_flag(key)))
    test = C.conform(raw_test, ["l_orderkey", "l_linenumber", *feats, "l_linestatus", "l_returnflag"],
                     LINEITEM_RAW_RENAMES)
    test = test.withColumn("l_returnflag", clean_label(F.col("l_returnflag"), {"A": 0, "N": 1, "R": 2},
                                                        default="N"))
    # unseen categories -> Unknown with the vocabulary the fitted indexer
    # holds: no second scan of the training split, no join
    test = test.withColumn("l_linestatus",
                           bucket_unseen(F.col("l_linestatus"), model.vocabulary("l_linestatus")))
    scored = score(test, model).select("l_orderkey", "l_linenumber", "l_returnflag", "prediction_label", "confidence")
    return _model_output(scored, ["l_orderkey", "l_linenumber"], "l_returnflag", ["A", "N", "R"])


# ---------------------------------------------------------------------------
# Serving over stored predictions
# ---------------------------------------------------------------------------

def _docs(spark, sf_dir):
    return SI.stored_predictions(spark, sf_dir)


def _top(spark, sf_dir, by, descending, *ties):
    """An exact page through the zone map: only files that may hold one of its rows are opened."""
    found = top_k(_docs(spark, sf_dir), SI.prediction_zones(spark, sf_dir), PAGE, by, descending, ties)
    return S.flat(found.rows)


_PLACE = ("kafka_metadata.partition", "kafka_metadata.offset")


def fetch_first_100(spark, sf_dir):
    out = _top(spark, sf_dir, "timestamp", False, *_PLACE)
    doc_id = F.concat_ws(":", F.lit("demo"), F.col("partition").cast("string"), F.col("offset").cast("string"))
    return out.withColumn("doc_id", doc_id)


def latest_predictions(spark, sf_dir):
    return _top(spark, sf_dir, "timestamp", True, *_PLACE)


def top_confidence(spark, sf_dir):
    return _top(spark, sf_dir, "confidence", True, "timestamp", *_PLACE)


def by_attack_type(spark, sf_dir):
    return S.by_attack_type(_docs(spark, sf_dir), ALERT_TYPE)


def by_offset(spark, sf_dir):
    return _top(spark, sf_dir, "kafka_metadata.offset", True, "kafka_metadata.partition")


def lookup_offset(spark, sf_dir):
    """One document by its place in the source."""
    return S.flat(lookup(_docs(spark, sf_dir), partition=LOOKUP_PARTITION, offset=LOOKUP_OFFSET))


def alerts(spark, sf_dir):
    return S.alerts(_docs(spark, sf_dir), SI.NORMAL_EVENT)


def attack_distribution(spark, sf_dir):
    return S.attack_distribution(_docs(spark, sf_dir))


def total_predictions(spark, sf_dir):
    return S.total_predictions(_docs(spark, sf_dir))


def prediction_counts(spark, sf_dir):
    return P.counts_by(_docs(spark, sf_dir), "prediction")


def label_counts(spark, sf_dir):
    d = _docs(spark, sf_dir).select(F.col("attack_type").alias("prediction_label"))
    return P.counts_by(d, "prediction_label")


# ---------------------------------------------------------------------------
# Streaming
# ---------------------------------------------------------------------------

def _stream_decoded(spark, sf_dir):
    env = SI.events_envelope_stream(spark, sf_dir)
    rec = decode_json(env, wire_v1(STANDIN_FIELDS))
    return C.fill_zero(rec, SI.RECORD_NUMERIC)


def stream_append(spark, sf_dir):
    """File stream -> decode -> fill -> idempotent Parquet sink (availableNow)."""
    out, ckpt = fresh_dir(spark, "stream_out"), fresh_dir(spark, "stream_ckpt")
    run = run_to_end(_stream_decoded(spark, sf_dir), out, ckpt)
    return spark.read.parquet(run.output).drop("batch_id")


def stream_restart(spark, sf_dir):
    """Restart on one checkpoint while new data arrives: the events table
    lands in two parts (hash split of the key, together the whole table);
    the stream runs after the first, stops, and resumes after the second.
    Every event must come out exactly once."""
    ev = _t(spark, sf_dir, "events")
    src = fresh_dir(spark, "stream_src")
    out, ckpt = fresh_dir(spark, "stream_out"), fresh_dir(spark, "stream_ckpt")
    first = train_flag(F.col("event_id"))
    ev.where(first).write.parquet(src + "/arrival=1")

    def decoded():
        stream = spark.readStream.schema(SI.EVENTS_SCHEMA).parquet(src + "/*")
        rec = decode_json(SI.envelope(stream), wire_v1(STANDIN_FIELDS))
        return C.fill_zero(rec, SI.RECORD_NUMERIC)

    run_to_end(decoded(), out, ckpt)
    ev.where(~first).write.parquet(src + "/arrival=2")
    run = run_to_end(decoded(), out, ckpt)
    return spark.read.parquet(run.output).drop("batch_id")


def stream_score(spark, sf_dir):
    """A fitted pipeline applied to the stream; documents partitioned by type.
    Every event's stream prediction must be the one batch scoring gives."""
    types = ("view", "click", "error")
    rec = SI.records(spark, sf_dir).withColumn("event_type", _band(F.col("value"), VALUE_BANDS, types))
    train, _ = train_test_split(rec, "event_id")
    model = fit_classifier(for_fit(train, "event_id"), "event_type", ["user_id", "value"], kind="rf")
    env = SI.events_envelope_stream(spark, sf_dir)
    srec = C.fill_zero(decode_json_lenient(env, STANDIN_FIELDS), SI.RECORD_NUMERIC)
    docs = to_documents(score(srec, model, fill="zero"), keep=["event_id"])
    out, ckpt = fresh_dir(spark, "scored"), fresh_dir(spark, "scored_ckpt")
    run = run_to_end(docs, out, ckpt, partition_by=["attack_type"])
    stream = spark.read.parquet(run.output).select(
        "event_id", F.col("attack_type").alias("prediction_label"), "confidence")
    batch = score(rec, model, fill="zero").select("event_id", F.col("event_type").alias("label"),
                                                  F.col("prediction_label").alias("batch_label"))
    both = stream.join(batch, "event_id")
    checked = _model_output(both.withColumn("same", F.col("prediction_label") == F.col("batch_label")),
                            ["event_id", "same"], "label", list(types))
    return checked.withColumnRenamed("same", "same_as_batch")


def stream_throughput(spark, sf_dir):
    """Hourly counts on the stream, update mode, upserted; a back-fill has no
    watermark, so late files count too."""
    ev = spark.readStream.schema(SI.EVENTS_SCHEMA).parquet(
        f"{sf_dir.rstrip('/')}/events*.parquet")
    counts = windowed_counts(ev, "ts", "1 hour", None)
    out, ckpt = fresh_dir(spark, "tput"), fresh_dir(spark, "tput_ckpt")
    run = run_to_end(counts, out, ckpt, output_mode="update")
    res = latest_per_key(spark.read.parquet(run.output), ["bucket"])
    return res.select("bucket", "n")


def _arrivals(spark, sf_dir, kind):
    """The events table landing in two parts by a hash of the key; in the second, a third of the first comes again."""
    ev = _t(spark, sf_dir, "events")
    src = fresh_dir(spark, kind)
    first = train_flag(F.col("event_id"))
    return (src, lambda: ev.where(first).write.parquet(src + "/arrival=1"),
            lambda again: (ev.where(~first).unionByName(ev.where(first & (F.col("event_id") % 3 == 0))) if again
                           else ev.where(~first)).write.parquet(src + "/arrival=2"))


def stream_running_total(spark, sf_dir):
    """Live totals over arrivals out of order, with a restart between: the same as in batch."""
    src, first, second = _arrivals(spark, sf_dir, "totals_src")
    out, ckpt = fresh_dir(spark, "totals"), fresh_dir(spark, "totals_ckpt")
    for arrive in (first, lambda: second(False)):
        arrive()
        events = spark.readStream.schema(SI.EVENTS_SCHEMA).parquet(src + "/*")
        run = run_to_end(live_totals(events, "ts"), out, ckpt, output_mode="update")
    return live_throughput(spark.read.parquet(run.output), SPIKE_FACTOR)


def stream_once(spark, sf_dir):
    """Events that are sent again after a restart come out once."""
    src, first, second = _arrivals(spark, sf_dir, "once_src")
    out, ckpt = fresh_dir(spark, "once"), fresh_dir(spark, "once_ckpt")
    for arrive in (first, lambda: second(True)):
        arrive()
        stream = SI.envelope(spark.readStream.schema(SI.EVENTS_SCHEMA).parquet(src + "/*"))
        decoded = decode_json_lenient(without_repeats(stream, "timestamp", ONCE_WATERMARK), STANDIN_FIELDS)
        run = run_to_end(decoded, out, ckpt)
    return spark.read.parquet(run.output).select("event_id", "event_type", "topic", "partition", "offset")


def stream_committed(spark, sf_dir):
    """Decoded events in a folder that one checkpoint owns, each batch committed once."""
    out, ckpt = fresh_dir(spark, "committed"), fresh_dir(spark, "committed_ckpt")
    writer = _stream_decoded(spark, sf_dir).writeStream.option("checkpointLocation", ckpt).trigger(availableNow=True)
    query = writer.foreachBatch(CommittedSink(out, ckpt)).start()
    query.awaitTermination()
    return spark.read.parquet(out).drop("batch_id")


def stream_ordered_files(spark, sf_dir):
    """Events as a list of files against the order of their names, the last ones listed only at a restart."""
    src, out, ckpt = (fresh_dir(spark, f"ordered_{kind}") for kind in ("src", "out", "ckpt"))
    events = spark.read.schema(SI.EVENTS_SCHEMA).parquet(table_path(sf_dir, "events"))
    parts = events.withColumn("part", F.pmod("event_id", F.lit(ORDERED_PARTS)))
    parts.repartition("part").sortWithinPartitions("part", "event_id").write.partitionBy("part").parquet(src)
    files = sorted(spark.read.parquet(src).inputFiles(), key=lambda f: -int(f.rsplit("part=", 1)[1].split("/")[0]))
    for listed in (files[:ORDERED_PARTS // 2], files):
        query = (ordered_stream(spark, listed, SI.EVENTS_SCHEMA).writeStream.format("parquet").option("path", out)
                 .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        query.awaitTermination()
    return spark.read.parquet(out).select("event_id", "event_type", "file_number", "row_number")


QUERIES: dict[str, Query] = {
    # sources / decode / encode
    "stream_append": stream_append,
    "stream_restart": stream_restart,
    "decode_kafka_json": decode_kafka_json,
    "decode_lenient": decode_lenient,
    "quarantine": quarantine,
    "quarantine_good": quarantine_good,
    "decode_props": decode_props,
    "encode_json": encode_json,
    "first_n_rows": first_n_rows,
    "csv_roundtrip": csv_roundtrip,
    "headerless_csv": headerless_csv,
    "headerless_bad_bytes": headerless_bad_bytes,
    "stream_once": stream_once,
    "stream_committed": stream_committed,
    "stream_ordered_files": stream_ordered_files,
    # cleaning / conforming
    "fill_missing_zero": fill_missing_zero,
    "cast_rate": cast_rate,
    "derive_label": derive_label,
    "conform_schema": conform_schema,
    "numeric_columns": numeric_columns_q,
    "drop_columns": drop_columns,
    "schema_diff": schema_diff_q,
    "label_code_map": label_code_map,
    "label_cleanup": label_cleanup,
    "label_missing_counts": label_missing_counts,
    "shared_columns": shared_columns,
    "unknown_bucket": unknown_bucket,
    "union_by_name": union_by_name,
    # profiling
    "value_counts": value_counts,
    "label_index_pairs": label_index_pairs,
    "counts_per_source": counts_per_source,
    "counts_per_file": counts_per_file,
    "null_profile": null_profile,
    "dataset_shape": dataset_shape,
    "column_profile": column_profile,
    "impute_mean": impute_mean,
    "throughput": throughput_q,
    "stream_throughput": stream_throughput,
    "stream_running_total": stream_running_total,
    "retain_newest_bytes": retain_newest_bytes,
    "retain_newest_documents": retain_newest_documents_q,
    # features
    "string_index": string_index,
    "string_index_multi": string_index_multi,
    "string_index_join": string_index_join,
    "alphabetical_index": alphabetical_index,
    "index_unseen": index_unseen,
    "drop_stage": drop_stage_q,
    "assemble_features": assemble_features,
    "train_test_split": train_test_split_q,
    "index_to_label": index_to_label,
    # evaluation
    "accuracy_f1": accuracy_f1_q,
    "auc": auc,
    # models
    "train_rf": train_rf,
    "train_lr": train_lr,
    "model_roundtrip": model_roundtrip,
    "scored_columns": scored_columns,
    "train_gbt": train_gbt,
    "train_gbt_ovr": train_gbt_ovr,
    "batch_score": batch_score,
    "score_conformed": score_conformed,
    "stream_score": stream_score,
    # serving
    "fetch_first_100": fetch_first_100,
    "latest_predictions": latest_predictions,
    "top_confidence": top_confidence,
    "by_attack_type": by_attack_type,
    "by_offset": by_offset,
    "lookup_offset": lookup_offset,
    "alerts": alerts,
    "attack_distribution": attack_distribution,
    "total_predictions": total_predictions,
    "prediction_counts": prediction_counts,
    "label_counts": label_counts,
}
