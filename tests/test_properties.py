"""Property tests, each example one DataFrame of many rows."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowscore.functions.json_codec import decode_json, encode_json
from flowscore.operators import profile as P
from flowscore.operators.features import index_stage
from flowscore.operators.score import decode_labels
from flowscore.schema import UNKNOWN_LABEL, wire_v2

FIELDS = [("a", "i"), ("b", "f"), ("c", "s")]
SCHEMA = "a bigint, b double, c string"

records = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(-(2**63), 2**63 - 1)),
              st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False)),
              st.one_of(st.none(), st.text(max_size=12))),
    min_size=1, max_size=60)

labels = st.lists(st.one_of(st.none(), st.sampled_from(["dos", "worms", "normal", "x y", "É"])),
                  min_size=1, max_size=80)

SETTINGS = settings(max_examples=6, deadline=None)


@SETTINGS
@given(records)
def test_decode_of_encode_is_identity(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    enc = encode_json(df).select(F.col("value").cast("binary").alias("value"))
    back = decode_json(enc, wire_v2(FIELDS), keep=[])
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)


@SETTINGS
@given(labels)
def test_class_counts_add_up(spark, vals):
    df = spark.createDataFrame([(v,) for v in vals], "y string")
    counts = P.value_counts(df, "y").agg(F.sum("count")).first()[0] or 0
    assert counts == sum(v is not None for v in vals)
    by = P.counts_by(df, "y").agg(F.sum("count")).first()[0]
    assert by == len(vals)


@SETTINGS
@given(labels)
def test_index_then_label_is_identity(spark, vals):
    df = spark.createDataFrame([(v,) for v in vals], "y string")
    m = index_stage("y").fit(df)
    out = decode_labels(m.transform(df), list(m.labels) + [UNKNOWN_LABEL], prediction="y_index", out="back")
    for r in out.collect():
        assert r.back == (r.y if r.y is not None else UNKNOWN_LABEL)


def test_initial_shuffle_partitions_scale_with_cores():
    from flowscore.session import initial_shuffle_partitions
    assert initial_shuffle_partitions(8) == 200              # floor on small machines
    assert initial_shuffle_partitions(8000) == 32000         # 1,000 executors x 8 cores
