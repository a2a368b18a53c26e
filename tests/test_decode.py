"""Decode / encode edge cases (FIXTURES F8, SURVEY D1-D4)."""

import math

from pyspark.sql import functions as F

from flowscore.functions.json_codec import (decode_json, decode_json_lenient,
                                            decode_with_quarantine, encode_json)
from flowscore.operators.conform import fill_zero
from flowscore.schema import WIRE_FIELDS, wire_v1, wire_v2, numeric_wire_columns

FIELDS = [("stcpb", "i"), ("rate", "f"), ("proto", "s"), ("sbytes", "i")]


def _env(spark, payloads):
    rows = [(None if p is None else bytearray(p.encode()), "demo", 0, i) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, "value binary, topic string, partition int, offset bigint")


def test_wire_schema_has_43_fields_in_order():
    s = wire_v1()
    assert len(s.fields) == 43
    assert s.fields[0].name == "id" and s.fields[-1].name == "ct_dst_src_ltm"
    assert len(numeric_wire_columns()) == 40
    assert wire_v2()["stcpb"].dataType.simpleString() == "bigint"


def test_int32_overflow_becomes_null_then_zero(spark):
    df = decode_json(_env(spark, ['{"stcpb": 4294958913, "sbytes": 5}']), wire_v1(FIELDS))
    r = df.first()
    assert r.stcpb is None
    assert fill_zero(df, ["stcpb", "rate", "sbytes"]).first().stcpb == 0


def test_lenient_decode_recovers_big_fractional_and_text_numbers(spark):
    env = _env(spark, ['{"stcpb": 4294958913}', '{"stcpb": 0.0}', '{"stcpb": "7"}'])
    vals = [r.stcpb for r in decode_json_lenient(env, FIELDS).orderBy("offset").collect()]
    assert vals == [4294958913, 0, 7]


def test_faithful_decode_loses_float_and_text_in_int_field(spark):
    env = _env(spark, ['{"stcpb": 0.0, "sbytes": 3}', '{"stcpb": "7", "sbytes": 3}'])
    rows = decode_json(env, wire_v1(FIELDS)).orderBy("offset").collect()
    assert [r.stcpb for r in rows] == [None, None]
    assert [r.sbytes for r in rows] == [3, 3]


def test_nan_and_string_fields(spark):
    env = _env(spark, ['{"rate": NaN, "proto": 5}', '{"proto": null}', '{"extra": 1}'])
    rows = decode_json(env, wire_v1(FIELDS)).orderBy("offset").collect()
    assert math.isnan(rows[0].rate)
    assert rows[0].proto == "5"
    assert rows[1].proto is None and rows[2].proto is None
    filled = fill_zero(decode_json(env, wire_v1(FIELDS)), ["rate", "stcpb", "sbytes"]).orderBy("offset").collect()
    assert filled[0].rate == 0.0
    assert filled[1].proto is None  # strings are not filled


def test_malformed_and_null_payloads_are_quarantined(spark):
    env = _env(spark, ['{"stcpb": 1}', "not json", None, '{"stcpb": 2}'])
    good, bad = decode_with_quarantine(env, wire_v2(FIELDS))
    assert sorted(r.stcpb for r in good.collect()) == [1, 2]
    bad_rows = bad.orderBy("offset").collect()
    assert [r._corrupt_record for r in bad_rows] == ["not json", None]
    # without quarantine a malformed payload is a full row of nulls -> zeros
    plain = fill_zero(decode_json(env, wire_v1(FIELDS)), ["stcpb", "rate", "sbytes"])
    assert plain.where(F.col("offset") == 1).first().stcpb == 0


def test_decode_encode_round_trip(spark):
    src = spark.createDataFrame([(1, 2.5, "tcp", 10), (2, None, None, 20)],
                                "stcpb bigint, rate double, proto string, sbytes bigint")
    enc = encode_json(src).select(F.col("value").cast("binary").alias("value"))
    back = decode_json(enc, wire_v2(FIELDS), keep=[])
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, src.collect()), key=str)


def test_encode_omits_null_fields(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert encode_json(df).first().value == '{"a":1}'


def test_all_wire_fields_decode(spark):
    payload = "{" + ", ".join(f'"{n}": {("1" if c != "s" else chr(34) + "x" + chr(34))}'
                              for n, c in WIRE_FIELDS if n != "id") + "}"
    r = decode_json(_env(spark, [payload]), wire_v1()).first()
    assert r.id is None and r.proto == "x" and r.ct_dst_src_ltm == 1


def test_decode_of_one_field_parses_only_that_field(spark):
    """Catalyst prunes from_json to the used field (it never does when
    from_json carries an options map)."""
    df = decode_json(_env(spark, ['{"stcpb": 7, "proto": "tcp"}']), wire_v1())
    plan = df.select("proto")._jdf.queryExecution().optimizedPlan().toString()
    parse = next(line for line in plan.splitlines() if "from_json" in line)
    assert parse.count("StructField(") == 1 and "StructField(proto," in parse
    assert df.select("proto").first().proto == "tcp"
