"""Declared schemas and fixed vocabularies.

Everything under "Fixed values" must equal the reference application's
values for results to line up (field names and order, label codes, column
renames).  They are stated plainly, in their natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------

# Flow record on the wire: (name, type) in declaration order.  "i" = int32,
# "f" = float32, "s" = string.  `id` is declared but never sent.
WIRE_FIELDS = [
    ("id", "i"), ("rate", "f"), ("proto", "s"), ("state", "s"), ("dur", "f"),
    ("sbytes", "i"), ("dbytes", "i"), ("sttl", "i"), ("dttl", "i"),
    ("sloss", "i"), ("dloss", "i"), ("service", "s"), ("sload", "f"),
    ("dload", "f"), ("spkts", "i"), ("dpkts", "i"), ("swin", "i"),
    ("dwin", "i"), ("stcpb", "i"), ("dtcpb", "i"), ("smean", "i"),
    ("dmean", "i"), ("trans_depth", "i"), ("response_body_len", "i"),
    ("sjit", "f"), ("djit", "f"), ("sinpkt", "f"), ("dinpkt", "f"),
    ("tcprtt", "f"), ("synack", "f"), ("ackdat", "f"), ("is_sm_ips_ports", "i"),
    ("ct_state_ttl", "i"), ("ct_flw_http_mthd", "i"), ("is_ftp_login", "i"),
    ("ct_ftp_cmd", "i"), ("ct_srv_src", "i"), ("ct_srv_dst", "i"),
    ("ct_dst_ltm", "i"), ("ct_src_ltm", "i"), ("ct_src_dport_ltm", "i"),
    ("ct_dst_sport_ltm", "i"), ("ct_dst_src_ltm", "i"),
]

# Training table columns, in file order (45 columns).
TRAINING_COLUMNS = [
    "id", "dur", "proto", "service", "state", "spkts", "dpkts", "sbytes",
    "dbytes", "rate", "sttl", "dttl", "sload", "dload", "sloss", "dloss",
    "sinpkt", "dinpkt", "sjit", "djit", "swin", "stcpb", "dtcpb", "dwin",
    "tcprtt", "synack", "ackdat", "smean", "dmean", "trans_depth",
    "response_body_len", "ct_srv_src", "ct_state_ttl", "ct_dst_ltm",
    "ct_src_dport_ltm", "ct_dst_sport_ltm", "ct_dst_src_ltm",
    "is_ftp_login", "ct_ftp_cmd", "ct_flw_http_mthd", "ct_src_ltm",
    "ct_srv_dst", "is_sm_ips_ports", "attack_cat", "label",
]

# Columns never sent on the wire / never used as features.
DROPPED_ON_WIRE = ["attack_cat", "label", "id"]
EXCLUDED_FROM_FEATURES = ["label", "label_index", "id"]

# Categorical inputs and their indexed outputs.
CATEGORICAL_COLUMNS = ["proto", "state", "service"]
CATEGORICAL_INDEXED = ["proto_index", "state_index", "service_index"]

# Raw-file column renames (raw name -> training name), applied after lower-casing.
RAW_RENAMES = {
    "sintpkt": "sinpkt",
    "dintpkt": "dinpkt",
    "smeansz": "smean",
    "dmeansz": "dmean",
    "res_bdy_len": "response_body_len",
}

# Attack label vocabulary with fixed codes.
LABEL_CODES = {
    "Normal": 0,
    "Generic": 1,
    "Exploits": 2,
    "Fuzzers": 3,
    "DoS": 4,
    "Reconnaissance": 5,
    "Analysis": 6,
    "Backdoor": 7,
    "Shellcode": 8,
    "Worms": 9,
}
NORMAL_LABEL = "Normal"
UNKNOWN_CATEGORY = "Unknown"
UNKNOWN_LABEL = "__unknown__"

# Stream source settings.
TOPIC = "demo"
TOPIC_PARTITIONS = 6

# Size cap of the stored predictions (bytes), oldest evicted first.
PREDICTIONS_CAP_BYTES = 4294967296

# Spike rule: a bucket is a spike when its count exceeds this factor x base.
SPIKE_FACTOR = 1.5

# ---------------------------------------------------------------------------
# Derived schemas
# ---------------------------------------------------------------------------

_FAITHFUL = {"i": T.IntegerType(), "f": T.FloatType(), "s": T.StringType()}
_WIDENED = {"i": T.LongType(), "f": T.DoubleType(), "s": T.StringType()}

KAFKA_ENVELOPE = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
])
ENVELOPE_COLUMNS = ["topic", "partition", "offset", "timestamp"]


def struct_from_fields(fields, widened: bool = False) -> T.StructType:
    """Build a nullable StructType from (name, code) pairs."""
    mapping = _WIDENED if widened else _FAITHFUL
    return T.StructType([T.StructField(n, mapping[c], True) for n, c in fields])


def wire_v1(fields=WIRE_FIELDS) -> T.StructType:
    """The faithful wire schema: int32 / float32 / string."""
    return struct_from_fields(fields, widened=False)


def wire_v2(fields=WIRE_FIELDS) -> T.StructType:
    """Widened wire schema: int64 / float64 / string (no silent overflow)."""
    return struct_from_fields(fields, widened=True)


def numeric_wire_columns(fields=WIRE_FIELDS) -> list[str]:
    return [n for n, c in fields if c != "s"]


def training_features(columns=TRAINING_COLUMNS) -> list[str]:
    """Numeric feature columns of the training table (in file order)."""
    return [c for c in columns
            if c not in EXCLUDED_FROM_FEATURES + CATEGORICAL_COLUMNS + ["attack_cat"]]


def training_schema() -> T.StructType:
    """Declared schema of the training CSV (replaces type inference)."""
    wire = dict(WIRE_FIELDS)
    out = []
    for c in TRAINING_COLUMNS:
        if c == "attack_cat":
            out.append(T.StructField(c, T.StringType()))
        elif c == "label":
            out.append(T.StructField(c, T.IntegerType()))
        elif c == "rate" or wire.get(c) == "f":
            out.append(T.StructField(c, T.DoubleType()))
        elif wire.get(c) == "s":
            out.append(T.StructField(c, T.StringType()))
        else:
            out.append(T.StructField(c, T.LongType()))
    return T.StructType(out)


# ---------------------------------------------------------------------------
# Stand-in record built from the `events` table (same shape as a flow record:
# a declared-but-unsent id, int / float / string fields, and one counter that
# overflows int32).
# ---------------------------------------------------------------------------

STANDIN_FIELDS = [
    ("id", "i"), ("event_id", "i"), ("user_id", "i"), ("event_type", "s"),
    ("value", "f"), ("stcpb", "i"),
]
STANDIN_COUNTER_FACTOR = 1000003
