"""DuckDB SQL equivalents of the registered queries (the correctness gate).

Each string runs on the pre-registered table views.  For fitted models the
SQL states what a right fit gives on a label that is a rule of the features:
every row's key and label, predictions and confidences within their range,
and an accuracy over the bound.
"""

from __future__ import annotations

SPLIT = 3435973836  # int(0.8 * 2^32)


def flag(key: str, seed: int = 42) -> str:
    """The hash split of ``features.train_flag`` in SQL (exact, no overflow)."""
    return (f"(((({key})::HUGEINT * 2654435761 + {seed}) % 4294967296 + 4294967296) "
            f"% 4294967296 < {SPLIT})")


# Events with missing values by rule (same rule as standins.missing_by_rule).
MISSING = """m as (
  select event_id, ts,
         case when event_id % 10 = 2 then null else user_id end as user_id,
         case when event_id % 10 = 3 then null else event_type end as event_type,
         case when event_id % 10 < 2 then null
              when event_id % 10 = 4 then 'nan'::double else value end as value
  from events)"""

# Envelope columns of the stand-in stream.
ENVELOPE = """'demo' as topic, (event_id % 6)::int as "partition",
  (event_id // 6)::bigint as "offset", ts as "timestamp\""""

# Frequency index of the event type (StringIndexer order: count desc, value asc).
EVENT_INDEX = """idx as (
  select event_type, (row_number() over (order by n desc, event_type) - 1)::double as i
  from (select event_type, count(*) as n from events group by event_type))"""

# Prediction documents of the stand-in scorer.
DOCS = EVENT_INDEX + """,
docs as (
  select e.event_id, e.event_type as attack_type,
         round(e.value / (1 + e.value), 6) as confidence, idx.i as prediction,
         e.ts as "timestamp", e.ts::date as event_date, (e.event_id % 6)::int as "partition",
         (e.event_id // 6)::bigint as "offset"
  from events e join idx on e.event_type = idx.event_type)"""

DECODED_V1 = f"""select 0::int as id, event_id::int as event_id, user_id::int as user_id,
  event_type, value::float as value,
  (case when event_id * 1000003 > 2147483647 then 0 else event_id * 1000003 end)::int as stcpb,
  {ENVELOPE}
from events"""

LINEITEM_TYPES = [
    ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
    ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
    ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
    ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz"),
]

EVENT_VOCAB = ["view", "click", "purchase", "signup", "error"]


def _vocab_case(expr: str, vocab: list[str]) -> str:
    whens = " ".join(f"when '{v}' then {i}" for i, v in enumerate(vocab))
    return f"case {expr} {whens} end"


def _column_profile() -> str:
    def present(c, t):
        return f"count_if({c} is not null and not isnan({c}))" if t == "double" else f"count({c})"
    parts = [f"select '{c}' as column_name, '{t}' as data_type, {present(c, t)}::bigint as non_null "
             f"from lineitem" for c, t in LINEITEM_TYPES]
    return "\nunion all ".join(parts)


def _null_profile() -> str:
    cols = [("event_id", "event_id is null"), ("ts", "ts is null"),
            ("user_id", "user_id is null"), ("event_type", "event_type is null"),
            ("value", "value is null or isnan(value)")]
    body = "\nunion all ".join(
        f"select '{c}' as column_name, count_if({cond})::bigint as n_missing from m" for c, cond in cols)
    return f"with {MISSING}\n{body}"


# Labels as standing in raw files: missing, padded or in capitals by rule.
MESSY = """r as (
  select event_id,
    case when event_id % 10 = 3 then null
         when event_id % 10 = 6 then '  ' || event_type || ' '
         when event_id % 10 = 9 then upper(event_type)
         else event_type end as raw_label
  from events)"""

_VOCAB_LIST = ", ".join(f"'{v}'" for v in EVENT_VOCAB)

def _bands(c: str, low: float, high: float, *names: str) -> str:
    return f"case when {c} < {low} then '{names[0]}' when {c} < {high} then '{names[1]}' else '{names[2]}' end"


def _model(keys: str, label: str, rows: str) -> str:
    return (f"select {keys}, {label} as label, true as in_vocabulary, true as confidence_ok, true as accurate "
            f"from {rows}")


EMBEDDING_LABEL = _bands("embedding[3]", -0.05, 0.05, "low", "mid", "high")
EMBEDDING_CLASS = "'class_' || (" + " + ".join(
    f"(embedding[3] >= {x})::int" for x in (-0.16, -0.11, -0.08, -0.05, 0.0, 0.05, 0.08, 0.11, 0.16)) + ")"
LABELLED_TEST = f"documents join labels using (doc_id) where not {flag('doc_id')}"

ORACLE: dict[str, str] = {
    "stream_append": DECODED_V1,
    "stream_restart": DECODED_V1,
    "decode_kafka_json": DECODED_V1,
    "decode_lenient": f"""select 0::bigint as id, event_id, user_id, event_type, value,
  event_id * 1000003 as stcpb, {ENVELOPE}
from events""",
    "quarantine": f"""select case when event_id % 10 = 7 then 'not json {{' end as _corrupt_record, {ENVELOPE}
from events where event_id % 10 in (7, 8)""",
    "quarantine_good": f"""select null::bigint as id, event_id, user_id, event_type, value,
  event_id * 1000003 as stcpb, {ENVELOPE}
from events where event_id % 10 not in (7, 8)""",
    "decode_props": "select event_id, json_extract_string(props, '$.k')::bigint as k from events",
    "encode_json": """select event_id,
  to_json({'event_id': event_id, 'user_id': user_id, 'event_type': event_type})::varchar as value
from events""",
    "first_n_rows": "select * from lineitem order by l_orderkey, l_linenumber limit 2000",
    "csv_roundtrip": "select * from lineitem",
    "headerless_csv": "select * from lineitem",
    "fill_missing_zero": f"""with {MISSING}
select event_id, coalesce(user_id, 0)::bigint as user_id,
  case when value is null or isnan(value) then 0::double else value end as value, event_type
from m""",
    "cast_rate": """select event_id,
  try_cast(case when event_id % 10 = 3 then 'n/a' when event_id % 10 = 5 then null
                else value::varchar end as double) as rate
from events""",
    "derive_label": "select doc_id, quality::varchar as label from labels",
    "conform_schema": """select l_orderkey, l_quantity, 'nan'::double as rate, l_extendedprice,
  l_discount, l_returnflag, 0 as l_comment
from lineitem""",
    "numeric_columns": """select l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
  l_discount, l_tax from lineitem""",
    "drop_columns": """select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
  l_extendedprice, l_discount, l_tax from lineitem""",
    "schema_diff": """with l as (select distinct lower(column_name) as c from information_schema.columns
                where table_name = 'documents'),
     r as (select distinct lower(column_name) as c from information_schema.columns
                where table_name = 'labels')
select coalesce(l.c, r.c) as column_name,
  case when l.c is not null and r.c is not null then 'both'
       when l.c is not null then 'left' else 'right' end as side
from l full outer join r on l.c = r.c""",
    "label_code_map": f"""select event_id, event_type,
  {_vocab_case('event_type', EVENT_VOCAB[:4])} as code from events""",
    "label_cleanup": f"""with {MESSY},
c as (select event_id, coalesce(trim(raw_label), 'view') as t from r),
l as (select event_id, case when t in ({_VOCAB_LIST}) then t else '__unknown__' end as label from c)
select event_id, label, {_vocab_case('label', EVENT_VOCAB)} as code from l""",
    "label_missing_counts": f"""with {MESSY}
select count(*)::bigint as n_rows, count_if(raw_label is null)::bigint as n_missing,
  count_if(trim(raw_label) in ({_VOCAB_LIST}))::bigint as n_mapped,
  count_if(trim(raw_label) not in ({_VOCAB_LIST}))::bigint as n_unmapped from r""",
    "shared_columns": "select l_orderkey, l_quantity, l_extendedprice, l_discount, l_returnflag from lineitem",
    "unknown_bucket": f"""with o as (select o_orderkey, o_custkey::varchar as customer,
                  {flag('o_orderkey')} as tr from orders),
     seen as (select distinct customer from o where tr)
select o.o_orderkey, case when s.customer is not null then o.customer else 'Unknown' end as customer
from o left join seen s on o.customer = s.customer
where not o.tr""",
    "union_by_name": f"""select * from orders where {flag('o_orderkey')}
union all by name
select o_totalprice, o_orderkey, o_custkey, o_orderstatus, o_orderdate
from orders where not {flag('o_orderkey')}""",
    "value_counts": """select event_type, count(*)::bigint as "count" from events
where event_type is not null group by event_type""",
    "label_index_pairs": f"""with {EVENT_INDEX}
select e.event_type as label, idx.i as label_index, count(*)::bigint as "count"
from events e join idx on e.event_type = idx.event_type
group by e.event_type, idx.i""",
    "counts_per_source": """select d.source, grouping(d.source)::bigint as is_total, count_if(l.toxic = 1)::bigint as n_pos,
  count_if(l.toxic = 0)::bigint as n_neg, count(*)::bigint as n_rows
from documents d join labels l on d.doc_id = l.doc_id
group by rollup (d.source)""",
    "counts_per_file": """select f.file_name, grouping(f.file_name)::bigint as is_total, count_if(l.toxic = 1)::bigint as n_pos,
  count_if(l.toxic = 0)::bigint as n_neg, count(*)::bigint as n_rows
from (select 'documents.parquet' as file_name, doc_id from documents) f join labels l on f.doc_id = l.doc_id
group by rollup (f.file_name)""",
    "null_profile": _null_profile(),
    "dataset_shape": """select count(*)::bigint as n_rows,
  (select count(*) from information_schema.columns where table_name = 'lineitem')::bigint as n_columns
from lineitem""",
    "column_profile": _column_profile(),
    "impute_mean": f"""with {MISSING},
mu as (select avg(value) as mu from m where value is not null and not isnan(value))
select event_id,
  round(case when value is null or isnan(value) then (select mu from mu) else value end, 6) as value
from m""",
    "throughput": """with c as (select date_trunc('hour', ts) as bucket, count(*)::bigint as n
           from events group by 1)
select bucket, n, (sum(n) over (order by bucket))::bigint as running_total,
  n > 1.5 * (select avg(n) from c) as spike
from c""",
    "stream_throughput": """select date_trunc('hour', ts) as bucket, count(*)::bigint as n
from events group by 1""",
    "retain_newest_bytes": """with s as (
  select event_id // 100 as batch_id,
    sum(strlen(to_json({'event_id': event_id, 'user_id': user_id,
                        'event_type': event_type})::varchar))::bigint as bytes
  from events group by 1),
c as (select batch_id, bytes, (sum(bytes) over (order by batch_id desc))::bigint as cum_bytes from s)
select batch_id, bytes, cum_bytes from c where cum_bytes <= 262144""",
    "retain_newest_documents": """with s as (
  select event_id, ts, strlen(to_json({'event_id': event_id, 'user_id': user_id,
                                       'event_type': event_type})::varchar)::bigint as bytes from events),
c as (select *, sum(bytes) over (order by ts desc, event_id desc) as upto from s)
select event_id, ts, bytes from c where upto <= 262144""",
    "string_index": f"""with {EVENT_INDEX}
select e.event_id, idx.i as event_type_index from events e join idx on e.event_type = idx.event_type""",
    "string_index_multi": """with rf as (
  select l_returnflag, (row_number() over (order by n desc, l_returnflag) - 1)::double as i
  from (select l_returnflag, count(*) as n from lineitem group by 1)),
ls as (
  select l_linestatus, (row_number() over (order by n desc, l_linestatus) - 1)::double as i
  from (select l_linestatus, count(*) as n from lineitem group by 1))
select l.l_orderkey, l.l_linenumber, rf.i as l_returnflag_index, ls.i as l_linestatus_index
from lineitem l join rf on l.l_returnflag = rf.l_returnflag
               join ls on l.l_linestatus = ls.l_linestatus""",
    "string_index_join": """with idx as (
  select part, (row_number() over (order by n desc, part) - 1)::double as i
  from (select l_partkey::varchar as part, count(*) as n from lineitem group by 1))
select l_orderkey, l_linenumber, i as part_index from lineitem join idx on l_partkey::varchar = part""",
    "alphabetical_index": """select event_id, (dense_rank() over (order by event_type) - 1)::double
  as event_type_index from events""",
    "index_unseen": """with seen as (
  select event_type, (row_number() over (order by event_type) - 1)::double as i
  from (select distinct event_type from events where event_type <> 'click'))
select e.event_id, coalesce(seen.i, (select count(*) from seen)::double) as event_type_index
from events e left join seen on e.event_type = seen.event_type""",
    "drop_stage": """with rf as (
  select l_returnflag, (row_number() over (order by n desc, l_returnflag) - 1)::double as i
  from (select l_returnflag, count(*) as n from lineitem group by 1))
select l.l_orderkey, l.l_linenumber, rf.i as l_returnflag_index
from lineitem l join rf on l.l_returnflag = rf.l_returnflag""",
    "assemble_features": f"""with {MISSING}
select event_id, coalesce(value, 'nan'::double) as f0,
  coalesce(user_id::double, 'nan'::double) as f1, event_id::double as f2, 3::bigint as n_features
from m""",
    "train_test_split": f"select event_id, {flag('event_id')} as is_train from events",
    "index_to_label": f"""with {EVENT_INDEX}
select e.event_id, idx.i as event_type_index, e.event_type as label
from events e join idx on e.event_type = idx.event_type""",
    "accuracy_f1": """with cm as (select quality as y, toxic as z, count(*)::double as n
            from labels group by 1, 2),
a as (select y as c, sum(n) as support, sum(case when y = z then n else 0 end) as tp
      from cm group by 1),
p as (select z as c, sum(n) as pred from cm group by 1),
f as (select a.support, a.tp,
        case when a.tp > 0 then 2 * (a.tp / p.pred) * (a.tp / a.support)
                              / ((a.tp / p.pred) + (a.tp / a.support))
             else 0::double end as f
      from a left join p on a.c = p.c)
select round(sum(tp) / sum(support), 9) as accuracy,
       round(sum(f * support) / sum(support), 9) as f1 from f""",
    "auc": """with d as (select l.quality as y, d.n_chars::double as x
           from labels l join documents d on l.doc_id = d.doc_id),
r as (select y, (rank() over (order by x))::double
              + ((count(*) over (partition by x))::double - 1) / 2 as rk from d),
s as (select sum(case when y = 1 then rk else 0 end)::double as sp,
             count_if(y = 1)::double as p, count_if(y = 0)::double as n from r)
select round((sp - p * (p + 1) / 2) / (p * n), 9) as auc from s""",
    "fetch_first_100": f"""with {DOCS}
select *, 'demo:' || "partition"::varchar || ':' || "offset"::varchar as doc_id
from docs order by "timestamp", "partition", "offset" limit 100""",
    "latest_predictions": f"""with {DOCS}
select * from docs order by "timestamp" desc, "partition" desc, "offset" desc limit 100""",
    "top_confidence": f"""with {DOCS}
select * from docs
order by confidence desc nulls last, "timestamp" desc, "partition" desc, "offset" desc limit 100""",
    "by_attack_type": f"with {DOCS}\nselect * from docs where attack_type = 'error'",
    "by_offset": f"""with {DOCS}
select * from docs order by "offset" desc, "partition" desc limit 100""",
    "lookup_offset": f"""with {DOCS}
select * from docs where "partition" = 3 and "offset" = 100""",
    "alerts": f"""with {DOCS}
select "timestamp" as created_at, attack_type, confidence, "partition", "offset"
from docs where attack_type <> 'view'""",
    "attack_distribution": f"""with {DOCS}
select attack_type, count(*)::bigint as "count" from docs group by attack_type""",
    "total_predictions": f"with {DOCS}\nselect count(*)::bigint as total from docs",
    "prediction_counts": f"""with {DOCS}
select prediction, count(*)::bigint as "count" from docs group by prediction""",
    "label_counts": f"""with {DOCS}
select attack_type as prediction_label, count(*)::bigint as "count" from docs group by attack_type""",
    "train_rf": _model("vec_id", EMBEDDING_LABEL, f"embeddings where not {flag('vec_id')}"),
    "train_gbt_ovr": _model("vec_id, true as has_confidence", EMBEDDING_CLASS, f"embeddings where not {flag('vec_id')}"),
    "batch_score": _model("vec_id", EMBEDDING_LABEL, "embeddings"),
    "train_lr": _model("doc_id", "(n_chars >= 1500)::int", LABELLED_TEST),
    "model_roundtrip": _model("doc_id, true as same_after_load", "(n_chars >= 1500)::int", LABELLED_TEST),
    "scored_columns": f"""select doc_id, 3 as n_features, 2 as n_classes, true as sums_to_one,
  true as confidence_is_max, true as prediction_is_likeliest
from {LABELLED_TEST}""",
    "train_gbt": _model("doc_id", "(n_chars >= 1500)::int", LABELLED_TEST),
    "score_conformed": _model(
        "l_orderkey, l_linenumber", _bands("l_quantity", 17, 34, "A", "N", "R"),
        f"lineitem where not {flag('(l_orderkey * 8 + l_linenumber)')}"),
    "stream_score": _model("event_id, true as same_as_batch", _bands("value", 20, 55, "view", "click", "error"), "events"),
}

# The same rows by another way.
ORACLE["headerless_bad_bytes"] = ORACLE["headerless_csv"]
ORACLE["stream_running_total"] = ORACLE["throughput"]
ORACLE["stream_committed"] = DECODED_V1
ORACLE["stream_once"] = """select event_id, event_type, 'demo' as topic, (event_id % 6)::int as "partition",
  (event_id // 6)::bigint as "offset" from events"""
ORACLE["stream_ordered_files"] = """select event_id, event_type, (15 - event_id % 16)::int as file_number,
  row_number() over (partition by event_id % 16 order by event_id) - 1 as row_number from events"""
