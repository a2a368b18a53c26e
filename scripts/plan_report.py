"""Explain every registered query and flag plan shapes that do not scale.

For each query: number of shuffles (Exchange), broadcasts, whether any
exchange funnels everything into ONE partition (global sort / window /
limit without top-k), nested-loop or cartesian joins, scans and their
ReadSchema width.  Model queries (which run jobs while being built) are
skipped unless named.

    python scripts/plan_report.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from flowscore.plans.catalog import QUERIES  # noqa: E402
from flowscore.session import get_session  # noqa: E402

SKIP = {"model_roundtrip", "scored_columns", "train_rf", "train_lr", "train_gbt", "train_gbt_ovr", "batch_score", "score_conformed",
        "stream_score", "stream_append", "stream_restart", "stream_throughput", "csv_roundtrip",
        "headerless_csv", "auc"}


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _single_partition_consumers(plan: str) -> list[str]:
    """Operator directly above each SinglePartition exchange."""
    lines = plan.splitlines()
    out = []
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line and i > 0:
            m = re.search(r"([A-Z][A-Za-z]+)", lines[i - 1])
            out.append(m.group(1) if m else "?")
    return out


def report(name: str, df) -> str:
    p = plan_text(df)
    shuffles = len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition)", p))
    bcast = p.count("BroadcastExchange")
    bad_join = ("BroadcastNestedLoopJoin" in p) or ("CartesianProduct" in p)
    topk = "TakeOrderedAndProject" in p
    scans = re.findall(r"ReadSchema: struct<([^\n]*)", p)
    widths = [s.count(":") for s in scans]
    consumers = _single_partition_consumers(p)
    global_agg = sum(1 for c in consumers if c in ("HashAggregate", "ObjectHashAggregate", "SortAggregate"))
    other = [c for c in consumers if c not in ("HashAggregate", "ObjectHashAggregate", "SortAggregate")]
    flags = []
    if global_agg:
        flags.append(f"global-agg-final x{global_agg} (partials only)")
    if other:
        flags.append("ONE-TASK " + ",".join(other))
    if bad_join:
        flags.append("NESTED-LOOP/CARTESIAN")
    return (f"{name:22s} shuffles={shuffles} broadcasts={bcast} topk={topk} "
            f"scans={len(scans)} read_cols={widths} {' '.join(flags)}")


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_session("local[8]", shuffle_partitions=8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # show the static plan
    for name, fn in QUERIES.items():
        if (names and name not in names) or (not names and name in SKIP):
            continue
        print(report(name, fn(spark, sf_dir)))


if __name__ == "__main__":
    main()
