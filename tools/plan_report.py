"""Summarise physical plans: scans, exchanges, join strategies, windows, pushed filters.

    python tools/plan_report.py [--sf DIR] [name ...]
"""
from __future__ import annotations

import argparse
import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from metroscope.plans.catalog import QUERIES  # noqa: E402
from metroscope.session import local_session  # noqa: E402

PATTERNS = {
    "scan": r"FileScan|Scan parquet",
    "exchange": r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition|Exchange RoundRobin",
    "single_partition": r"Exchange SinglePartition",
    "bhj": r"BroadcastHashJoin",
    "smj": r"SortMergeJoin",
    "bnlj": r"BroadcastNestedLoopJoin|CartesianProduct",
    "window": r"\bWindow\b",
    "expand": r"\bExpand\b",
    "python": r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas",
}


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    spark = local_session()
    for n in a.names or sorted(QUERIES):
        if n.startswith(("r1", "r2", "e1_", "e12", "s6", "s10")):
            continue  # these run jobs while building; plans of their final reads are trivial
        plan = QUERIES[n](spark, a.sf)._jdf.queryExecution().executedPlan().toString()
        counts = {k: len(re.findall(p, plan)) for k, p in PATTERNS.items()}
        pushed = sorted(set(re.findall(r"PushedFilters: \[([^\]]+)\]", plan)))
        print(n, counts, ("pushed=" + "; ".join(pushed)) if pushed else "")


if __name__ == "__main__":
    main()
