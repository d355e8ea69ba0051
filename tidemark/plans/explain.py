"""Summaries of physical plans, for reviewing what Spark will run.

``plan_summary(df)`` reads ``df.explain("formatted")`` and counts the
operators that matter at scale: shuffles (Exchange), join strategies,
aggregate kinds, windows, top-k, and the columns each file scan reads.
With AQE the plan is the initial one; joins may still become broadcast
joins at run time when a side turns out small.
"""

from __future__ import annotations

import contextlib
import io
import re
from collections import Counter

from pyspark.sql import DataFrame

OPERATORS = ("Exchange", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin",
             "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct",
             "HashAggregate", "ObjectHashAggregate", "SortAggregate", "Window",
             "TakeOrderedAndProject", "Generate", "Expand", "Union")


def formatted_plan(df: DataFrame) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def plan_summary(df: DataFrame) -> dict:
    text = formatted_plan(df)
    tree = text.split("\n\n", 1)[0]
    ops = Counter()
    for line in tree.splitlines():
        m = re.search(r"([A-Za-z]+)(?: [A-Za-z]+)* \(\d+\)", line)
        if m and m.group(1) in OPERATORS:
            ops[m.group(1)] += 1
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    pushed = [p for p in re.findall(r"PushedFilters: \[([^\]]*)\]", text) if p]
    return {
        "operators": {k: ops[k] for k in OPERATORS if ops[k]},
        "scans": len(scans),
        "max_scan_columns": max((s.count(":") for s in scans), default=0),
        "pushed_filters": len(pushed),
    }


def report(spark, sf_dir: str) -> str:
    """Markdown table of plan summaries for every registered query."""
    from tidemark.plans.registry import QUERIES

    cols = ["Exchange", "SortMergeJoin", "BroadcastHashJoin", "HashAggregate",
            "SortAggregate", "Window", "TakeOrderedAndProject"]
    lines = ["| query | " + " | ".join(cols) + " | scans | max scan cols | pushed filters |",
             "| --- |" + " --- |" * (len(cols) + 3)]
    for name, fn in QUERIES.items():
        s = plan_summary(fn(spark, sf_dir))
        ops = s["operators"]
        lines.append(f"| {name} | " + " | ".join(str(ops.get(c, 0)) for c in cols)
                     + f" | {s['scans']} | {s['max_scan_columns']} | {s['pushed_filters']} |")
    return "\n".join(lines)


if __name__ == "__main__":
    import os
    import sys

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    from tidemark.session import local_session

    print(report(local_session(), sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"))
