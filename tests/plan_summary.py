"""Summarise the physical plans of the registered queries.

Usage: python tests/plan_summary.py [sf_dir] [name ...]

For each query: scans (with their read columns), shuffle exchanges,
broadcast exchanges, join strategies, partial aggregates and Python nodes,
taken from ``explain("formatted")`` before execution.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarise(df) -> dict:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    p = buf.getvalue()
    nodes = re.findall(r"^\(\d+\) ([A-Za-z]+(?: [A-Za-z]+)?)", p, re.M)
    reads = re.findall(r"^ReadSchema: struct<(.*)>$", p, re.M)
    exch = re.findall(r"^Arguments: (hashpartitioning|rangepartitioning|"
                      r"SinglePartition|RoundRobinPartitioning)[^\n]*", p, re.M)
    joins = [n for n in nodes if n.endswith("Join") or "Join" in n]
    return {
        "scans": [",".join(sorted(c.split(":")[0] for c in
                                  re.split(r",(?![^<]*>)", r))) for r in reads],
        "shuffles": len(exch),
        "broadcasts": nodes.count("BroadcastExchange"),
        "joins": sorted(set(joins)),
        "partial_aggs": len(re.findall(r"partial_", p)),
        "python": bool(re.search(r"EvalPython|PythonUDF|ArrowEvalPython", p)),
    }


def main(argv):
    sf = argv[1] if len(argv) > 1 and argv[1].startswith("/") \
        else "/root/testdata/sf0.1"
    names = [a for a in argv[1:] if not a.startswith("/")]
    from chorus.session import build_session
    from chorus.plans.queries import QUERIES
    spark = build_session("local[8]")
    for n in names or sorted(QUERIES):
        if n in ("csv_roundtrip", "parquet_roundtrip", "csv_extract",
                 "stream_fact_comment"):
            continue  # these write before they return a plan
        print(n, summarise(QUERIES[n](spark, sf)), flush=True)


if __name__ == "__main__":
    main(sys.argv)
