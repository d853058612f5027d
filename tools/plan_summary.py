"""Summarise the executed physical plans of the headline queries.

usage: python tools/plan_summary.py [sf_dir] > PLANS.md
For each query: counts of shuffles, broadcast and sort-merge joins,
WindowGroupLimit (map-side top-k), aggregates, and every Parquet scan with
its pushed filters and read schema.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

HASH_AGG = r"HashAggregate\("
SORT_AGG = r"SortAggregate\("
HEADLINE = ["master", "tag_similarity_all", "cohort_profile", "recommend", "segment_top_items"]


def summarise(name: str, plan: str) -> list[str]:
    count = lambda pat: len(re.findall(pat, plan))
    out = [f"## {name}", "",
           f"- shuffles (Exchange hashpartitioning/rangepartitioning): "
           f"{count(r'Exchange (?:hash|range)partitioning')}",
           f"- broadcast exchanges: {count(r'BroadcastExchange')}; broadcast hash joins: "
           f"{count(r'BroadcastHashJoin')}; sort-merge joins: {count(r'SortMergeJoin')}",
           f"- map-side top-k (WindowGroupLimit ... Partial): {count(r'WindowGroupLimit.*Partial')}",
           f"- hash aggregates: {count(HASH_AGG)}; sort aggregates: {count(SORT_AGG)}",
           f"- cartesian / nested-loop joins: {count(r'CartesianProduct|BroadcastNestedLoopJoin')}; "
           f"python evaluation nodes: {count(r'EvalPython|InPandas')}",
           "", "scans:", ""]
    seen = set()
    for m in re.finditer(r"FileScan parquet \[[^\]]*\][^\n]*", plan):
        line = m.group(0)
        loc = re.search(r"Location: \S+ \[([^\]]*)\]|Location: [^\[]*\[([^\]]*)\]", line)
        path = (loc.group(1) or loc.group(2)) if loc else "?"
        path = re.sub(r"^file:", "", path).replace("/root/testdata/", "")
        path = re.sub(r"/tmp/checkpoints/([a-z-]+)-[0-9a-f]+", r"<checkpoint>/\1", path)
        pushed = re.search(r"PushedFilters: (\[[^\]]*\])", line)
        schema = re.search(r"ReadSchema: (\S.*?)\s*$", line)
        entry = f"- `{path}` pushed {pushed.group(1) if pushed else '[]'} read `{schema.group(1) if schema else '?'}`"
        if entry not in seen:
            seen.add(entry)
            out.append(entry)
    return out + [""]


def main() -> None:
    from playlens.plans.registry import QUERIES
    from playlens.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 32)
    spark.sparkContext.setLogLevel("ERROR")
    lines = ["# Executed plans of the headline queries", "",
             f"Generated by `tools/plan_summary.py` on `{sf.replace('/root/testdata/', '')}` "
             "(final AQE plans after execution).", ""]
    for name in HEADLINE:
        df = QUERIES[name](spark, sf)
        df.collect()  # runs this very plan, so that what is shown is final
        plan = df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
        lines += summarise(name, plan)
    print("\n".join(lines))


if __name__ == "__main__":
    main()
