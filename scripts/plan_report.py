"""Physical-plan summary of every registered query (after execution, AQE final plan).

    python scripts/plan_report.py [--sf-dir DIR] > PLANS.md

Per query: shuffles, join strategies, aggregate kinds, windows, explodes and
what reaches each Parquet scan (columns read, pushed filters).
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarize(plan: str) -> dict[str, str]:
    lines = plan.split("\n")

    def count(pat):
        return sum(1 for ln in lines if re.search(pat, ln))

    joins = sorted({m.group(1) + " " + (m.group(2) or "") for ln in lines
                    for m in [re.search(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|"
                                        r"BroadcastNestedLoopJoin|CartesianProduct)\s+.*?\b(LeftOuter|Inner|"
                                        r"LeftSemi|LeftAnti|RightOuter|FullOuter)?\b", ln)] if m})
    aggs = {k: count(k + r"\(") for k in ("HashAggregate", "SortAggregate", "ObjectHashAggregate")}
    scans = []
    for ln in lines:
        if "FileScan" in ln:
            cols = re.search(r"ReadSchema: struct<([^>]*)>", ln)
            pushed = re.search(r"PushedFilters: \[([^\]]*)\]", ln)
            table = re.search(r"file:[^\]]*/([a-z_]+)\.parquet", ln)
            ncols = len(re.findall(r"\w+:", cols.group(1))) if cols else 0
            scans.append(f"{table.group(1) if table else 'files'}({ncols} cols"
                         + (f"; {pushed.group(1)}" if pushed and pushed.group(1) else "") + ")")
    return {
        "shuffles": str(count(r"Exchange (hash|range|RoundRobin|SinglePartition)")),
        "reused": str(count(r"ReusedExchange")),
        "broadcasts": str(count(r"BroadcastExchange")),
        "joins": ", ".join(j.strip() for j in joins) or "-",
        "aggregates": ", ".join(f"{k} {v}" for k, v in aggs.items() if v) or "-",
        "windows": str(count(r"\bWindow \[")),
        "explodes": str(count(r"Generate (explode|posexplode|inline)")),
        "scans": "; ".join(scans) or "-",
    }


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.1")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    from pulsekit.plans.queries import queries
    from pulsekit.session import build_session
    spark = build_session("local[8]", shuffle_partitions=8)
    qs = queries()
    cols = ["shuffles", "reused", "broadcasts", "joins", "aggregates", "windows", "explodes", "scans"]
    print("| query | " + " | ".join(cols) + " |")
    print("| --- " * (len(cols) + 1) + "|")
    for name in args.names or [n for n in qs if not n.startswith("bpm_predict")]:
        df = qs[name](spark, args.sf_dir)
        df._jdf.queryExecution().toRdd().count()  # runs this very plan, so AQE has its final form
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        s = summarize(plan)
        print(f"| {name} | " + " | ".join(s[c] for c in cols) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
