"""Per-key physical plan summary: scans, exchanges, broadcasts, top-k.

Usage: python scripts/plan_summary.py [sf_dir]  -> markdown table on stdout
Counts come from the executed (AQE initial) plan before any job runs.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pitchside.registry import QUERIES, SIDE_EFFECT_KEYS  # noqa: E402
from pitchside.session import build_session  # noqa: E402


def summarize(plan: str) -> dict:
    lines = plan.splitlines()
    scans = [re.search(r"\[file:[^\]]*/([^/\]]+)\]", l) for l in lines if "FileScan" in l]
    counts: dict[str, int] = {}
    for m in scans:
        if m:
            name = m.group(1).replace(".parquet", "")
            counts[name] = counts.get(name, 0) + 1
    return {
        "scans": ", ".join(f"{k} x{v}" for k, v in sorted(counts.items())) or "-",
        "shuffles": sum(1 for l in lines if "Exchange hashpartitioning" in l or "Exchange rangepartitioning" in l
                        or "Exchange SinglePartition" in l or "Exchange RoundRobin" in l),
        "broadcasts": sum(1 for l in lines if "BroadcastExchange" in l),
        "topk": "yes" if any("TakeOrderedAndProject" in l for l in lines) else "",
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    print("| key | files scanned | shuffles | broadcasts | top-k |")
    print("| --- | --- | --- | --- | --- |")
    for key in sorted(QUERIES):
        if key in SIDE_EFFECT_KEYS:
            continue
        plan = QUERIES[key](spark, sf)._jdf.queryExecution().executedPlan().toString()
        s = summarize(plan)
        print(f"| `{key}` | {s['scans']} | {s['shuffles']} | {s['broadcasts']} | {s['topk']} |")
    spark.stop()


if __name__ == "__main__":
    main()
