"""Static physical-plan summary of every registered query: shuffles, broadcasts,
nested-loop / cartesian joins, windows, Python nodes. Usage:
python scripts/plan_audit.py [sf_dir] > docs/PLANS.md"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from weir.plans import catalog  # noqa: E402
from weir.plans.pipeline import flagship  # noqa: E402
from weir.session import build_session  # noqa: E402

PATTERNS = {
    "shuffles": r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange RoundRobinPartitioning",
    "single-partition": r"Exchange SinglePartition",
    "broadcasts": r"BroadcastExchange",
    "nested-loop joins": r"BroadcastNestedLoopJoin",
    "cartesian": r"CartesianProduct",
    "sort-merge joins": r"SortMergeJoin",
    "windows": r"\bWindow \[",
    "python": r"ArrowEvalPython|MapInPandas|MapInArrow|FlatMapGroupsInPandas|PythonUDF",
}


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session()
    # A stream's plan is one per micro-batch: the table it leaves says nothing.
    plans = {"flagship": flagship, **{n: f for n, f in catalog.queries().items() if not n.startswith("stream_")}}
    print(f"# Physical plans at {os.path.basename(sf)} (static, before AQE re-planning)\n")
    print("| query | " + " | ".join(PATTERNS) + " | scans |")
    print("| --- | " + " | ".join("---" for _ in PATTERNS) + " | --- |")
    for name, fn in plans.items():
        df = fn(spark, sf)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            plan = df._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
        counts = [len(re.findall(p, plan)) for p in PATTERNS.values()]
        scans = sorted(set(re.findall(r"/([a-z]+)\.parquet", plan)))
        print(f"| `{name}` | " + " | ".join(str(c) for c in counts) + f" | {', '.join(scans)} |")


if __name__ == "__main__":
    main()
