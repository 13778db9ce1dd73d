"""Tabulate the executed (final adaptive) plan of each query.

    python scripts/plan_report.py [sf_dir] > PLANS.md

For every query: shuffle exchanges, broadcast exchanges, join strategies,
aggregation kinds, windows, Python (Arrow) stages, and whether each Parquet
scan reads a pruned schema / pushes filters.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from filingflow.plans.catalog import QUERIES  # noqa: E402
from filingflow.session import build_session  # noqa: E402


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    qe = df._jdf.queryExecution()
    return qe.executedPlan().toString()


def count(pattern: str, text: str) -> int:
    return len(re.findall(pattern, text))


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=16, app_name="filingflow-plans")
    rows = []
    for name in HEADLINE:
        plan = final_plan(QUERIES[name](spark, sf))
        scans = re.findall(r"FileScan parquet \[([^\]]*)\].*?PushedFilters: \[([^\]]*)\]", plan)
        pushed = sum(1 for _, f in scans if f.strip())
        rows.append(
            (
                name,
                count(r"Exchange (hash|range|rebalance|Single|Round)", plan),
                count(r"BroadcastExchange", plan),
                count(r"BroadcastHashJoin", plan),
                count(r"SortMergeJoin", plan),
                count(r"HashAggregate", plan) + count(r"SortAggregate", plan) + count(r"ObjectHashAggregate", plan),
                count(r"\bWindow \[", plan),
                count(r"MapInPandas|ArrowEvalPython|FlatMapGroupsInPandas", plan),
                f"{len(scans)} ({pushed} with pushed filters)",
            )
        )
    spark.stop()
    print("| query | shuffles | broadcasts | BHJ | SMJ | aggregates | windows | python stages | parquet scans |")
    print("|---|---|---|---|---|---|---|---|---|")
    for r in rows:
        print("| " + " | ".join(str(x) for x in r) + " |")


if __name__ == "__main__":
    main()
