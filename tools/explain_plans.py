"""Print the formatted physical plan of registered queries, with a short
count of exchanges, joins and scans (pushdown shows as PushedFilters /
ReadSchema in the scan nodes).

usage: python tools/explain_plans.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DEFAULT = ["model_frame", "first_order_cohort", "temporal_split", "describe_numeric", "corr_matrix",
           "compute_metrics", "tfidf"]


def summary(plan: str) -> str:
    keys = ["Exchange", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin", "HashAggregate",
            "SortAggregate", "Window", "Scan parquet"]
    return ", ".join(f"{k}={len(re.findall(re.escape(k) + r' \(', plan))}" for k in keys)


def main():
    from rebuy.plans import catalog
    from rebuy.session import get_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or DEFAULT
    spark = get_session("local[8]", shuffle_partitions=8)
    qs = catalog.queries()
    for n in names:
        df = qs[n](spark, sf)
        plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        print(f"=== {n}: {summary(plan)}")
        print(plan)


if __name__ == "__main__":
    main()
