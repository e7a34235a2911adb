"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each query is fully computed into Spark's no-op sink (no driver transfer).
The first query builds the model frame from the raw parquet tables; later
analytics start from the checkpointed model frame / splits, as a pipeline
would.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "model_frame",          # cohort + label + 46-column features from raw tables
    "first_order_cohort",
    "temporal_split",
    "dataset_summary",
    "describe_numeric",
    "iqr_outliers",
    "corr_matrix",
    "target_corr",
    "welch_ttest",
    "state_rate",
    "compute_metrics",
    "roc_curve",
    "pr_curve",
    "calibration_curve",
    "threshold_sweep",
    "failure_analysis",
]
OPTIONAL = ["tabular_lr", "tabular_rf", "tfidf"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from rebuy.plans import catalog
    from rebuy.session import get_session

    spark = get_session(f"local[{cpus}]", app="rebuy-bench", shuffle_partitions=int(cpus) * 2)
    # warm-up outside the timings: JVM start and first job scheduling
    spark.range(10000).selectExpr("sum(id)").collect()
    qs = catalog.queries()
    names = [n for n in HEADLINE if n in qs] + [n for n in OPTIONAL if n in qs]
    times = {}
    for name in names:
        t0 = time.time()
        try:
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - t0, 3)
        except Exception as e:  # noqa: BLE001 - a failing query is reported, not fatal
            times[name] = None
            print(f"# {name} failed: {str(e)[:200]}", file=sys.stderr)
    done = [v for v in times.values() if v is not None]
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total_time",
        "value": round(sum(done), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
