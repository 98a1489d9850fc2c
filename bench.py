"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed to completion into Spark's ``noop`` sink (every row
is computed, nothing is collected) and timed.  The model queries share one
fitted pipeline per session, as the original job does, so their times are
cumulative in the order below: ``model_leaderboard`` pays for the
preprocessing fit and the three classifiers.  Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from curata.session import local_session  # noqa: E402
from curata.plans.registry import QUERIES  # noqa: E402

HEADLINE = [
    "scan_encounters", "class_distribution", "missing_rate", "numeric_histogram", "correlation_matrix",
    "noise_audit", "cleaning_audit", "clean_pipeline", "dedup_rows", "feature_table",
    "auc_roc", "classification_metrics", "confusion_matrix",
    "learning_curve_rows", "impute_median", "scale_features", "model_leaderboard", "learning_curve",
]


def run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [a for a in sys.argv[1:]]
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")), app="curata-bench")
    warm = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.path.isdir(warm):
        run(spark, "scan_encounters", warm)
    times = {}
    for name in HEADLINE:
        if only and name not in only:
            continue
        times[name] = round(run(spark, name, sf_dir), 3)
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
