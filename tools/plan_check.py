"""Scan the physical plan of every catalogue query for operators that do
not scale: cartesian products, nested-loop joins and row-at-a-time Python
UDFs.  Queries that fit models run their fits while building and are
skipped unless named.

    python tools/plan_check.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

BAD = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")
MODEL_QUERIES = {"spark_regression", "spark_classification", "spark_ml_metrics", "sgd_fit", "pca_ols", "logreg",
                 "random_forest", "rff_svm", "mlp", "metrics_json", "feature_profile", "feature_describe"}


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    from forkcast.plans.catalog import QUERIES
    from forkcast.session import build_session
    spark = build_session("local[8]", shuffle_partitions=8)
    names = a.names or [n for n in QUERIES if n not in MODEL_QUERIES]
    bad = 0
    for n in names:
        plan = QUERIES[n](spark, a.sf)._jdf.queryExecution().executedPlan().toString()
        hits = [b for b in BAD if b in plan]
        bad += bool(hits)
        print(f"{n:28s} {'BAD ' + ', '.join(hits) if hits else 'ok'}", flush=True)
    print(f"{len(names) - bad}/{len(names)} clean")
    spark.stop()


if __name__ == "__main__":
    main()
