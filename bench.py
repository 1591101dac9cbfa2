"""Benchmark the headline queries; prints ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

``BENCH_REPEAT`` timed runs per query; every DataFrame is fully computed
into the ``noop`` sink (all rows produced, none kept).  Time includes
plan building and any fitting a query does (medians, k-NN levels).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["describe_numeric", "cost_rating_crosstab", "cuisine_counts_all", "impute_knn",
            "clean_table", "spark_regression"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    from forkcast.session import build_session
    from forkcast.plans.catalog import QUERIES
    spark = build_session(f"local[{cpus}]", app="forkcast-bench", shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus * 2)))
    times = {}
    for name in names:
        run = QUERIES[name]
        samples = []
        for i in range(repeat + 1):
            t0 = time.perf_counter()
            run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            if i > 0:
                samples.append(dt)
        times[name] = round(statistics.median(samples), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "headline_total_median_sec", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
           "cpus": cpus, "repeat": repeat, "spark": spark.version,
           "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions"))}
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
