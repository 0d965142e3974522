"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs to completion through the ``noop`` sink (the whole plan
executes; nothing is collected). Prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from knnrec.plans.queries import QUERIES  # noqa: E402
from knnrec.session import build_session, release_all  # noqa: E402

HEADLINE = [
    "mae_exact",            # full exact pipeline: stats, deviations, all pairs, top k, predict, MAE
    "mae_approx",           # partitioned approximate pipeline (10 parts, replication 2)
    "topk_neighbors",
    "similarity_all_pairs",
    "predict_pairs",
    "score_all_items",
    "matmul_hot_keys",      # few keys that nearly all users share: every key is split
    "recommend_top_n",
    "replication_sweep",    # six replication levels in one job
    "candidate_ratio",
    "ratings_parse",
    "usage_daily_cost",
    "breakeven_days",
    "budget_units_ratio",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus))
    # Warm the JVM (class loading, JIT, codegen caches) on the smallest data
    # set with the two pipelines; this run is not timed.
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    for name in ("mae_exact", "mae_approx"):
        QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
        release_all()
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()  # before the plan is built: analysis and schema reading count
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        release_all()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
