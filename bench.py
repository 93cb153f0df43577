"""Bench: the reference's eight timed questions, source model vs star, on Spark.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

As in the reference timing script, both models are loaded first (staging and
mart build are reported, not counted), then each query gets one warm-up run
and BENCH_RUNS timed runs with every result row fetched; the per-query value
is the mean.  Prints one JSON line; ``value`` is the sum of the eight means.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["q1_source", "q1_star", "q2_source", "q2_star", "q3_source", "q3_star", "q4_source", "q4_star"]


def main() -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    from starmart.plans import catalog, registry
    from starmart.session import get_spark

    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=max(cpus, 2))
    t0 = time.perf_counter()
    dict(catalog.sources(spark, sf_dir))  # all tables, each made on first reading
    t1 = time.perf_counter()
    dict(catalog.mart(spark, sf_dir))
    t2 = time.perf_counter()
    qs = registry.queries()
    out = {}
    for name in HEADLINE:
        qs[name](spark, sf_dir).collect()          # warm-up
        times = []
        for _ in range(runs):
            s = time.perf_counter()
            qs[name](spark, sf_dir).collect()
            times.append(time.perf_counter() - s)
        out[name] = round(statistics.mean(times), 4)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "sum of mean query time, 8 reference questions (source + star)",
                      "value": round(sum(out.values()), 4), "unit": "sec", "queries": out,
                      "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "load_sec": {"staging": round(t1 - t0, 2), "mart_build": round(t2 - t1, 2)},
                      "cpus": cpus, "runs": runs}))
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
