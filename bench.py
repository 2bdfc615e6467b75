"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is run to completion with the ``noop`` sink (full evaluation, no
driver collect); one warm-up run, then the median of ``BENCH_RUNS`` timed
runs.  Prints one JSON line.
"""

from __future__ import annotations

import gc
import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from streamkit.plans.queries import QUERIES  # noqa: E402
from streamkit.session import build_session  # noqa: E402

HEADLINE = [
    "windowed_word_count",
    "word_count",
    "rolling_sum",
    "rolling_maxby",
    "count_sliding",
    "session_by_user",
    "session_by_type",
    "sliding_sum",
    "tumbling_sum",
    "global_concat",
    "split_select",
    "compound_growth",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session(f"local[{cpus}]", "streamkit-bench", shuffle_partitions=cpus,
                          extra_conf={"spark.driver.memory": "16g"})
    timings, errors = {}, {}
    for name in names:
        def once():
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

        # between queries (untimed): drop the previous query's objects so the
        # JVM frees its heap and the context cleaner removes its shuffle files
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        try:
            once()  # warm-up: JIT, file listing, broadcast of small side tables
            timings[name] = round(statistics.median(once() for _ in range(runs)), 3)
        except Exception as exc:  # noqa: BLE001 - report and go on with the other queries
            timings[name] = None
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "total_median_sec",
        "value": round(sum(v for v in timings.values() if v is not None), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
        "spark": spark.version,
        **({"errors": errors} if errors else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
