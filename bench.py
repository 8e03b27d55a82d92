"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line. Each query is timed end to end including
runs (default 3), after one untimed warm-up query on the smallest tables.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "merged",            # forecast/observation join + error (BASELINE row 1)
    "stats",             # per-place aggregates (BASELINE row 2)
    "highest_forecast",  # table-wide arg-max (BASELINE row 3)
    "city_range",
    "city_detail",
    "upsert_merged",
    "upsert_stats",
    "validate_records",
    "flatten",
    "weather_pipeline",  # whole run: documents -> validated tables -> upsert -> snapshot
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    from skyfold.plans import catalog
    from skyfold.session import build_session

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus, app_name="skyfold-bench")
    qs = catalog.queries()
    warm = "/root/testdata/sf0.001"
    if os.path.isdir(warm):
        qs["stats"](spark, warm).collect()
    times: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in HEADLINE:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            n = len(qs[name](spark, sf_dir).collect())
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
        rows[name] = n
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "rows": rows,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "repeat": repeat,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
