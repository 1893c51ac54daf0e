"""Benchmark: run every registered query of the review and event side over ``$BENCH_SF_DIR`` on
``local[$BENCH_CPUS]`` and print one JSON line.

Each query is executed in full with the ``noop`` sink (every row computed,
nothing collected to the driver), building its DataFrame inside the timer.
All queries run in ``BENCH_PASSES`` (default 2) passes over the list;
``queries`` holds each query's best time over the passes and ``value`` their
sum, damping the machine's run-to-run noise. Every pass's raw times are kept
under ``passes`` (the first is a cold JVM).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = set(filter(None, os.environ.get("BENCH_QUERIES", "").split(",")))
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else None

    from quire.session import build_session
    from quire.plans.catalog import QUERIES

    passes = int(os.environ.get("BENCH_PASSES", "2"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus, app_name="quire-bench")

    errors: dict[str, str] = {}

    def run_pass() -> dict[str, float | None]:
        times: dict[str, float | None] = {}
        for name, fn in QUERIES.items():
            if only and name not in only:
                continue
            t0 = time.perf_counter()
            try:
                fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
                times[name] = round(time.perf_counter() - t0, 3)
            except Exception as e:  # noqa: BLE001 - one failure must not lose the others
                times[name] = None
                errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
        return times

    def total(times):
        return round(sum(t for t in times.values() if t is not None), 3)

    runs = [run_pass() for _ in range(max(1, passes))]
    spark.stop()
    best = {}
    for name in runs[0]:
        got = [r[name] for r in runs if r.get(name) is not None]
        best[name] = min(got) if got else None
    out = {"metric": "total_query_seconds", "value": total(best), "unit": "sec",
           "queries": best, "sf": sf, "cpus": cpus, "method": f"best of {len(runs)} passes",
           "passes": [{"value": total(r), "queries": r} for r in runs]}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()
