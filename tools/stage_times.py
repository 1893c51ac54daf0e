"""Per-stage task counts and times of registered queries, from Spark's event log.

usage: python tools/stage_times.py [sf_dir] [query ...]

Runs the queries in a fresh local[8] session whose event log goes to a new
scratch folder, then summarises each stage: tasks, busiest task, summed task
time, records read from the input or the shuffle. No UI or REST endpoint is
used; everything comes from the log file.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    names = argv[2:] or ["product_stats"]
    log_dir = tempfile.mkdtemp(prefix="run-eventlog-")
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[8]")
             .config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.eventLog.enabled", "true")
             .config("spark.eventLog.dir", f"file://{log_dir}")
             .config("spark.eventLog.compress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from quire.plans.catalog import QUERIES
    QUERIES["product_stats"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    marks = []
    for n in names:
        spark.sparkContext.setJobGroup(n, n)
        t0 = time.time()
        QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        marks.append((n, round(time.time() - t0, 2)))
    spark.stop()

    stages = {}
    tasks = defaultdict(list)
    group_of_stage = {}
    for path in glob.glob(f"{log_dir}/**/events_*", recursive=True) + glob.glob(f"{log_dir}/*.*"):
        if os.path.isdir(path):
            continue
        for line in open(path):
            e = json.loads(line)
            ev = e.get("Event")
            if ev == "SparkListenerJobStart":
                g = (e.get("Properties") or {}).get("spark.jobGroup.id")
                for sid in e.get("Stage IDs", []):
                    group_of_stage[sid] = g
            elif ev == "SparkListenerStageCompleted":
                info = e["Stage Info"]
                stages[info["Stage ID"]] = info
            elif ev == "SparkListenerTaskEnd":
                m = e.get("Task Metrics") or {}
                rec = (m.get("Input Metrics", {}).get("Records Read", 0)
                       + m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0))
                tasks[e["Stage ID"]].append((m.get("Executor Run Time", 0), rec))
    for name, secs in marks:
        print(f"## {name} ({secs} s wall)\n")
        print("| stage | tasks | tasks with rows | busiest task ms | summed task ms | rows in | name |")
        print("|---|---|---|---|---|---|---|")
        for sid in sorted(s for s in stages if group_of_stage.get(s) == name):
            ts = tasks.get(sid, [])
            busy = [t for t in ts if t[1] > 0]
            print(f"| {sid} | {len(ts)} | {len(busy)} | {max((t[0] for t in ts), default=0)} | "
                  f"{sum(t[0] for t in ts)} | {sum(t[1] for t in ts)} | "
                  f"{stages[sid]['Stage Name'].split(' at ')[0]} |")
        print()


if __name__ == "__main__":
    main(sys.argv)
