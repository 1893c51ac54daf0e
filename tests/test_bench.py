"""bench.py prints one JSON line in the agreed shape."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2",
               BENCH_QUERIES="product_stats,sse_events")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, cwd=ROOT,
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    res = json.loads(lines[0])
    assert res["unit"] == "sec" and res["sf"] == 0.001 and "errors" not in res
    assert set(res["queries"]) == {"product_stats", "sse_events"}
    assert res["value"] == round(sum(res["queries"].values()), 3)
    assert len(res["passes"]) == 2
    for name, t in res["queries"].items():
        assert t == min(p["queries"][name] for p in res["passes"])
