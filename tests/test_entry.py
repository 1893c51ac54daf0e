"""The driver contract, exercised like the driver: a separate process with a
bare session, started from another working directory."""

import json
import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = r"""
import importlib.util, json
spec = importlib.util.spec_from_file_location("__spark_entry__", %r)
E = importlib.util.module_from_spec(spec); spec.loader.exec_module(E)
from pyspark.sql import SparkSession
s = (SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "8")
     .config("spark.sql.session.timeZone", "America/Los_Angeles").getOrCreate())
df = E.entry(s)
rows = df.count()
q, o = E.queries(), E.oracle_sql()
top = q["top_products"](s, "/root/testdata/sf0.001")
print(json.dumps({"rows": rows, "cols": df.columns, "queries": sorted(q), "oracles": sorted(o),
                  "top": top.count()}))
"""


def test_entry_contract_in_a_fresh_process():
    cwd = tempfile.mkdtemp(prefix="run-entry-")
    out = subprocess.run([sys.executable, "-c", SCRIPT % os.path.join(ROOT, "__spark_entry__.py")],
                         cwd=cwd, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-3000:]
    res = json.loads(out.stdout.strip().splitlines()[-1])
    assert res["rows"] > 0
    assert res["cols"] == ["product_id", "product_title", "product_category", "total_reviews",
                           "avg_star_rating"]
    assert set(res["oracles"]) <= set(res["queries"]) and len(res["oracles"]) >= 40
    assert 0 < res["top"] <= 10
