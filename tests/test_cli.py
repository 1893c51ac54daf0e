"""The job command line, run as a user would (separate processes)."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _run(*args, timeout=600):
    env = dict(os.environ, PYTHONPATH=ROOT)
    out = subprocess.run([sys.executable, "-m", "quire", *args], cwd=ROOT, env=env,
                         capture_output=True, text=True, timeout=timeout)
    assert out.returncode == 0, out.stderr[-3000:]
    return out.stdout


def test_cli_batch_and_stream_jobs(spark, workdir):
    from quire.schemas import REVIEW_COLUMNS
    from quire.sources import fixtures, land_csv, land_lines
    sf = "/root/testdata/sf0.001"
    csv = land_csv(fixtures.reviews_raw(spark, sf).select(*REVIEW_COLUMNS), f"{workdir}/reviews")
    counts = json.loads(_run("document-store", csv, f"{workdir}/docs").strip().splitlines()[-1])
    assert counts["raw"] == fixtures.reviews_raw(spark, sf).count()
    assert spark.read.parquet(f"{workdir}/docs/product_stats").count() == counts["product_stats"]

    land_lines(fixtures.page_messages(spark, sf), f"{workdir}/input")
    _run("filter", "--source-path", f"{workdir}/input", "--sink-path", f"{workdir}/processed",
         "--checkpoint", f"{workdir}/ck1", "--available-now")
    _run("load", "--source-path", f"{workdir}/processed", "--table-path", f"{workdir}/pages",
         "--checkpoint", f"{workdir}/ck2", "--available-now")
    from quire import operators as op
    from quire.schemas import PAGE_CREATIONS
    from quire.sinks import KeyedTable
    got = sorted(map(tuple, KeyedTable(spark, f"{workdir}/pages", PAGE_CREATIONS).read().collect()))
    want = sorted(map(tuple, op.latest_per_key(
        op.decode_processed(op.wiki_filter(fixtures.page_messages(spark, sf)))
          .select(*PAGE_CREATIONS.columns), PAGE_CREATIONS.key).collect()))
    assert got == want
