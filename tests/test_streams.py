"""Stream = batch, restart and replay tests over file twins of the topics."""

import os

from quire import operators as op
from quire.schemas import PAGE_CREATIONS
from quire.sinks import KeyedTable
from quire.sources import fixtures, land_lines
from quire.streaming.jobs import (
    Endpoint, _Totals, observed_rows, read_counters, read_rejects, rows_processed, start_archive_job, start_filter_job, start_load_job,
    start_normalise_job, start_publish_job,
)

SF = "/root/testdata/sf0.001"
ONCE = {"availableNow": True}


def _run(q):
    q.awaitTermination(120)
    q.stop()
    return q


def _batch_set(df):
    return sorted(tuple(r) for r in df.collect())


def test_filter_then_load_stream_equals_batch(spark, workdir):
    msgs = fixtures.page_messages(spark, SF)
    land_lines(msgs.repartition(3), f"{workdir}/in")
    q = _run(start_filter_job(spark, Endpoint(path=f"{workdir}/in"), Endpoint(path=f"{workdir}/processed"),
                              checkpoint=f"{workdir}/ck1", trigger=ONCE))
    assert rows_processed(q) == msgs.count() == observed_rows(q, "filter_in")
    streamed = spark.read.text(f"{workdir}/processed")
    assert observed_rows(q, "filter_out") == streamed.count()
    assert _batch_set(streamed) == _batch_set(op.wiki_filter(msgs))
    # restart from the checkpoint: nothing is re-emitted
    _run(start_filter_job(spark, Endpoint(path=f"{workdir}/in"), Endpoint(path=f"{workdir}/processed"),
                          checkpoint=f"{workdir}/ck1", trigger=ONCE))
    assert spark.read.text(f"{workdir}/processed").count() == streamed.count()
    # load the processed topic into the keyed table
    table = KeyedTable(spark, f"{workdir}/pages", PAGE_CREATIONS)
    metrics = []
    _run(start_load_job(spark, Endpoint(path=f"{workdir}/processed", max_per_trigger=1), table,
                        checkpoint=f"{workdir}/ck2", trigger=ONCE, metrics=metrics, compact_every=2))
    assert len(metrics) >= 2 and table.snapshot() is not None
    assert any(m.get("compacted_upto") is not None for m in metrics)
    expect = op.latest_per_key(op.decode_processed(op.wiki_filter(msgs)).select(*PAGE_CREATIONS.columns),
                               PAGE_CREATIONS.key)
    assert _batch_set(table.read()) == _batch_set(expect)
    assert sum(m["rows"] for m in metrics) == streamed.count()
    # replaying the last micro-batch (same id, same rows) leaves the table as it was
    last = metrics[-1]["batch_id"]
    n_log = table.log().count()
    replay = table.log().filter(f"batch_id = {last}").select(*PAGE_CREATIONS.columns)
    table.write_batch(spark.createDataFrame(replay.collect(), replay.schema), last, replay=True)
    assert table.log().count() == n_log
    assert _batch_set(table.read()) == _batch_set(expect)


def test_archive_stream_minutes_and_late_row(spark, workdir):
    now = "2025-01-01T12:34:56+00:00"
    msgs = fixtures.tweet_messages(spark, SF)
    late = spark.createDataFrame([('{"author_id":"x","created_at":"2023-05-06T07:08:09+00:00","text":"late"}',),
                                  ("{broken",), ("[1]",), ("",)], "value string")
    land_lines(msgs, f"{workdir}/tweets/a")
    _run(start_archive_job(spark, Endpoint(path=f"{workdir}/tweets/*"), f"{workdir}/archive",
                           checkpoint=f"{workdir}/ck", trigger=ONCE, now=now))
    land_lines(late, f"{workdir}/tweets/b")
    q = _run(start_archive_job(spark, Endpoint(path=f"{workdir}/tweets/*"), f"{workdir}/archive",
                               checkpoint=f"{workdir}/ck", trigger=ONCE, now=now))
    assert observed_rows(q, "archive_in") == 4 and observed_rows(q, "archive_out") == 1
    back = spark.read.option("header", "true").option("escape", '"').csv(f"{workdir}/archive")
    expect = op.archive_rows(msgs.unionByName(late), now).select("minute", "author_id", "created_at", "text")
    assert _batch_set(back.select("minute", "author_id", "created_at", "text")) == _batch_set(expect)
    assert os.path.isdir(f"{workdir}/archive/minute=06_05_2023_07_08")


def test_publish_and_normalise_streams(spark, workdir):
    now = "2025-01-01T00:00:00+00:00"
    from quire.sources import land_csv
    tw = fixtures.tweets(spark, SF)
    land_csv(tw, f"{workdir}/tw")
    _run(start_publish_job(spark, f"{workdir}/tw", tw.columns, Endpoint(path=f"{workdir}/pub"),
                           checkpoint=f"{workdir}/ck1", trigger=ONCE, now=now))
    assert _batch_set(spark.read.text(f"{workdir}/pub")) == _batch_set(op.publish_rows(tw, now))
    lines = fixtures.sse_lines(spark, SF)
    land_lines(lines, f"{workdir}/sse")
    _run(start_normalise_job(spark, Endpoint(path=f"{workdir}/sse"), Endpoint(path=f"{workdir}/msgs"),
                             checkpoint=f"{workdir}/ck2", trigger=ONCE, now=now))
    got = spark.read.text(f"{workdir}/msgs")
    assert _batch_set(got) == _batch_set(op.encode_rows(op.sse_to_messages(lines, now)))


def test_archive_stream_with_salted_writers(spark, workdir):
    now = "2025-01-01T12:34:56+00:00"
    msgs = fixtures.tweet_messages(spark, SF)
    land_lines(msgs, f"{workdir}/tweets")
    _run(start_archive_job(spark, Endpoint(path=f"{workdir}/tweets"), f"{workdir}/archive",
                           checkpoint=f"{workdir}/ck", trigger=ONCE, now=now, writers_per_minute=3))
    back = spark.read.option("header", "true").option("escape", '"').csv(f"{workdir}/archive")
    expect = op.archive_rows(msgs, now).select("minute", "author_id", "created_at", "text")
    assert _batch_set(back.select("minute", "author_id", "created_at", "text")) == _batch_set(expect)


def test_counters_over_more_than_a_hundred_batches(spark, workdir):
    rows = spark.createDataFrame([('{"author_id":"x","text":"t"}',)], "value string")
    land_lines(rows.repartition(1), f"{workdir}/one/0")
    import shutil
    from glob import glob
    os.makedirs(f"{workdir}/many")
    part = glob(f"{workdir}/one/0/part-*")[0]
    for i in range(110):
        shutil.copy(part, f"{workdir}/many/f{i:03d}.txt")
    q = _run(start_publish_or_filter(spark, workdir))
    import time
    for _ in range(50):  # progress events arrive a moment after the query ends
        if rows_processed(q) == 110:
            break
        time.sleep(0.2)
    assert len(q.recentProgress) <= 101 and rows_processed(q) == 110 == observed_rows(q, "filter_in")


def start_publish_or_filter(spark, workdir):
    return start_filter_job(spark, Endpoint(path=f"{workdir}/many", max_per_trigger=1),
                            Endpoint(path=f"{workdir}/out"), trigger=ONCE)


def test_publish_refuses_another_header(spark, workdir):
    import pytest
    from quire.sources import land_csv
    tw = spark.createDataFrame([("t", "a", "c")], "text string, author_id string, created_at string")
    land_csv(tw, f"{workdir}/tw")
    with pytest.raises(Exception):
        _run(start_publish_job(spark, f"{workdir}/tw", ["author_id", "created_at", "text"],
                               Endpoint(path=f"{workdir}/pub"), checkpoint=f"{workdir}/ck", trigger=ONCE))


def test_a_file_source_can_start_at_the_latest(spark, workdir):
    """Files from before the first start stay out, also after a restart; files
    that came while the query was down are taken."""
    rows = lambda *users: spark.createDataFrame(
        [(f'{{"user_id":"{u}","domain":"d","page_title":"p","created_at":"t"}}',) for u in users], "value string")
    src = f"{workdir}/topic"
    land_lines(rows("old"), f"{src}/a")
    for d, _, names in os.walk(src):
        for n in names:
            os.utime(os.path.join(d, n), (1_600_000_000, 1_600_000_000))
    got = {}
    for start in ("latest", None):
        table = KeyedTable(spark, f"{workdir}/pages-{start}", PAGE_CREATIONS)

        def run():
            return _run(start_load_job(spark, Endpoint(path=f"{src}/*", starting_offsets=start), table, trigger=ONCE))
        run()
        land_lines(rows(f"new-{start}"), f"{src}/b-{start}")
        run()
        got[start] = {r.user_id for r in table.read().collect()}
    assert got["latest"] == {"new-latest"} and got[None] == {"old", "new-latest", "new-None"}


def test_rejects_and_counters_are_replaced_by_a_replay(spark, workdir):
    import shutil
    src, root = f"{workdir}/topic", f"{workdir}/out"
    land_lines(spark.createDataFrame([('{"user_id":"u","domain":"d","created_at":"t"}',), ("{broken",), ("[1]",), ("",),
                                      ('{"user_id":"u","domain":""}',)], "value string"), f"{src}/a")
    table = KeyedTable(spark, f"{workdir}/pages", PAGE_CREATIONS)
    for turn in range(2):
        _run(start_load_job(spark, Endpoint(path=f"{src}/*"), table, checkpoint=f"{workdir}/ck", trigger=ONCE,
                            rejects_path=f"{root}/rejects", counters_path=f"{root}/counters"))
        # as if the query had died before it committed the micro-batch
        shutil.rmtree(f"{workdir}/ck/commits", ignore_errors=True)
    assert table.read().count() == 1 and table.batches() == [0]
    assert sorted((r.reason, r.value) for r in read_rejects(spark, f"{root}/rejects").collect()) == [
        ("missing domain, created_at", '{"user_id":"u","domain":""}'), ("not JSON", ""), ("not JSON", "{broken"),
        ("not an object", "[1]")]
    assert [tuple(r) for r in read_counters(spark, f"{root}/counters").collect()] == [
        ("page_load-page_creations", 1, 5, 1, 4)]


def test_run_totals_stay_small():
    t = _Totals()
    for b in range(1000):
        t.note(b, 10, {"x": 3})
        t.note(b, 10, {})      # reported again without its counts
    t.note(5, 10, {"x": 3})    # an old report
    assert (t.rows_before + t.rows, t.seen_before["x"] + t.seen["x"]) == (10000, 3000)


def test_the_archive_reads_what_the_commit_log_has(spark, workdir):
    """A file that a failed micro-batch left beside the sink's own is not read."""
    from quire.sinks import read_minute_archive
    land_lines(fixtures.busy_minutes(spark, SF, False), f"{workdir}/topic")
    _run(start_archive_job(spark, Endpoint(path=f"{workdir}/topic"), f"{workdir}/archive", trigger=ONCE,
                           now="2025-01-01T12:34:56+00:00", writers_per_minute=3))
    n = read_minute_archive(spark, f"{workdir}/archive").count()
    some = next(d for d in os.listdir(f"{workdir}/archive") if d.startswith("minute="))
    with open(f"{workdir}/archive/{some}/part-left-over.csv", "w") as f:
        f.write("author_id,created_at,text\nx,y,z\n")
    assert read_minute_archive(spark, f"{workdir}/archive").count() == n > 0
