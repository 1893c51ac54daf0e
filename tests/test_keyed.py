"""Upsert semantics and layout of keyed tables."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from quire.operators import latest_per_key
from quire.schemas import PAGE_CREATIONS, REVIEWS_BY_PRODUCT, TOP_CUSTOMERS_SCHEMA
from quire.sinks import CountTable, KeyedTable

COLS = "domain string, created_at string, user_id string, page_title string"


def test_latest_per_key_order_and_ties(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b"), ("k", 2, "c"), ("j", 1, None),
                                ("j", 1, "z"), (None, 9, "n")], "k string, seq int, v string")
    got = {r.k: (r.seq, r.v) for r in latest_per_key(df, ["k"], order=["seq"]).collect()}
    assert got == {"k": (2, "c"), "j": (1, "z")}


def test_hot_key_is_pre_aggregated(spark):
    df = spark.range(0, 100000).select((F.col("id") % 3 == 0).cast("string").alias("k"),
                                       F.col("id").alias("v"))
    plan = latest_per_key(df, ["k"], order=["v"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") + plan.count("ObjectHashAggregate") + \
        plan.count("SortAggregate") >= 2  # partial before the exchange, final after
    assert "Window" not in plan


def test_keyed_table_upsert_replay_and_rejects(spark, workdir):
    t = KeyedTable(spark, f"{workdir}/pages", PAGE_CREATIONS, rejects_path=f"{workdir}/rejects")
    b0 = spark.createDataFrame([("d", "2024-01-01", "u1", "A"), ("d", "2024-01-01", "u1", "B"),
                                ("d", "2024-01-02", "u2", "C"), (None, "2024-01-01", "u3", "X")], COLS)
    res = t.write_batch(b0, 0)
    assert res == {"rows": 3, "rejected": 1}
    assert [r.user_id for r in spark.read.parquet(f"{workdir}/rejects").collect()] == ["u3"]
    first = {(r.created_at, r.user_id): r.page_title for r in t.read().collect()}
    assert first == {("2024-01-01", "u1"): "B", ("2024-01-02", "u2"): "C"}
    # a later batch replaces the row with the same key
    b1 = spark.createDataFrame([("d", "2024-01-01", "u1", "A2")], COLS)
    t.write_batch(b1, 1)
    second = {(r.created_at, r.user_id): r.page_title for r in t.read().collect()}
    assert second == {("2024-01-01", "u1"): "A2", ("2024-01-02", "u2"): "C"}
    # replaying batch 1 (same id) leaves the table and its log unchanged
    n_log = t.log().count()
    with pytest.raises(ValueError):
        t.write_batch(b1, 1)
    t.write_batch(b1, 1, replay=True)
    assert t.log().count() == n_log
    assert {(r.created_at, r.user_id): r.page_title for r in t.read().collect()} == second
    # compaction keeps the content; later batches still win over the snapshot
    before = sorted(map(tuple, t.read().collect()))
    assert t.compact() == 1 and t.snapshot()[0] == 1
    assert t.compact() == 1  # idempotent
    assert sorted(map(tuple, t.read().collect())) == before
    t.write_batch(spark.createDataFrame([("d", "2024-01-02", "u2", "C2")], COLS), 2)
    after = {(r.created_at, r.user_id): r.page_title for r in t.read().collect()}
    assert after == {("2024-01-01", "u1"): "A2", ("2024-01-02", "u2"): "C2"}
    # readers skip the compacted part of the log by a partition filter
    with pytest.raises(ValueError):  # readers no longer look at batches of the snapshot
        t.write_batch(b1, 1, replay=True)
    # a write without a number goes above log and snapshot and is seen
    t.compact()
    assert t.next_batch() == 3
    t.write_batch(spark.createDataFrame([("e", "2024-01-02", "u2", "E")], COLS))
    assert t.read().count() == 3 and t.batches()[-1] == 3
    plan = t.read()._jdf.queryExecution().executedPlan().toString()
    assert "_compacted/upto=2" in plan and "(batch_id" in plan and "> 2)" in plan


def test_lookup_prunes_buckets_and_pushes_key(spark, workdir):
    t = KeyedTable(spark, f"{workdir}/rbp", REVIEWS_BY_PRODUCT)
    rows = [(str(p), s, dt.date(2020, 1, 1 + s), f"r{p}-{s}", "c", "t", "h", None)
            for p in range(50) for s in range(1, 6)]
    df = spark.createDataFrame(rows, "product_id string, star_rating int, review_date date, "
                               "review_id string, customer_id string, product_title string, "
                               "review_headline string, review_body string")
    t.write_batch(df, 0)
    look = t.read(product_id="7")
    assert look.count() == 5
    plan = look._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(b" in plan or "PartitionFilters: [(b" in plan \
        or ("PartitionFilters" in plan and "b#" in plan.split("PartitionFilters")[1][:200])
    assert "EqualTo(product_id,7)" in plan


def test_connector_table_appends_through_a_format(spark, workdir):
    """The connector path: a plain append with format/options (here the
    built-in json source stands in for a keyed-store connector)."""
    from quire.sinks import ConnectorTable
    t = ConnectorTable(spark, PAGE_CREATIONS, "json", {"path": f"{workdir}/store"})
    rows = spark.createDataFrame([("d", "t1", "u1", "A"), (None, "t2", "u2", "B")], COLS)
    assert t.write_batch(rows, 0) == {"rows": 1, "rejected": 1}
    assert [tuple(r) for r in t.read(domain="d").collect()] == [("d", "t1", "u1", "A")]


def test_reading_an_empty_keyed_table_says_so(spark, workdir):
    t = KeyedTable(spark, f"{workdir}/nothing", PAGE_CREATIONS)
    with pytest.raises(FileNotFoundError):
        t.read()
    assert t.compact() is None


def test_bucket_count_stays_with_the_table(spark, workdir):
    from dataclasses import replace
    hashed = replace(PAGE_CREATIONS, by_value=False)
    t = KeyedTable(spark, f"{workdir}/b", hashed)
    t.write_batch(spark.createDataFrame([(f"d{i}", "t", "u", "p") for i in range(30)], COLS))
    other = KeyedTable(spark, f"{workdir}/b", replace(hashed, buckets=7))
    assert other.buckets() == hashed.buckets
    assert all(other.read(domain=f"d{i}").count() == 1 for i in range(3))


def test_stream_epochs_of_two_runs(spark, workdir):
    t = KeyedTable(spark, f"{workdir}/e", PAGE_CREATIONS)
    rows = lambda *names: spark.createDataFrame([("d", n, "u", "p") for n in names], COLS)
    t.write_epoch(rows("1", "2"), "run-a", 0)
    t.write_epoch(rows("1", "2"), "run-a", 0)  # a replay
    t.write_epoch(rows("3"), "run-b", 0)       # a job with a new checkpoint
    assert t.batches() == [0, 1] and t.read().count() == 3
    t.compact()
    t.write_epoch(rows("1", "2"), "run-a", 0)  # already part of the snapshot
    assert t.batches() == [0, 1] and t.read().count() == 3


def test_a_replay_replaces_the_whole_batch(spark, workdir):
    t = KeyedTable(spark, f"{workdir}/r", PAGE_CREATIONS, rejects_path=f"{workdir}/rr")
    many = spark.createDataFrame([(f"d{i % 3}", f"t{i}", "u", "p") for i in range(60)] + [(None, "t", "u", "p")], COLS)
    t.write_batch(many)
    assert t.read().count() == 60 and spark.read.parquet(f"{workdir}/rr/batch_id=0").count() == 1
    t.write_batch(spark.createDataFrame([("d0", "t0", "u", "new")], COLS), 0, replay=True)
    assert [tuple(r) for r in t.read().collect()] == [("d0", "t0", "u", "new")]
    assert not os.path.exists(f"{workdir}/rr/batch_id=0")


def test_two_writers_get_their_own_batches(spark, workdir):
    """Both look at the table before either writes; both batches stay."""
    a, b = (KeyedTable(spark, f"{workdir}/w", PAGE_CREATIONS) for _ in range(2))
    one, two = a.claim(), b.claim()
    assert (one, two) == ((0, 0), (1, 0))
    rows = lambda n: spark.createDataFrame([("d", n, "u", n)], COLS)
    b.write_claimed(rows("b"), *two)
    assert [r.page_title for r in a.read().collect()] == ["b"]  # the unfinished batch is not seen
    a.write_claimed(rows("a"), *one)
    assert sorted(r.page_title for r in b.read().collect()) == ["a", "b"]
    # whoever loses the race for a number takes the next one
    real, seen = a.next_batch, []
    a.next_batch = lambda: seen.append(1) or (1 if len(seen) == 1 else real())
    assert a.claim() == (2, 0) and len(seen) == 2
    with pytest.raises(ValueError):
        b.claim(2)


def test_an_unfinished_write_is_never_read(spark, workdir):
    t = KeyedTable(spark, f"{workdir}/u", PAGE_CREATIONS)
    t.write_batch(spark.createDataFrame([("d", "t", "u", "good")], COLS))
    broken = spark.createDataFrame([("d", "t", "u", "x")], COLS).withColumn(
        "page_title", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        t.write_batch(broken, 0, replay=True)
    assert [r.page_title for r in t.read().collect()] == ["good"] and t.batches() == [0]


def test_retire_keeps_the_content_and_shrinks_the_log(spark, workdir):
    t = KeyedTable(spark, f"{workdir}/s", PAGE_CREATIONS)
    for i in range(4):
        t.write_batch(spark.createDataFrame([("d", "t", "u", f"v{i}"), ("d", f"t{i}", "u", "p")], COLS))
        if i % 2:
            t.compact()
    t.write_batch(spark.createDataFrame([("e", "t", "u", "x")], COLS))
    t.write_batch(spark.createDataFrame([("e", "t", "u", "y")], COLS), 4, replay=True)
    before = sorted(map(tuple, t.read().collect()))
    t.retire()
    assert sorted(map(tuple, t.read().collect())) == before and t.batches() == [4] and t.next_batch() == 5
    left = [d for d, _, names in os.walk(f"{workdir}/s") if any(n.endswith(".parquet") for n in names)]
    assert all("batch_id=4/attempt=1" in d or "upto=3" in d for d in left)
    versions = {r.page_title: r.batch_id for r in t.versions().where("domain = 'd' and created_at = 't'").collect()}
    assert versions == {"v3": 3}  # a snapshot row keeps its own batch


def test_a_bucket_is_clustered_by_key_ranges(spark, workdir):
    """Of a bucket's eight files at most two have a key in their range, so the
    pushed equality skips the others; a hot key spreads over several files."""
    import pyarrow.parquet as pq
    from dataclasses import replace
    old = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        t = KeyedTable(spark, f"{workdir}/c", replace(REVIEWS_BY_PRODUCT, buckets=1))
        df = spark.range(4000).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 500).cast("string")).alias("product_id"),
            (F.col("id") % 5 + 1).cast("int").alias("star_rating"), F.lit(dt.date(2020, 1, 1)).alias("review_date"),
            F.col("id").cast("string").alias("review_id"), *[F.lit("x").alias(c) for c in REVIEWS_BY_PRODUCT.columns[4:]])
        t.write_batch(df)
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    files = [os.path.join(d, n) for d, _, names in os.walk(f"{workdir}/c") for n in names if n.endswith(".parquet")]
    assert len(files) == 8
    ranges = []
    for f in files:
        meta = pq.ParquetFile(f).metadata
        stats = [meta.row_group(g).column(0).statistics for g in range(meta.num_row_groups)]
        ranges.append((min(s.min for s in stats), max(s.max for s in stats)))
    for key in [str(k) for k in range(0, 500, 7)]:
        assert 1 <= sum(lo <= key <= hi for lo, hi in ranges) <= 2
    assert 2 <= sum(lo <= "hot" <= hi for lo, hi in ranges) <= 4
    assert t.read(product_id="hot").count() == sum(1 for i in range(4000) if i % 3 == 0)


def test_few_valued_keys_have_a_directory_each(spark, workdir):
    t = KeyedTable(spark, f"{workdir}/v", PAGE_CREATIONS)
    t.write_batch(spark.createDataFrame([("007", "t", "u", "p"), ("a/b=c", "t", "u", "q"), ("", "t", "u", "r"),
                                         ("2020-01", "t", "u", "s")], COLS))
    assert {r.domain for r in t.read().collect()} == {"007", "a/b=c", "2020-01"}  # text stays text
    look = t.read(domain="007")
    assert look.count() == 1
    plan = look._jdf.queryExecution().executedPlan().toString()
    assert "domain" in plan.split("PartitionFilters")[1][:120]


def test_counts_sum_fall_and_vanish(spark, workdir):
    t = CountTable(spark, f"{workdir}/n", TOP_CUSTOMERS_SCHEMA, "period")
    rows = lambda *r: spark.createDataFrame(list(r), "period string, customer_id string, review_count long")
    t.write_batch(rows(("2015-08", "a", 3), ("2015-08", "b", 1), ("2015-09", "a", 1)))
    t.write_batch(rows(("2015-08", "a", -1), ("2015-09", "a", -1)))
    want = [("2015-08", "a", 2), ("2015-08", "b", 1)]
    assert sorted(map(tuple, t.read().collect())) == want
    t.compact()
    t.retire()
    assert sorted(map(tuple, t.read().collect())) == want and t.read(period="2015-09").isEmpty()
    t.write_batch(rows(("2015-08", "b", 4)))
    t.write_batch(rows(("2015-08", "b", 1)), 2, replay=True)
    assert sorted(map(tuple, t.read(period="2015-08").collect())) == [("2015-08", "a", 2), ("2015-08", "b", 2)]


def test_a_whole_count_table_is_summed_behind_its_exchange(spark, workdir, monkeypatch):
    """Nothing is hashed in scan splits, whose rows are far more than their bytes tell;
    the tasks of the exchange follow the rows."""
    monkeypatch.setattr("quire.session.TASK_ROWS", 100)
    t = CountTable(spark, f"{workdir}/n", TOP_CUSTOMERS_SCHEMA, "period")
    rows = spark.range(300).select(F.lit("2015-08").alias("period"), F.col("id").cast("string").alias("customer_id"),
                                   F.lit(2).cast("long").alias("review_count"))
    t.write_batch(rows)
    t.write_batch(rows.where("customer_id < 100").withColumn("review_count", F.lit(-2).cast("long")))
    df = t.read()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == 1 and "HashAggregate" not in plan.split("Exchange ")[1]
    assert df.rdd.getNumPartitions() == 4
    assert sorted(int(r.customer_id) for r in df.collect()) == list(range(100, 300))
