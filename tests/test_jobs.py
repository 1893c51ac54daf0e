"""End-to-end batch jobs over a review CSV landed from the driver tables."""

from pyspark.sql import functions as F

from quire import operators as op
from quire.plans.jobs import BOARDS, ReviewServing, board_changes, document_store_job, keyed_tables_job
from quire.schemas import REVIEW_COLUMNS
from quire.sources import fixtures, land_csv, read_reviews_csv

SF = "/root/testdata/sf0.001"


def _csv(spark, workdir):
    return land_csv(fixtures.reviews_raw(spark, SF).select(*REVIEW_COLUMNS), f"{workdir}/reviews")


def test_document_store_job(spark, workdir):
    csv = _csv(spark, workdir)
    counts = document_store_job(spark, csv, f"{workdir}/docs")
    raw = fixtures.reviews_raw(spark, SF)
    clean = op.clean_reviews(raw, keep_unparsed_dates=True)
    assert counts["raw"] == raw.count()
    assert counts["clean"] == clean.count()
    ps = spark.read.parquet(f"{workdir}/docs/product_stats")
    assert counts["product_stats"] == ps.count() == op.product_stats(clean).count()
    assert ps.exceptAll(op.product_stats(clean)).count() == 0
    monthly = spark.read.parquet(f"{workdir}/docs/monthly_product_reviews")
    assert monthly.count() == counts["monthly_product_reviews"]
    assert monthly.filter(F.col("year").isNull()).count() > 0  # bad dates kept
    # re-running replaces, never appends
    document_store_job(spark, csv, f"{workdir}/docs")
    assert spark.read.parquet(f"{workdir}/docs/product_stats").count() == counts["product_stats"]


def test_keyed_tables_job_and_serving(spark, workdir):
    csv = _csv(spark, workdir)
    counts = keyed_tables_job(spark, csv, f"{workdir}/keyed", batch_id=0)
    clean = op.clean_reviews(fixtures.reviews_raw(spark, SF))
    assert counts["clean"] == clean.count()
    srv = ReviewServing(spark, f"{workdir}/keyed")
    period = clean.groupBy("period").count().orderBy(F.desc("count"), "period").first()["period"]
    expect = op.top_products(op.items_by_period(clean), period, 5)
    assert [tuple(r) for r in srv.top_products(period, 5).collect()] == [tuple(r) for r in expect.collect()]
    assert [tuple(r) for r in srv.top_haters(period, 5).collect()] == \
        [tuple(r) for r in op.top_haters(op.sentiment_by_period(clean), period, 5).collect()]
    pid = clean.first()["product_id"]
    got = srv.reviews_by_product(pid).collect()
    want = op.reviews_of_product(op.latest_per_key(
        clean.select("product_id", "star_rating", "review_date", "review_id", "customer_id",
                     "product_title", "review_headline", "review_body"),
        ["product_id", "star_rating", "review_date", "review_id"]), pid).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want]
    cid = clean.first()["customer_id"]
    assert srv.reviews_by_customer(cid).count() > 0
    # a second run (same batch id) is a replay: nothing changes
    before = srv.by_product.read().count()
    keyed_tables_job(spark, csv, f"{workdir}/keyed", batch_id=0)
    assert srv.by_product.read().count() == before
    assert srv.top_products("1900-01").isEmpty()


def test_second_feed_and_corrections(spark, workdir):
    """Feeds add up in tables and boards; a corrected rating moves a customer
    to the other sentiment and leaves nothing behind."""
    cols = ", ".join(f"{c} string" for c in REVIEW_COLUMNS)

    def feed(name, *rows):
        df = spark.createDataFrame([{c: "1" for c in REVIEW_COLUMNS} | {"review_date": "2015-08-31"} | r
                                    for r in rows], cols)
        return land_csv(df, f"{workdir}/{name}")

    a = [{"review_id": f"a{i}", "product_id": "p1", "customer_id": "c1", "star_rating": "5"} for i in range(9)]
    b = [{"review_id": f"b{i}", "product_id": "p2", "customer_id": "c1", "star_rating": "5"} for i in range(2)]
    root = f"{workdir}/keyed"
    keyed_tables_job(spark, feed("fa", *a), root)
    keyed_tables_job(spark, feed("fb", *b), root)
    srv = ReviewServing(spark, root)
    assert [tuple(r) for r in srv.top_customers("2015-08").collect()] == [("c1", 11)]
    assert [(r.product_id, r.review_count) for r in srv.top_products("2015-08").collect()] == [("p1", 9), ("p2", 2)]
    assert [tuple(r) for r in srv.top_backers("2015-08").collect()] == [("c1", 11)]
    keyed_tables_job(spark, feed("fc", *[r | {"star_rating": "1"} for r in a + b]), root)
    assert [tuple(r) for r in srv.top_haters("2015-08").collect()] == [("c1", 11)]
    assert srv.top_backers("2015-08").isEmpty()
    # the product board counts a re-rated review once, as the customer board does
    assert [(r.product_id, r.review_count) for r in srv.top_products("2015-08").collect()] == [("p1", 9), ("p2", 2)]
    assert [tuple(r) for r in srv.top_customers("2015-08").collect()] == [("c1", 11)]
    # a corrected date moves a review; the emptied period goes from every board
    keyed_tables_job(spark, feed("fd", *[r | {"star_rating": "5", "review_date": "2016-01-02"} for r in a + b]), root)
    for name in BOARDS:
        assert srv.board(name, "2015-08").isEmpty()
    assert [tuple(r) for r in srv.top_backers("2016-01").collect()] == [("c1", 11)]
    # also from snapshots of tables and boards
    for t in (srv.by_product, srv.by_customer):
        t.compact()
    keyed_tables_job(spark, feed("fe", a[0] | {"star_rating": "1", "review_date": "2016-01-02"}), root)
    assert [tuple(r) for r in srv.top_backers("2016-01").collect()] == [("c1", 10)]
    assert [tuple(r) for r in srv.top_haters("2016-01").collect()] == [("c1", 1)]


def test_a_replayed_feed_corrects_later_boards(spark, workdir):
    """Replaying an earlier feed with other content changes what later feeds did
    to the boards; a run that stopped before its boards is made good."""
    cols = ", ".join(f"{c} string" for c in REVIEW_COLUMNS)

    def feed(name, *rows):
        df = spark.createDataFrame([{c: "1" for c in REVIEW_COLUMNS} | {"review_date": "2015-08-31", "star_rating": "5"} | r
                                    for r in rows], cols)
        return land_csv(df, f"{workdir}/{name}")

    root = f"{workdir}/keyed"
    r = [{"review_id": f"r{i}", "product_id": "p", "customer_id": "c"} for i in range(4)]
    keyed_tables_job(spark, feed("f0", *r), root)                                     # 4 reviews
    keyed_tables_job(spark, feed("f1", r[0] | {"star_rating": "1"}), root)            # r0 corrected
    srv = ReviewServing(spark, root)
    assert [tuple(x) for x in srv.top_backers("2015-08").collect()] == [("c", 3)]
    keyed_tables_job(spark, feed("f0b", *r[1:3]), root, batch_id=0)                   # r0 and r3 never came
    assert [tuple(x) for x in srv.top_backers("2015-08").collect()] == [("c", 2)]
    assert [tuple(x) for x in srv.top_haters("2015-08").collect()] == [("c", 1)]
    assert [tuple(x) for x in srv.top_customers("2015-08").collect()] == [("c", 3)]
    # tables written, boards not: the next run does both
    clean = op.clean_reviews(read_reviews_csv(spark, feed("f2", r[3])))
    for t in (srv.by_product, srv.by_customer):
        t.write_batch(clean)
    keyed_tables_job(spark, feed("f3", {"review_id": "x", "product_id": "q", "customer_id": "c"}), root)
    assert [tuple(x) for x in srv.top_customers("2015-08").collect()] == [("c", 5)]
    assert [(x.product_id, x.review_count) for x in srv.top_products("2015-08").collect()] == [("p", 4), ("q", 1)]


def test_change_sets_read_touched_buckets_only(spark, workdir):
    root = f"{workdir}/keyed"
    csv = _csv(spark, workdir)
    keyed_tables_job(spark, csv, root)
    one = read_reviews_csv(spark, csv).where("product_id = '7'")
    keyed_tables_job(spark, land_csv(one, f"{workdir}/one"), root)
    srv = ReviewServing(spark, root)
    changes = board_changes(srv.by_product, srv.by_customer, 1)["top_reviewed_items_by_period"]
    assert changes.isEmpty()  # the same reviews again
    plan = changes._jdf.queryExecution().executedPlan().toString()
    bucket = srv.by_product.log([1]).first()["b"]
    assert f"(b#" in plan and f"= {bucket})" in plan.split("PartitionFilters", 1)[1]


def test_changes_of_a_feed_are_exchanged_once(spark, workdir, monkeypatch):
    """A first feed's reviews are grouped, counted and stored in order behind one
    exchange, whose tasks get rows, not bytes; nothing is sorted or hashed before it."""
    monkeypatch.setattr("quire.session.TASK_ROWS", 1000)
    root = f"{workdir}/keyed"
    keyed_tables_job(spark, _csv(spark, workdir), root)
    srv = ReviewServing(spark, root)
    changes = board_changes(srv.by_product, srv.by_customer, 0)
    for name, (_, schema) in BOARDS.items():
        plan = changes[name]._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange rangepartitioning(") == 1 and "hashpartitioning(" not in plan, plan
        assert "SortAggregate" not in plan.split("Exchange rangepartitioning(")[1] and plan.count("Sort [") <= 2, plan
        # one row a key, in files of disjoint key ranges, sorted
        key = [c for c in schema.fieldNames() if c != "review_count"]
        stored = spark.read.parquet(f"{root}/{name}/batch_id=0/attempt=0").withColumn("f", F.input_file_name())
        files = {}
        for row in stored.withColumn("at", F.monotonically_increasing_id()).orderBy("f", "at").collect():
            files.setdefault(row.f, []).append(tuple(row[c] for c in key))
        spans = sorted((rows[0], rows[-1]) for rows in files.values())
        assert all(rows == sorted(set(rows)) for rows in files.values())
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_boards_count_a_repeated_key_once(spark, workdir):
    """Rows of one key within a feed count once, as the greatest has it; a later
    feed takes them all back."""
    cols = ", ".join(f"{c} string" for c in REVIEW_COLUMNS)

    def feed(name, *rows):
        df = spark.createDataFrame([{c: "1" for c in REVIEW_COLUMNS} | {"review_date": "2015-08-31"} | r
                                    for r in rows], cols)
        return land_csv(df, f"{workdir}/{name}", compression="lz4")

    r = {"review_id": "r", "product_id": "p", "customer_id": "c", "star_rating": "5"}
    root = f"{workdir}/keyed"
    keyed_tables_job(spark, feed("f0", r | {"product_title": "a"}, r | {"product_title": "b", "star_rating": "1"},
                                 r | {"product_title": "b"}, r | {"review_date": "2015-09-01", "product_title": "b"}), root)
    srv = ReviewServing(spark, root)
    rows = lambda name: sorted(map(tuple, srv.board(name).collect()))
    # the product side tells rows by their rating also: two keys in August, one in September
    assert rows("top_reviewed_items_by_period") == [
        ("2015-08", "p", "b", 2), ("2015-09", "p", "b", 1)]
    assert rows("top_customers_by_period") == [("2015-08", "c", 1), ("2015-09", "c", 1)]
    assert rows("top_sentiment_by_period") == [("2015-08", "c", 1, "backer"), ("2015-09", "c", 1, "backer")]
    keyed_tables_job(spark, feed("f1", r | {"star_rating": "1", "review_date": "2015-08-02"}), root)
    assert rows("top_reviewed_items_by_period") == [("2015-08", "p", "1", 1)]
    assert rows("top_customers_by_period") == [("2015-08", "c", 1)]
    assert rows("top_sentiment_by_period") == [("2015-08", "c", 1, "hater")]


def test_tasks_follow_rows(spark):
    from quire.session import tasks_for
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "10")
    try:
        assert [tasks_for(spark, n) for n in (0, 1, 250_001, 2_500_000, 9_000_000, 40_000_001)] == [1, 1, 2, 10, 10, 41]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_boards_in_an_external_store_can_fall(spark, workdir):
    """A store that upserts by key, here the Parquet source of one folder per table."""
    cols = ", ".join(f"{c} string" for c in REVIEW_COLUMNS)

    def feed(name, *rows):
        df = spark.createDataFrame([{c: "1" for c in REVIEW_COLUMNS} | {"review_date": "2015-08-31"} | r
                                    for r in rows], cols)
        return land_csv(df, f"{workdir}/{name}")

    sent = {}

    class Store:
        def __init__(self, spark, spec, format, options):
            self.spec = spec

        def write_batch(self, df, batch_id=None, replay=False):
            for row in df.select(*self.spec.columns).collect():
                sent.setdefault(self.spec.name, {})[tuple(row[c] for c in self.spec.key)] = tuple(row)
            return {"rows": 0, "rejected": 0}

        def read(self, **equal_to):
            df = spark.createDataFrame(list(sent[self.spec.name].values()), self.spec.schema)
            for c, v in equal_to.items():
                df = df.where(F.col(c) == v)
            return df

    from quire.plans import jobs
    real, jobs.ConnectorTable = jobs.ConnectorTable, Store
    try:
        r = [{"review_id": f"r{i}", "product_id": "p", "customer_id": "c", "star_rating": "5"} for i in range(3)]
        for i, rows in enumerate((r, [x | {"star_rating": "2"} for x in r[:2]])):
            keyed_tables_job(spark, feed(f"f{i}", *rows), f"{workdir}/k", store_format="any", store_options={})
        srv = ReviewServing(spark, f"{workdir}/k", "any", {})
        assert [tuple(x) for x in srv.top_backers("2015-08").collect()] == [("c", 1)]
        assert [tuple(x) for x in srv.top_haters("2015-08").collect()] == [("c", 2)]
    finally:
        jobs.ConnectorTable = real


def test_monthly_mart_files_hold_disjoint_ranges_in_order(spark, workdir):
    old = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        document_store_job(spark, _csv(spark, workdir), f"{workdir}/docs")
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    key = ["product_id", "year", "month"]
    df = spark.read.parquet(f"{workdir}/docs/monthly_product_reviews").withColumn("f", F.input_file_name())
    lowest = F.struct(*[F.col(c) for c in key])
    spans = sorted((r.f, tuple(r.lo), tuple(r.hi)) for r in df.groupBy("f").agg(
        F.min(lowest).alias("lo"), F.max(lowest).alias("hi")).collect())
    order = lambda t: tuple((x is not None, x) for x in t)  # noqa: E731  (nulls first, as stored)
    assert len(spans) == 5
    assert all(order(a[2]) <= order(b[1]) for a, b in zip(spans, spans[1:]))


def test_files_with_different_headers_are_refused(spark, workdir):
    import pytest
    one = spark.createDataFrame([("r1", "p1")], "review_id string, product_id string")
    land_csv(one, f"{workdir}/h/a")
    land_csv(one.select("product_id", "review_id"), f"{workdir}/h/b")
    from quire.sources import read_reviews_csv
    with pytest.raises(Exception, match="header"):
        read_reviews_csv(spark, f"{workdir}/h/*").collect()
    got = read_reviews_csv(spark, f"{workdir}/h/b").first()
    assert (got.review_id, got.product_id) == ("r1", "p1")


def test_json_the_variant_parser_refuses(spark):
    big = "x" * 17_000_000
    recs = ['{"author_id":"a","author_id":"b","created_at":"t","text":true}',
            '{"author_id":NaN,"text":"n","other":NaN}', '{"author_id":"c","text":"' + big + '"}',
            "{broken", '{"author_id":"d"']
    df = spark.createDataFrame([(r,) for r in recs], "value string")
    got = {r.author_id: r.text for r in op.archive_rows(df, now="2025-01-01T00:00:00+00:00")
           .select("author_id", F.when(F.length("text") > 100, F.length("text").cast("string"))
                   .otherwise(F.col("text")).alias("text")).collect()}
    assert got["b"] == "True" and got["c"] == str(len(big)) and len(got) == 3
    lines = spark.createDataFrame([('data: {"page_title":"x","page_title":"y","meta":{"domain":"d"}}',)], "value string")
    assert op.sse_to_messages(lines).first().page_title == "y"


def test_small_wrong_answers(spark):
    from quire.functions import is_iso_datetime, iso_utc, strict_date
    df = spark.createDataFrame([("2015-08-31\n",)], "d string")
    assert df.select(strict_date("d")).first()[0] is None
    assert df.select(is_iso_datetime("d")).first()[0] is False
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = spark.sql("select timestamp_ntz'2025-03-09 02:30:00' as t").select(iso_utc(F.col("t"))).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == "2025-03-09T02:30:00.000000+00:00"
