"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of SURVEY §2, each over the whole driver tables.

Inputs come from :mod:`quire.sources.fixtures`; each query composes the
library's operators exactly as a job would. Parameters the serving API takes
per request (period, product, customer, n) are fixed here to values that
exist in the test data. ``now`` is injected so stamped outputs are repeatable.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire import operators as op
from quire.plans.jobs import ReviewServing, keyed_tables_job
from quire.schemas import PAGE_CREATIONS, REVIEW_COLUMNS, REVIEWS_BY_CUSTOMER, REVIEWS_BY_PRODUCT
from quire.session import scratch_path
from quire.sinks import (
    KeyedTable, read_minute_archive, write_documents, write_minute_archive, write_records,
)
from quire.sources import (
    fixtures, land_csv, land_lines, read_csv_rows, read_lines, read_reviews_csv,
)
from quire.streaming.jobs import (
    Endpoint, read_counters, read_rejects, start_archive_job, start_filter_job, start_load_job, start_normalise_job,
)

# Request parameters used by the registered serving queries.
PERIOD = "1998-01"
PRODUCT_ID = "42"
STAR_RATING = 5
CUSTOMER_ID = "85"
DOMAIN = "en.wikipedia.org"
TOP_N = 10
# Injected "current time" for the stamping queries.
NOW = "2025-01-01T12:34:56.789012+00:00"

Query = Callable[[SparkSession, str], DataFrame]


# -- shared building blocks ---------------------------------------------------

def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed-table job cleaning (bad dates dropped, ``period`` added)."""
    return op.clean_reviews(fixtures.reviews_raw(spark, sf_dir))


def _clean_keep_bad_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document-store job cleaning (bad dates kept as NULL)."""
    return op.clean_reviews(fixtures.reviews_raw(spark, sf_dir), keep_unparsed_dates=True)


def _landed_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the dirty reviews as CSV to the shared folder and scan them back."""
    path = land_csv(fixtures.reviews_raw(spark, sf_dir).select(*REVIEW_COLUMNS),
                    scratch_path(spark, "reviews-csv"))
    return read_reviews_csv(spark, path)


def _keyed(df: DataFrame, spec) -> DataFrame:
    """Content of a keyed table after the rows were written (upsert on the PK)."""
    return op.latest_per_key(df.select(*spec.columns), spec.key)


def _reviews_by_product_table(spark, sf_dir):
    return _keyed(_clean(spark, sf_dir), REVIEWS_BY_PRODUCT)


def _reviews_by_customer_table(spark, sf_dir):
    return _keyed(_clean(spark, sf_dir), REVIEWS_BY_CUSTOMER)


def _topic(spark: SparkSession, records: DataFrame, name: str) -> DataFrame:
    """Land records as a topic twin (text lines in the shared folder) and read
    them back, as the chained stream jobs exchange them through a topic."""
    path = land_lines(records.select("value"), scratch_path(spark, name))
    return read_lines(spark, path)


def _input_topic(spark, sf_dir):
    """The page-event topic the normaliser publishes to."""
    return _topic(spark, fixtures.page_messages(spark, sf_dir), "topic-input")


def _processed_topic(spark, sf_dir):
    """The filter job's output topic, read by the load job."""
    return _topic(spark, op.wiki_filter(_input_topic(spark, sf_dir)), "topic-processed")


def _processed_pages(spark, sf_dir):
    return op.decode_processed(_processed_topic(spark, sf_dir))


def _page_creations(spark, sf_dir):
    return _keyed(_processed_pages(spark, sf_dir), PAGE_CREATIONS)


def _archive(spark, sf_dir):
    return op.archive_rows(fixtures.tweet_messages(spark, sf_dir), now=NOW)


# -- the queries --------------------------------------------------------------

def scan_reviews(spark, sf_dir):
    return _landed_reviews(spark, sf_dir)


def profile_reviews(spark, sf_dir):
    return op.profile(_landed_reviews(spark, sf_dir))


def clean_reviews(spark, sf_dir):
    return _clean(spark, sf_dir)


def clean_reviews_keep_bad_dates(spark, sf_dir):
    return _clean_keep_bad_dates(spark, sf_dir)


def stage_counts(spark, sf_dir):
    return op.review_stage_counts(fixtures.reviews_raw(spark, sf_dir))


def product_stats(spark, sf_dir):
    return op.product_stats(_clean_keep_bad_dates(spark, sf_dir))


def customer_stats(spark, sf_dir):
    return op.customer_stats(_clean_keep_bad_dates(spark, sf_dir))


def monthly_product_reviews(spark, sf_dir):
    return op.monthly_product_reviews(_clean_keep_bad_dates(spark, sf_dir))


def items_by_period(spark, sf_dir):
    return op.items_by_period(_clean(spark, sf_dir))


def customers_by_period(spark, sf_dir):
    return op.customers_by_period(_clean(spark, sf_dir))


def sentiment_by_period(spark, sf_dir):
    return op.sentiment_by_period(_clean(spark, sf_dir))


def reviews_by_product(spark, sf_dir):
    return op.review_projection(_clean(spark, sf_dir), REVIEWS_BY_PRODUCT.columns)


def reviews_by_customer(spark, sf_dir):
    return op.review_projection(_clean(spark, sf_dir), REVIEWS_BY_CUSTOMER.columns)


def sentiment_by_period_union(spark, sf_dir):
    """The literal two-filter union form of the sentiment mart (G1)."""
    return op.sentiment_by_period(_clean(spark, sf_dir), one_pass=False)


def keyed_reviews_by_product(spark, sf_dir):
    """Content of the product-keyed review table after the write (PK upsert)."""
    return _reviews_by_product_table(spark, sf_dir)


def keyed_reviews_by_customer(spark, sf_dir):
    """Content of the customer-keyed review table after the write (PK upsert)."""
    return _reviews_by_customer_table(spark, sf_dir)


@lru_cache(maxsize=16)
def _stored(spark: SparkSession, app_id: str, sf_dir: str) -> ReviewServing:
    """The tables and boards as the keyed-tables job writes them, once a session:
    the serving queries below are lookups in this store."""
    root = scratch_path(spark, "review-store")
    csv = land_csv(fixtures.reviews_raw(spark, sf_dir).select(*REVIEW_COLUMNS), f"{root}/feed",
                   compression="lz4")
    keyed_tables_job(spark, csv, f"{root}/tables")
    return ReviewServing(spark, f"{root}/tables")


def _serving(spark: SparkSession, sf_dir: str) -> ReviewServing:
    return _stored(spark, spark.sparkContext.applicationId, sf_dir)


def reviews_of_product(spark, sf_dir):
    return _serving(spark, sf_dir).reviews_by_product(PRODUCT_ID)


def reviews_of_product_rating(spark, sf_dir):
    return _serving(spark, sf_dir).reviews_by_product(PRODUCT_ID, STAR_RATING)


def reviews_of_customer(spark, sf_dir):
    return _serving(spark, sf_dir).reviews_by_customer(CUSTOMER_ID)


def top_products(spark, sf_dir):
    return _serving(spark, sf_dir).top_products(PERIOD, TOP_N)


def top_customers(spark, sf_dir):
    return _serving(spark, sf_dir).top_customers(PERIOD, TOP_N)


def top_haters(spark, sf_dir):
    return _serving(spark, sf_dir).top_haters(PERIOD, TOP_N)


def top_backers(spark, sf_dir):
    return _serving(spark, sf_dir).top_backers(PERIOD, TOP_N)


def top_products_all_periods(spark, sf_dir):
    return op.top_products_all_periods(op.items_by_period(_clean(spark, sf_dir)), TOP_N)


def upsert_latest_review(spark, sf_dir):
    """Reviews keyed by review id alone (ids repeat): the latest date wins."""
    rows = op.review_projection(_clean(spark, sf_dir), REVIEWS_BY_PRODUCT.columns)
    return op.latest_per_key(rows, ["review_id"], order=["review_date"])


def wiki_filter(spark, sf_dir):
    return op.wiki_filter(_input_topic(spark, sf_dir))


def wiki_roundtrip(spark, sf_dir):
    return _processed_pages(spark, sf_dir)


def page_creations(spark, sf_dir):
    return _page_creations(spark, sf_dir)


def newest_pages(spark, sf_dir):
    """Newest pages of one domain, from the table the load job writes."""
    table = KeyedTable(spark, scratch_path(spark, "pages"), PAGE_CREATIONS)
    table.write_batch(_processed_pages(spark, sf_dir))
    return op.newest_pages(table.read(domain=DOMAIN), DOMAIN, TOP_N)


def sse_events(spark, sf_dir):
    return op.sse_to_messages(fixtures.sse_lines(spark, sf_dir), now=NOW)


def event_messages(spark, sf_dir):
    """The normaliser's output: event lines -> JSON page messages, nulls kept."""
    return op.encode_rows(op.sse_to_messages(fixtures.sse_lines(spark, sf_dir), now=NOW))


def publish_tweets(spark, sf_dir):
    """Tweets CSV (read as dict-like rows) -> stamped JSON messages."""
    t = fixtures.tweets(spark, sf_dir)
    path = land_csv(t, scratch_path(spark, "tweets-csv"))
    return op.publish_rows(read_csv_rows(spark, path, t.columns), now=NOW)


def tweets_archive_rows(spark, sf_dir):
    return _archive(spark, sf_dir)


def tweets_minute_files(spark, sf_dir):
    return _archive(spark, sf_dir).groupBy("file_name").agg(F.count(F.lit(1)).alias("n_rows"))


# -- the stream jobs, run to completion over file twins ----------------------
# Each starts the real Structured Streaming job(s) with an ``availableNow``
# trigger on records landed from the driver tables, waits for them, and
# returns what the sink holds; the result must equal the batch twin above.
# (The archive queries take the busy-minute messages: one directory per minute
# of the plain tweets' month of stamps would be tens of thousands of tiny files.)

def _finish(query) -> None:
    query.awaitTermination()
    query.stop()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def stream_page_creations(spark, sf_dir):
    """Generator topic -> filter stream -> processed topic -> load stream."""
    once = {"availableNow": True}
    src = land_lines(fixtures.page_messages(spark, sf_dir), scratch_path(spark, "stream-input"))
    processed = scratch_path(spark, "stream-processed")
    _finish(start_filter_job(spark, Endpoint(path=src), Endpoint(path=processed),
                             checkpoint=scratch_path(spark, "ckpt-filter"), trigger=once))
    table = KeyedTable(spark, scratch_path(spark, "stream-pages"), PAGE_CREATIONS)
    _finish(start_load_job(spark, Endpoint(path=processed), table,
                           checkpoint=scratch_path(spark, "ckpt-load"), trigger=once))
    return table.read()


def stream_event_messages(spark, sf_dir):
    """Landed event lines -> normaliser stream -> message records."""
    src = land_lines(fixtures.sse_lines(spark, sf_dir), scratch_path(spark, "stream-sse"))
    out = scratch_path(spark, "stream-messages")
    _finish(start_normalise_job(spark, Endpoint(path=src), Endpoint(path=out),
                                checkpoint=scratch_path(spark, "ckpt-normalise"),
                                trigger={"availableNow": True}, now=NOW))
    return read_lines(spark, out)


# -- a second feed, a restart, and the batch sinks --------------------------------

def _landed_clean(spark, sf_dir):
    path = scratch_path(spark, "clean")
    _clean(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


def keyed_two_feeds(spark, sf_dir):
    """The review table after two feeds (odd and even product ids)."""
    table = KeyedTable(spark, scratch_path(spark, "two-feeds"), REVIEWS_BY_PRODUCT)
    clean = _landed_clean(spark, sf_dir)
    odd = F.col("product_id").cast("long") % 2 == 1
    table.write_batch(clean.where(odd))
    table.write_batch(clean.where(~odd))
    return table.read()


def keyed_replay(spark, sf_dir):
    """The review table after a batch of everything was replayed with fewer and
    corrected rows: odd products only, the headline replaced."""
    table = KeyedTable(spark, scratch_path(spark, "replayed"), REVIEWS_BY_PRODUCT)
    clean = _landed_clean(spark, sf_dir)
    table.write_batch(clean)
    corrected = (clean.where(F.col("product_id").cast("long") % 2 == 1)
                      .withColumn("review_headline", F.concat(F.lit("corrected "), F.col("review_headline"))))
    table.write_batch(corrected, 0, replay=True)
    return table.read()


def _feeds(spark, name, *feeds):
    """Serving over the keyed-tables job's store after feeds of raw reviews."""
    root = scratch_path(spark, name)
    for i, rows in enumerate(feeds):
        feed = land_csv(rows.select(*REVIEW_COLUMNS), f"{root}/feed-{i}", compression="lz4")
        keyed_tables_job(spark, feed, f"{root}/tables")
    return ReviewServing(spark, f"{root}/tables")


def boards_two_feeds(spark, sf_dir):
    """The customer board after two runs of the job over two feeds of the same
    periods: every customer counted over both, a review in both as the second has it."""
    raw = fixtures.reviews_raw(spark, sf_dir)
    odd = F.col("product_id").cast("long") % 2 == 1
    return _feeds(spark, "boards", raw.where(odd), raw.where(~odd)).board("top_customers_by_period")


def boards_after_correction(spark, sf_dir):
    """All three boards after a second feed that corrects every review of one
    period: products with an even id get one star, and all move to the next year,
    so the period is emptied."""
    raw = fixtures.reviews_raw(spark, sf_dir)
    even = F.col("product_id").cast("long") % 2 == 0
    fixed = (raw.where(F.col("review_date").startswith(f"{PERIOD}-"))
                .withColumn("star_rating", F.when(even, F.lit("1")).otherwise(F.col("star_rating")))
                .withColumn("review_date", F.concat((F.substring("review_date", 1, 4).cast("int") + 1).cast("string"),
                                                    F.lit("-"), F.lit(PERIOD[5:]), F.lit("-15"))))
    store = _feeds(spark, "corrected", raw, fixed)
    none = F.lit(None).cast("string")
    items, people, tagged = (store.board(b) for b in (
        "top_reviewed_items_by_period", "top_customers_by_period", "top_sentiment_by_period"))
    return (items.select(F.lit("items").alias("board"), "period", F.col("product_id").alias("id"),
                         F.col("product_title").alias("label"), "review_count")
            .union(people.select(F.lit("customers"), "period", "customer_id", none, "review_count"))
            .union(tagged.select(F.lit("sentiment"), "period", "customer_id", "sentiment", "review_count")))


def stream_load_restart(spark, sf_dir):
    """The load stream run, stopped and run again (its own default checkpoint)
    after more records arrived."""
    once = {"availableNow": True}
    records = op.wiki_filter(fixtures.page_messages(spark, sf_dir))
    first = F.pmod(F.xxhash64("value"), F.lit(2)) == 0
    src = scratch_path(spark, "restart-topic")
    table = KeyedTable(spark, scratch_path(spark, "restart-pages"), PAGE_CREATIONS)
    for i, part in enumerate((records.where(first), records.where(~first))):
        land_lines(part, f"{src}/part-{i}")
        _finish(start_load_job(spark, Endpoint(path=f"{src}/*"), table, trigger=once))
    return table.read()


def archive_files(spark, sf_dir):
    """The batch archive of the busy minutes, written and read back."""
    path = scratch_path(spark, "archive")
    for late in (False, True):
        write_minute_archive(op.archive_rows(fixtures.busy_minutes(spark, sf_dir, late), now=NOW), path)
    return read_minute_archive(spark, path)


def stream_archive(spark, sf_dir):
    """The archive stream over the same messages: run, stopped, and run again
    when the late half had come; read through the sink's commit log."""
    src, out = scratch_path(spark, "busy-topic"), scratch_path(spark, "stream-archive")
    for late in (False, True):
        land_lines(fixtures.busy_minutes(spark, sf_dir, late), f"{src}/late-{late}")
        _finish(start_archive_job(spark, Endpoint(path=f"{src}/*"), out, trigger={"availableNow": True}, now=NOW,
                                  writers_per_minute=4))
    return read_minute_archive(spark, out)


def _load_all_messages(spark, sf_dir, name):
    """The load stream over unfiltered messages with broken ones among them, run
    and, when the second half had come, run again: (rejects, counters) paths."""
    ev = fixtures.page_messages(spark, sf_dir)
    domain, half = F.get_json_object("value", "$.domain"), F.pmod(F.xxhash64("value"), F.lit(2))
    bad = (F.when(domain == "de.wikipedia.org", F.concat(F.lit("{broken "), F.col("value")))
            .when(domain == "commons.wikimedia.org", F.to_json(F.array("value"))).otherwise(F.col("value")))
    root = scratch_path(spark, name)
    table = KeyedTable(spark, f"{root}/pages", PAGE_CREATIONS)
    for i in (0, 1):
        land_lines(ev.where(half == i).select(bad.alias("value")), f"{root}/topic/part-{i}")
        _finish(start_load_job(spark, Endpoint(path=f"{root}/topic/*"), table, trigger={"availableNow": True},
                               rejects_path=f"{root}/rejects", counters_path=f"{root}/counters"))
    return f"{root}/rejects", f"{root}/counters"


def stream_rejects(spark, sf_dir):
    """Messages that the load stream rejected, as they came, and why."""
    return read_rejects(spark, _load_all_messages(spark, sf_dir, "stream-rejects")[0])


def stream_counters(spark, sf_dir):
    """The load stream's counters over both of its runs."""
    return read_counters(spark, _load_all_messages(spark, sf_dir, "stream-counters")[1])


def document_marts(spark, sf_dir):
    """The document-store job's product mart, written twice (replaced whole) and read back."""
    root = scratch_path(spark, "documents")
    mart = op.product_stats(_clean_keep_bad_dates(spark, sf_dir))
    for _ in range(2):
        write_documents(mart, f"{root}/product_stats")
    return spark.read.parquet(f"{root}/product_stats")


def publish_records(spark, sf_dir):
    """The publisher's messages appended to a topic twin and read back."""
    topic = scratch_path(spark, "topic-tweets")
    write_records(op.publish_rows(fixtures.tweets(spark, sf_dir), now=NOW), topic)
    return read_lines(spark, topic)


QUERIES: dict[str, Query] = {f.__name__: f for f in [
    scan_reviews, profile_reviews, clean_reviews, clean_reviews_keep_bad_dates, stage_counts,
    product_stats, customer_stats, monthly_product_reviews, items_by_period,
    customers_by_period, sentiment_by_period, reviews_by_product, reviews_by_customer,
    reviews_of_product, reviews_of_product_rating, reviews_of_customer, top_products,
    top_customers, top_haters, top_backers, top_products_all_periods, upsert_latest_review,
    wiki_filter, wiki_roundtrip, page_creations, newest_pages, sse_events, publish_tweets,
    tweets_archive_rows, tweets_minute_files, sentiment_by_period_union,
    keyed_reviews_by_product, keyed_reviews_by_customer, event_messages,
    stream_page_creations, stream_event_messages, keyed_two_feeds, boards_two_feeds,
    stream_load_restart, document_marts, publish_records, keyed_replay, boards_after_correction,
    archive_files, stream_archive, stream_rejects, stream_counters,
]}
