"""Input views derived from the driver's tables (FIXTURES.md §3).

The reference reads dirty review CSVs, tweet CSVs, page-event messages and
server-sent-event lines that are not shipped. These views build inputs of the
same shape from the driver tables, so every query's work grows with them.
Only the columns each view needs are read, so the Parquet scans are pruned.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import encode, iso_utc


@lru_cache(maxsize=128)
def _open(spark: SparkSession, app_id: str, path: str) -> DataFrame:
    return spark.read.parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, opened once per session (file listing and footer read
    happen once, like a catalog table handle; the tables are read-only)."""
    return _open(spark, spark.sparkContext.applicationId, f"{sf_dir.rstrip('/')}/{name}.parquet")


def _prop_k() -> Column:
    return F.get_json_object("props", "$.k")


def reviews_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty, all-string reviews: one per line item.

    Junk ratings ('n/a', '3.0'), unverified purchases, missing bodies and
    unparsable dates appear at fixed rates. ``(order, line)`` is not unique in
    the driver data, so review ids repeat, as the upsert needs.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_returnflag", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    # Orders grows with the line items (a quarter of them), so that join is a
    # sort-merge join at every scale (AQE splits skewed order keys); the part
    # side is broadcast only when its size is under the broadcast threshold.
    joined = (li.join(orders.hint("merge"), li.l_orderkey == orders.o_orderkey)
                .join(part, li.l_partkey == part.p_partkey))
    stars = (F.lit(1) + F.col("l_quantity").cast("int") % 5).cast("string")
    return joined.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("review_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_title"),
        F.col("p_type").alias("product_category"),
        F.when(F.col("l_orderkey") % 97 == 0, F.lit("n/a"))
         .when(F.col("l_orderkey") % 89 == 0, F.concat(stars, F.lit(".0")))
         .otherwise(stars).alias("star_rating"),
        F.when(F.col("l_returnflag") == "R", F.lit("0")).otherwise(F.lit("1")).alias("verified_purchase"),
        F.col("l_linenumber").cast("string").alias("helpful_votes"),
        (F.col("l_linenumber") + 3).cast("string").alias("total_votes"),
        F.col("o_orderpriority").alias("review_headline"),
        F.when(F.col("l_linenumber") == 7, F.lit(None).cast("string"))
         .otherwise(F.concat(F.col("o_orderpriority"), F.lit(" "), F.col("p_name"))).alias("review_body"),
        F.when(F.col("l_suppkey") % 41 == 0, F.lit("bad-date"))
         .otherwise(F.col("l_shipdate").cast("date").cast("string")).alias("review_date"),
    )


def page_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page-create messages as the normaliser emits them (typed columns)."""
    ev = table(spark, sf_dir, "events").select("user_id", "event_type", "props", "ts")
    return ev.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.when(F.col("user_id") % 11 == 0, F.lit(None).cast("boolean"))
         .otherwise(F.col("user_id") % 5 == 0).alias("user_is_bot"),
        # Event type -> wiki domain ('error' has none).
        F.when(F.col("event_type") == "click", F.lit("en.wikipedia.org"))
         .when(F.col("event_type") == "view", F.lit("www.wikidata.org"))
         .when(F.col("event_type") == "purchase", F.lit("commons.wikimedia.org"))
         .when(F.col("event_type") == "signup", F.lit("de.wikipedia.org"))
         .alias("domain"),
        F.concat(F.lit("Page_"), _prop_k()).alias("page_title"),
        iso_utc(F.col("ts")).alias("created_at"),
    )


def page_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as topic records: one JSON ``value`` per event."""
    return page_events(spark, sf_dir).select(
        encode("user_id", "user_is_bot", "domain", "page_title", "created_at",
               keep_nulls=True).alias("value"))


def sse_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Server-sent-event lines: comments, other fields, blanks, broken JSON
    and page-create payloads (some without a user id)."""
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "props")
    user_part = F.when(F.col("user_id") % 7 == 0, F.lit("")) \
        .otherwise(F.concat(F.lit('"user_id":'), F.col("user_id").cast("string"), F.lit(",")))
    bot = F.when(F.col("user_id") % 5 == 0, F.lit("true")).otherwise(F.lit("false"))
    payload = F.concat(
        F.lit('data: {"page_title":"Page_'), _prop_k(), F.lit('","meta":{"domain":"'),
        F.col("event_type"), F.lit('"},"performer":{'), user_part,
        F.lit('"user_is_bot":'), bot, F.lit("}}"))
    eid = F.col("event_id")
    return ev.select(
        F.when(eid % 50 == 0, F.lit(":ok"))
         .when(eid % 51 == 0, F.lit("event: message"))
         .when(eid % 53 == 0, F.lit("data: {broken"))
         .when(eid % 59 == 0, F.lit(""))
         .otherwise(payload).alias("value"))


def tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tweet rows as the CSV the publisher reads (all strings)."""
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "props", "ts")
    return ev.select(
        F.col("event_id").cast("string").alias("tweet_id"),
        F.col("user_id").cast("string").alias("author_id"),
        F.when(F.col("event_id") % 13 == 0, F.lit("not-a-date"))
         .otherwise(iso_utc(F.col("ts"))).alias("created_at"),
        F.concat(F.col("event_type"), F.lit(' said "'), _prop_k(), F.lit('"')).alias("text"),
    )


def _as_messages(t: DataFrame) -> DataFrame:
    return t.select(encode(*t.columns, keep_nulls=True).alias("value"))


def tweet_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tweets as topic records (JSON of every column, nulls kept)."""
    return _as_messages(tweets(spark, sf_dir))


def busy_minutes(spark: SparkSession, sf_dir: str, late: bool) -> DataFrame:
    """The tweets as messages of a busy topic: the stamps of a day all fall into
    its first minute. One half of them (odd tweet ids) comes late."""
    t = tweets(spark, sf_dir)
    odd = F.col("tweet_id").cast("long") % 2 == 1
    day = F.concat(F.substring("created_at", 1, 10), F.lit("T00:00:"), F.substring("created_at", 18, 20))
    return _as_messages(t.where(odd if late else ~odd).withColumn(
        "created_at", F.when(F.col("created_at") == "not-a-date", F.col("created_at")).otherwise(day)))
