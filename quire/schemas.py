"""Declared schemas and keyed-table specs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    BooleanType, DataType, DateType, IntegerType, LongType, StringType, StructField, StructType,
)

# The review CSV header the batch jobs read, in file order.
REVIEW_COLUMNS = [
    "review_id", "product_id", "product_title", "product_category", "customer_id",
    "star_rating", "verified_purchase", "helpful_votes", "total_votes",
    "review_date", "review_headline", "review_body",
]

# Columns cast to int, and the columns a clean row must have.
REVIEW_INT_COLUMNS = ["star_rating", "verified_purchase", "helpful_votes", "total_votes"]
REVIEW_REQUIRED_COLUMNS = ["review_id", "product_id", "star_rating", "review_date"]

# Reviews arrive as an all-string CSV; nothing is inferred.
REVIEWS_RAW_SCHEMA = StructType([StructField(c, StringType(), True) for c in REVIEW_COLUMNS])

# Fields of the page message, published by the event normaliser
# and read by the filter stream, in order.
PAGE_MESSAGE_FIELDS = [("user_id", StringType()), ("user_is_bot", BooleanType()), ("domain", StringType()),
                       ("page_title", StringType()), ("created_at", StringType())]
BOT_FLAG = "user_is_bot"
PAGE_MESSAGE_SCHEMA = StructType([StructField(n, t, True) for n, t in PAGE_MESSAGE_FIELDS])
# The message after the filter stream dropped the bot flag.
PROCESSED_MESSAGE_SCHEMA = StructType([f for f in PAGE_MESSAGE_SCHEMA.fields if f.name != BOT_FLAG])

# Domains the filter stream lets through.
ALLOWED_DOMAINS = ["en.wikipedia.org", "www.wikidata.org", "commons.wikimedia.org"]


@dataclass(frozen=True)
class KeySpec:
    """Primary key of a keyed table.

    ``partition_key`` are the columns a lookup must fix; ``clustering`` are the
    remaining key columns with their stored direction (True = descending).
    Rows are stored in ``buckets`` hash buckets of the partition key, or in a
    directory per value of it (``by_value``, for keys of few values). ``types``
    names the columns that are not text.
    """

    name: str
    partition_key: tuple[str, ...]
    clustering: tuple[tuple[str, bool], ...]
    columns: tuple[str, ...]
    buckets: int = 64
    by_value: bool = False
    types: tuple[tuple[str, DataType], ...] = ()

    @property
    def key(self) -> list[str]:
        return list(self.partition_key) + [c for c, _ in self.clustering]

    @property
    def schema(self) -> StructType:
        own = dict(self.types)
        return StructType([StructField(c, own.get(c, StringType()), True) for c in self.columns])


_REVIEW_TYPES = (("star_rating", IntegerType()), ("review_date", DateType()))

# Keys, order and columns of the keyed serving tables.
REVIEWS_BY_PRODUCT = KeySpec(
    "reviews_by_product", ("product_id",),
    (("star_rating", True), ("review_date", True), ("review_id", False)),
    ("product_id", "star_rating", "review_date", "review_id", "customer_id",
     "product_title", "review_headline", "review_body"),
    types=_REVIEW_TYPES,
)
REVIEWS_BY_CUSTOMER = KeySpec(
    "reviews_by_customer", ("customer_id",),
    (("review_date", True), ("review_id", False)),
    ("customer_id", "review_date", "review_id", "product_id", "product_title",
     "star_rating", "review_headline", "review_body"),
    types=_REVIEW_TYPES,
)
# Leaderboards in an external keyed store: one row per feed's change of a count.
# The title is kept in the key so two titles of one product never collide.
_BOARD_TYPES = (("batch_id", LongType()), ("review_count", LongType()))
TOP_ITEMS_BY_PERIOD = KeySpec(
    "top_reviewed_items_by_period", ("period",),
    (("product_id", False), ("product_title", False), ("batch_id", False)),
    ("period", "product_id", "product_title", "batch_id", "review_count"), types=_BOARD_TYPES,
)
TOP_CUSTOMERS_BY_PERIOD = KeySpec(
    "top_customers_by_period", ("period",),
    (("customer_id", False), ("batch_id", False)),
    ("period", "customer_id", "batch_id", "review_count"), types=_BOARD_TYPES,
)
TOP_SENTIMENT_BY_PERIOD = KeySpec(
    "top_sentiment_by_period", ("period",),
    (("sentiment", False), ("customer_id", False), ("batch_id", False)),
    ("period", "sentiment", "customer_id", "batch_id", "review_count"), types=_BOARD_TYPES,
)
PAGE_CREATIONS = KeySpec(
    "page_creations", ("domain",),
    (("created_at", True), ("user_id", False)),
    ("domain", "created_at", "user_id", "page_title"), by_value=True,
)


# Columns of the per-period leaderboards.
def _schema(**cols) -> StructType:
    return StructType([StructField(k, v, True) for k, v in cols.items()])


TOP_ITEMS_SCHEMA = _schema(period=StringType(), product_id=StringType(),
                           product_title=StringType(), review_count=LongType())
TOP_CUSTOMERS_SCHEMA = _schema(period=StringType(), customer_id=StringType(),
                               review_count=LongType())
TOP_SENTIMENT_SCHEMA = _schema(period=StringType(), customer_id=StringType(),
                               review_count=LongType(), sentiment=StringType())

