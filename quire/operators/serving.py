"""Serving queries over the keyed tables.

Each returns a lazily planned DataFrame in the response's column order. An
empty result is the "nothing found" outcome (check with ``isEmpty()``).
Lookups are equality filters on the table's key, which Catalyst pushes into
the Parquet scan (and, on the keyed layout, into partition pruning).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import null_to_empty, to_text

# The accepted range of a top-N size and of a star rating.
TOP_N_MIN, TOP_N_MAX, TOP_N_DEFAULT = 1, 100, 10
STAR_MIN, STAR_MAX = 1, 5


def check_n(n: int) -> int:
    if not isinstance(n, int) or isinstance(n, bool) or not TOP_N_MIN <= n <= TOP_N_MAX:
        raise ValueError(f"n must be an integer in [{TOP_N_MIN}, {TOP_N_MAX}], got {n!r}")
    return n


def check_star_rating(star_rating: int) -> int:
    if not isinstance(star_rating, int) or isinstance(star_rating, bool) \
            or not STAR_MIN <= star_rating <= STAR_MAX:
        raise ValueError(f"star_rating must be between {STAR_MIN} and {STAR_MAX}, got {star_rating!r}")
    return star_rating


def _review_fields(with_customer: bool) -> list[Column]:
    cols = [F.col("review_id"), F.col("product_id")]
    if with_customer:
        cols.append(F.col("customer_id"))
    return cols + [F.col("product_title"), F.col("star_rating"), F.col("review_headline"),
                   null_to_empty("review_body").alias("review_body"),
                   to_text("review_date").alias("review_date")]


def reviews_of_product(reviews_by_product: DataFrame, product_id: str,
                       star_rating: int | None = None) -> DataFrame:
    """All reviews of a product (optionally of one rating), in stored order:
    star DESC, date DESC, id ASC."""
    df = reviews_by_product.where(F.col("product_id") == F.lit(str(product_id)))
    if star_rating is not None:
        df = df.where(F.col("star_rating") == F.lit(check_star_rating(star_rating)))
    return (df.orderBy(F.col("star_rating").desc(), F.col("review_date").desc(),
                       F.col("review_id").asc())
              .select(*_review_fields(with_customer=True)))


def reviews_of_customer(reviews_by_customer: DataFrame, customer_id: str) -> DataFrame:
    """All reviews by a customer: date DESC, id ASC."""
    df = reviews_by_customer.where(F.col("customer_id") == F.lit(str(customer_id)))
    return (df.orderBy(F.col("review_date").desc(), F.col("review_id").asc())
              .select(*_review_fields(with_customer=False)))


def _top(df: DataFrame, order: list[Column], columns: list[str], n: int) -> DataFrame:
    # orderBy + limit plans as TakeOrderedAndProject: each task keeps its own
    # top n, only n rows per task reach the final merge.
    return df.orderBy(*order).limit(n).select(*columns)


def top_products(items_by_period: DataFrame, period: str, n: int = TOP_N_DEFAULT) -> DataFrame:
    """Most reviewed products of a period: count DESC, id ASC (title ASC)."""
    df = items_by_period.where(F.col("period") == F.lit(period))
    return _top(df, [F.col("review_count").desc(), F.col("product_id").asc(),
                     F.col("product_title").asc()],
                ["product_id", "product_title", "review_count"], check_n(n))


def top_customers(customers_by_period: DataFrame, period: str, n: int = TOP_N_DEFAULT) -> DataFrame:
    """Most active customers of a period: count DESC, id ASC."""
    df = customers_by_period.where(F.col("period") == F.lit(period))
    return _top(df, [F.col("review_count").desc(), F.col("customer_id").asc()],
                ["customer_id", "review_count"], check_n(n))


def top_by_sentiment(sentiment_by_period: DataFrame, period: str, sentiment: str,
                     n: int = TOP_N_DEFAULT) -> DataFrame:
    df = sentiment_by_period.where((F.col("period") == F.lit(period))
                                   & (F.col("sentiment") == F.lit(sentiment)))
    return _top(df, [F.col("review_count").desc(), F.col("customer_id").asc()],
                ["customer_id", "review_count"], check_n(n))


def top_haters(sentiment_by_period: DataFrame, period: str, n: int = TOP_N_DEFAULT) -> DataFrame:
    return top_by_sentiment(sentiment_by_period, period, "hater", n)


def top_backers(sentiment_by_period: DataFrame, period: str, n: int = TOP_N_DEFAULT) -> DataFrame:
    return top_by_sentiment(sentiment_by_period, period, "backer", n)


def top_n_per_group(df: DataFrame, group: list[str], order: list[Column], n: int,
                    rank_col: str = "rank") -> DataFrame:
    """Top-n rows of every group at once.

    ``row_number() <= n`` lets Spark insert a partial WindowGroupLimit before
    the shuffle, so at most n rows per group leave each map task even when a
    single group holds most of the data.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    return (df.withColumn(rank_col, F.row_number().over(w))
              .where(F.col(rank_col) <= F.lit(n)))


def top_products_all_periods(items_by_period: DataFrame, n: int = TOP_N_DEFAULT) -> DataFrame:
    return top_n_per_group(items_by_period, ["period"],
                           [F.col("review_count").desc(), F.col("product_id").asc(),
                            F.col("product_title").asc()], n) \
        .select("period", "rank", "product_id", "product_title", "review_count")


def newest_pages(page_creations: DataFrame, domain: str | None = None,
                 n: int = TOP_N_DEFAULT) -> DataFrame:
    """Newest page creations (of one domain): created_at DESC, user_id ASC."""
    df = page_creations
    if domain is not None:
        df = df.where(F.col("domain") == F.lit(domain))
    return _top(df, [F.col("created_at").desc(), F.col("user_id").asc(), F.col("domain").asc()],
                ["domain", "created_at", "user_id", "page_title"], n)
