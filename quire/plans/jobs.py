"""End-to-end batch jobs and the serving facade.

The reference scans its CSV once per count and once per write (7-8 scans).
Here each job scans the CSV once: stage counts ride on that pass as
observations, the clean rows are landed as Parquet in the shared folder
(cutting lineage; a lost executor recomputes from Parquet, not from the
unsplittable multi-line CSV), and every mart is derived from the landed copy.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire import operators as op
from quire.schemas import (
    REVIEWS_BY_CUSTOMER, REVIEWS_BY_PRODUCT, TOP_CUSTOMERS_BY_PERIOD, TOP_CUSTOMERS_SCHEMA,
    TOP_ITEMS_BY_PERIOD, TOP_ITEMS_SCHEMA, TOP_SENTIMENT_BY_PERIOD, TOP_SENTIMENT_SCHEMA,
)
from quire.functions import period_of
from quire.operators.keyed import latest_per_key
from quire.session import discard, scratch_path, tasks_for
from quire.sinks import ConnectorTable, CountTable, KeyedTable, write_documents
from quire.sinks.keyed import BATCH_COL, BUCKET_COL
from quire.sources import read_reviews_csv


FILE_FORMATS = ("parquet", "orc", "json", "csv")


def _together(*jobs) -> None:
    """Run small Spark jobs side by side."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        for done in [pool.submit(job) for job in jobs]:
            done.result()


def _land_clean(spark: SparkSession, reviews_path: str, keep_unparsed_dates: bool, path: str) -> tuple[DataFrame, dict]:
    raw, raw_obs = op.observed(read_reviews_csv(spark, reviews_path), "raw_rows")
    clean, clean_obs = op.observed(op.clean_reviews(raw, keep_unparsed_dates=keep_unparsed_dates),
                                   "clean_rows")
    clean.write.mode("overwrite").parquet(path)
    counts = {"raw": raw_obs.get["rows"], "clean": clean_obs.get["rows"]}
    return spark.read.parquet(path), counts


def document_store_job(spark: SparkSession, reviews_path: str | list[str], out_root: str,
                       format: str = "parquet", options: dict | None = None,
                       work_path: str | None = None) -> dict:
    """Reviews CSV -> clean (bad dates kept) -> 3 marts, each replaced whole.

    With a connector ``format`` the collection name is added to ``options``.
    Returns the stage row counts.
    """
    landed = work_path or scratch_path(spark, "clean-reviews")
    clean, counts = _land_clean(spark, reviews_path, True, landed)
    marts = {
        "product_stats": op.product_stats(clean),
        "customer_stats": op.customer_stats(clean),
        # files of disjoint key ranges, in order: the mart's order is the stored order
        "monthly_product_reviews": op.monthly_product_reviews(clean, ordered=False)
                                     .repartitionByRange("product_id", "year", "month")
                                     .sortWithinPartitions("product_id", "year", "month"),
    }
    for name, df in marts.items():
        df, obs = op.observed(df, name)
        opts = dict(options or {})
        if format not in FILE_FORMATS:
            opts.setdefault("collection", name)
        target = f"{out_root.rstrip('/')}/{name}" if format in FILE_FORMATS else None
        write_documents(df, target, format, opts)
        counts[name] = obs.get["rows"]
    if not work_path:
        discard(spark, landed)
    return counts


# A review is told by these columns on either side of the store; a later feed that
# brings it again replaces all of its rows in the boards.
_PRODUCT_SIDE, _CUSTOMER_SIDE = ["product_id", "review_id"], ["customer_id", "review_id"]
# The leaderboards, with their stored columns.
BOARDS = {"top_reviewed_items_by_period": (TOP_ITEMS_BY_PERIOD, TOP_ITEMS_SCHEMA),
          "top_customers_by_period": (TOP_CUSTOMERS_BY_PERIOD, TOP_CUSTOMERS_SCHEMA),
          "top_sentiment_by_period": (TOP_SENTIMENT_BY_PERIOD, TOP_SENTIMENT_SCHEMA)}


def _board(spark: SparkSession, root: str, name: str) -> CountTable:
    return CountTable(spark, f"{root}/{name}", BOARDS[name][1], "period")


def _changed_reviews(table: KeyedTable, batch: int, review: list[str], columns: list[str]) -> tuple[DataFrame, int]:
    """The review rows that ``batch`` brought (as stored, so a key may repeat) and
    about how many these are. When there are earlier batches, also those they
    replace, the rows of these reviews in the last earlier batch that had them, told
    by ``sign`` (1 and -1). Only the buckets that the batch touches are read."""
    key = table.spec.key
    cols = list(dict.fromkeys([*key, *review, *columns]))
    mine = table.log([batch])
    new, size = mine.select(*cols), mine.count()
    if table.snapshot() is None and min(table.batches()) == batch:
        return new, size
    touched = [r[BUCKET_COL] for r in mine.select(BUCKET_COL).distinct().collect()]  # at most the bucket count
    # the earlier rows stream past the batch's reviews: no sort of the table
    asked = mine.select(BUCKET_COL, *review).distinct().hint("shuffle_hash")
    found = (table.versions(below=batch).where(F.col(BUCKET_COL).isin(touched)).select(*cols, BATCH_COL, BUCKET_COL)
                  .join(asked, [BUCKET_COL, *review], "left_semi"))
    # both follow the join's exchange: the versions of a review meet in one task, spilling if need be
    last = F.max(BATCH_COL).over(Window.partitionBy(BUCKET_COL, *review))
    old = (latest_per_key(found, [BUCKET_COL, *key], order=[BATCH_COL])
           .withColumn("_last", last).where(F.col(BATCH_COL) == F.col("_last")))
    one = F.lit(1).cast("long")
    return new.withColumn("sign", one).union(old.select(*cols, -one)), 2 * size


def _by_month(table: KeyedTable, batch: int, review: list[str], columns: list[str]) -> DataFrame:
    """The changed reviews of ``batch`` with their ``period``, one row a key and
    sign, exchanged once by ranges of period and partition key. A key has its date
    among its columns, so it is whole in its range, and so is every group by period
    and partition key: the counts and the stored order need no other exchange."""
    rows, size = _changed_reviews(table, batch, review, columns)
    spread = rows.withColumn("period", period_of("review_date")).repartitionByRange(
        tasks_for(rows.sparkSession, size), "period", *table.spec.partition_key)
    signed = [c for c in spread.columns if c == "sign"]
    latest = latest_per_key(spread, ["period", *table.spec.key, *signed], drop_null_keys=False)
    return latest if signed else latest.withColumn("sign", F.lit(1).cast("long"))


def _net(changes: DataFrame, *key: str) -> DataFrame:
    return (changes.groupBy(*key).agg(F.sum("sign").alias("review_count")).where("review_count != 0"))


def _board_changes(by_product: KeyedTable, by_customer: KeyedTable, batch: int) -> tuple[dict[str, DataFrame], DataFrame]:
    """:func:`board_changes`, and what is kept for them until they are written."""
    stars, sign = F.col("star_rating"), F.col("sign")
    items = _by_month(by_product, batch, _PRODUCT_SIDE, ["product_id", "review_date", "product_title"])
    people = _by_month(by_customer, batch, _CUSTOMER_SIDE,
                       ["customer_id", "review_date", "product_id", "product_title", "star_rating"])
    # both customer boards come from one pass over the changes
    tags = [(op.marts.BACKER, stars >= op.marts.BACKER_MIN_STARS),  # as their stored key orders them
            (op.marts.HATER, stars <= op.marts.HATER_MAX_STARS)]
    counts = (people.groupBy("period", "customer_id")
                    .agg(F.sum("sign").alias("review_count"),
                         *[F.sum(F.when(cond, sign).otherwise(F.lit(0).cast("long"))).alias(tag) for tag, cond in tags])
                    .sortWithinPartitions("period", "customer_id").persist(StorageLevel.DISK_ONLY))
    tagged = counts.select("period", "customer_id", F.explode(F.array(*[
        F.struct(F.col(tag).alias("review_count"), F.lit(tag).alias("sentiment")) for tag, _ in tags])).alias("_t"))
    return {
        "top_reviewed_items_by_period": _net(items, "period", "product_id", "product_title")
                                        .sortWithinPartitions("period", "product_id", "product_title"),
        "top_customers_by_period": counts.select("period", "customer_id", "review_count").where("review_count != 0"),
        "top_sentiment_by_period": tagged.select("period", "customer_id", "_t.*").where("review_count != 0"),
    }, counts


def board_changes(by_product: KeyedTable, by_customer: KeyedTable, batch: int) -> dict[str, DataFrame]:
    """What ``batch`` changes in each leaderboard: signed counts by its key, in
    ranges and order of that key."""
    return _board_changes(by_product, by_customer, batch)[0]


def keyed_tables_job(spark: SparkSession, reviews_path: str | list[str], root: str, batch_id: int | None = None,
                     work_path: str | None = None, store_format: str | None = None,
                     store_options: dict | None = None) -> dict:
    """Reviews CSV -> clean (bad dates dropped) -> 2 keyed review tables
    (upsert) and 3 per-period leaderboards.

    Every run adds a batch of its own, so a second feed adds to the first;
    giving the ``batch_id`` of an earlier run replays it, whole. The boards
    count the stored rows of each review as its last feed had it: a corrected
    rating or date moves it and an emptied period goes. They are kept as each
    batch's signed changes, computed from the reviews in the feed and what the
    tables held of them before, and summed on reading.

    Tables are Parquet under ``root``; with ``store_format`` (a keyed-store
    connector) all five go to that store too, the table name added to
    ``store_options``. The tables under ``root`` are still kept then: the
    changes need the earlier versions, which such a store does not have.
    """
    root = root.rstrip("/")
    landed = work_path or scratch_path(spark, "clean-reviews")
    clean, counts = _land_clean(spark, reviews_path, False, landed)

    def store(spec):
        return ConnectorTable(spark, spec, store_format, {**(store_options or {}), "table": spec.name})

    tables = [KeyedTable(spark, f"{root}/{spec.name}", spec) for spec in (REVIEWS_BY_PRODUCT, REVIEWS_BY_CUSTOMER)]

    # the number that is free in the first table is this run's in all of them
    replay = batch_id is not None
    batch_id, attempt = tables[0].claim(batch_id, replay)

    def write(table: KeyedTable) -> None:
        res = table.write_claimed(clean, *((batch_id, attempt) if table is tables[0] else table.claim(batch_id, True)))
        counts[table.spec.name] = res["rows"]
        counts[f"{table.spec.name}_rejected"] = res["rejected"]
        if store_format:
            store(table.spec).write_batch(clean, batch_id)

    _together(*[partial(write, t) for t in tables])

    def tell(batch: int, name: str, changes: DataFrame) -> None:
        board = _board(spark, root, name)
        written = board.write_batch(changes, batch, replay=True, clustered=True)
        if batch == batch_id:
            counts[name] = written
        if store_format:
            rows = board.log([batch]).withColumn("batch_id", F.lit(batch).cast("long"))
            store(BOARDS[name][0]).write_batch(rows, batch)

    # a replayed batch, or one that another run overtook, changes what later ones did;
    # a run that stopped before its boards left them to the next one
    told = set.intersection(*[set(_board(spark, root, name).batches()) for name in BOARDS])
    for batch in [n for n in tables[1].batches() if n >= batch_id or n not in told]:
        changes, held = _board_changes(*tables, batch)
        items, *people = [partial(tell, batch, name, rows) for name, rows in changes.items()]
        # the second board of the customers reads what the first has computed
        _together(items, lambda: [board() for board in people])
        held.unpersist()
    if not work_path:
        discard(spark, landed)
    return counts


class ReviewServing:
    """The serving lookups (K1-K7) over tables written by :func:`keyed_tables_job`
    (in ``store_format`` when given, as the job wrote them)."""

    def __init__(self, spark: SparkSession, root: str, store_format: str | None = None,
                 store_options: dict | None = None):
        self.spark, self.root = spark, root.rstrip("/")

        def table(spec):
            if store_format:
                return ConnectorTable(spark, spec, store_format,
                                      {**(store_options or {}), "table": spec.name})
            return KeyedTable(spark, f"{self.root}/{spec.name}", spec)

        self.by_product = table(REVIEWS_BY_PRODUCT)
        self.by_customer = table(REVIEWS_BY_CUSTOMER)
        self._table, self._store = table, store_format

    def board(self, name: str, period: str | None = None) -> DataFrame:
        """A leaderboard (of one period): the changes of all feeds, summed."""
        spec, schema = BOARDS[name]
        if not self._store:
            table = _board(self.spark, self.root, name)
            return table.read(period=period) if period is not None else table.read()
        rows = self._table(spec).read(**({} if period is None else {"period": period}))
        return (_net(rows.withColumnRenamed("review_count", "sign"), *[c for c in schema.fieldNames() if c != "review_count"])
                .select(*schema.fieldNames()))

    def reviews_by_product(self, product_id: str, star_rating: int | None = None) -> DataFrame:
        if star_rating is not None:
            op.serving.check_star_rating(star_rating)
        return op.reviews_of_product(self.by_product.read(product_id=str(product_id)),
                                     product_id, star_rating)

    def reviews_by_customer(self, customer_id: str) -> DataFrame:
        return op.reviews_of_customer(self.by_customer.read(customer_id=str(customer_id)),
                                      customer_id)

    def top_products(self, period: str, n: int = 10) -> DataFrame:
        return op.top_products(self.board("top_reviewed_items_by_period", period), period, n)

    def top_customers(self, period: str, n: int = 10) -> DataFrame:
        return op.top_customers(self.board("top_customers_by_period", period), period, n)

    def top_haters(self, period: str, n: int = 10) -> DataFrame:
        return op.top_haters(self.board("top_sentiment_by_period", period), period, n)

    def top_backers(self, period: str, n: int = 10) -> DataFrame:
        return op.top_backers(self.board("top_sentiment_by_period", period), period, n)
