"""Mart semantics on hand-made rows."""

import datetime as dt

from quire import operators as op

D = dt.date(2020, 1, 5)


def _clean(spark, rows):
    return spark.createDataFrame(
        rows, "review_id string, customer_id string, product_id string, product_title string, "
              "star_rating int, review_date date, period string")


def test_sentiment_ratings_1_to_5(spark):
    df = _clean(spark, [(f"r{i}", "c1", "p", "t", i, D, "2020-01") for i in range(1, 6)])
    got = {(r["sentiment"], r["review_count"]) for r in op.sentiment_by_period(df).collect()}
    assert got == {("hater", 2), ("backer", 2)}


def test_sentiment_one_pass_equals_union(spark):
    rows = [(f"r{i}", f"c{i % 7}", "p", "t", i % 6, D, f"2020-0{1 + i % 3}") for i in range(200)]
    df = _clean(spark, rows)
    a = op.sentiment_by_period(df, one_pass=True)
    b = op.sentiment_by_period(df, one_pass=False)
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_two_titles_stay_two_rows(spark):
    df = _clean(spark, [("r1", "c", "p", "A", 5, D, "2020-01"), ("r2", "c", "p", "B", 4, D, "2020-01")])
    assert op.items_by_period(df).count() == 2
    assert op.product_stats(df.drop("period").withColumn("product_category", df.product_id)).count() == 2


def test_clean_orders_differ_on_bad_dates(spark):
    raw = spark.createDataFrame(
        [("r1", "p", "5", "1", "2020-01-01"), ("r2", "p", "4", "1", "bad"), ("r3", "p", "x", "1", "2020-01-01"),
         ("r4", "p", "3", "0", "2020-01-01"), ("r5", None, "3", "1", "2020-01-01")],
        "review_id string, product_id string, star_rating string, verified_purchase string, review_date string")
    raw = raw.selectExpr("*", "'1' helpful_votes", "'2' total_votes", "'t' product_title")
    keyed = op.clean_reviews(raw)
    docs = op.clean_reviews(raw, keep_unparsed_dates=True)
    assert sorted(r.review_id for r in keyed.collect()) == ["r1"]
    assert sorted(r.review_id for r in docs.collect()) == ["r1", "r2"]
    assert "period" in keyed.columns and "period" not in docs.columns
    monthly = op.monthly_product_reviews(docs).collect()
    assert {(r.year, r.month) for r in monthly} == {(2020, 1), (None, None)}
