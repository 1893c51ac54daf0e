"""Serving queries: argument checks, ties, empty results."""

import datetime as dt

import pytest

from quire import operators as op


def _items(spark):
    rows = [("2020-01", "p3", "t", 5), ("2020-01", "p1", "t", 5), ("2020-01", "p2", "t", 7),
            ("2020-01", "p0", "t", 1), ("2020-02", "p9", "t", 2)]
    return spark.createDataFrame(rows, "period string, product_id string, product_title string, "
                                       "review_count bigint")


@pytest.mark.parametrize("n", [0, 101, -1])
def test_n_out_of_range(spark, n):
    with pytest.raises(ValueError):
        op.top_products(_items(spark), "2020-01", n)


@pytest.mark.parametrize("n,expect", [(1, ["p2"]), (3, ["p2", "p1", "p3"]), (100, ["p2", "p1", "p3", "p0"])])
def test_top_n_ties_by_id(spark, n, expect):
    got = [r.product_id for r in op.top_products(_items(spark), "2020-01", n).collect()]
    assert got == expect


def test_unknown_period_is_empty(spark):
    assert op.top_products(_items(spark), "1900-01").isEmpty()


def test_top_n_all_periods_uses_group_limit(spark):
    df = op.top_products_all_periods(_items(spark), 2)
    got = sorted((r.period, r.rank, r.product_id) for r in df.collect())
    assert got == [("2020-01", 1, "p2"), ("2020-01", 2, "p1"), ("2020-02", 1, "p9")]
    assert "WindowGroupLimit" in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("bad", [0, 6, True, "5"])
def test_star_rating_checked(spark, bad):
    df = spark.createDataFrame([], "product_id string, star_rating int, review_date date, review_id string")
    with pytest.raises(ValueError):
        op.reviews_of_product(df, "p", bad)


def test_reviews_of_product_order_and_body_default(spark):
    rows = [("p", 5, dt.date(2020, 1, 1), "b", "c", "t", "h", None),
            ("p", 5, dt.date(2020, 1, 2), "z", "c", "t", "h", "x"),
            ("p", 5, dt.date(2020, 1, 1), "a", "c", "t", "h", "y"),
            ("p", 3, dt.date(2021, 1, 1), "q", "c", "t", "h", "y"),
            ("o", 5, dt.date(2020, 1, 1), "o", "c", "t", "h", "y")]
    df = spark.createDataFrame(rows, "product_id string, star_rating int, review_date date, "
                               "review_id string, customer_id string, product_title string, "
                               "review_headline string, review_body string")
    got = op.reviews_of_product(df, "p").collect()
    assert [r.review_id for r in got] == ["z", "a", "b", "q"]
    assert [r.review_body for r in got] == ["x", "y", "", "y"]
    assert got[0].review_date == "2020-01-02"
    assert op.reviews_of_product(df, "nope").isEmpty()


def test_newest_pages(spark):
    rows = [("d", "2024-01-0%d" % i, f"u{i % 2}", "t") for i in range(1, 10)] + [("e", "2030-01-01", "u", "t")]
    df = spark.createDataFrame(rows, "domain string, created_at string, user_id string, page_title string")
    got = [r.created_at for r in op.newest_pages(df, "d", 3).collect()]
    assert got == ["2024-01-09", "2024-01-08", "2024-01-07"]
