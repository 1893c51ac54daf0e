"""Every registered query against its DuckDB oracle (sf0.001 here; the driver
runs the same check at sf0.01, see tools/check_oracle.py)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from quire.plans.catalog import QUERIES  # noqa: E402
from quire.plans.oracle import ORACLE_SQL  # noqa: E402
from check_oracle import TABLES, digest, type_mismatches  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    o_cols = [d[0] for d in cur.description]
    o_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(o_cols)
    assert type_mismatches(df.schema, cur.description) == {}
    assert len(rows) == len(o_rows)
    assert digest(df.columns, rows) == digest(o_cols, o_rows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["product_id", "product_title", "product_category", "total_reviews",
                          "avg_star_rating"]
