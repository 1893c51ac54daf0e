"""Edge rows for the scalar and JSON functions (FIXTURES.md §4)."""

import datetime as dt

from pyspark.sql import functions as F

from quire.functions import (
    decode, encode, is_iso_datetime, iso_text, lenient_int, minute_key, now_iso, strict_date,
)
from quire.schemas import PAGE_MESSAGE_SCHEMA


def _col(spark, values, fn, type_="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {type_}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_lenient_int(spark):
    assert _col(spark, ["5", " 5 ", "5.0", "5.9", "x", "", None, "-2"], lenient_int) == \
        [5, 5, 5, 5, None, None, None, -2]


def test_strict_date(spark):
    got = _col(spark, ["2015-08-31", "2015-8-1", "08/31/2015", "2015-02-30",
                       "2015-08-31 10:00:00", "", None], strict_date)
    assert got == [dt.date(2015, 8, 31), None, None, None, None, None, None]


def test_lenient_int_equals_non_ansi_cast(spark):
    """The reference cast text to int with ANSI off; that cast is the oracle."""
    vals = ["5", " 5 ", "5.0", "5.9", "x", "", None, "-2", "4.99999", "1e3", ".", ".5", "5.", "+5",
            "-5.9", "+", "-", "+.", "-.", "007", "2147483647", "2147483648", "-2147483648",
            "-2147483649", "1,000", "\t7\n", "5 5", "0x10", "\u0661\u0662", "  -0.5  ", "5..0",
            "99999999999999999999.5", "\u00a05", "5\u3000", "--5", "5-", "3.0.0"]
    df = spark.createDataFrame([(v,) for v in vals], "x string")
    old = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", "false")
        legacy = [r[0] for r in df.select(F.col("x").cast("int")).collect()]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
    ours = [r[0] for r in df.select(lenient_int("x")).collect()]
    assert [(v, a, b) for v, a, b in zip(vals, legacy, ours) if a != b] == []


def test_strict_date_equals_formatter_parse(spark):
    vals = ["2015-08-31", "2015-8-1", "2015-02-30", "2016-02-29", "2015-02-29", "0000-01-01",
            "0001-01-01", "9999-12-31", " 2015-08-31", "2015-08-31 ", "2015-08-31T00:00",
            "2015-13-01", "2015-00-10", "2015-01-00", "+2015-01-01", "20150101", "2015/01/01",
            "१२३४-०१-०१", "", None]
    df = spark.createDataFrame([(v,) for v in vals], "x string")
    got = df.select("x", strict_date("x").eqNullSafe(F.try_to_date("x", "yyyy-MM-dd")).alias("same"),
                    strict_date("x").cast("string").alias("a")).collect()
    assert all(r.same for r in got), [(r.x, r.a) for r in got if not r.same]


def test_from_json_permissive(spark):
    rows = ['{bad', '[]', 'null', '', '{"user_id": 12, "user_is_bot": "false"}',
            '{"user_id": "7", "user_is_bot": true, "domain": "x"}']
    df = spark.createDataFrame([(r,) for r in rows], "value string")
    got = df.select(decode("value", PAGE_MESSAGE_SCHEMA).alias("d")).select("d.*").collect()
    for r in got[:4]:
        assert all(v is None for v in r)
    assert got[4]["user_id"] == "12" and got[4]["user_is_bot"] is None
    assert got[5]["user_id"] == "7" and got[5]["user_is_bot"] is True


def test_to_json_null_fields(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    omit = df.select(encode("x", "y")).first()[0]
    keep = df.select(encode("x", "y", keep_nulls=True)).first()[0]
    assert omit == '{"x":"a"}'
    assert keep == '{"x":"a","y":null}'


def test_iso_now_injected_and_current(spark):
    assert iso_text("2025-01-01T12:34:56.789012+00:00") == "2025-01-01T12:34:56.789012+00:00"
    assert iso_text("2025-01-01T14:34:56+02:00") == "2025-01-01T12:34:56.000000+00:00"
    cur = spark.range(1).select(now_iso()).first()[0]
    parsed = dt.datetime.fromisoformat(cur)
    assert parsed.utcoffset() == dt.timedelta(0)
    assert abs((dt.datetime.now(dt.timezone.utc) - parsed).total_seconds()) < 300


def test_now_is_utc_whatever_the_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        cur = spark.range(1).select(now_iso()).first()[0]
        parsed = dt.datetime.fromisoformat(cur)
        assert abs((dt.datetime.now(dt.timezone.utc) - parsed).total_seconds()) < 300
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_minute_key_iso_variants(spark):
    now = "2025-01-01T12:34:56+00:00"
    vals = ["2024-03-05T10:20:30.123456+00:00", "2024-03-05T10:20:30+02:00",
            "2024-03-05T10:20:30Z", "2024-03-05T10:20:30", "2024-03-05",
            "2024", "bad", "", None]
    got = _col(spark, vals, lambda c: minute_key(c, now))
    assert got == ["05_03_2024_10_20", "05_03_2024_10_20", "05_03_2024_10_20",
                   "05_03_2024_10_20", "05_03_2024_00_00",
                   "01_01_2025_12_34", "01_01_2025_12_34", "01_01_2025_12_34",
                   "01_01_2025_12_34"]
    # same keys as the archiver's own rule (stamp's own offset) for valid text
    for v, k in zip(vals[:5], got[:5]):
        assert dt.datetime.fromisoformat(v).strftime("%d_%m_%Y_%H_%M") == k


def test_is_iso_datetime(spark):
    assert _col(spark, ["2024-01-01T00:00:00+00:00", "2024", "x", None], is_iso_datetime) == \
        [True, False, False, False]


def test_minute_key_matches_python_fromisoformat(spark):
    """The archiver's rule, run by Python itself, is the oracle."""
    now = "2025-01-01T12:34:56+00:00"
    vals = ["2024-03-05T10", "2024-03-05 10", "2024-03-05T10:20", "2024-03-05T10:20Z",
            "2024-03-05T10+02:00", "2024-03-05T10:20:30.5", "2024-03-05T10:20:30,5",
            "2024-03-05T1020", "2024-03-05T102030", "2024-03-05T10:20:30.1234567",
            "2024-03-05T10:20:30+0200", "2024-03-05T10:20:30 UTC", "2024-03-05T10:20:30-05:30",
            "2024-03-05x10:20", "2024-02-29T23:59:59", "2023-02-29T10:00", "2024-13-01",
            "2024-03-05T24:00", "2024-03-05T10:60", "2024-03-05T", "2024-03-05T10:20:30+24:00",
            "2024-03-05T10:20:30.000000+00:00", "2024-03-05", "2024-3-5", " 2024-03-05",
            "2024-03-05T10:20:30Z ", "", "x"]

    def py_key(v):
        try:
            return dt.datetime.fromisoformat(v).strftime("%d_%m_%Y_%H_%M")
        except ValueError:
            return dt.datetime.fromisoformat(now).strftime("%d_%m_%Y_%H_%M")

    got = _col(spark, vals, lambda c: minute_key(c, now))
    assert [(v, k) for v, k in zip(vals, got) if k != py_key(v)] == []


def test_sse_missing_vs_null(spark):
    from quire.operators import sse_to_messages
    lines = [
        'data: {"performer":{"user_is_bot":null}}',
        'data: {"performer":{}}',
        'data: {"performer":null}',
        'data: {"page_title":"x"}',
        'data:{"performer":{"user_id":12,"user_is_bot":true},"meta":{"domain":"d"},"page_title":"p"}',
        'data: {"performer":{"user_id":null}, "meta":{"domain":null}, "page_title":null}',
        'data: {"performer":{"user_is_bot":"false","user_id":"u"},"page_title":7}',
        'data: {"performer":{"user_is_bot":0}}',
        ':comment', 'event: message', '', 'data: {broken', 'data: [1,2]', 'data: 5',
        'id: data: {"page_title":"no"}',
    ]
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    got = [tuple(r) for r in sse_to_messages(df, now="2025-01-01T00:00:00+00:00").collect()]
    stamp = "2025-01-01T00:00:00.000000+00:00"
    assert got == [
        ("", None, "", "", stamp),
        ("", False, "", "", stamp),
        ("", False, "", "", stamp),
        ("", False, "", "x", stamp),
        ("12", True, "d", "p", stamp),
        ("", False, None, None, stamp),
        ("u", None, "", "7", stamp),
        ("", None, "", "", stamp),
    ]


def test_wiki_filter_drops_null_and_text_bot_flags(spark):
    from quire.operators import wiki_filter
    recs = [
        '{"user_id":"1","user_is_bot":false,"domain":"en.wikipedia.org","page_title":"a","created_at":"t"}',
        '{"user_id":"2","user_is_bot":true,"domain":"en.wikipedia.org","page_title":"b","created_at":"t"}',
        '{"user_id":"3","user_is_bot":null,"domain":"en.wikipedia.org","page_title":"c","created_at":"t"}',
        '{"user_id":"4","user_is_bot":"false","domain":"en.wikipedia.org","page_title":"d","created_at":"t"}',
        '{"user_id":"5","user_is_bot":false,"domain":"de.wikipedia.org","page_title":"e","created_at":"t"}',
        '{"user_id":"6","user_is_bot":false,"page_title":"f","created_at":"t"}',
        '{"user_id":7,"user_is_bot":false,"domain":"www.wikidata.org","created_at":"t"}',
        '{broken',
    ]
    df = spark.createDataFrame([(v,) for v in recs], "value string")
    got = sorted(r.value for r in wiki_filter(df).collect())
    assert got == ['{"user_id":"1","domain":"en.wikipedia.org","page_title":"a","created_at":"t"}',
                   '{"user_id":"7","domain":"www.wikidata.org","created_at":"t"}']


def test_archive_skips_non_objects(spark):
    from quire.operators import archive_rows
    recs = ['{"author_id":"a","created_at":"2024-01-01T00:00:00+00:00","text":"t"}', '{}',
            '{broken', '[]', 'null', '', '5', '[{"author_id":"b"}]', '{"author_id":null,"text":7}',
            ' \n {"author_id":true,"text":false}']
    df = spark.createDataFrame([(v,) for v in recs], "value string")
    got = [tuple(r) for r in archive_rows(df, now="2025-01-01T00:00:00+00:00")
           .select("author_id", "created_at", "text", "minute").collect()]
    assert got == [("a", "2024-01-01T00:00:00+00:00", "t", "01_01_2024_00_00"),
                   ("", "", "", "01_01_2025_00_00"),
                   ("", "", "7", "01_01_2025_00_00"),
                   ("True", "", "False", "01_01_2025_00_00")]  # as csv writes str(True)


def test_sse_payload_strips_like_python(spark):
    from quire.functions import sse_payload
    lines = ["data: {}", "data:{}", "data:\t {} \r", "data:\u00a0{}\u3000", "data:\x1c{}\x1f",
             "data:\u2028{\"a\": 1}\u2029", "data:\u200b{}", "data:", "data:  ", "data: x y "]
    got = _col(spark, lines, sse_payload)
    assert got == [ln[len("data:"):].strip() for ln in lines]
