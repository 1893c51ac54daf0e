"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written from the semantics in SURVEY §2, not from the Spark code: the input
views are re-derived in SQL from the driver tables, and every computed column
carries the same alias as the Spark result.
"""

from __future__ import annotations

from quire.plans.catalog import (
    CUSTOMER_ID, DOMAIN, NOW, PERIOD, PRODUCT_ID, STAR_RATING, TOP_N,
)
from quire.functions.scalars import iso_text
from quire.schemas import ALLOWED_DOMAINS

_NOW_ISO = iso_text(NOW)
_NOW_MINUTE = f"{_NOW_ISO[8:10]}_{_NOW_ISO[5:7]}_{_NOW_ISO[0:4]}_{_NOW_ISO[11:13]}_{_NOW_ISO[14:16]}"


def _int(c: str) -> str:
    return f"cast(trunc(try_cast(trim({c}) as decimal(20,4))) as int)"


REVIEWS = """
reviews as (
  select cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) as review_id,
         cast(o_custkey as varchar) as customer_id,
         cast(l_partkey as varchar) as product_id,
         p_name as product_title,
         p_type as product_category,
         case when l_orderkey % 97 = 0 then 'n/a'
              when l_orderkey % 89 = 0 then cast(1 + (cast(l_quantity as int) % 5) as varchar) || '.0'
              else cast(1 + (cast(l_quantity as int) % 5) as varchar) end as star_rating,
         case when l_returnflag = 'R' then '0' else '1' end as verified_purchase,
         cast(l_linenumber as varchar) as helpful_votes,
         cast(l_linenumber + 3 as varchar) as total_votes,
         o_orderpriority as review_headline,
         case when l_linenumber = 7 then null else o_orderpriority || ' ' || p_name end as review_body,
         case when l_suppkey % 41 = 0 then 'bad-date' else strftime(l_shipdate, '%Y-%m-%d') end as review_date
  from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
)"""

TYPED = f"""
typed as (
  select review_id, customer_id, product_id, product_title, product_category,
         {_int('star_rating')} as star_rating, {_int('verified_purchase')} as verified_purchase,
         {_int('helpful_votes')} as helpful_votes, {_int('total_votes')} as total_votes,
         review_headline, review_body, review_date as review_date_text,
         cast(try_strptime(review_date, '%Y-%m-%d') as date) as review_date
  from reviews
)"""

# keyed-table job order: parse, then drop NULL keys
CLEAN = """
clean as (
  select review_id, customer_id, product_id, product_title, product_category, star_rating,
         verified_purchase, helpful_votes, total_votes, review_headline, review_body, review_date,
         strftime(review_date, '%Y-%m') as period
  from typed
  where review_id is not null and product_id is not null and star_rating is not null
    and review_date is not null and verified_purchase = 1
)"""

# document-store job order: drop NULL keys on the raw text, then parse
CLEAN1 = """
clean1 as (
  select review_id, customer_id, product_id, product_title, product_category, star_rating,
         verified_purchase, helpful_votes, total_votes, review_headline, review_body, review_date
  from typed
  where review_id is not null and product_id is not null and star_rating is not null
    and review_date_text is not null and verified_purchase = 1
)"""

ITEMS = """
items as (select period, product_id, product_title, count(*) as review_count
          from clean group by period, product_id, product_title)"""

CUSTOMERS = """
customers as (select period, customer_id, count(*) as review_count
              from clean group by period, customer_id)"""

SENTIMENT = """
sentiment as (
  select period, customer_id, count(*) as review_count, 'hater' as sentiment
  from clean where star_rating <= 2 group by period, customer_id
  union all
  select period, customer_id, count(*) as review_count, 'backer' as sentiment
  from clean where star_rating >= 4 group by period, customer_id
)"""

BY_PRODUCT = """
by_product as (
  select product_id, star_rating, review_date, review_id, customer_id, product_title,
         review_headline, review_body
  from clean
  qualify row_number() over (
    partition by product_id, star_rating, review_date, review_id
    order by customer_id desc nulls last, product_title desc nulls last,
             review_headline desc nulls last, review_body desc nulls last) = 1
)"""

BY_CUSTOMER = """
by_customer as (
  select customer_id, review_date, review_id, product_id, product_title, star_rating,
         review_headline, review_body
  from clean where customer_id is not null
  qualify row_number() over (
    partition by customer_id, review_date, review_id
    order by product_id desc nulls last, product_title desc nulls last,
             star_rating desc nulls last, review_headline desc nulls last,
             review_body desc nulls last) = 1
)"""

WIKI = """
wiki as (
  select cast(user_id as varchar) as user_id,
         case when user_id % 11 = 0 then null else user_id % 5 = 0 end as user_is_bot,
         case event_type when 'click' then 'en.wikipedia.org' when 'view' then 'www.wikidata.org'
                         when 'purchase' then 'commons.wikimedia.org'
                         when 'signup' then 'de.wikipedia.org' end as domain,
         'Page_' || json_extract_string(props, '$.k') as page_title,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' as created_at
  from events
)"""

_DOMAINS = ", ".join(f"'{d}'" for d in ALLOWED_DOMAINS)
PROCESSED = f"""
processed as (
  select user_id, domain, page_title, created_at from wiki
  where domain in ({_DOMAINS}) and user_is_bot = false
)"""

PAGES = """
pages as (
  select domain, created_at, user_id, page_title from processed
  where domain is not null and created_at is not null and user_id is not null
  qualify row_number() over (partition by domain, created_at, user_id
                             order by page_title desc nulls last) = 1
)"""

SSE = """
sse as (
  select case when event_id % 50 = 0 then ':ok'
              when event_id % 51 = 0 then 'event: message'
              when event_id % 53 = 0 then 'data: {broken'
              when event_id % 59 = 0 then ''
              else 'data: ' || '{"page_title":"Page_' || json_extract_string(props, '$.k')
                   || '","meta":{"domain":"' || event_type || '"},"performer":{'
                   || case when user_id % 7 = 0 then ''
                           else '"user_id":' || cast(user_id as varchar) || ',' end
                   || '"user_is_bot":' || case when user_id % 5 = 0 then 'true' else 'false' end
                   || '}}' end as line
  from events
)"""

def _field(path: str, missing: str, null: str = "null") -> str:
    """Missing path -> ``missing``; JSON null -> ``null``; else the text value."""
    return (f"case when json_extract(p, '{path}') is null then {missing} "
            f"when json_type(json_extract(p, '{path}')) = 'NULL' then {null} "
            f"else json_extract_string(p, '{path}') end")


SSE_MESSAGES = f"""
sse_messages as (
  select {_field('$.performer.user_id', "''", "''")} as user_id,
         case when json_extract(p, '$.performer.user_is_bot') is null then false
              when json_type(json_extract(p, '$.performer.user_is_bot')) = 'BOOLEAN'
                then cast(json_extract_string(p, '$.performer.user_is_bot') as boolean)
              else null end as user_is_bot,
         {_field('$.meta.domain', "''")} as domain,
         {_field('$.page_title', "''")} as page_title,
         '{_NOW_ISO}' as created_at
  from (select trim(substr(line, 6)) as p from sse where starts_with(line, 'data:')) s
  where json_valid(p) and json_type(p) = 'OBJECT'
)"""

TWEETS = """
tweets as (
  select cast(event_id as varchar) as tweet_id, cast(user_id as varchar) as author_id,
         case when event_id % 13 = 0 then 'not-a-date'
              else strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' end as created_at,
         event_type || ' said "' || json_extract_string(props, '$.k') || '"' as text
  from events
)"""

ARCHIVE = f"""
archive as (
  select 'tweets_' || minute || '.csv' as file_name, minute, author_id, created_at, text
  from (
    select coalesce(author_id, '') as author_id, coalesce(created_at, '') as created_at,
           coalesce(text, '') as text,
           case when regexp_matches(coalesce(created_at, ''), '^\\d{{4}}-\\d{{2}}-\\d{{2}}([T ]\\d{{2}}:\\d{{2}}.*)?$')
                     and try_cast(created_at as timestamptz) is not null
                then substr(created_at, 9, 2) || '_' || substr(created_at, 6, 2) || '_'
                     || substr(created_at, 1, 4) || '_'
                     || case when length(created_at) >= 16
                             then substr(created_at, 12, 2) || '_' || substr(created_at, 15, 2)
                             else '00_00' end
                else '{_NOW_MINUTE}' end as minute
    from tweets) t
)"""

_REVIEW_SCHEMA = ("struct<" + ",".join(f"{c}:string" for c in [
    "review_id", "product_id", "product_title", "product_category", "customer_id",
    "star_rating", "verified_purchase", "helpful_votes", "total_votes", "review_date",
    "review_headline", "review_body"]) + ">")


def _with(*ctes: str) -> str:
    return "with " + ",".join(ctes) + "\n"


_R = (REVIEWS, TYPED)
_C = (REVIEWS, TYPED, CLEAN)
_C1 = (REVIEWS, TYPED, CLEAN1)

ORACLE_SQL: dict[str, str] = {
    "scan_reviews": _with(REVIEWS) + """
select review_id, product_id, product_title, product_category, customer_id, star_rating,
       verified_purchase, helpful_votes, total_votes, review_date, review_headline, review_body
from reviews""",
    "profile_reviews": _with(REVIEWS) + f"""
select count(*) as n_rows, 12 as n_columns, '{_REVIEW_SCHEMA}' as schema from reviews""",
    "clean_reviews": _with(*_C) + "select * from clean",
    "clean_reviews_keep_bad_dates": _with(*_C1) + "select * from clean1",
    "stage_counts": _with(REVIEWS, TYPED, CLEAN, CLEAN1) + """
select 'raw' as stage, count(*) as n_rows from reviews
union all select 'clean', count(*) from clean1
union all select 'product_stats', count(*) from
  (select distinct product_id, product_title, product_category from clean1)
union all select 'customer_stats', count(*) from (select distinct customer_id from clean1)
union all select 'monthly_product_reviews', count(*) from
  (select distinct product_id, product_title, year(review_date), month(review_date) from clean1)
union all select 'clean_keyed', count(*) from clean""",
    "product_stats": _with(*_C1) + """
select product_id, product_title, product_category, count(review_id) as total_reviews,
       round(avg(star_rating), 2) as avg_star_rating
from clean1 group by product_id, product_title, product_category""",
    "customer_stats": _with(*_C1) + """
select customer_id, count(review_id) as verified_review_count from clean1 group by customer_id""",
    "monthly_product_reviews": _with(*_C1) + """
select product_id, product_title, cast(year(review_date) as int) as year,
       cast(month(review_date) as int) as month, count(review_id) as monthly_review_count
from clean1 group by all order by product_id, year, month""",
    "items_by_period": _with(*_C, ITEMS) + "select * from items",
    "customers_by_period": _with(*_C, CUSTOMERS) + "select * from customers",
    "sentiment_by_period": _with(*_C, SENTIMENT) + "select * from sentiment",
    "reviews_by_product": _with(*_C) + """
select product_id, star_rating, review_date, review_id, customer_id, product_title,
       review_headline, review_body from clean""",
    "reviews_by_customer": _with(*_C) + """
select customer_id, review_date, review_id, product_id, product_title, star_rating,
       review_headline, review_body from clean""",
    "reviews_of_product": _with(*_C, BY_PRODUCT) + f"""
select review_id, product_id, customer_id, product_title, star_rating, review_headline,
       coalesce(review_body, '') as review_body, cast(review_date as varchar) as review_date
from by_product where product_id = '{PRODUCT_ID}'
order by star_rating desc, review_date desc, review_id""",
    "reviews_of_product_rating": _with(*_C, BY_PRODUCT) + f"""
select review_id, product_id, customer_id, product_title, star_rating, review_headline,
       coalesce(review_body, '') as review_body, cast(review_date as varchar) as review_date
from by_product where product_id = '{PRODUCT_ID}' and star_rating = {STAR_RATING}
order by star_rating desc, review_date desc, review_id""",
    "reviews_of_customer": _with(*_C, BY_CUSTOMER) + f"""
select review_id, product_id, product_title, star_rating, review_headline,
       coalesce(review_body, '') as review_body, cast(review_date as varchar) as review_date
from by_customer where customer_id = '{CUSTOMER_ID}'
order by review_date desc, review_id""",
    "top_products": _with(*_C, ITEMS) + f"""
select product_id, product_title, review_count from items where period = '{PERIOD}'
order by review_count desc, product_id asc nulls first, product_title asc nulls first
limit {TOP_N}""",
    "top_customers": _with(*_C, CUSTOMERS) + f"""
select customer_id, review_count from customers where period = '{PERIOD}'
order by review_count desc, customer_id asc nulls first limit {TOP_N}""",
    "top_haters": _with(*_C, SENTIMENT) + f"""
select customer_id, review_count from sentiment where period = '{PERIOD}' and sentiment = 'hater'
order by review_count desc, customer_id asc nulls first limit {TOP_N}""",
    "top_backers": _with(*_C, SENTIMENT) + f"""
select customer_id, review_count from sentiment where period = '{PERIOD}' and sentiment = 'backer'
order by review_count desc, customer_id asc nulls first limit {TOP_N}""",
    "top_products_all_periods": _with(*_C, ITEMS) + f"""
select period, cast(row_number() over (partition by period order by review_count desc,
         product_id asc nulls first, product_title asc nulls first) as int) as rank,
       product_id, product_title, review_count
from items qualify rank <= {TOP_N}""",
    "upsert_latest_review": _with(*_C) + """
select product_id, star_rating, review_date, review_id, customer_id, product_title,
       review_headline, review_body
from clean where review_id is not null
qualify row_number() over (
  partition by review_id
  order by review_date desc nulls last, product_id desc nulls last, star_rating desc nulls last,
           review_date desc nulls last, customer_id desc nulls last,
           product_title desc nulls last, review_headline desc nulls last,
           review_body desc nulls last) = 1""",
    "wiki_filter": _with(WIKI, PROCESSED) + """
select cast(json_object('user_id', user_id, 'domain', domain, 'page_title', page_title,
                        'created_at', created_at) as varchar) as value
from processed""",
    "wiki_roundtrip": _with(WIKI, PROCESSED) + "select * from processed",
    "page_creations": _with(WIKI, PROCESSED, PAGES) + "select * from pages",
    "newest_pages": _with(WIKI, PROCESSED, PAGES) + f"""
select domain, created_at, user_id, page_title from pages where domain = '{DOMAIN}'
order by created_at desc, user_id asc nulls first limit {TOP_N}""",
    "sse_events": _with(SSE, SSE_MESSAGES) + "select * from sse_messages",
    "publish_tweets": _with(TWEETS) + f"""
select cast(json_object('tweet_id', coalesce(tweet_id, ''), 'author_id', coalesce(author_id, ''),
                        'created_at', '{_NOW_ISO}', 'text', coalesce(text, '')) as varchar) as value
from tweets""",
    "tweets_archive_rows": _with(TWEETS, ARCHIVE) + "select * from archive",
    "sentiment_by_period_union": _with(*_C, SENTIMENT) + "select * from sentiment",
    "keyed_reviews_by_product": _with(*_C, BY_PRODUCT) + "select * from by_product",
    "keyed_reviews_by_customer": _with(*_C, BY_CUSTOMER) + "select * from by_customer",
    "event_messages": _with(SSE, SSE_MESSAGES) + """
select cast(json_object('user_id', user_id, 'user_is_bot', user_is_bot, 'domain', domain,
                        'page_title', page_title, 'created_at', created_at) as varchar) as value
from sse_messages""",
    "tweets_minute_files": _with(TWEETS, ARCHIVE) + """
select file_name, count(*) as n_rows from archive group by file_name""",
}

# The stream jobs must produce exactly what their batch twins produce.
ORACLE_SQL["stream_page_creations"] = ORACLE_SQL["page_creations"]
ORACLE_SQL["stream_event_messages"] = ORACLE_SQL["event_messages"]
ORACLE_SQL["stream_load_restart"] = ORACLE_SQL["page_creations"]
# What was written in parts or through a sink must read back as one.
ORACLE_SQL["keyed_two_feeds"] = ORACLE_SQL["keyed_reviews_by_product"]
ORACLE_SQL["document_marts"] = ORACLE_SQL["product_stats"]
ORACLE_SQL["publish_records"] = ORACLE_SQL["publish_tweets"]
# The stored boards count stored rows (one a key), of each review as its last feed had it.
STORED_ITEMS = BY_PRODUCT + """,
items as (select strftime(review_date, '%Y-%m') as period, product_id, product_title, count(*) as review_count
          from by_product group by all)"""
STORED_PEOPLE = BY_CUSTOMER + """,
customers as (select strftime(review_date, '%Y-%m') as period, customer_id, count(*) as review_count
              from by_customer group by all),
sentiment as (
  select strftime(review_date, '%Y-%m') as period, customer_id, count(*) as review_count,
         case when star_rating <= 2 then 'hater' else 'backer' end as sentiment
  from by_customer where star_rating <> 3 group by all)"""


def _fed(second: str) -> str:
    """``clean`` after two feeds, for a side of the store that tells a review by
    ``{key}``: rows of the last feed that had the review."""
    return f"""
fed as ({second}),
clean_of as (select * from fed qualify feed = max(feed) over (partition by {{key}}, review_id))"""


def _side(key: str, second: str, table: str, *ctes: str) -> str:
    """Tables of one side, computed from its own current rows."""
    own = _fed(second).format(key=key).replace("clean_of", f"clean_{key}")
    return own + "," + table.replace("from clean", f"from clean_{key}")


_HALVES = "select *, case when cast(product_id as bigint) % 2 = 1 then 0 else 1 end as feed from clean"
ORACLE_SQL["boards_two_feeds"] = _with(*_C, _side("customer_id", _HALVES, STORED_PEOPLE)) + "select * from customers"
_CORRECTED = f"""
select *, 0 as feed from clean
union all
select review_id, customer_id, product_id, product_title, product_category,
       case when cast(product_id as bigint) % 2 = 0 then 1 else star_rating end as star_rating,
       verified_purchase, helpful_votes, total_votes, review_headline, review_body,
       make_date({int(PERIOD[:4]) + 1}, {int(PERIOD[5:])}, 15) as review_date,
       '{int(PERIOD[:4]) + 1}-{PERIOD[5:]}' as period, 1 as feed
from typed where strftime(review_date, '%Y-%m') = '{PERIOD}' and verified_purchase = 1
  and (star_rating is not null or cast(product_id as bigint) % 2 = 0)"""
ORACLE_SQL["boards_after_correction"] = _with(
    *_C, _side("customer_id", _CORRECTED, STORED_PEOPLE),
    _side("product_id", _CORRECTED, STORED_ITEMS).replace("fed", "fed_items")) + """
select 'items' as board, period, product_id as id, product_title as label, review_count from items
union all select 'customers', period, customer_id, null, review_count from customers
union all select 'sentiment', period, customer_id, sentiment, review_count from sentiment"""
ORACLE_SQL["keyed_replay"] = _with(*_C, BY_PRODUCT) + """
select * replace ('corrected ' || review_headline as review_headline) from by_product
where cast(product_id as bigint) % 2 = 1"""
for _name, _cte, _stored in (("top_products", ITEMS, STORED_ITEMS), ("top_customers", CUSTOMERS, STORED_PEOPLE),
                             ("top_haters", SENTIMENT, STORED_PEOPLE), ("top_backers", SENTIMENT, STORED_PEOPLE)):
    ORACLE_SQL[_name] = ORACLE_SQL[_name].replace(_cte, _stored)

# The busy minutes: all stamps of a day in its first minute.
BUSY = TWEETS.replace("strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')", "strftime(ts, '%Y-%m-%dT00:00:%S.%f')")
for _name in ("archive_files", "stream_archive"):
    ORACLE_SQL[_name] = _with(BUSY, ARCHIVE) + "select minute, author_id, created_at, text from archive"

# Unfiltered page messages, those of two domains broken: one not JSON, one an array.
MESSAGES = """
messages as (
  select domain, to_json({'user_id': user_id, 'user_is_bot': user_is_bot, 'domain': domain,
                          'page_title': page_title, 'created_at': created_at}) as m
  from wiki),
rejects as (
  select case domain when 'de.wikipedia.org' then '{broken ' || cast(m as varchar)
                     when 'commons.wikimedia.org' then cast(to_json([cast(m as varchar)]) as varchar)
                     else cast(m as varchar) end as value,
         case domain when 'de.wikipedia.org' then 'not JSON' when 'commons.wikimedia.org' then 'not an object'
                     else 'missing domain' end as reason
  from messages
  where domain is null or domain in ('de.wikipedia.org', 'commons.wikimedia.org'))"""
ORACLE_SQL["stream_rejects"] = _with(WIKI, MESSAGES) + "select value, reason from rejects"
ORACLE_SQL["stream_counters"] = _with(WIKI, MESSAGES) + f"""
select 'page_load-page_creations' as job, cast(2 as bigint) as epochs, n as rows_in, n - r as rows_out, r as rejected
from (select count(*) as n from messages), (select count(*) as r from rejects)"""
