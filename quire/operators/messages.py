"""Message transforms shared by batch and Structured Streaming
(SURVEY C8, C9, C12, C15-C20, H7-H20, B7).

Every function maps a DataFrame to a DataFrame with stateless, built-in
expressions, so the same code runs on a static table or on ``readStream``.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions import (
    archive_file_name, decode, encode, json_field, minute_key, now_iso, parse_once, python_text,
    sse_payload,
)
from quire.schemas import (
    ALLOWED_DOMAINS, PAGE_MESSAGE_SCHEMA, PROCESSED_MESSAGE_SCHEMA,
)

# The SSE field carrying the event, and the outgoing fields.
SSE_DATA_FIELD = "data:"
PROCESSED_FIELDS = ["user_id", "domain", "page_title", "created_at"]


def decode_messages(records: DataFrame, schema=PAGE_MESSAGE_SCHEMA,
                    value_col: str = "value") -> DataFrame:
    """Topic records -> typed columns (H7 binary->string, H8 permissive parse,
    C12 struct expansion). A malformed record gives an all-NULL row, which
    the stream jobs' predicates and key checks then drop."""
    return records.select(parse_once(decode(value_col, schema)).alias("data")).select("data.*")


def filter_pages(messages: DataFrame, allowed_domains: Sequence[str] = ALLOWED_DOMAINS) -> DataFrame:
    """Keep human page creations on allowed domains.

    NULL domain or NULL/unparsable bot flag fails the predicate and is dropped.
    """
    return messages.filter(F.col("domain").isin(list(allowed_domains))
                           & (F.col("user_is_bot") == F.lit(False)))


def encode_processed(messages: DataFrame) -> DataFrame:
    """Drop the bot flag and re-encode (C15, H9: NULL fields omitted)."""
    return messages.select(encode(*PROCESSED_FIELDS).alias("value"))


def wiki_filter(records: DataFrame, allowed_domains: Sequence[str] = ALLOWED_DOMAINS) -> DataFrame:
    """Filter stream transform: records -> parse -> filter -> records."""
    return encode_processed(filter_pages(decode_messages(records), allowed_domains))


def decode_processed(records: DataFrame) -> DataFrame:
    """Load stream transform: processed records -> 4 string columns."""
    return decode_messages(records, PROCESSED_MESSAGE_SCHEMA)


# Python's json.loads takes repeated names (the last counts) and NaN, and has no
# size limit; the variant parser refuses these. Such a record is parsed again by
# name, with the fields as variants, then (fields over the variant limit) as text.
_LENIENT = {"allowSingleQuotes": "false", "columnNameOfCorruptRecord": "_bad"}


def _again(text, fields: str):
    """The named fields of a JSON object; NULL for malformed text."""
    got = F.from_json(text, f"{fields}, _bad string", _LENIENT)
    whole = F.regexp_replace(text, r"[ \t\n\r]+\z", "").endswith("}")
    return F.when(whole & got.isNotNull() & got["_bad"].isNull(), got)


def _parsed_objects(records: DataFrame, text, by_variant: str, by_text: str) -> DataFrame:
    """``v``, ``g``, ``s`` of records whose ``text`` (a column that starts with a
    brace) is a JSON object: the variant, or for what its parser refuses the
    named fields as variants and as text. Two barriers: every record is parsed
    once, and only refused ones again, behind the second."""
    once = records.select(text.alias("_text")).select("_text", parse_once(F.try_parse_json("_text")).alias("v"))
    refused, t = F.col("v").isNull(), F.col("_text")
    again = F.when(refused, F.struct(_again(t, by_variant).alias("g"), _again(t, by_text).alias("s")))
    return (once.select("v", parse_once(again).alias("r")).select("v", "r.g", "r.s")
                .filter("v is not null or g is not null or s is not null"))


def sse_to_messages(lines: DataFrame, now: datetime | str | None = None,
                    line_col: str = "value") -> DataFrame:
    """Server-sent-event lines -> flat page messages.

    Keeps non-empty ``data:`` lines whose payload is a JSON object; other
    lines and broken JSON are skipped. Missing fields take the defaults
    ("" for text, False for the bot flag); an explicit JSON null bot flag, or
    one that is not a JSON boolean (e.g. the text "false"), is NULL, so the
    filter stream drops it, as it drops a non-boolean flag it cannot parse.
    """
    line = F.col(line_col)
    payload = sse_payload(line)
    # valid JSON that starts with "{" is an object: no need to inspect its schema
    by_name = ("performer struct<user_id: {0}, user_is_bot: {1}>, meta struct<domain: {0}>, page_title {0}")
    parsed = _parsed_objects(lines.filter(line.startswith(SSE_DATA_FIELD) & payload.startswith("{")), payload,
                             by_name.format("variant", "variant"), by_name.format("string", "boolean"))
    v, g, s = F.col("v"), F.col("g"), F.col("s")
    empty = F.lit("")

    def pick(of_variant, path, of_text):
        """The field from whichever parse has the record."""
        return (F.when(v.isNotNull(), of_variant(v, "$." + path)).when(g.isNotNull(), of_variant(g[path] if "." not in path
                else g[path.split(".")[0]][path.split(".")[1]], "$")).otherwise(of_text))

    flag = lambda x, p: json_field(x, p, "boolean", F.lit(False), strict_type="BOOLEAN")
    field = lambda x, p: json_field(x, p, "string", empty)
    return parsed.select(
        F.coalesce(pick(python_text, "performer.user_id", s["performer"]["user_id"]), empty).alias("user_id"),
        pick(flag, "performer.user_is_bot", F.coalesce(s["performer"]["user_is_bot"], F.lit(False))).alias("user_is_bot"),
        pick(field, "meta.domain", F.coalesce(s["meta"]["domain"], empty)).alias("domain"),
        pick(field, "page_title", F.coalesce(s["page_title"], empty)).alias("page_title"),
        now_iso(now).alias("created_at"),
    )


def stamp_messages(rows: DataFrame, now: datetime | str | None = None,
                   stamp_col: str = "created_at") -> DataFrame:
    """Overwrite the stamp column with the current UTC time, keep the rest (C20)."""
    return rows.withColumn(stamp_col, now_iso(now))


def encode_rows(rows: DataFrame) -> DataFrame:
    """Every column as one JSON object per row, NULLs kept."""
    return rows.select(encode(*rows.columns, keep_nulls=True).alias("value"))


def publish_rows(rows: DataFrame, now: datetime | str | None = None) -> DataFrame:
    """Publisher transform: stamp each row, then encode it as a message."""
    return encode_rows(stamp_messages(rows, now))


def archive_rows(records: DataFrame, now: datetime | str | None = None,
                 value_col: str = "value") -> DataFrame:
    """Archiver transform: message -> (file_name, minute, author_id, created_at, text).

    Missing or null fields become "" and other values are written as the
    consumer's ``str()`` renders them (C19). The minute comes from the
    message's own stamp, so a late message lands in its older minute; a
    missing or bad stamp falls back to the current minute (H18, H19). A
    record that is not a JSON object is skipped (the reference's consumer
    would stop on it).
    """
    text = F.col(value_col).cast("string")
    is_object = F.regexp_replace(text, r"^[ \t\n\r]+", "").startswith("{")
    names = ("author_id", "created_at", "text")
    parsed = _parsed_objects(records.filter(is_object), text,
                             *[", ".join(f"{c} {t}" for c in names) for t in ("variant", "string")])
    v, g, s = F.col("v"), F.col("g"), F.col("s")
    msg = parsed.select(*[F.coalesce(
        F.when(v.isNotNull(), python_text(v, f"$.{c}")).when(g.isNotNull(), python_text(g[c], "$")).otherwise(s[c]),
        F.lit("")).alias(c) for c in names])
    out = msg.withColumn("minute", minute_key("created_at", now))
    return out.select(archive_file_name("minute").alias("file_name"), "minute",
                      "author_id", "created_at", "text")
