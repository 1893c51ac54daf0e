"""Scalar column expressions. All are built-in Spark expressions,
so they stay inside whole-stage codegen; no Python runs per row."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Text a non-ANSI string-to-int cast accepts: optional sign, ASCII digits and
# an optional fraction that is discarded (an empty part counts as 0).
_INT_TEXT = r"^[+-]?[0-9]*(\.[0-9]*)?$"
# Characters the legacy cast ignores around a number (ASCII space and controls).
_EDGE_CHARS = "".join(chr(i) for i in range(0x21))


def lenient_int(c: ColumnLike) -> Column:
    """String to int as a non-ANSI ``cast('integer')`` does, NULL instead of
    an error: surrounding whitespace ignored, fraction truncated ('5.9' -> 5,
    '-5.9' -> -5), junk, exponents and overflow -> NULL.

    Plain integers take the strict cast (same value); only text it rejects
    is shape-checked and cut at the decimal point.
    """
    c = _col(c)
    t = F.btrim(c, F.lit(_EDGE_CHARS))
    whole = F.substring_index(t, ".", 1)
    cut = F.when(whole.isin("", "+", "-"), F.lit(0)).otherwise(whole.try_cast("int"))
    slow = F.when(t.rlike(_INT_TEXT) & ~t.isin("", "+", "-"), cut)
    # the strict cast ignores the same surrounding characters itself
    return F.coalesce(c.try_cast("int"), slow)


# ISO calendar date text with a four-digit year.
_ISO_DATE_TEXT = r"^\d{4}-\d{2}-\d{2}\z"


def strict_date(c: ColumnLike, fmt: str = "yyyy-MM-dd") -> Column:
    """String to date by an exact pattern; anything else is NULL.

    For the ISO pattern the text is shape-checked and cast (no formatter, no
    exception per bad row); the result equals ``try_to_date(c, fmt)``.
    """
    c = _col(c)
    if fmt == "yyyy-MM-dd":
        return F.when(c.rlike(_ISO_DATE_TEXT), c.try_cast("date"))
    return F.try_to_date(c, fmt)


def period_of(c: ColumnLike) -> Column:
    """Calendar month as ``yyyy-MM`` text."""
    return F.date_format(_col(c), "yyyy-MM")


def null_to_empty(c: ColumnLike) -> Column:
    return F.coalesce(_col(c), F.lit(""))


def to_text(c: ColumnLike) -> Column:
    return _col(c).cast("string")


# ISO-8601 text of a UTC instant has microseconds and an explicit offset.
_ISO_UTC_SUFFIX = "+00:00"


def iso_text(now: datetime | str) -> str:
    """Python-side rendering of an injected 'now' in the same format."""
    if isinstance(now, str):
        now = datetime.fromisoformat(now)
    if now.tzinfo is None:
        now = now.replace(tzinfo=timezone.utc)
    now = now.astimezone(timezone.utc)
    return now.strftime("%Y-%m-%dT%H:%M:%S.%f") + _ISO_UTC_SUFFIX


def utc_wall_clock(ts: Column) -> Column:
    """Instant -> TIMESTAMP_NTZ holding its UTC wall clock, whatever the session zone."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), ts.cast("timestamp_ntz"))


def iso_utc(ts: Column) -> Column:
    """TIMESTAMP_NTZ (UTC wall clock) -> ISO text with ``+00:00``.

    Taken from the stamp's own text, which knows no zone (a formatter would
    shift wall clocks that the session's zone skips)."""
    text = ts.cast("string")
    return F.concat(F.replace(F.substring(text, 1, 19), F.lit(" "), F.lit("T")), F.lit("."),
                    F.rpad(F.substring(text, 21, 6), 6, "0"), F.lit(_ISO_UTC_SUFFIX))


def now_iso(now: datetime | str | None = None) -> Column:
    """Current UTC time as ISO text; ``now`` is injectable for repeatable runs."""
    if now is not None:
        return F.lit(iso_text(now))
    return iso_utc(utc_wall_clock(F.current_timestamp()))


# ISO-8601 extended date (years 0001-9999), then optionally any single
# separator character and a time: HH[:MM[:SS]] or HH[MM[SS]], then either a
# fraction ([.,] and digits) or, right before an offset, any one character,
# and an offset Z or +/-HH[[:]MM[[:]SS]] with an optional fraction. These are
# the strings Python's ``datetime.fromisoformat`` accepts with an extended
# date. Calendar validity of the date is checked separately.
_HMS = r"(:[0-5]\d(:[0-5]\d)?|[0-5]\d([0-5]\d)?)?"
_ISO_SHAPE = (r"^(?!0000)\d{4}-(0[1-9]|1[0-2])-\d{2}"
              r"(.([01]\d|2[0-3])" + _HMS + r"([.,]\d+|[^Z+-](?=[Z+-]))?"
              r"(Z|[+-]([01]\d|2[0-3])" + _HMS + r"([.,]\d+)?)?)?\z")


def is_iso_datetime(c: ColumnLike) -> Column:
    """True where the text is an ISO date or date-time (extended date form)."""
    c = _col(c)
    valid_day = strict_date(F.substring(c, 1, 10)).isNotNull()
    return F.coalesce(c.rlike(_ISO_SHAPE) & valid_day, F.lit(False))


def minute_key(created_at: ColumnLike, now: datetime | str | None = None) -> Column:
    """``dd_MM_yyyy_HH_mm`` of a message stamp, in the stamp's own offset.

    The digits are taken from the text itself, so a stamp written with any
    offset names the minute it shows (hour-only times give minute 00). A
    missing or unparsable stamp falls back to the current (or injected) UTC
    minute.
    """
    c = _col(created_at)
    # the archiver's strftime("%Y") (glibc) does not zero-pad years below 1000
    year = F.regexp_replace(F.substring(c, 1, 4), "^0+", "")
    day = F.concat_ws("_", F.substring(c, 9, 2), F.substring(c, 6, 2), year)
    hour = F.when(F.length(c) >= 13, F.substring(c, 12, 2)).otherwise(F.lit("00"))
    minute = (F.when((F.substring(c, 14, 1) == ":") & F.substring(c, 15, 2).rlike(r"^\d\d$"),
                     F.substring(c, 15, 2))
               .when(F.substring(c, 14, 2).rlike(r"^\d\d$"), F.substring(c, 14, 2))
               .otherwise(F.lit("00")))
    if now is not None:
        fallback = F.lit(datetime.fromisoformat(iso_text(now)).strftime("%d_%m_%Y_%H_%M"))
    else:
        fallback = F.date_format(utc_wall_clock(F.current_timestamp()), "dd_MM_yyyy_HH_mm")
    return F.when(is_iso_datetime(c), F.concat_ws("_", day, hour, minute)).otherwise(fallback)


# Archive file naming, prefix and extension.
ARCHIVE_FILE_PREFIX = "tweets_"
ARCHIVE_FILE_SUFFIX = ".csv"


def archive_file_name(minute: ColumnLike) -> Column:
    return F.concat(F.lit(ARCHIVE_FILE_PREFIX), _col(minute), F.lit(ARCHIVE_FILE_SUFFIX))


# Whitespace as Python's ``str.strip()`` sees it: Unicode white space plus the
# ASCII file/group/record/unit separators.
_PY_SPACE = r"[\s\x1c-\x1f]"


def sse_payload(line: ColumnLike) -> Column:
    """Text after the ``data:`` field name, surrounding whitespace removed."""
    return F.regexp_replace(F.substr(_col(line), F.lit(6)),
                            f"(?U)^{_PY_SPACE}+|{_PY_SPACE}+$", "")
