"""Review cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import lenient_int, period_of, strict_date
from quire.schemas import REVIEW_INT_COLUMNS, REVIEW_REQUIRED_COLUMNS


def typed_reviews(raw: DataFrame) -> DataFrame:
    """Cast the numeric text columns (review_date stays text)."""
    return raw.withColumns({c: lenient_int(c) for c in REVIEW_INT_COLUMNS})


def keep_condition(keep_unparsed_dates: bool) -> Column:
    """Predicate over :func:`typed_reviews` rows that a clean row satisfies.

    Required columns must be non-NULL (the date as text when unparsed dates
    are kept, else as a parsed date) and the purchase must be verified.
    """
    cond = F.col("verified_purchase") == 1
    for c in REVIEW_REQUIRED_COLUMNS:
        v = strict_date(c) if (c == "review_date" and not keep_unparsed_dates) else F.col(c)
        cond = cond & v.isNotNull()
    return cond


def clean_reviews(raw: DataFrame, keep_unparsed_dates: bool = False,
                  with_period: bool | None = None) -> DataFrame:
    """Type the all-string reviews and keep verified, complete rows.

    Default (keyed-table job order): parse the date first, then drop rows with
    a NULL key column, so unparsable dates vanish; adds ``period`` (yyyy-MM).

    ``keep_unparsed_dates=True`` (document-store job order): drop NULLs while
    the date is still text, then parse, so an unparsable date survives as
    NULL and forms its own (NULL, NULL) month group. No ``period`` column.
    """
    df = (typed_reviews(raw)
          .filter(keep_condition(keep_unparsed_dates))
          .withColumn("review_date", strict_date("review_date")))
    if with_period is None:
        with_period = not keep_unparsed_dates
    if with_period:
        df = df.withColumn("period", period_of("review_date"))
    return df
