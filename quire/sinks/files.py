"""Batch sinks.

Connector formats (a document store, a message broker) are a ``format`` plus
``options`` argument; their jars are not on this image, so tests use the
file-backed twins (Parquet for documents, text lines for topic records).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.sources.files import CSV_DIALECT, CSV_WRITE

ARCHIVE_COLUMNS = ["author_id", "created_at", "text"]


def write_documents(df: DataFrame, target: str | None, format: str = "parquet",
                    options: dict | None = None) -> None:
    """Replace a whole result set (B1: one collection per mart, overwritten).

    ``format="mongodb"`` with ``options={"database": ..., "collection": ...}``
    and no ``target`` goes to the document store; a path-based format (default
    Parquet) writes at ``target``.
    """
    w = df.write.format(format).mode("overwrite").options(**(options or {}))
    if target is not None:
        w.save(target)
    else:
        w.save()


def write_records(records: DataFrame, target: str, format: str = "text",
                  options: dict | None = None) -> None:
    """Append message records (column ``value``) to a topic.

    ``format="kafka"`` with ``target`` as the topic name and the broker in
    ``options``; the default appends text lines under the ``target`` path.
    """
    values = records.select(F.col("value").cast("string").alias("value"))
    if format == "kafka":
        values.write.format("kafka").options(**(options or {})).option("topic", target).save()
    else:
        values.write.format(format).mode("append").options(**(options or {})).save(target)


def write_minute_archive(rows: DataFrame, path: str) -> None:
    """Per-minute CSV archive (B6): one directory ``minute=<dd_MM_yyyy_HH_mm>``
    per minute, a header line in every part file, values written verbatim
    with minimal quoting. Rows end in LF where a Python ``csv.writer`` writes
    CRLF: Spark would also rewrite line breaks inside quoted values to the
    row separator, and values matter more than terminator bytes; the csv
    module reads either back to the same rows.

    ``rebalance`` on the minute gives one writer per minute, while AQE splits
    a minute that holds a hot share of the rows across several writers.
    """
    (rows.hint("rebalance", "minute")
         .select("minute", *ARCHIVE_COLUMNS)
         .write.mode("append").partitionBy("minute")
         .options(**CSV_WRITE).csv(path))


def read_minute_archive(spark: SparkSession, path: str) -> DataFrame:
    """``minute, author_id, created_at, text`` of an archive; of one that a
    stream writes, the files that its commit log has. Empty fields are ``""``."""
    schema = ", ".join(f"{c} string" for c in [*ARCHIVE_COLUMNS, "minute"])
    return (spark.read.schema(schema).options(**CSV_DIALECT).csv(path)
                 .select("minute", *[F.coalesce(c, F.lit("")).alias(c) for c in ARCHIVE_COLUMNS]))
