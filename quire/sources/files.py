"""File sources.

Review CSVs are multi-line, so one file is one task. Ingest many files (or
land the data once with :func:`land_csv` / as Parquet) rather than one large
file, and read everything else from Parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from quire.schemas import REVIEWS_RAW_SCHEMA

# The CSV dialect of the review files (double-quote quoting,
# doubled quote as escape, fields may span lines).
CSV_DIALECT = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true"}

# Columns are taken by header name: a file whose header differs from the first
# file's (or from the given columns) is an error, never read by position.
BY_NAME = {"enforceSchema": "false"}

# Writer options: keep values verbatim (Spark trims by default) and write an
# empty string as an empty field, like a Python ``csv.writer``.
CSV_WRITE = {"header": "true", "quote": '"', "escape": '"', "emptyValue": "",
             "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _by_header(df: DataFrame, schema: StructType) -> DataFrame:
    """Project the expected columns by header name; absent ones are NULL."""
    have = set(df.columns)
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) if f.name in have
                       else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_reviews_csv(spark: SparkSession, path: str | list[str],
                     schema: StructType = REVIEWS_RAW_SCHEMA) -> DataFrame:
    """All-string review scan (A1).

    Empty and quoted-empty fields read as NULL, short rows are null-padded,
    long rows cut, blank lines skipped, spaces kept. Column names come from
    the header (nothing is inferred: every column is a string) and the
    expected columns are picked by name, whatever their order; all files of
    one read must have the same header, else the read fails.
    """
    df = (spark.read.options(**CSV_DIALECT).options(**BY_NAME)
          .option("inferSchema", "false").option("mode", "PERMISSIVE")
          .csv(path))
    return _by_header(df, schema)


def read_csv_rows(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """CSV rows as the publisher sees them (A2): every field a string and a
    missing or empty field is ``""`` rather than NULL. ``columns`` defaults to
    every column of the header, in header order."""
    df = spark.read.options(**CSV_DIALECT).options(**BY_NAME).option("inferSchema", "false").csv(path)
    columns = list(columns) if columns is not None else df.columns
    schema = StructType([StructField(c, StringType(), True) for c in columns])
    return _by_header(df, schema).fillna("", subset=columns)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Landed event-stream lines (A5): one row per line, column ``value``."""
    return spark.read.text(path)


def land_csv(df: DataFrame, path: str, mode: str = "overwrite", compression: str | None = None) -> str:
    """Write ``df`` in the review CSV dialect (header per part file), with a
    ``compression`` that readers tell by the file names. As multi-line files are
    never split, a compressed one is read in as many tasks."""
    df.write.mode(mode).options(**CSV_WRITE).csv(path, compression=compression)
    return path


def land_lines(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Write a single string column as text lines."""
    df.write.mode(mode).text(path)
    return path
