"""Source profile and stage cardinalities.

The reference counts every stage with an extra action (a full re-scan each).
Here a running job attaches an :class:`Observation` to the write it does
anyway, and the counts arrive with that single pass. For a query that must
return the counts as a table, :func:`review_stage_counts` takes them all in one pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from quire.functions import strict_date
from quire.operators.clean import keep_condition, typed_reviews


def profile(df: DataFrame) -> DataFrame:
    """One row: row count, column count and the schema as DDL-like text."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows",
        F.lit(len(df.columns)).alias("n_columns"),
        F.lit(df.schema.simpleString()).alias("schema"))


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row counter that is filled by whatever action runs ``df``."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def review_stage_counts(raw: DataFrame) -> DataFrame:
    """(stage, n_rows) of both review jobs in one pass over the raw rows.

    raw rows; clean rows of the document-store job and the number of rows of
    each of its three marts (distinct mart keys among those rows); clean rows
    of the keyed-table job. One scan: plain conditional counts plus three
    distinct counts, which Spark evaluates with a single Expand and two
    partial-aggregation levels instead of one scan per stage.
    """
    typed = typed_reviews(raw)
    docs, keyed = keep_condition(True), keep_condition(False)
    date = strict_date("review_date")

    def key_of(*cols: str | F.Column) -> F.Column:
        return F.when(docs, F.struct(*cols))

    agg = typed.agg(
        F.count(F.lit(1)).alias("raw"),
        F.count_if(docs).alias("clean"),
        F.count_distinct(key_of("product_id", "product_title", "product_category"))
         .alias("product_stats"),
        F.count_distinct(key_of("customer_id")).alias("customer_stats"),
        F.count_distinct(key_of("product_id", "product_title", F.year(date).alias("year"),
                                F.month(date).alias("month"))).alias("monthly_product_reviews"),
        F.count_if(keyed).alias("clean_keyed"),
    )
    stages = ["raw", "clean", "product_stats", "customer_stats", "monthly_product_reviews",
              "clean_keyed"]
    return agg.unpivot([], stages, "stage", "n_rows")
