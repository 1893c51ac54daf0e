"""Upsert semantics of a keyed table.

Appending to a keyed store replaces the row with the same primary key: last
write wins. Here that is a group-by on the key keeping, per key, the row with
the greatest ``(order..., rest...)`` struct via ``max``, one payload a row. ``max`` is a
declarative aggregate with a partial (map-side) step, so a key holding a
third of all rows is reduced to one row per map task before the shuffle; no
task ever sorts or holds a whole key group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_key(key: Sequence[str]) -> Column:
    cond = F.lit(False)
    for c in key:
        cond = cond | F.col(c).isNull()
    return cond


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str | Column] = (),
                   drop_null_keys: bool = True) -> DataFrame:
    """One row per ``key``: the last write.

    ``order`` names what "later" means (e.g. a batch id, then a sequence or
    event time); remaining ties are broken by the greatest non-key values, so
    the result never depends on task order. Output keeps ``df``'s columns.
    """
    key = list(key)
    if drop_null_keys:
        df = df.filter(~null_key(key))
    rest = [c for c in df.columns if c not in key]
    if not rest:
        return df.dropDuplicates(key)
    # order columns first; one that is also a payload column stands once
    named = [c for c in order if isinstance(c, str) and c in rest]
    ranks = [F.col(c) if isinstance(c, str) else c for c in order if not (isinstance(c, str) and c in key)]
    ranks = [r if n in named else r.alias(f"__order{i}")
             for i, (r, n) in enumerate(zip(ranks, [c for c in order if not (isinstance(c, str) and c in key)]))]
    row = F.struct(*ranks, *[F.col(c) for c in rest if c not in named])
    return (df.groupBy(*key)
              .agg(F.max(row).alias("__latest"))
              .select(*key, *[F.col(f"__latest.{c}").alias(c) for c in rest])
              .select(*df.columns))
