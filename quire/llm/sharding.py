"""Reproducible shuffle into shards: a Feistel permutation of row numbers.

Rows get global numbers ``0 .. n-1`` (in document order, ties by content); a
keyed permutation of ``0 .. n-1`` moves number ``x`` to place ``p(x)``; shard
and slot are ``p mod shards`` and ``p div shards``. Both can be recomputed from
the row number, the row count, the shard count and the key alone, shard
sizes differ by one at most, and slots have no gaps.

The permutation is a Feistel network on a grid ``a x b`` with ``a * b >= n``:
the halves (row, column) are alternately shifted by a hash of the other half,
so every round is a bijection. Places beyond ``n`` are walked along their
cycle until they fall inside; the grid is chosen with the fewest such places,
``a * b - n``, and a walk passes each of them once at most, so that many
steps (plus one) always suffice.
"""

from __future__ import annotations

from math import isqrt

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import number_rows

ROUNDS = 6
_SEARCH = 1 << 20


def grid(n: int) -> tuple[int, int]:
    """``(a, b)`` near the square root of ``n`` with ``a * b >= n`` and the
    least waste, looking at up to 2**20 widths."""
    root = max(1, isqrt(max(n, 1)))
    widths = np.arange(max(1, root // 2, root - _SEARCH), root + 1, dtype=np.int64)
    waste = (-n) % widths
    a = int(widths[len(widths) - 1 - int(np.argmin(waste[::-1]))])
    return a, max(1, -(-n // a))


def _whole(x: Column, by: int) -> Column:
    """Exact quotient of a multiple of ``by``."""
    return F.floor(x / F.lit(by)).cast("long")


def feistel(x: Column, a: int, b: int, key: int, rounds: int = ROUNDS) -> Column:
    """Keyed bijection of ``0 .. a*b-1``."""
    keys = F.array(*[F.lit(key * 1000003 + r).cast("long") for r in range(rounds)])

    def step(s, k):
        row = F.pmod(s["l"] + F.pmod(F.xxhash64(s["r"], k, F.lit(0)), F.lit(a)), F.lit(a)).cast("long")
        col = F.pmod(s["r"] + F.pmod(F.xxhash64(row, k, F.lit(1)), F.lit(b)), F.lit(b)).cast("long")
        return F.struct(row.alias("l"), col.alias("r"))

    r = F.pmod(x, F.lit(b)).cast("long")
    begin = F.struct(_whole(x - r, b).alias("l"), r.alias("r"))
    return F.aggregate(keys, begin, step, lambda s: s["l"] * F.lit(b) + s["r"])


def permute(x: Column, n: int, key: int) -> Column:
    """Keyed bijection of ``0 .. n-1`` (cycle walking inside the grid)."""
    a, b = grid(n)
    y = feistel(x, a, b, key)
    if a * b == n:
        return y
    return F.aggregate(F.sequence(F.lit(1), F.lit(a * b - n)), y,
                       lambda p, _: F.when(p >= F.lit(n), feistel(p, a, b, key)).otherwise(p))


def shuffle_into_shards(df: DataFrame, order: list[Column], shards: int, key: int) -> DataFrame:
    """``df`` plus ``row_no``, ``place``, ``shard`` and ``slot``.

    ``order`` must make equal-ranked rows interchangeable for the result to be
    reproducible. Null sort keys come first; an empty table stays empty;
    repeated rows each get a place of their own.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    rows = number_rows(df, order)
    n = rows.count()
    place = permute(F.col("row_no"), n, key)
    return (rows.withColumn("place", place)
                .withColumn("shard", F.pmod("place", F.lit(shards)).cast("int"))
                .withColumn("slot", _whole(F.col("place") - F.col("shard"), shards)))


def shard_documents(docs: DataFrame, shards: int = 40, key: int = 20240817,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Shard and slot of every document (the texts themselves do not move).

    Returns ``doc_id, size, text_crc32, law, shard, slot, grown_shard``: size is
    the UTF-8 length plus 16 (null text: 16, CRC of nothing 0); law ``rows``
    (shard counts at most one apart); ``grown_shard`` is null under that law.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = docs.select(F.col(id_col).alias("doc_id"),
                         (F.octet_length(text) + 16).cast("long").alias("size"),
                         F.crc32(text.cast("binary")).alias("text_crc32"),
                         F.xxhash64(text).alias("_h"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("text_crc32"), F.col("size"), F.col("_h")]
    out = shuffle_into_shards(narrow, order, shards, key)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
