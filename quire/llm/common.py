"""Helpers shared by the training-data operators.

* landing of intermediate tables in the shared folder (``spark.checkpoint.dir``),
  which cuts lineage and survives a lost executor;
* gapless global row numbers without a one-task sort;
* connected components by alternating star contraction;
* word positions and hashes of Arrow string columns, computed with numpy over
  blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.session import discard, scratch_path


def land(df: DataFrame, name: str, options: dict | None = None) -> DataFrame:
    """Write ``df`` to a fresh folder in the shared scratch space and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Landed tables of one operator run, removed when their readers are done."""

    def __init__(self) -> None:
        self.held: list[tuple] = []

    def land(self, df: DataFrame, name: str, options: dict | None = None) -> DataFrame:
        path = scratch_path(df.sparkSession, name)
        df.write.options(**(options or {})).parquet(path)
        self.held.append((df.sparkSession, path))
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        """Remove all of it: after this only what was landed elsewhere can be read."""
        for spark, path in self.held:
            discard(spark, path)
        self.held = []


@contextmanager
def freed_shuffles(spark):
    """Within this block a query's shuffle files go when it is done, not when the
    driver next collects garbage. For steps whose results are landed."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def sieve(hashes: DataFrame, bits: int) -> bytes:
    """A bit set of ``2 ** bits`` bits (15 or more) with the first ``bits`` bits of each
    long of a one-column table; its size depends on ``bits`` alone."""
    at = F.shiftrightunsigned(hashes.columns[0], 64 - bits) + 1  # bitmap buckets of 32768 bits begin at 1
    rows = (hashes.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("bucket"))
                  .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")))
    out = bytearray(1 << (bits - 3))
    for row in rows.toLocalIterator():
        out[(row["bucket"] - 1) << 12:row["bucket"] << 12] = row["bits"]
    return bytes(out)


def sieved(held: bytes, hashes: np.ndarray, bits: int) -> np.ndarray:
    """Which hashes may be among those of :func:`sieve`."""
    at = (hashes.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)
    return ((np.frombuffer(held, np.uint8)[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool)


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` plus column ``name``, computed once a row: a one-element explode,
    through which the optimizer copies no expression into later lambdas,
    filters or joins."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def fresh_names(df: DataFrame, *wanted: str) -> list[str]:
    """Column names that ``df`` does not have (case aside), one for each wanted name."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        name = f"_{name}"
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def number_rows(df: DataFrame, order: list[Column], col: str = "row_no") -> DataFrame:
    """``df`` (landed) with a gapless global row number from 0 in ``order``.

    A range-partitioned sort numbers the rows inside each partition; a table
    with one row per partition adds the offsets.
    """
    at = "_at"
    rows = land(df.orderBy(*order).withColumn(at, F.monotonically_increasing_id()), "numbered")
    part = F.shiftright(F.col(at), 33)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition of the sort, so far below the size bound of a broadcast
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    within = F.col(at) - F.shiftleft(F.col("_part"), 33)
    return (rows.withColumn("_part", part).join(F.broadcast(offsets), "_part")
                .withColumn(col, F.col("_offset") + within).drop(at, "_part", "_offset"))


def connected_components(edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """``(u, v)`` long pairs -> ``(node, component)``: the smallest node reachable.

    Alternating large-star and small-star steps: neighbour minima are
    aggregates (combined map-side) joined back to the edges, so no group is
    gathered; a node with very many edges is split by the skew join. Each
    round is landed (in ``scratch``, if given). Nodes without an edge do not appear.
    """
    land = (scratch or Scratch()).land
    cur = land(edges.where("u is not null and v is not null and u != v")
                    .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                    .distinct(), "cc")

    def mark(e: DataFrame):
        r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return tuple(r)

    seen = mark(cur)
    while True:
        both = cur.union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.join(least, "u").where("v > u")
                     .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u")
                      .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                                F.struct(F.col("u"), F.col("m").alias("v")))).alias("e"))
                      .select("e.u", "e.v").where("u != v").distinct())
        cur = land(small, "cc")
        now = mark(cur)
        if now == seen:
            break
        seen = now
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


# -- words of Arrow string columns ------------------------------------------------

# Odd 64-bit constants of the multiplicative hashes (any odd values would do).
_BASE = 0x9E3779B97F4A7C15
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)
_MASK = (1 << 64) - 1
_BLOCK = 1 << 20


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer spreading every bit of a 64-bit hash."""
    h = h ^ (h >> np.uint64(30))
    h = h * _MIX1
    h = h ^ (h >> np.uint64(27))
    h = h * _MIX2
    return h ^ (h >> np.uint64(31))


def byte_table(members: Iterator[int], lower: bool = False) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(members)] = True
    return t


# Words: runs of bytes other than ASCII white space.
NOT_SPACE = byte_table(b for b in range(256) if b != 0x20 and not 0x09 <= b <= 0x0D)
# Words: runs of ASCII letters and digits and of all non-ASCII bytes.
ALNUM = byte_table(b for b in range(256)
                   if b >= 0x80 or 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20

_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _powers.get("up")
    if have is None or len(have) < n:
        with np.errstate(over="ignore"):
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                p = np.full(n, base, np.uint64)
                p[0] = 1
                _powers[name] = np.cumprod(p, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


class Words:
    """Word positions (byte offsets) and hashes of a run of texts.

    ``first[d]:first[d + 1]`` are the words of text ``d``; ``prefixes`` maps a
    byte length to hashes of the words' first bytes (0 for shorter words).
    """

    def __init__(self, data: np.ndarray, offs: np.ndarray, table: np.ndarray, prefixes=()):
        starts, ends, hashes = [], [], []
        pre = {p: [] for p in prefixes}
        n = len(data)
        fresh = np.zeros(n + 1, bool)  # a text begins here
        fresh[offs[offs < n]] = True
        at = 0
        while at < n:
            to = min(n, at + _BLOCK)
            while to < n and table[data[to]] and not fresh[to]:  # never cut a word
                to += 1
            block = _LOWER[data[at:to]]
            word = table[data[at:to]]
            new = fresh[at:to]
            begin = word.copy()
            begin[1:] &= ~word[:-1] | new[1:]
            stop = word.copy()
            stop[:-1] &= ~word[1:] | new[1:]
            s, e = np.flatnonzero(begin), np.flatnonzero(stop) + 1
            if len(s):
                up, down = _power_tables(to - at + 1)
                with np.errstate(over="ignore"):
                    total = np.zeros(to - at + 1, np.uint64)
                    np.cumsum((block.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
                    size = (e - s).astype(np.uint64)
                    hashes.append(mix((total[e] - total[s]) * down[s] + size))
                    for p in prefixes:
                        end = np.minimum(s + p, e)
                        h = mix((total[end] - total[s]) * down[s] + np.uint64(p << 32))
                        pre[p].append(np.where(e - s > p, h, np.uint64(0)))
                starts.append(s + at)
                ends.append(e + at)
            at = to
        cat = lambda xs, t: np.concatenate(xs) if xs else np.zeros(0, t)
        self.start, self.end = cat(starts, np.int64), cat(ends, np.int64)
        self.hash = cat(hashes, np.uint64)
        self.prefix = {p: cat(x, np.uint64) for p, x in pre.items()}
        self.first = np.searchsorted(self.start, offs)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the ``k``-word sequences starting at each word, and which
        of them end in the same text."""
        return word_grams(self.hash, self.first, k)


def word_grams(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    n = len(h)
    if n < k:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    g = np.zeros(n - k + 1, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            g = mix(g * np.uint64(_BASE) + h[j:n - k + 1 + j])
    doc_end = np.repeat(first[1:], np.diff(first))[:n - k + 1]
    return g, np.arange(n - k + 1) + k <= doc_end


def text_slices(col: pa.Array, limit: int = 4 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of a string column holding about ``limit`` bytes (a single
    text may be longer): first row, past row, bytes, offsets. Null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    if pa.types.is_string(col.type):
        col = col.cast(pa.large_string())
    n = len(col)
    if not n:
        return
    _, off, raw = col.buffers()
    offs = np.frombuffer(off, np.int64, n + 1, col.offset * 8)
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        j = min(j, n)
        yield i, j, data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        i = j


def signed(h: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark longs."""
    return h.view(np.int64)


def cut_strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The slices ``data[start:end]`` of UTF-8 bytes (they may overlap) as strings."""
    size = (end - start).astype(np.int64)
    offs = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=offs[1:])
    at = np.repeat(start - offs[:-1], size) + np.arange(offs[-1])
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offs), pa.py_buffer(data[at].tobytes()))


def gathered(batches: Iterator[pa.RecordBatch], limit: int, size) -> Iterator[pa.RecordBatch]:
    """Runs of record batches joined until ``size`` of them reaches ``limit``."""
    held, total = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        total += size(batch)
        if total >= limit:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, total = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
