"""Exact top-k search by inner product: pivot-table elimination.

Each component ``x`` of a vector becomes ``floor(256 * x)``; the score of a
query and a candidate is their integer inner product.

* **Pivot table.** Angles are a metric, and a score is both lengths times the
  cosine of the angle. The angles of every vector to ``pivots`` vectors (chosen
  farthest first from ``sample`` rows of least id hash; any choice gives the same
  result) are computed once and kept beside it. For a query and a candidate the
  largest difference of their angles to one pivot is a lower bound of their
  angle, so it gives an upper bound of the score.
* **Layout.** A vector belongs to the cell of its nearest pivot; a cell is dealt
  by id hash into blocks of about ``block`` vectors, so a cell of any size is many
  tasks. Of equal vectors only the ``k + 1`` smallest ids can be results, for
  any query, and only these are kept.
* **Search.** A query first meets the blocks of its own cell; its k-th score
  there is its threshold. It then meets the blocks of the other cells, unless
  the angle ranges of a cell bound its scores below the threshold. Queries that
  meet one block are dealt into groups of about ``group``. Within a block
  candidates are scored in the order of their bounds, until the next bound is
  below the k-th score; equal bounds are scored, so ties are exact.

Scores are exact: float products where every partial sum stays under 2 ** 53,
Python integers beyond; a score outside 64 bits is cut to them. Vectors that are null or hold null
or non-finite components take no part; shorter vectors count as padded with
zeros. Rows are told apart by row, not by id: of rows with one id each is a
query of its own and a candidate of the others. Null ids are candidates, after
all others in ties, and never queries.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import land

_NULL_ID = np.iinfo(np.int64).max
_SLACK = 1e-5  # of angles and cosines in float32


@dataclass(frozen=True)
class Params:
    k: int = 5
    pivots: int = 48
    sample: int = 2048
    block: int = 4096
    group: int = 4096
    first_step: int = 128     # candidates scored before the bound is looked at again


def _rows_of(col: pa.Array, dim: int) -> np.ndarray:
    """List column -> matrix, padded with zeros."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    size = np.asarray(col.value_lengths())
    flat = np.asarray(col.flatten(), np.float64)
    out = np.zeros((len(col), dim))
    row = np.repeat(np.arange(len(col)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def _angles(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths, and angles to the pivots (a zero vector is at angle 0 to all)."""
    with np.errstate(over="ignore", invalid="ignore"):
        top = np.abs(x).max(axis=1, initial=0)
        scaled = x / np.where(top > 0, top, 1)[:, None]
        length = np.sqrt((scaled ** 2).sum(axis=1))
        cosine = (scaled @ pivots.T) / np.where(length > 0, length, 1)[:, None]
    angle = np.arccos(np.clip(cosine, -1, 1)).astype(np.float32)
    angle[length == 0] = 0
    return length * top, angle


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x ** 2).sum(axis=1, keepdims=True))


def choose_pivots(x: np.ndarray, m: int) -> np.ndarray:
    """Farthest-first unit vectors of a sample, by angle."""
    x = x[np.abs(x).max(axis=1, initial=0) > 0]
    if not len(x):
        return np.zeros((1, x.shape[1]))
    x = np.unique(_unit(x), axis=0)
    own, near = [0], x @ x[0]
    while len(own) < min(m, len(x)):
        far = int(np.argmin(near))
        if near[far] > 1 - 1e-9:
            break
        own.append(far)
        near = np.maximum(near, x @ x[far])
    return x[own]


def _table(pivots: np.ndarray, dim: int):
    """(row, id, query, vec) -> the same with length, angles, cell."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            length, angle = _angles(_rows_of(batch.column("vec"), dim), pivots)
            yield pa.record_batch(
                [batch.column("row"), batch.column("id"), batch.column("query"), batch.column("vec"),
                 pa.array(length), pa.ListArray.from_arrays(
                     pa.array(np.arange(len(angle) + 1) * angle.shape[1], pa.int32()), pa.array(angle.ravel())),
                 pa.array(angle.argmin(axis=1).astype(np.int32))],
                ["row", "id", "query", "vec", "length", "angle", "cell"])
    return run


def _exact(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Integer inner products of ``q`` (a, d) with ``v`` (a, c, d)."""
    if np.abs(q).max(initial=0) * np.abs(v).max(initial=0) * q.shape[1] < 2.0 ** 53:
        return np.matmul(v, q[:, :, None])[:, :, 0].astype(np.int64)
    big = np.vectorize(int, otypes=[object])
    total = (big(v) * big(q)[:, None, :]).sum(axis=2)
    lo, hi = -(1 << 63), (1 << 63) - 1
    return np.array([[min(max(s, lo), hi) for s in r] for r in total], np.int64).reshape(total.shape)


def _merge(best_s, best_i, rows, cand, score, ids, own, k):
    """Put scored candidates (``rows``, ``cand``, ``score``) among the best of their rows."""
    touched = np.unique(rows)
    r = np.r_[np.repeat(touched, k), rows]
    c = np.r_[best_i[touched].ravel(), cand]
    s = np.r_[best_s[touched].ravel(), score]
    r, c, s = r[c >= 0], c[c >= 0], s[c >= 0]
    order = np.lexsort((own[c], ids[c], ~s, r))
    r, c, s = r[order], c[order], s[order]
    place = np.arange(len(r)) - np.searchsorted(r, r)
    r, c, s, place = (x[place < k] for x in (r, c, s, place))
    best_s[r, place], best_i[r, place] = s, c


def _search(p: Params, dim: int, pivots: int):
    """The best ``k`` candidates within a block of each query that meets it:
    rows (row of the query, id and row of the candidate, score)."""
    least = np.iinfo(np.int64).min

    def run(block: pa.Table, asked: pa.Table) -> pa.Table:
        out = [[], [], [], []]
        if block.num_rows and asked.num_rows:
            ids, own = np.array(block.column("id")), np.array(block.column("row"))
            v, vl = _rows_of(block.column("vec"), dim), np.array(block.column("length"))
            va = _rows_of(block.column("angle"), pivots).astype(np.float32)
            step = max(1, (1 << 21) // len(v))
            for a in range(0, asked.num_rows, step):
                part = asked.slice(a, step)
                q, qr = _rows_of(part.column("vec"), dim), np.array(part.column("row"))
                qa = _rows_of(part.column("angle"), pivots).astype(np.float32)
                floor = np.array(part.column("floor"))
                apart = np.zeros((len(q), len(v)), np.float32)
                for j in range(pivots):
                    np.maximum(apart, np.abs(qa[:, j:j + 1] - va[None, :, j]), out=apart)
                with np.errstate(over="ignore", invalid="ignore"):
                    scale = np.array(part.column("length"))[:, None] * vl[None, :]
                    bound = scale * (np.cos(np.maximum(apart - _SLACK, 0)) + _SLACK)
                    bound[~(scale < 2.0 ** 62)] = np.inf  # cut scores are not bounded by it
                bound[qr[:, None] == own[None, :]] = -np.inf
                order = np.argsort(-bound, axis=1)
                bound = np.take_along_axis(bound, order, axis=1)
                best_s = np.full((len(q), p.k), least)
                best_i = np.full((len(q), p.k), -1)
                live, at, size = np.arange(len(q)), 0, p.first_step
                while at < len(v) and len(live):
                    full = best_i[live, -1] >= 0
                    kth = np.maximum(np.where(full, best_s[live, -1], least), floor[live])
                    live = live[(bound[live, at] > -np.inf) & (bound[live, at] >= kth)]
                    for s in range(0, len(live), 256):
                        some = live[s:s + 256]
                        cand = order[some, at:at + size]
                        score = _exact(q[some], v[cand])
                        kth = np.maximum(np.where(best_i[some, -1] >= 0, best_s[some, -1], least), floor[some])
                        r, c = np.nonzero((score >= kth[:, None]) & (bound[some, at:at + size] > -np.inf))
                        if len(r):
                            _merge(best_s, best_i, some[r], cand[r, c], score[r, c], ids, own, p.k)
                    at, size = at + size, size * 2
                r, c = np.nonzero(best_i >= 0)
                for col, value in zip(out, (qr[r], ids[best_i[r, c]], own[best_i[r, c]], best_s[r, c])):
                    col.append(value)
        cols = [pa.array(np.concatenate(c) if c else np.zeros(0), pa.int64()) for c in out]
        return pa.table(cols, ["row", "id", "own", "score"])
    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("row").orderBy(F.col("score").desc(), "id", "own")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(vectors: DataFrame, params: Params = Params(), id_col: str = "vec_id", vec_col: str = "embedding",
           queries: Column | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` best candidates of every
    query row, ties to the smaller id. ``queries`` tells query rows (default:
    ids divisible by 50); candidates are all rows but the query's own."""
    p = params
    ask = F.pmod(F.col(f"`{id_col}`"), F.lit(50)) == 0 if queries is None else queries
    raw = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vec_col}`").alias("raw"),
                         ask.alias("query"))
    finite = ~F.exists("raw", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    raw = raw.where(F.col("raw").isNotNull()).where(finite)
    # floor(256 x) keeps the element type exactly: 256 x only moves the exponent
    kind = vectors.schema[vec_col].dataType.elementType.simpleString()
    kind = "float" if kind == "float" else "double"
    scaled = F.transform("raw", lambda x: F.when(
        F.abs(x.cast("double")) < 2.0 ** 40, F.floor(F.lit(256.0) * x.cast("double")).cast("double"))
        .otherwise(F.lit(256.0) * x.cast("double")))
    rows = land(raw.select(F.monotonically_increasing_id().alias("row"),
                           F.coalesce("id", F.lit(int(_NULL_ID))).alias("id"),
                           F.coalesce("query", F.lit(False)).alias("query"),
                           scaled.cast(f"array<{kind}>").alias("vec")), "vectors")
    dim = max(1, rows.agg(F.max(F.size("vec"))).first()[0] or 1)
    sample = rows.orderBy(F.xxhash64("id", "row"), "row").limit(p.sample).select("vec").toPandas()["vec"]
    first = np.zeros((len(sample), dim))
    for i, x in enumerate(sample):
        first[i, :len(x)] = x
    pivots = choose_pivots(first, p.pivots)
    # equal vectors (trailing zeros aside): every query keeps at most k of them
    same = Window.partitionBy("vec").orderBy("id", "row")
    some = rows.withColumn("_n", F.row_number().over(same)).where(F.col("_n") <= p.k + 1).select("row")
    shape = f"row long, id long, query boolean, vec array<{kind}>, length double, angle array<float>, cell int"
    table = land(rows.mapInArrow(_table(pivots, dim), shape), "pivot-table")
    cand = table.join(some, "row", "left_semi")
    cells = land(cand.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.max("length").alias("longest"),
        *[F.min(F.col("angle")[j]).alias(f"lo{j}") for j in range(len(pivots))],
        *[F.max(F.col("angle")[j]).alias(f"hi{j}") for j in range(len(pivots))]), "pivot-cells")
    # one row per cell, so at most ``pivots`` rows
    cell = cells.select("cell", F.ceil(F.col("n") / p.block).cast("int").alias("parts"), "longest",
                        F.array(*[f"lo{j}" for j in range(len(pivots))]).alias("lo"),
                        F.array(*[f"hi{j}" for j in range(len(pivots))]).alias("hi"))
    cell = F.broadcast(land(cell, "pivot-ranges"))
    blocks = land(cand.join(cell.select("cell", "parts"), "cell")
                      .select("cell", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int").alias("part"),
                              "row", "id", "vec", "length", "angle"), "pivot-blocks")
    asked = table.where("query").select("row", "id", "vec", "length", "angle", F.col("cell").alias("home"))

    def meet(met: DataFrame, name: str) -> DataFrame:
        """Answers of queries to the blocks of the cells they meet (column
        ``cell``); a block stands once for each group of its queries."""
        groups = F.broadcast(land(met.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / p.group).cast("int").alias("groups")),
                                  "pivot-groups"))  # one row per cell
        met = (met.join(groups, "cell").join(cell.select("cell", "parts"), "cell")
                  .select("cell", F.pmod(F.xxhash64("row"), F.col("groups")).cast("int").alias("group"), "row", "vec",
                          "length", "angle", "floor",
                          F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")))
        held = (blocks.join(groups, "cell").select(
            "cell", "part", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("group"),
            "row", "id", "vec", "length", "angle"))
        key = ["cell", "part", "group"]
        return land(_best(held.groupBy(*key).cogroup(met.groupBy(*key)).applyInArrow(
            _search(p, dim, len(pivots)), "row long, id long, own long, score long"), p.k), name)

    least = F.lit(int(np.iinfo(np.int64).min))
    home = meet(asked.withColumn("cell", F.col("home")).withColumn("floor", least), "pivot-home")
    reached = home.groupBy("row").agg(F.max(F.when(F.col("rank") == p.k, F.col("score"))).alias("floor"))
    rest = asked.join(reached, "row", "left").withColumn("floor", F.coalesce("floor", least))
    # the angle of a query to a cell's vectors is at least its distance to the cell's range
    gap = F.aggregate(F.zip_with(F.col("angle"), F.arrays_zip("lo", "hi"),
                                 lambda a, r: F.greatest(r["lo"] - a, a - r["hi"], F.lit(0.0).cast("float"))),
                      F.lit(0.0).cast("float"), lambda t, x: F.greatest(t, x))
    gap = F.greatest(gap.cast("double") - 2 * _SLACK, F.lit(0.0))
    most = F.col("length") * F.col("longest")
    # a negative cosine would be bounded by the shortest vector; 0 will do
    bound = F.when(most >= 2.0 ** 62, F.lit(float("inf"))).otherwise(
        F.greatest(most * (F.cos(gap) + _SLACK), F.lit(0.0)))
    every = F.array(*[F.lit(i) for i in range(len(pivots))])
    rest = (rest.withColumn("cell", F.explode(every)).where("cell != home")
                .join(cell.select("cell", "longest", "lo", "hi"), "cell").where(bound >= F.col("floor"))
                .select("row", "vec", "length", "angle", "cell", "floor"))
    away = meet(land(rest, "pivot-met"), "pivot-away")
    best = _best(home.drop("rank").unionByName(away.drop("rank")), p.k)
    names = asked.select("row", F.col("id").alias("query_id"))
    return best.join(names, "row").select(
        "query_id", F.col("rank").cast("int").alias("rank"),
        F.nullif("id", F.lit(int(_NULL_ID))).alias("vec_id"), "score")
