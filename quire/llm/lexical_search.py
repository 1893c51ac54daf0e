"""Ranked lexical search: NRA over impact-sorted lists.

Terms are runs of ASCII letters, digits and non-ASCII bytes, A-Z lower-cased. A
document's score for an item sums, over the item's terms with repeats, the
term's weight times its impact in the document, ``(scale * tf) div
(1000 * tf + 12 * m)`` with the length factor ``m`` (see :func:`search`); all in
64-bit integers.

* **Index.** One pass over the texts writes blocks of documents as rows: the
  block's postings by term, for terms that hit a sieve of the items' terms
  (``2 ** sieve_bits`` bits, whatever the items; a term that only collides is
  never asked for). Global counts and document frequencies are sums over these
  rows. A block holds about ``block`` words or ``block_docs`` documents.
* **Items** are packed into blocks too, with the weights of their terms. Every
  item block meets every document block by an equi-join on a salted block
  number, so neither side passes through the driver or one task.
* **Search** (no random access). Within a block each term of an item is a list
  sorted by impact. All lists are read in steps; a document's lower bound is
  what was read of it, its upper bound adds the next unread value of every list
  in which it has not been seen. Reading ends when no other document can reach the
  k-th lower bound and the bounds of all that are left meet: membership, scores and ties are
  then final. Scores of different blocks are independent, so the best ``k`` of
  the items are the best of the blocks'.

Null and empty texts hold no term and are no part of the counts. Every row is a
document of its own, repeated ids included; null ids come last in ties. Items
are told apart by row: repeated items are ranked each; an item without known
terms has no rows. An empty table gives none.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import ALNUM, _LOWER, Words, cut_strings, land, signed, text_slices

# Fixed values of the scoring formula.
SCALE, TF_STEP, LENGTH_STEP = 1_000_000_000, 1000, 12
LENGTH_BASE, LENGTH_SHARE = 100 - 25, 25


@dataclass(frozen=True)
class Params:
    k: int = 20
    sieve_bits: int = 20
    block: int = 1 << 20        # words
    block_docs: int = 1 << 13
    item_block: int = 1 << 8    # items
    met: int = 4                # document blocks that meet one copy of an item block
    first_step: int = 64        # postings read from each list at first


def _words(data: np.ndarray, offs: np.ndarray) -> Words:
    return Words(data, offs, ALNUM)


def _item_terms(batches):
    """Rows (item, term, times, bit) of rows (item, text)."""
    for batch in batches:
        item = np.array(batch.column(0))
        for i, _, data, offs in text_slices(batch.column(1)):
            w = _words(data, offs)
            terms = cut_strings(_LOWER[data], w.start, w.end)
            doc = np.repeat(np.arange(len(offs) - 1), np.diff(w.first))
            yield pa.record_batch([pa.array(item[doc + i]), terms.cast(pa.string()), pa.array(signed(w.hash))],
                                  ["item", "term", "hash"])


def _index(p: Params, sieve):
    """Rows (block, docs, n, terms, at, doc, tf): the documents of a block (ids
    and words), its terms, where their postings begin, and the postings."""
    def run(batches):
        bits = np.frombuffer(sieve.value, np.uint8)
        part, count = TaskContext.get().partitionId(), 0
        held = []   # (ids, n, document numbers, terms) of slices
        words = docs = 0

        def block():
            ids = pa.chunked_array([h[0] for h in held]).combine_chunks()
            n = np.concatenate([h[1] for h in held])
            base = np.cumsum([0] + [len(h[1]) for h in held])
            doc = np.concatenate([h[2] + b for h, b in zip(held, base)])
            coded = pa.chunked_array([h[3] for h in held]).combine_chunks().dictionary_encode()
            term = np.asarray(coded.indices).astype(np.int64)
            key, tf = np.unique((term << 32) | doc, return_counts=True)
            begin = np.searchsorted(key >> 32, np.arange(len(coded.dictionary) + 1))
            one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
            return pa.record_batch(
                [pa.array([(part << 32) + count], pa.int64()), one(ids), one(pa.array(n)),
                 one(coded.dictionary.cast(pa.string())), one(pa.array(begin.astype(np.int32))),
                 one(pa.array((key & 0xFFFFFFFF).astype(np.int32))), one(pa.array(tf.astype(np.int64)))],
                ["block", "docs", "n", "terms", "at", "doc", "tf"])

        for batch in batches:
            for i, j, data, offs in text_slices(batch.column(1)):
                w = _words(data, offs)
                bit = (w.hash >> np.uint64(64 - p.sieve_bits)).astype(np.int64)
                hit = np.flatnonzero((bits[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1)
                n = np.diff(w.first)
                doc = np.repeat(np.arange(j - i), n)[hit]
                held.append((batch.column(0).slice(i, j - i), n.astype(np.int64), doc,
                             cut_strings(_LOWER[data], w.start[hit], w.end[hit])))
                words, docs = words + len(w.start), docs + (j - i)
                if words >= p.block or docs >= p.block_docs:
                    yield block()
                    held, words, docs, count = [], 0, 0, count + 1
        if held:
            yield block()
    return run


INDEX = "block long, docs array<long>, n array<long>, terms array<string>, at array<int>, doc array<int>, tf array<long>"


def nra(lists: list[tuple[np.ndarray, np.ndarray]], docs: int, k: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """The documents that can be among the best ``k`` and their exact scores
    (above 0), from lists ``(document numbers, values)`` sorted by falling value.
    More than ``k`` come back where scores tie."""
    lower = np.zeros(docs, np.int64)
    unseen = np.ones((docs, len(lists)), bool)
    touched = np.zeros(docs, bool)
    alive = np.ones(docs, bool)  # bounds only close in, so what falls below the k-th stays there
    at = 0
    while True:
        nxt = np.zeros(len(lists), np.int64)
        for t, (doc, value) in enumerate(lists):
            some = doc[at:at + step]
            lower[some] += value[at:at + step]  # a list holds a document once
            unseen[some, t] = False
            touched[some] = True
            if at + step < len(value):
                nxt[t] = value[at + step]
        at, step = at + step, step * 2
        own = np.flatnonzero(touched & alive)
        kth = int(np.partition(lower[own], len(own) - k)[len(own) - k]) if len(own) >= k else 0
        gap = (unseen[own] * nxt).sum(axis=1)
        live = lower[own] + gap >= max(kth, 1)
        alive[own[~live]] = False
        # what no list has told of yet is bounded by the next values of all
        if not nxt.any() or (kth > int(nxt.sum()) and not gap[live].any()):
            return own[live], lower[own[live]]


def _ranked(p: Params):
    """The best ``k`` documents of a block for each item of an item block."""
    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                col = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
                get = lambda c, t=None: np.asarray(col[c][r].values)
                n, ids = get("n"), get("docs")
                place = {t: i for i, t in enumerate(col["terms"][r].values.to_pylist())}
                at, doc, tf = get("at"), get("doc"), get("tf")
                total_n, total_l = col["total_n"][r].as_py(), col["total_l"][r].as_py()
                m = LENGTH_BASE + (LENGTH_SHARE * n * total_n) // max(1, total_l)
                known: dict[int, tuple] = {}
                out = [[], [], []]
                for one in col["items"][r].values.to_pylist():
                    lists = []
                    for term, weight in zip(one["terms"], one["weights"]):
                        i = place.get(term)
                        if i is None or not weight:
                            continue
                        if i not in known:
                            d, f = doc[at[i]:at[i + 1]], tf[at[i]:at[i + 1]]
                            impact = (SCALE * f) // (TF_STEP * f + LENGTH_STEP * m[d])
                            order = np.argsort(-impact, kind="stable")
                            known[i] = d[order], impact[order]
                        lists.append((known[i][0], known[i][1] * weight))
                    if not lists:
                        continue
                    d, s = nra(lists, len(n), p.k, p.first_step)
                    best = np.lexsort((ids[d], -s))[:p.k]
                    out[0].append(np.full(len(best), one["item"]))
                    out[1].append(ids[d[best]])
                    out[2].append(s[best])
                yield pa.record_batch([pa.array(np.concatenate(c) if c else [], pa.int64()) for c in out],
                                      ["item", "doc_id", "score"])
    return run


def search(docs: DataFrame, items: DataFrame, params: Params = Params(), id_col: str = "doc_id",
           text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of every item.

    ``N`` counts the documents with a term and ``L`` all their terms; with ``df``
    of them holding a term it weighs ``floor(1000 * ln((2N + 2) / (2df + 1)))``.
    With ``n`` terms of its own a document has ``m = 75 + (25 * n * N) div L``.
    Equal scores come by ascending id; only scores above 0 count.
    """
    p = params
    spark = docs.sparkSession
    null_id = int(np.iinfo(np.int64).max)
    asked = land(items.select(F.monotonically_increasing_id().alias("item"), F.col(f"`{item_col}`").alias("item_id"),
                              F.coalesce(F.col(f"`{item_text}`"), F.lit("")).alias("text")), "lexical-items")
    terms = land(asked.select("item", "text").mapInArrow(_item_terms, "item long, term string, hash long")
                      .groupBy("item", "term", "hash").agg(F.count(F.lit(1)).alias("times")), "lexical-terms")
    sieve = np.zeros(1 << p.sieve_bits, np.uint8)
    bit = F.shiftrightunsigned("hash", 64 - p.sieve_bits)
    for row in terms.select(bit.alias("bit")).distinct().toLocalIterator():  # at most 2 ** sieve_bits
        sieve[row["bit"]] = 1
    known = spark.sparkContext.broadcast(np.packbits(sieve).tobytes())
    src = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(null_id)).alias("doc_id"),
                      F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    # small row groups: a row is a block, and a reader decodes a row group at once
    index = land(src.mapInArrow(_index(p, known), INDEX), "lexical-index", {"parquet.block.size": 16 << 20})
    total = index.select(F.aggregate("n", F.lit(0).cast("long"), lambda t, x: t + (x > 0).cast("long")).alias("n"),
                         F.aggregate("n", F.lit(0).cast("long"), lambda t, x: t + x).alias("l"))
    total_n, total_l, held = (int(x or 0) for x in total.agg(F.sum("n"), F.sum("l"), F.count("n")).first())
    salts = F.lit(max(1, held // p.met))
    counted = F.transform(F.sequence(F.lit(0), F.size("terms") - 1),
                       lambda i: F.struct(F.get("terms", i).alias("term"), (F.get("at", i + 1) - F.get("at", i)).alias("df")))
    df = (index.where(F.size("terms") > 0).select(F.explode(counted).alias("t")).groupBy(F.col("t.term").alias("term"))
               .agg(F.sum("t.df").alias("df")))
    weight = F.floor(1000 * F.log(F.lit(2.0 * total_n + 2) / (2 * F.col("df") + 1))).cast("long")
    weighed = (terms.join(df, "term").withColumn("weight", weight * F.col("times"))
                    .groupBy("item").agg(F.sort_array(F.collect_list(F.struct("term", "weight"))).alias("t")))
    # items in blocks of about item_block: an item is one small row
    blocks = max(1, -(-asked.count() // p.item_block))
    packed = land(weighed.groupBy(F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int").alias("iblock"))
                         .agg(F.collect_list(F.struct("item", F.col("t.term").alias("terms"),
                                                      F.col("t.weight").alias("weights"))).alias("items")), "lexical-packed")
    # salts in proportion to the document blocks: every task meets a few of them, and
    # one copy of the items; never broadcast, since both sides grow
    salted = packed.select("*", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"))
    met = (index.withColumn("salt", F.pmod(F.xxhash64("block"), salts).cast("int"))
                .select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("iblock"))
                .hint("merge").join(salted, ["iblock", "salt"])
                .select("docs", "n", "terms", "at", "doc", "tf", "items", F.lit(total_n).cast("long").alias("total_n"),
                        F.lit(total_l).cast("long").alias("total_l")))
    found = met.mapInArrow(_ranked(p), "item long, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), "doc_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= p.k)
    return (best.join(asked.select("item", "item_id"), "item")
                .select("item_id", F.col("rank").cast("int").alias("rank"),
                        F.nullif("doc_id", F.lit(null_id)).alias("doc_id"), "score"))
