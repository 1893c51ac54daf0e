"""Benchmark decontamination: n-gram seeds, then local alignment.

1. The benchmark items are split into blocks of bounded size by a hash of
   their text; the steps below run once a block over all documents.
2. Every ``k``-word sequence of an item is a seed, however often it stands in
   the documents: copies of an item never cost an edited copy its seeds.
3. Around a seed, a cheap bound comes first: the alignment cannot score more
   than the words that item and passage share, nor than the words of the item
   in any stretch as long as an alignment of ``min_score`` can be. Passages
   met only by a common sequence end here; no match is lost.
4. Where the bound allows a match, the passage around the seeds (the item's length
   and a half to both sides) is aligned with the item by Smith-Waterman over
   words. Score: the best local alignment (match 1, mismatch and gap -1)
   divided by the item's words, so 1 is a verbatim copy. Overlapping passages
   of one item are aligned as one.

Words are runs of ASCII letters, digits and non-ASCII characters, case
ignored (ASCII). Items of fewer than ``k`` words use their whole word
sequence as one seed. Items without words, and null or empty texts, match
nothing. Equal items each report their matches; repeated documents each
report theirs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from quire.llm.common import ALNUM, Words, signed, text_slices, word_grams


@dataclass(frozen=True)
class Params:
    k: int = 4                    # words of a seed
    min_score: float = 0.5
    block_bytes: int = 8 << 20    # item text that is sent to every task at once


class Items:
    """Word hashes of a block of items and the seeds that point into them."""

    def __init__(self, ids: list, texts: list[str], k: int):
        self.k, self.ids = k, ids
        self.words, gram, owner, at = [], [], [], []
        for i, j, data, offs in text_slices(pa.array(texts, pa.string())):
            w = Words(data, offs, ALNUM)
            for n in range(j - i):
                h = w.hash[w.first[n]:w.first[n + 1]]
                self.words.append(h)
                if len(h):
                    g, _ = word_grams(h, np.array([0, len(h)]), min(k, len(h)))
                    gram.append(g)
                    owner.append(np.full(len(g), i + n))
                    at.append(np.arange(len(g)))
        cat = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
        gram, owner, at = cat(gram, np.uint64), cat(owner, np.int64), cat(at, np.int64)
        order = np.argsort(gram, kind="stable")
        self.gram, self.owner, self.at = gram[order], owner[order], at[order]
        self.sizes = sorted({min(k, len(h)) for h in self.words if len(h)})
        self.bags = [np.unique(h, return_counts=True) for h in self.words]


_BITS = 20


def _sieve(grams: np.ndarray) -> np.ndarray:
    s = np.zeros(1 << _BITS, bool)
    s[grams >> np.uint64(64 - _BITS)] = True
    return s


def _found(w: Words, sizes: list[int], grams: np.ndarray, sieve: np.ndarray):
    """(word position, gram) of every known gram; ``grams`` sorted."""
    for k in sizes:
        g, ok = w.grams(k)
        near = np.flatnonzero(sieve[g >> np.uint64(64 - _BITS)] & ok)
        at = np.searchsorted(grams, g[near])
        at[at == len(grams)] = 0
        hit = grams[at] == g[near]
        yield near[hit], g[near][hit]


def align(item: np.ndarray, passage: np.ndarray) -> tuple[float, int, int]:
    """Best local alignment of two hash sequences: score and the passage's
    first and past word. Match 1, mismatch -1, gap -1."""
    n = len(passage)
    j = np.arange(1, n + 1)
    prev, start = np.zeros(n + 1), np.arange(n + 1)
    best = (0.0, 0, 0)
    for x in item:
        diag = prev[:-1] + np.where(passage == x, 1.0, -1.0)
        up = prev[1:] - 1
        cell = np.maximum(diag, up)
        origin = np.where(diag >= up, start[:-1], start[1:])
        origin = np.where(cell > 0, origin, j)
        cell = np.maximum(cell, 0)
        # gaps in the item: the best earlier cell less its distance
        lifted = cell + j
        run = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted >= run, np.arange(n), 0))
        row = run - j
        origin = np.where(row > 0, origin[source], j)
        prev = np.concatenate(([0.0], row))
        start = np.concatenate(([0], origin))
        top = int(np.argmax(row))
        if row[top] > best[0]:
            best = (float(row[top]), int(origin[top]), top + 1)
    return best


def _may_score(bag, passage: np.ndarray, least: float, span: int) -> bool:
    """Whether an alignment of ``span`` passage words at most may score ``least``:
    it matches no more words than both sides hold, and no more than the
    stretch has words of the item."""
    word, count = bag
    at = np.searchsorted(word, passage)
    at[at == len(word)] = 0
    known = word[at] == passage
    if np.minimum(np.bincount(at[known], minlength=len(word)), count).sum() < least:
        return False
    total = np.concatenate(([0], np.cumsum(known)))
    return int((total[span:] - total[:-span]).max(initial=0) if len(passage) > span else total[-1]) >= least


def _runs(doc: np.ndarray, owners: np.ndarray, limit: int = 1 << 20):
    """Bounds of runs of hits (sorted by document) that point to about ``limit``
    seeds of items; a document is never split."""
    total = np.cumsum(owners)
    ends = np.flatnonzero(np.r_[doc[1:] != doc[:-1], True]) + 1
    a = done = 0
    for b, following in zip(ends, np.r_[ends[1:], 0]):
        if not following or total[following - 1] - done > limit:
            yield a, b
            a, done = b, total[b - 1]


def _matcher(items: Items, min_score: float):
    """A function giving (row, item id, score, first word, past word) of the
    matches in a column of texts."""
    grams, owner, words, sizes = items.gram, items.owner, items.words, items.sizes
    sieve, ids, bags = _sieve(grams), items.ids, items.bags

    def find(texts: pa.Array):
        for i, _, data, offs in text_slices(texts):
            w = Words(data, offs, ALNUM)
            hits = [(p, g) for p, g in _found(w, sizes, grams, sieve) if len(p)]
            if not hits:
                continue
            pos = np.concatenate([x[0] for x in hits])
            g = np.concatenate([x[1] for x in hits])
            order = np.argsort(pos, kind="stable")
            pos, g = pos[order], g[order]
            lo, hi = np.searchsorted(grams, g), np.searchsorted(grams, g, "right")
            for a, b in _runs(np.searchsorted(w.first, pos, "right"), hi - lo):
                yield from ((i + d, *rest) for d, *rest in passages(w, pos[a:b], lo[a:b], hi[a:b]))

    def passages(w: Words, pos: np.ndarray, lo: np.ndarray, hi: np.ndarray):
        item = np.concatenate([owner[a:b] for a, b in zip(lo, hi)])
        pos = np.repeat(pos, hi - lo)
        doc = np.searchsorted(w.first, pos, "right") - 1
        order = np.lexsort((pos, item, doc))
        pos, item, doc = pos[order], item[order], doc[order]
        cut = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])])
        for a, b in zip(cut, np.r_[cut[1:], len(pos)]):
            d, it = int(doc[a]), int(item[a])
            size = len(words[it])
            reach = size * 3 // 2 + 2
            begin, end = int(w.first[d]), int(w.first[d + 1])
            # an alignment of this score has no more gaps than the rest of the item
            least, span = min_score * size - 1e-9, max(1, int(size * (2 - min_score)) + 1)
            best, at = (0.0, 0, 0), 0
            p = pos[a:b]
            for part in np.split(p, np.flatnonzero(np.diff(p) > 2 * reach) + 1):
                left = max(begin, int(part[0]) - reach)
                right = min(end, int(part[-1]) + reach)
                if not _may_score(bags[it], w.hash[left:right], least, span):
                    continue
                got = align(words[it], w.hash[left:right])
                if got[0] > best[0]:
                    best, at = got, left - begin
            score = best[0] / size
            if score >= min_score:
                yield d, ids[it], score, at + best[1], at + best[2]
    return find


def _report(find):
    def run(batches):
        for batch in batches:
            keys = batch.column(0)
            got = list(zip(*find(batch.column(1)))) or [()] * 5
            yield pa.record_batch([keys.take(pa.array(got[0], pa.int64())), pa.array(got[1], pa.int64()),
                                   pa.array(got[2], pa.float64()), pa.array(got[3], pa.int64()),
                                   pa.array(got[4], pa.int64())],
                                  ["doc_id", "item_id", "score", "first_word", "past_word"])
    return run


def _clean(find, text_at: int):
    def run(batches):
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            keep[[m[0] for m in find(batch.column(text_at))]] = False
            yield batch.filter(pa.array(keep))
    return run


def _blocks(benchmark: DataFrame, params: Params):
    """Matchers of the item blocks."""
    items = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    total = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    blocks = max(1, -(-2 * total // params.block_bytes))
    items = items.withColumn("_b", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    for b in range(blocks):
        # a block: about half of block_bytes of item text on average
        rows = items.where(F.col("_b") == b).orderBy("item_id", "text").collect()
        block = Items([r["item_id"] for r in rows], [r["text"] for r in rows], params.k)
        if not len(block.gram):
            continue
        yield _matcher(block, params.min_score)


def find_benchmark_passages(docs: DataFrame, benchmark: DataFrame, params: Params = Params(),
                            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, item_id, score, first_word, past_word``: a row for each document
    and item whose best alignment scores ``min_score`` or more; the words of
    the matching passage are ``first_word`` up to, not including, ``past_word``.

    ``id_col`` may have any type (use a row number to tell repeated ids apart)."""
    schema = StructType([StructField("doc_id", docs.schema[id_col].dataType),
                         StructField("item_id", LongType()), StructField("score", DoubleType()),
                         StructField("first_word", LongType()), StructField("past_word", LongType())])
    src = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    out = docs.sparkSession.createDataFrame([], schema)
    for find in _blocks(benchmark, params):
        out = out.union(src.mapInArrow(_report(find), schema))
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, params: Params = Params(),
                      text_col: str = "text") -> DataFrame:
    """The documents, all columns as they are, without those that hold a
    benchmark passage. Rows pass through; nothing is shuffled."""
    at = docs.columns.index(text_col)
    out = docs
    for find in _blocks(benchmark, params):
        out = out.mapInArrow(_clean(find, at), docs.schema)
    return out
